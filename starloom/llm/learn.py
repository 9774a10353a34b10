"""What the trained operators share: bounded training rows, held-out rows, calibration, counts by key."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_TRAIN_ROWS = 20_000  # a classifier's training rows, at most about so many


def remainder(id_col: str, n: int) -> Column:
    """The CRC-32 of the id written as text, modulo ``n``: decides which rows are held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def bounded_sample(rows: DataFrame, id_col: str, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """All rows if there are at most ``max_rows``, else about so many, chosen by a hash of the id."""
    n = rows.count()
    if n <= max_rows:
        return rows
    limit = int(max_rows / n * 1_000_000)
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(1_000_000)) < limit)


def shares(counts: dict, total: int) -> dict:
    """How many rows each label may give so that all give about ``total``: small ones all of theirs, the others alike."""
    left, given = total, {}
    for k, (label, n) in enumerate(sorted(counts.items(), key=lambda c: (c[1], str(c[0])))):
        given[label] = min(n, left // (len(counts) - k))
        left -= given[label]
    return given


def sample_by_label(rows: DataFrame, id_col: str, label_col: str, max_rows: int = MAX_TRAIN_ROWS) -> tuple[DataFrame, list]:
    """About ``max_rows`` of the rows at most, chosen by a hash of the id, and all labels: rare ones keep all their rows."""
    counts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    parts = 1_000_000
    chosen = F.lit(False)
    for label, n in shares(counts, max_rows).items():
        below = parts if n == counts[label] else int(n / counts[label] * parts)
        chosen |= F.col(label_col).eqNullSafe(F.lit(label)) & (F.pmod(F.xxhash64(F.lit("sample"), id_col), F.lit(parts)) < below)
    return rows.where(chosen), sorted(counts)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (the last is the intercept) of a small logistic regression, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(float)
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = sigmoid(x @ w)
        gradient = x.T @ (p - y) + penalty @ w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-8:
            break
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def keyed_sums(
    rows: DataFrame,
    count: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]],
    width: int,
    reduce: dict[int, Callable] | None = None,
) -> DataFrame:
    """Sums of count vectors by 64-bit key over all rows: columns ``key`` and ``n0`` to ``n<width - 1>``.

    ``count`` gives the distinct keys of a batch and a matrix of counts, so that each task adds up
    its own rows before anything is shuffled. ``reduce`` names other functions than the sum.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = count(batch)
            columns = [pa.array(keys.view(np.int64))] + [pa.array(counts[:, i].astype(np.int64)) for i in range(width)]
            yield pa.RecordBatch.from_arrays(columns, ["key"] + [f"n{i}" for i in range(width)])

    schema = "key long, " + ", ".join(f"n{i} long" for i in range(width))
    return rows.mapInArrow(each, schema).groupBy("key").agg(
        *[(reduce or {}).get(i, F.sum)(f"n{i}").alias(f"n{i}") for i in range(width)]
    )


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their rows of counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first, axis=0)


def table_of(counts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A bounded count table on the driver: sorted keys and their counts."""
    found = counts.toArrow()
    keys = found["key"].to_numpy().view(np.uint64)
    values = np.column_stack([found[f"n{i}"].to_numpy() for i in range(width)]) if len(keys) else np.zeros((0, width))
    order = np.argsort(keys)
    return keys[order], values[order].astype(np.float64)
