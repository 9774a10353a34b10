"""Document fingerprints by a randomised edit embedding.

Every text walks through a random string machine that all texts share: at step t it emits the
character it stands on and moves on if a random bit of (t, character) says so. Texts that differ by a
few edits fall into step again soon, so their emitted strings differ in few places: edit distance has
become Hamming distance. The walk starts anew every ``BLOCK`` characters, so that all blocks walk side by
side, and is followed for two steps per character, which bring it to the end on average; beyond, texts
would only agree in having ended. A fingerprint samples the emitted string of the
whole text in ``SAMPLES`` places, 4 bits of each; a place depends on the length alone and is the same for
two lengths with the probability of their ratio. Bands of samples give candidates, which are verified.

Defined results: a null text is empty; all samples of an empty text are 0. Equal texts have equal fingerprints.
Rows that repeat an id follow each other by the hash of their texts. A single document is followed by itself.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.text import mix, slices

BLOCK = 512
STEPS = 2 * BLOCK
SAMPLES = 128
BANDS = 16
KINDS = 256  # characters fall into so many kinds; kind 0 stands behind the end

_rng = np.random.Generator(np.random.PCG64(5))
_MOVES = _rng.integers(0, 2, (STEPS, KINDS), np.uint8)
_MOVES[:, 0] = 0
_SYMBOLS = _rng.integers(0, 16, (SAMPLES, KINDS), np.uint8)
_SYMBOLS[:, 0] = 0
_DRAWS = _rng.random((SAMPLES, 96))


def _records() -> np.ndarray:
    """For every sample the places where a random order of 0, 1, 2, ... reaches a new least: the last one in reach is sampled."""
    records = np.zeros((SAMPLES, _DRAWS.shape[1] + 1))
    for i in range(_DRAWS.shape[1]):
        records[:, i + 1] = np.ceil(np.minimum((records[:, i] + 1) / np.maximum(_DRAWS[:, i], 1e-9), 2.0**52))
    return records.astype(np.int64)


_RECORDS = _records()


def places(lengths: np.ndarray) -> np.ndarray:
    """Sampled places in the emitted strings of texts of these lengths."""
    return np.stack([r[np.searchsorted(r, np.maximum(2 * lengths, 1)) - 1] for r in _RECORDS], axis=1)


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of 4-bit samples for each text."""
    codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
    lengths = np.array([len(c) for c in codes], np.int64)
    out = np.zeros((len(texts), SAMPLES), np.uint8)
    if not lengths.sum():
        return out
    flat = (mix(np.concatenate(codes).astype(np.uint64)) % np.uint64(KINDS - 1)).astype(np.uint8) + np.uint8(1)
    begin = np.cumsum(lengths) - lengths
    # two steps per character of each block
    sampled = places(lengths)
    text = np.repeat(np.arange(len(texts)), SAMPLES)
    sample = np.tile(np.arange(SAMPLES), len(texts))
    block, step = sampled.ravel() // STEPS, sampled.ravel() % STEPS
    some = lengths[text] > 0
    text, sample, block, step = text[some], sample[some], block[some], step[some]
    key = text * (int(block.max()) + 1) + block
    used, which = np.unique(key, return_inverse=True)
    owner, number = used // (int(block.max()) + 1), used % (int(block.max()) + 1)
    start = begin[owner] + number * BLOCK
    size = np.minimum(lengths[owner] - number * BLOCK, BLOCK)
    column = np.arange(BLOCK + 1)
    field = np.where(column < size[:, None], flat[np.minimum(start[:, None] + column, len(flat) - 1)], 0)
    field = np.ascontiguousarray(field.astype(np.uint8)).ravel()
    at = np.arange(len(used)) * (BLOCK + 1)
    order = np.argsort(step, kind="stable")
    bounds = np.searchsorted(step[order], np.arange(STEPS + 1))
    for t in range(int(step.max()) + 1):
        kind = field[at]
        if bounds[t] < bounds[t + 1]:
            here = order[bounds[t] : bounds[t + 1]]
            out[text[here], sample[here]] = _SYMBOLS[sample[here], kind[which[here]]]
        at += _MOVES[t][kind]
    return out


def as_text(samples: np.ndarray) -> list[str]:
    packed = (samples[:, ::2] << 4) | samples[:, 1::2]
    return [row.tobytes().hex() for row in packed]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of samples that agree."""
    return (a == b).mean(axis=1)


def _followed(pairs: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    """Result rows of (id, text, text of the next document)."""
    ids, own, after = zip(*pairs, strict=True) if pairs else ((), (), ())
    edited = [x[: len(x) - len(x) // 2] + y[: len(x) // 2] for x, y in zip(own, after, strict=True)]
    # the next document's fingerprint is worked out with its own row, but for the last
    prints = fingerprints([*own, *after[-1:]])
    a, b = prints[: len(own)], prints[1:]
    c = fingerprints(edited)
    columns = [
        pa.array(ids, kind),
        pa.array([len(x) for x in own], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        pa.array(as_text(a), pa.string()),
        pa.array(as_text(c), pa.string()),
        pa.array(likeness(a, c)),
        pa.array(likeness(a, b)),
    ]
    return pa.RecordBatch.from_arrays(columns, NAMES)


NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of every text and of its edit: the second half replaced by the beginning of the next document.

    The next document has the next smaller id; the first follows the last. Documents are laid out by id over
    tasks, each of which streams through its own; only the first and the last of each task meet their
    neighbours in a second, small step.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = [F.desc("id"), F.xxhash64("text")]
    laid_out = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)

    def each(batches):
        first = last = arrow = task = None
        for batch in batches:
            arrow = batch.schema.field("id").type
            for _, part in slices_of(batch):
                ids, texts = part["id"].to_pylist(), part["text"].to_pylist()
                if first is None:
                    first = (ids[0], texts[0])
                else:
                    ids, texts = [last[0], *ids], [last[1], *texts]
                last = (ids[-1], texts[-1])
                if len(ids) > 1:
                    yield _with_ends(_followed(list(zip(ids[:-1], texts[:-1], texts[1:], strict=True)), arrow), None, None)
        if first is not None:
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            for end, (i, text) in enumerate((first, last)):
                row = pa.RecordBatch.from_arrays([pa.array([i], arrow), *(pa.nulls(1, t) for t in _KINDS)], NAMES)
                yield _with_ends(row, task * 2 + end, text)

    schema = f"id {kind.simpleString()}, {_COLUMNS}, place long, text string"
    found = stored(laid_out.mapInArrow(each, schema), "fingerprints")
    ends = found.where("place is not null").select("id", "place", "text")
    # two rows for each task of the layout
    by_place = Window.orderBy("place")
    follower = F.coalesce(F.lead("text").over(by_place), F.first("text").over(by_place))
    open_rows = ends.withColumn("next", follower).where("place % 2 = 1").select("id", "text", "next")

    def close(batches):
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("id", "text", "next")]
            for row in zip(*columns, strict=True):
                yield _followed([row], batch.schema.field("id").type)

    closed = open_rows.mapInArrow(close, f"id {kind.simpleString()}, {_COLUMNS}")
    done = found.where("place is null").drop("place", "text")
    return done.unionByName(closed).withColumnRenamed("id", id_col)


_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _with_ends(batch: pa.RecordBatch, place, text) -> pa.RecordBatch:
    n = batch.num_rows
    arrays = [*batch.columns, pa.array([place] * n, pa.int64()), pa.array([text] * n, pa.string())]
    return pa.RecordBatch.from_arrays(arrays, [*NAMES, "place", "text"])


def slices_of(batch: pa.RecordBatch):
    """Runs of rows of bounded text."""
    for row, part in slices(batch["text"]):
        yield row, batch.slice(row, len(part))


def near_pairs(prints: DataFrame, *, id_col="doc_id", print_col="fingerprint", least=0.8) -> DataFrame:
    """Pairs of classes of equal fingerprints that share a band and agree in ``least`` of all samples.

    Returns ``a`` and ``b``, the smallest ids of both classes, and their ``likeness``. Copies are one class and make no pairs.
    """
    digits = SAMPLES // BANDS
    classes = prints.groupBy(F.col(print_col).alias("print")).agg(F.min(id_col).alias("id"))
    bands = F.array(*[F.concat(F.lit(f"{i}:"), F.substring("print", i * digits + 1, digits)) for i in range(BANDS)])
    held = classes.withColumn("band", F.explode(bands))
    other = held.select("band", F.col("id").alias("b"), F.col("print").alias("print_b"))
    pairs = held.join(other, "band").where("id < b").select(F.col("id").alias("a"), "b", "print", "print_b").distinct()
    agree = F.aggregate(
        F.sequence(F.lit(1), F.lit(SAMPLES)), F.lit(0),
        lambda n, i: n + F.when(F.substr("print", i, F.lit(1)) == F.substr("print_b", i, F.lit(1)), 1).otherwise(0),
    )
    return pairs.select("a", "b", (agree / SAMPLES).alias("likeness")).where(F.col("likeness") >= least)
