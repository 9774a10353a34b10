"""Quality rules: exact text counts, and a calibrated logistic regression over hashed n-grams.

The regression sees hashed word unigrams and bigrams and hashed groups of four characters, each kind as
shares of the text. It is trained on labelled rows by stochastic gradient steps in a few tasks whose
weights are averaged after every pass; a fold of the labelled rows that no step saw calibrates the
score into a probability. Whole texts are scored in Arrow batches against a fixed threshold.

Defined results: a null or empty text has all counts 0 and fails the base rules. Repeated rows are
scored alike. Without labels of both kinds the model says 0.5 for all texts. Columns other than the
id, the text and the label are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.learn import MAX_TRAIN_ROWS, bounded_sample, fit_logistic, sigmoid
from starloom.llm.text import IN_WORD, Words, slices, strings, sums_by_text, whole_windows, windows, words

BITS = 16  # each kind of n-gram is hashed to 2^16 weights
KINDS = 3
CHARACTERS = 4
PASSES = 4
TASKS = 6
SUMS = 4
STEP_BYTES = 256 << 10  # text of one gradient step
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MIN_QUALITY = 0.3  # calibrated probability from which a text is kept
FOLDS = 5  # one of so many is kept for calibration

_symbol = np.zeros(256, bool)
_symbol[list(b"#*$%&|<>")] = True


def repeats(keys: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Which keys stand twice or more in their text."""
    salted = keys + text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(salted)
    same = salted[order][1:] == salted[order][:-1]
    found = np.zeros(len(keys), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def text_counts(w: Words) -> dict[str, np.ndarray]:
    """Exact counts for each text."""
    inside = IN_WORD[w.data]
    code_point = (w.data & 0xC0) != 0x80
    hashes, text_of = w.hashes(), w.text_of
    ok = whole_windows(w.first, 3)
    at = np.flatnonzero(ok)
    covered = np.zeros(len(hashes), bool)
    hit = at[repeats(windows(hashes, 3)[at], text_of[at])]
    for j in range(3):
        covered[hit + j] = True
    breaks = np.flatnonzero(w.data == 0x0A)
    begin = np.union1d(w.bounds[:-1], breaks + 1)
    begin = begin[begin < len(w.data)]
    end = np.r_[begin[1:], len(w.data)]
    end = np.minimum(end, np.r_[breaks, len(w.data)][np.searchsorted(breaks, begin)])
    with_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, begin)
    begin, end = begin[with_word], end[with_word]
    line_text = np.searchsorted(w.bounds, begin, "right") - 1
    lines = w.spans(begin, end) + line_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, first = np.unique(lines, return_index=True)
    n = len(w.bounds) - 1
    return {
        "n_words": w.counts,
        "word_chars": sums_by_text(inside & code_point, w.bounds),
        "n_symbols": sums_by_text(_symbol[w.data], w.bounds),
        "n_dup_lines": np.bincount(line_text, minlength=n) - np.bincount(line_text[first], minlength=n),
        "n_repeat_words": sums_by_text(covered, w.first),
    }


def grams(w: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: slots of all n-grams in a row, and the bounds of each text's."""
    shift = np.uint64(64 - BITS)
    hashes = w.hashes()
    ok = whole_windows(w.first, 2)
    pairs = windows(hashes, 2)[ok] if len(ok) else np.zeros(0, np.uint64)
    pair_bounds = np.r_[0, np.cumsum(np.maximum(w.counts - 1, 0))]
    characters = w.characters()
    text_begin = np.searchsorted(characters, w.bounds)
    begin = np.flatnonzero(whole_windows(text_begin, CHARACTERS))
    group = w.spans(characters[begin], characters[begin + CHARACTERS])
    group_bounds = np.r_[0, np.cumsum(np.maximum(np.diff(text_begin) - CHARACTERS + 1, 0))]
    return [
        ((hashes >> shift).astype(np.int64), w.first),
        ((pairs >> shift).astype(np.int64), pair_bounds),
        ((group >> shift).astype(np.int64), group_bounds),
    ]


def raw_scores(features: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray, bias: float) -> np.ndarray:
    total = np.full(len(features[0][1]) - 1, bias)
    for (slots, bounds), weight in zip(features, weights, strict=True):
        total += sums_by_text(weight[slots], bounds) / np.maximum(np.diff(bounds), 1)
    return total


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    calibration: np.ndarray  # slope and intercept

    def probabilities(self, w: Words) -> np.ndarray:
        z = raw_scores(grams(w), self.weights, self.bias)
        return sigmoid(z * self.calibration[0] + self.calibration[1])


def _learn(batches: Iterator[pa.RecordBatch], weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """One pass of adaptive gradient steps over the batches."""
    weights, seen = weights.copy(), np.full(weights.shape, 1e-8)
    bias_seen = 1e-8
    for batch in batches:
        labels = batch["label"].to_numpy(zero_copy_only=False)
        for row, part in slices(batch["text"], STEP_BYTES):
            features = grams(words(part, fold=True))
            y = labels[row : row + len(part)]
            error = sigmoid(raw_scores(features, weights, bias)) - y
            for k, (slots, bounds) in enumerate(features):
                sizes = np.diff(bounds)
                share = np.repeat(error / np.maximum(sizes, 1), sizes)
                gradient = np.bincount(slots, share, minlength=1 << BITS) / len(y)
                seen[k] += gradient**2
                weights[k] -= 2.0 * gradient / np.sqrt(seen[k])
            slope = error.mean()
            bias_seen += slope**2
            bias -= 0.3 * slope / np.sqrt(bias_seen)
    return weights, bias


def _weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the changes of weights and of the intercepts of some training tasks, times the rows of each."""
    weights, bias, rows = None, 0.0, 0
    for batch in batches:
        for i in range(batch.num_rows):
            n = batch["n"][i].as_py()
            change = np.frombuffer(zlib.decompress(batch["weights"][i].as_py()), np.float16)
            own = change.astype(np.float32) * np.float32(n)
            weights = own if weights is None else weights + own
            bias, rows = bias + batch["bias"][i].as_py() * n, rows + n
    if weights is not None:
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()]), pa.array([bias]), pa.array([rows])], ["weights", "bias", "n"])


def fit(labelled: DataFrame, *, id_col="doc_id", text_col="text", label_col="quality", max_rows=MAX_TRAIN_ROWS):
    """A :class:`QualityModel` from rows with a 0/1 label, at most about ``max_rows`` of them."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = bounded_sample(rows.select(id_col, text_col, label_col), id_col, max_rows).select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.col(label_col).cast("double").alias("label"),
        (F.pmod(F.xxhash64(F.lit("fold"), id_col), F.lit(FOLDS)) == 0).alias("fold"),
    )
    # one layout for all passes: the same rows in the same order in each task, whichever executor runs it
    laid_out = rows.repartition(TASKS, "id").sortWithinPartitions(F.xxhash64(F.lit("order"), "id"), F.xxhash64("text"))
    training = laid_out.where("not fold").select("text", "label")
    weights, bias = np.zeros((KINDS, 1 << BITS)), 0.0
    for _ in range(PASSES):

        def one_pass(batches, weights=weights.astype(np.float32), bias=bias):
            batches = [b for b in batches if b.num_rows]
            if batches:
                learned, b = _learn(batches, weights.astype(np.float64), bias)
                rows = sum(b.num_rows for b in batches)
                # only what changed: a task that saw few texts has little to say
                change = zlib.compress((learned - weights).astype(np.float16).tobytes(), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([change]), pa.array([float(b)]), pa.array([rows])],
                    ["weights", "bias", "n"],
                )

        schema = "weights binary, bias double, n long"
        # a few tasks add up what each training task has learned, so that the driver gets a few rows
        parts = training.mapInArrow(one_pass, schema).repartition(SUMS).mapInArrow(_weighed, schema).collect()
        if not parts:
            return QualityModel(weights.astype(np.float32), 0.0, np.zeros(2))
        total = sum(p.n for p in parts)
        weights += (sum(np.frombuffer(p.weights, np.float32).astype(float) for p in parts) / total).reshape(KINDS, -1)
        bias = sum(p.bias for p in parts) / total
    plain = QualityModel(weights.astype(np.float32), bias, np.array([1.0, 0.0]))

    def fold_scores(batches):
        for batch in batches:
            for row, part in slices(batch["text"]):
                z = raw_scores(grams(words(part, fold=True)), plain.weights, plain.bias)
                yield pa.RecordBatch.from_arrays([pa.array(z), batch["label"].slice(row, len(part))], ["z", "y"])

    fold = laid_out.where("fold").select("text", "label").mapInArrow(fold_scores, "z double, y double").toPandas()
    both = fold.y.nunique() == 2
    calibration = fit_logistic(fold[["z"]].to_numpy(), fold.y.to_numpy()) if both else np.array([1.0, 0.0])
    return QualityModel(plain.weights, plain.bias, calibration)


SCORED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, quality double, kept boolean"
)


def score(docs: DataFrame, model: QualityModel, *, id_col="doc_id", text_col="text", min_quality=MIN_QUALITY):
    """One row per document: exact counts, the base rules' verdict, the calibrated quality and the final verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        for batch in batches:
            ids = strings(batch[id_col])
            for row, part in slices(batch[text_col]):
                counts = text_counts(words(part))
                quality = shared.value.probabilities(words(part, fold=True))
                n = counts["n_words"]
                failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED_PERCENT * n)
                columns = [ids.slice(row, len(part)), *(pa.array(c.astype(np.int64)) for c in counts.values())]
                columns += [pa.array(failed), pa.array(quality), pa.array(~failed & (quality >= min_quality))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, *counts, "base_failed", "quality", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, {SCORED}")
