"""Toxicity by two Kneser-Ney word models, one for toxic and one for ordinary texts.

Both interpolate discounted bigrams with discounted words, these with discounted word beginnings, and
these with one shared distribution: in how many different contexts, of either class, a word was seen.
All counts are kept, also those of an expression of one text: the discounts leave most of its weight to the
backoff, so that it says a little. A word whose beginning neither class knows says nothing. An expression counts once in a text, so that one repetitive text doesn't make it common. The
log-likelihood ratio is normalised by length, over the whole text and over its most suspicious runs of
some lengths; a logistic calibration on labelled rows that were not counted turns these into a score.

Defined results: null and empty texts have no token and get the score of a ratio of 0. Repeated rows are scored
alike. Without labels of both kinds every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.learn import (
    MAX_TRAIN_ROWS,
    add_up,
    bounded_sample,
    fit_logistic,
    keyed_sums,
    sigmoid,
    table_of,
)
from starloom.llm.text import Words, lookup, release, slices, strings, sums_by_text, whole_windows, windows, words

DISCOUNT = 0.75
LEAST_TAKEN = (0.0, 0.99, 1.8, 2.4)  # of an expression of no, one, two, more texts: the backoff has at least so much of it
RUNS = (1, 3, 8, 24)  # words in a suspicious run
STEM_BYTES = 6  # the beginning of a word
FOLDS = 5
THRESHOLD = 0.3

# words of letters and digits in lower case: punctuation doesn't hide an expression
_in_word = np.zeros(256, bool)
_in_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def tokens(part: pa.Array) -> Words:
    return words(part, fold=True, in_word=_in_word)


def _bigrams(w: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the second words of all bigrams, and the bigrams' hashes."""
    at = np.flatnonzero(whole_windows(w.first, 2))
    return at + 1, windows(hashes, 2)[at]


def _stems(w: Words) -> np.ndarray:
    return w.spans(w.start, np.minimum(w.end, w.start + STEM_BYTES)) ^ np.uint64(1)


@dataclass
class ToxicityModel:
    words: np.ndarray  # sorted hashes of words and of beginnings of words
    probabilities: np.ndarray  # by class, toxic and ordinary
    ratios: np.ndarray  # logs of toxic over ordinary probability
    bigrams: np.ndarray
    after: np.ndarray  # such ratios of a bigram's second word after the first
    calibration: np.ndarray
    sent: object = None  # the broadcast of these tables, which scoring uses again

    def features(self, w: Words) -> np.ndarray:
        """Length-normalised log-likelihood ratios of each text and of the largest of its runs, by length of run."""
        hashes = w.hashes()
        token = np.zeros(len(hashes))
        if len(self.words) and len(hashes):
            at, known = lookup(self.words, hashes)
            token[known] = self.ratios[at[known]]
            rest = np.flatnonzero(~known)
            stem, stemmed = lookup(self.words, _stems(w)[rest])
            token[rest[stemmed]] = self.ratios[stem[stemmed]]
            second, pairs = _bigrams(w, hashes)
            pair, paired = lookup(self.bigrams, pairs)
            second, pair = second[paired], pair[paired]
            token[second] = self.after[pair]
        columns = [sums_by_text(token, w.first) / np.maximum(w.counts, 1)]
        running = np.r_[0.0, np.cumsum(token)]
        some = np.flatnonzero(w.counts)
        for n in RUNS:
            stop = np.minimum(np.arange(len(token)) + n, np.repeat(w.first[1:], w.counts))
            runs = (running[stop] - running[:-1]) / n
            largest = np.zeros(len(w.counts))
            if len(some):
                largest[some] = np.maximum(np.maximum.reduceat(runs, w.first[some]), 0)
            columns.append(largest)
        return np.column_stack(columns)

    def scores(self, w: Words, calibration: np.ndarray) -> np.ndarray:
        return sigmoid(self.features(w) @ calibration[:-1] + calibration[-1])

    def __getstate__(self):
        return {**self.__dict__, "sent": None, "probabilities": None}  # scoring needs the ratios alone


def _once(keys: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Places of the first sight of every key in its text."""
    return np.unique(keys + text_of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]


def _word_counts(batch):
    """In how many texts of either class a word or beginning stands; the third count tells beginnings."""
    keys, counts = [], []
    label = batch["label"].to_numpy(zero_copy_only=False).astype(np.int64)
    for row, part in slices(batch["text"]):
        w = tokens(part)
        for stem, found in enumerate((w.hashes(), _stems(w))):
            first = _once(found, w.text_of)
            toxic = label[row : row + len(part)][w.text_of[first]]
            keys.append(found[first])
            counts.append(np.column_stack([toxic, 1 - toxic, np.full(len(first), stem)]))
    return add_up(np.concatenate(keys), np.concatenate(counts)) if keys else _none(3)


def discounts(counts: np.ndarray) -> np.ndarray:
    """What the backoff takes of each count: more, where more expressions of that count are not seen once more.

    From the numbers of expressions seen once, twice, three and four times (``DISCOUNT`` where one is missing), and never
    less than ``LEAST_TAKEN``: the largest ratio of a long text's runs is easily that of a word which happens to be rare.
    """
    seen = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].astype(float)
    taken = np.full(4, DISCOUNT)
    if seen.all():
        share = seen[0] / (seen[0] + 2 * seen[1])
        taken[1:] = [k - (k + 1) * share * seen[k] / seen[k - 1] for k in (1, 2, 3)]
        taken = np.minimum(taken, [0, 0.999, 1.999, 2.999])
    taken = np.maximum(taken, LEAST_TAKEN)
    taken[0] = 0
    return taken[np.minimum(counts, 3).astype(np.uint8)]


def _none(width):
    return np.zeros(0, np.uint64), np.zeros((0, width), np.int64)


def fit(labelled: DataFrame, *, id_col="doc_id", text_col="text", label_col="toxic", max_rows=MAX_TRAIN_ROWS):
    """A :class:`ToxicityModel` from rows with a 0/1 label, at most about ``max_rows`` of them."""
    context = labelled.sparkSession.sparkContext
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = bounded_sample(rows.select(id_col, text_col, label_col), id_col, max_rows).select(
        F.col(text_col).alias("text"),
        F.col(label_col).cast("int").alias("label"),
        (F.pmod(F.xxhash64(F.lit("fold"), text_col), F.lit(FOLDS)) == 0).alias("fold"),
    )
    # copies of one text are no evidence that its words are typical
    rows = rows.groupBy(F.xxhash64("text"), "label").agg(F.first("text").alias("text"), F.first("fold").alias("fold"))
    rows = stored(rows.select("text", "label", "fold"), "labelled-sample")
    counted = rows.where("not fold").select("text", "label")
    keys, c = table_of(keyed_sums(counted, _word_counts, 3), 3)
    is_stem, c = c[:, 2] > 0, c[:, :2].copy()
    release()
    if not len(keys) or not c.sum(axis=0).all():
        none, pairs = np.zeros(0, np.uint64), np.zeros((0, 2))
        return ToxicityModel(none, pairs, np.zeros(0), none, np.zeros(0), np.r_[np.zeros(len(RUNS) + 1), -1000.0])
    known = context.broadcast(keys)

    def bigram_counts(batch):
        """Keys are the bigrams; texts by class, and the numbers of both words."""
        keys, counts = [], []
        label = batch["label"].to_numpy(zero_copy_only=False).astype(np.int64)
        for row, part in slices(batch["text"]):
            w = tokens(part)
            hashes, text_of = w.hashes(), w.text_of
            second, pairs = _bigrams(w, hashes)
            at, there = lookup(known.value, hashes)
            both = there[second] & there[second - 1]
            second, pairs = second[both], pairs[both]
            first = _once(pairs, text_of[second])
            second, pairs = second[first], pairs[first]
            toxic = label[row : row + len(part)][text_of[second]]
            keys.append(pairs)
            counts.append(np.column_stack([toxic, 1 - toxic, at[second - 1], at[second]]))
        if not keys:
            return _none(4)
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        if not len(keys):
            return _none(4)
        _, first = np.unique(keys, return_index=True)
        distinct, sums = add_up(keys, counts[:, :2])
        return distinct, np.column_stack([sums, counts[first, 2:]])

    # the words' numbers are the same in all rows of a key: their maximum is the number
    pairs = stored(keyed_sums(counted, bigram_counts, 4, reduce={2: F.max, 3: F.max}), "bigrams")
    # the bigrams of the bounded sample, in short numbers, to the driver once
    found = pairs.select("key", *[F.col(f"n{i}").cast("int").alias(f"n{i}") for i in range(4)]).toArrow()
    bigrams, (toxic, ordinary, first, second) = found["key"].to_numpy().view(np.uint64), (found[f"n{i}"].to_numpy() for i in range(4))
    del found
    release()
    # in how many contexts, of either class, a word was seen
    shared = 0.5 + np.bincount(second, minlength=len(keys))
    shared[is_stem] = (c[is_stem] > 0).sum(axis=1)
    p = np.zeros(c.shape)
    for kind in (is_stem, ~is_stem):
        total = np.maximum(c[kind].sum(axis=0), 1)
        taken = np.column_stack([discounts(c[kind, k]) for k in range(2)])
        p[kind] = (c[kind] - taken) / total + taken.sum(axis=0) / total * (shared[kind] / shared[kind].sum())[:, None]
    # after each word: how many bigrams of a class were counted, and the weight of the backoff
    followed, contexts = np.ones(c.shape), np.ones(c.shape)
    taken = [discounts(n).astype(np.float32) for n in (toxic, ordinary)]
    for k, n in enumerate((toxic, ordinary)):
        counted_after = np.bincount(first, n, len(keys))
        followed[:, k] = np.maximum(counted_after, 1)
        contexts[:, k] = np.where(counted_after > 0, np.bincount(first, taken[k], len(keys)) / followed[:, k], 1.0)
    after_all, kinds = np.bincount(first, toxic, len(keys)) + np.bincount(first, ordinary, len(keys)), np.bincount(first, minlength=len(keys))
    words_shared = shared / shared[~is_stem].sum()
    after = np.empty(len(bigrams), np.float16)
    for row in range(0, len(bigrams), 1 << 18):
        part = slice(row, row + (1 << 18))
        a, b = first[part], second[part]
        # how much likelier the second word is after the first in both classes together
        together = np.maximum(toxic[part] + ordinary[part] - DISCOUNT, 0) / after_all[a]
        lift = (together + DISCOUNT * kinds[a] / after_all[a] * words_shared[b]) / words_shared[b]
        logs = [
            np.log((n[part] - taken[k][part]) / followed[a, k] + contexts[a, k] * p[b, k] * lift) for k, n in enumerate((toxic, ordinary))
        ]
        after[part] = logs[0] - logs[1]
    order = np.argsort(bigrams)
    bigrams, after = bigrams[order], after[order]
    del order, toxic, ordinary, first, second, taken
    ratios = np.log(p[:, 0]) - np.log(p[:, 1])
    model = ToxicityModel(keys, p.astype(np.float32), ratios.astype(np.float32), bigrams, after, np.zeros(len(RUNS) + 2))
    known.unpersist()
    del p, c, shared, followed, contexts, words_shared, after_all, kinds
    model.sent = plain = context.broadcast(model)
    release()  # the driver needs its memory for the next fit

    names = [f"f{i}" for i in range(len(RUNS) + 1)]

    def fold_features(batches):
        for batch in batches:
            for row, part in slices(batch["text"]):
                found = plain.value.features(tokens(part))
                label = batch["label"].slice(row, len(part)).cast(pa.float64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in found.T), label], [*names, "y"])

    schema = ", ".join(f"{c} double" for c in [*names, "y"])
    fold = rows.where("fold").select("text", "label").mapInArrow(fold_features, schema).toPandas()
    model.calibration = fit_logistic(fold[names].to_numpy(), fold.y.to_numpy())
    return model


def score(docs: DataFrame, model: ToxicityModel, *, id_col="doc_id", text_col="text", threshold=THRESHOLD):
    """One row per document: its score from 0 to 1 and whether it reaches the threshold."""
    shared, calibration = model.sent or docs.sparkSession.sparkContext.broadcast(model), model.calibration

    def each(batches):
        for batch in batches:
            ids = strings(batch[id_col])
            for row, part in slices(batch[text_col]):
                found = shared.value.scores(tokens(part), calibration)
                predicted = pa.array((found >= threshold).astype(np.int32))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(part)), pa.array(found), predicted], [id_col, "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(each, f"`{id_col}` {kind}, score double, predicted int")
