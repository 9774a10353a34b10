"""Collocations: phrases that are frequent against the counts of their two parts.

Only the longest windows are counted: each place of a text gives the word there and the words after it
in its piece, padded to ``MAX_WORDS``. A ROLLUP over the window's columns adds these counts up over ever
shorter prefixes, which gives the count of every shorter phrase, of every word, and all words of a language.

A phrase that is wanted has ``min_count`` places, so any two neighbouring words in it do, and any three. Passes
before count such runs by a hash, those of three words only where both pairs are frequent; the frequent ones set bits
in a bitmap of fixed size. A window ends where a run's bit is not set: nothing wanted loses a place, as runs that share a
bit only let windows be longer than needed. The bitmaps do not grow with the corpus. Windows are counted by the words
themselves, not by hashes.

Defined results: a null or empty text has no word; a null language is ``und``, together with rows that
say ``und``. Repeated rows count as often as they stand there. Ties in rank go to the larger count, then to the
smaller phrase in byte order. Without a phrase of ``min_count`` places there are no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.learn import add_up
from starloom.llm.text import Words, mix, slices, windows, words

MAX_WORDS = 4
MIN_COUNT = 30
COVERED = 80  # per cent of its places that a phrase has inside a longer one
TOP = 2000
NO_LANGUAGE = "und"
KEY_BITS = 40  # of a run's hash: short keys make small shuffles
BITS = 27  # the bitmap has 2 ** BITS bits, 16 MB
HELD_ROWS = 1 << 18  # a task hands on its counts when it holds so many

_ends_piece = np.zeros(256, bool)
_ends_piece[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_in_word = ~_ends_piece
_in_word[[0x20, 0x09]] = False


def _joined(w: Words) -> np.ndarray:
    """For every word but the last: whether the next one stands in the same piece of the same text."""
    ends = np.zeros(len(w.data) + 1, np.int64)
    np.cumsum(_ends_piece[w.data], out=ends[1:])
    text_of = w.text_of
    return (ends[w.start[1:]] == ends[w.end[:-1]]) & (text_of[1:] == text_of[:-1])


def _label_hash(label: str) -> int:
    return int.from_bytes(hashlib.blake2b(label.encode(), digest_size=8).digest(), "big")


def _runs(w: Words, seeds: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words and its language, by the place where it begins."""
    runs = windows(w.hashes(), k)
    return mix(runs + seeds[w.text_of][: len(runs)]) >> np.uint64(64 - KEY_BITS)


def _frequent(w: Words, seeds: np.ndarray, bitmaps: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For runs of two words and on, by where they begin: whether their bit is set, and whether one word more may do."""
    masks, may = [], _joined(w)
    for k, bits in enumerate(bitmaps, start=2):
        place = _runs(w, seeds, k) >> np.uint64(KEY_BITS - BITS)
        masks.append(may & ((bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool))
        may = masks[-1][:-1] & masks[-1][1:]
    return masks, may


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[Words, list[str]]]:
    for row, part in slices(batch["text"]):
        yield words(part, fold=True, in_word=_in_word), batch["lang"].slice(row, len(part)).to_pylist()


def _seeds(labels: list[str]) -> np.ndarray:
    known = {label: _label_hash(label) for label in set(labels)}
    return np.array([known[label] for label in labels], np.uint64)


def _count_runs(batches: Iterator[pa.RecordBatch], bitmaps: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of the runs that are one word longer than those of the last bitmap."""

    def out(keys, n):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    keys, n, rows = [], [], 0
    for batch in batches:
        for w, labels in _texts(batch):
            seeds = _seeds(labels)
            _, may = _frequent(w, seeds, bitmaps)
            found, counts = np.unique(_runs(w, seeds, len(bitmaps) + 2)[may], return_counts=True)
            keys.append(found)
            n.append(counts.astype(np.int64))
            rows += len(found)
            if rows > 4 * HELD_ROWS:
                found, counts = add_up(np.concatenate(keys), np.concatenate(n))
                keys, n, rows = [found], [counts], len(found)
                if rows > 2 * HELD_ROWS:
                    yield out(found, counts)
                    keys, n, rows = [], [], 0
    if keys:
        yield out(*add_up(np.concatenate(keys), np.concatenate(n)))


def _bitmap(runs: DataFrame, min_count: int) -> np.ndarray:
    """Bits of the frequent runs, 64 in a number: at most ``2 ** (BITS - 6)`` rows reach the driver."""
    frequent = runs.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    place = frequent.select(F.expr(f"shiftrightunsigned(key, {KEY_BITS - BITS})").alias("at"))
    grouped = place.groupBy(F.expr("shiftrightunsigned(at, 6)").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")
    )
    found = grouped.toArrow()
    bitmap = np.zeros(1 << (BITS - 6), np.uint64)
    bitmap[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bitmap


def _distinct(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of columns of numbers below 2^31, and the sums of ``n`` over them."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        _, key = np.unique((key << 31) | c, return_inverse=True)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    sums = np.zeros(len(first), np.int64)
    np.add.at(sums, inverse, n)
    return [c[first] for c in columns], sums


class _Windows:
    """Counts of windows in one task: numbers of their words, by length."""

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.words: dict[bytes, int] = {}
        self.labels: dict[str, int] = {}
        self.held: list[list] = [[] for _ in range(self.width)]
        self.rows = 0

    def add(self, w: Words, labels: list[str], reach: list[np.ndarray]) -> None:
        """``reach`` tells by the place of its first word whether a window has a second one, a third one and so on."""
        if not len(w.start):
            return
        letters = w.data[_in_word[w.data]]
        offsets = np.zeros(len(w.start) + 1, np.int64)
        np.cumsum(w.end - w.start, out=offsets[1:])
        found = pa.Array.from_buffers(pa.large_binary(), len(w.start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        numbers = np.array([self.words.setdefault(x, len(self.words)) for x in found.dictionary.to_pylist()], np.int64)
        word = numbers[found.indices.to_numpy()]
        label = np.array([self.labels.setdefault(x, len(self.labels)) for x in labels], np.int64)[w.text_of]
        length = np.ones(len(word), np.int64)
        for more in reach:
            length[: len(more)] += more
        for k in range(1, self.width + 1):
            at = np.flatnonzero(length == k)
            if len(at):
                columns, n = _distinct([label[at], *(word[at + j] for j in range(k))], np.ones(len(at), np.int64))
                self.held[k - 1].append((columns, n))
                self.rows += len(n)

    def merge(self) -> None:
        for k, held in enumerate(self.held):
            if len(held) > 1:
                columns = [np.concatenate(c) for c in zip(*[h[0] for h in held], strict=True)]
                self.held[k] = [_distinct(columns, np.concatenate([h[1] for h in held]))]
        self.rows = sum(len(h[1]) for held in self.held for h in held)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        names = ["lang", *(f"w{k}" for k in range(1, self.width + 1)), "n"]
        # the last word stands for a place after the end of the window
        vocabulary = pa.array([*self.words, b""], pa.binary()).cast(pa.string())
        labels = pa.array(list(self.labels), pa.string())
        for held in self.held:
            for columns, n in held:
                for row in range(0, len(n), 100_000):
                    part = slice(row, row + 100_000)
                    pad = np.full(len(n[part]), len(self.words), np.int64)
                    places = [c[part] for c in columns[1:]] + [pad] * (self.width + 1 - len(columns))
                    arrays = [labels.take(pa.array(columns[0][part])), *(vocabulary.take(pa.array(p)) for p in places)]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(n[part])], names)
        self.clear()


def padded_windows(texts: DataFrame, min_count: int, width: int = MAX_WORDS) -> DataFrame:
    """Partial counts of the windows of (``lang``, ``text``) rows: ``lang``, ``w1`` and on (the empty text pads), ``n``."""
    context = texts.sparkSession.sparkContext
    bitmaps = []
    for _ in range(2, width):
        known = context.broadcast(list(bitmaps))
        runs = texts.mapInArrow(lambda batches, known=known: _count_runs(batches, known.value), "key long, n long")
        bitmaps.append(_bitmap(runs, min_count))
    shared = context.broadcast(bitmaps)

    def each(batches):
        held = _Windows(width)
        for batch in batches:
            for w, labels in _texts(batch):
                masks, may = _frequent(w, _seeds(labels), shared.value)
                held.add(w, labels, [*masks, may])
                if held.rows > 2 * HELD_ROWS:
                    held.merge()
                if held.rows > HELD_ROWS or len(held.words) > HELD_ROWS:
                    yield from held.batches()
        yield from held.batches()

    schema = ", ".join(["lang string", *(f"w{k} string" for k in range(1, width + 1)), "n long"])
    return texts.mapInArrow(each, schema)


def phrase_counts(docs: DataFrame, *, lang_col="lang", text_col="text", min_count=MIN_COUNT, width=MAX_WORDS) -> DataFrame:
    """``lang``, ``phrase`` (words joined by a space), ``size`` (words) and ``n`` of all phrases with at least
    ``min_count`` places; ``size`` 0 has all words of the language.
    """
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_col).alias("text")
    )
    columns = [f"w{k}" for k in range(1, width + 1)]
    size = F.lit(width) - F.bit_count(F.grouping_id())
    summed = padded_windows(texts, min_count, width).rollup("lang", *columns).agg(F.sum("n").alias("n"), size.alias("size"))
    last = F.get(F.array(F.lit("-"), *columns), F.col("size"))
    # a condition on keys alone, which Catalyst applies before rows are added up: what ends in padding is no phrase
    real = summed.where(F.col("lang").isNotNull() & ((F.col("size") == 0) | (last != "")))
    return real.where((F.col("size") == 0) | (F.col("n") >= min_count)).select("lang", F.concat_ws(" ", *columns).alias("phrase"), "size", "n")


def collocations(
    docs: DataFrame,
    *,
    lang_col="lang",
    text_col="text",
    min_count: int = MIN_COUNT,
    covered: int = COVERED,
    top: int = TOP,
    width: int = MAX_WORDS,
) -> DataFrame:
    """The first ``top`` phrases of every language, with the cut that explains them best (``l``, ``r``)."""
    counts = stored(phrase_counts(docs, lang_col=lang_col, text_col=text_col, min_count=min_count, width=width), "phrases")
    known = counts.where("size >= 1")
    phrases = known.where("size >= 2").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"), "size")

    cuts = phrases.select("lang", "phrase", "a", "words", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("array_join(slice(words, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(words, k + 1, size - k), ' ')").alias("right"),
    )
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # 38 digits hold the product, which may pass 64 bits
    score = F.expr("(cast(a as decimal(25, 0)) * 2000000) div cast(l + r as decimal(25, 0))")
    best = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )

    spans = "transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' ')))"
    inner = phrases.where("size >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.flatten(F.expr(spans))).alias("phrase"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = F.expr(f"longer is null or cast(longer as decimal(25, 0)) * 100 < cast(a as decimal(25, 0)) * {covered}")
    kept = best.join(inner, ["lang", "phrase"], "left").where(alone)

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", F.col("n").alias("n"))
    return first.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").alias("score")
    )
