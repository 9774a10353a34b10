"""Language ID: known words by their log frequency in each language, unseen words by their characters.

Of an unseen word each character is scored by the longest known run of characters that ends there, from
six characters down to one. Words and runs are learned from labelled rows, about ``max_rows`` of them
at most (all rows of small languages, a share of large ones), and kept if seen ``MIN_COUNT`` times. A text's prediction is the language with the largest sum, its
score that language's share after normalising.

Defined results: a null text, and one without a letter, is ``und`` with score 0. Equal sums go to the
first language by name. Without a labelled row every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.learn import MAX_TRAIN_ROWS, add_up, keyed_sums, sample_by_label, table_of
from starloom.llm.text import Words, lookup, slices, strings, words

MIN_COUNT = 3
LONGEST = 6
SMOOTHING = 0.5
UNDETERMINED = "und"

# words of ASCII letters in lower case and of all other characters
_in_word = np.zeros(256, bool)
_in_word[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def tokens(part: pa.Array) -> Words:
    return words(part, fold=True, in_word=_in_word)


@dataclass
class Letters:
    """Characters of some words: word ``i`` has those from ``first[i]`` to before ``last[i]``, at these places in the data."""

    at: np.ndarray
    first: np.ndarray
    last: np.ndarray


def letters(w: Words, start: np.ndarray, end: np.ndarray) -> Letters:
    at = w.characters()
    return Letters(at, np.searchsorted(at, start), np.searchsorted(at, end))


def _runs(w: Words, of: Letters, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All runs of ``n`` characters in the given words: the word's number, the character it ends before in the word, its hash."""
    counts = np.maximum(of.last - of.first - n + 1, 0)
    word = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(word)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = of.first[word] + place
    return word, place + n, w.spans(of.at[begin], of.at[begin + n])


@dataclass
class LanguageModel:
    languages: list[str]
    words: np.ndarray
    word_logs: np.ndarray
    runs: list[tuple[np.ndarray, np.ndarray]]  # by length, from 1: keys and log frequencies
    floor: np.ndarray

    def unseen(self, w: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log frequencies of words that were not learned: means over their characters' longest known runs."""
        of = letters(w, start, end)
        sizes = of.last - of.first
        bounds = np.r_[0, np.cumsum(sizes)]
        logs = np.repeat(self.floor[None, :], bounds[-1], axis=0)
        for n, (keys, known_logs) in enumerate(self.runs, 1):  # longer runs replace shorter ones
            word, place, hashes = _runs(w, of, n)
            at, known = lookup(keys, hashes)
            logs[bounds[word[known]] + place[known] - 1] = known_logs[at[known]]
        total = np.add.reduceat(logs, bounds[:-1], axis=0) if len(sizes) else np.zeros((0, len(self.languages)))
        return total / sizes[:, None]

    def scores(self, w: Words) -> np.ndarray:
        """Sum of the log frequencies, a row per text and a column per language."""
        hashes = w.hashes()
        at, known = lookup(self.words, hashes)
        logs = np.zeros((len(hashes), len(self.languages)))
        logs[known] = self.word_logs[at[known]]
        rest = np.flatnonzero(~known)
        if len(rest):  # each different unseen word once
            _, first, inverse = np.unique(hashes[rest], return_index=True, return_inverse=True)
            chosen = rest[first]
            logs[rest] = self.unseen(w, w.start[chosen], w.end[chosen])[inverse]
        running = np.zeros((len(logs) + 1, logs.shape[1]))
        np.cumsum(logs, axis=0, out=running[1:])
        return running[w.first[1:]] - running[w.first[:-1]]


def _salted(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys of words (``n`` = 0) and of runs of ``n`` characters do not meet."""
    return keys ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))


def _counter(languages: list[str]):
    """Counts by language of words, and of runs of characters in the different words; the last column tells the length of run."""
    width = len(languages)

    def count(batch):
        number = pc.index_in(batch["label"], pa.array(languages)).to_numpy(zero_copy_only=False)
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros((0, width + 1), np.int64)]

        def add(key, language, weight, n):
            matrix = np.zeros((len(key), width + 1), np.int64)
            matrix[np.arange(len(key)), language] = weight
            distinct, sums = add_up(key, matrix)
            sums[:, width] = n
            keys.append(distinct)
            counts.append(sums)

        for row, part in slices(batch["text"]):
            w = tokens(part)
            language = number[row : row + len(part)][w.text_of]
            hashes = w.hashes()
            salted = hashes + language.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            _, first, weight = np.unique(salted, return_index=True, return_counts=True)
            add(hashes[first], language[first], weight, 0)
            different = letters(w, w.start[first], w.end[first])
            for n in range(1, LONGEST + 1):
                word, _, key = _runs(w, different, n)
                of = language[first][word]
                together = key + of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                _, one, times = np.unique(together, return_index=True, return_counts=True)
                add(_salted(key[one], n), of[one], times, n)
        return add_up_lengths(np.concatenate(keys), np.concatenate(counts))

    return count


def add_up_lengths(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like :func:`add_up`; the last column is the same in all rows of a key and stays."""
    _, first = np.unique(keys, return_index=True)
    distinct, sums = add_up(keys, counts)
    if len(sums):
        sums[:, -1] = counts[first, -1]
    return distinct, sums


def fit(labelled: DataFrame, *, id_col="doc_id", text_col="text", label_col="lang", max_rows=MAX_TRAIN_ROWS):
    """A :class:`LanguageModel` from rows with a language, at most about ``max_rows`` of them."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(label_col).alias("label"))
    rows, languages = sample_by_label(rows, "id", "label", max_rows)
    width = len(languages)
    if not width:
        return LanguageModel([], np.zeros(0, np.uint64), np.zeros((0, 0)), [], np.zeros(0))
    common = " + ".join(f"n{i}" for i in range(width)) + f" >= {MIN_COUNT}"
    keys, counts = table_of(keyed_sums(rows, _counter(languages), width + 1, {width: F.max}).where(common), width + 1)
    tables = []
    for n in range(LONGEST + 1):
        own = counts[:, width] == n
        found = _salted(keys[own], n)
        order = np.argsort(found)
        tables.append((found[order], counts[own][order, :width]))

    # one scale for all tables: what a word or run adds is its share within its language, smoothed alike
    def logs(counts):
        return np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * (len(counts) + 1)))

    word_logs = logs(tables[0][1])
    floor = np.full(width, logs(tables[1][1]).min() if len(tables[1][1]) else 0.0)
    return LanguageModel(languages, tables[0][0], word_logs, [(k, logs(c)) for k, c in tables[1:]], floor)


def identify(docs: DataFrame, model: LanguageModel, *, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: predicted language and score."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, lang_pred string, score double"
    return docs.select(id_col, text_col).mapInArrow(predictor(docs, model, text_col, [id_col]), schema)


def predictor(docs: DataFrame, model: LanguageModel, text_col: str, carried: list[str], found=("lang_pred", "score")):
    """For ``mapInArrow``: the carried columns of each row, its predicted language and score, under the ``found`` names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def each(batches):
        model = shared.value
        names = pa.array([*model.languages, UNDETERMINED])
        for batch in batches:
            columns = [strings(batch[c]) for c in carried]
            lettered = pc.fill_null(pc.match_substring_regex(batch[text_col], r"\p{L}"), False)
            lettered = strings(lettered).to_numpy(zero_copy_only=False)
            for row, part in slices(batch[text_col]):
                n = len(part)
                if model.languages:
                    sums = model.scores(tokens(part))
                    best = sums.argmax(axis=1)
                    share = 1 / np.exp(np.maximum(sums - sums.max(axis=1, keepdims=True), -700)).sum(axis=1)
                    best = np.where(lettered[row : row + n], best, len(model.languages))
                    share = np.where(lettered[row : row + n], share, 0.0)
                else:
                    best, share = np.zeros(n, np.int64), np.zeros(n)
                parts = [c.slice(row, n) for c in columns]
                yield pa.RecordBatch.from_arrays([*parts, names.take(pa.array(best)), pa.array(share)], [*carried, *found])

    return each


def determined(docs: DataFrame, model: LanguageModel, *, text_col="text", least=0.0) -> DataFrame:
    """The documents, with all their columns, whose language is one of the model's with at least this score.

    A model without languages tells nothing: then every text with a letter stays.
    """
    if not model.languages:
        return docs.where(F.col(text_col).rlike(r"\p{L}"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    names = ("_lang_pred", "_lang_score")
    found = docs.mapInArrow(
        predictor(docs, model, text_col, docs.columns, names), f"{fields}, {names[0]} string, {names[1]} double"
    )
    return found.where((F.col(names[0]) != UNDETERMINED) & (F.col(names[1]) >= least)).drop(*names)
