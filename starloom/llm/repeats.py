"""Substring dedup: passages that an earlier document holds too are cut out of later ones.

A passage is a run of words each of which lies in a window of ``width`` consecutive words that also
starts in a document with a smaller id. The work is done in shards of documents:

1. From every window the least hash of its ``SEED``-word groups is taken: windows with the same words
   have the same one. Shards announce these; those of two shards or more are candidates.
2. Shards announce their windows over candidate groups by a hash of all their words and a second,
   independent check, with the smallest id; a shard is told about those windows that stand in a
   document before all of its own. That confirms the recurring passages.
3. Every shard compiles its confirmed passages, longest runs of such windows, into an Aho-Corasick automaton over
   word numbers and streams all its documents through it, which finds every occurrence word for word.

Defined results: null and empty texts have no word and lose none. A text shorter than a window loses
nothing. Rows that repeat an id are one document: they do not take words from each other. Ids are integers; a
null id comes after all others.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.shards import SHARD, SHARD_BYTES, announce, answer, sharded
from starloom.llm.text import lookup, slices, whole_windows, windows, words

WIDTH = 13
SEED = 6


class _Shard:
    """Words of all documents of one shard, by ascending id."""

    def __init__(self, table: pa.Table, id_col: str, text_col: str, width: int):
        self.table = table.sort_by(id_col)
        self.ids = pc.fill_null(self.table[id_col].cast(pa.int64()), np.iinfo(np.int64).max).to_numpy()
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, part in slices(self.table[text_col]):
            w = words(part)
            hashes.append(w.hashes())
            counts.append(w.counts)
        self.hashes = np.concatenate(hashes)
        self.first = np.r_[0, np.cumsum(np.concatenate(counts))]
        self.at = np.flatnonzero(whole_windows(self.first, width))  # where whole windows start
        self.window_ids = np.repeat(self.ids, np.diff(self.first))[self.at]
        self.width = width

    def groups(self) -> np.ndarray:
        """For every whole window the least hash of its groups of words."""
        seed = min(SEED, self.width)
        group = windows(self.hashes, seed)
        n = len(self.hashes) - self.width + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        least = group[:n].copy()
        for j in range(1, self.width - seed + 1):
            np.minimum(least, group[j : j + n], out=least)
        return least[self.at]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """For every whole window its hash and its check."""
        key = windows(self.hashes, self.width)[self.at]
        check = windows(self.hashes, self.width, seed=1)[self.at] >> np.uint64(33)
        return key, check.astype(np.int64)


def _rows(shard: int, **columns: np.ndarray) -> pa.Table:
    arrays = {k: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for k, v in columns.items()}
    n = len(next(iter(columns.values())))
    return pa.table({SHARD: pa.array(np.full(n, shard, np.int64)), **arrays})


def _groups_of(id_col, text_col, width):
    def work(table):
        shard = _Shard(table, id_col, text_col, width)
        return _rows(table[SHARD][0].as_py(), key=np.unique(shard.groups()))

    return work


def _windows_of(id_col, text_col, width):
    def work(table, answers):
        keys = np.sort(answers["key"].to_numpy().view(np.uint64))
        if not table.num_rows or not len(keys):
            return _rows(0, key=np.zeros(0, np.uint64), check=np.zeros(0, np.int64), low=np.zeros(0, np.int64))
        shard = _Shard(table, id_col, text_col, width)
        chosen = np.flatnonzero(lookup(keys, shard.groups())[1])
        key, check = shard.windows()
        key, first = np.unique(key[chosen], return_index=True)  # ids ascend: the first has the smallest
        first = chosen[first]
        return _rows(table[SHARD][0].as_py(), key=key, check=check[first], low=shard.window_ids[first])

    return work


def _confirmed(shard: _Shard, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages that documents of this shard must give up: first and last word, and an id before which they do not count.

    A passage is a longest run of windows of one document that an earlier document holds too.
    """
    key, check = shard.windows()
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    begin = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
    place = order[begin]
    low = shard.window_ids[place]
    asked = np.argsort(answers["key"].to_numpy().view(np.uint64))
    known = answers["key"].to_numpy().view(np.uint64)[asked]
    at, there = lookup(known, ordered[begin])
    if len(known):
        there &= answers["check"].to_numpy()[asked][at] == check[place]
        low = np.where(there, np.minimum(low, answers["low"].to_numpy()[asked][at]), low)
    least = np.empty(len(key), np.int64)
    least[order] = np.repeat(low, np.diff(np.r_[begin, len(ordered)]))
    given = np.flatnonzero(least < shard.window_ids)
    if not len(given):
        return given, given, given
    start = shard.at[given]
    text = np.searchsorted(shard.first, start, "right")
    new = np.flatnonzero(np.r_[True, (np.diff(start) != 1) | (np.diff(text) != 0)])
    last = start[np.r_[new[1:], len(start)] - 1] + shard.width - 1
    return start[new], last, np.maximum.reduceat(least[given], new)


def _covered(shard: _Shard, start: np.ndarray, last: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which words of the shard the automaton finds in a confirmed passage of earlier documents."""
    covered = np.zeros(len(shard.hashes), bool)
    if not len(start):
        return covered
    numbers = np.unique(shard.hashes, return_inverse=True)[1].tolist()
    passages: dict[tuple[int, ...], int] = {}
    for a, b, least in zip(start.tolist(), last.tolist(), low.tolist(), strict=True):
        passage = tuple(numbers[a : b + 1])
        passages[passage] = min(least, passages.get(passage, least))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i, passage in enumerate(passages):
        automaton.add_word(passage, i)
    automaton.make_automaton()
    sizes = np.array([len(p) for p in passages])
    lows = np.array(list(passages.values()))
    for i, document in enumerate(shard.ids):
        begin, end = shard.first[i], shard.first[i + 1]
        if end - begin < shard.width:
            continue
        found = list(automaton.iter(tuple(numbers[begin:end])))
        if found:
            place, which = np.array(found).T
            counts = lows[which] < document
            place, size = place[counts] + 1, sizes[which[counts]]
            steps = np.zeros(end - begin + 1, np.int64)
            np.add.at(steps, place - size, 1)
            np.add.at(steps, place, -1)
            covered[begin:end] = np.cumsum(steps[:-1]) > 0
    return covered


def _cut(id_col, text_col, width, columns, size_col, normal, counts):
    def work(table, answers):
        if not table.num_rows:
            return table.select(columns).append_column(counts[0], pa.array([], pa.int64())).append_column(
                counts[1], pa.array([], pa.int64())
            )
        shard = _Shard(table, id_col, text_col, width)
        covered = _covered(shard, *_confirmed(shard, answers))
        running = np.r_[0, np.cumsum(covered)]
        removed = running[shard.first[1:]] - running[shard.first[:-1]]
        kept = shard.table[text_col].to_pylist()
        for i, text in enumerate(kept):
            if removed[i]:
                keep = ~covered[shard.first[i] : shard.first[i + 1]]
                found = text.encode().split()
                kept[i] = b" ".join([found[j] for j in np.flatnonzero(keep)]).decode()
            elif normal:
                kept[i] = b" ".join(text.encode().split()).decode() if text else ""
        out = shard.table.select(columns)
        kept = pa.array(kept, out.schema.field(text_col).type)
        out = out.set_column(columns.index(text_col), text_col, kept)
        if size_col in columns:
            length = pc.utf8_length(kept).cast(out.schema.field(size_col).type)
            out = out.set_column(columns.index(size_col), size_col, length)
        return out.append_column(counts[0], pa.array(np.diff(shard.first))).append_column(counts[1], pa.array(removed))

    return work


def remove_repeats(
    docs: DataFrame, *, id_col="doc_id", text_col="text", size_col=None, columns=None, width=WIDTH, normal=True,
    counts=("n_words", "n_removed"), shard_bytes=SHARD_BYTES,
) -> DataFrame:
    """The documents without the words of passages that a document with a smaller id holds.

    Returns ``columns`` (the id and the text if not given) with the text that is left, then
    the ``counts`` of words and of words removed. With ``normal`` the words left are joined by one space in every text, else
    only in those that lose any. ``size_col`` names a column to fill with the new length.
    """
    columns = columns or [id_col, text_col]
    shards = sharded(docs.select(*columns), id_col, text_col, shard_bytes)
    groups = announce(shards, _groups_of(id_col, text_col, width), f"{SHARD} long, key long")
    by_key = Window.partitionBy("key")
    candidates = groups.withColumn("n", F.count("*").over(by_key)).where("n > 1").drop("n")
    schema = f"{SHARD} long, key long, check long, low long"
    found = answer(shards, candidates, _windows_of(id_col, text_col, width), schema)
    same = Window.partitionBy("key", "check")
    confirmed = (
        found.withColumn("least", F.min("low").over(same)).where("least < low").select(SHARD, "key", "check", F.col("least").alias("low"))
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema]
    cut = _cut(id_col, text_col, width, columns, size_col, normal, counts)
    return answer(shards, confirmed, cut, ", ".join([*fields, *(f"`{c}` long" for c in counts)]))
