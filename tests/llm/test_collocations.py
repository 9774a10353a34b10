"""Collocations against brute force: nulls, empty texts, pieces, ties, covered phrases, copies, clashing names."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import collocations as C
from starloom.llm import text

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def fold(t):
    return (t or "").encode().lower().decode()


def brute(rows, min_count, covered=80, top=2000):
    f, n = collections.Counter(), collections.Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", fold(t)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    found = {}
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    for (lang, w), a in candidates.items():
        inside = any(
            g == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v))) and 100 * b >= covered * a
            for (g, v), b in candidates.items()
        )
        if not inside:
            cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    rows = []
    for lang, some in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            rows.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(rows)


def ours(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("min_count, top", [(2, 2000), (5, 7)])
def test_collocations_match_brute_force(spark, corpus, docs, min_count, top):
    rows = [(t, lang) for _, t, lang, _ in corpus]
    assert ours(C.collocations(docs, min_count=min_count, top=top)) == brute(rows, min_count, top=top)


def test_pieces_case_ties_and_covered_phrases(spark):
    rows = [("New York, new york. NEW\tYORK new\nyork ÄB äb Äb äB", "x")] * 2 + [("a b c d e a b c d", "x"), (None, None), ("q q q q", None)]
    rows += [("p q r s", "und"), ("", "y"), ("one", "y"), ("z" * 9000 + " z", "y")]
    df = spark.createDataFrame(rows, "text string, lang string")
    for min_count in (1, 2, 3):
        assert ours(C.collocations(df, min_count=min_count)) == brute(rows, min_count)
    short = C.collocations(df, min_count=2, width=2).select("lang", "phrase", "a")
    assert sorted(map(tuple, short.collect())) == sorted((r[0], r[2], r[3]) for r in brute(rows, 2, covered=10**9) if len(r[2].split(" ")) == 2)


def test_no_rows(spark, nothing):
    assert ours(C.collocations(nothing)) == []
    df = spark.createDataFrame([(None, None), ("", "a"), ("w " * 20, "a")], "text string, lang string")
    assert ours(C.collocations(df)) == []


def test_counts_stay_right_when_tasks_hand_on_early(spark, corpus, docs, monkeypatch):
    monkeypatch.setattr(C, "HELD_ROWS", 50)
    part = text.words(pa.array([fold(t) for _, t, _, _ in corpus], pa.large_string()), in_word=C._in_word)
    held, plain = C._Windows(4), C._Windows(4)
    masks, may = C._frequent(part, C._seeds(["x"] * len(corpus)), [np.full(1 << (C.BITS - 6), ~np.uint64(0))] * 2)
    reach = [*masks, may]
    plain.add(part, ["x"] * len(corpus), reach)
    sums = collections.Counter()
    for _ in range(3):
        held.add(part, ["x"] * len(corpus), reach)
    held.merge()
    for which, times in ((held, 1), (plain, -3)):
        for batch in which.batches():
            for row in batch.to_pylist():
                n = row.pop("n")
                sums[tuple(row.values())] += times * n
    assert sums and not any(sums.values())
    batches = [pa.RecordBatch.from_pydict({"lang": ["x"], "text": [fold(t)]}) for _, t, _, _ in corpus]
    pairs = collections.Counter()
    for out in C._count_runs(iter(batches), []):
        for key, n in zip(out["key"].to_pylist(), out["n"].to_pylist(), strict=True):
            pairs[key] += n
    assert sum(pairs.values()) == int(masks[0].sum())


def test_runs_of_two_languages_differ():
    w = text.words(pa.array(["a b", "a b"], pa.large_string()), in_word=C._in_word)
    same, other = C._runs(w, C._seeds(["x", "x"]), 2), C._runs(w, C._seeds(["x", "y"]), 2)
    assert same[0] == same[2] and other[0] != other[2]
    assert not np.array_equal(same, other)


def test_products_past_64_bits(spark, monkeypatch):
    counts = [("x", "a b", 2, 8 * 10**17), ("x", "a", 1, 9 * 10**17), ("x", "b", 1, 8 * 10**17 + 1), ("x", "", 0, 4 * 10**18)]
    df = spark.createDataFrame(counts, "lang string, phrase string, size int, n long")
    monkeypatch.setattr(C, "phrase_counts", lambda *a, **k: df)
    score = 2000000 * 8 * 10**17 // (17 * 10**17 + 1)
    assert ours(C.collocations(df)) == [("x", 1, "a b", 8 * 10**17, 9 * 10**17, 8 * 10**17 + 1, 4 * 10**18, score)]
