"""The source audit against brute force: nulls, groups without terms, ties, one source, shards, large counts."""

import collections
import re

import numpy as np
import pytest

from starloom.llm import divergence as D

NAMES = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, min_docs, top=10):
    groups, df = collections.defaultdict(collections.Counter), collections.Counter()
    for t, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").encode().lower().decode())
        groups[lang, source].update(terms)
        df.update((lang, x) for x in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = {x for (g, x), n in df.items() if g == lang and n >= min_docs}
        v = len(kept)
        mine = {s: {x: c[x] for x in kept} for (g, s), c in groups.items() if g == lang}
        whole = {x: sum(c[x] for c in mine.values()) for x in kept}

        def share(c):
            total = sum(c.values()) + 2 * v
            return {x: 1 + 1000000000 * (n + 2) // total for x, n in c.items()}

        p, q = {s: share(c) for s, c in mine.items()}, share(whole)

        def f(a, b):
            return (a - b) * (a - b) // (a + b)

        for s, ps in p.items():
            pairs = [(-sum(f(ps[x], po[x]) for x in kept), o.encode()) for o, po in p.items() if o != s]
            terms = [(-f(ps[x], q[x]), x.encode()) for x in kept if mine[s][x] > 0 and ps[x] > q[x]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, rank) for rank, (v, i) in enumerate(found, 1)]
    return sorted(out)


def ours(df):
    assert df.columns == NAMES
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("min_docs, shard_rows", [(3, 20_000), (2, 7), (1000, 5)])
def test_audit_matches_brute_force(spark, corpus, docs, min_docs, shard_rows, monkeypatch):
    monkeypatch.setattr(D, "CELLS", 40)
    rows = [(t, lang, source) for _, t, lang, source in corpus]
    assert ours(D.audit(docs, min_docs=min_docs, shard_rows=shard_rows)) == brute(rows, min_docs)


def test_small_groups(spark, nothing):
    assert ours(D.audit(nothing)) == []
    rows = [("Aé bÉ a1b", "x", "s"), ("ae É", "x", None), (None, "x", "t"), ("", None, None), ("b b b", "y", "only"), ("b b b", "y", "only")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert ours(D.audit(df, min_docs=1)) == brute(rows, 1)
    assert ours(D.audit(df, min_docs=1, top=1)) == brute(rows, 1, 1)


def test_tasks_that_hand_on_early_count_the_same(spark, corpus, monkeypatch):
    import pyarrow as pa

    def batches():
        for _, t, lang, source in corpus:
            yield pa.RecordBatch.from_pydict({"lang": [lang or ""], "source": [source or ""], "text": [t]}, pa.schema([("lang", pa.string()), ("source", pa.string()), ("text", pa.string())]))

    def total():
        sums = collections.Counter()
        for out in D._partial(batches()):
            for r in out.to_pylist():
                sums[r["lang"], r["source"], r["term"]] += r["n"] + 1000003 * r["docs"]
        return sums

    once = total()
    monkeypatch.setattr(D, "HELD_ROWS", 30)
    assert once == total() and once


def test_shares_are_exact():
    rng = np.random.Generator(np.random.PCG64(3))
    total = rng.integers(1, 9 * 10**15, 500)
    counts = (total * rng.random(500)).astype(np.int64)
    expected = [1 + 10**9 * int(c) // int(t) for c, t in zip(counts, total, strict=True)]
    assert D.shares(counts, total).tolist() == expected
