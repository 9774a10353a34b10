"""How far the sources of a language differ in their words: a divergence of each pair, and each one's own words.

Tasks count with Arrow's compute functions: lower case, split at what is no letter, encode as a dictionary, group by
document and term, then by source and term. Spark adds these partial counts up, keeps the terms of enough
documents, and deals the terms of a language into shards, one row per term with its counts by source. Each
shard adds up its terms' share of every pair of sources and finds its own best terms; both are merged.

All arithmetic is on whole numbers: a share of words is a number of billionths, worked out by long division.

Defined results: null text, language and source are the empty text. Rows count as documents, also repeated ones. A
(language, source) without any term is there all the same. A language without kept terms has pairs of value 0 and no
terms; a language of one source has no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.text import release, slices

MIN_DOCS = 10
TOP = 10
SLICE_BYTES = 8 << 20
HELD_ROWS = 1 << 20  # a task adds up its partial counts when it holds so many
SHARD_ROWS = 20_000  # terms of a shard, about
CELLS = 1 << 21  # terms by sources that are worked on at once

NO_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SHARE_DIGITS = 3  # the long division gives so many groups of three digits: billionths
COUNTED = "lang string, source string, term string, n long, docs long"


def _count(texts: pa.Array, group: np.ndarray) -> pa.Table:
    """Occurrences and documents of each (group, term) of some texts."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=NO_LETTER)
    found = lists.flatten().dictionary_encode()
    rows = pa.table({"doc": pc.list_parent_indices(lists), "term": found.indices})
    by_doc = rows.group_by(["doc", "term"]).aggregate([([], "count_all")])
    by_group = pa.table(
        {"group": group[by_doc["doc"].to_numpy()], "term": by_doc["term"], "n": by_doc["count_all"]}
    ).group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
    counts = pa.table(
        {
            "group": by_group["group"],
            "term": found.dictionary.take(by_group["term"].combine_chunks()),
            "n": by_group["n_sum"],
            "docs": by_group["n_count"],
        }
    )
    return counts.filter(pc.not_equal(counts["term"], ""))


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple, int] = {}
    held: list[pa.Table] = []

    def merged():
        summed = pa.concat_tables(held).group_by(["group", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return summed.rename_columns(["group", "term", "n", "docs"])

    def out(counts):
        at = counts["group"].to_numpy()
        labels = [pa.array([g[i] for g in groups], pa.string()) for i in range(2)]
        arrays = [*(x.take(pa.array(at)) for x in labels), counts["term"].cast(pa.string()), counts["n"], counts["docs"]]
        names = ["lang", "source", "term", "n", "docs"]
        yield from pa.table(dict(zip(names, arrays, strict=True))).to_batches(max_chunksize=100_000)

    for batch in batches:
        for row, part in slices(batch["text"], SLICE_BYTES):
            pairs = zip(*(batch[c].slice(row, len(part)).to_pylist() for c in ("lang", "source")), strict=True)
            held.append(_count(part, np.array([groups.setdefault(p, len(groups)) for p in pairs], np.int64)))
            if sum(t.num_rows for t in held) > HELD_ROWS:
                held = [merged()]
                if held[0].num_rows > HELD_ROWS // 2:
                    yield from out(held.pop())
    if held:
        yield from out(merged())
    release()


def shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """One more than the billionths that ``counts`` are of ``total``, rounded down, without a product that passes 64 bits."""
    whole, rest = np.divmod(counts, total)
    for _ in range(SHARE_DIGITS):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shard(terms: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """Shares of all pairs and the best terms of every source, from the terms of one shard of one language."""
    order = np.argsort(groups["source"].to_numpy().astype(object), kind="stable")
    sources = [groups["source"][int(i)].as_py() for i in order]
    n, v = groups["n"].to_numpy()[order], int(groups["v"][0].as_py())
    language = groups["lang"][0].as_py()
    number = {s: i for i, s in enumerate(sources)}
    total, everything = n + 2 * v, int(groups["n_lang"][0].as_py()) + 2 * v
    pairs = np.zeros((len(sources), len(sources)), np.int64)
    best: list[tuple] = []
    step = max(1, CELLS // len(sources))
    for row in range(0, terms.num_rows, step):
        part = terms.slice(row, step).combine_chunks()
        names = np.array([t.encode() for t in part["term"].to_pylist()], object)
        lists = part["counts"].combine_chunks()
        at = pc.list_parent_indices(lists).to_numpy()
        flat = lists.flatten()
        who = np.array([number[s] for s in flat.field("source").to_pylist()], np.int64)
        counts = np.zeros((part.num_rows, len(sources)), np.int64)
        counts[at, who] = flat.field("n").to_numpy()
        by_name = np.argsort(names, kind="stable")
        counts, names = counts[by_name], names[by_name]
        p = shares(counts + 2, total[None, :])
        q = shares(counts.sum(axis=1) + 2, np.int64(everything))
        for a in range(len(sources)):
            pairs[a, a + 1 :] += distances(p[:, a : a + 1], p[:, a + 1 :]).sum(axis=0)
            own = np.flatnonzero((counts[:, a] > 0) & (p[:, a] > q))
            value = distances(p[own, a], q[own])
            for i in np.argsort(-value, kind="stable")[:top]:
                best.append((sources[a], "term", names[own[i]].decode(), int(value[i])))
    for a, b in zip(*np.triu_indices(len(sources), 1), strict=True):
        best.append((sources[a], "pair", sources[b], int(pairs[a, b])))
    columns = [list(c) for c in zip(*best, strict=True)] or [[], [], [], []]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.table([pa.array([language] * len(best), pa.string()), *arrays], ["lang", "source", "part", "item", "value"])


def audit(
    docs: DataFrame,
    *,
    lang_col="lang",
    source_col="source",
    text_col="text",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``lang``, ``source``, ``part`` (``pair`` or ``term``), ``item``, ``value`` and ``rank`` of every group.

    The rows of ``pair`` are the square of a language's sources, as is the work for each term.
    """
    blank = F.lit("")
    texts = docs.select(
        *[F.coalesce(F.col(c).cast("string"), blank).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
        F.col(text_col).alias("text"),
    )
    counted = texts.mapInArrow(_partial, COUNTED).groupBy("lang", "source", "term")
    counted = counted.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # one row per term: as many counts as the language has sources, at most
    by_term = counted.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts")
    )
    kept = stored(by_term.where(F.col("docs") >= min_docs).drop("docs"), "terms")

    sums = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    every = texts.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").fillna({"n": 0})
    every = stored(every.join(sizes, "lang", "left").fillna({"v": 0}), "groups")
    every = every.join(every.groupBy("lang").agg(F.sum("n").alias("n_lang")), "lang")

    n_shards = max(1, -(-kept.count() // shard_rows))
    shard = F.pmod(F.xxhash64("term"), F.lit(n_shards)).cast("int").alias("shard")
    terms = kept.select("lang", shard, "term", "counts").groupBy("lang", "shard")
    groups = every.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))).groupBy("lang", "shard")

    def each(part, of):
        found = _shard(part, of, top)
        release()
        return found

    schema = "lang string, source string, part string, item string, value long"
    found = stored(terms.cogroup(groups).applyInArrow(each, schema), "divergences")
    half = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    other = half.select("lang", F.col("item").alias("source"), "part", F.col("source").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).cast("int").alias("rank")
    pairs = half.union(other).select("*", rank)
    own = found.where("part = 'term'").select("*", rank).where(F.col("rank") <= top)
    return pairs.union(own)
