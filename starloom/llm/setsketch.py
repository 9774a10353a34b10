"""Near-duplicate documents by SetSketch registers, with every link confirmed on full shingle sets.

A register holds how small, on an exponential scale and cut to 16 bits, the least of a set's exponential hashes is; the
register of a union is the larger one, and two sets share a register about as often as their Jaccard similarity says.

1. One pass gives each document's set size, a 128-bit name of its set and its registers. Documents with the same set are one
   class; everything else deals with the smallest id of each class.
2. Bands of registers are the keys of buckets. In each bucket a leader is paired with the others, a link is
   tried first by the joint likelihood of both sketches, then on the full sets, and links are put together
   to components. Leaders differ between thirds of the bands.
3. Buckets that still hold two components are gone through in blocks of bounded size: pairs of different
   components, most alike first, are confirmed until the block is one component or no likely pair is left.
   So no link is lost for the sake of the leaders, and no group's pairs are all listed.

With 30 bands of 4 registers a pair of similarity 0.85 shares no bucket once in 10^9, one of 0.8 once in 10^7.

Defined results: null and empty texts, and texts without words, have an empty set and are linked with
nothing. Texts of fewer words than a shingle have one shingle, all their words. Rows that repeat an id
are one document with several sets, each of which is linked for itself. Rows without an id are kept, and link nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import broadcast_if_few, components, joined_components, stored
from starloom.llm.text import mix, slices, strings, windows, words

BANDS = 30
ROWS = 4
REGISTERS = BANDS * ROWS
BASE = 1.001
RATE = 20.0
LARGEST = 65534
MARGIN = 5.0  # standard deviations by which an estimate may fall short of the threshold
BLOCK = 1000  # members of a bucket that are compared at once, at most twice as many

_rng = np.random.Generator(np.random.PCG64(11))
_FACTORS = _rng.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _rng.integers(0, 1 << 63, (BANDS, ROWS + 1), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(part: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, all in a row, and the bounds of each text's."""
    w = words(part, fold=True)
    hashes, counts = w.hashes(), w.counts
    owner, values = [], []
    for k in range(1, width + 1):  # texts of k words, and of more if k is the width
        chosen = counts >= k if k == width else counts == k
        text = np.flatnonzero(chosen)
        if len(text):
            n = counts[text] - k + 1
            owner.append(np.repeat(text, n))
            at = np.repeat(w.first[text] - np.cumsum(n) + n, n) + np.arange(n.sum())
            values.append(windows(hashes, k)[at])
    if not owner:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    owner, values = np.concatenate(owner), np.concatenate(values)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.r_[True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])]
    owner, values = owner[new], values[new]
    return values, np.searchsorted(owner, np.arange(len(counts) + 1))


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of registers for each text; an empty set has zeros."""
    n = len(bounds) - 1
    some = np.flatnonzero(np.diff(bounds))
    least = np.full((n, REGISTERS), np.iinfo(np.uint64).max, np.uint64)
    for i, factor in enumerate(_FACTORS if len(some) else ()):
        least[some, i] = np.minimum.reduceat(values * factor, bounds[some])
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    exponential = -np.log1p(-np.minimum(uniform, 1 - 1e-16))
    level = np.floor(1 - np.log(exponential / RATE) / np.log(BASE)) - 1
    level = np.clip(level, 0, LARGEST + 1).astype(np.uint16)
    level[np.diff(bounds) == 0] = 0
    return level


def band_keys(level: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row of registers."""
    parts = level.reshape(len(level), BANDS, ROWS).astype(np.uint64)
    return mix((parts * _BAND[:, :ROWS]).sum(axis=2, dtype=np.uint64) + _BAND[:, ROWS])


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of sketches that is likeliest, given both set sizes, to a hundredth."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    return likeliest(above, below, REGISTERS - above - below, size_a, size_b)


def likeliest(above, below, equal, size_a, size_b) -> np.ndarray:
    u = (size_a / (size_a + size_b))[:, None]
    v = 1 - u
    j = np.linspace(0.0, 1.0, 101)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    likelihood = above[:, None] * np.log(up) + below[:, None] * np.log(down) + equal[:, None] * np.log(same)
    best = likelihood.argmax(axis=1)
    return j[np.arange(len(best)), best]


def floor_for(percent: int) -> float:
    s = percent / 100
    return s - MARGIN * (s * (1 - s) / REGISTERS) ** 0.5


def likely(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that may be linked, and their estimates.

    The sizes alone rule many out. An estimate is at most the share of equal registers times the ratio of the larger to the
    smaller set, so that where this falls short by more than the grid's step the likelihood need not be worked out.
    """
    low = floor_for(percent)
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    equal = (a == b).sum(axis=1)
    at = np.flatnonzero((100 * small >= percent * large) & (equal * large >= (low - 0.02) * REGISTERS * small))
    j = estimate(np.broadcast_to(a, b.shape)[at], b[at], size_a[at], size_b[at]) if len(at) else np.zeros(0)
    return at[j >= low], j[j >= low]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


NAME = ("n", "a", "b")


def set_names(values: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """The size of each set and two hashes of its members in any order: together its name."""
    names = [pa.array(np.diff(bounds))]
    for salt in (1, 2):
        running = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(mix(values ^ np.uint64(salt * 0x5851F42D4C957F2D)), out=running[1:])
        names.append(pa.array((running[bounds[1:]] - running[bounds[:-1]]).view(np.int64)))
    return names


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id``, set size ``n``, the set's name (``a``, ``b``) and ``registers`` of every document."""

    def each(batches):
        for batch in batches:
            ids = strings(batch[id_col])
            for row, part in slices(batch[text_col]):
                values, bounds = shingle_sets(part, width)
                level = registers(values, bounds)
                packed = pa.array([r.tobytes() for r in level], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(part)), *set_names(values, bounds), packed], ["id", *NAME, "registers"]
                )

    schema = "id long, n long, a long, b long, registers binary"
    return docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(each, schema)


def _unpack(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _bands(batches):
    for batch in batches:
        keys = band_keys(_unpack(batch["registers"]))
        ids = np.repeat(batch["id"].to_numpy(), BANDS)
        third = np.tile(np.arange(BANDS, dtype=np.int32) * 3 // BANDS, batch.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(third), pa.array(ids)], ["key", "third", "id"])


def _sets_of(id_col: str, text_col: str, width: int):
    def each(batches):
        for batch in batches:
            ids = strings(batch[id_col])
            for row, part in slices(batch[text_col]):
                values, bounds = shingle_sets(part, width)
                packed = [values[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [ids.slice(row, len(part)), *set_names(values, bounds), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", *NAME, "shingles"])

    return each


def _confirm(percent: int):
    def each(batches):
        for batch in batches:
            a, b = _unpack(batch["registers_a"]), _unpack(batch["registers_b"])
            sets = [[np.frombuffer(x, np.uint64) for x in batch[c].to_pylist()] for c in ("shingles_a", "shingles_b")]
            sizes = [np.array([len(x) for x in s], float) for s in sets]
            keep = np.zeros(len(a), bool)
            for i in likely(a, b, *sizes, percent)[0]:
                keep[i] = linked(sets[0][i], sets[1][i], percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return each


def _block(percent: int):
    """Links that join different components of one block of a bucket, likeliest pairs first."""
    def work(table):
        table = table.sort_by("id")
        ids = table["id"].to_numpy()
        level = _unpack(table["registers"])
        sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        sizes = np.array([len(s) for s in sets], float)
        side = table["side"].to_numpy()
        _, component = np.unique(table["component"].to_numpy(), return_inverse=True)
        found, tried = [], []
        for i in range(len(ids) - 1):
            rest = np.arange(i + 1, len(ids))
            # within one side only where both sides are the same block
            rest = rest[(component[rest] != component[i]) & ((side[rest] == 2) | (side[rest] != side[i])) & (ids[rest] != ids[i])]
            if not len(rest):
                continue
            at, j = likely(level[i], level[rest], np.full(len(rest), sizes[i]), sizes[rest], percent)
            tried.append(np.column_stack([j, np.full(len(at), i), rest[at]]))
        if tried:
            tried = np.concatenate(tried)
            for _, i, k in tried[np.argsort(-tried[:, 0], kind="stable")]:
                i, k = int(i), int(k)
                if component[i] != component[k] and linked(sets[i], sets[k], percent):
                    found.append((ids[i], ids[k]))
                    component[component == component[k]] = component[i]
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return work


def near_duplicates(docs: DataFrame, *, id_col="doc_id", text_col="text", width=5, percent=80) -> DataFrame:
    """One row per document: ``n_shingles``, ``component_id`` (the smallest id reachable by links) and ``kept``.

    Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets.
    """
    sketched = stored(sketches(docs, id_col, text_col, width), "sketches")
    name = list(NAME)
    classes = sketched.where("n > 0 AND id IS NOT NULL").groupBy(*name).agg(F.min("id").alias("id"), F.first("registers").alias("registers"))
    classes = stored(classes, "classes")
    bands = classes.select("id", "registers").mapInArrow(_bands, "key long, third int, id long")
    leaders = bands.groupBy("key").agg(
        F.count("*").alias("members"), F.min("id").alias("first"), F.max("id").alias("last"), F.min_by("id", F.xxhash64("id")).alias("some")
    ).where("members > 1")
    lead = F.when(F.col("third") == 0, F.col("first")).when(F.col("third") == 1, F.col("last")).otherwise(F.col("some"))
    shared = stored(bands.join(leaders, "key").select("key", "id", "members", lead.alias("lead")), "buckets")
    members = broadcast_if_few(stored(shared.select("id").distinct(), "members"))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    chosen = texts.join(members, texts["_id"] == members["id"], "left_semi")
    # an id of several texts has several sets, each with its own registers
    sets = chosen.mapInArrow(_sets_of("_id", "_text", width), "id long, n long, a long, b long, shingles binary").dropDuplicates(["id", *name])
    profiles = stored(sets.join(classes, ["id", *name]).select("id", "registers", "shingles"), "profiles")

    pairs = shared.where("lead <> id").select(F.least("lead", "id").alias("a"), F.greatest("lead", "id").alias("b")).distinct()
    for side in ("a", "b"):
        own = profiles.select(F.col("id").alias(side), F.col("registers").alias(f"registers_{side}"), F.col("shingles").alias(f"shingles_{side}"))
        pairs = pairs.join(own, side)
    links = pairs.mapInArrow(_confirm(percent), "a long, b long")
    repeated = sketched.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    repeated = stored(repeated, "repeated")
    if not repeated.isEmpty():  # one document: what its sets are linked with is reached by way of it
        own = sketched.where("n > 0").join(broadcast_if_few(repeated), "id", "left_semi").select(F.col("id").alias("b"), F.struct(*name).alias("set"))
        least = classes.select(F.col("id").alias("a"), F.struct(*name).alias("set"))
        links = links.union(own.distinct().join(least, "set").select("a", F.col("b")).where("a <> b"))
    links = stored(links, "links")
    found = components(links)

    placed = shared.select("key", "id", "members").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = stored(placed, "placed")
    split = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    open_members = placed.join(split, "key")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    open_members = open_members.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "id"), F.col("blocks")).cast("int"))
    open_members = open_members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own, other = F.col("own"), F.col("other")
    open_members = open_members.select(
        "key", F.least(own, other).alias("i"), F.greatest(own, other).alias("j"), "id", "component",
        F.when(own == other, 2).when(own < other, 0).otherwise(1).alias("side"),
    ).join(profiles, "id")
    more = open_members.groupBy("key", "i", "j").applyInArrow(_block(percent), "a long, b long")
    more = stored(more.distinct(), "links")
    if not more.isEmpty():
        found = joined_components(found, more)

    grouped = classes.select(*name, F.col("id").alias("rep")).join(found.withColumnRenamed("id", "rep"), "rep", "left")
    grouped = grouped.select(*name, F.coalesce("component", "rep").alias("component"))
    result = sketched.select("id", *name).join(grouped, name, "left")
    component = F.coalesce("component", "id")
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept")
    )
