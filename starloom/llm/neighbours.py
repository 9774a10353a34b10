"""Approximate nearest neighbours in learned partitions.

A bounded sample of the vectors is joined to its nearest neighbours, which gives a graph. The graph is cut into
partitions of equal size, by bisections that separate few neighbours. A small network learns from a vector in which
partitions the neighbours of the sample's vectors lie. It puts every vector into its most probable partition
and routes each query to its most probable partitions, until their probabilities add up to ``mass``. There, every
vector is compared with the query, by the cosine of the original vectors in double precision.

``mass`` is measured, not set: vectors of the sample that the network has not learned from are searched among the
sample, and the least mass is taken that finds ``recall`` of their true neighbours. A query goes on to further
partitions while those before hold fewer vectors than it wants.

Partitions are compared in blocks: a large partition is dealt into several, and so are its queries, so that no task
holds more than ``BLOCK_ROWS`` vectors and ``BLOCK_QUERIES`` queries, about.

Defined results: a vector takes part if it has the most frequent length (the smallest of several) and only finite
components, not all zero. A row is no candidate of its own, but other rows with its id are; repeated rows of a
query each have their answers. Equal scores go to the smaller id, null ids last. A null id is a candidate and no query. With
no more than ``k`` candidates a query gets all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.components import stored
from starloom.llm.text import release

SAMPLE_ROWS = 8192  # the index is learned from at most about so many vectors
PARTITIONS = 64
PARTITION_SAMPLE = 32  # vectors of the sample in a partition, at least
DEGREE = 16  # neighbours of a vector in the graph
HIDDEN = 192
EPOCHS = 30
HELD_OUT = 8  # one in so many vectors of the sample measures recall
RECALL = 0.96
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 4_096
CLOSE = 1e-9  # products of matrices are off by less
COMPARED = 128  # rows compared with all others at once while the driver fits: 8 MB a copy with the whole sample


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors times powers of two, which changes no cosine, so that no square overflows."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, keepdims=True))
    return np.ldexp(vectors, -exponent)


def units(vectors: np.ndarray) -> np.ndarray:
    near = scaled(vectors)
    return near / np.sqrt((near * near).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows; the same for the same two rows, wherever they stand."""
    a, b = scaled(a), scaled(b)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def neighbour_lists(x: np.ndarray, degree: int, rows: np.ndarray | None = None) -> np.ndarray:
    """The nearest other rows of each row (or of some) of unit vectors, in blocks."""
    rows = np.arange(len(x)) if rows is None else rows
    lists = np.empty((len(rows), degree), np.int64)
    for at in range(0, len(rows), COMPARED):
        some = rows[at : at + COMPARED]
        near = x[some] @ x.T
        near[np.arange(len(some)), some] = -2
        # copied: a view of the lists would keep the order of all rows
        lists[at : at + COMPARED] = np.argpartition(np.negative(near, out=near), degree - 1, axis=1)[:, :degree]
    return lists


def _bisect(nodes: np.ndarray, lists: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of the nodes, with few neighbours between them."""
    place = np.full(len(lists), -1)
    place[nodes] = np.arange(len(nodes))
    ends = place[lists[nodes]]
    a = np.repeat(np.arange(len(nodes)), lists.shape[1])[ends.ravel() >= 0]
    b = ends.ravel()[ends.ravel() >= 0]
    a, b = np.r_[a, b], np.r_[b, a]
    n, half = len(nodes), len(nodes) // 2
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    # the second eigenvector of the random walk on the graph, by power iteration
    value = rng.standard_normal(n)
    for _ in range(60):
        value -= (value * degree).sum() / degree.sum()
        value = 0.5 * value + 0.5 * np.bincount(a, value[b], n) / degree
        value /= max(np.abs(value).max(), 1e-300)
    side = np.zeros(n, bool)
    side[np.argsort(value, kind="stable")[half:]] = True
    # swaps of equal numbers of nodes that have more neighbours on the other side
    for _ in range(20):
        there = np.bincount(a, side[b], n)
        gain = np.where(side, np.bincount(a, minlength=n) - 2 * there, 2 * there - np.bincount(a, minlength=n))
        left, right = (np.flatnonzero(side == s) for s in (False, True))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        good = int((gain[left[:m]] + gain[right[:m]] > 0).sum()) // 4
        if not good:
            break
        side[left[:good]], side[right[:good]] = True, False
    return nodes[~side], nodes[side]


def balanced_partitions(lists: np.ndarray, n: int, rng) -> np.ndarray:
    """A partition number for every row, ``n`` (a power of two) of equal size."""
    parts = [np.arange(len(lists))]
    while len(parts) < n:
        parts = [half for part in parts for half in _bisect(part, lists, rng)]
    number = np.zeros(len(lists), np.int64)
    for i, part in enumerate(parts):
        number[part] = i
    return number


@dataclass
class Router:
    """A network with one hidden layer: probabilities of the partitions of a vector's neighbours."""

    weights: list[np.ndarray]
    mass: float = 1.0

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        z = np.maximum(units(vectors) * np.sqrt(vectors.shape[1]) @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def probes(self, p: np.ndarray, sizes: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, partition) pairs: the most probable partitions up to the mass, and on until ``wanted`` vectors are there."""
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
        held = np.cumsum(sizes[order], axis=1) - sizes[order]
        row, at = np.nonzero((before < self.mass) | (held < wanted))
        return row, order[row, at]


def train(x: np.ndarray, targets: np.ndarray, rng) -> Router:
    """Learns the rows' distributions over partitions by Adam steps on small batches."""
    x = x * np.sqrt(x.shape[1])
    n = targets.shape[1]
    w = [
        rng.standard_normal((x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN),
        rng.standard_normal((HIDDEN, n)) * np.sqrt(1 / HIDDEN), np.zeros(n),
    ]
    first, second = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    step = 0
    for epoch in range(EPOCHS):
        rate = 3e-3 * (1 - epoch / EPOCHS)
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            hidden = np.maximum(x[rows] @ w[0] + w[1], 0)
            z = hidden @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            off = (p / p.sum(axis=1, keepdims=True) - targets[rows]) / len(rows)
            back = (off @ w[2].T) * (hidden > 0)
            gradients = [x[rows].T @ back + 1e-4 * w[0], back.sum(axis=0), hidden.T @ off + 1e-4 * w[2], off.sum(axis=0)]
            step += 1
            for a, g, m, v in zip(w, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(w)


def fit(vectors: np.ndarray, *, k: int, partitions=PARTITIONS, recall=RECALL) -> Router:
    """A router from a bounded sample of vectors: neighbour graph, balanced partitions, network, mass."""
    rng = np.random.Generator(np.random.PCG64(11))
    x = np.unique(units(vectors), axis=0)  # copies of one vector are no neighbourhood of their own
    x = x[rng.permutation(len(x))]
    degree = min(DEGREE, len(x) - 1)
    n = 1
    while n * 2 <= partitions and len(x) >= n * 2 * PARTITION_SAMPLE:
        n *= 2
    if degree < 1 or n == 1:
        return Router([np.zeros((vectors.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)])
    lists = neighbour_lists(x, degree)
    number = balanced_partitions(lists, n, rng)
    targets = np.zeros((len(x), n))
    np.add.at(targets, (np.repeat(np.arange(len(x)), degree), number[lists].ravel()), 1 / degree)
    held = np.arange(len(x)) % HELD_OUT == 0
    router = train(x[~held], targets[~held], rng)
    # the mass that a held-out vector needs to come to the partition of each of its neighbours
    p = router.probabilities(x)
    put = p.argmax(axis=1)
    near = neighbour_lists(x, min(k, degree), np.flatnonzero(held))
    mine = p[held]
    own = np.take_along_axis(mine, put[near], axis=1)
    before = np.where(mine[:, None, :] > own[:, :, None], mine[:, None, :], 0).sum(axis=2)
    router.mass = float(np.quantile(before, recall)) + 1e-6
    return router


def usable(rows: DataFrame, vector_col: str) -> DataFrame:
    """The rows whose vector takes part."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    some = F.exists(vector_col, lambda x: x != 0)
    whole = rows.where(F.col(vector_col).isNotNull() & finite & some)
    lengths = whole.groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), "d").first()
    return whole.where(F.size(vector_col) == F.lit(lengths["d"] if lengths else 0))


def _best(queries: np.ndarray, keys: np.ndarray, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """The ``k`` nearest of the block's vectors for each query: places of queries and vectors, and scores."""
    # equal vectors have equal scores: each is compared once, and stands for its first rows in order of id
    order = np.lexsort([rows, ids[1], ids[0]])
    _, first, same = np.unique(vectors[order], axis=0, return_index=True, return_inverse=True)
    by_vector = order[np.argsort(same.ravel(), kind="stable")]
    count = np.bincount(same.ravel(), minlength=len(first))
    begin = np.cumsum(count) - count
    distinct = vectors[order[first]]
    flat = units(distinct)
    found = []
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        near = units(some) @ flat.T
        take = min(k + 1, near.shape[1])
        least = np.partition(near, near.shape[1] - take, axis=1)[:, near.shape[1] - take]
        q, v = np.nonzero(near >= least[:, None] - CLOSE)
        score = cosines(some[q], distinct[v])
        repeats = np.minimum(count[v], k + 1)
        place = by_vector[np.repeat(begin[v] - (np.cumsum(repeats) - repeats), repeats) + np.arange(repeats.sum())]
        q, score = np.repeat(q, repeats), np.repeat(score, repeats)
        other = rows[place] != keys[at : at + 256][q]
        q, place, score = q[other], place[other], score[other]
        by_rank = np.lexsort([rows[place], ids[1][place], ids[0][place], -score, q])
        q, place, score = q[by_rank], place[by_rank], score[by_rank]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        found.append((q[rank < k] + at, place[rank < k], score[rank < k]))
    return [np.concatenate(c) for c in zip(*found, strict=True)]


def nearest(
    vectors: DataFrame,
    is_query,
    *,
    id_col="vec_id",
    vector_col="embedding",
    k: int = 5,
    sample_rows: int = SAMPLE_ROWS,
    partitions: int = PARTITIONS,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` of the ``k`` nearest rows found for each row where ``is_query`` holds.

    The index is fitted on at most about ``sample_rows`` vectors, chosen by a hash, and holds every vector.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(is_query, F.lit(False)).alias("asked"), F.col(vector_col).alias("vector")
    )
    # the row numbers are fixed by writing them
    rows = stored(usable(rows, "vector").withColumn("row", F.monotonically_increasing_id()), "vectors")
    total = rows.count()
    share = min(1.0, sample_rows / max(total, 1))
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "vector"), F.lit(1_000_000)) < int(share * 1_000_000))
    # equal vectors have one hash: one row of each, so that the sample stays small whatever repeats
    sample = chosen.select("vector").distinct().toArrow()["vector"].combine_chunks()
    width = len(sample[0]) if len(sample) else 1
    found = matrix(sample, width)
    found = found[np.lexsort(found.T)]
    router = fit(found, k=k, partitions=partitions, recall=recall) if len(found) else fit(np.ones((1, width)), k=k)
    del sample, found
    release()  # the driver needs its memory for the next search
    shared = spark.sparkContext.broadcast(router)

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                part = shared.value.probabilities(matrix(batch["vector"], width)).argmax(axis=1)
                yield batch.append_column("part", pa.array(part.astype(np.int32)))

    kind = rows.schema["vector"].dataType.simpleString()
    placed = stored(rows.mapInArrow(place, f"id long, asked boolean, vector {kind}, row long, part int"), "placed")
    sizes = np.zeros(router.weights[-1].size, np.int64)
    for r in placed.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                p = shared.value.probabilities(matrix(batch["vector"], width))
                at, part = shared.value.probes(p, sizes, k + 1)
                taken = pa.Table.from_batches([batch]).take(pa.array(at)).append_column("part", pa.array(part.astype(np.int32)))
                yield from taken.to_batches()

    routed = placed.where("asked and id is not null").select("id", "vector", "row")
    routed = stored(routed.mapInArrow(route, f"id long, vector {kind}, row long, part int"), "routed")
    asked = np.zeros(len(sizes), np.int64)
    for r in routed.groupBy("part").count().collect():
        asked[r["part"]] = r["count"]

    # block of a partition's vectors, and group of its queries
    def dealt(df, own, other, at, across):
        n_own, n_other = (F.element_at(F.array(*[F.lit(max(1, -(-int(n) // most))) for n in counts]), F.col("part") + 1) for counts, most in (own, other))
        return df.withColumn(at, F.pmod(F.xxhash64(F.lit(at), "row"), n_own).cast("int")).withColumn(
            across, F.explode(F.sequence(F.lit(0), n_other - 1))
        )

    by_vector, by_query = (sizes, block_rows), (asked, block_queries)
    candidates = dealt(placed.select("id", "vector", "row", "part"), by_vector, by_query, "block", "crowd")
    questions = dealt(routed, by_query, by_vector, "crowd", "block")
    keys = ["part", "block", "crowd"]

    def search(of, by):
        if not of.num_rows or not by.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(("query", "query_row", "id", "row", "score"), (*[pa.int64()] * 4, pa.float64()), strict=True)})
        vector_ids = of["id"].combine_chunks()
        ids = (pc.is_null(vector_ids).to_numpy(zero_copy_only=False), pc.fill_null(vector_ids, 0).to_numpy(zero_copy_only=False))
        row = of["row"].to_numpy()
        asked_rows = by["row"].to_numpy()
        q, v, score = _best(matrix(by["vector"], width), asked_rows, matrix(of["vector"], width), ids, row, k)
        return pa.table(
            {
                "query": by["id"].combine_chunks().take(pa.array(q)),
                "query_row": asked_rows[q],
                "id": vector_ids.take(pa.array(v)),
                "row": row[v],
                "score": score,
            }
        )

    schema = "query long, query_row long, id long, row long, score double"
    hits = candidates.groupBy(*keys).cogroup(questions.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score"
    )
