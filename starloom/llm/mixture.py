"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a row of slots, each a block of ``BLOCK`` words of one source. A source's target in words
gives its number of slots; the sources' slots lie one after the other on the integers below 2^k, and
reversing the k bits of such an integer (a van der Corput point) gives the slot's position in
the mix, so that every stretch of the mix holds the sources in nearly the wanted shares. The rank of
a slot within its source, which counts the source's earlier slots, is worked out from the bits, without sorting. A source's documents
are shuffled by a hash, laid end to end and cut into blocks of equal words; the slot of rank r
takes block r, from the start again once all are used, and the last slot takes only what
the target leaves.

Targets: weights share ``total`` of all words; a target stops at ``most`` times its source's words, and
the rest is shared again by weight until none is above.

Defined results: a null or empty text has size 0 and nothing is taken of it. Sources without words have target
0. Null is a source of its own, the last. Rows that repeat an id are laid side by side, ordered by their text; rows without an id
are documents like others, shuffled by their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL = 1.5
MOST = 2.0
BLOCK = 1024
BUCKET_DIGITS = 3  # a source's shuffled documents are laid out in 16^3 stretches


def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, *, weights=WEIGHTS, total=TOTAL, most=MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` for every source of a (source, size) table.

    In order of ``most * size / weight`` the sources that stop come first: a source stops if, with all before it
    stopped, its share of what is left would be more than its limit. One row per source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limited = sums.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(most))
    limited = limited.withColumn("all", F.sum("source_size").over(everything) * F.lit(total))
    ordered = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rated = limited.withColumn("rate", left / weight_left).withColumn("stops", F.col("limit") <= F.col("rate") * F.col("weight"))
    # the first source that does not stop sets the rate for itself and all after it; later rows have smaller ones
    rate = F.max(F.when(~F.col("stops"), F.col("rate"))).over(everything)
    target = F.when(F.col("stops"), F.col("limit")).otherwise(rate * F.col("weight"))
    return rated.withColumn("target", target).select("source", "source_size", "target")


def laid_out(docs: DataFrame) -> DataFrame:
    """For each document of (key, source, size, tie): the place of its first word among its source's shuffled words."""
    # rows without a key are shuffled by their text
    name = F.coalesce(F.concat(F.lit("mix-"), F.col("key").cast("string")), F.concat(F.lit("text-"), F.col("tie").cast("string")))
    spread = F.md5(name)
    docs = docs.withColumn("spread", spread).withColumn("bucket", F.substring("spread", 1, BUCKET_DIGITS))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0))).drop("bucket_size")
    inside = Window.partitionBy("source", "bucket").orderBy("spread", "key", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = docs["source"].eqNullSafe(sums["source"]) & (docs["bucket"] == sums["bucket"])
    placed = docs.join(sums, same).select(docs["*"], sums["offset"])
    return placed.withColumn("begin", F.col("offset") + F.col("inside")).drop("spread", "bucket", "inside", "offset")


def schedule(wanted: DataFrame, *, block=BLOCK) -> DataFrame:
    """The slots of the mix: ``source``, ``position`` in the mix, ``rank`` in the source, ``block``, ``pass``, ``words`` taken."""
    take = F.round("target").cast("long")
    sources = wanted.where("source_size > 0").withColumn("take", take)
    by_name = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # whole passes take whole streams: the last block of a pass is as short as the stream leaves it
    per_pass = F.ceil(F.col("source_size") / block)
    passes = F.floor(F.col("take") / F.col("source_size"))
    slots = passes * per_pass + F.ceil((F.col("take") - passes * F.col("source_size")) / block)
    sources = sources.withColumn("per_pass", per_pass).withColumn("slots", slots)
    sources = sources.withColumn("from", F.coalesce(F.sum("slots").over(by_name), F.lit(0)))
    bits = F.greatest(F.ceil(F.log2(F.sum("slots").over(everything))), F.lit(1)).cast("int")
    sources = sources.where("slots > 0").withColumn("bits", bits)
    # in chunks, so that a large source is not one row that one task unfolds
    chunk = 1 << 16
    chunks = sources.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / chunk).cast("long"))))
    chunks = chunks.repartition(F.col("source"), F.col("chunk"))
    low = F.col("chunk") * chunk
    high = F.least(low + chunk, F.col("slots")) - 1
    slots = chunks.withColumn("own", F.explode(F.sequence(low, high))).withColumn("point", F.col("from") + F.col("own"))
    slots = slots.withColumn("position", F.expr("cast(conv(reverse(lpad(bin(point), bits, '0')), 2, 10) AS bigint)"))
    # points of the source whose reversed bits are smaller: those that agree in the j lowest bits, where this one has bit j and they don't
    rank = F.expr(
        "aggregate(sequence(0, bits - 1), 0L, (n, j) -> n + CASE WHEN getbit(point, j) = 1 THEN "
        "floor((`from` + slots - 1 - pmod(point, shiftleft(1L, j))) / shiftleft(2L, j)) - "
        "floor((`from` - 1 - pmod(point, shiftleft(1L, j))) / shiftleft(2L, j)) ELSE 0L END)"
    )
    slots = slots.withColumn("rank", rank)
    slots = slots.withColumn("block", F.col("rank") % F.col("per_pass")).withColumn("pass", F.floor(F.col("rank") / F.col("per_pass")))
    block_words = F.least(F.lit(block), F.col("source_size") - F.col("block") * block)
    rest = F.col("take") - F.col("pass") * F.col("source_size") - F.col("block") * block
    return slots.withColumn("words", F.least(block_words, rest)).select("source", "position", "rank", "block", "pass", "words")


def _left_join(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """A left join on columns in which null is a value."""
    right = right.withColumnsRenamed({c: f"_{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same &= left[c].eqNullSafe(right[f"_{c}"])
    return left.join(right, same, "left").drop(*[f"_{c}" for c in columns])


def mix(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, total=TOTAL, most=MOST, block=BLOCK):
    """One row per document: ``size``, ``source_size``, ``target``, and the words ``taken`` of it in every pass.

    ``taken`` adds up the passes; ``passes`` lists the words taken in each, always a run from the document's start.
    """
    sized = docs.select(
        F.col(id_col).alias("key"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("tie"),
    )
    wanted = targets(sized, weights=weights, total=total, most=most)
    placed = laid_out(sized)
    # the stretch of a document in each block that it reaches
    held = placed.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("size") - 1) / block)))
    )
    slots = schedule(wanted, block=block)
    joined = held.join(slots, held["source"].eqNullSafe(slots["source"]) & (held["block"] == slots["block"]))
    low = F.greatest(F.col("begin"), held["block"] * block)
    high = F.least(F.col("begin") + F.col("size"), held["block"] * block + F.col("words"))
    pieces = joined.select(held["source"], "key", "tie", "begin", "pass", F.greatest(high - low, F.lit(0)).alias("words"))
    identity = ["key", "tie", "begin"]
    in_pass = pieces.groupBy(*identity, "pass").agg(F.sum("words").alias("words")).where("words > 0")
    passes = in_pass.groupBy(*identity).agg(
        F.sum("words").alias("taken"), F.transform(F.array_sort(F.collect_list(F.struct("pass", "words"))), lambda p: p["words"]).alias("passes")
    )
    mixed = _left_join(placed, passes, identity)
    named = wanted.withColumnRenamed("source", "name")
    mixed = mixed.join(named, mixed["source"].eqNullSafe(named["name"]))
    return mixed.select(
        F.col("key").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        F.coalesce("passes", F.array().cast("array<bigint>")).alias("passes"), "tie",
    )


def mixed_documents(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", size_col=None, **options) -> DataFrame:
    """The documents as the mix holds them: a row for every pass that takes words, cut after the last word taken.

    Rows alike in id and text are put together first; their shares are all kept. ``size_col`` names a column to
    fill with the new length.
    """
    mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    # null is an id too; one shuffle of the texts by these two serves both the grouping and the join
    name = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string")), F.lit(""))
    shares = mixed.where("taken > 0").groupBy(name.alias("_key"), F.col("tie").alias("_tie")).agg(
        F.flatten(F.collect_list("passes")).alias("_passes"), F.first("size").alias("_size")
    )
    texts = docs.withColumn("_key", name).withColumn("_tie", F.xxhash64(text_col)).dropDuplicates(["_key", "_tie"])
    joined = texts.join(shares, ["_key", "_tie"])
    rows = joined.withColumn("_take", F.explode("_passes"))
    head = F.expr(
        f"array_join(slice(regexp_extract_all(`{text_col}`, '[^\\\\x20\\\\x09-\\\\x0D]+', 0), 1, cast(_take AS int)), ' ')"
    )
    text = F.when(F.col("_take") < F.col("_size"), head).otherwise(F.col(text_col))
    columns = {text_col: text}
    if size_col:
        columns[size_col] = F.char_length(text).cast(docs.schema[size_col].dataType)
    return rows.select(*[columns.get(c, texts[c]).alias(c) for c in docs.columns])
