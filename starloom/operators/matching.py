"""Names that are written differently on two sides: candidates by shared character trigrams, ranked with the edit distance.

A pair is a candidate if the shorter name has at least a share ``least`` of its trigrams in the longer one. Any
such pair shares one of the shorter name's rarest trigrams, as many as could be missing plus one; only these are looked up, so that common
trigrams bring no pairs together and yet no candidate is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 0.6
TOP = 3


def plain_name(name: Column | str) -> Column:
    """Lower case, and one space for whatever is neither letter nor digit."""
    name = F.col(name) if isinstance(name, str) else name
    return F.trim(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def trigrams(plain: Column) -> Column:
    padded = F.concat(F.lit(" "), plain, F.lit(" "))
    places = F.sequence(F.lit(1), F.greatest(F.length(padded) - 2, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.substring(padded, i, F.lit(3))))


def _named(df: DataFrame, column: str) -> DataFrame:
    names = df.select(F.col(column).cast("string").alias("name")).where(plain_name("name") != "").distinct()
    return names.withColumn("plain", plain_name("name")).withColumn("grams", trigrams(F.col("plain")))


def _rarest(names: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """Each name with its rarest trigrams, of which a candidate has one at least."""
    one = names.select("name", F.explode("grams").alias("gram")).join(counts, "gram")
    # a name has few trigrams: this list is as long as the name
    ordered = one.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("o"))
    size = F.size("o")
    enough = (size - F.ceil(size * F.lit(least)) + 1).cast("int")
    return ordered.select("name", F.explode(F.slice("o", F.lit(1), enough)).alias("s")).select("name", "s.gram")


def name_candidates(
    left: DataFrame, left_column: str, right: DataFrame, right_column: str, *, least: float = LEAST, top: int = TOP
) -> DataFrame:
    """``name``, ``candidate``, ``overlap``, ``edit`` and ``rank``: for each name on the left at most ``top`` names on the right.

    ``overlap`` is the share of the shorter name's trigrams in the longer one, ``edit`` one minus the edit distance per
    character of the longer name. Ties go to the smaller name. Names without a letter or digit have no candidates.
    """
    a, b = _named(left, left_column), _named(right, right_column)
    counts = a.union(b).select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))

    def grams(names: DataFrame) -> DataFrame:
        return names.select("name", F.explode("grams").alias("gram"))

    def met(ours: DataFrame, theirs: DataFrame) -> DataFrame:
        pairs = ours.withColumnRenamed("name", "_a").join(theirs.withColumnRenamed("name", "_b"), "gram")
        return pairs.select("_a", "_b")

    pairs = met(_rarest(a, counts, least), grams(b)).union(met(grams(a), _rarest(b, counts, least))).distinct()
    both = pairs.join(a.select(F.col("name").alias("_a"), F.col("plain").alias("_pa"), F.col("grams").alias("_ga")), "_a")
    both = both.join(b.select(F.col("name").alias("_b"), F.col("plain").alias("_pb"), F.col("grams").alias("_gb")), "_b")
    overlap = F.size(F.array_intersect("_ga", "_gb")) / F.least(F.size("_ga"), F.size("_gb"))
    edit = 1 - F.levenshtein("_pa", "_pb") / F.greatest(F.length("_pa"), F.length("_pb"))
    scored = both.select(F.col("_a").alias("name"), F.col("_b").alias("candidate"), overlap.alias("overlap"), edit.alias("edit"))
    order = Window.partitionBy("name").orderBy(F.desc("overlap"), F.desc("edit"), "candidate")
    kept = scored.where(F.col("overlap") >= least).withColumn("rank", F.row_number().over(order))
    return kept.where(F.col("rank") <= top)
