"""Questions asked of the two star schemas.

Each one first counts the fact by the codes it needs, so what is joined to the dimensions is as
small as the number of distinct codes, however the rows are spread over them. A loaded
:class:`~starloom.plans.cube.Cube` answers the questions about arrivals as the fact does.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import code_label, weighted_mean
from starloom.lookups import MODE_LABELS, VISA_LABELS
from starloom.operators.joins import star_join
from starloom.plans.cube import Cube

# Upper bounds in degrees of each climate class; the last class has none.
CLIMATE_BOUNDS = ((0.0, "cold"), (10.0, "cool"), (20.0, "mild"))
WARMEST = "warm"


def _arrivals(fact: DataFrame | Cube, *codes: str) -> DataFrame:
    if isinstance(fact, Cube):
        return fact.counts(*codes)
    return fact.groupBy(*codes).agg(F.count(F.lit(1)).alias("_n"))


def arrivals_by_country(
    fact: DataFrame | Cube,
    country: DataFrame,
    years: tuple[int, int] | None = None,
) -> DataFrame:
    """Arrivals per country of residence, year and month, for an inclusive range of years."""
    if years is not None:
        fact = fact.where(F.col("i94yr").between(*years))
    counts = _arrivals(fact, "i94res", "i94yr", "i94mon")
    return (
        star_join(counts, (country, "i94res", "Code"))
        .groupBy("CountryName", "i94yr", "i94mon")
        .agg(F.sum("_n").alias("arrivals"))
    )


def _arrivals_by_label(
    fact: DataFrame | Cube, code: str, label: str, labels: Mapping[int, str]
) -> DataFrame:
    return _arrivals(fact, code).select(
        F.col(code), code_label(code, labels, "unknown").alias(label), F.col("_n").alias("arrivals")
    )


def arrivals_by_visa(fact: DataFrame | Cube) -> DataFrame:
    return _arrivals_by_label(fact, "i94visa", "visa", VISA_LABELS)


def arrivals_by_mode(fact: DataFrame | Cube) -> DataFrame:
    return _arrivals_by_label(fact, "i94mode", "mode", MODE_LABELS)


def climate(
    temperature: Column,
    bounds: Sequence[tuple[float, str]] = CLIMATE_BOUNDS,
    warmest: str = WARMEST,
) -> Column:
    classes = reduce(
        lambda chain, bound: chain.when(temperature < bound[0], bound[1]),
        bounds,
        F.when(temperature.isNull(), "unknown"),
    )
    return classes.otherwise(warmest)


def arrivals_by_climate(
    fact: DataFrame | Cube,
    country: DataFrame,
    bounds: Sequence[tuple[float, str]] = CLIMATE_BOUNDS,
    warmest: str = WARMEST,
) -> DataFrame:
    """Arrivals per climate class of the country of residence."""
    return (
        star_join(_arrivals(fact, "i94res"), (country, "i94res", "Code"))
        .groupBy(climate(F.col("Temperature"), bounds, warmest).alias("climate"))
        .agg(F.sum("_n").alias("arrivals"))
    )


def visitor_stats(fact: DataFrame | Cube) -> DataFrame:
    if isinstance(fact, Cube):
        return fact.ages("gender")
    return fact.groupBy("gender").agg(
        F.count(F.lit(1)).alias("visitors"),
        F.avg("i94bir").alias("avg_age"),
        F.min("i94bir").alias("min_age"),
        F.max("i94bir").alias("max_age"),
    )


def origin_by_state(fact: DataFrame | Cube, country: DataFrame, state: DataFrame) -> DataFrame:
    """Per country of residence: arrivals, states addressed, and what those states look like,
    weighted with the arrivals that name them.
    """
    pairs = star_join(
        _arrivals(fact, "i94res", "i94addr"),
        (country, "i94res", "Code"),
        (state, "i94addr", "StateCode"),
    )
    return pairs.groupBy("CountryName").agg(
        F.sum("_n").alias("arrivals"),
        F.count_if(F.col("StateCode").isNotNull()).alias("state_pairs"),
        weighted_mean("MedianAge", "_n", "skip").alias("mean_median_age"),
        weighted_mean("ForeignBorn", "_n", "skip").alias("mean_foreign_born"),
        weighted_mean("TotalPopulation", "_n", "skip").alias("mean_population"),
    )


def song_plays(songplays: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Plays per song, with title and artist; plays of unknown songs are counted under null."""
    counts = songplays.groupBy("song_id", "artist_id").agg(F.count(F.lit(1)).alias("plays"))
    title = songs.select(F.col("song_id").alias("_song"), "title")
    name = artists.select(F.col("artist_id").alias("_artist"), F.col("name").alias("artist"))
    return star_join(counts, (title, "song_id", "_song"), (name, "artist_id", "_artist")).select(
        "song_id", "title", "artist", "plays"
    )
