"""State dimension: city demographics rolled up to states."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import weighted_mean
from starloom.lookups import RACES
from starloom.operators.aggregates import sum_where

# Column of the city file -> column of the dimension.
_COUNTS = {
    "Total Population": "TotalPopulation",
    "Male Population": "MalePopulation",
    "Female Population": "FemalePopulation",
    "Foreign-born": "ForeignBorn",
    "Number of Veterans": "NumberOfVeterans",
}
_MEANS = {"Median Age": "MedianAge", "Average Household Size": "AverageHouseholdSize"}


def city_measures(demographics: DataFrame, races: Mapping[str, str] = RACES) -> DataFrame:
    """One row per city: its measures (repeated on every input row, so the least is taken) and one
    count per group. Both come from a single grouping, and rows without a full key are left out.
    """
    key = {"City": "City", "State": "State", "State Code": "StateCode"}
    keyed = demographics.where(" AND ".join(f"`{c}` IS NOT NULL" for c in key))
    return keyed.groupBy(*[F.col(f"`{c}`").alias(name) for c, name in key.items()]).agg(
        *[F.min(f"`{c}`").alias(name) for c, name in (_COUNTS | _MEANS).items()],
        *sum_where("Count", "Race", races),
    )


def build_state(
    demographics: DataFrame, races: Mapping[str, str] = RACES, missing: str = "zero"
) -> DataFrame:
    """One row per state: summed counts, and means weighted with the population of each city.

    A missing count is 0. ``missing="zero"`` also lets a city without a mean enter it as 0;
    ``"skip"`` leaves that city out of the mean.
    """
    counts = [*_COUNTS.values(), *races.values()]
    cities = city_measures(demographics, races).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts}
    )
    return cities.groupBy("State", "StateCode").agg(
        *[F.sum(c).alias(c) for c in counts],
        *[weighted_mean(c, "TotalPopulation", missing).alias(c) for c in _MEANS.values()],
    )
