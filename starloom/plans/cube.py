"""Arrivals counted once by the codes that questions ask for, month by month.

One pass over the fact groups it by several sets of codes. Every row keeps partial results that can be added up
(rows, sum, least and greatest age), so that a month that is loaded again replaces its own rows only, and a question is
answered from the smallest set of codes that covers it, without the fact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import CONTRACTS
from starloom.sinks.tables import load_table, qualified

MONTH = ("i94yr", "i94mon")
CODES = ("i94res", "i94addr", "i94visa", "i94mode", "gender")
# From small to large: the first one that holds all codes of a question answers it.
SETS = (("gender",), ("i94visa",), ("i94mode",), ("i94res",), ("i94res", "i94addr"))


def set_name(codes: tuple[str, ...]) -> str:
    return "+".join(codes)


def build_cube(fact: DataFrame) -> DataFrame:
    """One row per month, set of codes and values of these codes. A null code is a value; codes outside the set are null too."""
    grouped = fact.groupingSets([(*MONTH, *codes) for codes in SETS], *MONTH, *CODES)
    names = {sum((c not in codes) << (len(CODES) - 1 - i) for i, c in enumerate(CODES)): set_name(codes) for codes in SETS}
    of = F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), F.grouping_id().cast("int"))
    return grouped.agg(
        of.alias("cube_set"), F.count(F.lit(1)).alias("arrivals"), F.count("i94bir").alias("ages"),
        F.sum("i94bir").alias("age_sum"), F.min("i94bir").alias("age_min"), F.max("i94bir").alias("age_max"),
    )


def load_cube(spark: SparkSession, fact: DataFrame, location: str, database: str | None = None, *, months_only: bool = False) -> int:
    """Load the cube of ``fact``; with ``months_only`` the fact holds some months, and the others' rows stay."""
    contract = CONTRACTS["arrivals_cube"]
    mode = "overwrite_partitions" if months_only else "overwrite"
    return load_table(build_cube(fact), contract, qualified(database, contract.name), mode=mode, location=location)


@dataclass(frozen=True)
class Cube:
    """A loaded cube in the place of the fact: the questions of :mod:`starloom.plans.analytics` take either."""

    rows: DataFrame

    def where(self, condition: Column) -> Cube:
        """Some months of it."""
        return Cube(self.rows.where(condition))

    def _set(self, codes: tuple[str, ...]) -> DataFrame:
        wanted = set(codes) - set(MONTH)
        for known in SETS:
            if wanted <= set(known):
                return self.rows.where(F.col("cube_set") == set_name(known))
        raise ValueError(f"no set of the cube holds {sorted(wanted)}")

    def counts(self, *codes: str) -> DataFrame:
        """Rows of the fact by these codes."""
        return self._set(codes).groupBy(*codes).agg(F.sum("arrivals").alias("_n"))

    def ages(self, *codes: str) -> DataFrame:
        """Rows and ages of the fact by these codes."""
        return self._set(codes).groupBy(*codes).agg(
            F.sum("arrivals").alias("visitors"), F.try_divide(F.sum("age_sum").cast("double"), F.sum("ages").cast("double")).alias("avg_age"),
            F.min("age_min").alias("min_age"), F.max("age_max").alias("max_age"),
        )
