"""Country dimension: code list with the mean temperature of each country."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.values import recode, title_case, to_int
from starloom.lookups import COUNTRY_CODE_NAMES, TEMPERATURE_NAMES
from starloom.operators.aggregates import avg_per_key


def build_country(
    temperature: DataFrame,
    lookup: DataFrame,
    *,
    temperature_names: Mapping[str, str] = TEMPERATURE_NAMES,
    code_names: Mapping[str, str] = COUNTRY_CODE_NAMES,
    recode_first: bool = True,
) -> DataFrame:
    """Every code of ``lookup``, with the mean of ``AverageTemperature`` over the country's readings.

    Names are corrected on both sides and compared without case; a code without readings gets null.
    With ``recode_first`` two names that are corrected to one are averaged together. Without it the
    mean is taken per name as read, and such a country comes once per name.
    """
    name = recode("Country", temperature_names)
    if recode_first:
        readings = temperature.select(F.lower(name).alias("_name"), "AverageTemperature")
        means = avg_per_key(readings, ["_name"], ["AverageTemperature"])
    else:
        means = avg_per_key(temperature, ["Country"], ["AverageTemperature"]).select(
            F.lower(name).alias("_name"), "AverageTemperature"
        )
    codes = lookup.select(
        to_int("Code").alias("Code"),
        F.lower(recode("Country", code_names)).alias("_code_name"),
    )
    return codes.join(means, codes["_code_name"] == means["_name"], "left").select(
        "Code",
        title_case("_code_name").alias("CountryName"),
        F.col("AverageTemperature").cast("double").alias("Temperature"),
    )
