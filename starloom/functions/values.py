"""Recoding, labels, casts, missing values and weighted means."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(values.items())])


def recode(value: Column | str, mapping: Mapping) -> Column:
    """Replace listed values; every other value, null included, is kept."""
    if not mapping:
        return _col(value)
    return F.coalesce(F.element_at(_literal_map(mapping), _col(value)), _col(value))


def code_label(code: Column | str, labels: Mapping, default: str | None = None) -> Column:
    """Label of a code; ``default`` (or null) for a code that is not listed."""
    found = F.element_at(_literal_map(labels), _col(code))
    return found if default is None else F.coalesce(found, F.lit(default))


def title_case(name: Column | str) -> Column:
    return F.initcap(F.lower(_col(name)))


def to_int(value: Column | str) -> Column:
    """Cast to int; fractions are cut, text such as ``"12.0"`` is accepted, anything else is null."""
    return _col(value).try_cast("double").try_cast("int")


def to_bigint(value: Column | str) -> Column:
    """As :func:`to_int`; whole numbers are exact, those written with a fraction up to 2^53."""
    return F.coalesce(_col(value).try_cast("bigint"), _col(value).try_cast("double").try_cast("bigint"))


def is_missing(name: str, data_type: T.DataType) -> Column:
    """Null, or NaN where the type has NaN."""
    c = F.col(f"`{name}`")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def weighted_mean(value: Column | str, weight: Column | str, missing: str = "zero") -> Column:
    """Aggregate sum(value * weight) / sum(weight) as double; null when the weights sum to 0.

    ``missing="zero"`` counts a missing value as 0 with its full weight; ``missing="skip"`` leaves
    the row out of both sums.
    """
    v, w = _col(value), _col(weight)
    if missing == "zero":
        total, weights = F.coalesce(v, F.lit(0)) * F.coalesce(w, F.lit(0)), F.coalesce(w, F.lit(0))
    elif missing == "skip":
        total, weights = v * w, F.when(v.isNotNull(), w)
    else:
        raise ValueError(f"missing must be 'zero' or 'skip', not {missing!r}")
    return F.try_divide(
        F.sum(total).cast("double"), F.sum(weights).cast("double")
    )
