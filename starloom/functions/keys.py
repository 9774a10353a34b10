"""Surrogate key expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_key(*parts: Column | str) -> Column:
    """MD5 of the concatenated text of the parts; null if any part is null.

    A repeatable key: the same row gets the same key in every run. At 10^12 rows a 64-bit hash
    would already collide, 128 bits do not.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.md5(F.concat(*texts))


def separated_md5_key(*parts: Column | str) -> Column:
    """MD5 of the parts with a separator between them, so that ("1", "23") and ("12", "3") differ.

    Never null: a null part is another value than any text.
    """
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    marked = [F.coalesce(F.concat(F.lit("="), t), F.lit("")) for t in texts]
    return F.md5(F.concat_ws("\x1f", *marked))


def identity_key(start: int = 0) -> Column:
    """Unique increasing bigint for rows that are written once; gaps occur, as with identity columns.

    Costs no shuffle. Values change between runs, so write the frame before using it twice.
    """
    return F.monotonically_increasing_id() + F.lit(start)
