"""Column functions that treat NULL as a value where Spark's own skip it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_distinct_na(c: str | Column) -> Column:
    """Distinct values, NULL being one of them."""
    c = F.col(c) if isinstance(c, str) else c
    return F.count_distinct(c) + F.coalesce(F.max(F.when(c.isNull(), 1)), F.lit(0))


def greatest_na(*columns: Column) -> Column:
    """The largest value; NULL if any is NULL."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(known, F.greatest(*columns))


def paste_na(*parts: Column, sep: str = "_") -> Column:
    """Values joined by ``sep``; a NULL is written NA."""
    return F.concat_ws(sep, *[F.coalesce(p.cast("string"), F.lit("NA")) for p in parts])


def plain_number(c: Column) -> Column:
    """A number as text, without decimals where there are none."""
    c = c.cast("double")
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def weighted_mean_na(x: Column, w: Column) -> Column:
    """Weighted mean; NULL if a value or a weight is NULL."""
    whole = (F.count(x) == F.count(F.lit(1))) & (F.count(w) == F.count(F.lit(1)))
    return F.when(whole, F.try_divide(F.sum(x * w), F.sum(w)))


def sum_na_rm(c: str | Column) -> Column:
    """Sum of the known values, 0 if there are none."""
    return F.coalesce(F.sum(c), F.lit(0.0))


def join_nullsafe(left: DataFrame, right: DataFrame, keys: dict[str, str] | list[str], how: str = "left", null_keys_match: bool = True) -> DataFrame:
    """Equi-join on ``keys`` (left name -> right name) with NULL equal to NULL; right keys don't appear in the result.

    No broadcast is forced: Spark broadcasts the right side where its size is under the session's threshold.
    """
    keys = {k: k for k in keys} if isinstance(keys, list) else keys
    own = {k: f"_right_{k}" for k in keys.values()}
    right = right.withColumnsRenamed(own)
    same = [left[a].eqNullSafe(right[own[b]]) if null_keys_match else left[a] == right[own[b]] for a, b in keys.items()]
    return left.join(right, reduce(lambda a, b: a & b, same), how).drop(*own.values())
