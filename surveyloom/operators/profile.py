"""Columns that hold a single value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def single_valued_flags(df: DataFrame) -> DataFrame:
    """One row with a boolean for each column: whether it holds one value, NULL counting as a value.

    One pass of minima, maxima and counts: no distinct aggregation and no Expand.
    """
    rows = F.count(F.lit(1))
    return df.agg(*[(((F.count(c) == rows) & F.min(c).eqNullSafe(F.max(c))) | (F.count(c) == 0)).__and__(rows > 0).alias(c) for c in df.columns])


def distinct_counts(df: DataFrame) -> DataFrame:
    """(variable, n_values): distinct values of each column, NULL counting as a value; nothing for an empty table.

    Columns of one type are stacked and grouped by column and value, so a group is two values wide; counts of distinct values
    side by side would make each row as many rows of all columns.
    """
    by_type: dict[str, list[str]] = {}
    for c, t in df.dtypes:
        by_type.setdefault(t, []).append(c)
    counts = []
    for names in by_type.values():
        cells = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"`{c}`").alias("value")) for k, c in enumerate(names)])
        groups = df.select(F.inline(cells)).groupBy("k", "value").agg(F.lit(1).alias("one"))
        found = groups.groupBy("k").agg(F.count("one").alias("n_values"))
        counts.append(found.select(F.get(F.array(*map(F.lit, names)), F.col("k")).alias("variable"), "n_values"))
    return reduce(DataFrame.unionByName, counts)


def uniq_vars(df: DataFrame) -> list[str]:
    """Names of the columns that hold a single value, in order."""
    flags = single_valued_flags(df).first()
    return [c for c in df.columns if flags[c]]


def uniq_vars_to_list(df: DataFrame) -> dict[str, object]:
    """The single-valued columns and their values."""
    names = uniq_vars(df)
    if not names:
        return {}
    row = df.agg(*[F.min(c).alias(c) for c in names]).first()
    return {c: row[c] for c in names}


def uniq_vars_to_attr(df: DataFrame) -> tuple[DataFrame, dict[str, object]]:
    """``df`` without its single-valued columns, and these as a dictionary (also in the first remaining column's metadata)."""
    values = uniq_vars_to_list(df)
    rest = df.drop(*values)
    if rest.columns and values:
        rest = rest.withMetadata(rest.columns[0], {"single_valued": {k: None if v is None else str(v) for k, v in values.items()}})
    return rest, values
