"""Validation that stops a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SurveyError(ValueError):
    """Input that breaks a rule of harmonisation."""


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df``, or an error if ``keys`` repeat: the right side of a many-to-one join must not multiply rows."""
    example = repeated_keys(df, keys).first()
    if example is not None:
        raise SurveyError(f"{what} isn't unique by {', '.join(keys)}: {[example[k] for k in keys]} occurs {example['n']} times")
    return df


def unique_in_plan(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df``, with an error when its rows are read if ``keys`` repeat; no job of its own. For small tables: they are grouped.

    NULL counts as a value. The error names the key, so it can be found in a batch of many surveys.
    """
    rest = [c for c in df.columns if c not in keys]
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    message = F.concat(F.lit(f"{what} isn't unique by {', '.join(keys)}: ["), shown, F.lit("] occurs "), F.count(F.lit(1)).cast("string"), F.lit(" times"))
    twice = F.when(F.count(F.lit(1)) > 1, F.raise_error(message)).cast("boolean")
    own = df.groupBy(*keys).agg(twice.alias("_twice"), *[F.first(c).alias(c) for c in rest])
    return own.where("_twice IS NULL").select(*df.columns)


def require_columns(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SurveyError(f"{what} lacks {', '.join(missing)}")
