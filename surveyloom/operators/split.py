"""One set of rows for each welfare measure of a survey."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.schema import SURVEY_KEY
from surveyloom.operators.framework import cache_id

PREFIX = "fw_"
NUMBERS = ("double", "float", "integer", "long", "short", "byte")


def with_framework(df: DataFrame, framework: DataFrame) -> DataFrame:
    """Survey rows with ``cache_id`` and the framework's values in columns with the prefix ``fw_``.

    ``framework`` is that of the surveys (``survey_framework``) or of all surveys (``all_frameworks``). A NULL in the survey
    key meets nothing, so the join is a plain equality and Spark can prune the folders of a table that is partitioned by the
    key; a NULL module meets a NULL module.
    """
    own = framework.withColumnsRenamed({c: PREFIX + c for c in framework.columns if c != "cache_id"})
    keys = [df[k] == own[PREFIX + k] for k in SURVEY_KEY]
    if "cache_prefix" in framework.columns:
        module = F.col("module") if "module" in df.columns else F.lit(None)
        found = df.join(own, keys).withColumn("cache_id", cache_id(F.col(PREFIX + "cache_prefix"), module))
        return found.drop(PREFIX + "cache_prefix", *[PREFIX + k for k in SURVEY_KEY])
    modules = ["module"] if "module" in df.columns else []
    found = df.join(own, [*keys, *[df[m].eqNullSafe(own[PREFIX + m]) for m in modules]])
    return found.drop(*[PREFIX + k for k in (*SURVEY_KEY, *modules)])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in NUMBERS or f.dataType.typeName().startswith("decimal")]


def alternative_columns(df: DataFrame, framework: DataFrame) -> list[str]:
    """The numeric columns of ``df`` that a framework table names as second measure: a small job on the framework alone."""
    named = framework.select("oth_welfare1_var").where(F.col("oth_welfare1_var").isin(numeric_columns(df))).distinct()
    return sorted(r[0] for r in named.collect())


def named_column(names: list[str], name: Column) -> Column:
    """The value of the column whose name a row holds."""
    return F.coalesce(*[F.when(name == c, F.col(c).cast("double")) for c in names], F.lit(None).cast("double"))


def split_alt_welfare(df: DataFrame, framework: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Survey rows, twice where the survey has an alternative measure.

    On the second set ``welfare`` is the column that the framework names and
    ``welfare_type`` the short code; on the first an existing ``welfare_type``
    column stays. ``names`` are the columns that the framework may name; without
    them they are looked up in it now, so that the scan reads no other column. A
    second measure of none of these columns is an error when rows of its survey
    are read.
    """
    names = alternative_columns(df, framework) if names is None else names
    both = with_framework(df, framework)
    alt, name = F.col("fw_is_alt_welf"), F.col("fw_oth_welfare1_var")
    kept = F.col("welfare_type") if "welfare_type" in df.columns else F.col("fw_wt")
    unknown = F.raise_error(F.concat(F.lit("no numeric column "), F.coalesce(name, F.lit("NULL")), F.lit(" for the second measure of "), F.col("cache_id")))
    found = F.when(F.coalesce(name.isin(names), F.lit(False)), named_column(names, name)).otherwise(unknown.cast("double"))
    return both.withColumns({
        "welfare": F.when(alt, found).otherwise(F.col("welfare").cast("double")),
        "welfare_type": F.when(alt, F.col("fw_wt")).otherwise(kept),
    })
