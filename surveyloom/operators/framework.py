"""The framework: one or two metadata rows per survey, with their cache ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.nulls import greatest_na, join_nullsafe, paste_na, plain_number
from surveyloom.functions.schema import DOMAINS, SURVEY_KEY
from surveyloom.operators.checks import SurveyError, require_columns, require_unique, unique_in_plan


def reporting_level(framework: DataFrame) -> DataFrame:
    """Surveys in use (``inpovcal`` 1) with the largest of their domains as text; NULL if a domain is NULL."""
    used = framework.where("inpovcal = 1")
    return used.withColumn("reporting_level", greatest_na(*[F.col(c) for c in DOMAINS]).cast("bigint").cast("string"))


def long_type(c: Column) -> Column:
    """consumption or income by the first letter, else empty."""
    return F.when(c.rlike("^[Cc]"), "consumption").when(c.rlike("^[Ii]"), "income").otherwise("")


def short_type(c: Column) -> Column:
    return F.when(c == "income", "INC").when(c == "consumption", "CON").otherwise("")


def with_alternatives(framework: DataFrame) -> DataFrame:
    """One more row (``is_alt_welf``) for each survey with a second welfare measure; its own type is NULL there."""
    # rows are doubled where they are read: a union would read the framework twice
    measures = F.when(F.col("oth_welfare1_type") != "", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = framework.withColumn("is_alt_welf", F.explode(measures))
    alt = F.col("is_alt_welf")
    return rows.withColumns({
        "welfare_type": F.when(alt, long_type(F.col("oth_welfare1_type"))).otherwise(F.col("welfare_type")),
        "oth_welfare1_type": F.when(~alt, F.col("oth_welfare1_type")),
    })


def with_cache_id(framework: DataFrame) -> DataFrame:
    """Adds ``wt`` and ``cache_id``; ``module`` comes from the survey data."""
    return with_cache_prefix(framework).withColumn("cache_id", cache_id(F.col("cache_prefix"), F.col("module"))).drop("cache_prefix")


def with_cache_prefix(framework: DataFrame) -> DataFrame:
    """Adds ``wt`` and all of the cache id that doesn't depend on the data's module."""
    return framework.withColumn("wt", short_type(F.col("welfare_type"))).withColumn(
        "cache_prefix",
        paste_na(F.col("country_code"), plain_number(F.col("surveyid_year")), F.col("survey_acronym"), F.concat(F.lit("D"), F.coalesce("reporting_level", F.lit("NA"))), F.col("wt")),
    )


def cache_id(prefix: Column, module: Column) -> Column:
    return F.concat(prefix, F.lit("_"), F.coalesce(module, F.lit("")))


def other_type() -> Column:
    """Short code of the second measure, NULL where there is none."""
    return F.when(F.col("oth_welfare1_type") != "", short_type(long_type(F.col("oth_welfare1_type"))))


def all_frameworks(pfw: DataFrame, alternatives: bool = True) -> DataFrame:
    """Framework rows of all surveys in use, with ``cache_prefix``: they meet the survey rows without a look at these first.

    The key of the whole of ``pfw`` is checked where its rows are read, and so is that a survey's two measures have different
    cache ids: a repeated key stops the run that would multiply survey rows, without a job of its own.
    """
    rows = reporting_level(unique_in_plan(pfw, SURVEY_KEY, "framework")).drop("module")
    if not alternatives:
        return with_cache_prefix(rows.withColumn("is_alt_welf", F.lit(False)))
    alike = (F.col("inpovcal") == 1) & short_type(F.col("welfare_type")).eqNullSafe(other_type())
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in SURVEY_KEY])
    error = F.raise_error(F.concat(F.lit("framework after alternatives isn't unique by cache_id: both measures of ["), shown, F.lit("] have one type")))
    # in a filter, as a column could be left out of the plan
    checked = rows.where(F.when(alike, error.cast("boolean")).otherwise(True))
    return with_cache_prefix(with_alternatives(checked))


def survey_framework(surveys: DataFrame, pfw: DataFrame, alternatives: bool = True, validate: bool = True) -> DataFrame:
    """Framework rows of the surveys found in ``surveys`` (any table with the survey key and, if known, ``module``).

    ``validate`` runs small checks first: the key is unique in the whole of
    ``pfw``, every survey has a row in use, and no two rows share a cache id.
    """
    require_columns(surveys, SURVEY_KEY, "survey data")
    keys = surveys.select(*SURVEY_KEY, F.col("module") if "module" in surveys.columns else F.lit(None).cast("string").alias("module")).distinct()
    rows = join_nullsafe(keys, reporting_level(pfw).drop("module"), SURVEY_KEY, "inner")
    out = with_cache_id(with_alternatives(rows) if alternatives else rows.withColumn("is_alt_welf", F.lit(False)))
    if validate:
        require_unique(pfw, SURVEY_KEY, "framework")
        lost = keys.join(rows.select(*SURVEY_KEY), SURVEY_KEY, "left_anti").first()
        if lost is not None:
            raise SurveyError(f"framework has no row in use for {[lost[k] for k in SURVEY_KEY]}")
        require_unique(out, ["cache_id"], "framework after alternatives")
    return out
