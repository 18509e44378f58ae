"""Weights scaled to national-accounts population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.nulls import join_nullsafe, sum_na_rm, weighted_mean_na

UNIT = ["cache_id", "country_code", "survey_year", "reporting_level"]


def survey_totals(df: DataFrame) -> DataFrame:
    """Weight by survey and reporting level."""
    return df.groupBy(*UNIT).agg(sum_na_rm("weight").alias("weight"))


def nearest_year_pop(pop: DataFrame, totals: DataFrame) -> DataFrame:
    """Population rows of the years nearest to each survey level (ties stay), with weights of one over the distance."""
    both = totals.join(
        pop.select(F.col("country_code").alias("_country"), F.col("pop_data_level").alias("_level"), "year", "pop"),
        F.col("country_code").eqNullSafe(F.col("_country")) & F.col("reporting_level").eqNullSafe(F.col("_level")),
    ).drop("_country", "_level")
    both = both.withColumn("diff_year", F.abs(F.col("year") - F.col("survey_year")))
    least = F.min("diff_year").over(Window.partitionBy("cache_id", "reporting_level"))
    near = both.withColumn("_least", least).where("diff_year = _least").drop("_least")
    return near.withColumn("wght", F.when(F.col("diff_year") == 0, 1.0).otherwise(F.try_divide(F.lit(1.0), F.col("diff_year"))))


def pop_factor(pop: DataFrame, totals: DataFrame) -> DataFrame:
    """(cache_id, reporting_level, pop_fact)."""
    near = nearest_year_pop(pop, totals)
    means = near.groupBy("cache_id", "reporting_level").agg(weighted_mean_na(F.col("pop"), F.col("wght")).alias("pop"), weighted_mean_na(F.col("weight"), F.col("wght")).alias("weight"))
    return means.select("cache_id", "reporting_level", F.try_divide("pop", "weight").alias("pop_fact"))


def nearest_years(pop: DataFrame) -> DataFrame:
    """(country_code, pop_data_level, years): the population of each year as an array, one row per country and level."""
    return pop.groupBy("country_code", "pop_data_level").agg(F.collect_list(F.struct(F.col("year").cast("double").alias("year"), F.col("pop").cast("double").alias("pop"))).alias("_years"))


def with_factors(levels: DataFrame, pop: DataFrame) -> DataFrame:
    """``levels`` with ``_adjust`` and ``pop_fact``, by windows over a few rows per survey.

    ``levels`` holds the columns of ``UNIT``, ``weight`` (known sums) and ``_grouped``; several rows of one unit add up.
    """
    survey, unit, level = (Window.partitionBy(*k) for k in (["cache_id"], UNIT, ["cache_id", "reporting_level"]))
    one = F.row_number().over(unit.orderBy("weight")) == 1
    several = F.size(F.collect_set("reporting_level").over(survey)) + F.max(F.col("reporting_level").isNull().cast("int")).over(survey) > 1
    total = levels.select("*", several.alias("_several"), F.bool_or("_grouped").over(survey).alias("_any"), F.sum("weight").over(unit).alias("_total"), one.alias("_one"))
    both = join_nullsafe(total, nearest_years(pop), {"country_code": "country_code", "reporting_level": "pop_data_level"})
    far = lambda x: F.abs(x["year"] - F.col("survey_year"))
    # each unit counts once, by its nearest years
    least = F.min(F.when(F.col("_one"), F.array_min(F.transform("_years", far)))).over(level)
    near = both.withColumn("_least", least).withColumn("_near", F.when(F.col("_one"), F.filter("_years", lambda x: far(x) == F.col("_least"))))
    share = F.when(F.col("_least") == 0, 1.0).otherwise(F.try_divide(F.lit(1.0), F.col("_least")))
    n = F.coalesce(F.greatest(F.size("_near"), F.lit(0)), F.lit(0))
    people = F.aggregate("_near", F.lit(0.0).cast("double"), lambda s, x: s + x["pop"])
    sums = near.select(
        "*", F.sum(n * share).over(level).alias("_w"), F.sum(F.when(n > 0, people * share)).over(level).alias("_pw"), F.sum(n * share * F.col("_total")).over(level).alias("_tw"),
        F.bool_or(F.exists("_near", lambda x: x["pop"].isNull())).over(level).alias("_unknown"),
    )
    fact = F.try_divide(F.try_divide("_pw", "_w"), F.try_divide("_tw", "_w"))
    adjust = F.col("_several") & ~F.col("_any")
    return sums.select(*levels.columns, adjust.alias("_adjust"), F.when(adjust & ~F.coalesce("_unknown", F.lit(False)), fact).alias("pop_fact"))


def level_sums() -> list[Column]:
    """Aggregates of survey rows that ``with_factors`` needs."""
    return [sum_na_rm("weight").alias("weight"), F.coalesce(F.bool_or(F.col("distribution_type").isin("group", "aggregate")), F.lit(False)).alias("_grouped")]


def rescaled() -> Column:
    return F.when(F.col("_adjust"), F.col("weight") * F.col("pop_fact")).otherwise(F.col("weight"))


def adjust_population(df: DataFrame, pop: DataFrame) -> DataFrame:
    """Surveys with several reporting levels whose data isn't grouped get ``weight * pop_fact``; others keep their weight (``pop_fact`` NULL).

    A level without population gets a NULL weight. One aggregation of the rows and one join back.
    """
    found = with_factors(df.groupBy(*UNIT).agg(*level_sums()), pop).drop("weight", "_grouped")
    return join_nullsafe(df, found, UNIT).withColumn("weight", rescaled()).drop("_adjust")
