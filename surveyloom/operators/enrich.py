"""Prices: PPP and CPI joins, reporting level and deflated welfare."""

from __future__ import annotations

import re
import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.nulls import join_nullsafe
from surveyloom.functions.schema import DATA_LEVELS, SORT_KEYS, checked_kind
from surveyloom.operators.checks import require_unique, unique_in_plan
from surveyloom.operators.population import level_sums, rescaled, with_factors

CPI_KEY = ["country_code", "survey_year", "survey_acronym", "cpi_data_level"]
PPP_KEY = ["country_code", "ppp_data_level"]


def ppp_version() -> Column:
    """ppp_2017_01_02 from year, release v1 and adaptation v2."""
    parts = [F.col(c).cast("string") for c in ("ppp_year", "release_version", "adaptation_version")]
    return F.regexp_replace(F.concat_ws("_", F.lit("ppp"), *parts), "_v", "_0")


def ppp_to_wide(ppp: DataFrame, versions: list[str] | None = None, validate: bool = True) -> DataFrame:
    """One column per PPP version. Repeated cells are an error, found at once or, without ``validate``, when the rows are read.

    Pass ``versions`` to save the job that finds them.
    """
    named = ppp.withColumn("ppp_version", ppp_version())
    if validate:
        require_unique(named, [*PPP_KEY, "ppp_version"], "PPP")
    versions = versions or sorted(r[0] for r in named.select("ppp_version").distinct().collect())
    cells = named.groupBy(*PPP_KEY).agg(*[cell("ppp", F.col("ppp_version") == v, v) for v in versions])
    return cells


def cell(c: str, where: Column, name: str) -> Column:
    """The only value of ``c`` where a condition holds; a second one is an error."""
    value = F.first(F.when(where, F.col(c)), ignorenulls=True)
    return F.when(F.count(F.when(where, 1)) > 1, F.raise_error(F.lit(f"PPP isn't unique: {name} occurs twice for a country and level")).cast("double")).otherwise(value).alias(name)


def years(names: list[str], prefix: str) -> list[str]:
    """Sorted years in column names such as cpi2011 or ppp_2017_01_02."""
    return sorted({m[1] for n in names if (m := re.match(rf"{prefix}_?([0-9]{{4}})", n))})


def base_years(cpi_columns: list[str], ppp_columns: list[str]) -> list[str]:
    """Years that both price tables have."""
    cpi, ppp = years(cpi_columns, "cpi"), years(ppp_columns, "ppp")
    both = [y for y in cpi if y in ppp]
    if cpi != ppp:
        warnings.warn(f"CPI years {cpi} and PPP years {ppp} differ; only {both} are used", stacklevel=2)
    return both


def price_columns(cpi: DataFrame) -> DataFrame:
    """The CPI table's keys and yearly columns."""
    if "cpi2005_SM21" in cpi.columns:
        cpi = cpi.withColumnRenamed("cpi2005_SM21", "cpi2005")
    return cpi.select(*CPI_KEY, *[c for c in cpi.columns if re.fullmatch(r"cpi[0-9]{4}", c)])


PROFILE_KEY = ["cache_id", *DATA_LEVELS]


def survey_profile(df: DataFrame, kind: str, *sums: Column, by: list[str] = PROFILE_KEY) -> DataFrame:
    """One row per survey and combination of its data levels: the first row's sort key as ``_key``, and ``sums``.

    The only aggregation of the rows that ranks, reporting levels and population factors need.
    """
    return df.groupBy(*by).agg(F.min(F.struct(*SORT_KEYS[checked_kind(kind)])).alias("_key"), *sums)


def level_rank(level: str) -> Column:
    """1 national only, 2 rural before urban, 3 anything else, by the order of the rows' sort key; over a survey's profile rows."""
    survey, v, key = Window.partitionBy("cache_id"), F.col(level), F.col("_key")
    rural, urban = (F.min(F.when(v == x, key)).over(survey) for x in ("rural", "urban"))
    national = F.coalesce(F.bool_or(v == "national").over(survey), F.lit(False))
    other = F.bool_or(~F.coalesce(v.isin("national", "rural", "urban"), F.lit(False))).over(survey)
    return F.when(national & ~other & rural.isNull() & urban.isNull(), 1).when(~national & ~other & (rural <= urban), 2).otherwise(3)


def level_ranks(df: DataFrame, kind: str) -> DataFrame:
    """(cache_id, rank of each data level)."""
    ranks = survey_profile(df, kind).select("cache_id", *[level_rank(c).alias(c) for c in DATA_LEVELS])
    return ranks.groupBy("cache_id").agg(*[F.first(c).alias(c) for c in DATA_LEVELS])


def profile_reporting_level(profile: DataFrame) -> DataFrame:
    """A profile with ``reporting_level``: the value of the data level with the highest rank, the first of equals."""
    ranked = profile.select("*", *[level_rank(c).alias(f"_rank_{c}") for c in DATA_LEVELS])
    most = F.greatest(*[F.col(f"_rank_{c}") for c in DATA_LEVELS])
    value = F.lit(None).cast("string")
    for c in reversed(DATA_LEVELS):
        value = F.when(F.col(f"_rank_{c}") == most, F.col(c)).otherwise(value)
    return ranked.select(*profile.columns, value.alias("reporting_level"))


def with_reporting_level(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``reporting_level``: the data level of the highest rank, the first of equals."""
    found = profile_reporting_level(survey_profile(df, kind)).drop("_key")
    return join_nullsafe(df, found, PROFILE_KEY)


def with_level_and_population(df: DataFrame, pop: DataFrame, kind: str) -> DataFrame:
    """``adjust_population`` after ``with_reporting_level``, from one aggregation of the rows."""
    by = [*PROFILE_KEY, "country_code", "survey_year"]
    levelled = profile_reporting_level(survey_profile(df, kind, *level_sums(), by=by)).drop("_key")
    found = with_factors(levelled, pop).drop("weight", "_grouped")
    return join_nullsafe(df, found, by).withColumn("weight", rescaled()).drop("_adjust")


def deflated(welfare: Column, ppp: Column, cpi: Column) -> Column:
    """Welfare in PPP terms; an assumption of this library (see README). NULL where a price is zero or unknown."""
    return F.try_divide(welfare, ppp * cpi)


def with_prices(df: DataFrame, cpi: DataFrame, ppp: DataFrame, versions: list[str] | None = None, validate: bool = True) -> DataFrame:
    """PPP and CPI columns, ``welfare_lcu`` and one ``welfare_ppp_*`` column per PPP version of a base year."""
    wide = ppp_to_wide(ppp, versions, validate)
    prices = price_columns(cpi)
    prices = require_unique(prices, CPI_KEY, "CPI") if validate else unique_in_plan(prices, CPI_KEY, "CPI")
    df = join_nullsafe(join_nullsafe(df, wide, PPP_KEY), prices, CPI_KEY)
    used = [(v, f"cpi{y}") for y in base_years(prices.columns, wide.columns) for v in wide.columns if v.startswith(f"ppp_{y}")]
    return df.select("*", F.col("welfare").alias("welfare_lcu"), *[deflated(F.col("welfare"), F.col(v), F.col(c)).alias(f"welfare_{v}") for v, c in used])


def add_survey_vars(
    df: DataFrame, cpi: DataFrame, ppp: DataFrame, pop: DataFrame, kind: str, versions: list[str] | None = None, validate: bool = True
) -> DataFrame:
    """Reporting level, prices, deflated welfare and population-adjusted weights."""
    last = ["reporting_level", "pop_fact"]
    priced = with_prices(with_level_and_population(df, pop, kind), cpi, ppp, versions, validate)
    return priced.select(*df.columns, "reporting_level", *[c for c in priced.columns if c not in (*df.columns, *last)], "pop_fact")
