"""Registered survey queries and their DuckDB equivalents, written independently of each other."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveyloom.functions.schema import CLEAN_COLUMNS, CLEAN_TYPES, DATA_LEVELS, SURVEY_KEY
from surveyloom.operators import checks, clean, enrich, framework, population, profile, split, validity
from surveyloom.plans import batch, pipeline
from surveyloom.plans.adapters import ctes, view
from surveyloom.sources import inventory, surveys, versions
from surveyloom.sources.config import Locations, scratch

FLAGSHIP = "welfare_ppp"
#: Versions of the PPP adapter; naming them saves the job that finds them.
VERSIONS = ["ppp_2011_01_01", "ppp_2011_02_01", "ppp_2017_01_02"]
#: Columns that the framework adapter names as second measures.
ALTERNATIVES = ["alt_welfare"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    """Doubles rounded: their sums depend on the order of rows."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def sql_rounded(columns: dict[str, str] | list[str], source: str, places: int = 4) -> str:
    doubles = {*[c for c, t in CLEAN_TYPES.items() if t == "double"], "welfare_lcu", "pop_fact", "pop", "wght", "diff_year", "year"}
    real = lambda c: c in doubles or c.startswith(("cpi2", "ppp_2", "welfare_ppp_"))
    return "SELECT " + ", ".join(f"round({c}, {places}) AS {c}" if real(c) else c for c in columns) + f" FROM {source}"


def micro(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "md")


def pfw(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "pfw")


def micro_framework(spark: SparkSession, d: str) -> DataFrame:
    return framework.survey_framework(micro(spark, d), pfw(spark, d), validate=False)


def micro_rows(spark: SparkSession, d: str) -> DataFrame:
    return split.split_alt_welfare(micro(spark, d), framework.all_frameworks(pfw(spark, d)), ALTERNATIVES)


def group_rows(spark: SparkSession, d: str) -> DataFrame:
    gd = view(spark, d, "gd").drop("bin")
    return split.with_framework(gd, framework.all_frameworks(pfw(spark, d), alternatives=False))


# ---- DuckDB building blocks ----

_LEVEL = """CASE WHEN cpi_domain IS NOT NULL AND ppp_domain IS NOT NULL AND gdp_domain IS NOT NULL AND pce_domain IS NOT NULL AND pop_domain IS NOT NULL
  THEN CAST(greatest(cpi_domain, ppp_domain, gdp_domain, pce_domain, pop_domain) AS VARCHAR) END"""
_WT = "CASE welfare_type WHEN 'income' THEN 'INC' WHEN 'consumption' THEN 'CON' ELSE '' END"
_ALT_TYPE = "CASE WHEN regexp_matches(oth_welfare1_type, '^[Cc]') THEN 'consumption' WHEN regexp_matches(oth_welfare1_type, '^[Ii]') THEN 'income' ELSE '' END"


def sql_framework(data: str, alternatives: bool = True) -> str:
    """CTEs used, both_rows and fw (the framework of the surveys in ``data``)."""
    alt = f" UNION ALL SELECT * EXCLUDE (welfare_type), {_ALT_TYPE} AS welfare_type, true AS is_alt FROM used WHERE oth_welfare1_type <> ''" if alternatives else ""
    return f""", used AS (
  SELECT p.*, k.module, {_LEVEL} AS level FROM pfw p JOIN (SELECT DISTINCT country_code, surveyid_year, survey_acronym, module FROM {data}) k USING (country_code, surveyid_year, survey_acronym)
  WHERE inpovcal = 1
), both_rows AS (SELECT * EXCLUDE (welfare_type), welfare_type, false AS is_alt FROM used{alt}),
fw AS (SELECT *, {_WT} AS wt, country_code || '_' || CAST(CAST(surveyid_year AS BIGINT) AS VARCHAR) || '_' || survey_acronym || '_D' || coalesce(level, 'NA') || '_' || {_WT} || '_' || module AS cache_id FROM both_rows)"""


#: Microdata rows of both measures with framework columns.
_SPLIT = """, rows AS (
  SELECT fw.cache_id, m.country_code, m.surveyid_year, m.survey_acronym, m.hhid, m.pid, CASE WHEN fw.is_alt THEN m.alt_welfare ELSE m.welfare END AS welfare, m.alt_welfare,
    m.weight_p, m.urban, m.male, m.educat4, m.educat5, m.literacy, fw.wt AS welfare_type, fw.survey_year, fw.use_imputed, fw.cpi_domain, fw.ppp_domain, fw.gdp_domain, fw.pce_domain, fw.pop_domain
  FROM md m JOIN fw ON m.country_code = fw.country_code AND m.surveyid_year = fw.surveyid_year AND m.survey_acronym = fw.survey_acronym
)"""


def _level(domain: str) -> str:
    return f"CASE {domain}_domain WHEN 1 THEN 'national' WHEN 2 THEN CASE urban WHEN 1 THEN 'urban' WHEN 0 THEN 'rural' END END AS {domain}_data_level"


_CLEAN = f""", clean AS (
  SELECT cache_id, country_code, surveyid_year, survey_acronym, survey_year, hhid, pid, welfare / 365 AS welfare, weight_p AS weight, CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS area,
    welfare_type, CASE WHEN use_imputed = 1 THEN 'imputed' ELSE 'micro' END AS distribution_type, {_level("cpi")}, {_level("ppp")}, {_level("pop")}, {_level("gdp")}, {_level("pce")},
    CAST(NULL AS VARCHAR) AS gd_type, alt_welfare, CAST(NULL AS VARCHAR) AS imputation_id
  FROM rows
)"""
SQL_MICRO = ctes("pfw", "md") + sql_framework("md") + _SPLIT + _CLEAN


def _group_level(domain: str) -> str:
    return f"CASE {domain}_domain WHEN 1 THEN 'national' WHEN 2 THEN area ELSE '' END AS {domain}_data_level"


SQL_GROUP = ctes("pfw", "gd") + sql_framework("gd", alternatives=False) + f""", grouped AS (
  SELECT fw.cache_id, g.country_code, g.surveyid_year, g.survey_acronym, fw.survey_year, g.welfare, g.weight, CASE WHEN urban = 1 THEN 'urban' WHEN urban = 0 THEN 'rural' WHEN urban IS NULL THEN 'national' ELSE '' END AS area,
    g.welfare_type, g.gd_type, fw.cpi_domain, fw.ppp_domain, fw.gdp_domain, fw.pce_domain, fw.pop_domain
  FROM gd g JOIN fw ON g.country_code = fw.country_code AND g.surveyid_year = fw.surveyid_year AND g.survey_acronym = fw.survey_acronym
), areas AS (SELECT cache_id, count(DISTINCT area) AS n_areas FROM grouped GROUP BY cache_id),
clean AS (
  SELECT cache_id, country_code, surveyid_year, survey_acronym, survey_year, CAST(NULL AS VARCHAR) AS hhid, CAST(NULL AS VARCHAR) AS pid, welfare, weight, CAST(NULL AS VARCHAR) AS gender, area, welfare_type,
    CASE pop_domain WHEN 1 THEN 'group' WHEN 2 THEN CASE WHEN n_areas <= 1 THEN 'group' ELSE 'aggregate' END ELSE '' END AS distribution_type,
    {_group_level("cpi")}, {_group_level("ppp")}, {_group_level("pop")}, {_group_level("gdp")}, {_group_level("pce")}, gd_type, CAST(NULL AS DOUBLE) AS alt_welfare, CAST(NULL AS VARCHAR) AS imputation_id
  FROM grouped JOIN areas USING (cache_id)
)"""
_LORENZ = """, valid AS (
  SELECT * REPLACE (
    CASE WHEN code = 1 THEN weight / max(weight) OVER (PARTITION BY cache_id, area) ELSE sum(weight) OVER run / sum(weight) OVER (PARTITION BY cache_id, area) END AS weight,
    CASE WHEN code = 1 THEN welfare / max(welfare) OVER (PARTITION BY cache_id, area)
      ELSE sum(CASE WHEN code = 5 THEN weight * welfare ELSE welfare END) OVER run / sum(CASE WHEN code = 5 THEN weight * welfare ELSE welfare END) OVER (PARTITION BY cache_id, area) END AS welfare)
  FROM (SELECT *, CAST(regexp_replace(gd_type, '^T0', '') AS INTEGER) AS code FROM clean WHERE area IS NOT NULL)
  WINDOW run AS (PARTITION BY cache_id, area ORDER BY welfare, weight ROWS UNBOUNDED PRECEDING)
)"""
_VALID = ", valid AS (SELECT * FROM clean WHERE welfare >= 0 AND weight > 0)"
_RANKS = """, firsts AS (
  SELECT cache_id, level, value, min(rn) AS rn FROM (
    SELECT *, row_number() OVER (PARTITION BY cache_id ORDER BY country_code NULLS FIRST, surveyid_year NULLS FIRST, welfare NULLS FIRST, hhid NULLS FIRST, pid NULLS FIRST) AS rn FROM {source}
  ) UNPIVOT INCLUDE NULLS (value FOR level IN (cpi_data_level, ppp_data_level, pop_data_level, gdp_data_level, pce_data_level))
  GROUP BY cache_id, level, value
), ranks AS (
  SELECT cache_id, level, CASE WHEN vals = ['national'] THEN 1 WHEN vals = ['rural', 'urban'] THEN 2 ELSE 3 END AS rank
  FROM (SELECT cache_id, level, list(coalesce(value, '?') ORDER BY rn) AS vals FROM firsts GROUP BY cache_id, level)
), chosen AS (
  SELECT cache_id, arg_min(level, (3 - rank) * 10 + list_position(['cpi_data_level', 'ppp_data_level', 'pop_data_level', 'gdp_data_level', 'pce_data_level'], level)) AS level FROM ranks GROUP BY cache_id
), levelled AS (
  SELECT s.*, CASE c.level WHEN 'cpi_data_level' THEN cpi_data_level WHEN 'ppp_data_level' THEN ppp_data_level WHEN 'pop_data_level' THEN pop_data_level WHEN 'gdp_data_level' THEN gdp_data_level ELSE pce_data_level END AS reporting_level
  FROM {source} s JOIN chosen c USING (cache_id)
)"""
_WIDE = """, wide AS (
  SELECT country_code AS k1, ppp_data_level AS k2,
    max(CASE WHEN ppp_year = 2011 AND release_version = 'v1' THEN ppp END) AS ppp_2011_01_01, max(CASE WHEN ppp_year = 2011 AND release_version = 'v2' THEN ppp END) AS ppp_2011_02_01,
    max(CASE WHEN ppp_year = 2017 THEN ppp END) AS ppp_2017_01_02
  FROM ppp GROUP BY ALL
)"""
_PRICED = """, priced AS (
  SELECT s.*, wide.* EXCLUDE (k1, k2), c.cpi2005_SM21 AS cpi2005, c.cpi2011, c.cpi2017, s.welfare AS welfare_lcu,
    s.welfare / (wide.ppp_2011_01_01 * c.cpi2011) AS welfare_ppp_2011_01_01, s.welfare / (wide.ppp_2011_02_01 * c.cpi2011) AS welfare_ppp_2011_02_01, s.welfare / (wide.ppp_2017_01_02 * c.cpi2017) AS welfare_ppp_2017_01_02
  FROM {source} s LEFT JOIN wide ON s.country_code IS NOT DISTINCT FROM k1 AND s.ppp_data_level IS NOT DISTINCT FROM k2
  LEFT JOIN cpi c ON s.country_code IS NOT DISTINCT FROM c.country_code AND s.survey_year IS NOT DISTINCT FROM c.survey_year AND s.survey_acronym IS NOT DISTINCT FROM c.survey_acronym AND s.cpi_data_level IS NOT DISTINCT FROM c.cpi_data_level
)"""
_POPULATION = """, adjusted AS (
  SELECT cache_id FROM levelled GROUP BY cache_id HAVING count(DISTINCT coalesce(reporting_level, '?')) > 1 AND count(*) FILTER (distribution_type IN ('group', 'aggregate')) = 0
), totals AS (
  SELECT cache_id, country_code, survey_year, reporting_level, coalesce(sum(weight), 0) AS weight FROM levelled {where} GROUP BY ALL
), near AS (
  SELECT *, CASE WHEN diff_year = 0 THEN 1.0 ELSE 1 / diff_year END AS wght FROM (
    SELECT t.*, p.year, p.pop, abs(p.year - t.survey_year) AS diff_year FROM totals t JOIN pop p ON t.country_code = p.country_code AND t.reporting_level = p.pop_data_level)
  QUALIFY diff_year = min(diff_year) OVER (PARTITION BY cache_id, reporting_level)
), factors AS (
  SELECT cache_id, reporting_level, sum(pop * wght) / sum(wght) / (sum(weight * wght) / sum(wght)) AS pop_fact FROM near GROUP BY ALL
)"""
_PRICE_VIEWS = ctes("pfw", "md", "ppp", "cpi", "pop")
SQL_PRICES = _PRICE_VIEWS + sql_framework("md") + _SPLIT + _CLEAN
PRICE_COLUMNS = ["welfare_lcu", *VERSIONS, "cpi2005", "cpi2011", "cpi2017", *[f"welfare_{v}" for v in VERSIONS]]


# ---- profile ----

_MD = ["country_code", "surveyid_year", "survey_acronym", "module", "hhid", "pid", "welfare", "alt_welfare", "weight_p", "urban", "male", "educat4", "educat5", "literacy"]


@query(
    "uniq_vars",
    ctes("md") + " " + " UNION ALL ".join(f"SELECT '{c}' AS variable, count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 END), 0) AS n_values, count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 END), 0) = 1 AS is_single FROM md" for c in _MD),
)
def uniq_vars(spark, d):
    df = micro(spark, d).select(*_MD)
    flags = profile.single_valued_flags(df).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, _MD)), F.array(*_MD))).alias("variable", "is_single"))
    # of an empty table no value is counted
    return flags.join(profile.distinct_counts(df), "variable", "left").withColumn("n_values", F.coalesce("n_values", F.lit(0).cast("long")))


_SINGLE_VIEW = "SELECT gdp_domain, n_rows, inpovcal, country_code FROM (SELECT *, 25 AS n_rows FROM pfw)"


def _profiled(spark, d):
    return pfw(spark, d).select("gdp_domain", F.lit(25).alias("n_rows"), "inpovcal", "country_code")


@query("uniq_vars_to_list", ctes("pfw") + " SELECT 'gdp_domain' AS variable, CAST(min(gdp_domain) AS VARCHAR) AS value FROM pfw HAVING count(DISTINCT gdp_domain) = 1 UNION ALL SELECT 'n_rows', '25'")
def uniq_vars_to_list(spark, d):
    values = profile.uniq_vars_to_list(_profiled(spark, d))
    return spark.createDataFrame([(k, str(v)) for k, v in values.items()], "variable string, value string")


@query("uniq_vars_to_attr", ctes("pfw") + " SELECT inpovcal, country_code FROM pfw")
def uniq_vars_to_attr(spark, d):
    return profile.uniq_vars_to_attr(_profiled(spark, d))[0]


# ---- framework ----


@query("framework_unique_key", ctes("pfw") + " SELECT surveyid_year, survey_acronym, count(*) AS n FROM pfw GROUP BY ALL HAVING count(*) > 1")
def framework_unique_key(spark, d):
    # the whole key is unique; a part of it isn't
    if checks.repeated_keys(pfw(spark, d), SURVEY_KEY).first() is not None:
        raise checks.SurveyError("the framework's key repeats")
    return checks.repeated_keys(pfw(spark, d), ["surveyid_year", "survey_acronym"])


@query("framework_reporting_level", ctes("pfw") + f" SELECT country_code, surveyid_year, survey_acronym, {_LEVEL} AS reporting_level FROM pfw WHERE inpovcal = 1")
def framework_reporting_level(spark, d):
    return framework.reporting_level(pfw(spark, d)).select(*SURVEY_KEY, "reporting_level")


@query(
    "framework_alt_rows",
    ctes("pfw") + f" SELECT country_code, welfare_type, oth_welfare1_type, false AS is_alt_welf FROM pfw UNION ALL SELECT country_code, {_ALT_TYPE}, NULL, true FROM pfw WHERE oth_welfare1_type <> ''",
)
def framework_alt_rows(spark, d):
    return framework.with_alternatives(pfw(spark, d)).select("country_code", "welfare_type", "oth_welfare1_type", "is_alt_welf")


@query("framework_cache_id", ctes("pfw", "md") + sql_framework("md") + " SELECT country_code, is_alt AS is_alt_welf, wt, cache_id FROM fw")
def framework_cache_id(spark, d):
    return micro_framework(spark, d).select("country_code", "is_alt_welf", "wt", "cache_id")


@query("split_alt_welfare", ctes("pfw", "md") + sql_framework("md") + _SPLIT + " SELECT cache_id, hhid, pid, round(welfare, 4) AS welfare, welfare_type FROM rows")
def split_alt_welfare(spark, d):
    return rounded(micro_rows(spark, d).select("cache_id", "hhid", "pid", "welfare", "welfare_type"))


# ---- cleaning ----


def _weights(spark, d, name):
    df = micro(spark, d).withColumn("cache_id", F.col("country_code"))
    df = df.drop("weight_p") if name is None else df.withColumnRenamed("weight_p", name)
    return rounded(clean.with_weight(df).select("cache_id", "hhid", "pid", "welfare", "weight"), 10)


for _name, _column in (("weight_fallback_p", "weight_p"), ("weight_fallback_h", "weight_h")):
    query(_name, ctes("md") + " SELECT country_code AS cache_id, hhid, pid, welfare, weight_p AS weight FROM md")(partial(_weights, name=_column))
query("weight_equal", ctes("md") + " SELECT country_code AS cache_id, hhid, pid, welfare, round(1.0::DOUBLE / count(*) OVER (PARTITION BY country_code), 10) AS weight FROM md")(partial(_weights, name=None))


@query("welfare_daily", ctes("pfw", "md") + sql_framework("md") + _SPLIT + _CLEAN + " SELECT cache_id, hhid, pid, round(welfare, 4) AS welfare FROM clean")
def welfare_daily(spark, d):
    return rounded(clean.clean_micro(micro_rows(spark, d)).select("cache_id", "hhid", "pid", "welfare"))


def _recoded(spark, d, column):
    return micro(spark, d).select("hhid", "pid", "welfare", clean.recode(column, clean.RECODES[column]).alias(column))


for _column, _labels in clean.RECODES.items():
    _cases = " ".join(f"WHEN {k} THEN '{v}'" for k, v in _labels.items())
    query(f"recode_{_column}", ctes("md") + f" SELECT hhid, pid, welfare, CASE {_column} {_cases} END AS {_column} FROM md")(partial(_recoded, column=_column))


@query("fill_missing_typed", SQL_MICRO + " SELECT cache_id, gender, area, gd_type, imputation_id, count(*) AS n FROM clean GROUP BY ALL")
def fill_missing_typed(spark, d):
    return clean.clean_micro(micro_rows(spark, d)).groupBy("cache_id", "gender", "area", "gd_type", "imputation_id").agg(F.count(F.lit(1)).alias("n"))


_LEVELS = ", ".join(DATA_LEVELS)


@query("data_levels_micro", SQL_MICRO + f" SELECT cache_id, {_LEVELS}, count(*) AS n FROM clean GROUP BY ALL")
def data_levels_micro(spark, d):
    return clean.clean_micro(micro_rows(spark, d)).groupBy("cache_id", *DATA_LEVELS).agg(F.count(F.lit(1)).alias("n"))


@query("data_levels_group", SQL_GROUP + f" SELECT cache_id, {_LEVELS}, count(*) AS n FROM clean GROUP BY ALL")
def data_levels_group(spark, d):
    return clean.clean_group(group_rows(spark, d)).groupBy("cache_id", *DATA_LEVELS).agg(F.count(F.lit(1)).alias("n"))


@query("distribution_type_micro", SQL_MICRO + " SELECT cache_id, distribution_type, count(*) AS n FROM clean GROUP BY ALL")
def distribution_type_micro(spark, d):
    return clean.clean_micro(micro_rows(spark, d)).groupBy("cache_id", "distribution_type").agg(F.count(F.lit(1)).alias("n"))


@query("distribution_type_group", SQL_GROUP + " SELECT cache_id, distribution_type, count(*) AS n FROM clean GROUP BY ALL")
def distribution_type_group(spark, d):
    return clean.clean_group(group_rows(spark, d)).groupBy("cache_id", "distribution_type").agg(F.count(F.lit(1)).alias("n"))


@query("group_area", ctes("gd") + " SELECT country_code, bin, CASE WHEN urban = 1 THEN 'urban' WHEN urban = 0 THEN 'rural' WHEN urban IS NULL THEN 'national' ELSE '' END AS area FROM gd")
def group_area(spark, d):
    return view(spark, d, "gd").select("country_code", "bin", clean.group_area(F.col("urban")).alias("area"))


_OUT = ["cache_id", *CLEAN_COLUMNS]


@query("clean_micro", SQL_MICRO + " " + sql_rounded(_OUT, "clean"))
def clean_micro(spark, d):
    return rounded(clean.clean(micro_rows(spark, d), "micro"))


@query("clean_group", SQL_GROUP + " " + sql_rounded(_OUT, "clean"))
def clean_group(spark, d):
    return rounded(clean.clean(group_rows(spark, d), "group"))


# ---- validity ----


@query("validity_micro", SQL_MICRO + _VALID + " " + sql_rounded(_OUT, "valid"))
def validity_micro(spark, d):
    return rounded(validity.validity_clean(clean.clean_micro(micro_rows(spark, d)), "micro"))


@query("validity_group", SQL_GROUP + _LORENZ + " " + sql_rounded(_OUT, "valid", 8))
def validity_group(spark, d):
    return rounded(validity.validity_clean(clean.clean_group(group_rows(spark, d)), "group"), 8)


@query("gd_type_code", ctes("gd") + " SELECT gd_type, CAST(regexp_replace(gd_type, '^T0', '') AS INTEGER) AS code, count(*) AS n FROM gd GROUP BY ALL")
def gd_type_code(spark, d):
    return view(spark, d, "gd").groupBy("gd_type").agg(F.count(F.lit(1)).alias("n")).withColumn("code", validity.gd_type_code(F.col("gd_type")))


# ---- prices ----


@query("ppp_to_wide", ctes("ppp") + _WIDE + " " + sql_rounded(["country_code", "ppp_data_level", *VERSIONS], "(SELECT k1 AS country_code, k2 AS ppp_data_level, * FROM wide)"))
def ppp_to_wide(spark, d):
    return rounded(enrich.ppp_to_wide(view(spark, d, "ppp")))


@query("base_years", ctes("cpi", "ppp") + " SELECT DISTINCT CAST(ppp_year AS VARCHAR) AS base_year FROM ppp WHERE EXISTS (SELECT 1 FROM (DESCRIBE SELECT * FROM cpi) c WHERE c.column_name LIKE concat('cpi', CAST(ppp_year AS VARCHAR), '%'))")
def base_years(spark, d):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        found = enrich.base_years(enrich.price_columns(view(spark, d, "cpi")).columns, enrich.ppp_to_wide(view(spark, d, "ppp")).columns)
    return spark.createDataFrame([(y,) for y in found], "base_year string")


@query("level_rank", SQL_MICRO + _RANKS.format(source="clean") + " SELECT cache_id, level, rank FROM ranks")
def level_rank(spark, d):
    ranks = enrich.level_ranks(clean.clean_micro(micro_rows(spark, d)), "micro")
    return ranks.select("cache_id", F.explode(F.map_from_arrays(F.array(*map(F.lit, DATA_LEVELS)), F.array(*DATA_LEVELS))).alias("level", "rank"))


@query("reporting_level", SQL_MICRO + _RANKS.format(source="clean") + " SELECT cache_id, reporting_level, count(*) AS n FROM levelled GROUP BY ALL")
def reporting_level(spark, d):
    return enrich.with_reporting_level(clean.clean_micro(micro_rows(spark, d)), "micro").groupBy("cache_id", "reporting_level").agg(F.count(F.lit(1)).alias("n"))


def _priced(spark, d):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return enrich.with_prices(clean.clean_micro(micro_rows(spark, d)), view(spark, d, "cpi"), view(spark, d, "ppp"), VERSIONS, validate=False)


_ID = ["cache_id", "hhid", "pid"]


@query("join_ppp", SQL_PRICES + _WIDE + _PRICED.format(source="clean") + " " + sql_rounded([*_ID, *VERSIONS], "priced"))
def join_ppp(spark, d):
    return rounded(_priced(spark, d).select(*_ID, *VERSIONS))


@query("join_cpi", SQL_PRICES + _WIDE + _PRICED.format(source="clean") + " " + sql_rounded([*_ID, "cpi2005", "cpi2011", "cpi2017"], "priced"))
def join_cpi(spark, d):
    return rounded(_priced(spark, d).select(*_ID, "cpi2005", "cpi2011", "cpi2017"))


@query("welfare_ppp", SQL_PRICES + _WIDE + _PRICED.format(source="clean") + " " + sql_rounded([*_ID, "welfare_lcu", *[f"welfare_{v}" for v in VERSIONS]], "priced"))
def welfare_ppp(spark, d):
    return rounded(_priced(spark, d).select(*_ID, "welfare_lcu", *[f"welfare_{v}" for v in VERSIONS]))


# ---- population ----

SQL_LEVELLED = SQL_PRICES + _VALID + _RANKS.format(source="valid")


def _levelled(spark, d):
    return enrich.with_reporting_level(validity.valid_micro(clean.clean_micro(micro_rows(spark, d))), "micro")


@query("survey_totals", SQL_LEVELLED + _POPULATION.format(where="") + " SELECT cache_id, country_code, survey_year, reporting_level, round(weight, 4) AS weight FROM totals")
def survey_totals(spark, d):
    return rounded(population.survey_totals(_levelled(spark, d)))


@query("nearest_year_pop", SQL_LEVELLED + _POPULATION.format(where="") + " " + sql_rounded(["cache_id", "country_code", "survey_year", "reporting_level", "weight", "year", "pop", "diff_year", "wght"], "near", 3))
def nearest_year_pop(spark, d):
    return rounded(population.nearest_year_pop(view(spark, d, "pop"), population.survey_totals(_levelled(spark, d))), 3)


@query("pop_factor", SQL_LEVELLED + _POPULATION.format(where="") + " " + sql_rounded(["cache_id", "reporting_level", "pop_fact"], "factors", 3))
def pop_factor(spark, d):
    return rounded(population.pop_factor(view(spark, d, "pop"), population.survey_totals(_levelled(spark, d))), 3)


_ADJUSTED = """, scaled AS (
  SELECT l.* REPLACE (CASE WHEN a.cache_id IS NULL THEN weight ELSE weight * pop_fact END AS weight), f.pop_fact
  FROM {source} l LEFT JOIN adjusted a USING (cache_id) LEFT JOIN factors f ON l.cache_id = f.cache_id AND l.reporting_level IS NOT DISTINCT FROM f.reporting_level
)"""
_WHERE = "WHERE cache_id IN (SELECT cache_id FROM adjusted)"


_ADJUST_SQL = SQL_LEVELLED + _POPULATION.format(where=_WHERE) + _ADJUSTED.format(source="levelled") + " " + sql_rounded([*_ID, "reporting_level", "weight", "pop_fact"], "scaled", 3)


@query("adjust_population", _ADJUST_SQL)
def adjust_population(spark, d):
    valid = validity.valid_micro(clean.clean_micro(micro_rows(spark, d)))
    return rounded(enrich.with_level_and_population(valid, view(spark, d, "pop"), "micro").select(*_ID, "reporting_level", "weight", "pop_fact"), 3)


@query("adjust_population_by_level", _ADJUST_SQL)
def adjust_population_by_level(spark, d):
    # of data that has its reporting level
    return rounded(population.adjust_population(_levelled(spark, d), view(spark, d, "pop")).select(*_ID, "reporting_level", "weight", "pop_fact"), 3)


# ---- inventory ----


def _inventory(spark, d):
    raw = view(spark, d, "inv")
    return inventory.clean_inventory(raw.toDF(*[c.lower() for c in raw.columns]), "/share/")


@query(
    "inventory_clean",
    ctes("inv") + r""", n AS (SELECT replace(fullname, '\', '/') AS p, try_strptime(creationtime, '%m/%d/%Y %I:%M:%S %p') AS c, try_strptime(lastwritetime, '%m/%d/%Y %I:%M:%S %p') AS w, segment AS segment FROM inv),
  s AS (SELECT CASE WHEN starts_with(p, '/share/') THEN substr(p, 8) ELSE p END AS fullname, c, w, segment, regexp_replace(string_split(p, '/')[-1], '\.[^.]*$', '') AS survey_id FROM n),
  x AS (SELECT *, string_split(survey_id, '_') AS k FROM s)
  SELECT fullname, strftime(c, '%Y-%m-%d %H:%M:%S') AS creationtime, strftime(w, '%Y-%m-%d %H:%M:%S') AS lastwritetime, segment, survey_id, k[1] AS country_code, k[2] AS surveyid_year, k[3] AS survey_acronym, k[4] AS vermast, k[6] AS veralt, k[9] AS module
  FROM x WHERE c IS NOT NULL AND k[9] IN ('GPWG', 'ALL', 'BIN', 'GROUP', 'HIST')""",
)
def inventory_clean(spark, d):
    df = _inventory(spark, d)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("fullname", stamp("creationtime"), stamp("lastwritetime"), "segment", "survey_id", "country_code", "surveyid_year", "survey_acronym", "vermast", "veralt", "module")


_DIGEST_SQL = f"""WITH inv_rows AS ({ORACLES['inventory_clean']}), top AS (SELECT max(fullname) AS one FROM inv_rows)
  SELECT 'same rows' AS case_, count(*) AS n_rows, true AS equal FROM inv_rows
  UNION ALL SELECT 'another order', count(*), true FROM inv_rows
  UNION ALL SELECT 'without a row', count(*), count(*) = (SELECT count(*) FROM inv_rows) FROM inv_rows, top WHERE fullname <> one
  UNION ALL SELECT 'another cell', count(*), count(*) FILTER (fullname = one AND veralt IS DISTINCT FROM 'V99') = 0 FROM inv_rows, top
  UNION ALL SELECT 'a value in the next column', count(*), count(*) FILTER (vermast IS NOT NULL) = 0 FROM inv_rows"""


@query("inventory_digest", _DIGEST_SQL)
def inventory_digest(spark, d):
    # each case reads the rows again; they are parsed once
    df = batch.stored(_inventory(spark, d), "inventory")
    own = inventory.digest(df)
    one = df.select(F.max("fullname")).first()[0]
    empty = F.lit(None).cast("string")
    others = {
        "same rows": df, "another order": df.orderBy(F.desc("fullname")), "without a row": df.where(F.col("fullname") != one),
        "another cell": df.withColumn("veralt", F.when(F.col("fullname") == one, "V99").otherwise(F.col("veralt"))),
        # NULL counts, so a value moved beside a NULL is seen
        "a value in the next column": df.withColumns({"vermast": empty, "veralt": F.col("vermast")}),
    }
    found = {name: inventory.digest(x) for name, x in others.items()}
    return spark.createDataFrame([(name, int(x.split(":")[0]), x == own) for name, x in found.items()], "case_ string, n_rows long, equal boolean")


def _written_csv(spark, d, path):
    view(spark, d, "inv").write.option("header", True).csv(path)
    return path


@query("inventory_read", ctes("inv") + " SELECT FullName AS fullname, CreationTime AS creationtime, LastWriteTime AS lastwritetime, Segment AS segment FROM inv")
def inventory_read(spark, d):
    return inventory.read_inventory(spark, _written_csv(spark, d, scratch(spark, "inventory-csv")))


@query("inventory_update", ORACLES["inventory_clean"])
def inventory_update(spark, d):
    raw = scratch(spark, "raw")
    at = Locations.of("/share/", raw)
    _written_csv(spark, d, at.inventory_file)
    if [inventory.update_inventory(spark, at.inventory_file, at.inventory_table, "/share/") for _ in range(2)] != [True, False]:
        raise checks.SurveyError("an inventory is saved once unless it changes")
    df = versions.read_version(spark, at.inventory_table)
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select("fullname", stamp("creationtime"), stamp("lastwritetime"), "segment", "survey_id", "country_code", "surveyid_year", "survey_acronym", "vermast", "veralt", "module")


_ORDER = ", ".join(inventory.ORDER)


@query("inventory_order", f"WITH keys AS (SELECT DISTINCT {_ORDER} FROM ({ORACLES['inventory_clean']})) SELECT {_ORDER}, row_number() OVER (ORDER BY {_ORDER}) AS place FROM keys")
def inventory_order(spark, d):
    # the keys alone are sorted, by all tasks; places are those in the sorted files, so no task sees all keys
    path = scratch(spark, "ordered-keys")
    _inventory(spark, d).select(*inventory.ORDER).distinct().orderBy(*inventory.ORDER).write.parquet(path)
    rows = spark.read.parquet(path).select(*inventory.ORDER, F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    earlier = F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select("file", F.coalesce(earlier, F.lit(0)).alias("before"))
    return rows.join(files, "file").select(*inventory.ORDER, (F.col("before") + F.col("row") + 1).cast("long").alias("place"))


_STAMP = "concat(CAST(1 + c_custkey % 12 AS VARCHAR(20)), {s}, CAST(1 + c_custkey % 28 AS VARCHAR(20)), {s}, {y}, ' ', CAST({h} AS VARCHAR(20)), ':07:', CAST(10 + c_custkey % 50 AS VARCHAR(20)){m})"
_YEAR, _HOUR = "CAST(1990 + c_custkey % 40 AS VARCHAR(20))", "c_custkey % 24"
_STAMPS = f"""SELECT c_custkey, CASE c_custkey % 5
  WHEN 0 THEN {_STAMP.format(s="'/'", y=_YEAR, h="1 + c_custkey % 12", m=", CASE WHEN c_custkey % 2 = 0 THEN ' AM' ELSE ' PM' END")}
  WHEN 1 THEN {_STAMP.format(s="'/'", y=_YEAR, h=_HOUR, m="")} WHEN 2 THEN {_STAMP.format(s="'-'", y=_YEAR, h=_HOUR, m="")}
  WHEN 3 THEN {_STAMP.format(s="'/'", y="CAST(10 + c_custkey % 20 AS VARCHAR(20))", h=_HOUR, m="")} ELSE 'some day' END AS stamp FROM """


@query(
    "inventory_times",
    f"SELECT c_custkey, strftime(coalesce(try_strptime(stamp, '%m/%d/%Y %I:%M:%S %p'), CASE WHEN length(split_part(split_part(stamp, ' ', 1), '/', 3)) = 4 THEN try_strptime(stamp, '%m/%d/%Y %H:%M:%S') END,"
    f" try_strptime(stamp, '%m-%d-%Y %H:%M:%S'), try_strptime(stamp, '%m/%d/%y %H:%M:%S')), '%Y-%m-%d %H:%M:%S') AS parsed FROM ({_STAMPS} customer)",
)
def inventory_times(spark, d):
    stamps = spark.sql(_STAMPS + "{customer}", customer=spark.read.parquet(f"{d}/customer.parquet"))
    return stamps.select("c_custkey", F.date_format(inventory.month_first_time(F.col("stamp")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


_LAYOUTS = {
    # date and time, and how DuckDB reads it
    0: ("concat({mo}, '/', {dd}, '/', {y}, ' ', {h12}, ':07:', {s}, CASE WHEN c_custkey % 2 = 0 THEN ' AM' ELSE ' PM' END)", "%m/%d/%Y %I:%M:%S %p"),
    1: ("concat({mo}, '/', {dd}, '/', {y}, ' ', {h}, ':07:', {s})", "%m/%d/%Y %H:%M:%S"),
    2: ("concat({mo}, '-', {dd}, '-', {y}, ' ', {h}, ':07:', {s})", "%m-%d-%Y %H:%M:%S"),
    3: ("concat({mo}, '/', {dd}, '/', substring({y}, 3, 2), ' ', {h}, ':07:', {s})", "%m/%d/%y %H:%M:%S"),
    4: ("concat({mo}, '.', {dd}, '.', {y}, 'T', {h}, '.07.', {s})", "%m.%d.%YT%H.%M.%S"),
    5: ("concat({name}, ' ', {dd}, ', ', {y}, ' ', {h12}, ':07:', {s}, 'pm')", "%b %d, %Y %I:%M:%S%p"),
    6: ("concat({mm}, {d2}, {y}, ' ', {hh}, '07', {s})", "%m%d%Y %H%M%S"),
    7: ("concat({mo}, ' ', {dd}, ' ', {y}, '  ', {h}, ' 07 ', {s})", "%m %d %Y  %H %M %S"),
    8: ("concat({mo}, '/', {dd}, '/', {y}, ' ', {h}, ':07:', {s}, '.25')", "%m/%d/%Y %H:%M:%S.%g"),
    9: ("concat({mo}, '_', {dd}, '_', {y}, '_', {h}, '_07_', {s})", "%m_%d_%Y_%H_%M_%S"),
    10: ("concat('13/', {dd}, '/', {y}, ' ', {h}, ':07:', {s})", None),
    11: ("concat({mo}, '/', {dd}, '/', {y}, ' 13:07:', {s}, ' AM')", None),
    12: ("'some day'", None),
}
_text = "CAST({} AS VARCHAR(20))".format
_PARTS = {
    "mo": _text("1 + c_custkey % 12"), "dd": _text("1 + c_custkey % 28"), "y": _text("1969 + c_custkey % 100"), "h": _text("c_custkey % 24"), "h12": _text("1 + c_custkey % 12"), "s": _text("10 + c_custkey % 50"),
    "mm": "lpad(CAST(1 + c_custkey % 12 AS VARCHAR(20)), 2, '0')", "d2": "lpad(CAST(1 + c_custkey % 28 AS VARCHAR(20)), 2, '0')", "hh": "lpad(CAST(c_custkey % 24 AS VARCHAR(20)), 2, '0')",
    "name": "substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(1 + 3 * (c_custkey % 12) AS INTEGER), 3)",
}
_LAID_OUT = "SELECT c_custkey, c_custkey % 13 AS layout, CASE c_custkey % 13 " + " ".join(f"WHEN {k} THEN {text.format(**_PARTS)}" for k, (text, _) in _LAYOUTS.items()) + " END AS stamp FROM "


@query(
    "inventory_time_layouts",
    "SELECT c_custkey, layout, strftime(CASE layout " + " ".join(f"WHEN {k} THEN try_strptime(stamp, '{how}')" for k, (_, how) in _LAYOUTS.items() if how) + f" END, '%Y-%m-%d %H:%M:%S') AS parsed FROM ({_LAID_OUT} customer)",
)
def inventory_time_layouts(spark, d):
    stamps = spark.sql(_LAID_OUT + "{customer}", customer=spark.read.parquet(f"{d}/customer.parquet"))
    return stamps.select("c_custkey", "layout", F.date_format(inventory.month_first_time(F.col("stamp")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "inventory_losses",
    ctes("inv") + """, rows AS (
    SELECT CASE WHEN try_strptime(creationtime, '%m/%d/%Y %I:%M:%S %p') IS NULL THEN 'creationtime_unknown'
      WHEN string_split(regexp_replace(fullname, '[.][^.]*$', ''), '_')[-1] NOT IN ('GPWG', 'ALL', 'BIN', 'GROUP', 'HIST') THEN 'module_other' END AS dropped_by FROM inv)
  SELECT dropped_by, count(*) AS n FROM rows WHERE dropped_by IS NOT NULL GROUP BY ALL""",
)
def inventory_losses(spark, d):
    raw = view(spark, d, "inv")
    return inventory.inventory_losses(inventory.judged_inventory(raw.toDF(*[c.lower() for c in raw.columns]), "/share/"))


# ---- sources and sinks ----


@query("load_surveys", ctes("md") + " SELECT country_code, surveyid_year, hhid, pid, welfare FROM md WHERE country_code IN ('NATION_1', 'NATION_5') AND surveyid_year = 1997")
def load_surveys(spark, d):
    path = scratch(spark, "surveys")
    micro(spark, d).write.partitionBy("country_code", "surveyid_year").parquet(path)
    return surveys.load_surveys(spark, path, ["NATION_1", "NATION_5"], 1997.0).select("country_code", F.col("surveyid_year").cast("double").alias("surveyid_year"), "hhid", "pid", "welfare")


@query("load_auxiliary", ctes("ppp") + " SELECT country_code, ppp_data_level, ppp_year, release_version, adaptation_version, round(ppp, 4) AS ppp FROM ppp")
def load_auxiliary(spark, d):
    folder = scratch(spark, "auxiliary")
    view(spark, d, "ppp").write.parquet(f"{folder}/ppp.parquet")
    return rounded(surveys.load_auxiliary(spark, folder, "ppp"))


@query("rename_raw", ctes("md") + " SELECT country_code, surveyid_year, survey_acronym, male AS gender, urban AS area, CAST(educat4 AS VARCHAR) AS imputation_id, hhid, pid FROM md")
def rename_raw(spark, d):
    given = {"country_code": "countrycode", "surveyid_year": "year", "survey_acronym": "survname"}
    raw = micro(spark, d).select(*SURVEY_KEY, "male", "urban", F.col("educat4").cast("string").alias("sim"), "hhid", "pid").withColumnsRenamed(given)
    return surveys.rename_raw(raw)


_SAVED_SQL = """WITH steps AS (
  SELECT 1 AS step, 1 AS version, true AS was_written, count(*) AS n_rows, sum(c_custkey) AS total FROM customer UNION ALL SELECT 2, 1, false, count(*), sum(c_custkey) FROM customer
  UNION ALL SELECT 3, 2, true, count(*), sum(c_custkey) FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT 4, 3, true, count(*), sum(c_custkey) FROM customer WHERE c_custkey % 3 > 0
  UNION ALL SELECT 5, 3, false, count(*), sum(c_custkey) FROM customer WHERE c_custkey % 3 > 0
) SELECT step, version, was_written, n_rows, CAST(total AS BIGINT) AS total FROM steps"""


@query("save_if_changed", _SAVED_SQL)
def save_if_changed(spark, d):
    path, df = scratch(spark, "saved"), spark.read.parquet(f"{d}/customer.parquet")
    changed = df.where("c_custkey % 3 > 0")
    steps = [(df, False), (df.orderBy(F.desc("c_name")), False), (changed, False), (changed, True), (changed, False)]
    # what a reader finds after each step
    found = []
    for k, (x, force) in enumerate(steps, 1):
        written = inventory.save_if_changed(x, path, force)
        number = versions.current(spark, path).number
        stored = versions.read_version(spark, path, number).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("c_custkey").alias("total"))
        found.append(stored.select(F.lit(k).alias("step"), F.lit(number).alias("version"), F.lit(written).alias("was_written"), "n_rows", "total"))
    return reduce(DataFrame.unionByName, found)


@query(
    "bundled_columns",
    SQL_MICRO + f" SELECT variable, count(value) AS n_known FROM (UNPIVOT (SELECT {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in CLEAN_COLUMNS)} FROM clean) ON {', '.join(CLEAN_COLUMNS)} INTO NAME variable VALUE value) GROUP BY variable"
    + " UNION ALL SELECT * FROM (SELECT unnest(['gender', 'area', 'gd_type', 'imputation_id']) AS variable, 0 AS n_known)",
)
def bundled_columns(spark, d):
    # the bundled list against the cleaned rows: their columns, types and known values
    with open(surveys.bundled("clean_columns.csv"), encoding="utf-8") as f:
        listed = [line.strip().split(",") for line in f][1:]
    rows = clean.clean_micro(micro_rows(spark, d))
    if [[c, t] for c, t in rows.drop("cache_id").dtypes] != listed:
        raise checks.SurveyError("the bundled columns aren't those of the cleaned rows")
    known = rows.agg(*[F.count(c).alias(c) for c, _ in listed])
    return known.unpivot([], [c for c, _ in listed], "variable", "n_known")


@query("process_data_default", "SELECT r_regionkey, r_name FROM region")
def process_data_default(spark, d):
    return pipeline.process_data(spark.read.parquet(f"{d}/region.parquet").select("r_regionkey", "r_name"), pfw(spark, d), "other")


# ---- row order ----


def _placed(df: DataFrame, kind: str, *columns: str) -> DataFrame:
    """Places of the rows of each survey in the order of ``sort_rows``."""
    own = Window.partitionBy("cache_id").orderBy("at")
    return clean.sort_rows(df, kind).withColumn("at", F.monotonically_increasing_id()).select("cache_id", *columns, F.row_number().over(own).cast("long").alias("place"))


_PLACE = "row_number() OVER (PARTITION BY cache_id ORDER BY {keys}) AS place"
_MICRO_KEYS = "country_code NULLS FIRST, surveyid_year NULLS FIRST, welfare NULLS FIRST, hhid NULLS FIRST, pid NULLS FIRST"


@query("row_order_micro", SQL_MICRO + f" SELECT cache_id, hhid, pid, {_PLACE.format(keys=_MICRO_KEYS)} FROM clean")
def row_order_micro(spark, d):
    return _placed(clean.clean_micro(micro_rows(spark, d)), "micro", "hhid", "pid")


@query("row_order_group", SQL_GROUP + f" SELECT cache_id, area, round(weight, 4) AS weight, {_PLACE.format(keys='country_code NULLS FIRST, surveyid_year NULLS FIRST, area NULLS FIRST, welfare NULLS FIRST')} FROM clean")
def row_order_group(spark, d):
    return rounded(_placed(clean.clean_group(group_rows(spark, d)), "group", "area", "weight"))


@query("row_order_reporting", SQL_MICRO + _RANKS.format(source="clean") + f" SELECT cache_id, reporting_level, hhid, pid, {_PLACE.format(keys='reporting_level NULLS FIRST, ' + _MICRO_KEYS)} FROM levelled")
def row_order_reporting(spark, d):
    return _placed(enrich.with_reporting_level(clean.clean_micro(micro_rows(spark, d)), "micro"), "micro", "reporting_level", "hhid", "pid")


@query("surveys_in_files", SQL_MICRO + f" SELECT cache_id, hhid, pid, round(welfare, 4) AS welfare, {_PLACE.format(keys=_MICRO_KEYS)} FROM clean")
def surveys_in_files(spark, d):
    # places by the names of a survey's files and the rows in them
    path = scratch(spark, "ordered-surveys")
    surveys.write_surveys(clean.clean_micro(micro_rows(spark, d)), path, "micro")
    own = Window.partitionBy("cache_id").orderBy("file", "row")
    rows = spark.read.parquet(path).select("cache_id", "hhid", "pid", "welfare", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return rounded(rows.select("cache_id", "hhid", "pid", "welfare", F.row_number().over(own).cast("long").alias("place")))


# ---- pipelines ----

SQL_PROCESS = ctes("pfw", "md") + sql_framework("md", alternatives=False) + _SPLIT.replace("fw.wt AS welfare_type", "fw.welfare_type") + _CLEAN + _VALID


@query("process_data_micro", SQL_PROCESS + " " + sql_rounded(_OUT, "valid"))
def process_data_micro(spark, d):
    return rounded(pipeline.process_data(micro(spark, d), pfw(spark, d), "micro", validate=False))


@query("process_data_group", SQL_GROUP + _LORENZ + " " + sql_rounded(_OUT, "valid", 8))
def process_data_group(spark, d):
    return rounded(pipeline.process_data(view(spark, d, "gd").drop("bin"), pfw(spark, d), "group", validate=False), 8)


@query(
    "pipeline_full",
    SQL_LEVELLED + _WIDE + _PRICED.format(source="levelled") + _POPULATION.format(where=_WHERE) + _ADJUSTED.format(source="priced")
    + " " + sql_rounded([*_OUT, "reporting_level", *PRICE_COLUMNS, "pop_fact"], "scaled", 4),
)
def pipeline_full(spark, d):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        df = pipeline.full_chain(micro(spark, d), pfw(spark, d), view(spark, d, "cpi"), view(spark, d, "ppp"), view(spark, d, "pop"), "micro", VERSIONS, validate=False, alternatives=ALTERNATIVES)
    return rounded(df, 4)


# ---- batches ----

_NUMBERS = "('surveyid_year', 'welfare', 'alt_welfare', 'weight_p', 'urban', 'male', 'educat4', 'educat5', 'literacy')"
_BROKEN = f""", keys AS (
  SELECT country_code, surveyid_year, survey_acronym, count(*) AS n, count(*) FILTER (inpovcal = 1) AS used FROM pfw_bad GROUP BY ALL
), described AS (
  SELECT p.*, k.n, {_WT} AS wt, CASE {_ALT_TYPE} WHEN 'income' THEN 'INC' WHEN 'consumption' THEN 'CON' ELSE '' END AS other_wt, {_LEVEL} AS level
  FROM pfw_bad p JOIN keys k USING (country_code, surveyid_year, survey_acronym) WHERE inpovcal = 1
), twice AS (
  SELECT 'cpi' AS what, country_code, survey_year, survey_acronym FROM cpi_bad GROUP BY country_code, survey_year, survey_acronym, cpi_data_level HAVING count(*) > 1
  UNION SELECT 'ppp', country_code, NULL, NULL FROM ppp_bad GROUP BY country_code, ppp_data_level, ppp_year, release_version, adaptation_version HAVING count(*) > 1
), judged AS (
  SELECT s.country_code, s.surveyid_year, s.survey_acronym, s.module, s.n_rows, p.oth_welfare1_var, p.n,
    s.country_code || '_' || CAST(CAST(s.surveyid_year AS BIGINT) AS VARCHAR) || '_' || s.survey_acronym || '_D' || coalesce(p.level, 'NA') || '_' || p.wt || '_' || s.module AS first_id,
    CASE WHEN p.country_code IS NULL THEN 'no_framework' WHEN p.n > 1 THEN 'framework_repeats' WHEN p.oth_welfare1_type <> '' AND p.wt = p.other_wt THEN 'cache_id_repeats'
      WHEN p.oth_welfare1_type <> '' AND p.oth_welfare1_var NOT IN {_NUMBERS} THEN 'no_such_column'
      WHEN EXISTS (SELECT 1 FROM twice t WHERE what = 'cpi' AND t.country_code = p.country_code AND t.survey_year = p.survey_year AND t.survey_acronym = p.survey_acronym) THEN 'cpi_repeats'
      WHEN s.country_code IN (SELECT country_code FROM twice WHERE what = 'ppp') THEN 'ppp_repeats' END AS rule
  FROM (SELECT country_code, surveyid_year, survey_acronym, module, count(*) AS n_rows FROM md_bad GROUP BY ALL) s LEFT JOIN described p USING (country_code, surveyid_year, survey_acronym)
), pfw_ok AS (SELECT p.* FROM pfw_bad p SEMI JOIN (SELECT * FROM judged WHERE rule IS NULL) j ON p.country_code = j.country_code AND p.surveyid_year = j.surveyid_year AND p.survey_acronym = j.survey_acronym)"""
_BATCH = ctes("pfw_bad", "md_bad", "cpi_bad", "ppp_bad", "pop") + _BROKEN + sql_framework("md_bad").replace("FROM pfw p", "FROM pfw_ok p") + _SPLIT.replace("FROM md m", "FROM md_bad m") + _CLEAN


def _full_batch(spark, d):
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return batch.full_batch(*[view(spark, d, n) for n in ("md_bad", "pfw_bad", "cpi_bad", "ppp_bad", "pop")], "micro", VERSIONS)


@query(
    "batch_status",
    _BATCH + """ SELECT country_code, surveyid_year, survey_acronym, module, CASE WHEN rule IN ('no_framework', 'framework_repeats') THEN NULL ELSE first_id END AS cache_id, rule,
    CASE rule WHEN 'no_framework' THEN 'the framework has no row in use' WHEN 'framework_repeats' THEN 'the framework has ' || n || ' rows' WHEN 'cache_id_repeats' THEN 'both measures have the cache id ' || first_id
      WHEN 'no_such_column' THEN 'no numeric column ' || oth_welfare1_var || ' for the second measure' WHEN 'cpi_repeats' THEN 'the CPI table has a level of the survey twice' ELSE 'the PPP table has a level of the country twice' END AS message, n_rows
  FROM judged WHERE rule IS NOT NULL
  UNION ALL SELECT j.country_code, j.surveyid_year, j.survey_acronym, j.module, c.cache_id, 'no_valid_rows', 'none of ' || count(*) || ' rows is valid', count(*)
  FROM clean c JOIN judged j USING (country_code, surveyid_year, survey_acronym) GROUP BY ALL HAVING count(*) FILTER (welfare >= 0 AND weight > 0) = 0""",
)
def batch_status(spark, d):
    return _full_batch(spark, d).status


@query(
    "batch_counts",
    _BATCH + """ SELECT cache_id, CASE WHEN welfare IS NULL THEN 'welfare_unknown' WHEN welfare < 0 THEN 'welfare_negative' WHEN weight IS NULL THEN 'weight_unknown' WHEN weight <= 0 THEN 'weight_not_positive' END AS dropped_by,
    count(*) AS n FROM clean GROUP BY ALL""",
)
def batch_counts(spark, d):
    return _full_batch(spark, d).counts


@query("batch_process", ctes("pfw_bad", "md_bad") + sql_framework("md_bad", alternatives=False).replace("FROM pfw p", "FROM (SELECT * FROM pfw_bad WHERE country_code <> 'NATION_3') p") + _SPLIT.replace("FROM md m", "FROM md_bad m").replace("fw.wt AS welfare_type", "fw.welfare_type") + _CLEAN + _VALID + " " + sql_rounded(_OUT, "valid"))
def batch_process(spark, d):
    return rounded(batch.process_batch(view(spark, d, "md_bad"), view(spark, d, "pfw_bad"), "micro").rows)


@query(
    "batch_full",
    _BATCH + _VALID + _RANKS.format(source="valid") + _WIDE.replace("FROM ppp ", "FROM ppp_bad ") + _PRICED.format(source="levelled") + _POPULATION.format(where=_WHERE) + _ADJUSTED.format(source="priced")
    + " " + sql_rounded([*_OUT, "reporting_level", *PRICE_COLUMNS, "pop_fact"], "scaled", 6),
)
def batch_full(spark, d):
    return rounded(_full_batch(spark, d).rows, 6)
