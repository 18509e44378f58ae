"""Survey-shaped views over the driver's tables: a survey is one nation.

The SQL is common to Spark and DuckDB. ``view`` gives a Spark DataFrame,
``ctes`` the same views as the WITH clause of a DuckDB query.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_KEY = "n_name AS country_code, CAST(1996 + n_nationkey % 4 AS DOUBLE) AS surveyid_year, concat('S', CAST(n_regionkey AS VARCHAR(10))) AS survey_acronym"
_MODULE = "CASE n_nationkey % 3 WHEN 0 THEN 'GPWG' WHEN 1 THEN 'ALL' ELSE 'BIN' END AS module"
_TYPE = "CASE WHEN n_regionkey % 2 = 0 THEN 'consumption' ELSE 'income' END"
_OTHER = "CASE WHEN n_nationkey % 4 <> 1 THEN '' WHEN n_regionkey % 2 = 0 THEN 'Income' ELSE 'Consumption' END"
_LEVELS = "(SELECT 'national' AS level, CAST(1.0 AS DOUBLE) AS p, CAST(1.0 AS DOUBLE) AS m UNION ALL SELECT 'urban', CAST(1.25 AS DOUBLE), CAST(1.1 AS DOUBLE) UNION ALL SELECT 'rural', CAST(0.75 AS DOUBLE), CAST(0.9 AS DOUBLE))"

#: {name} stands for a driver table or an earlier view.
VIEWS = {
    "pfw": f"""
SELECT {_KEY},
  CAST(1996 + n_nationkey % 4 AS DOUBLE) + CASE WHEN n_nationkey % 5 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS survey_year,
  1 + n_nationkey % 2 AS cpi_domain, CASE WHEN n_nationkey = 7 THEN NULL ELSE 1 + n_nationkey % 2 END AS ppp_domain,
  1 AS gdp_domain, CASE WHEN n_nationkey % 6 = 0 THEN 3 ELSE 1 END AS pce_domain, 1 + n_nationkey % 2 AS pop_domain,
  CASE WHEN n_nationkey = 24 THEN 0 ELSE 1 END AS inpovcal, CASE WHEN n_nationkey % 8 = 3 THEN 1 ELSE 0 END AS use_imputed,
  {_TYPE} AS welfare_type, {_OTHER} AS oth_welfare1_type, CASE WHEN n_nationkey % 4 = 1 THEN 'alt_welfare' ELSE '' END AS oth_welfare1_var
FROM {{nation}}""",
    "md": f"""
SELECT {_KEY}, {_MODULE}, CAST(l_orderkey AS VARCHAR(20)) AS hhid,
  concat(CAST(l_linenumber AS VARCHAR(20)), '-', CAST(l_partkey AS VARCHAR(20)), '-', CAST(l_suppkey AS VARCHAR(20))) AS pid,
  l_extendedprice AS welfare, l_extendedprice * (1 - l_discount) AS alt_welfare, l_quantity AS weight_p,
  CASE WHEN l_linestatus = 'O' THEN 1 WHEN l_linestatus = 'F' THEN 0 END AS urban,
  CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 0 END AS male,
  CASE WHEN l_linenumber <= 4 THEN l_linenumber END AS educat4, CASE WHEN l_linenumber <= 5 THEN l_linenumber END AS educat5,
  CASE WHEN l_discount < 0.05 THEN 1 WHEN l_discount < 0.09 THEN 0 END AS literacy
FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey JOIN {{nation}} ON s_nationkey = n_nationkey""",
    "gd": f"""
SELECT country_code, surveyid_year, survey_acronym, module, welfare_type, gd_type, urban, CAST(bin AS BIGINT) AS bin,
  sum(c_acctbal + 1000) AS welfare, CAST(count(*) AS DOUBLE) AS weight
FROM (
  SELECT *, ntile(10) OVER (PARTITION BY country_code, urban ORDER BY c_acctbal, c_custkey) AS bin FROM (
    SELECT {_KEY}, {_MODULE}, {_TYPE} AS welfare_type, CASE n_nationkey % 3 WHEN 0 THEN 'T01' WHEN 1 THEN 'T02' ELSE 'T05' END AS gd_type,
      CASE WHEN n_nationkey % 2 = 0 THEN NULL WHEN c_mktsegment IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') THEN 1 ELSE 0 END AS urban, c_acctbal, c_custkey
    FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey) AS c) AS b
GROUP BY country_code, surveyid_year, survey_acronym, module, welfare_type, gd_type, urban, bin""",
    "ppp": f"""
SELECT n_name AS country_code, level AS ppp_data_level, ppp_year, release_version, adaptation_version, (n_nationkey + 1) * p * (ppp_year - 2000) / 10 AS ppp
FROM {{nation}} CROSS JOIN {_LEVELS} AS l CROSS JOIN (
  SELECT 2011 AS ppp_year, 'v1' AS release_version, 'v1' AS adaptation_version UNION ALL SELECT 2011, 'v2', 'v1' UNION ALL SELECT 2017, 'v1', 'v2') AS v
WHERE NOT (n_nationkey = 5 AND ppp_year = 2017)""",
    "cpi": f"""
SELECT country_code, survey_year, survey_acronym, level AS cpi_data_level, (survey_year - 1990) / 20 AS cpi2005_SM21, (survey_year - 1990) / 21 * m AS cpi2011, (survey_year - 1990) / 27 * m AS cpi2017
FROM {{pfw}} CROSS JOIN {_LEVELS} AS l""",
    "pop": f"""
SELECT n_name AS country_code, level AS pop_data_level, CAST(year(o_orderdate) AS DOUBLE) AS year,
  sum(CASE WHEN level = 'national' OR (level = 'urban' AND o_orderstatus = 'O') OR (level = 'rural' AND o_orderstatus <> 'O') THEN o_totalprice ELSE CAST(0 AS DOUBLE) END) AS pop
FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey CROSS JOIN {_LEVELS} AS l
WHERE year(o_orderdate) BETWEEN 1995 AND 2001
GROUP BY n_name, level, year(o_orderdate)""",
}

VIEWS["inv"] = """
SELECT concat(chr(92), 'share', chr(92), n_name, chr(92), 'C', CAST(n_nationkey AS VARCHAR(20)), '_', CAST(1990 + c_custkey % 30 AS VARCHAR(20)), '_S', CAST(c_custkey % 9 AS VARCHAR(20)), '_V0', CAST(1 + c_custkey % 3 AS VARCHAR(20)), '_M_V0', CAST(1 + c_custkey % 4 AS VARCHAR(20)), '_A_COL_',
    CASE c_custkey % 7 WHEN 0 THEN 'GPWG' WHEN 1 THEN 'ALL' WHEN 2 THEN 'BIN' WHEN 3 THEN 'GROUP' WHEN 4 THEN 'HIST' WHEN 5 THEN 'RAW' ELSE 'OTHER' END, '.dta') AS FullName,
  CASE WHEN c_custkey % 17 = 0 THEN 'unknown' ELSE concat(CAST(1 + c_custkey % 12 AS VARCHAR(20)), '/', CAST(1 + c_custkey % 28 AS VARCHAR(20)), '/', CAST(2000 + c_custkey % 20 AS VARCHAR(20)), ' ', CAST(1 + c_custkey % 12 AS VARCHAR(20)), ':05:09 ', CASE WHEN c_custkey % 2 = 0 THEN 'AM' ELSE 'PM' END) END AS CreationTime,
  concat(CAST(1 + c_custkey % 12 AS VARCHAR(20)), '/1/2021 11:30:00 PM') AS LastWriteTime, c_mktsegment AS Segment
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""


_MD_COLUMNS = "country_code, surveyid_year, survey_acronym, module, hhid, pid, alt_welfare, urban, male, educat4, educat5, literacy"
#: The same with surveys that break a rule: repeated keys and prices, a second measure of the first one's type or of no column, no valid row.
VIEWS |= {
    "pfw_bad": """
SELECT country_code, surveyid_year, survey_acronym, survey_year, cpi_domain, ppp_domain, gdp_domain, pce_domain, pop_domain, inpovcal, use_imputed, welfare_type,
  CASE WHEN country_code = 'NATION_13' THEN welfare_type ELSE oth_welfare1_type END AS oth_welfare1_type, CASE WHEN country_code = 'NATION_9' THEN 'no_such' ELSE oth_welfare1_var END AS oth_welfare1_var
FROM {pfw}
UNION ALL SELECT country_code, surveyid_year, survey_acronym, survey_year, cpi_domain, ppp_domain, gdp_domain, pce_domain, pop_domain, 0, use_imputed, welfare_type, oth_welfare1_type, oth_welfare1_var
FROM {pfw} WHERE country_code = 'NATION_3'""",
    "md_bad": f"""
SELECT {_MD_COLUMNS},
  CASE WHEN country_code = 'NATION_2' OR (male IS NULL AND educat4 = 1) THEN NULL WHEN educat4 = 2 AND urban = 1 THEN -welfare ELSE welfare END AS welfare,
  CASE WHEN weight_p <= 3 THEN 0 WHEN weight_p <= 6 THEN NULL ELSE weight_p END AS weight_p
FROM {{md}}""",
    "cpi_bad": "SELECT * FROM {cpi} UNION ALL SELECT * FROM {cpi} WHERE country_code = 'NATION_6' AND cpi_data_level = 'urban'",
    "ppp_bad": "SELECT * FROM {ppp} UNION ALL SELECT * FROM {ppp} WHERE country_code = 'NATION_4' AND ppp_data_level = 'rural' AND ppp_year = 2017",
}


def needs(name: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", VIEWS[name])))


@lru_cache(64)
def table(spark: SparkSession, path: str) -> DataFrame:
    """A driver table; its schema is looked up once a session."""
    return spark.read.parquet(path)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {n: view(spark, sf_dir, n) if n in VIEWS else table(spark, f"{sf_dir}/{n}.parquet") for n in needs(name)}
    return spark.sql(VIEWS[name], **tables)


def ctes(*names: str) -> str:
    """``WITH`` and the named views with those they need, for DuckDB."""
    wanted: list[str] = []
    for n in names:
        wanted += [x for x in [*[y for y in needs(n) if y in VIEWS], n] if x not in wanted]
    return "WITH " + ", ".join(f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', VIEWS[n])})" for n in wanted)
