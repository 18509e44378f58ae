"""Many surveys at once, where a bad survey costs itself only.

A survey that breaks a rule is left out of the rows and listed in a status table
with the rule and a message; the others go through one plan, as they would
without it. Rows that the validity rules drop aren't lost either: the rows are
written once, each with the rule that drops it, so kept rows, dropped rows and
their counts are read from one table.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from surveyloom.functions.schema import CLEAN_COLUMNS, SURVEY_KEY, checked_kind
from surveyloom.operators.checks import require_columns
from surveyloom.operators.clean import clean
from surveyloom.operators.enrich import CPI_KEY, PPP_KEY, add_survey_vars, ppp_version, price_columns
from surveyloom.operators.framework import cache_id, long_type, reporting_level, short_type, survey_framework, with_cache_prefix
from surveyloom.operators.split import numeric_columns, split_alt_welfare, with_framework
from surveyloom.operators.validity import DROPPED, LAYOUTS, dropped_by, gd_type_code, rules_of, valid_group
from surveyloom.sources.config import scratch

@dataclass(frozen=True)
class Batch:
    """What a batch gave.

    ``rows``: the harmonised rows of the surveys that broke no rule. ``status``: a row per survey (and module of the data)
    that is missing there, with the rule it broke. ``counts``: (cache_id, dropped_by, n), NULL for kept rows; the counts of a
    measure add up to its rows in the data. ``dropped``: the dropped rows themselves. ``totals``: rows by rule over all
    surveys, seen while the rows were written.
    """

    rows: DataFrame
    status: DataFrame
    counts: DataFrame
    dropped: DataFrame
    totals: dict[str, int]


def surveys_of(df: DataFrame, kind: str) -> DataFrame:
    """(survey key, module, n_rows, bad_layout): one row per survey and module of the data."""
    module = F.col("module") if "module" in df.columns else F.lit(None).cast("string")
    keyed = df.select(*[F.col(k) for k in SURVEY_KEY], module.alias("module"), *(["gd_type"] if kind == "group" else []))
    rows = F.count(F.lit(1)).alias("n_rows")
    if kind == "group":
        known = F.coalesce(gd_type_code(F.col("gd_type")).isin(list(LAYOUTS)), F.lit(False))
        return keyed.groupBy(*SURVEY_KEY, "module").agg(rows, F.min(F.when(~known, F.coalesce("gd_type", F.lit("NULL")))).alias("bad_layout"))
    # the least text, though it is always NULL here, would have every task sort its rows
    return keyed.groupBy(*SURVEY_KEY, "module").agg(rows).withColumn("bad_layout", F.lit(None).cast("string"))


def framework_of_keys(pfw: DataFrame) -> DataFrame:
    """One row per key of the framework: how often it is there and in use, and what is said of the survey."""
    said = ["survey_year", "welfare_type", "oth_welfare1_type", "oth_welfare1_var", "cache_prefix"]
    used = with_cache_prefix(reporting_level(pfw)).groupBy(*SURVEY_KEY).agg(F.count(F.lit(1)).alias("n_used"), *[F.first(c).alias(c) for c in said])
    return pfw.groupBy(*SURVEY_KEY).agg(F.count(F.lit(1)).alias("n_framework")).join(used, SURVEY_KEY, "left")


def survey_rules(columns: list[str], alternatives: bool) -> dict[str, tuple[Column, Column]]:
    """Rule -> (whether a survey breaks it, message), in the order in which they are asked; over ``surveys_of`` with ``framework_of_keys``."""
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else F.coalesce(x.cast("string"), F.lit("NULL")) for x in parts])
    second = F.coalesce(F.col("oth_welfare1_type") != "", F.lit(False))
    alike = short_type(F.col("welfare_type")) == short_type(long_type(F.col("oth_welfare1_type")))
    rules = {
        "no_framework": (F.coalesce("n_used", F.lit(0)) == 0, F.lit("the framework has no row in use")),
        "framework_repeats": (F.col("n_framework") > 1, text("the framework has ", F.col("n_framework"), " rows")),
    }
    if alternatives:
        rules["cache_id_repeats"] = (second & alike, text("both measures have the cache id ", F.col("cache_id")))
        named = F.coalesce(F.col("oth_welfare1_var").isin(columns), F.lit(False))
        rules["no_such_column"] = (second & ~named, text("no numeric column ", F.col("oth_welfare1_var"), " for the second measure"))
    rules["unknown_layout"] = (F.col("bad_layout").isNotNull(), text("gd_type ", F.col("bad_layout"), " is no layout"))
    return rules


def single(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose key occurs once. For small tables: they are grouped."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest]).where("_n = 1").select(*df.columns)


def judged_surveys(df: DataFrame, pfw: DataFrame, kind: str, alternatives: bool, repeated: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``surveys_of`` with cache id, rule and message; a written table, for which only key columns of the data are read.

    ``repeated``: rule -> (table of keys that repeat, message).
    """
    found = surveys_of(df, kind).join(framework_of_keys(pfw), SURVEY_KEY, "left")
    found = found.withColumn("cache_id", F.when((F.col("n_framework") == 1) & (F.col("n_used") == 1), cache_id(F.col("cache_prefix"), F.col("module"))))
    rules = survey_rules(numeric_columns(df), alternatives)
    for rule, (keys, message) in repeated.items():
        found = found.join(keys.distinct().withColumn(f"_{rule}", F.lit(True)), keys.columns, "left")
        rules[rule] = (F.coalesce(F.col(f"_{rule}"), F.lit(False)), F.lit(message))
    first = lambda k: F.coalesce(*[F.when(rule[0], rule[1] if k else F.lit(name)) for name, rule in rules.items()])
    return stored(found.select(*SURVEY_KEY, "module", "cache_id", first(0).alias("rule"), first(1).alias("message"), "n_rows"), "surveys")


def stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def accounted(rows: DataFrame, kind: str) -> tuple[DataFrame, dict[str, int]]:
    """Cleaned rows with ``dropped_by``, in one table, and the number of rows by rule.

    No folder for each rule: a task would sort all its rows by rule, wide as they are, to have one file open at a time.
    """
    seen = Observation("rows by rule")
    rules = rules_of(kind)
    judged = rows.withColumn(DROPPED, dropped_by(kind))
    counted = [F.count_if(F.col(DROPPED).isNull()).alias("kept"), *[F.count_if(F.col(DROPPED) == r).alias(r) for r in rules]]
    table = stored(judged.observe(seen, *counted), "judged")
    return table, seen.get


def _batch(df: DataFrame, pfw: DataFrame, kind: str, alternatives: bool, repeated: dict[str, tuple[DataFrame, str]]) -> Batch:
    require_columns(df, SURVEY_KEY, "survey data")
    surveys = judged_surveys(df, pfw, kind, alternatives, repeated)
    # written, so that its size is known and it is broadcast: else all rows are dealt by survey, and a task sorts a whole survey
    framework = stored(survey_framework(surveys.where("rule IS NULL"), pfw, alternatives, validate=False), "framework")
    rows = split_alt_welfare(df, framework) if alternatives else with_framework(df, framework)
    table, totals = accounted(clean(rows, kind), kind)
    counts = table.groupBy("cache_id", DROPPED).agg(F.count(F.lit(1)).alias("n"))
    none = counts.groupBy("cache_id").agg(F.sum("n").alias("n_rows"), F.count_if(F.col(DROPPED).isNull()).alias("kept")).where("kept = 0")
    empty = none.join(framework.select(*SURVEY_KEY, "module", "cache_id"), "cache_id").select(
        *SURVEY_KEY, "module", "cache_id", F.lit("no_valid_rows").alias("rule"), F.concat(F.lit("none of "), F.col("n_rows").cast("string"), F.lit(" rows is valid")).alias("message"), "n_rows"
    )
    kept = table.where(F.col(DROPPED).isNull()).select("cache_id", *CLEAN_COLUMNS)
    return Batch(valid_group(kept) if kind == "group" else kept, surveys.where("rule IS NOT NULL").unionByName(empty), counts, table.where(F.col(DROPPED).isNotNull()), totals)


def process_batch(df: DataFrame, pfw: DataFrame, kind: str) -> Batch:
    """``process_data`` of many surveys: framework, cleaning and validity, without the alternative measure."""
    return _batch(df, pfw, checked_kind(kind), False, {})


def full_batch(df: DataFrame, pfw: DataFrame, cpi: DataFrame, ppp: DataFrame, pop: DataFrame, kind: str, versions: list[str] | None = None) -> Batch:
    """``full_chain`` of many surveys. A survey whose prices are there twice breaks a rule as well."""
    keys = lambda t, by, out: t.groupBy(*by).count().where("count > 1").select(*out)
    cpi, named = price_columns(cpi), ppp.withColumn("ppp_version", ppp_version())
    repeated = {
        "cpi_repeats": (keys(cpi, CPI_KEY, CPI_KEY[:3]), "the CPI table has a level of the survey twice"),
        "ppp_repeats": (keys(named, [*PPP_KEY, "ppp_version"], PPP_KEY[:1]), "the PPP table has a level of the country twice"),
    }
    batch = _batch(df, pfw, checked_kind(kind), True, repeated)
    prices = single(named, [*PPP_KEY, "ppp_version"]).select(*ppp.columns)
    return replace(batch, rows=add_survey_vars(batch.rows, single(cpi, CPI_KEY), prices, pop, kind, versions, validate=False))
