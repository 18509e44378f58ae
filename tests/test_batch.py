"""Many surveys at once: what a bad survey costs, and the account of dropped rows."""

import math

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import clean, framework, split, validity
from surveyloom.plans import batch, pipeline
from surveyloom.plans.results import captured
from tests.test_survey import GROUP, POP, micro, one, pfw, pfw_row  # noqa: F401

CPI = "country_code string, survey_year double, survey_acronym string, cpi_data_level string, cpi2017 double"
PPP = "country_code string, ppp_data_level string, ppp_year int, release_version string, adaptation_version string, ppp double"


def rules(found):
    return sorted((r.country_code, r.rule) for r in found.status.collect())


def test_one_bad_survey_of_three(spark, pfw):  # noqa: F811
    df = micro(spark, [one(), one("BBB"), one("CCC"), one("CCC", "2")])
    fw = pfw(pfw_row(), pfw_row("BBB"), pfw_row("BBB"), pfw_row("CCC"))
    found = batch.process_batch(df, fw, "micro")
    assert sorted(r.country_code for r in found.rows.collect()) == ["AAA", "CCC", "CCC"]
    (row,) = found.status.collect()
    assert (row.country_code, row.cache_id, row.rule, row.message, row.n_rows) == ("BBB", None, "framework_repeats", "the framework has 2 rows", 1)


def test_rows_are_those_of_the_good_surveys_alone(spark, pfw):  # noqa: F811
    rows = [one(c, str(k), 365.0 * k, k % 2) for c in ("AAA", "BBB", "CCC") for k in range(5)]
    df = micro(spark, rows)
    found = batch.process_batch(df, pfw(pfw_row(), pfw_row("CCC")), "micro").rows
    alone = pipeline.process_data(df.where("country_code <> 'BBB'"), pfw(pfw_row(), pfw_row("CCC")), "micro")
    assert found.columns == alone.columns and found.exceptAll(alone).count() == alone.exceptAll(found).count() == 0 and found.count() == 10


def test_every_rule(spark, pfw):  # noqa: F811
    names = ["OK", "NOFW", "UNUSED", "TWICE", "ALIKE", "NOCOL", "CPI2", "PPP2", "EMPTY", None]
    df = micro(spark, [one(c, "1", None if c == "EMPTY" else 365.0) for c in names]).withColumn("other", F.lit(1.0))
    fw = pfw(
        pfw_row("OK", other="c", var="other"), pfw_row("UNUSED", used=0), pfw_row("TWICE"), pfw_row("TWICE", used=0), pfw_row("ALIKE", other="Inc", var="other"), pfw_row("NOCOL", other="c", var="hhid"),
        pfw_row("CPI2"), pfw_row("PPP2"), pfw_row("EMPTY"), pfw_row(None),
    )
    cpi = spark.createDataFrame([(c, 2012.0, "SUR", "national", 1.0) for c in ("OK", "PPP2", "CPI2", "CPI2", "EMPTY")], CPI)
    ppp = spark.createDataFrame([(c, "urban", 2017, "v1", "v2", 2.0) for c in ("OK", "PPP2", "PPP2", "CPI2", "EMPTY")], PPP)
    pop = spark.createDataFrame([("OK", "urban", 2012.0, 5.0)], POP)
    found = batch.full_batch(df, fw, cpi, ppp, pop, "micro", ["ppp_2017_01_02"])
    assert {(r.country_code, r.rule) for r in found.status.collect()} == {
        (None, "no_framework"), ("NOFW", "no_framework"), ("UNUSED", "no_framework"), ("TWICE", "framework_repeats"), ("ALIKE", "cache_id_repeats"), ("NOCOL", "no_such_column"),
        ("CPI2", "cpi_repeats"), ("PPP2", "ppp_repeats"), ("EMPTY", "no_valid_rows"),
    }
    assert sorted((r.cache_id, r.welfare_ppp_2017_01_02) for r in found.rows.collect()) == [("OK_2012_SUR_D2_CON_GPWG", 1.0 / 365 / 2), ("OK_2012_SUR_D2_INC_GPWG", 0.5)]
    message = {r.country_code: r.message for r in found.status.collect()}
    assert message["NOCOL"] == "no numeric column hhid for the second measure" and message["ALIKE"] == "both measures have the cache id ALIKE_2012_SUR_D2_INC_GPWG"
    assert message["EMPTY"] == "none of 1 rows is valid"


def test_unknown_layouts(spark, pfw):  # noqa: F811
    g = lambda c, t: (c, 2012.0, "SUR", "BIN", 1.0, 1.0, 1, "income", t)
    df = spark.createDataFrame([g("AAA", "T02"), g("BBB", "T02"), g("BBB", "T09"), g("CCC", None)], GROUP)
    found = batch.process_batch(df, pfw(pfw_row(), pfw_row("BBB"), pfw_row("CCC")), "group")
    assert rules(found) == [("BBB", "unknown_layout"), ("CCC", "unknown_layout")]
    assert {r.message for r in found.status.collect()} == {"gd_type T09 is no layout", "gd_type NULL is no layout"}
    assert [(r.country_code, r.weight, r.welfare) for r in found.rows.collect()] == [("AAA", 1.0, 1.0)]


def test_modules_of_a_survey_are_judged_apart(spark, pfw):  # noqa: F811
    g = lambda m, t: ("AAA", 2012.0, "SUR", m, 1.0, 1.0, 1, "income", t)
    df = spark.createDataFrame([g("BIN", "T02"), g("GROUP", "T09"), g(None, "T01")], GROUP)
    found = batch.process_batch(df, pfw(pfw_row()), "group")
    assert [(r.module, r.cache_id, r.rule) for r in found.status.collect()] == [("GROUP", "AAA_2012_SUR_D2_INC_GROUP", "unknown_layout")]
    assert sorted(r.cache_id for r in found.rows.collect()) == ["AAA_2012_SUR_D2_INC_", "AAA_2012_SUR_D2_INC_BIN"]


def test_data_without_modules(spark, pfw):  # noqa: F811
    df = micro(spark, [one(), one("BBB"), one("CCC", "1", -1.0)]).drop("module")
    found = batch.process_batch(df, pfw(pfw_row(), pfw_row("CCC")), "micro")
    assert rules(found) == [("BBB", "no_framework"), ("CCC", "no_valid_rows")] and [r.cache_id for r in found.rows.collect()] == ["AAA_2012_SUR_D2_INC_"]


def test_counts_add_up(spark, pfw):  # noqa: F811
    nan = float("nan")
    values = [(1.0, 1.0), (None, 1.0), (nan, 1.0), (-1.0, 1.0), (1.0, None), (1.0, nan), (1.0, 0.0), (-1.0, None), (0.0, 2.0)]
    df = micro(spark, [one(c, str(k), w, 1, v) for c in ("AAA", "BBB") for k, (w, v) in enumerate(values)])
    found = batch.process_batch(df, pfw(pfw_row(), pfw_row("BBB")), "micro")
    want = {None: 2, "welfare_unknown": 2, "welfare_negative": 2, "weight_unknown": 2, "weight_not_positive": 1}
    for c in ("AAA", "BBB"):
        assert {r.dropped_by: r.n for r in found.counts.where(F.col("cache_id").startswith(c)).collect()} == want
    assert found.totals == {"kept" if r is None else r: 2 * n for r, n in want.items()}
    assert found.rows.count() + found.dropped.count() == df.count() == sum(found.totals.values())
    rows = clean.clean(split.with_framework(df, framework.all_frameworks(pfw(pfw_row(), pfw_row("BBB")))), "micro")
    assert validity.valid_micro(rows).count() == found.rows.count()
    assert all(not math.isnan(r.welfare) for r in found.rows.collect())


def test_no_task_sorts_its_rows(spark, pfw, monkeypatch):  # noqa: F811
    plans, seen = {}, batch.stored

    def noted(df, name, *by):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return seen(df, name, *by)

    monkeypatch.setattr(batch, "stored", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        df = micro(spark, [one(), one("BBB", "1", -1.0)])
        found = batch.process_batch(df, pfw(pfw_row(), pfw_row("BBB")), "micro")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # rows meet the framework without being dealt by survey, and are written without a folder for each rule
    assert "BroadcastHashJoin" in plans["judged"] and "SortMergeJoin" not in plans["judged"]
    assert not any("dropped_by=" in f for f in found.dropped.inputFiles()) and found.dropped.count() == found.rows.count() == 1
    assert "SortAggregate" not in batch.surveys_of(df, "micro")._jdf.queryExecution().sparkPlan().toString()


@pytest.mark.parametrize("kind", ["micro", "group"])
def test_no_surveys(spark, pfw, kind):  # noqa: F811
    df = micro(spark, []) if kind == "micro" else spark.createDataFrame([], GROUP)
    found = batch.process_batch(df, pfw(pfw_row()), kind)
    assert found.rows.count() == found.status.count() == found.counts.count() == 0 and sum(found.totals.values()) == 0


def test_captured_rows_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    result = captured(lambda: spark.range(7).mapInArrow(counted, "id long"))
    assert result.status == "ok" and result.frame.count() == 7 and seen.value == 7
