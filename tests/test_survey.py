"""Rules of harmonisation on small hand-computed inputs, and invariants of the whole chain."""

import warnings

import pytest
from pyspark.sql import functions as F

from surveyloom.functions import nulls
from surveyloom.functions.schema import CLEAN_COLUMNS, CLEAN_SCHEMA, CLEAN_TYPES, DATA_LEVELS, RAW_NAMES, SURVEY_KEY
from surveyloom.operators import checks, clean, enrich, framework, population, profile, split, validity
from surveyloom.plans import pipeline
from surveyloom.plans.adapters import view
from surveyloom.plans.results import captured
from surveyloom.plans.survey_queries import QUERIES
from surveyloom.sources import inventory, surveys, versions
from surveyloom.sources.config import Locations

PFW = (
    "country_code string, surveyid_year double, survey_acronym string, survey_year double, cpi_domain int, ppp_domain int, gdp_domain int, pce_domain int, pop_domain int,"
    " inpovcal int, use_imputed int, welfare_type string, oth_welfare1_type string, oth_welfare1_var string"
)


def pfw_row(country="AAA", year=2012.0, acronym="SUR", survey_year=2012.0, domains=(1, 2, 1, 1, 2), used=1, imputed=0, kind="income", other="", var=""):
    return (country, year, acronym, survey_year, *domains, used, imputed, kind, other, var)


@pytest.fixture
def pfw(spark):
    return lambda *rows: spark.createDataFrame(list(rows), PFW)


def micro(spark, rows, extra="weight double"):
    return spark.createDataFrame(rows, f"country_code string, surveyid_year double, survey_acronym string, module string, hhid string, pid string, welfare double, urban int, {extra}")


def one(country="AAA", hh="1", welfare=365.0, urban=1, *more):
    return (country, 2012.0, "SUR", "GPWG", hh, "1", welfare, urban, *(more or (2.0,)))


def test_single_values_count_null(spark):
    df = spark.createDataFrame([("a", "a", None), ("a", None, None)], "x string, y string, z string")
    assert profile.uniq_vars(df) == ["x", "z"]
    assert profile.uniq_vars_to_list(df) == {"x": "a", "z": None}
    rest, values = profile.uniq_vars_to_attr(df)
    assert rest.columns == ["y"] and values == {"x": "a", "z": None}
    assert rest.schema["y"].metadata["single_valued"]["x"] == "a"
    assert profile.uniq_vars(df.limit(0)) == []


def test_distinct_counts(spark):
    nan = float("nan")
    rows = [("a", None, 1.0, nan, 1), ("a", None, 0.0, nan, 2), ("b", None, -0.0, None, 2)]
    df = spark.createDataFrame(rows, "x string, y string, z double, `w.w` double, k int")
    assert {r.variable: r.n_values for r in profile.distinct_counts(df).collect()} == {"x": 2, "y": 1, "z": 2, "w.w": 2, "k": 2}
    assert profile.distinct_counts(df.limit(0)).count() == 0


def test_no_row_is_expanded_to_all_columns(spark, sf_dir):
    assert "Expand" not in QUERIES["uniq_vars"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()


def test_null_helpers(spark):
    df = spark.createDataFrame([(1, 2, 1.0), (None, 3, 1.0)], "a int, b int, w double")
    assert [r[0] for r in df.select(nulls.greatest_na(F.col("a"), F.col("b"))).collect()] == [2, None]
    assert df.agg(nulls.count_distinct_na("a")).first()[0] == 2
    assert df.select(nulls.paste_na(F.col("a"), F.col("b"))).collect()[1][0] == "NA_3"
    assert df.agg(nulls.weighted_mean_na(F.col("a"), F.col("w"))).first()[0] is None
    assert df.agg(nulls.weighted_mean_na(F.col("b"), F.col("w"))).first()[0] == 2.5
    assert df.where("a IS NULL").agg(nulls.sum_na_rm("a")).first()[0] == 0
    right = spark.createDataFrame([(None, "x")], "a int, v string")
    assert nulls.join_nullsafe(df, right, ["a"]).where("v = 'x'").count() == 1
    assert nulls.join_nullsafe(df, right, ["a"], null_keys_match=False).where("v = 'x'").count() == 0


def test_cache_id_and_alternatives(spark, pfw):
    df = micro(spark, [one()])
    rows = framework.survey_framework(df, pfw(pfw_row(other="c", var="hhid"))).orderBy("is_alt_welf").collect()
    assert [r.cache_id for r in rows] == ["AAA_2012_SUR_D2_INC_GPWG", "AAA_2012_SUR_D2_CON_GPWG"]
    assert rows[1].oth_welfare1_type is None and rows[1].welfare_type == "consumption"
    no_domain = framework.survey_framework(df, pfw(pfw_row(domains=(1, None, 1, 1, 1)))).first()
    assert no_domain.reporting_level is None and no_domain.cache_id == "AAA_2012_SUR_DNA_INC_GPWG"


@pytest.mark.parametrize("bad", [[pfw_row(), pfw_row()], [pfw_row(country="BBB")], [pfw_row(used=0)], [pfw_row(other="income", var="hhid")]])
def test_framework_errors(spark, pfw, bad):
    with pytest.raises(checks.SurveyError):
        framework.survey_framework(micro(spark, [one()]), pfw(*bad))


def test_split_copies_only_surveys_with_two_measures(spark, pfw):
    df = micro(spark, [one("AAA", "1", 10.0, 1, 2.0, 7.0), one("BBB", "1", 20.0, 1, 2.0, 8.0)], "weight double, other double")
    fw = framework.survey_framework(df, pfw(pfw_row(other="Con", var="other"), pfw_row(country="BBB")))
    got = sorted((r.country_code, r.welfare_type, r.welfare) for r in split.split_alt_welfare(df, fw).collect())
    assert got == [("AAA", "CON", 7.0), ("AAA", "INC", 10.0), ("BBB", "INC", 20.0)]


def cleaned(spark, pfw, df, *rows, **kw):
    return clean.clean(split.with_framework(df, framework.survey_framework(df, pfw(*rows))), "micro", **kw)


def test_micro_rules(spark, pfw):
    df = micro(spark, [one(), one(hh="2", urban=0), one(hh="3", urban=9), one(hh="4", urban=None)], "weight double")
    df = df.withColumns({"educat4": F.lit(2), "educat5": F.lit(7), "literacy": F.lit(0), "male": F.lit(1)})
    out = cleaned(spark, pfw, df, pfw_row(imputed=1), keep_extra=True).orderBy("hhid").collect()
    assert [r.welfare for r in out] == [1.0] * 4 and {r.distribution_type for r in out} == {"imputed"}
    assert [r.ppp_data_level for r in out] == ["urban", "rural", None, None]
    assert {r.cpi_data_level for r in out} == {"national"}
    assert (out[0].recoded_educat4, out[0].recoded_educat5, out[0].recoded_literacy, out[0].recoded_male) == ("Primary", None, "no", "male")
    assert out[0].gender is None and out[0].area is None and out[0].survey_year == 2012.0
    assert cleaned(spark, pfw, df, pfw_row()).drop("cache_id").schema.simpleString() == CLEAN_SCHEMA.simpleString()


def test_unset_domain_keeps_an_existing_level_of_some_columns(spark, pfw):
    df = micro(spark, [one()]).withColumns({"gdp_data_level": F.lit("x"), "ppp_data_level": F.lit("x")})
    row = cleaned(spark, pfw, df, pfw_row(domains=(1, 3, 3, 3, 1))).first()
    assert row.gdp_data_level == "x" and row.ppp_data_level is None and row.pce_data_level is None


def test_domain_two_needs_urban(spark, pfw):
    df = micro(spark, [one()]).drop("urban")
    assert cleaned(spark, pfw, df, pfw_row(domains=(1, 1, 1, 1, 1))).count() == 1
    with pytest.raises(Exception, match="no column urban"):
        cleaned(spark, pfw, df, pfw_row()).collect()


@pytest.mark.parametrize("name,expected", [("weight", 2.0), ("weight_p", 2.0), ("weight_h", 2.0), ("other", 0.5)])
def test_weight_fallback(spark, pfw, name, expected):
    df = micro(spark, [one(), one(hh="2")]).withColumnRenamed("weight", name)
    assert {r.weight for r in cleaned(spark, pfw, df, pfw_row()).collect()} == {expected}


GROUP = "country_code string, surveyid_year double, survey_acronym string, module string, welfare double, weight double, urban int, welfare_type string, gd_type string"


def test_group_rules(spark, pfw):
    g = lambda c, w, u, t="T02": (c, 2012.0, "SUR", "BIN", w, 1.0, u, "income", t)
    df = spark.createDataFrame([g("AAA", 1.0, 1), g("AAA", 3.0, 1), g("BBB", 1.0, 1), g("BBB", 1.0, 0), g("CCC", 1.0, None), g("CCC", 2.0, 9)], GROUP)
    fw = framework.survey_framework(df, pfw(pfw_row(), pfw_row("BBB"), pfw_row("CCC", domains=(1, 1, 1, 1, 1))))
    out = clean.clean(split.with_framework(df, fw), "group")
    kinds = {r.country_code: r.distribution_type for r in out.collect()}
    assert kinds == {"AAA": "group", "BBB": "aggregate", "CCC": "group"}
    assert sorted(r.area for r in out.where("country_code = 'CCC'").collect()) == ["", "national"]
    lorenz = sorted((r.weight, r.welfare) for r in validity.validity_clean(out, "group").where("country_code = 'AAA'").collect())
    assert lorenz == [(0.5, 0.25), (1.0, 1.0)]


def test_validity(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, 1.0), (1.0, None), (-1.0, 1.0), (1.0, 0.0), (0.0, 2.0)], "welfare double, weight double")
    assert validity.valid_micro(df).count() == 2
    codes = spark.createDataFrame([("T01",), ("T05",), ("x",)], "g string").select(validity.gd_type_code(F.col("g"))).collect()
    assert [r[0] for r in codes] == [1, 5, None]


def test_ppp_names_and_repeated_cells(spark):
    schema = "country_code string, ppp_data_level string, ppp_year int, release_version string, adaptation_version string, ppp double"
    row = ("AAA", "national", 2017, "v1", "v2", 2.0)
    assert enrich.ppp_to_wide(spark.createDataFrame([row], schema)).columns[-1] == "ppp_2017_01_02"
    with pytest.raises(checks.SurveyError):
        enrich.ppp_to_wide(spark.createDataFrame([row, row], schema))


def test_base_years_warn():
    with pytest.warns(UserWarning, match="differ"):
        assert enrich.base_years(["cpi2005", "cpi2011", "cpi2017"], ["ppp_2011_01_01", "ppp_2017_01_02"]) == ["2011", "2017"]
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert enrich.base_years(["cpi2011"], ["ppp_2011_01_01", "ppp_2011_02_01"]) == ["2011"]


def test_level_rank_follows_the_sort_key(spark):
    def rank(values):
        rows = [("A", 2000.0, float(i), str(i), "1", "c", v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "country_code string, surveyid_year double, welfare double, hhid string, pid string, cache_id string, v string")
        return enrich.level_ranks(df.withColumns({c: F.col("v") for c in DATA_LEVELS}), "micro").first().cpi_data_level

    assert [rank(v) for v in (["national"], ["rural", "urban"], ["urban", "rural"], ["urban"], [None], ["national", None], [""])] == [1, 2, 3, 3, 3, 3, 3]


TOTAL = "cache_id string, country_code string, survey_year double, reporting_level string, weight double"
POP = "country_code string, pop_data_level string, year double, pop double"


@pytest.mark.parametrize(
    "survey_year,pops,expected",
    [(2015.5, [(2015.0, 100.0), (2016.0, 110.0)], 105.0 / 50), (2015.0, [(2013.0, 80.0), (2018.0, 90.0)], 80.0 / 50), (2015.0, [(2015.0, 70.0), (2016.0, 1.0)], 70.0 / 50)],
)
def test_nearest_year_factor(spark, survey_year, pops, expected):
    totals = spark.createDataFrame([("c", "A", survey_year, "urban", 50.0)], TOTAL)
    pop = spark.createDataFrame([("A", "urban", *p) for p in pops], POP)
    assert population.pop_factor(pop, totals).first().pop_fact == pytest.approx(expected)


def test_invariants_of_the_chain(spark, sf_dir):
    md, pfw, cpi, ppp, pop = (view(spark, sf_dir, n) for n in ("md", "pfw", "cpi", "ppp", "pop"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = pipeline.full_chain(md, pfw, cpi, ppp, pop, "micro", validate=False).cache()
    assert out.columns[1 : 1 + len(CLEAN_COLUMNS)] == CLEAN_COLUMNS
    off = out.where("abs(welfare_ppp_2017_01_02 * ppp_2017_01_02 * cpi2017 - welfare_lcu) > 1e-9 * abs(welfare_lcu)")
    assert off.count() == 0
    # adjusted weights add up to the population of the nearest years
    adjusted = out.where("pop_fact IS NOT NULL")
    totals = population.survey_totals(adjusted)
    assert population.pop_factor(pop, totals).where("abs(pop_fact - 1) > 1e-9").count() == 0 and totals.count() > 0
    # the fork doubles the rows of surveys with a second measure
    n = lambda q: out.where(q).groupBy("country_code").pivot("welfare_type", ["INC", "CON"]).count()
    both = n("true").where("INC IS NOT NULL AND CON IS NOT NULL")
    assert both.count() > 0 and both.where("INC <> CON").count() == 0
    # one survey alone gives what it gives in the batch
    name = both.first().country_code
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        alone = pipeline.full_chain(md.where(F.col("country_code") == name), pfw, cpi, ppp, pop, "micro", validate=False)
    keep = [c for c in out.columns if c not in ("weight", "pop_fact")]
    batch = out.where(F.col("country_code") == name).select(keep)
    assert alone.select(keep).exceptAll(batch).count() == 0 and alone.count() == batch.count()
    out.unpersist()


def test_process_data_and_errors_as_values(spark, pfw):
    df = micro(spark, [one()])
    assert pipeline.process_data(df, pfw(pfw_row()), "micro").columns == ["cache_id", *CLEAN_COLUMNS]
    assert pipeline.process_data(df, pfw(pfw_row()), "other") is df
    ok = captured(pipeline.process_data, df, pfw(pfw_row()), "micro")
    assert ok.status == "ok" and ok.frame.count() == 1
    bad = captured(pipeline.process_data, df, pfw(pfw_row(country="BBB")), "micro")
    assert bad.status == "error" and bad.message.startswith("Error: framework has no row")
    assert captured(lambda: warnings.warn("w")).message == "Warning: w"
    with pytest.raises(ValueError):
        clean.clean(df, "other")


def test_inventory(spark, tmp_path):
    csv = tmp_path / "inventory.csv"
    line = lambda sid, t="1/2/2020 3:04:05 PM", extra="x": f"D:\\raw\\A\\{sid}.dta,{t},3/4/2021 13:00:00,{extra}\n"
    csv.write_text(
        " FullName , CreationTime,LastWriteTime,Note\n"
        + line("BBB_2010_SUR_V01_M_V02_A_COL_GPWG") + line("AAA_2010_SUR_V01_M_V02_A_COL_HIST", extra='""') + line("AAA_2010_SUR_V01_M_V02_A_COL_RAW")
        + line("CCC_2010_SUR_V01_M_V02_A_COL_GPWG", t="soon") + line("short_id")
    )
    out = str(tmp_path / "out")
    assert inventory.update_inventory(spark, str(csv), out, "D:/raw/") is True
    rows = versions.read_version(spark, out).orderBy("country_code").collect()
    assert [r.survey_id for r in rows] == ["AAA_2010_SUR_V01_M_V02_A_COL_HIST", "BBB_2010_SUR_V01_M_V02_A_COL_GPWG"]
    assert rows[0].fullname == "A/AAA_2010_SUR_V01_M_V02_A_COL_HIST.dta" and rows[0].note == "" and rows[0].module == "HIST"
    assert str(rows[0].creationtime) == "2020-01-02 15:04:05"
    assert inventory.update_inventory(spark, str(csv), out, "D:/raw/") is False
    assert inventory.update_inventory(spark, str(csv), out, "D:/raw/", force=True) is True
    csv.write_text(csv.read_text() + line("DDD_2010_SUR_V01_M_V02_A_COL_ALL"))
    assert inventory.update_inventory(spark, str(csv), out, "D:/raw/") is True
    with pytest.raises(checks.SurveyError):
        inventory.read_inventory(spark, str(tmp_path / "none.csv"))


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("a", "AAA", 2012.0), ("b", "BBB", 2013.0)], "cache_id string, country_code string, surveyid_year double")
    surveys.write_surveys(df, str(tmp_path / "s"))
    assert surveys.load_surveys(spark, str(tmp_path / "s"), "AAA").count() == 1
    assert surveys.load_surveys(spark, str(tmp_path / "s"), ["AAA", "BBB"], 2013.0).count() == 1
    df.write.parquet(str(tmp_path / "pfw.parquet"))
    assert surveys.load_auxiliary(spark, str(tmp_path), "pfw").count() == 2
    with pytest.raises(checks.SurveyError):
        surveys.load_auxiliary(spark, str(tmp_path), "other")
    assert surveys.bundled() == ["clean_columns.csv", "raw_names.csv"]
    assert [x.strip() for x in open(surveys.bundled("clean_columns.csv"))][1:] == [f"{c},{t}" for c, t in CLEAN_TYPES.items()]
    assert [x.strip() for x in open(surveys.bundled("raw_names.csv"))][1:] == [f"{a},{b}" for a, b in RAW_NAMES.items()]
    raw = spark.createDataFrame([("AAA", 1)], "countrycode string, sim int")
    assert surveys.rename_raw(raw).columns == ["country_code", "imputation_id"]


def test_filters_and_columns_reach_the_scan(spark, tmp_path, capsys):
    spark.createDataFrame([("AAA", 2012.0, 1.0, 2.0)], "country_code string, surveyid_year double, welfare double, other double").write.parquet(str(tmp_path / "t"))
    surveys.load_surveys(spark, str(tmp_path / "t"), "AAA").select("welfare").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(country_code,AAA)" in plan.replace(" ", "") and "other" not in plan


def test_key_is_the_survey_key():
    assert SURVEY_KEY == ["country_code", "surveyid_year", "survey_acronym"]


def test_locations(spark, tmp_path, monkeypatch):
    monkeypatch.delenv("SURVEYLOOM_ROOT", raising=False)
    with pytest.raises(checks.SurveyError):
        Locations.of()
    monkeypatch.setenv("SURVEYLOOM_ROOT", f"{tmp_path}/")
    at = Locations.of()
    assert at.inventory_file == f"{tmp_path}/raw/_Inventory/DLWRAW_all_DTAs.csv" and Locations.of(raw="s3a://x/y/").inventory_folder == "s3a://x/y/_Inventory"
    (tmp_path / "raw" / "_Inventory").mkdir(parents=True)
    (tmp_path / "raw" / "_Inventory" / "DLWRAW_all_DTAs.csv").write_text(f"FullName,CreationTime,LastWriteTime\n{tmp_path}/raw/AAA_2010_SUR_V01_M_V02_A_COL_GPWG.dta,1/2/2020 3:04:05 PM,1/2/2020 3:04:05 PM\n")
    assert [inventory.update_survey_inventory(spark) for _ in range(2)] == [True, False] and inventory.update_survey_inventory(spark, force=True)
    assert versions.read_version(spark, at.inventory_table).first().fullname == "/raw/AAA_2010_SUR_V01_M_V02_A_COL_GPWG.dta"


def test_files_are_written_in_order(spark, tmp_path):
    rows = [("s", "AAA", 2012.0, float(k * 7 % 40), str(k), "1", "rural" if k % 3 else "urban") for k in range(40)]
    df = spark.createDataFrame(rows, "cache_id string, country_code string, surveyid_year double, welfare double, hhid string, pid string, reporting_level string").repartition(3)
    surveys.write_surveys(df, str(tmp_path / "s"), "micro")
    for file in (tmp_path / "s").rglob("*.parquet"):
        found = [(r.reporting_level, r.welfare) for r in spark.read.parquet(str(file)).collect()]
        assert found == sorted(found) and found


def test_repeated_prices_are_errors_without_validation_too(spark):
    schema = "country_code string, ppp_data_level string, ppp_year int, release_version string, adaptation_version string, ppp double"
    row = ("AAA", "national", 2017, "v1", "v2", 2.0)
    wide = enrich.ppp_to_wide(spark.createDataFrame([row], schema), ["ppp_2017_01_02", "ppp_2011_01_01"], validate=False)
    assert [tuple(r) for r in wide.collect()] == [("AAA", "national", 2.0, None)]
    with pytest.raises(Exception, match="isn't unique"):
        enrich.ppp_to_wide(spark.createDataFrame([row, row], schema), ["ppp_2017_01_02"], validate=False).collect()
    cpi = spark.createDataFrame([("AAA", 2012.0, "S", "national", 1.0)] * 2, "country_code string, survey_year double, survey_acronym string, cpi_data_level string, cpi2017 double")
    with pytest.raises(Exception, match="CPI isn't unique"):
        checks.unique_in_plan(cpi, enrich.CPI_KEY, "CPI").collect()


def test_population_windows_are_the_plain_operators(spark):
    """``adjust_population`` by windows gives the factors of ``pop_factor``, units that share a level and unknown population included."""
    import random

    rng = random.Random(4)
    rows, pops = [], []
    for c in "ABCDEF":
        for level in ("urban", "rural", None):
            for year in (2010.0, 2012.5) if c in "AB" else (2011.0,):
                if c != "F" or level == "urban":
                    rows += [(c, c, year, level, rng.choice([None, rng.uniform(1, 9)]), "group" if c == "E" else "micro") for _ in range(rng.randrange(1, 4))]
            if c != "D" or level == "urban":
                pops += [(c, level, float(y), None if c == "C" and y == 2011 else rng.uniform(10, 90)) for y in range(2009, 2014)]
    df = spark.createDataFrame(rows, "cache_id string, country_code string, survey_year double, reporting_level string, weight double, distribution_type string")
    pop = spark.createDataFrame(pops, POP)
    got = {(r.cache_id, r.reporting_level): r.pop_fact for r in population.adjust_population(df, pop).collect()}
    want = {(r.cache_id, r.reporting_level): r.pop_fact for r in population.pop_factor(pop, population.survey_totals(df)).collect()}
    assert set(got) >= set(want) and len(got) == 16
    for key, fact in got.items():
        assert fact == (pytest.approx(want[key]) if key[0] not in "EF" and want.get(key) is not None else None), key


def test_repeated_framework_keys_stop_the_run_itself(spark, pfw):
    df = micro(spark, [one(), one("BBB"), one("CCC")])
    twice = pfw(pfw_row(), pfw_row("BBB"), pfw_row("BBB", used=0), pfw_row("CCC"))
    with pytest.raises(Exception, match=r"framework isn't unique by country_code.*\[BBB, 2012.0, SUR\] occurs 2 times"):
        pipeline.process_data(df, twice, "micro", validate=False).collect()
    alike = pfw(pfw_row(), pfw_row("BBB", other="Income", var="welfare"), pfw_row("CCC", used=0, other="Income", var="welfare"))
    with pytest.raises(Exception, match=r"both measures of \[BBB, 2012.0, SUR\] have one type"):
        split.split_alt_welfare(df, framework.all_frameworks(alike)).select("hhid").collect()
    # only the second measure matters here, and surveys out of use don't
    assert pipeline.process_data(df, alike, "micro", validate=False).count() == 2


def test_a_guard_is_no_job_of_its_own(spark, pfw):
    df, fw = micro(spark, [one()]), pfw(pfw_row(), pfw_row())
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("guard", "guard")
    rows = pipeline.process_data(df, fw, "micro", validate=False)
    assert tracker.getJobIdsForGroup("guard") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    with pytest.raises(Exception, match="isn't unique"):
        rows.write.format("noop").mode("overwrite").save()


def test_null_survey_keys_meet_nothing(spark, pfw):
    df = micro(spark, [one(None), one()])
    rows = split.with_framework(df, framework.all_frameworks(pfw(pfw_row(None), pfw_row())))
    assert [r.country_code for r in rows.collect()] == ["AAA"]


def test_the_split_reads_only_columns_that_the_framework_names(spark, pfw, tmp_path, capsys):
    wide = micro(spark, [one("AAA"), one("BBB")]).withColumns({f"v{k}": F.lit(float(k)) for k in range(200)})
    wide.write.parquet(str(tmp_path / "wide"))
    df = spark.read.parquet(str(tmp_path / "wide"))
    fw = pfw(pfw_row(other="c", var="v17"), pfw_row("BBB", other="c", var="v42"), pfw_row("DDD", other="c", var="elsewhere"))
    assert split.alternative_columns(df, fw) == ["v17", "v42"]
    rows = split.split_alt_welfare(df, framework.all_frameworks(fw)).select("cache_id", "welfare")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    rows.explain()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in capsys.readouterr().out.split("ReadSchema: struct<")[1:] if "welfare:" in x.split(">")[0]]
    assert scans and all({c.split(":")[0] for c in x.split(">")[0].split(",") if c.startswith("v")} == {"v17", "v42"} for x in scans)
    assert sorted(r.welfare for r in rows.collect()) == [17.0, 42.0, 365.0, 365.0]


@pytest.mark.parametrize("var", ["nowhere", "hhid", "", None])
def test_a_second_measure_without_a_column_is_an_error(spark, pfw, var):
    df = micro(spark, [one(), one("BBB")])
    fw = framework.all_frameworks(pfw(pfw_row(), pfw_row("BBB", other="c", var=var)))
    assert split.split_alt_welfare(df.where("country_code = 'AAA'"), fw).count() == 1
    with pytest.raises(Exception, match="for the second measure of BBB_2012_SUR_D2_CON_GPWG"):
        split.split_alt_welfare(df, fw).collect()


def test_the_framework_prunes_folders(spark, sf_dir, tmp_path, capsys):
    view(spark, sf_dir, "md").write.partitionBy("country_code", "surveyid_year").parquet(str(tmp_path / "md"))
    for name in ("pfw", "cpi", "ppp", "pop"):
        view(spark, sf_dir, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    aux = {n: surveys.load_auxiliary(spark, str(tmp_path), n) for n in surveys.AUXILIARY}
    names = [r[0] for r in view(spark, sf_dir, "md").join(aux["pfw"].where("inpovcal = 1"), SURVEY_KEY).select("country_code").distinct().orderBy("country_code").limit(2).collect()]
    few = aux["pfw"].where(F.col("country_code").isin(names))
    df = surveys.load_surveys(spark, str(tmp_path / "md"))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = pipeline.full_chain(df, few, aux["cpi"], aux["ppp"], aux["pop"], "micro", validate=False)
    out.explain()
    plan = capsys.readouterr().out
    assert "dynamicpruning#" in plan
    assert {r.country_code for r in out.select("country_code").distinct().collect()} == set(names) and len(names) == 2
