"""Versioned tables, time stamps, and the order of rows in files."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from surveyloom.operators import checks
from surveyloom.plans.survey_queries import QUERIES
from surveyloom.sources import inventory, surveys, versions


def folders(path):
    return sorted(x.name for x in (path / "data").iterdir()) if (path / "data").exists() else []


def test_versions(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    assert versions.current(spark, path) is None and versions.versions(spark, path) == []
    with pytest.raises(checks.SurveyError, match="no version"):
        versions.read_version(spark, path)
    assert versions.save_version(df, path, notes={"lost": 3})
    # the same rows in another order are no new version, and leave nothing behind
    assert not versions.save_version(df.orderBy(F.desc("id")), path)
    assert len(folders(tmp_path / "t")) == 1
    assert versions.save_version(df, path, force=True)
    assert versions.save_version(df.where("id = 1"), path)
    assert [v.number for v in versions.versions(spark, path)] == [1, 2, 3] and versions.versions(spark, path)[0].notes == {"lost": 3}
    assert [r.id for r in versions.read_version(spark, path).collect()] == [1]
    assert versions.read_version(spark, path, 1).count() == 2
    with pytest.raises(checks.SurveyError, match="no version 9"):
        versions.read_version(spark, path, 9)
    (tmp_path / "t" / "data" / "left-behind").mkdir()
    assert versions.remove_versions(spark, path, keep=1) == 3
    assert [v.number for v in versions.versions(spark, path)] == [3] and versions.read_version(spark, path).count() == 1
    # numbers go on
    assert versions.save_version(df, path) and versions.current(spark, path).number == 4


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    path, df = str(tmp_path / "t"), spark.range(100).withColumn("x", F.col("id") * 2)
    assert versions.save_version(df, path)
    broken = df.withColumn("x", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken row"):
        versions.save_version(broken, path)
    assert versions.read_version(spark, path).count() == 100 and versions.current(spark, path).number == 1
    assert len(folders(tmp_path / "t")) == 1


def test_a_version_is_not_published_twice(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), spark.range(3)
    assert versions.save_version(df, path)
    stale = versions.current(spark, path)
    assert versions.save_version(spark.range(4), path)
    # a writer that began before the other one ended
    monkeypatch.setattr(versions, "current", lambda *_: stale)
    with pytest.raises(checks.SurveyError, match="another writer"):
        versions.save_version(spark.range(5), path)
    monkeypatch.undo()
    assert versions.read_version(spark, path).count() == 4 and len(folders(tmp_path / "t")) == 2
    assert not [x for x in (tmp_path / "t" / "manifests").iterdir() if x.name.startswith(".") and not x.name.endswith(".crc")]


def test_writers_at_once(spark, tmp_path):
    path, ended = str(tmp_path / "t"), []

    def save(k):
        try:
            ended.append(versions.save_version(spark.range(k + 1), path))
        except checks.SurveyError:
            ended.append(None)

    threads = [threading.Thread(target=save, args=(k,)) for k in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = versions.versions(spark, path)
    assert len(ended) == 4 and [v.number for v in found] == list(range(1, 1 + sum(map(bool, ended))))
    assert all(versions.read_version(spark, path, v.number).count() == v.rows for v in found)


def test_an_unchanged_save_reads_the_manifest_only(spark, tmp_path):
    path, df = tmp_path / "t", spark.range(10)
    assert versions.save_version(df, str(path))
    (folder,) = folders(path)
    (path / "data" / folder).rename(path / "data" / "elsewhere")
    assert not versions.save_version(df, str(path))


def test_digests_see_nulls_and_schemas(spark):
    rows = lambda r, s="a string, b string": inventory.digest(spark.createDataFrame(r, s))
    assert rows([("x", None)]) != rows([(None, "x")])
    assert rows([("x", "y"), ("z", None)]) == rows([("z", None), ("x", "y")])
    assert rows([("x", "y")]) != rows([("x", "y")] * 2) and rows([("x", "y")]) != rows([("x", "y")], "a string, c string")
    assert rows([]) == rows([])


@pytest.mark.parametrize("rows", [0, 5])
def test_saved_schema_comes_back(spark, tmp_path, rows):
    df = spark.range(rows).select("id", F.col("id").cast("decimal(9,2)").alias("a.b"), F.current_timestamp().alias("t"), F.array("id").alias("list"))
    versions.save_version(df, str(tmp_path / "t"))
    found = versions.read_version(spark, str(tmp_path / "t"))
    assert found.schema.simpleString() == df.schema.simpleString() and found.count() == rows
    assert json.loads(versions.current(spark, str(tmp_path / "t")).schema)["type"] == "struct"


TIMES = [
    ("1/2/2020 3:04:05 PM", "2020-01-02 15:04:05"), ("01-02-2020 15:04:05", "2020-01-02 15:04:05"), ("1.2.20 3:4:5", "2020-01-02 03:04:05"), ("12/31/68 0:0:0", "2068-12-31 00:00:00"),
    ("12/31/69 0:0:0", "1969-12-31 00:00:00"), ("Jan 2, 2020 12:00:00 am", "2020-01-02 00:00:00"), ("january 2 2020 12:00:00 P.M.", "2020-01-02 12:00:00"), ("Sept. 9 2021, 1:02:03", "2021-09-09 01:02:03"),
    ("01022020150405", "2020-01-02 15:04:05"), ("010220 150405", "2020-01-02 15:04:05"), ("1_2_2020T03_04_05", "2020-01-02 03:04:05"), (" 1/2/2020  03:04:05.5 ", "2020-01-02 03:04:05"), ("2/29/2020 1:1:1", "2020-02-29 01:01:01"),
    ("2/29/2021 1:1:1", None), ("13/1/2020 1:1:1", None), ("1/2/2020 13:00:00 PM", None), ("1/2/2020 0:00:00 AM", None), ("1/2/2020 24:00:00", None), ("1/2/2020 1:60:00", None), ("1/2/2020", None), ("soon", None),
    ("Janu 2 2020 1:1:1", None), ("1/2/020 1:1:1", None), ("1/2/2020 1:1:1 then", None), ("", None), (None, None),
]


def test_times(spark):
    df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(TIMES)], "k int, t string")
    found = df.select("k", "t", F.date_format(inventory.month_first_time(F.col("t")), "yyyy-MM-dd HH:mm:ss").alias("at")).orderBy("k").collect()
    assert [(r.t, r["at"]) for r in found] == TIMES


def patterns_in(df):
    """How often the plan matches a pattern of times."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE(")


def test_a_row_is_parsed_once(spark, sf_dir):
    raw = spark.createDataFrame([("D:\\x\\A_2000_S_V01_M_V01_A_COL_GPWG.dta", "1/2/2003 4:05:06 PM", "20/20/2003")], "fullname string, creationtime string, lastwritetime string")
    # two columns, each against both layouts, and no more for the filters on them
    assert patterns_in(inventory.clean_inventory(raw)) == patterns_in(inventory.judged_inventory(raw)) == 4
    assert patterns_in(QUERIES["inventory_clean"](spark, sf_dir)) == 4


def test_places_are_counted_over_sorted_keys_only(spark, sf_dir):
    df = QUERIES["inventory_order"](spark, sf_dir)
    assert patterns_in(df) == 0 and "monotonically" not in df._jdf.queryExecution().optimizedPlan().toString()
    rows = sorted((tuple(r)[:-1], r.place) for r in df.collect())
    assert [place for _, place in rows] == list(range(1, len(rows) + 1)) and len({key for key, _ in rows}) == len(rows) > 1


def test_digests_of_the_cases_parse_once(spark, sf_dir, monkeypatch):
    seen = []
    monkeypatch.setattr(inventory, "digest", lambda df, own=inventory.digest: seen.append(patterns_in(df)) or own(df))
    assert {r.case_: r.equal for r in QUERIES["inventory_digest"](spark, sf_dir).collect()}["same rows"] and set(seen) == {0}


def test_rows_left_out_are_counted(spark, tmp_path):
    line = lambda name, a="1/2/2020 3:04:05 PM", b="Mar 4, 2021 13:00:00": f'{name},{a},"{b}"\n'
    good = "D:\\x\\AAA_2010_SUR_V01_M_V02_A_COL_{}.dta".format
    (tmp_path / "i.csv").write_text("FullName,CreationTime,LastWriteTime\n" + line(good("GPWG")) + line(good("RAW")) + line(good("ALL"), a="soon") + line(good("ALL"), b="") + line("NA") + line("short_id") + line("short_id", a="soon"))
    assert inventory.update_inventory(spark, str(tmp_path / "i.csv"), str(tmp_path / "t"), "D:/x/")
    saved = versions.current(spark, str(tmp_path / "t"))
    assert saved.rows == 1 and saved.notes == {"fullname_unknown": 1, "creationtime_unknown": 2, "lastwritetime_unknown": 1, "survey_id_short": 1, "module_other": 1}
    assert versions.read_version(spark, str(tmp_path / "t")).first().fullname == "AAA_2010_SUR_V01_M_V02_A_COL_GPWG.dta"


@pytest.mark.parametrize("kind", ["micro", "group"])
def test_files_of_a_survey_are_in_order(spark, tmp_path, kind):
    # one survey holds two thirds of the rows, a hundred of them with equal keys
    columns = "cache_id string, country_code string, surveyid_year double, welfare double, hhid string, pid string, area string, weight double"
    rows = [("large" if k % 3 else f"s{k % 4}", "AAA", 2012.0, None if k < 150 else float(k * 7919 % 1000), None if k < 300 else str(k), "1", "urban" if k % 2 else "rural", float(k)) for k in range(3000)]
    path = str(tmp_path / "s")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        surveys.write_surveys(spark.createDataFrame(rows, columns).repartition(3), path, kind)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(list((tmp_path / "s" / "cache_id=large").glob("*.parquet"))) >= 3
    keys = ["country_code", "surveyid_year", *(["welfare", "hhid", "pid"] if kind == "micro" else ["area", "welfare"])]
    total = 0
    for survey in ("large", "s0", "s1", "s2", "s3"):
        found = surveys.read_survey(spark, path, survey).collect()
        order = [tuple((r[k] is not None, r[k]) if r[k] is not None else (False,) for k in keys) for r in found]
        assert order == sorted(order)
        total += len(found)
    assert total == 3000
