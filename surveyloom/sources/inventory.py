"""The file inventory: a CSV of survey files, normalised and saved when it has changed."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.schema import MODULES, SURVEY_ID_PARTS
from surveyloom.operators.checks import SurveyError, require_columns
from surveyloom.sources.config import Locations
from surveyloom.sources.versions import digest_of, digest_parts, save_version

log = logging.getLogger(__name__)

#: Month first, then day, year, hour, minute and second with anything but digits between them (no letters after the month), or in pairs of digits.
_MONTH = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t|tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_HALF = r"\s*(?:([ap])\.?m\.?)?\s*$"
TIME_PATTERNS = (
    rf"(?i)^\s*(\d{{1,2}}|{_MONTH})[^0-9A-Za-z]+(\d{{1,2}})\D+(\d{{4}}|\d{{2}})\D+(\d{{1,2}})\D+(\d{{1,2}})\D+(\d{{1,2}}(?:\.\d+)?){_HALF}",
    rf"(?i)^\s*(\d{{2}})(\d{{2}})(\d{{4}}|\d{{2}})\D*(\d{{2}})(\d{{2}})(\d{{2}}(?:\.\d+)?){_HALF}",
)
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
#: Years of two digits up to this one are in this century.
LAST_SHORT_YEAR = 68
ORDER = ["country_code", "surveyid_year", "survey_acronym", "vermast", "veralt"]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark can see a path, on any file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """The CSV with lower-case column names, all as text; quoted empty fields are empty, not NULL."""
    if not path_exists(spark, path):
        raise SurveyError(f"there is no inventory file {path}")
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, nullValue="NA")
    return raw.toDF(*[c.strip().lower() for c in raw.columns])


def month_first_time(c: Column) -> Column:
    """A time stamp with the month first, as a number or a name; NULL for anything else.

    Separators are free, years have two or four digits, hours are of the day or, with AM or PM, of its half.
    """
    found = F.coalesce(*[F.when(c.rlike(p), F.split(F.regexp_replace(c, p, "$1,$2,$3,$4,$5,$6,$7"), ",")) for p in TIME_PATTERNS])
    # a lambda's argument is computed once; as a plain column the patterns would be matched wherever a part is named
    return F.get(F.transform(F.array(found), time_of_parts), 0)


def time_of_parts(found: Column) -> Column:
    """The time of month, day, year, hour, minute, second and half of the day, all as text."""
    part = lambda k: F.get(found, k)
    number = lambda k: part(k).try_cast("int")
    named = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.substring(part(0), 1, 3))), F.lit(0))
    month = F.coalesce(number(0), named.cast("int"))
    year = F.when(F.length(part(2)) == 4, number(2)).when(number(2) <= LAST_SHORT_YEAR, 2000 + number(2)).otherwise(1900 + number(2))
    half = F.lower(part(6))
    hour = F.when(half == "", number(3)).when(number(3).between(1, 12), number(3) % 12 + F.when(half == "p", 12).otherwise(0))
    return F.try_make_timestamp(year, month, number(1), hour, number(4), part(5).try_cast("decimal(16,6)"))


def clean_path(c: Column, root_dir: str) -> Column:
    """Slashes for backslashes, without the root (taken as plain text, at the start only)."""
    c = F.replace(c, F.lit("\\"), F.lit("/"))
    return F.when(c.startswith(root_dir), F.substring(c, F.lit(len(root_dir) + 1), F.length(c))).otherwise(c) if root_dir else c


def survey_id_of(path: Column) -> Column:
    """The file's name without its extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def survey_id_parts(survey_id: Column) -> dict[str, Column]:
    """The nine parts of a survey id; NULL where there are fewer. Their layout is an assumption of this library (see README)."""
    return named_parts(F.split(survey_id, "_"))


def named_parts(parts: Column) -> dict[str, Column]:
    return {name: F.get(parts, k) for k, name in enumerate(SURVEY_ID_PARTS)}


#: Why a row is left out, in the order in which rules are asked.
RULES = ("fullname_unknown", "creationtime_unknown", "lastwritetime_unknown", "survey_id_short", "module_other")


def judged_inventory(raw: DataFrame, root_dir: str = "") -> DataFrame:
    """Normalised paths, times and survey-id parts of all rows, and ``dropped_by``: the rule that leaves a row out, NULL for rows that stay."""
    require_columns(raw, ["fullname", "creationtime", "lastwritetime"], "inventory")
    others = [F.coalesce(c, F.lit("")).alias(c) for c in raw.columns if c not in ("fullname", "creationtime", "lastwritetime")]
    path = clean_path(F.col("fullname"), root_dir)
    survey_id = survey_id_of(path)
    # through a generator each row is parsed once; from a plain select the optimizer copies the parsing into every filter on it
    row = F.struct(
        path.alias("fullname"),
        month_first_time(F.col("creationtime")).alias("creationtime"),
        month_first_time(F.col("lastwritetime")).alias("lastwritetime"),
        *others,
        survey_id.alias("_survey_id"),
        F.split(survey_id, "_").alias("_parts"),
    )
    named = raw.select(F.inline(F.array(row))).withColumn("survey_id", F.col("_survey_id"))
    parts = named_parts(F.col("_parts"))
    short = F.size(F.array_compact(F.array(*parts.values()))) < len(parts)
    broken = (F.col("fullname").isNull(), F.col("creationtime").isNull(), F.col("lastwritetime").isNull(), short, ~F.col("module").isin(MODULES))
    judged = named.withColumns(parts).withColumn("dropped_by", F.coalesce(*[F.when(c, rule) for c, rule in zip(broken, RULES, strict=True)], F.lit(None).cast("string")))
    return judged.drop("_survey_id", "_parts")


def clean_inventory(raw: DataFrame, root_dir: str = "") -> DataFrame:
    """The rows of ``judged_inventory`` that stay. Not sorted."""
    return judged_inventory(raw, root_dir).where(F.col("dropped_by").isNull()).drop("dropped_by")


def inventory_losses(judged: DataFrame) -> DataFrame:
    """(dropped_by, n): rows by the rule that leaves them out."""
    return judged.where(F.col("dropped_by").isNotNull()).groupBy("dropped_by").agg(F.count(F.lit(1)).alias("n"))


def digest(df: DataFrame) -> str:
    """A digest of rows and schema that doesn't depend on the rows' order."""
    row = df.agg(*digest_parts(df.columns)).first()
    return digest_of(row[0], row[1], df.schema)


def save_if_changed(df: DataFrame, path: str, force: bool = False, notes: dict[str, int] | None = None) -> bool:
    """Save ``df`` as a new version of a table (see ``sources.versions``) if it differs from the current one (or ``force``); whether it was saved."""
    return save_version(df.select("*"), path, force, notes)


def update_inventory(spark: SparkSession, inventory_csv: str, out_path: str, root_dir: str = "", force: bool = False) -> bool:
    """Read, normalise, sort and save the inventory; whether it had changed.

    Rows that are left out are counted by rule, in a warning and in the notes of the saved version.
    """
    judged = judged_inventory(read_inventory(spark, inventory_csv), root_dir)
    losses = {r.dropped_by: r.n for r in inventory_losses(judged).collect()}
    if losses:
        log.warning("inventory rows left out: %s", ", ".join(f"{rule} {losses[rule]}" for rule in RULES if rule in losses))
    rows = judged.where(F.col("dropped_by").isNull()).drop("dropped_by").orderBy(*ORDER)
    return save_if_changed(rows, out_path, force, losses)


def update_survey_inventory(spark: SparkSession, root: str | None = None, raw: str | None = None, force: bool = False) -> bool:
    """``update_inventory`` of the file and table below a root; the root is also what is taken off the paths."""
    at = Locations.of(root, raw)
    return update_inventory(spark, at.inventory_file, at.inventory_table, at.root, force)
