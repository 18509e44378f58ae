"""Survey and auxiliary tables, and the bundled column lists."""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.functions.schema import RAW_NAMES
from surveyloom.operators.checks import SurveyError
from surveyloom.operators.clean import row_order

AUXILIARY = ("pfw", "cpi", "ppp", "pop")


def load_surveys(spark: SparkSession, path: str, country: str | list[str] | None = None, year: float | list[float] | None = None) -> DataFrame:
    """Survey rows of some countries and years; the filters reach the scan, and prune folders where the table is partitioned by them."""
    df = spark.read.parquet(path)
    for name, wanted in (("country_code", country), ("surveyid_year", year)):
        if wanted is not None:
            df = df.where(F.col(name).isin(wanted if isinstance(wanted, list) else [wanted]))
    return df


def load_auxiliary(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name not in AUXILIARY:
        raise SurveyError(f"{name!r} isn't one of {', '.join(AUXILIARY)}")
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Types whose values can be hashed, so that rows with equal sort keys have an order too.
PLAIN = ("string", "double", "float", "integer", "long", "short", "byte", "boolean", "date", "timestamp")


def full_order(df: DataFrame, kind: str) -> list[Column]:
    """Survey, the order of the kind, and a hash of the row for rows with equal keys."""
    keys = ["cache_id", *row_order(df.columns, kind)]
    rest = [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() in PLAIN]
    return [*map(F.col, keys), *([F.xxhash64(*rest)] if rest else [])]


def write_surveys(df: DataFrame, path: str, kind: str | None = None) -> None:
    """Harmonised rows in a folder per survey, rows of a survey together, large surveys split over several tasks.

    With ``kind`` the rows of a survey stand in the order of their kind from the first file to the last: tasks hold ranges of
    the whole order, so the files of a survey don't overlap, and their names are in the order of the ranges. Equal rows of
    the keys are told apart by a hash, so a survey without household ids is split as well. The ranges come from a sample, for
    which the rows are computed once more; give a stored table where they are dear.
    """
    if kind is None:
        df.hint("rebalance", "cache_id").write.mode("overwrite").partitionBy("cache_id").parquet(path)
        return
    order = full_order(df, kind)
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("cache_id").parquet(path)


def read_survey(spark: SparkSession, path: str, survey: str) -> DataFrame:
    """The rows of one survey as ``write_surveys`` put them, in the order of its files."""
    rows = spark.read.parquet(path).where(F.col("cache_id") == survey)
    return rows.orderBy(F.col("_metadata.file_name"), F.col("_metadata.row_index"))


def rename_raw(df: DataFrame) -> DataFrame:
    """Raw names to harmonised ones; optional, the cleaners themselves read raw names."""
    return df.withColumnsRenamed({a: b for a, b in RAW_NAMES.items() if a in df.columns and b not in df.columns})


def bundled(name: str | None = None) -> list[str] | str:
    """Names of the bundled CSV files, or the path of one."""
    folder = resources.files("surveyloom") / "data"
    names = sorted(x.name for x in folder.iterdir() if x.name.endswith(".csv"))
    if name is None:
        return names
    if name not in names:
        raise SurveyError(f"no bundled file {name!r}; there are {', '.join(names)}")
    return str(folder / name)
