"""Validity rules. The rules themselves are assumptions of this library (see README), each in one function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyloom.functions.schema import checked_kind

#: Layout of grouped data by code: what ``weight`` and ``welfare`` hold. cumulative: shares up to a class; shares: of a
#: class; means: population share and mean of a class.
LAYOUTS = {1: "cumulative", 2: "shares", 5: "means"}


#: Why a row is dropped, in the order in which rules are asked.
MICRO_RULES = {
    "welfare_unknown": "welfare IS NULL OR isnan(welfare)", "welfare_negative": "welfare < 0",
    "weight_unknown": "weight IS NULL OR isnan(weight)", "weight_not_positive": "weight <= 0",
}
GROUP_RULES = {"area_unknown": "area IS NULL"}
DROPPED = "dropped_by"


def rules_of(kind: str) -> dict[str, str]:
    return MICRO_RULES if checked_kind(kind) == "micro" else GROUP_RULES


def dropped_by(kind: str) -> Column:
    """The first rule that drops a row, NULL for rows that stay."""
    return F.coalesce(*[F.when(F.expr(rule), name) for name, rule in rules_of(kind).items()], F.lit(None).cast("string"))


def valid_micro(df: DataFrame) -> DataFrame:
    """Rows with a known, non-negative welfare and a positive weight."""
    return df.where("welfare >= 0 AND weight > 0 AND NOT isnan(welfare) AND NOT isnan(weight)")


def gd_type_code(c):
    """'T01' -> 1."""
    return F.regexp_replace(c, "^T0", "").try_cast("int")


def valid_group(df: DataFrame) -> DataFrame:
    """Grouped data as cumulative shares: ``weight`` of population and ``welfare`` of the total (Lorenz ordinate), per survey and area.

    Rows without an area are dropped. Partitions of the windows are the classes of one area, a few rows each.
    """
    w = Window.partitionBy("cache_id", "area")
    run = w.orderBy("welfare", "weight").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    layout = gd_type_code(F.col("gd_type"))
    total = F.when(layout == 5, F.col("weight") * F.col("welfare")).otherwise(F.col("welfare"))
    own = df.where("area IS NOT NULL").withColumn("_total", total)
    given = layout == 1
    people = F.when(given, F.try_divide(F.col("weight"), F.max("weight").over(w))).otherwise(F.try_divide(F.sum("weight").over(run), F.sum("weight").over(w)))
    share = F.when(given, F.try_divide(F.col("welfare"), F.max("welfare").over(w))).otherwise(F.try_divide(F.sum("_total").over(run), F.sum("_total").over(w)))
    return own.select(*[people.alias(c) if c == "weight" else share.alias(c) if c == "welfare" else F.col(c) for c in df.columns])


def validity_clean(df: DataFrame, kind: str) -> DataFrame:
    return valid_micro(df) if checked_kind(kind) == "micro" else valid_group(df)
