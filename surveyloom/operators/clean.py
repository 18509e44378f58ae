"""Cleaning of microdata and grouped data into the 20 columns.

Every rule that depends on a survey's metadata reads a framework column of the
same row, so one plan cleans any number of surveys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.nulls import count_distinct_na
from surveyloom.functions.schema import CLEAN_COLUMNS, CLEAN_TYPES, SORT_KEYS, checked_kind
from surveyloom.operators.checks import SurveyError, require_columns

#: Codes and their labels (fixed values).
EDUCAT4 = {1: "No education", 2: "Primary", 3: "Secondary", 4: "Tertiary"}
EDUCAT5 = {
    1: "No education",
    2: "Primary incomplete",
    3: "Primary complete but secondary incomplete",
    4: "Secondary complete",
    5: "Some tertiary/post-secondary",
}
LITERACY = {1: "yes", 0: "no"}
URBAN = {1: "urban", 0: "rural"}
MALE = {1: "male", 0: "female"}
RECODES = {"educat4": EDUCAT4, "educat5": EDUCAT5, "literacy": LITERACY, "urban": URBAN, "male": MALE}


def recode(c: str | Column, labels: dict[int, str]) -> Column:
    """Labels for codes; NULL for any other code."""
    c = F.col(c) if isinstance(c, str) else c
    out = F.lit(None).cast("string")
    for code, label in labels.items():
        out = F.when(c == code, label).otherwise(out)
    return out


def weight_column(columns: list[str]) -> Column | None:
    """The first weight at hand as ``weight``; None if equal weights are needed."""
    found = next((c for c in ("weight", "weight_p", "weight_h") if c in columns), None)
    return F.col(found) if found else None


def with_weight(df: DataFrame, by: str = "cache_id") -> DataFrame:
    """``df`` with ``weight``; without any weight column one over the number of rows of the survey."""
    found = weight_column(df.columns)
    if found is not None:
        return df.withColumn("weight", found)
    # a count joined back: the rows themselves aren't shuffled
    counts = df.groupBy(by).agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight"))
    return df.join(counts, by)


def level_micro(domain: str, urban: Column | None, existing: Column | None) -> Column:
    d = F.col(f"fw_{domain}_domain")
    unset = existing if existing is not None else F.lit(None).cast("string")
    two = urban if urban is not None else F.raise_error(F.lit(f"{domain}_domain is 2 and the data has no column urban")).cast("string")
    return F.when(d == 1, "national").when(d == 2, two).otherwise(unset)


def clean_micro(df: DataFrame, keep_extra: bool = False) -> DataFrame:
    """Microdata rows with framework columns (see ``with_framework``) -> ``cache_id`` and the 20 columns.

    ``keep_extra`` also returns the recoded columns, which aren't among the 20.
    """
    require_columns(df, ["welfare", "cache_id"], "microdata")
    df = with_weight(df)
    has = set(df.columns)
    cols: dict[str, Column] = {c: F.col(c) for c in CLEAN_COLUMNS if c in has}
    extra = {c: recode(c, labels) for c, labels in RECODES.items() if c in has}
    urban = extra.get("urban")
    if "subnatid" in has:
        extra["subnatid1"] = F.col("subnatid")
    cols["welfare"] = F.col("welfare").cast("double") / 365
    cols["weight"] = F.col("weight").cast("double")
    for c in ("survey_year", "welfare_type"):
        if c not in has:
            cols[c] = F.col(f"fw_{c}")
    if "countrycode" not in has:
        extra["countrycode"] = F.col("country_code")
    cols["distribution_type"] = F.when(F.col("fw_use_imputed") == 1, "imputed").otherwise("micro")
    for domain in ("ppp", "cpi", "gdp", "pce", "pop"):
        level = f"{domain}_data_level"
        stays = domain in ("gdp", "pce", "pop") and level in has
        cols[level] = level_micro(domain, urban, F.col(level) if stays else None)
    return projected(df, cols, extra if keep_extra else {})


def group_area(urban: Column) -> Column:
    return F.when(urban == 1, "urban").when(urban == 0, "rural").when(urban.isNull(), "national").otherwise("")


def clean_group(df: DataFrame) -> DataFrame:
    """Grouped data with framework columns -> ``cache_id`` and the 20 columns."""
    require_columns(df, ["country_code", "survey_acronym", "welfare_type", "gd_type", "surveyid_year", "weight", "welfare", "urban", "cache_id"], "grouped data")
    df = df.withColumn("area", group_area(F.col("urban")))
    areas = df.groupBy("cache_id").agg(count_distinct_na("area").alias("_areas"))
    df = df.join(areas, "cache_id")
    cols: dict[str, Column] = {c: F.col(c) for c in CLEAN_COLUMNS if c in df.columns}
    cols["survey_year"] = F.col("fw_survey_year")
    for domain in ("ppp", "cpi", "gdp", "pce", "pop"):
        d = F.col(f"fw_{domain}_domain")
        cols[f"{domain}_data_level"] = F.when(d == 1, "national").when(d == 2, F.col("area")).otherwise("")
    pop = F.col("fw_pop_domain")
    spread = F.when(F.col("_areas") <= 1, "group").otherwise("aggregate")
    cols["distribution_type"] = F.when(pop == 1, "group").when(pop == 2, spread).otherwise("")
    return projected(df, cols, {})


def projected(df: DataFrame, cols: dict[str, Column], extra: dict[str, Column]) -> DataFrame:
    """The closed column list with its types, missing columns as typed NULLs, in one select."""
    own = [cols.get(c, F.lit(None)).cast(t).alias(c) for c, t in CLEAN_TYPES.items()]
    return df.select("cache_id", *own, *[x.alias(f"recoded_{c}") for c, x in extra.items()])


def row_order(columns: list[str], kind: str) -> list[str]:
    """Keys of the rows' order: the reporting level where there is one, then those of the kind. Spelt out in full, since no sort keeps an earlier one."""
    return [*(["reporting_level"] if "reporting_level" in columns else []), *SORT_KEYS[checked_kind(kind)]]


def sort_rows(df: DataFrame, kind: str) -> DataFrame:
    """All rows in the order of their kind: a global sort, for a result that is read from front to back."""
    return df.orderBy(*row_order(df.columns, kind))


def clean(df: DataFrame, kind: str, keep_extra: bool = False) -> DataFrame:
    checked_kind(kind)
    if kind == "micro":
        return clean_micro(df, keep_extra)
    if keep_extra:
        raise SurveyError("grouped data has no recoded columns")
    return clean_group(df)
