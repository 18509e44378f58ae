"""Column lists and types of the harmonised tables (fixed values, in their fixed order)."""

from __future__ import annotations

from pyspark.sql import types as T

#: The cleaned table: exactly these columns, in this order.
CLEAN_TYPES = {
    "country_code": "string",
    "surveyid_year": "double",
    "survey_acronym": "string",
    "survey_year": "double",
    "hhid": "string",
    "pid": "string",
    "welfare": "double",
    "weight": "double",
    "gender": "string",
    "area": "string",
    "welfare_type": "string",
    "distribution_type": "string",
    "cpi_data_level": "string",
    "ppp_data_level": "string",
    "pop_data_level": "string",
    "gdp_data_level": "string",
    "pce_data_level": "string",
    "gd_type": "string",
    "alt_welfare": "double",
    "imputation_id": "string",
}
CLEAN_COLUMNS = list(CLEAN_TYPES)
CLEAN_SCHEMA = T.StructType([T.StructField(c, T.DoubleType() if t == "double" else T.StringType()) for c, t in CLEAN_TYPES.items()])

#: Raw survey names and their harmonised names.
RAW_NAMES = {
    "countrycode": "country_code",
    "year": "surveyid_year",
    "survname": "survey_acronym",
    "male": "gender",
    "urban": "area",
    "subnatid1": "subnational_id1",
    "subnatid2": "subnational_id2",
    "subnatid3": "subnational_id3",
    "sim": "imputation_id",
}

SURVEY_KEY = ["country_code", "surveyid_year", "survey_acronym"]
#: Order decides between data levels of equal rank.
DATA_LEVELS = ["cpi_data_level", "ppp_data_level", "pop_data_level", "gdp_data_level", "pce_data_level"]
DOMAINS = ["cpi_domain", "ppp_domain", "gdp_domain", "pce_domain", "pop_domain"]

SORT_KEYS = {
    "micro": ["country_code", "surveyid_year", "welfare", "hhid", "pid"],
    "group": ["country_code", "surveyid_year", "area", "welfare"],
}
KINDS = tuple(SORT_KEYS)
#: Inventory modules that are kept, and the parts of a survey id.
MODULES = ["GPWG", "ALL", "BIN", "GROUP", "HIST"]
SURVEY_ID_PARTS = ["country_code", "surveyid_year", "survey_acronym", "vermast", "m", "veralt", "a", "collection", "module"]


def checked_kind(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    return kind
