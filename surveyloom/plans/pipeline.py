"""The two entry points: cleaning alone, and the whole chain."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from surveyloom.functions.schema import KINDS
from surveyloom.operators.clean import clean
from surveyloom.operators.enrich import add_survey_vars
from surveyloom.operators.framework import all_frameworks, survey_framework
from surveyloom.operators.split import alternative_columns, split_alt_welfare, with_framework
from surveyloom.operators.validity import validity_clean
from surveyloom.sources.surveys import rename_raw

log = logging.getLogger(__name__)


def process_data(df: DataFrame, pfw: DataFrame, kind: str, validate: bool = True) -> DataFrame:
    """Framework, cleaning and validity, without the alternative measure. Data of any other kind is returned as it is.

    ``validate`` checks the framework in small jobs first. Without it surveys that have no framework row in use are left out,
    and a framework key that repeats stops the run when rows are read.
    """
    if kind not in KINDS:
        log.warning("no method for kind %r; the data is returned unchanged", kind)
        return df
    if validate:
        survey_framework(df, pfw, alternatives=False)
    rows = with_framework(df, all_frameworks(pfw, alternatives=False))
    return validity_clean(clean(rows, kind), kind)


def full_chain(
    df: DataFrame, pfw: DataFrame, cpi: DataFrame, ppp: DataFrame, pop: DataFrame, kind: str, versions: list[str] | None = None,
    apply_rename_map: bool = False, validate: bool = True, alternatives: list[str] | None = None,
) -> DataFrame:
    """Framework, split, cleaning, validity and enrichment of any number of surveys of one kind.

    ``alternatives`` are the columns that the framework names as second measures; naming them saves the job that finds them.
    """
    df = rename_raw(df) if apply_rename_map else df
    if validate:
        survey_framework(df, pfw)
    rows = split_alt_welfare(df, all_frameworks(pfw), alternative_columns(df, pfw) if alternatives is None else alternatives)
    return add_survey_vars(validity_clean(clean(rows, kind), kind), cpi, ppp, pop, kind, versions, validate)
