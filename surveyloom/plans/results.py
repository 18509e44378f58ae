"""Errors as exceptions (default) or as values; for errors of single surveys see ``plans.batch``."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from surveyloom.sources.config import scratch


@dataclass(frozen=True)
class StageResult:
    """What a stage gave: a frame, or the text of its first error or warning."""

    status: str
    message: str = ""
    frame: DataFrame | None = None


def captured(stage: Callable[..., DataFrame], *args, **kwargs) -> StageResult:
    """Run a stage that may fail; warnings count as failures.

    The rows are computed once, into the shared folder, so that errors in data show here; ``frame`` reads them there.
    """
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        try:
            frame = stage(*args, **kwargs)
            path = scratch(frame.sparkSession, "captured")
            frame.write.parquet(path)
            frame = frame.sparkSession.read.schema(frame.schema).parquet(path)
        except Warning as w:
            return StageResult("warning", f"Warning: {w}")
        except Exception as e:  # noqa: BLE001 - the caller asked for errors as values
            return StageResult("error", f"Error: {str(e).splitlines()[0] if str(e) else type(e).__name__}")
    return StageResult("ok", frame=frame)
