"""Where things are: folders below a root, and the session's shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from surveyloom.operators.checks import SurveyError

#: The root folder where none is given.
ROOT_VARIABLE = "SURVEYLOOM_ROOT"
#: The raw data below the root; the name of that folder is this library's own.
RAW_FOLDER = "raw"
#: Names of the inventory's folder and file below the raw data (fixed values).
INVENTORY_FOLDER, INVENTORY_FILE = "_Inventory", "DLWRAW_all_DTAs.csv"


@dataclass(frozen=True)
class Locations:
    """Paths of one installation, on any file system that Spark reads."""

    root: str
    raw: str

    @classmethod
    def of(cls, root: str | None = None, raw: str | None = None) -> Locations:
        """``root`` is taken from the environment where none is given, ``raw`` lies below the root unless it is given."""
        root = root or os.environ.get(ROOT_VARIABLE)
        if not (root or raw):
            raise SurveyError(f"give a root folder or set {ROOT_VARIABLE}")
        root = (root or "").rstrip("/")
        return cls(root, (raw or f"{root}/{RAW_FOLDER}").rstrip("/"))

    @property
    def inventory_folder(self) -> str:
        return f"{self.raw}/{INVENTORY_FOLDER}"

    @property
    def inventory_file(self) -> str:
        return f"{self.inventory_folder}/{INVENTORY_FILE}"

    @property
    def inventory_table(self) -> str:
        return f"{self.inventory_folder}/inventory.parquet"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); a local folder in local sessions only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise SurveyError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="surveyloom-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
