"""A table in versions: written beside the old one, and published by a manifest that comes last.

::

    path/data/<name>/        Parquet files of one version
    path/manifests/<n>.json  digest, rows, schema and folder of version n

A version is what its manifest says; the one with the largest number is current. A
manifest is renamed into place whole, and only if there is none of that number, so
a write that fails, or that loses against another one, leaves every published
version as it was. Rows are digested while they are written, and the digest of the
current version is read from its manifest: nothing stored is read to tell whether a
table has changed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.operators.checks import SurveyError

DATA, MANIFESTS = "data", "manifests"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    rows: int
    digest: str
    schema: str
    #: Anything a writer wants to keep with its version, such as counts of rows that it left out.
    notes: dict[str, int]


class Files:
    """The file system of a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.system.exists(self.at(path))

    def names(self, folder: str) -> list[str]:
        return [x.getPath().getName() for x in self.system.listStatus(self.at(folder))] if self.exists(folder) else []

    def remove(self, path: str) -> None:
        self.system.delete(self.at(path), True)

    def read(self, path: str) -> str:
        stream = self.system.open(self.at(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> bool:
        """Put a whole file into place; False if there is one already."""
        hidden = f"{path[: path.rindex('/')]}/.{uuid.uuid4().hex}"
        stream = self.system.create(self.at(hidden), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        try:
            context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.at(path).toUri(), self.conf)
            never = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            never[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            context.rename(self.at(hidden), self.at(path), never)
        except Exception:
            if self.exists(path):
                return False
            raise
        finally:
            if self.exists(hidden):
                self.remove(hidden)
        return True


def row_hash(columns: list[str]) -> Column:
    """A hash of a row in which NULL is a value, so that a value in another column is another row."""
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return F.xxhash64(*quoted, *[c.isNull() for c in quoted])


def digest_parts(columns: list[str]) -> list[Column]:
    """Number of rows and sum of their hashes: neither depends on the rows' order."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(row_hash(columns).cast("decimal(38,0)")).alias("hashes")]


def digest_of(rows: int, hashes: object, schema: T.StructType) -> str:
    return f"{rows}:{hashes or 0}:{schema.simpleString()}"


def versions(spark: SparkSession, path: str) -> list[Version]:
    """The published versions, oldest first."""
    files = Files(spark, path)
    names = [n for n in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]
    return sorted((Version(**json.loads(files.read(f"{path}/{MANIFESTS}/{n}"))) for n in names), key=lambda v: v.number)


def current(spark: SparkSession, path: str) -> Version | None:
    """The latest version; only its own manifest is read."""
    files = Files(spark, path)
    numbers = [int(n[:-5]) for n in files.names(f"{path}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit()]
    return Version(**json.loads(files.read(f"{path}/{MANIFESTS}/{max(numbers)}.json"))) if numbers else None


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current version, or an earlier one."""
    found = current(spark, path) if number is None else next((v for v in versions(spark, path) if v.number == number), None)
    if found is None:
        raise SurveyError(f"there is no version{'' if number is None else f' {number}'} of {path}")
    return spark.read.schema(T.StructType.fromJson(json.loads(found.schema))).parquet(f"{path}/{found.folder}")


def save_version(df: DataFrame, path: str, force: bool = False, notes: dict[str, int] | None = None) -> bool:
    """Write ``df`` as a new version if it differs from the current one (or ``force``); whether there is a new version.

    The rows are computed once: they are written to a folder of their own, which goes again if they are those of the current
    version. ``notes`` go into the manifest.
    """
    spark, files = df.sparkSession, Files(df.sparkSession, path)
    before = current(spark, path)
    folder = f"{DATA}/{uuid.uuid4().hex}"
    seen = Observation()
    try:
        df.observe(seen, *digest_parts(df.columns)).write.parquet(f"{path}/{folder}")
        parts = seen.get
        rows = parts.get("rows", 0)
        # a stage that runs twice must not count twice
        if spark.read.schema(df.schema).parquet(f"{path}/{folder}").count() != rows:
            raise SurveyError(f"the rows written to {path}/{folder} aren't those that were counted")
        digest = digest_of(rows, parts.get("hashes"), df.schema)
        if before is not None and before.digest == digest and not force:
            files.remove(f"{path}/{folder}")
            return False
        found = Version(1 if before is None else before.number + 1, folder, rows, digest, df.schema.json(), notes or {})
        if not files.exists(f"{path}/{MANIFESTS}"):
            files.system.mkdirs(files.at(f"{path}/{MANIFESTS}"))
        if not files.publish(f"{path}/{MANIFESTS}/{found.number}.json", json.dumps(asdict(found))):
            raise SurveyError(f"version {found.number} of {path} was published by another writer meanwhile")
    except Exception:
        if files.exists(f"{path}/{folder}"):
            files.remove(f"{path}/{folder}")
        raise
    return True


def remove_versions(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all but the latest versions, their manifests first; folders of writes that never ended go too. How many folders went.

    Not to be run beside a write or a reader of an old version.
    """
    files, found = Files(spark, path), versions(spark, path)
    stay = found[-keep:] if keep > 0 else []
    for old in found[: len(found) - len(stay)]:
        files.remove(f"{path}/{MANIFESTS}/{old.number}.json")
    gone = [n for n in files.names(f"{path}/{DATA}") if f"{DATA}/{n}" not in {v.folder for v in stay}]
    for name in gone:
        files.remove(f"{path}/{DATA}/{name}")
    return len(gone)
