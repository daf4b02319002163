"""Recorded stages of a job: what is done is not done again after a failure, and what is half done is.

Every stage writes below the folder of its job and then a record, in one step: the version of the input and the schemas of
its tables. A job that starts again in the same folder skips the stages whose record has the version of its input, and
removes what others have left behind before it writes.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables import written


def _at(spark: SparkSession, path: str):
    """The file system of a path, and the path, as the JVM has them."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def remove(spark: SparkSession, path: str) -> None:
    files, there = _at(spark, path)
    files.delete(there, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, there = _at(spark, path)
    return files.exists(there)


def put(spark: SparkSession, path: str, content: dict) -> None:
    """Write a small JSON file in one step: readers see the old content or the new one, never a part."""
    files, there = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(there.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    kinds = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    kinds[0] = hadoop.Options.Rename.OVERWRITE
    qualified = lambda p: files.makeQualified(p)
    hadoop.FileContext.getFileContext(qualified(there).toUri(), spark._jsc.hadoopConfiguration()).rename(
        qualified(beside), qualified(there), kinds
    )


def get(spark: SparkSession, path: str) -> dict | None:
    """The content of a small JSON file, or None if there is none."""
    files, there = _at(spark, path)
    if not files.exists(there):
        return None
    stream = files.open(there)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def version_of(spark: SparkSession, frames: Iterable[DataFrame], *more: object) -> str:
    """Digest of the files that the frames read (path, size, time of change) and of whatever else decides the result. A frame
    without files has the version of its plan; one made of rows on the driver is another one whenever it is made."""
    found: set[tuple] = set()
    for df in frames:
        names = df.inputFiles()
        if not names:
            found.add((df.semanticHash(), df.schema.json()))
        for folder in {n.rpartition("/")[0] for n in names}:
            files, there = _at(spark, spark._jvm.java.net.URI.create(folder).toString())
            for status in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI.create(folder))):
                found.add((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(json.dumps([sorted(map(str, found)), [str(m) for m in more]]).encode()).hexdigest()


class Stages:
    """The stages of one job in one folder."""

    def __init__(self, spark: SparkSession, folder: str, version: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.version = version
        #: Names of the stages that this run did, in the order in which they ended.
        self.done: list[str] = []

    def _record(self, name: str) -> str:
        return f"{self.folder}/_stages/{name.replace('/', '.')}.json"

    def step(self, name: str, work: Callable[[str], dict | None]) -> dict:
        """Do ``work``, which writes the folder ``name`` (its argument is the path), unless that was done before; the record."""
        record = get(self.spark, self._record(name))
        if record is None or record["version"] != self.version:
            remove(self.spark, f"{self.folder}/{name}")
            record = {"version": self.version, **(work(f"{self.folder}/{name}") or {})}
            put(self.spark, self._record(name), record)
            self.done.append(name)
        return record

    def table(self, name: str, make: Callable[[], DataFrame], by: str | None = None) -> DataFrame:
        """The table of this name, made and written unless that was done before."""

        def write(path: str) -> dict:
            return {"schema": written(make(), path, by).schema.jsonValue()}

        schema = StructType.fromJson(self.step(name, write)["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").select(*schema.names)

    def forget(self, name: str) -> None:
        """The stage is done again next time."""
        remove(self.spark, self._record(name))
