"""Small files and folders on whatever file system a path names.

Used for manifests and schema versions only: table data is always read and
written by Spark.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def make_folder(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    fs.mkdirs(target)
    return path


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.deleteOnExit(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder does not exist."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return bool(fs.exists(target))


def folder_size(spark: SparkSession, path: str) -> int:
    fs, target = _open(spark, path)
    return int(fs.getContentSummary(target).getLength())


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names at least one existing file or folder."""
    fs, target = _open(spark, pattern)
    return bool(fs.globStatus(target))


class VersionLog:
    """Numbered JSON documents; the newest complete one is the state.

    A document is written beside its final name and then renamed, so a reader sees
    either the old state or the new one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        names = children(self.spark, self.path)
        return [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]

    def read(self, version: int) -> dict[str, Any]:
        fs, target = _open(self.spark, self._name(version))
        stream = fs.open(target)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(
                stream, "UTF-8"
            )
        finally:
            stream.close()
        return json.loads(text)

    def latest_number(self) -> int:
        """How many documents there have been."""
        versions = self.versions()
        return versions[-1] + 1 if versions else 0

    def latest(self) -> dict[str, Any] | None:
        versions = self.versions()
        return self.read(versions[-1]) if versions else None

    def append(self, document: dict[str, Any]) -> int:
        versions = self.versions()
        version = versions[-1] + 1 if versions else 0
        final = self._name(version)
        fs, draft = _open(self.spark, f"{final}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(document), "utf-8"))
        finally:
            stream.close()
        target = _open(self.spark, final)[1]
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"{final} was written by someone else")
        return version

    def forget_before(self, version: int) -> None:
        for old in self.versions():
            if old < version:
                delete(self.spark, self._name(old))

    def _name(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"
