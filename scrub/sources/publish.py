"""Outputs of a run that become visible in one step.

Each run writes into a folder of its own below the target. A manifest, written last, names the outputs that
belong together; readers take the one with the highest number. So a run that ends between any two writes leaves what
was there, and outputs of different runs are never mixed. A manifest is created under its number or not at all, so of two
runs that end together one fails instead of hiding the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

MANIFESTS = "_manifests"


class PublishConflict(RuntimeError):
    """Another run published while this one was at work."""


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def new_version(target: str) -> str:
    """A folder below the target that no other run uses; plain readers of the target do not see it."""
    return f"{target.rstrip('/')}/_versions/{uuid.uuid4().hex}"


def _numbers(spark: SparkSession, target: str) -> list[int]:
    fs, folder = _file_system(spark, f"{target.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current_number(spark: SparkSession, target: str) -> int:
    """The number of the manifest that readers take; 0 before the first."""
    return max(_numbers(spark, target), default=0)


def publish(spark: SparkSession, target: str, outputs: Mapping[str, Mapping[str, Any]], after: int) -> int:
    """Make the outputs the current ones, if nothing was published since manifest ``after``; their number."""
    folder = f"{target.rstrip('/')}/{MANIFESTS}"
    fs, draft = _file_system(spark, f"{folder}/{uuid.uuid4().hex}.draft")
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{after + 1:010d}.json")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(outputs).encode()))
    finally:
        stream.close()
    # A rename is one step; where the name is taken already, the draft goes.
    if fs.exists(final) or current_number(spark, target) > after or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise PublishConflict(f"{target} was published by another run")
    return after + 1


def manifest(spark: SparkSession, target: str) -> dict[str, Any] | None:
    """The outputs that belong together now, by name: path, format and options of each."""
    number = current_number(spark, target)
    if not number:
        return None
    path = f"{target.rstrip('/')}/{MANIFESTS}/{number:010d}.json"
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_published(spark: SparkSession, target: str, output: str = "clean") -> DataFrame | None:
    """An output of the current version: ``clean``, ``quarantine`` or ``metrics``; None if there is none."""
    found = (manifest(spark, target) or {}).get(output)
    if found is None:
        return None
    return spark.read.format(found["format"]).options(**found["options"]).load(found["path"])


def drop_versions(spark: SparkSession, target: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` published versions (one at least), and what failed runs have left.

    Versions that no manifest names go too, so call it while no run is at work. Returns how many folders went.
    """
    target = target.rstrip("/")
    numbers = _numbers(spark, target)
    kept, named = numbers[-max(keep, 1):], set()
    for number in kept:
        text = spark.read.text(f"{target}/{MANIFESTS}/{number:010d}.json", wholetext=True).first()[0]
        named |= {part for o in json.loads(text).values() for part in o["path"].split("/")}
    fs, versions = _file_system(spark, f"{target}/_versions")
    gone = 0
    for status in fs.listStatus(versions) if kept and fs.exists(versions) else ():
        if status.getPath().getName() not in named:
            fs.delete(status.getPath(), True)
            gone += 1
    for number in numbers[:-len(kept)] if kept else ():
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{MANIFESTS}/{number:010d}.json"), False)
    return gone


class Scratch:
    """The tables that one run stores between its steps, in a folder that can be deleted as a whole."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        fs, folder = _file_system(self.spark, self.folder)
        fs.delete(folder, True)
