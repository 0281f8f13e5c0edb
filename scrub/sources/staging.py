"""Tables written between the steps of a run, so that no step repeats the work of an earlier one.

They go to the folder the cluster names in ``spark.checkpoint.dir``: files there outlive the
executors that wrote them, so losing an executor costs its running tasks only.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; a temporary one only for a session on one machine."""
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return _one_machine_folder()


@cache
def _one_machine_folder() -> str:
    return tempfile.mkdtemp(prefix="scrub-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write the table as Parquet to the shared folder and read it back: same rows, no lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage, upon which Spark deletes shuffle files that nothing refers to.

    A driver with memory to spare may keep them up to the end of a run. For steps whose exchanges take much disk.
    """
    spark.sparkContext._jvm.java.lang.System.gc()
