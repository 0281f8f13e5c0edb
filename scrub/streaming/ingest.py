"""Incremental ingest: each call picks up the files that landed since the last one.

The streaming checkpoint remembers which files were seen, and every micro-batch goes through an
ordinary batch function. A call ends when nothing new is left.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.cleaning import run
from ..plans.config import CleaningConfig
from ..sources.readers import check_format, csv_options


def ingest_new(
    spark: SparkSession,
    source: str,
    schema: T.StructType | str,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    fmt: str = "csv",
    files_per_batch: int | None = None,
    **options,
) -> None:
    """Call ``apply(batch, batch_id)`` on the rows of new files below ``source``; wait for the end.

    A batch that was cut short is given again with the same id and the same files, so ``apply``
    should overwrite what it wrote for that id. ``files_per_batch`` bounds a batch after a long
    pause.
    """
    fmt = check_format(fmt)
    if fmt == "csv":
        known = csv_options.__code__.co_varnames
        named = {k: options.pop(k) for k in list(options) if k in known}
        named["infer_schema"] = False
        options = csv_options(**named) | options
    if files_per_batch:
        options["maxFilesPerTrigger"] = files_per_batch
    stream = (
        spark.readStream.format(fmt).schema(schema)
        .options(recursiveFileLookup=True, **options).load(source)
    )
    drain(stream, checkpoint, apply)


def drain(
    stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Give ``apply`` the batches of a stream until nothing new is left."""
    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def clean_new_files(
    spark: SparkSession,
    config: CleaningConfig | Mapping[str, Any],
    schema: T.StructType | str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Run the configured cleaning on new files; every batch writes its own ``batch=<id>`` folder.

    Row-wise steps give the same rows as one run over all files. Types must not depend on which rows
    came first, so nothing is inferred: columns without a mapping stay as they are read. A mapping
    that ``infer_mapping`` found over a full table may be given as the type map. Outlier limits,
    duplicates and scores look at one batch only; ``clean_incrementally`` looks at all.
    """
    if not isinstance(config, CleaningConfig):
        config = CleaningConfig.from_dict(config)

    def apply(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch={batch_id}"
        batch_config = replace(
            config,
            infer=False,
            target=f"{config.target}/{folder}",
            quarantine_path=f"{config.quarantine_target}/{folder}",
            metrics_path=f"{config.metrics_target}/{folder}",
        )
        run(spark, batch_config, batch, mode="overwrite")

    csv = config.csv_options if config.input_format == "csv" else {}
    ingest_new(
        spark, config.source, schema, checkpoint, apply, config.input_format, files_per_batch,
        **csv,
    )
