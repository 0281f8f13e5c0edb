"""Incremental cleaning whose outputs are those of one run over all files so far.

Three streams, each with its own checkpoint, go through what is new; tables below the checkpoint join them:

1. ``types`` counts which values read as which type (``infer``). Counts add up, so the types depend on the files
   and not on how they came.
2. ``judged`` cleans, converts and judges rows, each file once, and keeps statistics of every batch that add up.
3. ``distinct`` reads the rows kept and drops those that any batch had before, by keyed state; outlier flags use limits
   over all rows so far.

Every batch writes a folder of its own and is written again whole when it was cut short. State is kept by RocksDB
next to the executors and saved to the checkpoint, so a lost executor loses none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import columns_of_type, data_columns, missing_cells, numeric_columns
from ..operators.dedup import dedup
from ..operators.enrich import add_audit, derive
from ..operators.outliers import flag_outliers
from ..operators.parts import merge_profiles, part_limits, profile_part
from ..operators.types import add_type_counts, type_counts, types_of_counts, wider_type
from ..plans.cleaning import clean_text, judge, score_counts, shape
from ..plans.config import CleaningConfig
from ..sources.writers import write_metrics, write_quarantine, write_table
from .dedup import dedup_stream, latest_rows
from .ingest import drain, ingest_new

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TypesChanged(ValueError):
    """New files give a column a wider type than rows were written with."""


@dataclass(frozen=True)
class Incremental:
    """What all batches so far come to. Frames are lazy."""

    spark: SparkSession
    config: CleaningConfig
    schema: T.StructType
    tables: str
    inferred: Mapping[str, str]
    width: int
    conversion_failures: int

    def _table(self, name: str) -> DataFrame | None:
        return read_batches(self.spark, f"{self.tables}/{name}")

    @cached_property
    def written(self) -> DataFrame | None:
        """The target as written, with the batch of each row; None before the first row."""
        return read_batches(self.spark, self.config.target, self.config.output_format, self.config)

    @property
    def clean(self) -> DataFrame | None:
        """The clean rows: of a key that several batches wrote, the last one."""
        return None if self.written is None else latest_rows(self.written, self.config.dedup_subset)

    @property
    def profile(self) -> DataFrame | None:
        """The profile of all rows read so far."""
        parts = self._table("profile")
        return None if parts is None else merge_profiles(parts, self.schema)

    @property
    def metrics(self) -> DataFrame | None:
        """One row of counters and scores, as those of ``run``."""
        judged, finished = self._table("counters"), self._table("finished")
        if judged is None or finished is None:
            return None
        if any(c in self.config.dedup_subset for c in self.clean.columns):
            rows = self.clean
            finished = rows.agg(F.count(F.lit(1)).alias("output_records"), F.sum(missing_cells(rows)).alias("missing_cells"))
        sums = [
            t.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in t.columns if c != "batch"])
            for t in (judged, finished)
        ]
        both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sums)
        both = both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("distinct_records", F.col("output_records"))
        return score_counts(both, self.width, self.conversion_failures)


def read_batches(
    spark: SparkSession, path: str, fmt: str = "parquet", config: CleaningConfig | None = None
) -> DataFrame | None:
    """A table written batch by batch, with its ``batch``; None if there is nothing yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return None
    reader = spark.read.format(fmt)
    if fmt == "csv" and config is not None:
        reader = reader.options(header=True, sep=config.csv_separator, quote=config.csv_quote)
    return reader.load(path)


def stateful_session(spark: SparkSession, state_partitions: int | None) -> SparkSession:
    """A session with the settings of ``spark`` and a state store that is not bound by memory."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(STATE_STORE, ROCKS_DB)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def _put(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _types(spark: SparkSession, tables: str, started: bool) -> dict[str, str]:
    """Inferred types over all counts. They never become narrower than those that rows were written with."""
    counts = read_batches(spark, f"{tables}/types")
    known = read_batches(spark, f"{tables}/published")
    published: dict[str, str] = {}
    for r in known.select("column_name", "type").collect() if known is not None else ():  # a row per column and change
        published[r.column_name] = wider_type(published.get(r.column_name), r.type)
    if counts is None:
        return published
    now = {r.column_name: r.inferred_type for r in types_of_counts(add_type_counts(counts)).collect()}
    joined = {c: wider_type(published.get(c), kind) for c, kind in now.items()} if started else now
    wider = {c: f"{published[c]} -> {kind}" for c, kind in joined.items() if started and published.get(c, kind) != kind}
    if wider:
        raise TypesChanged(f"rows were written with narrower types; map these columns or begin anew: {wider}")
    if joined != published:
        _put(spark.createDataFrame(sorted(joined.items()), "column_name string, type string"), f"{tables}/published")
    return joined


def clean_incrementally(
    spark: SparkSession,
    config: CleaningConfig | Mapping[str, Any],
    schema: T.StructType | str,
    checkpoint: str,
    files_per_batch: int | None = None,
    state_partitions: int | None = None,
) -> Incremental:
    """Clean the files below ``config.source`` that are new; targets gain a ``batch=<id>`` folder per batch.

    After any number of calls and batches the clean rows, quarantined rows, counters and scores are those of one ``run``
    over all files: duplicates are looked for in all batches, types are inferred from all values, and the profile
    adds up (its quantiles and distinct counts are estimates, see ``operators.parts``). Outlier limits are those of
    all rows at the time a row is written. A file whose values would widen the type of a column that was written already
    stops the call before anything of it is written (``TypesChanged``); columns in the type map are never inferred, and
    one that had no value when its first rows were written stays text.

    ``state_partitions`` is fixed by the first call; give it for the size that the table will have. Rows and their
    audit columns are written once, so there is no quality score among these. The checkpoint folder must be shared.
    """
    if not isinstance(config, CleaningConfig):
        config = CleaningConfig.from_dict(config)
    if not config.source or not config.target:
        raise ValueError("no source to read or no target to write to")
    if config.overflow == "string":
        raise ValueError("which columns fit a decimal is not known before all files are; use another overflow policy")
    own = stateful_session(spark, state_partitions)
    kind = schema if isinstance(schema, T.StructType) else own.createDataFrame([], schema).schema
    tables = f"{checkpoint}/tables"
    csv = config.csv_options if config.input_format == "csv" else {}

    def read_new(stream: str, apply: Callable[[DataFrame, int], None]) -> None:
        ingest_new(own, config.source, kind, f"{checkpoint}/{stream}", apply, config.input_format, files_per_batch, **csv)

    inferred: dict[str, str] = {}
    if config.infer:
        def count(batch: DataFrame, batch_id: int) -> None:
            text = clean_text(batch, config)
            columns = [c for c in columns_of_type(text, T.StringType) if c not in config.type_map]
            _put(type_counts(text, columns, config.convert_options).coalesce(1), f"{tables}/types/batch={batch_id}")

        read_new("types", count)
        inferred = _types(own, tables, started=read_batches(own, f"{tables}/judged") is not None)
        inferred = {c: t for c, t in inferred.items() if t != "string"}

    nothing = shape(own.createDataFrame([], kind), config, inferred)
    template = judge(nothing.df, config)

    def take_in(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch={batch_id}"
        if config.profiling:
            _put(profile_part(batch).coalesce(1), f"{tables}/profile/{folder}")
        judged = judge(shape(batch, config, inferred).df, config)
        _put(judged.tagged, f"{tables}/judged/{folder}")
        stored = judged.over(batch.sparkSession.read.schema(template.tagged.schema).parquet(f"{tables}/judged/{folder}"))
        _put(stored.tagged.agg(*stored.totals()), f"{tables}/counters/{folder}")
        if config.outliers:
            clean = stored.clean
            _put(profile_part(clean.select(*numeric_columns(clean))).coalesce(1), f"{tables}/limits/{folder}")
        # Copies inside a batch merge here, task by task; the state meets a row once for each batch.
        _put(dedup(stored.clean, config.dedup_subset), f"{tables}/rows/{folder}")
        if stored.moves_rows:
            write_quarantine(stored.quarantined, f"{config.quarantine_target}/{folder}", "overwrite")

    read_new("judged", take_in)
    clean = template.clean
    failures = sum(c.error is not None for c in nothing.conversions)
    limits = None
    parts = read_batches(own, f"{tables}/limits") if config.outliers else None
    if parts is not None:
        numbers = T.StructType([clean.schema[c] for c in numeric_columns(clean)])
        limits = part_limits(parts, numbers, config.outlier_method, config.outlier_threshold)

    def finish(batch: DataFrame) -> DataFrame:
        if limits is not None:
            batch = flag_outliers(batch, config.outlier_method, limits=limits)
        return derive(batch, config.derived)

    def give_out(batch: DataFrame, batch_id: int) -> None:
        folder = f"batch={batch_id}"
        done = finish(batch)
        seen = Observation()
        missing = F.sum(missing_cells(done))
        counted = done.observe(seen, F.count(F.lit(1)).alias("output_records"), F.coalesce(missing, F.lit(0)).alias("missing_cells"))
        write_table(
            add_audit(counted, config.job_run_id, config.source), f"{config.target}/{folder}",
            config.output_format, config.compression, config.csv_separator, config.csv_quote, "overwrite",
        )
        found = seen.get
        row = [(int(found["output_records"]), int(found["missing_cells"]))]
        _put(own.createDataFrame(row, "output_records long, missing_cells long"), f"{tables}/finished/{folder}")

    if read_batches(own, f"{tables}/rows") is not None:
        rows = own.readStream.schema(clean.schema).option("recursiveFileLookup", True).parquet(f"{tables}/rows")
        drain(dedup_stream(rows, config.dedup_subset), f"{checkpoint}/distinct", give_out, "update")

    result = Incremental(
        spark, replace(config, infer=False), kind, tables, inferred, len(data_columns(finish(clean))), failures
    )
    if config.profiling and result.metrics is not None:
        write_metrics(result.metrics, config.metrics_target, "overwrite")
    return result
