"""The composed cleaning run.

``plan`` builds all results of a run as lazy frames. ``run`` reads the source, executes the plan and
writes its outputs. Both go through the same steps; ``run`` only adds two tables written to the
shared folder, one after the row-wise steps and one after duplicate removal, so that parsing and
the dedup shuffle happen once although several outputs and the scores depend on them.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import AUDIT_COLUMNS, data_columns, missing_cells
from ..operators.dedup import dedup, dedup_counts
from ..operators.enrich import add_audit, derive
from ..operators.metrics import before_after, overall_score, percent, validity_score
from ..operators.nulls import fill_nulls
from ..operators.outliers import flag_outliers
from ..operators.profile import column_metrics, profile
from ..operators.rules import RuleResult, apply_rules
from ..operators.schema import Issue, validate_schema
from ..operators.strings import clean_strings
from ..operators.types import (
    Conversion,
    apply_conversions,
    conversion_report,
    counts_after,
    counts_before,
    infer_mapping,
    plan_conversions,
    report_of,
)
from ..sources.readers import (
    read_table,
    repartition_by_rows,
    sized_shuffles,
    source_bytes,
)
from ..sources.publish import Scratch, current_number, new_version, publish
from ..sources.staging import scratch_path
from ..sources.writers import write_metrics, write_quarantine, write_table
from .config import CleaningConfig

MISSING = "__missing_cells"
# Until the end of a run a row's own path is a struct, which no step takes for text.
SOURCE_PATH = "etl_source_path"
Stage = Callable[[DataFrame, str], DataFrame]


def _lazily(df: DataFrame, name: str) -> DataFrame:
    return df


class Watch:
    """Aggregates that are gathered by the jobs that write a run's tables, without a job of their own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._observed: list[tuple[Observation, list[str]]] = []

    def over(self, df: DataFrame, aggregates: list[Column]) -> DataFrame:
        """``df``, whose rows are counted by the first job that reads it whole."""
        if not aggregates:
            return df
        names = df.agg(*aggregates).columns
        observation = Observation()
        self._observed.append((observation, names))
        return df.observe(observation, *aggregates)

    @cached_property
    def found(self) -> DataFrame:
        """One row of all aggregates, known numbers; to be asked for once the tables are written."""
        row = {n: found.get(n) for o, names in self._observed for found in (o.get,) for n in names}
        schema = ", ".join(f"{n} long" for n in row)
        return self.spark.createDataFrame([tuple(int(v or 0) for v in row.values())], schema)

    def has(self, name: str) -> bool:
        return any(name in names for _, names in self._observed)


@dataclass(frozen=True)
class Shaped:
    """A table after the column-wise steps, and what its conversions were."""

    df: DataFrame
    text: DataFrame
    inferred: Mapping[str, str]
    conversions: tuple[Conversion, ...]


@dataclass(frozen=True)
class Result:
    """Outputs of a run; frames are lazy and only built when asked for.

    ``profile`` is None when profiling is off.
    """

    config: CleaningConfig
    source: DataFrame
    shaped: Shaped
    judged: RuleResult
    finished: DataFrame
    profile: DataFrame | None
    stage: Stage
    schema_warnings: tuple[Issue, ...] = ()
    watch: Watch | None = None
    scratch: Scratch | None = None

    def release(self) -> None:
        """Delete the tables that the run stored between its steps. What was written stays; frames of this result
        can no longer be read."""
        if self.scratch is not None:
            self.scratch.release()

    def __enter__(self) -> Result:
        return self

    def __exit__(self, *problem) -> None:
        self.release()

    @cached_property
    def clean(self) -> DataFrame:
        """The finished table with its audit columns; with profiling on, the score is one."""
        score = None
        if self.config.profiling:
            score = self.metrics.select("overall_quality_score").scalar()
        finished, own = self.finished.drop(MISSING), None
        if self.config.true_source and SOURCE_PATH in finished.columns:
            own = F.col(SOURCE_PATH).getField("path")
        return add_audit(
            finished, self.config.job_run_id, self.config.source, score, self.config.null_token,
            source_column=own,
        )

    @cached_property
    def metrics(self) -> DataFrame:
        """One row of counters and scores."""
        failures = sum(c.error is not None for c in self.shaped.conversions)
        distinct = _stays_distinct(self.judged.clean, self.config)
        finished = self.finished
        if MISSING not in finished.columns:
            finished = finished.withColumn(MISSING, missing_cells(finished))
        known = self.watch.found if self.watch is not None and self.watch.has("output_records") else None
        return self.stage(run_metrics(self.judged, finished, failures, distinct, known), "metrics")

    @cached_property
    def before_after(self) -> DataFrame:
        """Scores of the table as it came and as it is now; groups all rows of both.

        What a rule took out or a conversion could not do speaks against the table as it came.
        """
        counted = self.metrics.select(
            (F.col("validation_failures") + F.col("quarantined_records") + F.col("type_conversion_failures")).alias("n")
        )
        return before_after(self.source, self.finished.drop(MISSING), counted.scalar())

    @property
    def quarantine(self) -> DataFrame:
        moved = self.judged.quarantined
        if self.config.true_source and SOURCE_PATH in moved.columns:
            return moved.withColumn(SOURCE_PATH, F.col(SOURCE_PATH).getField("path"))
        return moved

    @cached_property
    def rule_counts(self) -> DataFrame:
        """Rows affected by each rule; those of a run were counted while they were written."""
        if self.watch is None:
            return self.judged.counts
        return self.judged.counts_of(self.watch.found if self.judged.rules else self.judged.tagged)

    @cached_property
    def conversions(self) -> DataFrame:
        """Success of every type conversion; that of a run was counted while it converted."""
        if self.watch is not None and self.shaped.conversions:
            return report_of(self.watch.found, self.shaped.conversions)
        return conversion_report(
            self.shaped.text, self.config.type_map, self.shaped.inferred,
            self.config.convert_options,
        )


def clean_text(df: DataFrame, config: CleaningConfig) -> DataFrame:
    return clean_strings(df, config.trim, config.collapse, config.string_case, config.alnum_columns)


def shape(
    df: DataFrame,
    config: CleaningConfig,
    inferred: Mapping[str, str] | None = None,
    watch: Watch | None = None,
) -> Shaped:
    """Clean strings, convert types and fill gaps.

    Inference runs one aggregate, unless what it found elsewhere is given; the rest is lazy. ``watch``
    counts the values before and after conversion.
    """
    text = clean_text(df, config)
    options = config.convert_options
    if inferred is None:
        inferred = infer_mapping(text, tuple(config.type_map), options) if config.infer else {}
    conversions = plan_conversions(text, config.type_map, inferred, options)
    if watch is None:
        converted = apply_conversions(text, conversions)
    else:
        before = watch.over(text, counts_before(conversions))
        converted = watch.over(apply_conversions(before, conversions), counts_after(conversions))
    filled = fill_nulls(
        converted,
        config.fill_strings,
        config.fill_numbers,
        config.fill_dates,
        config.fill_booleans,
        skip=config.critical_columns,
        date_format=config.date_formats[0],
        timestamp_format=config.timestamp_formats[0],
    )
    return Shaped(filled, text, inferred, tuple(conversions))


def judge(df: DataFrame, config: CleaningConfig) -> RuleResult:
    """Row-wise verdicts: missing keys first, then the rules."""
    return apply_rules(
        df, config.rules, config.quarantine, config.unknown, null_keys=config.critical_columns
    )


def finish(df: DataFrame, config: CleaningConfig) -> DataFrame:
    """The steps that look at all rows, then derived columns."""
    if config.outliers:
        df = flag_outliers(df, config.outlier_method, config.outlier_threshold)
    subset = config.dedup_subset
    if SOURCE_PATH in df.columns and not any(c in subset for c in df.columns):
        subset = [c for c in df.columns if c != SOURCE_PATH]  # the file a row came from is no part of it
    return derive(dedup(df, subset), config.derived)


def plan(df: DataFrame, config: CleaningConfig, stage: Stage = _lazily) -> Result:
    """All results of cleaning ``df``. ``stage`` may store the tables that several results share."""
    warnings_ = ()
    if config.schema_validation and config.schema:
        warnings_ = tuple(validate_schema(df, config.schema, config.convert_options))
    profiled = None
    if config.profiling:
        profiled = stage(profile(df.drop(SOURCE_PATH), approx_distinct=config.approx_distinct), "profile")
    watch = None if stage is _lazily else Watch(df.sparkSession)
    shaped = shape(df, config, watch=watch)
    judged = judge(shaped.df, config)
    if watch is not None:
        tagged = watch.over(judged.tagged, [*judged.totals(), *judged.affected_all()])
        judged = judged.over(stage(tagged, "judged"))
    finished = finish(judged.clean, config)
    if config.profiling:
        finished = finished.withColumn(MISSING, missing_cells(finished))
        if watch is not None:
            finished = watch.over(finished, finished_counts())
        finished = stage(finished, "finished")
    return Result(config, df, shaped, judged, finished, profiled, stage, warnings_, watch)


def finished_counts() -> list[Column]:
    """Aggregates over a finished table that carries its missing cells per row."""
    return [
        F.count(F.lit(1)).alias("output_records"),
        F.coalesce(F.sum(MISSING), F.lit(0)).alias("missing_cells"),
    ]


def _stays_distinct(deduplicated: DataFrame, config: CleaningConfig) -> bool:
    """Rows that were made distinct stay so, unless what made them distinct is hidden afterwards:
    by a derived column in place of an old one, or because audit columns do not count."""
    hidden = {d.name for d in config.derived} | set(AUDIT_COLUMNS)
    return not hidden & set(deduplicated.columns)


def run_metrics(
    judged: RuleResult,
    finished: DataFrame,
    conversion_failures: int,
    distinct: bool,
    known: DataFrame | None = None,
) -> DataFrame:
    """One row of counters and scores; ``finished`` carries its missing cells per row.

    The scores describe the finished table. When its rows are known to be ``distinct``, because
    duplicates were just removed, consistency needs no second shuffle to be known. ``known`` is a row
    of the counters if they were gathered before.
    """
    columns = [c for c in data_columns(finished) if c != MISSING]
    if known is None:
        parts = [judged.tagged.agg(*judged.totals()), finished.agg(*finished_counts())]
    else:
        parts = [known]
    if distinct:
        parts[-1] = parts[-1].withColumn("distinct_records", F.col("output_records"))
    if not distinct:
        parts.append(dedup_counts(finished, columns).select("distinct_records"))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return score_counts(both, len(columns), conversion_failures)


def score_counts(counts: DataFrame, width: int, conversion_failures: int) -> DataFrame:
    """The metrics row from one row of counters of a table of ``width`` columns."""
    total = F.col("output_records")
    cells = total * width
    failures = (
        F.col("validation_failures") + F.lit(conversion_failures) + F.col("quarantined_records")
    )
    scored = counts.select(
        total.alias("total_records"),
        (F.col("kept_records") - total).alias("duplicate_records"),
        "null_records",
        F.lit(0).cast("long").alias("invalid_records"),
        "quarantined_records",
        F.lit(conversion_failures).cast("long").alias("type_conversion_failures"),
        "validation_failures",
        "input_records",
        total.alias("output_records"),
        percent(cells - F.col("missing_cells"), cells).alias("completeness_score"),
        percent(F.col("distinct_records"), total).alias("consistency_score"),
        validity_score(total, failures).alias("validity_score"),
    )
    overall = overall_score(
        F.col("completeness_score"), F.col("consistency_score"), F.col("validity_score")
    )
    return scored.withColumn("overall_quality_score", overall)


def metrics_record(result: Result, config: CleaningConfig) -> DataFrame:
    """The metrics row with the column profiles and where it came from."""
    about = {
        "processing_timestamp": F.current_timestamp(),
        "job_name": F.lit(config.job_name),
        "source_path": F.lit(config.source).cast("string"),
        "target_path": F.lit(config.target).cast("string"),
    }
    record = result.metrics
    if result.profile is not None:
        record = record.withColumn(
            "column_metrics", column_metrics(result.profile).scalar()
        )
    rows = {
        "rule_counts": result.rule_counts,
        "conversions": result.conversions,
        "schema_warnings": record.sparkSession.createDataFrame(
            [(i.column, i.check, i.expected, i.actual) for i in result.schema_warnings],
            "column_name string, check string, expected string, actual string",
        ),
    }
    if config.advanced_analytics:
        rows["before_after"] = result.before_after
    gathered = {n: t.agg(F.collect_list(F.struct(*t.columns))).scalar() for n, t in rows.items()}
    return record.withColumns(about | gathered)


def run(
    spark: SparkSession,
    config: CleaningConfig | Mapping[str, Any],
    df: DataFrame | None = None,
    mode: str = "errorifexists",
) -> Result:
    """Clean ``config.source`` (or ``df``) and write clean rows, quarantined rows and metrics.

    Returns the result with ``clean``, ``quarantine`` and ``metrics`` as lazy frames over the staged
    tables. Failed writes raise.
    """
    if not isinstance(config, CleaningConfig):
        config = CleaningConfig.from_dict(config)
    if not config.target:
        raise ValueError("no target to write to")
    size = 0
    if df is None:
        if not config.source:
            raise ValueError("no source to read")
        csv = config.csv_options if config.input_format == "csv" else {}
        df = read_table(spark, config.source, config.input_format, **csv)
        size = source_bytes(spark, config.source)
        if config.true_source:
            df = df.withColumn(SOURCE_PATH, F.struct(F.col("_metadata.file_path").alias("path")))
    with sized_shuffles(df.sparkSession, size):
        return _run(df, config, mode)


def _check_targets(spark: SparkSession, config: CleaningConfig, mode: str) -> None:
    """Fail before anything is written when an output is there already and may not be replaced."""
    if mode not in ("error", "errorifexists", "default"):
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for target in (config.target, config.quarantine_target, config.metrics_target):
        path = spark._jvm.org.apache.hadoop.fs.Path(target)
        if path.getFileSystem(conf).exists(path):
            raise FileExistsError(f"{target} exists already")


def _run(df: DataFrame, config: CleaningConfig, mode: str) -> Result:
    """Quarantine and metrics are written first: where the target is there, all of the run is."""
    spark = df.sparkSession
    before = 0
    if config.versions:
        folder, before = new_version(config.target), current_number(spark, config.target)
        named = replace(
            config, target=f"{folder}/clean", quarantine_path=f"{folder}/quarantine", metrics_path=f"{folder}/metrics"
        )
    else:
        named = config
        _check_targets(spark, config, mode)
    if config.sampling:
        warnings.warn("a run cleans all rows; draw a sample with sample_rows before it", stacklevel=3)
    cached = None
    if config.repartitions:
        df = repartition_by_rows(df, df.count(), *config.partition_bounds)
    if config.cache:
        cached = df = df.persist(StorageLevel.MEMORY_AND_DISK)
    scratch = Scratch(spark, scratch_path(spark, "run"))
    try:
        result = replace(plan(df, config, stage=scratch.store), scratch=scratch)
        for low in result.conversions.where("low_success").collect():  # a row per column at most
            warnings.warn(
                f"only {low.success_rate:.0%} of the values of {low.column_name} convert to {low.target_type}",
                stacklevel=3,
            )
        outputs = {"clean": _output(named.target, named.output_format, named)}
        if result.judged.moves_rows:
            write_quarantine(result.quarantine, named.quarantine_target, mode)
            outputs["quarantine"] = _output(named.quarantine_target, "parquet", named)
        if config.profiling:
            write_metrics(metrics_record(result, config), named.metrics_target, mode)
            outputs["metrics"] = _output(named.metrics_target, "json", named)
        write_table(
            result.clean, named.target, config.output_format, config.compression,
            config.csv_separator, config.csv_quote, mode,
        )
        if config.versions:
            publish(spark, config.target, outputs, before)
        return result
    finally:
        if cached is not None:
            cached.unpersist()


def _output(path: str, fmt: str, config: CleaningConfig) -> dict[str, Any]:
    options = {"header": "true", "sep": config.csv_separator, "quote": config.csv_quote} if fmt == "csv" else {}
    return {"path": path, "format": fmt, "options": options}
