"""Reading tables and sizing what was read."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")

ROWS_PER_PARTITION = 1_000_000
# Bytes of source per shuffle partition.
BYTES_PER_SHUFFLE_PARTITION = 512 * 2**20
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def check_format(fmt: str) -> str:
    name = fmt.lower()
    if name not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}; use one of {', '.join(FORMATS)}")
    return name


def csv_options(
    separator: str = ",",
    quote: str = '"',
    escape: str = "\\",
    header: bool = True,
    infer_schema: bool = False,
    multiline: bool = True,
) -> dict:
    return {
        "sep": separator, "quote": quote, "escape": escape, "header": header,
        "inferSchema": infer_schema, "multiLine": multiline,
    }


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read all files below ``path``.

    CSV takes ``separator, quote, escape, header, infer_schema, multiline``; any other keyword goes
    to Spark's reader as it is. ``multiline`` is on by default so that quoted values may hold line
    breaks; then a file is read by one task, so turn it off for large files without such breaks.
    Small files are packed into one task up to ``spark.sql.files.maxPartitionBytes``.
    """
    fmt = check_format(fmt)
    if fmt == "csv":
        known = csv_options.__code__.co_varnames
        named = {k: options.pop(k) for k in list(options) if k in known}
        options = csv_options(**named) | options
    reader = spark.read.format(fmt).options(recursiveFileLookup=True, **options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """A seeded random share of the rows, whatever the size of the table."""
    return df.sample(fraction=fraction, seed=seed)


def partitions_for(records: int, rows: int = ROWS_PER_PARTITION, lo: int = 1, hi: int | None = None) -> int:
    """Partitions of about ``rows`` rows, at least ``lo``; no upper bound unless one is given."""
    wanted = max(records // rows, lo)
    return wanted if hi is None else min(wanted, hi)


def repartition_by_rows(
    df: DataFrame,
    records: int,
    rows: int = ROWS_PER_PARTITION,
    lo: int = 1,
    hi: int | None = None,
) -> DataFrame:
    """Spread ``records`` rows over partitions of about ``rows`` each. A full shuffle: cleaning runs
    do it only when asked to, and otherwise keep the scan's own partitions."""
    return df.repartition(partitions_for(records, rows, lo, hi))


def source_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Size of all files below ``path``; lists them and opens none."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.agg(F.sum("length")).first()[0] or 0


@contextmanager
def sized_shuffles(spark: SparkSession, size: int):
    """Within, shuffles have enough partitions for a source of ``size`` bytes; never fewer than the
    session asks for. Adaptive execution merges those that turn out small."""
    asked = spark.conf.get(SHUFFLE_PARTITIONS)
    wanted = size // BYTES_PER_SHUFFLE_PARTITION
    if wanted <= int(asked):
        yield
        return
    spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, asked)
