"""One query per operator. Dates, timestamps and decimals are shown as text in both dialects."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import scrub
from scrub import Action, CleaningConfig, ConvertOptions, DerivedColumn, Rule, SchemaSpec
from scrub.functions.parse import DATE_FORMATS
from scrub.sources import LOSSLESS_CSV, scratch_path

from .registry import ORACLES, query  # noqa: F401

TEXT_COLUMNS = ("order_id", "customer_id", "priority", "amount", "order_date", "is_active")
ORDER_DATES = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyyMMdd")


def shown(df: DataFrame, *names: str) -> DataFrame:
    """The columns, those of types that print differently per client as text."""
    kinds = dict(df.dtypes)
    return df.select(
        *[
            F.col(n).cast("string").alias(n)
            if kinds[n].startswith(("decimal", "date", "timestamp")) else F.col(n)
            for n in names or df.columns
        ]
    )


# --- sources and sinks ---------------------------------------------------------------------------


@query(
    "scan_csv", "dirty_orders",
    "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM <dirty_orders>",
)
def scan_csv(df):
    path = scratch_path(df.sparkSession, "orders-csv") + "/nested/folder"
    scrub.write_table(df, path, "csv", separator=";", **LOSSLESS_CSV)
    return scrub.read_table(
        df.sparkSession, path.rsplit("/", 2)[0], "csv", separator=";", **LOSSLESS_CSV
    )


@query("scan_json", "dirty_orders", "SELECT * FROM <dirty_orders>")
def scan_json(df):
    path = scratch_path(df.sparkSession, "orders-json")
    scrub.write_table(df, path + "/nested", "json")
    return scrub.read_table(df.sparkSession, path, "json")


@query("scan_parquet", "dirty_orders", "SELECT * FROM <dirty_orders>")
def scan_parquet(df):
    path = scratch_path(df.sparkSession, "orders-parquet")
    scrub.write_table(df, path + "/nested", "parquet")
    return scrub.read_table(df.sparkSession, path, "parquet")


@query("sink_roundtrip_parquet", "dirty_orders", "SELECT * FROM <dirty_orders>")
def sink_roundtrip_parquet(df):
    path = scratch_path(df.sparkSession, "orders-zstd")
    scrub.write_table(df, path, "parquet", compression="zstd")
    return scrub.read_table(df.sparkSession, path, "parquet")


@query("sink_roundtrip_csv", "dirty_orders", "SELECT * FROM <dirty_orders>")
def sink_roundtrip_csv(df):
    path = scratch_path(df.sparkSession, "orders-tab")
    scrub.write_table(df, path, "csv", separator="\t", quote="'", **LOSSLESS_CSV)
    return scrub.read_table(
        df.sparkSession, path, "csv", df.schema, separator="\t", quote="'", **LOSSLESS_CSV
    )


@query("sink_roundtrip_json", "dirty_orders", "SELECT * FROM <dirty_orders>")
def sink_roundtrip_json(df):
    path = scratch_path(df.sparkSession, "orders-lines")
    scrub.write_table(df, path, "json")
    return scrub.read_table(df.sparkSession, path, "json", df.schema)


# --- schema --------------------------------------------------------------------------------------


@query(
    "schema_report", "orders_text",
    """
    WITH s AS (
      SELECT count(TRY_CAST(replace(price_txt, ',', '') AS DOUBLE)) * 1.0 / count(price_txt) AS price,
             count(try_strptime(date_txt, '%Y/%m/%d')) * 1.0 / count(date_txt) AS day
      FROM <orders_text>),
    t AS (
      SELECT CASE WHEN price > 0.95 THEN 'decimal(38,10)' ELSE 'string' END AS price_type,
             CASE WHEN day > 0.90 THEN 'date' ELSE 'string' END AS date_type FROM s)
    SELECT 'id_txt' AS column_name, 'required' AS "check", 'present' AS expected,
           'present' AS actual, true AS ok
    UNION ALL SELECT 'weight_txt', 'required', 'present', 'missing', false
    UNION ALL SELECT NULL, 'min_columns', '5', '7', true
    UNION ALL SELECT NULL, 'max_columns', '6', '7', false
    UNION ALL SELECT 'price_txt', 'type', 'decimal(12,2)', price_type,
                     price_type = 'decimal(12,2)' FROM t
    UNION ALL SELECT 'date_txt', 'type', 'date', date_type, date_type = 'date' FROM t
    """,
)
def schema_report(df):
    spec = SchemaSpec(
        required_columns=("id_txt", "weight_txt"),
        column_types={"price_txt": "decimal(12,2)", "date_txt": "date"},
        min_columns=5,
        max_columns=6,
    )
    return scrub.schema_report(scrub.convert_types(df), spec)


# --- profiles ------------------------------------------------------------------------------------


def per_column(columns, one: str) -> str:
    """The same SELECT for each column; ``{c}`` is the column, ``{kind}`` its Spark type."""
    return " UNION ALL ".join(one.format(c=c, kind=k) for c, k in columns)


@query(
    "profile_table", "dirty_orders",
    "SELECT count(*) AS total_records, 6 AS total_columns FROM <dirty_orders>",
)
def profile_table(df):
    return scrub.table_profile(df)


@query(
    "profile_common", "dirty_orders",
    "WITH t AS (SELECT * FROM <dirty_orders>) " + per_column(
        zip(TEXT_COLUMNS, ("bigint", "bigint", "string", "string", "string", "string")),
        """SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) AS total_records,
        count(*) - count({c}) AS null_count,
        round((count(*) - count({c})) * 100.0 / count(*), 6) AS null_percentage,
        count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS unique_count,
        round((count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)) * 100.0
              / count(*), 6) AS uniqueness_percentage
        FROM t""",
    ),
)
def profile_common(df):
    return scrub.profile(df).select(
        "column_name", "data_type", "total_records", "null_count",
        F.round("null_percentage", 6).alias("null_percentage"), "unique_count",
        F.round("uniqueness_percentage", 6).alias("uniqueness_percentage"),
    )


STRING_PROFILE = """SELECT '{c}' AS column_name, min(length({c})) AS min_length,
    max(length({c})) AS max_length, round(avg(length({c})), 2) AS avg_length,
    count(*) FILTER (WHERE {c} = '') AS empty_string_count,
    count(*) FILTER (WHERE regexp_replace({c}, '\\s+', '', 'g') = '') AS whitespace_only_count
    FROM t"""


def string_profile(df):
    return scrub.profile(df).select(
        "column_name", "min_length", "max_length", "avg_length", "empty_string_count",
        "whitespace_only_count",
    ).where("min_length IS NOT NULL")


query(
    "profile_string", "documents",
    "WITH t AS (SELECT * FROM documents) " + per_column(
        zip(("text", "lang", "source"), ("string",) * 3), STRING_PROFILE
    ),
)(string_profile)

query(
    "profile_string_dirty", "dirty_orders",
    "WITH t AS (SELECT * FROM <dirty_orders>) " + per_column(
        zip(("priority", "amount", "order_date", "is_active"), ("string",) * 4), STRING_PROFILE
    ),
)(string_profile)

LINEITEM_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)


@query(
    "profile_numeric", "lineitem",
    per_column(
        zip(LINEITEM_NUMBERS, ("",) * 8),
        """SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value,
        CAST(max({c}) AS DOUBLE) AS max_value, round(avg({c}), 4) AS mean,
        round(stddev_samp({c}), 4) AS std_dev, round(var_samp({c}), 2) AS variance,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
        round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3,
        count(*) FILTER (WHERE {c} = 0) AS zero_count,
        count(*) FILTER (WHERE {c} < 0) AS negative_count FROM lineitem""",
    ),
)
def profile_numeric(df):
    return scrub.profile(df, exact_quantiles=True).where("mean IS NOT NULL").select(
        "column_name", F.col("min_value").cast("double").alias("min_value"),
        F.col("max_value").cast("double").alias("max_value"), "mean", "std_dev",
        F.round("variance", 2).alias("variance"),
        *[F.round(q, 6).alias(q) for q in ("q1", "median", "q3")], "zero_count", "negative_count",
    )


@query(
    "profile_datetime", "dirty_events",
    """SELECT 'ts' AS column_name, CAST(min(ts) AS VARCHAR) AS min_date,
    CAST(max(ts) AS VARCHAR) AS max_date, datesub('day', min(ts), max(ts)) AS date_range_days
    FROM <dirty_events>""",
)
def profile_datetime(df):
    return scrub.profile(df).where("date_range_days IS NOT NULL").select(
        "column_name", "min_date", "max_date", "date_range_days"
    )


@query(
    "profile_boolean", "dirty_events",
    """SELECT 'ok' AS column_name, count(*) FILTER (WHERE ok) AS true_count,
    count(*) FILTER (WHERE NOT ok) AS false_count,
    round(count(*) FILTER (WHERE ok) * 100.0 / count(ok), 6) AS true_percentage,
    round(count(*) FILTER (WHERE NOT ok) * 100.0 / count(ok), 6) AS false_percentage
    FROM <dirty_events>""",
)
def profile_boolean(df):
    return scrub.profile(df).where("true_count IS NOT NULL").select(
        "column_name", "true_count", "false_count",
        F.round("true_percentage", 6).alias("true_percentage"),
        F.round("false_percentage", 6).alias("false_percentage"),
    )


# --- strings -------------------------------------------------------------------------------------


@query(
    "str_trim", "dirty_orders",
    """SELECT order_id, trim(priority) AS priority, trim(amount) AS amount,
    trim(is_active) AS is_active FROM <dirty_orders>""",
)
def str_trim(df):
    return scrub.clean_strings(df, collapse=False).select(
        "order_id", "priority", "amount", "is_active"
    )


DOCUMENT_TEXTS = ("text", "lang", "source")


def documents(**options):
    def build(df):
        cleaned = scrub.clean_strings(df, **options)
        return cleaned.select(
            "doc_id", *[F.length(c).alias(f"{c}_n") for c in DOCUMENT_TEXTS],
            *[F.md5(c).alias(f"{c}_md5") for c in DOCUMENT_TEXTS],
        )

    return build


def documents_sql(value: str) -> str:
    """All texts of the documents by ``value``, in which ``{c}`` is a column."""
    values = ", ".join(f"{value.format(c=c)} AS {c}" for c in DOCUMENT_TEXTS)
    found = ", ".join(f"length({c}) AS {c}_n, md5({c}) AS {c}_md5" for c in DOCUMENT_TEXTS)
    return f"WITH t AS (SELECT doc_id, {values} FROM documents) SELECT doc_id, {found} FROM t"


SPACES = r"'[ \t\n\x0B\f\r]+'"

query(
    "str_collapse", "documents",
    documents_sql(f"regexp_replace({{c}}, {SPACES}, ' ', 'g')"),
)(documents(trim=False))

query("str_lower", "documents", documents_sql("lower({c})"))(
    documents(trim=False, collapse=False, case="lower")
)

# DuckDB maps characters one by one; the upper case of the German sharp s is two letters.
query("str_upper", "documents", documents_sql("upper(replace({c}, 'ß', 'ss'))"))(
    documents(trim=False, collapse=False, case="upper")
)

query(
    "str_alnum", "documents",
    documents_sql(r"regexp_replace({c}, '[^a-zA-Z0-9 \t\n\x0B\f\r]', '', 'g')"),
)(documents(trim=False, collapse=False, alnum_columns=DOCUMENT_TEXTS))

query(
    "str_clean_all", "documents",
    documents_sql(
        rf"regexp_replace(lower(regexp_replace(trim({{c}}), {SPACES}, ' ', 'g')), "
        r"'[^a-zA-Z0-9 \t\n\x0B\f\r]', '', 'g')"
    ),
)(documents(case="lower", alnum_columns=DOCUMENT_TEXTS))


@query(
    "str_title", "dirty_orders",
    r"""SELECT order_id,
    array_to_string(list_transform(regexp_extract_all(lower(priority), '\w+|\W+'),
                                   lambda x: concat(upper(x[1]), x[2:])), '') AS priority,
    array_to_string(list_transform(regexp_extract_all(lower(is_active), '\w+|\W+'),
                                   lambda x: concat(upper(x[1]), x[2:])), '') AS is_active
    FROM <dirty_orders>""",
)
def str_title(df):
    return scrub.clean_strings(df, trim=False, collapse=False, case="title").select(
        "order_id", "priority", "is_active"
    )


# --- types ---------------------------------------------------------------------------------------


@query(
    "cast_primitives", "orders_text",
    """SELECT id_txt, TRY_CAST(id_txt AS INTEGER) AS as_int, TRY_CAST(id_txt AS BIGINT) AS as_long,
    CAST(trunc(TRY_CAST(price_txt AS DOUBLE)) AS BIGINT) AS price_long,
    TRY_CAST(price_txt AS DOUBLE) AS price_double,
    CAST(TRY_CAST(price_txt AS FLOAT) AS DOUBLE) AS price_float,
    CAST(TRY_CAST(id_txt AS BIGINT) AS VARCHAR) AS as_text FROM <orders_text>""",
)
def cast_primitives(df):
    wide = df.select(
        "id_txt", F.col("id_txt").alias("as_int"), F.col("id_txt").alias("as_long"),
        F.col("price_txt").alias("price_long"), F.col("price_txt").alias("price_double"),
        F.col("price_txt").alias("price_float"), F.col("id_txt").cast("long").alias("as_text"),
    )
    converted = scrub.convert_types(
        wide,
        {"as_int": "integer", "as_long": "BIGINT", "price_long": "long", "price_double": "float8",
         "price_float": "real", "as_text": "string"},
        infer=False,
    )
    return converted.withColumn("price_float", F.col("price_float").cast("double"))


@query(
    "cast_ddl", "orders_text",
    """SELECT id_txt, TRY_CAST(id_txt AS SMALLINT) AS as_small, TRY_CAST(flag_txt AS TINYINT) AS
    flag, CAST(TRY_CAST(ts_txt AS TIMESTAMP) AS VARCHAR) AS moment FROM <orders_text>""",
)
def cast_ddl(df):
    wide = df.select(
        "id_txt", F.col("id_txt").alias("as_small"), F.col("flag_txt").alias("flag"),
        F.col("ts_txt").alias("moment"),
    )
    return shown(
        scrub.convert_types(
            wide, {"as_small": "smallint", "flag": "tinyint", "moment": "timestamp_ntz"}, infer=False
        )
    )


def amounts(options: ConvertOptions = ConvertOptions(), **targets: str):
    def build(df):
        wide = df.select("order_id", *[F.col("amount").alias(c) for c in targets])
        return shown(scrub.convert_types(wide, targets, False, options))

    return build


query(
    "cast_decimal_ps", "dirty_orders",
    """SELECT order_id, CAST(TRY_CAST(amount AS DECIMAL(12,2)) AS VARCHAR) AS exact,
    CAST(TRY_CAST(amount AS DECIMAL(9,1)) AS VARCHAR) AS rounded,
    CAST(TRY_CAST(amount AS DECIMAL(18,3)) AS VARCHAR) AS fallback FROM <dirty_orders>""",
)(amounts(ConvertOptions(precision=18, scale=3), exact="decimal(12,2)", rounded="decimal(9, 1)",
          fallback="decimal(5)"))

query(
    "cast_decimal", "dirty_orders",
    """SELECT order_id, CAST(TRY_CAST(amount AS DECIMAL(38,10)) AS VARCHAR) AS as_decimal,
    CAST(TRY_CAST(amount AS DECIMAL(38,10)) AS VARCHAR) AS as_numeric FROM <dirty_orders>""",
)(amounts(as_decimal="decimal", as_numeric="NUMERIC"))

query(
    "decimal_overflow_null", "dirty_orders",
    """SELECT order_id, CAST(TRY_CAST(amount AS DECIMAL(7,2)) AS VARCHAR) AS amount
    FROM <dirty_orders>""",
)(amounts(ConvertOptions(precision=7, scale=2, overflow="null"), amount="decimal"))

query(
    "decimal_overflow_clamp", "dirty_orders",
    """SELECT order_id, CASE WHEN TRY_CAST(amount AS DOUBLE) > 99999.99 THEN '99999.99'
    WHEN TRY_CAST(amount AS DOUBLE) < -99999.99 THEN '-99999.99'
    ELSE CAST(TRY_CAST(amount AS DECIMAL(7,2)) AS VARCHAR) END AS amount FROM <dirty_orders>""",
)(amounts(ConvertOptions(precision=7, scale=2), amount="decimal"))

query(
    "decimal_overflow_string", "dirty_orders",
    """SELECT order_id, coalesce(CAST(TRY_CAST(amount AS DECIMAL(7,2)) AS VARCHAR), amount) AS amount
    FROM <dirty_orders>""",
)(amounts(ConvertOptions(precision=7, scale=2, overflow="string"), amount="decimal"))

# The default date formats in DuckDB's notation, last one first as it wins.
DATES_SQL = ("%Y.%m.%d", "%d.%m.%Y", "%m-%d-%Y", "%Y%m%d", "%Y/%m/%d", "%d/%m/%Y", "%d-%m-%Y",
             "%m/%d/%Y", "%Y-%m-%d")


def first_of(column: str, formats) -> str:
    return "coalesce(" + ", ".join(f"try_strptime({column}, '{f}')" for f in formats) + ")"


@query(
    "parse_date_multi", "dirty_orders",
    f"""SELECT order_id, CAST(CAST({first_of('order_date', DATES_SQL)} AS DATE) AS VARCHAR)
    AS order_date FROM <dirty_orders>""",
)
def parse_date_multi(df):
    dates = df.select("order_id", "order_date")
    return shown(scrub.convert_types(dates, {"order_date": "date"}, infer=False))


@query(
    "parse_timestamp_multi", "orders_text",
    f"""SELECT id_txt, CAST({first_of('ts_txt', ('%d/%m/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S'))}
    AS VARCHAR) AS ts_txt,
    CAST({first_of("replace(strftime(CAST(ts_txt AS TIMESTAMP), '%d/%m/%Y %H:%M:%S'), '-', '/')",
                   ('%d/%m/%Y %H:%M:%S', '%m/%d/%Y %H:%M:%S'))} AS VARCHAR) AS other
    FROM <orders_text>""",
)
def parse_timestamp_multi(df):
    times = df.select(
        "id_txt", "ts_txt",
        F.date_format(F.col("ts_txt").cast("timestamp_ntz"), "dd/MM/yyyy HH:mm:ss").alias("other"),
    )
    return shown(
        scrub.convert_types(times, {"ts_txt": "timestamp", "other": "timestamp"}, infer=False)
    )


BOOLEAN_SQL = """CASE WHEN lower(trim({c})) IN ('true', 't', 'yes', 'y', '1', 'on') THEN true
    WHEN lower(trim({c})) IN ('false', 'f', 'no', 'n', '0', 'off') THEN false END"""


@query(
    "parse_boolean", "dirty_orders",
    f"SELECT order_id, {BOOLEAN_SQL.format(c='is_active')} AS is_active FROM <dirty_orders>",
)
def parse_boolean(df):
    words = df.select("order_id", "is_active")
    return scrub.convert_types(words, {"is_active": "boolean"}, infer=False)


REPORT_SQL = """SELECT '{c}' AS column_name, '{kind}' AS target_type, count({c}) AS before_count,
    count({c}_new) AS after_count, round(count({c}_new) * 1.0 / count({c}), 6) AS success_rate,
    count({c}_new) * 1.0 / count({c}) < 0.8 AS low_success FROM t"""


@query(
    "conversion_report", "dirty_orders",
    f"""WITH t AS (SELECT *, TRY_CAST(amount AS DECIMAL(12,2)) AS amount_new,
      {first_of('order_date', ('%Y%m%d', '%m/%d/%Y', '%Y-%m-%d'))} AS order_date_new,
      {BOOLEAN_SQL.format(c='is_active')} AS is_active_new FROM <dirty_orders>) """
    + per_column(
        (("amount", "decimal(12,2)"), ("order_date", "date"), ("is_active", "boolean")), REPORT_SQL
    ),
)
def conversion_report(df):
    report = scrub.conversion_report(
        df,
        {"amount": "decimal(12,2)", "order_date": "date", "is_active": "boolean"},
        options=ConvertOptions(date_formats=ORDER_DATES),
    )
    return report.select(
        "column_name", "target_type", "before_count", "after_count",
        F.round("success_rate", 6).alias("success_rate"), "low_success",
    )


NUMBER_SQL = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"
INFER_COLUMNS = ("id_txt", "price_txt", "flag_txt", "date_txt", "ts_txt", "compact_txt", "text_txt")
SHARES_SQL = "WITH t AS (SELECT * FROM <orders_text>), s AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS n,
    count(*) FILTER (WHERE lower(trim({c})) IN ('true', 't', 'yes', 'y', '1', 'on', 'false', 'f',
                                                'no', 'n', '0', 'off')) AS b,
    count(*) FILTER (WHERE regexp_matches(replace({c}, ',', ''), {NUMBER_SQL})) AS d,
    count(*) FILTER (WHERE regexp_matches(replace({c}, ',', ''), {NUMBER_SQL})
      AND TRY_CAST(replace({c}, ',', '') AS DOUBLE)
          = floor(TRY_CAST(replace({c}, ',', '') AS DOUBLE))) AS i,
    count({first_of(c, ('%d/%m/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S'))}) AS ts,
    count({first_of(c, DATES_SQL)}) AS day FROM t""".replace("\n", " ")
    for c in INFER_COLUMNS
) + ") "


@query(
    "infer_shares", "orders_text",
    SHARES_SQL + """SELECT column_name, n AS non_null_count, round(b * 1.0 / n, 6) AS boolean_share,
    round(d * 1.0 / n, 6) AS numeric_share, round(i * 1.0 / n, 6) AS integer_share,
    round(ts * 1.0 / n, 6) AS timestamp_share, round(day * 1.0 / n, 6) AS date_share FROM s""",
)
def infer_shares(df):
    shares = scrub.infer_shares(df)
    return shares.select(
        "column_name", "non_null_count",
        *[F.round(c, 6).alias(c) for c in shares.columns if c.endswith("_share")],
    )


@query(
    "infer_types", "orders_text",
    SHARES_SQL + """SELECT column_name, CASE WHEN b > 0.95 * n THEN 'boolean'
    WHEN d > 0.95 * n AND i > 0.98 * n THEN 'long' WHEN d > 0.95 * n THEN 'decimal'
    WHEN ts > 0.90 * n THEN 'timestamp' WHEN day > 0.90 * n THEN 'date' ELSE 'string' END
    AS inferred_type FROM s""",
)
def infer_types(df):
    return scrub.infer_types(df)


@query(
    "infer_optout", "orders_text",
    f"""SELECT TRY_CAST(id_txt AS BIGINT) AS id_txt,
    CAST(TRY_CAST(price_txt AS DECIMAL(38,10)) AS VARCHAR) AS price_txt,
    {BOOLEAN_SQL.format(c='flag_txt')} AS flag_txt,
    CAST(CAST({first_of('date_txt', DATES_SQL)} AS DATE) AS VARCHAR) AS date_txt,
    CAST(CAST(ts_txt AS TIMESTAMP) AS VARCHAR) AS ts_txt, compact_txt, text_txt
    FROM <orders_text>""",
)
def infer_optout(df):
    return shown(scrub.convert_types(df, {"compact_txt": "string"}))


# --- nulls ---------------------------------------------------------------------------------------


@query(
    "null_drop_critical", "dirty_events",
    """SELECT event_id, user_id, value, event_type, ok FROM <dirty_events>
    WHERE value IS NOT NULL AND NOT isnan(value) AND event_type IS NOT NULL""",
)
def null_drop_critical(df):
    return scrub.drop_null_keys(df, ["value", "event_type", "no_such_column"]).drop("ts")


def filled(*columns: str, **values):
    def build(df):
        return shown(scrub.fill_nulls(df, **values), *columns)

    return build


query(
    "null_fill_string", "dirty_events",
    "SELECT event_id, coalesce(event_type, 'N/A') AS event_type, ok FROM <dirty_events>",
)(filled("event_id", "event_type", "ok", strings="N/A"))

query(
    "null_fill_number", "dirty_events",
    """SELECT event_id, user_id, CASE WHEN value IS NULL OR isnan(value) THEN 0.5 ELSE value END
    AS value FROM <dirty_events>""",
)(filled("event_id", "user_id", "value", numbers="0.5"))

query(
    "null_fill_date", "dirty_events",
    """SELECT event_id, CAST(coalesce(ts, TIMESTAMP '2000-01-01 00:00:00') AS VARCHAR) AS ts
    FROM <dirty_events>""",
)(filled("event_id", "ts", dates="2000-01-01 00:00:00"))

query(
    "null_fill_boolean", "dirty_events",
    "SELECT event_id, coalesce(ok, false) AS ok FROM <dirty_events>",
)(filled("event_id", "ok", booleans="false"))


# --- rules ---------------------------------------------------------------------------------------


@query(
    "rule_drop_row", "dirty_orders",
    "SELECT * FROM <dirty_orders> WHERE NOT (customer_id < 100)",
)
def rule_drop_row(df):
    return scrub.apply_rules(df, [Rule("customer_id", "customer_id < 100")]).clean


@query(
    "rule_set_null", "customer",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
    c_mktsegment FROM customer""",
)
def rule_set_null(df):
    rules = [Rule("c_acctbal", "c_acctbal < 0", Action.SET_NULL, "negative")]
    return scrub.apply_rules(df, rules).clean.select("c_custkey", "c_acctbal", "c_mktsegment")


@query(
    "rule_set_default", "customer",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE c_mktsegment END AS c_mktsegment
    FROM customer""",
)
def rule_set_default(df):
    rules = [
        Rule("c_acctbal", "c_acctbal < 0", Action.SET_DEFAULT, "negative", default=0),
        Rule("c_mktsegment", "c_mktsegment = 'MACHINERY'", Action.SET_DEFAULT, "gone", default=""),
    ]
    return scrub.apply_rules(df, rules).clean.select("c_custkey", "c_acctbal", "c_mktsegment")


@query(
    "rule_flag", "dirty_orders",
    """SELECT order_id, customer_id, coalesce(customer_id < 100, false) AS customer_id_early_flag,
    coalesce(amount = 'abc', false) AS amount_words_flag FROM <dirty_orders>""",
)
def rule_flag(df):
    rules = [
        Rule("customer_id", "customer_id < 100", Action.FLAG_RECORD, "early"),
        Rule("amount", "amount = 'abc'", Action.FLAG_RECORD, "words"),
    ]
    return scrub.apply_rules(df, rules).clean.select(
        "order_id", "customer_id", "customer_id_early_flag", "amount_words_flag"
    )


QUARANTINE_RULES = (
    Rule("amount", "amount = 'abc'", Action.QUARANTINE, "not_a_number"),
    Rule("customer_id", "customer_id < 100", Action.SET_NULL, "early"),
    Rule("order_date", "order_date = 'unknown' AND customer_id IS NULL", Action.QUARANTINE, "lost"),
)
QUARANTINE_SQL = """WITH a AS (SELECT *, coalesce(amount = 'abc', false) AS q1 FROM <dirty_orders>),
    b AS (SELECT order_id, CASE WHEN NOT q1 AND customer_id < 100 THEN NULL ELSE customer_id END
          AS customer_id, priority, amount, order_date, is_active, q1 FROM a),
    c AS (SELECT *, NOT q1 AND coalesce(order_date = 'unknown' AND customer_id IS NULL, false) AS q2
          FROM b) """


@query(
    "rule_quarantine_rows", "dirty_orders",
    QUARANTINE_SQL + """SELECT order_id, customer_id, priority, amount, order_date, is_active,
    CASE WHEN q1 THEN 'not_a_number' ELSE 'lost' END AS quarantine_reason,
    md5(concat_ws('|', order_id, customer_id, priority, amount, order_date, is_active))
    AS original_row_hash FROM c WHERE q1 OR q2""",
)
def rule_quarantine_rows(df):
    return scrub.apply_rules(df, QUARANTINE_RULES).quarantined.drop("quarantine_timestamp")


@query(
    "rule_quarantine_clean", "dirty_orders",
    QUARANTINE_SQL + """SELECT order_id, customer_id, priority, amount, order_date, is_active
    FROM c WHERE NOT q1 AND NOT q2""",
)
def rule_quarantine_clean(df):
    return scrub.apply_rules(df, QUARANTINE_RULES).clean


UNION_RULES = (
    Rule("amount", "amount = 'abc'", Action.QUARANTINE, "not_a_number"),
    Rule("is_active", "is_active = 'maybe'", Action.FLAG_RECORD, "vague"),
    Rule("order_date", "order_date = 'unknown'", Action.QUARANTINE, "no_date"),
    Rule("customer_id", "customer_id IS NULL", Action.DROP_ROW, "nobody"),
)


@query(
    "rule_quarantine_union", "dirty_orders",
    """WITH t AS (SELECT * FROM <dirty_orders>)
    SELECT order_id, amount, order_date, CAST(NULL AS BOOLEAN) AS is_active_vague_flag,
      'not_a_number' AS quarantine_reason,
      md5(concat_ws('|', order_id, customer_id, priority, amount, order_date, is_active))
      AS original_row_hash FROM t WHERE amount = 'abc'
    UNION ALL
    SELECT order_id, amount, order_date, is_active = 'maybe', 'no_date',
      md5(concat_ws('|', order_id, customer_id, priority, amount, order_date, is_active,
                    is_active = 'maybe'))
    FROM t WHERE coalesce(amount <> 'abc', true) AND order_date = 'unknown'""",
)
def rule_quarantine_union(df):
    return scrub.apply_rules(df, UNION_RULES).quarantined.select(
        "order_id", "amount", "order_date", "is_active_vague_flag", "quarantine_reason",
        "original_row_hash",
    )


@query(
    "rule_counts", "dirty_orders",
    """WITH t AS (SELECT *, CASE WHEN amount = 'abc' THEN 0
      WHEN order_date = 'unknown' THEN 2 WHEN customer_id IS NULL THEN 3 END AS v
      FROM <dirty_orders>)
    SELECT 0 AS rule_order, 'not_a_number' AS rule_name, 'quarantine' AS action,
      'applied' AS status, count(*) FILTER (WHERE v = 0) AS affected_records FROM t
    UNION ALL SELECT 1, 'vague', 'flag_record', 'applied',
      count(*) FILTER (WHERE coalesce(v, 9) <> 0 AND is_active = 'maybe') FROM t
    UNION ALL SELECT 2, 'no_date', 'quarantine', 'applied', count(*) FILTER (WHERE v = 2) FROM t
    UNION ALL SELECT 3, 'nobody', 'drop_row', 'applied', count(*) FILTER (WHERE v = 3) FROM t
    UNION ALL SELECT 4, 'nowhere', 'drop_row', 'no such column', 0""",
)
def rule_counts(df):
    rules = (*UNION_RULES, Rule("country", "country IS NULL", Action.DROP_ROW, "nowhere"))
    return scrub.apply_rules(df, rules).counts.select(
        "rule_order", "rule_name", "action", "status", "affected_records"
    )


# --- outliers ------------------------------------------------------------------------------------


def quantile_flags(keys, columns, source, low, high, name, width) -> str:
    limits = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS {c}_{n}"
        for c in columns for p, n in ((low, "lo"), (high, "hi"))
    )
    flags = ", ".join(
        f"{c} < {c}_lo - {width} * ({c}_hi - {c}_lo) OR {c} > {c}_hi + {width} * ({c}_hi - {c}_lo) "
        f"AS {c}_outlier_{name}" for c in columns
    )
    return f"WITH q AS (SELECT {limits} FROM {source}) SELECT {keys}, {flags} FROM {source}, q"


LINES = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
)


@query(
    "outlier_iqr", "lineitem",
    quantile_flags("l_orderkey, l_linenumber", LINES, "lineitem", 0.25, 0.75, "iqr", 1.5),
)
def outlier_iqr(df):
    flagged = scrub.flag_outliers(df, "iqr", columns=LINES, exact=True)
    return flagged.select(
        "l_orderkey", "l_linenumber", *[f"{c}_outlier_iqr" for c in LINES]
    )


@query(
    "outlier_quantile", "lineitem",
    quantile_flags("l_orderkey, l_linenumber", LINES, "lineitem", 0.01, 0.99, "isolation", 0),
)
def outlier_quantile(df):
    flagged = scrub.flag_outliers(df, "isolation", columns=LINES, exact=True)
    return flagged.select(
        "l_orderkey", "l_linenumber", *[f"{c}_outlier_isolation" for c in LINES]
    )


EVENT_NUMBERS = ("event_id", "user_id", "value")


@query(
    "outlier_zscore", "events",
    "WITH s AS (SELECT " + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_d" for c in EVENT_NUMBERS)
    + " FROM events) SELECT event_id, user_id, event_type, value, props, "
    + ", ".join(f"abs(({c} - {c}_m) / {c}_d) > 2.5 AS {c}_outlier_zscore" for c in EVENT_NUMBERS) + " FROM events, s",
)
def outlier_zscore(df):
    return scrub.flag_outliers(df, "zscore", threshold=2.5).drop("ts")


# --- duplicates ----------------------------------------------------------------------------------


@query("dedup_all", "dirty_orders", "SELECT DISTINCT * FROM <dirty_orders>")
def dedup_all(df):
    return scrub.dedup(df)


@query(
    "dedup_subset", "dirty_orders",
    """SELECT order_id, customer_id, priority, amount, order_date, is_active FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_id NULLS FIRST,
        priority NULLS FIRST, amount NULLS FIRST, order_date NULLS FIRST, is_active NULLS FIRST)
        AS r FROM <dirty_orders>) WHERE r = 1""",
)
def dedup_subset(df):
    return scrub.dedup(df, ["customer_id", "no_such_column"])


@query(
    "dedup_counts", "dirty_orders",
    """WITH t AS (SELECT * FROM <dirty_orders>),
    a AS (SELECT count(*) AS n FROM t), b AS (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM t))
    SELECT n AS total_records, d AS distinct_records, n - d AS duplicate_records FROM a, b""",
)
def dedup_counts(df):
    return scrub.dedup_counts(df)


# --- derived and audit columns -------------------------------------------------------------------


@query(
    "derive_expr", "lineitem",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross FROM lineitem""",
)
def derive_expr(df):
    specs = [
        DerivedColumn("net", "l_extendedprice * (1 - l_discount)",
                      dependencies=("l_extendedprice", "l_discount")),
        DerivedColumn("gross", "net * (1 + l_tax)"),
        DerivedColumn("lost", "net * weight", dependencies=("weight",)),
    ]
    return scrub.derive(df, specs).drop(
        *[c for c in df.columns if c not in ("l_orderkey", "l_linenumber")]
    )


@query(
    "derive_window", "lineitem",
    """SELECT l_orderkey, l_linenumber,
    rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS place
    FROM lineitem""",
)
def derive_window(df):
    spec = DerivedColumn(
        "place", "rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber)"
    )
    return scrub.derive(df, [spec]).select("l_orderkey", "l_linenumber", "place")


@query(
    "derive_cast", "events",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST(CAST(value AS DECIMAL(12,1)) AS VARCHAR) AS tenths FROM events""",
)
def derive_cast(df):
    specs = [
        DerivedColumn("k", "get_json_object(props, '$.k')", "int"),
        DerivedColumn("tenths", "value", "decimal(12,1)"),
    ]
    return shown(scrub.derive(df, specs), "event_id", "k", "tenths")


@query(
    "audit_columns", "customer",
    """SELECT c_custkey, 'job-7' AS etl_job_id, 'customers' AS etl_source_path,
    md5(concat_ws('|', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) AS etl_row_hash
    FROM customer""",
)
def audit_columns(df):
    audited = scrub.add_audit(df, "job-7", "customers")
    return audited.select("c_custkey", "etl_job_id", "etl_source_path", "etl_row_hash")


@query(
    "audit_row_hash", "lineitem",
    "SELECT l_orderkey, l_linenumber, md5(concat_ws('|', *COLUMNS(*))) AS etl_row_hash FROM lineitem",
)
def audit_row_hash(df):
    return scrub.add_audit(df).select("l_orderkey", "l_linenumber", "etl_row_hash")


@query(
    "audit_load_time", "customer",
    "SELECT c_custkey, true AS is_set, 'timestamp' AS kind FROM customer",
)
def audit_load_time(df):
    audited = scrub.add_audit(df)
    kind = dict(audited.dtypes)["etl_load_timestamp"]
    recent = F.col("etl_load_timestamp") > F.current_timestamp() - F.expr("interval 1 day")
    return audited.select("c_custkey", recent.alias("is_set"), F.lit(kind).alias("kind"))


# --- scores --------------------------------------------------------------------------------------

EVENT_MISSING = """(CASE WHEN value IS NULL OR isnan(value) THEN 1 ELSE 0 END
    + CASE WHEN event_type IS NULL THEN 1 ELSE 0 END + CASE WHEN ok IS NULL THEN 1 ELSE 0 END
    + CASE WHEN ts IS NULL THEN 1 ELSE 0 END)"""


@query(
    "dq_completeness", "dirty_events",
    f"""SELECT count(*) AS total_records, count(*) * 6 AS total_cells,
    CAST(sum({EVENT_MISSING}) AS BIGINT) AS missing_cells,
    round((count(*) * 6 - sum({EVENT_MISSING})) * 100.0 / (count(*) * 6), 6) AS completeness_score
    FROM <dirty_events>""",
)
def dq_completeness(df):
    return scrub.completeness(df).withColumn(
        "completeness_score", F.round("completeness_score", 6)
    )


@query(
    "dq_consistency", "dirty_orders",
    """WITH t AS (SELECT * FROM <dirty_orders>),
    a AS (SELECT count(*) AS n FROM t), b AS (SELECT count(*) AS d FROM (SELECT DISTINCT * FROM t))
    SELECT n AS total_records, d AS distinct_records, round(d * 100.0 / n, 6) AS consistency_score
    FROM a, b""",
)
def dq_consistency(df):
    return scrub.consistency(df).withColumn("consistency_score", F.round("consistency_score", 6))


METRICS = (
    "total_records", "duplicate_records", "null_records", "quarantined_records",
    "type_conversion_failures", "validation_failures", "input_records",
)
SCORES = ("completeness_score", "consistency_score", "validity_score", "overall_quality_score")

ORDER_MISSING = """(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END
    + CASE WHEN amount IS NULL THEN 1 ELSE 0 END + CASE WHEN order_date IS NULL THEN 1 ELSE 0 END
    + CASE WHEN is_active IS NULL THEN 1 ELSE 0 END)"""

# The flagship run over the orders, and what it does as SQL.
CLEAN_ORDERS = CleaningConfig(
    string_case="lower",
    type_map={"amount": "decimal(12,2)", "order_date": "date", "is_active": "boolean"},
    date_formats=ORDER_DATES,
    critical_columns=("customer_id",),
    rules=(Rule("amount", "amount < 1000", Action.DROP_ROW, "small"),),
    source="orders",
    profiling=False,
)
SHAPED_SQL = f"""c AS (SELECT order_id, customer_id,
      lower(regexp_replace(trim(priority), '\\s+', ' ', 'g')) AS priority,
      TRY_CAST(trim(amount) AS DECIMAL(12,2)) AS amount,
      CAST({first_of('order_date', ('%Y%m%d', '%m/%d/%Y', '%Y-%m-%d'))} AS DATE) AS order_date,
      {BOOLEAN_SQL.format(c='is_active')} AS is_active FROM <dirty_orders>)"""
CLEAN_SQL = f"""WITH {SHAPED_SQL}, k AS (SELECT * FROM c WHERE customer_id IS NOT NULL),
    r AS (SELECT * FROM k WHERE NOT (amount < 1000)), u AS (SELECT DISTINCT * FROM r) """


@query(
    "dq_before_after", "dirty_orders",
    CLEAN_SQL + f""", raw AS (SELECT * FROM <dirty_orders>),
    m AS (SELECT 'before' AS stage, count(*) AS n, sum(CASE WHEN customer_id IS NULL THEN 1 ELSE 0
            END + CASE WHEN amount IS NULL THEN 1 ELSE 0 END) AS miss,
            (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS d,
            (SELECT count(*) FROM k) - (SELECT count(*) FROM r) AS failed FROM raw
          UNION ALL SELECT 'after', count(*), sum({ORDER_MISSING}), count(*), 0 FROM u),
    s AS (SELECT stage, n, (n * 6 - miss) * 100.0 / (n * 6) AS c, d * 100.0 / n AS e,
            (n - failed) * 100.0 / n AS v FROM m)
    SELECT stage, n AS total_records, round(c, 6) AS completeness_score, round(e, 6)
      AS consistency_score, round(v, 6) AS validity_score,
      round(0.4 * c + 0.3 * e + 0.3 * v, 6) AS overall_quality_score FROM s""",
)
def dq_before_after(df):
    report = scrub.plan(df, CLEAN_ORDERS).before_after
    return report.select("stage", "total_records", *[F.round(c, 6).alias(c) for c in SCORES])


@query(
    "audit_quality_score", "dirty_orders",
    CLEAN_SQL + f""", m AS (SELECT count(*) AS n, sum({ORDER_MISSING}) AS miss,
      (SELECT count(*) FROM k) - (SELECT count(*) FROM r) AS failed FROM u)
    SELECT order_id, round(0.4 * ((n * 6 - miss) * 100.0 / (n * 6)) + 0.3 * 100
      + 0.3 * ((n - failed) * 100.0 / n), 6) AS etl_quality_score FROM u, m""",
)
def audit_quality_score(df):
    clean = scrub.plan(df, replace(CLEAN_ORDERS, profiling=True)).clean
    return clean.select("order_id", F.round("etl_quality_score", 6).alias("etl_quality_score"))


# --- composed runs -------------------------------------------------------------------------------


@query(
    "clean_orders", "dirty_orders",
    CLEAN_SQL + """SELECT order_id, customer_id, priority, CAST(amount AS VARCHAR) AS amount,
    CAST(order_date AS VARCHAR) AS order_date, is_active, 'unknown' AS etl_job_id,
    'orders' AS etl_source_path,
    md5(concat_ws('|', order_id, customer_id, priority, amount, order_date, is_active))
    AS etl_row_hash FROM u""",
)
def clean_orders(df):
    return shown(scrub.plan(df, CLEAN_ORDERS).clean.drop("etl_load_timestamp"))


# A run with every row-wise step: fills, a quarantine before and after a change, flags, derivation.
STRICT_ORDERS = CleaningConfig(
    string_case="lower",
    type_map={"amount": "decimal(12,2)", "order_date": "date", "is_active": "boolean"},
    date_formats=ORDER_DATES,
    critical_columns=("customer_id",),
    fill_dates="1990-01-01",
    fill_booleans="false",
    rules=(
        Rule("amount", "amount IS NULL", Action.QUARANTINE, "no_amount"),
        Rule("amount", "amount > 400000", Action.SET_DEFAULT, "large", default=400000),
        Rule("priority", "priority LIKE '%not specified%'", Action.FLAG_RECORD, "vague"),
        Rule("order_date", "order_date < '1993-01-01' AND amount < 50000", Action.QUARANTINE, "old"),
        Rule("amount", "amount < 1000", Action.DROP_ROW, "small"),
    ),
    derived=(DerivedColumn("order_year", "year(order_date)", "int", dependencies=("order_date",)),),
    source="orders",
    profiling=False,
)
STRICT_SQL = f"""WITH {SHAPED_SQL},
    f AS (SELECT order_id, customer_id, priority, amount,
      coalesce(order_date, DATE '1990-01-01') AS order_date, coalesce(is_active, false) AS is_active
      FROM c WHERE customer_id IS NOT NULL),
    q1 AS (SELECT *, CAST(NULL AS BOOLEAN) AS priority_vague_flag FROM f WHERE amount IS NULL),
    g AS (SELECT * REPLACE (CASE WHEN amount > 400000 THEN CAST(400000 AS DECIMAL(12,2))
            ELSE amount END AS amount), priority LIKE '%not specified%' AS priority_vague_flag
          FROM f WHERE amount IS NOT NULL),
    q2 AS (SELECT * FROM g WHERE order_date < DATE '1993-01-01' AND amount < 50000),
    h AS (SELECT * FROM g WHERE NOT (order_date < DATE '1993-01-01' AND amount < 50000)),
    r AS (SELECT * FROM h WHERE NOT (amount < 1000)),
    u AS (SELECT DISTINCT * FROM r) """


@query(
    "clean_orders_quarantine", "dirty_orders",
    STRICT_SQL + """, q AS (SELECT *, 'no_amount' AS quarantine_reason FROM q1
      UNION ALL SELECT *, 'old' FROM q2)
    SELECT order_id, customer_id, priority, CAST(amount AS VARCHAR) AS amount,
      CAST(order_date AS VARCHAR) AS order_date, is_active, priority_vague_flag, quarantine_reason,
      md5(concat_ws('|', order_id, customer_id, priority, amount, order_date, is_active,
                    priority_vague_flag)) AS original_row_hash FROM q""",
)
def clean_orders_quarantine(df):
    return shown(scrub.plan(df, STRICT_ORDERS).quarantine.drop("quarantine_timestamp"))


def rounded_metrics(config: CleaningConfig):
    def build(df):
        metrics = scrub.plan(df, config).metrics
        return metrics.select(*METRICS, *[F.round(c, 6).alias(c) for c in SCORES])

    return build


def metrics_sql(head: str, width: int, counters: str) -> str:
    return head + f""", m AS (SELECT count(*) AS n, sum({ORDER_MISSING}) AS miss FROM u),
    x AS (SELECT n AS total_records, (SELECT count(*) FROM r) - n AS duplicate_records,
      (SELECT count(*) FROM c WHERE customer_id IS NULL) AS null_records, {counters},
      0 AS type_conversion_failures, (SELECT count(*) FROM c) AS input_records,
      (n * {width} - miss) * 100.0 / (n * {width}) AS a FROM m),
    y AS (SELECT *, greatest(0, least(100, (total_records - quarantined_records
      - validation_failures) * 100.0 / total_records)) AS v FROM x)
    SELECT total_records, duplicate_records, null_records, quarantined_records,
      type_conversion_failures, validation_failures, input_records,
      round(a, 6) AS completeness_score, 100.0 AS consistency_score, round(v, 6) AS validity_score,
      round(0.4 * a + 30 + 0.3 * v, 6) AS overall_quality_score FROM y"""


query(
    "dq_metrics", "dirty_orders",
    metrics_sql(
        CLEAN_SQL, 6,
        """0 AS quarantined_records,
        (SELECT count(*) FROM k) - (SELECT count(*) FROM r) AS validation_failures""",
    ),
)(rounded_metrics(CLEAN_ORDERS))

query(
    "clean_orders_metrics", "dirty_orders",
    metrics_sql(
        STRICT_SQL, 8,
        """(SELECT count(*) FROM q1) + (SELECT count(*) FROM q2) AS quarantined_records,
        (SELECT count(*) FROM h) - (SELECT count(*) FROM r) AS validation_failures""",
    ),
)(rounded_metrics(STRICT_ORDERS))


# --- values that expressions, types and sinks must not lose --------------------------------------


@query(
    "rule_bad_cast", "dirty_orders",
    "SELECT order_id, amount FROM <dirty_orders> WHERE NOT coalesce(TRY_CAST(amount AS DOUBLE) > 1000, false)",
)
def rule_bad_cast(df):
    rule = Rule("amount", "cast(amount AS double) > 1000", Action.QUARANTINE)
    return scrub.apply_rules(df, [rule]).clean.select("order_id", "amount")


@query(
    "derive_bad_division", "dirty_orders",
    """SELECT order_id, CASE WHEN order_id % 4 = 0 THEN NULL ELSE 12.0 / (order_id % 4) END AS share,
    TRY_CAST(priority AS INTEGER) AS number FROM <dirty_orders>""",
)
def derive_bad_division(df):
    specs = [
        DerivedColumn("share", "12 / (order_id % 4)"), DerivedColumn("number", "cast(priority AS int)"),
    ]
    return scrub.derive(df, specs).select("order_id", "share", "number")


@query(
    "infer_wide_numbers", "orders_text",
    """SELECT id_txt, concat('1', lpad(id_txt, 19, '0'), '.0000000000') AS wide20,
    concat('1', lpad(id_txt, 29, '0')) AS wide30, 'decimal' AS kind20, 'string' AS kind30 FROM <orders_text>""",
)
def infer_wide_numbers(df):
    wide = df.select(
        "id_txt", F.concat(F.lit("1"), F.lpad("id_txt", 19, "0")).alias("wide20"),
        F.concat(F.lit("1"), F.lpad("id_txt", 29, "0")).alias("wide30"),
    )
    kinds = {r.column_name: r.inferred_type for r in scrub.infer_types(wide, ["id_txt"]).collect()}
    mapping = {c: k for c, k in kinds.items() if k != "string"}
    converted = scrub.convert_types(wide, mapping, infer=False)
    return converted.select(
        "id_txt", F.col("wide20").cast("string").alias("wide20"), "wide30",
        F.lit(kinds["wide20"]).alias("kind20"), F.lit(kinds["wide30"]).alias("kind30"),
    )


def _spaced(df):
    return df.select(
        "order_id", F.concat(F.lit(" "), "priority", F.lit("  ")).alias("priority"), F.lit(None).cast("string").alias("nothing")
    )


SPACED_SQL = "SELECT order_id, ' ' || priority || '  ' AS priority, CAST(NULL AS VARCHAR) AS nothing FROM <dirty_orders>"


@query("sink_default_csv", "dirty_orders", SPACED_SQL)
def sink_default_csv(df):
    path = scratch_path(df.sparkSession, "orders-default-csv")
    scrub.write_table(_spaced(df), path, "csv")
    return scrub.read_table(
        df.sparkSession, path, "csv", _spaced(df).schema, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


@query("sink_default_json", "dirty_orders", SPACED_SQL)
def sink_default_json(df):
    path = scratch_path(df.sparkSession, "orders-default-json")
    scrub.write_table(_spaced(df), path, "json")
    return scrub.read_table(df.sparkSession, path, "json")


@query(
    "null_fill_now", "dirty_events",
    "SELECT event_id, ts IS NULL AS filled, true AS is_set FROM <dirty_events>",
)
def null_fill_now(df):
    filled = scrub.fill_nulls(df.withColumn("before", F.col("ts").isNull()), dates="current_timestamp")
    return filled.select("event_id", F.col("before").alias("filled"), F.col("ts").isNotNull().alias("is_set"))


@query("rule_quarantine_off", "dirty_orders", "SELECT order_id, amount FROM <dirty_orders>")
def rule_quarantine_off(df):
    rule = Rule("amount", "amount = 'abc'", Action.QUARANTINE)
    return scrub.apply_rules(df, [rule], quarantine=False).clean.select("order_id", "amount")


# Days since 1970 of years that calendars of most clients do not reach.
FAR_YEARS = (-290308, -290307, -12345, -1, 12345, 123456, 294246, 294247, 999999, 1234567)


@query(
    "parse_far_years", "orders",
    # The calendar repeats every 400 years, which have 146097 days.
    "WITH y AS (SELECT unnest([" + ", ".join(map(str, FAR_YEARS)) + """]) AS y),
    t AS (SELECT o_orderkey, o_orderdate AS o, y, CAST(floor(y / 400.0) AS BIGINT) AS era FROM orders, y)
    SELECT o_orderkey, y, CASE WHEN y BETWEEN -290307 AND 294246 THEN
      datediff('day', DATE '1970-01-01', make_date(2000 + y - era * 400, month(o), least(day(o), 28)))
      + (era - 5) * 146097 END AS days FROM t""",
)
def parse_far_years(df):
    years = df.select("o_orderkey", "o_orderdate", F.explode(F.lit(list(FAR_YEARS))).alias("y"))
    sign = F.when(F.col("y") > 9999, "+").when(F.col("y") < 0, "-").otherwise("")
    year = F.concat(sign, F.lpad(F.abs("y").cast("string"), 4, "0"))
    year = F.when(F.abs("y") > 9999, F.concat(sign, F.abs("y").cast("string"))).otherwise(year)
    month, day = F.lpad(F.month("o_orderdate").cast("string"), 2, "0"), F.least(F.day("o_orderdate"), F.lit(28)).cast("string")
    text = F.concat_ws("-", year, month, F.lpad(day, 2, "0"))
    found = scrub.convert_types(years.withColumn("day", text), {"day": "date"}, infer=False)
    return found.select("o_orderkey", "y", F.unix_date("day").alias("days"))
