"""The queries of the numbered operators, each over its whole table, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    contamination, language, lines, neardup, packing, periods, pieces, quality, sharding, spelling, substrings, suffixes, tokenfiles,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle.strip()
        return build

    return register


def read(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_bpe() -> str:
    """The vocabulary file of the public tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_bpe() -> str:
    """The model of the public tokenizer of pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op4_sharding")
def op4_sharding(spark, sf_dir):
    return sharding.shard_documents(read(spark, sf_dir), 40)


@query("op7_quality_rules", quality.ORACLE)
def op7_quality_rules(spark, sf_dir):
    return quality.judge(read(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op1_substring_dedup")
def op1_substring_dedup(spark, sf_dir):
    found = substrings.remove_repeats(read(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark, sf_dir):
    found = suffixes.remove_repeated_bytes(read(spark, sf_dir))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op5_token_files")
def op5_token_files(spark, sf_dir):
    index = tokenfiles.write_tokens(read(spark, sf_dir), tokenfiles.token_folder(spark), word_bpe())
    return tokenfiles.read_tokens(index)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir), word_bpe())


@query("op9_decontamination", contamination.ORACLE)
def op9_decontamination(spark, sf_dir):
    return contamination.find_contained(read(spark, sf_dir), read(spark, sf_dir, "benchmark"))


@query("op2_near_duplicates")
def op2_near_duplicates(spark, sf_dir):
    return neardup.classes(read(spark, sf_dir))


@query("op10_line_dedup")
def op10_line_dedup(spark, sf_dir):
    found = lines.remove_lines(read(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_language_id")
def op3_language_id(spark, sf_dir):
    docs = read(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


@query("op11_piece_encoding")
def op11_piece_encoding(spark, sf_dir):
    found = pieces.encode(read(spark, sf_dir), piece_bpe(), decoded=True)
    spanned = F.aggregate(F.zip_with("begins", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda n, x: n + x)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), pieces.digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), "n_bytes", spanned.alias("n_spanned"),
    )


@query("op12_spelling_variants")
def op12_spelling_variants(spark, sf_dir):
    # A word that lost a letter may be shorter than its run by one.
    found = spelling.runs(read(spark, sf_dir), at_least=spelling.MIN_LENGTH)
    return spelling.variants(spelling.vocabulary(spelling.with_typos(found, 199)))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text), in which the texts of a tenth of the ids repeat a passage up to their end.

    With h = crc32 of the id in decimal, g = h / 10 without rest: where h ends in 0, word i from a = g % n on becomes word
    a + (i - a) % p, with p = 1 + (n - a) / (3 + g % 8) without rest. Other texts, and those of a NULL id, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    chosen = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    placed = chosen.withColumn("a", F.when(n > 0, F.col("g") % n).cast("int"))
    repeated = placed.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int"))
    rest = n - F.col("a")
    passage = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), F.ceil(rest / F.col("p")).cast("int")))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(passage, F.lit(1), rest)), " ")
    return repeated.select("doc_id", F.when(F.col("p").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    found = periods.find_runs(with_planted_runs(read(spark, sf_dir)))
    best = periods.strongest(F.col("runs")).alias("best")
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines_ = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.select("doc_id", "n_words", "runs", "collapsed", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines_, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )
