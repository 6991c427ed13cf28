"""The operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonearm.llm import host_rules, mixing, near_text, near_vectors, packing, periodic, quality_model, ranked_search, repeated_bytes, repeats, sql, surrogates, token_store, warc
from tonearm.llm.files import read_table
from tonearm.llm.registry import ORACLES, QUERIES, query
from tonearm.session import working_folder

TOKENIZER = "word_bpe_49k.json"
VOCABULARY = 49_408
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
SMOOTHING = 0.7
#: Stands for the secret that a deployment sets.
SURROGATE_KEY = b"set this per corpus"


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids in packed files, read back: place, length and checksum of every document."""
    docs = read_table(spark, sf_dir, "documents")
    manifest = token_store.write_token_files(
        docs, public_tokenizers.path(TOKENIZER), 1, VOCABULARY, token_store.token_folder(docs)
    )
    return token_store.token_digests(manifest)


@query("op2_web_archives")
def op2_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to web archives and read back; repeated payloads become revisits."""
    pages = read_table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages, working_folder(spark, "web-archives"))
    return warc.read_archives(manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op3_repeated_passages")
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that documents before it have, and the spans removed."""
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


@query("op4_packed_sequences")
def op4_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens: place of every piece."""
    docs = read_table(spark, sf_dir, "documents")
    packed = packing.pack_documents(docs, public_tokenizers.path(TOKENIZER), 0, VOCABULARY, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op5_mixed_sources", sql.mixing(LANGUAGES, SMOOTHING, mixing.SWEEPS))
def op5_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability, draw and copies of every document after raking to sources, languages and topics."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    names = (F.col(f"margin_{name}").alias(name) for name in ("source", "lang", "topic"))
    return mixing.mix(docs, LANGUAGES, SMOOTHING).select("doc.doc_id", *names, "probability", "taken", "copies")


@query("op6_surrogates")
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for its personal data and secrets, and where they were."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = surrogates.with_surrogates(docs, SURROGATE_KEY)
    return made.select("doc.doc_id", "doc.text", F.size("replaced").cast("long").alias("n_replaced"), "replaced")


@query("op7_quality_scores")
def op7_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a model that the labels outside the held-out fold have taught."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality_model.score_documents(docs, model)
    return scored.select(
        "doc_id",
        quality_model.in_fold().alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        "n_passages",
    )


@query("op8_near_texts", sql.NEAR_TEXTS)
def op8_near_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of its links at 85 percent of three-word shingles."""
    docs = read_table(spark, sf_dir, "documents")
    found = near_text.near_duplicates(docs, near_text.Near(width=3, percent=85, bands=32, band_rows=6))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_host_rules", sql.HOST_RULES)
def op9_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document by its own rules and by its host's."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    judged = host_rules.judge(docs, keep="doc_id")
    return judged.select("doc.doc_id", *host_rules.COUNTS, "base_failed", "kept")


@query("op10_near_vectors", sql.NEAR_VECTORS)
def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of links and the component of its links within its label."""
    return near_vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


@query("op11_ranked_search", sql.RANKED_SEARCH)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_search.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op12_repeated_bytes", sql.REPEATED_BYTES)
def op12_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a repeated string of 400 bytes covers: counts and a digest of the rest."""
    cleaned = repeated_bytes.remove_repeated(read_table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents repeat a stretch of their words from some word on to the end.

    Which documents, from where and with which period follow from a checksum of doc_id; a null doc_id changes nothing.
    """
    mark = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", mark.alias("mark"), F.when(mark % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("g", F.floor(F.col("mark") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    a, p, n = (F.col(c).cast("int") for c in ("a", "p", "n"))
    again = F.flatten(F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), a), F.slice(again, F.lit(1), n - a))
    text = F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


@query("op13_periodic_runs", sql.PERIODIC_RUNS)
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated words of every document, and digests of its runs and of its words without the repeats."""
    found = periodic.periodic_runs(with_planted_periods(read_table(spark, sf_dir, "documents")))
    # greatest length first, then smallest start, then smallest period
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    )
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines.alias("lines"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def all_queries() -> dict:
    return dict(QUERIES)


def all_oracles() -> dict:
    return dict(ORACLES)
