"""The registered queries of this folder: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import licenses, quality
from millrace.llm.arc import convert
from millrace.llm.common import held_out, table
from millrace.llm.fim import fill_in_middle, restored
from millrace.llm.grace_dedup import exact_duplicates
from millrace.llm.langid import identify, train
from millrace.llm.line_dedup import without_repeats
from millrace.llm.mixing import mix
from millrace.llm.ngram_join import ngram_groups
from millrace.llm.packing import pack
from millrace.llm.periodic import longest_run, periodic_runs
from millrace.llm.site_text import extract
from millrace.llm.topk import top_k


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_groups(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs.filter(~held_out(F.col("doc_id")))))


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = convert(table(spark, sf_dir, "pages"))
    return stored.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, quality.train(docs, labels.filter(~held_out(F.col("doc_id")))))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    text = restored(F.col("form"), F.col("output"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), plant=True).withColumn("top", longest_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_html_text": op2_html_text,
    "op3_license_scan": op3_license_scan,
    "op4_mixing": op4_mixing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_arc_to_warc": op8_arc_to_warc,
    "op9_topk": op9_topk,
    "op10_quality": op10_quality,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
