"""Queries that write a table to files and read it back: order, nulls, numbers, several files, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import report, scoring, split, validate
from corpusprep.operators.chat import to_messages
from corpusprep.plans import catalog
from corpusprep.plans.views import document_lines, sft_view
from corpusprep.session import materialize, prepare, scratch_path
from corpusprep.sources import ingest, sinks

WALL_TIME = 12.25
# Several files, however small the table.
FILES = 4


def jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with nulls and numbers as JSONL, through the strict reader; each with its place among all lines."""
    prepare(spark)
    folder = scratch_path(spark, "jsonl")
    rows = sft_view(spark, sf_dir).select(
        "doc_id", "instruction", F.nullif("input", F.lit("")).alias("input"), "output", "language", (F.col("doc_id") * 1.5).alias("weight")
    )
    sinks.jsonl(sinks.in_order(rows, "doc_id", least=FILES), folder)
    read = ingest.with_line_number(ingest.jsonl(spark, folder, strict=True), ingest.line_starts(spark, folder, per_file=False), "position")

    def value(name: str, kind: str) -> Column:
        return F.try_variant_get(F.col("fields")[name], "$", kind).alias(name)

    texts = [value(c, "string") for c in ("instruction", "input", "output", "language")]
    explicit = F.map_contains_key("fields", F.lit("input")).alias("has_input")
    return read.select(value("doc_id", "bigint"), "position", *texts, value("weight", "double"), explicit)


def text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines in two folders, read as one; each with its place among all lines."""
    folders = [scratch_path(spark, f"text-{part}") for part in ("1", "2")]
    lines = document_lines(spark, sf_dir).withColumn("text", F.translate("text", "\r", " ")).filter(tx.strip(F.col("text")) != "")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for folder, chosen in zip(folders, (english, ~english)):
        sinks.text(sinks.in_order(lines.filter(chosen), "doc_id", "line_no", least=FILES), folder)
    return ingest.with_line_number(ingest.lines(spark, folders), ingest.line_starts(spark, folders, per_file=False), "position").select("position", "text")


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three splits as JSONL, one folder each."""
    folder = scratch_path(spark, "splits")
    sinks.splits(split.exact(catalog.valid_ids(spark, sf_dir), ["doc_id"]).select("doc_id", "language", "split"), folder)
    return spark.read.schema("doc_id bigint, language string, split string").json(folder)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message records as JSONL."""
    folder = scratch_path(spark, "messages")
    converted = to_messages(sft_view(spark, sf_dir), F.col("doc_id"))
    sinks.jsonl(converted, folder)
    return catalog.message_columns(spark.read.schema(converted.schema).json(folder))


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The validation report as a JSON object; the time is rounded half to even."""
    folder = scratch_path(spark, "report")
    judged = materialize(catalog.classified(spark, sf_dir).select("doc_id", "language", "status", "n_tokens"), "classified")
    parts = split.exact(validate.valid_records(judged), ["doc_id"])
    built = report.build(judged, parts, validate.lcpt_lines(document_lines(spark, sf_dir)), wall_time_seconds=WALL_TIME)
    sinks.jsonl(built, folder)
    read = spark.read.schema(built.schema).json(folder)
    return catalog.report_columns(read, "wall_time_seconds")


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The evaluation results by category."""
    folder = scratch_path(spark, "results")
    found = scoring.results(catalog.scored(spark, sf_dir))
    sinks.by_category(found, folder)
    return spark.read.schema(found.schema).json(folder).select(found.columns)


QUERIES: dict[str, catalog.Query] = {
    "q_roundtrip_jsonl": jsonl,
    "q_roundtrip_text": text,
    "q_roundtrip_splits": splits,
    "q_roundtrip_messages": messages,
    "q_roundtrip_report": reports,
    "q_roundtrip_results": results,
}
