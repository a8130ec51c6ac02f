"""Views of the given Parquet tables in the shapes that the operators read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TURN_BLOCK_BITS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def sft_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as instruction records: first line, the text after it, last line."""
    text = F.col("text")
    newline = F.instr(text, F.lit("\n"))
    return documents(spark, sf_dir).select(
        "doc_id",
        F.col("lang").alias("language"),
        "source",
        F.split_part(text, F.lit("\n"), F.lit(1)).alias("instruction"),
        F.when(newline > 0, F.substr(text, newline + 1)).otherwise("").alias("input"),
        F.split_part(text, F.lit("\n"), F.lit(-1)).alias("output"),
    )


def turn_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as (user turn, next assistant turn); the turn before the user one, if it is
    a system turn, is the input."""
    turns = table(spark, sf_dir, "conversations")
    # Turns stand side by side within blocks of a conversation, so that one very long conversation is
    # spread over many tasks; the turns at either end of a block belong to the next block, too.
    at, bits = F.col("turn"), TURN_BLOCK_BITS
    places = F.array_distinct(F.array(*(F.shiftright(at + by, bits) for by in (-1, 0, 1))))
    side_by_side = Window.partitionBy("conv_id", "block").orderBy("turn")

    def beside(move, by: int, role: str) -> Column:
        near = (move("role").over(side_by_side) == role) & (move("turn").over(side_by_side) == at + by)
        return F.when(near, move("text").over(side_by_side))

    return (
        turns.withColumn("block", F.explode(places))
        .withColumns({"answer": beside(F.lead, 1, "assistant"), "system": beside(F.lag, -1, "system")})
        .filter((F.col("role") == "user") & (F.col("block") == F.shiftright(at, bits)))
        .select("conv_id", "turn", F.col("text").alias("question"), F.coalesce("system", F.lit("")).alias("system"), "answer")
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as text lines with their place in the document."""
    return documents(spark, sf_dir).select(
        "doc_id", "lang", F.posexplode(F.split("text", "\n")).alias("line_no", "text")
    )
