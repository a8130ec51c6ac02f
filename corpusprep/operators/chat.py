"""Message records and chat text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.hashing import seeded_hash
from corpusprep.functions.text import as_str, is_falsy, strip, text_or_empty
from corpusprep.operators.split import DEFAULT_SEED

# Separators and chat marks.
MESSAGES_SEPARATOR = "\n\n"
CHAT_SEPARATOR = " "
TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"


def _messages(user: Column, assistant: Column) -> Column:
    return F.array(
        F.struct(F.lit("user").alias("role"), user.alias("content")),
        F.struct(F.lit("assistant").alias("role"), assistant.alias("content")),
    )


def fields_as_text(df: DataFrame, fields: str = "fields") -> DataFrame:
    """Instruction, input and output of JSON records, coerced to text, plus ``id``."""
    record = F.col(fields)
    id_ = F.when(~is_falsy(record["id"]), F.try_variant_get(record["id"], "$", "string"))
    return df.select(
        *[c for c in df.columns if c not in ("instruction", "input", "output", "id")],
        *[as_str(record[c]).alias(c) for c in ("instruction", "input", "output")],
        id_.alias("id"),
    )


def sample_id(line_no: Column, *parts: Column, seed: int = DEFAULT_SEED) -> Column:
    """``sample-<line>-<8 hex>``, with the hex from a hash so that reruns agree."""
    return F.concat(F.lit("sample-"), line_no.cast("string"), F.lit("-"), F.substring(seeded_hash(seed, line_no, *parts), 1, 8))


def to_messages(df: DataFrame, line_no: Column, seed: int = DEFAULT_SEED) -> DataFrame:
    """Triples to ``{id, messages}``; records without an instruction or an output are dropped.

    A non-empty ``id`` column is kept, others get a generated one.
    """
    user_text, answer, extra = (strip(text_or_empty(F.col(c))) for c in ("instruction", "output", "input"))
    content = F.when(extra != "", F.concat(user_text, F.lit(MESSAGES_SEPARATOR), extra)).otherwise(user_text)
    given = F.col("id").cast("string") if "id" in df.columns else F.lit(None).cast("string")
    return df.filter((user_text != "") & (answer != "")).select(
        F.coalesce(F.nullif(given, F.lit("")), sample_id(line_no, content, answer, seed=seed)).alias("id"),
        _messages(content, answer).alias("messages"),
    )


def conversion_metrics() -> list[Column]:
    """How many records :func:`to_messages` keeps and drops, as aggregates."""
    keeps = (strip(text_or_empty(F.col("instruction"))) != "") & (strip(text_or_empty(F.col("output"))) != "")
    return [F.count_if(keeps).alias("kept"), F.count_if(~keeps).alias("dropped")]


def conversion_counts(df: DataFrame) -> DataFrame:
    return df.agg(*conversion_metrics())


def render(messages: Column, add_generation_prompt: bool = False) -> Column:
    """Chat text of an array of (role, content); optionally opened for the assistant's turn."""
    turns = F.transform(
        messages, lambda m: F.concat(F.lit(TURN_START), m["role"], F.lit("\n"), m["content"], F.lit(TURN_END + "\n"))
    )
    text = F.array_join(turns, "")
    return F.concat(text, F.lit(TURN_START + "assistant\n")) if add_generation_prompt else text


def training_text(df: DataFrame, drop: tuple[str, ...] = ("instruction", "input", "output", "language")) -> DataFrame:
    """Triples to chat ``text`` with one space between instruction and input; triple columns go."""
    input_ = text_or_empty(F.col("input")) if "input" in df.columns else F.lit("")
    user = strip(F.concat(F.col("instruction"), F.lit(CHAT_SEPARATOR), input_))
    return df.withColumn("text", render(_messages(user, F.col("output")))).drop(*drop)


def prompt_chat(prompt: Column) -> Column:
    """A single user prompt as chat text that waits for the assistant."""
    return render(F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content"))), add_generation_prompt=True)
