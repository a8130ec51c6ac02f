"""Source adapters: each turns one shape of input into canonical records."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.text import strip, text_or_empty

# Fixed values.
MIN_DOCUMENT_CHARS = 100
CANONICAL = ("instruction", "input", "output", "language")


def _canonical(df: DataFrame, instruction, input_, output, language: str, keep: Sequence[str]) -> DataFrame:
    return df.select(
        *keep,
        instruction.alias("instruction"),
        input_.alias("input"),
        output.alias("output"),
        F.lit(language).alias("language"),
    )


def from_triples(df: DataFrame, language: str, keep: Sequence[str] = ()) -> DataFrame:
    """instruction, input (missing or null becomes empty), output."""
    input_ = text_or_empty(F.col("input")) if "input" in df.columns else F.lit("")
    return _canonical(df, F.col("instruction"), input_, F.col("output"), language, keep)


def from_turns(df: DataFrame, turns: str, field: str, language: str, keep: Sequence[str] = ()) -> DataFrame:
    """First two items of an array of turns, whatever their roles; later turns are ignored.

    A conversation of one turn gets a null output, which validation counts as empty.
    """
    first, second = F.get(F.col(turns), F.lit(0)), F.get(F.col(turns), F.lit(1))
    return _canonical(df, first[field], F.lit(""), second[field], language, keep)


def from_turn_rows(df: DataFrame, conversation: str, turn: str, text: str, language: str) -> DataFrame:
    """As :func:`from_turns` for a table with one row per turn, numbered from 0.

    Only turns 0 and 1 are read and combined, so a conversation of any length leaves each task as
    one small row.
    """
    at = {i: F.max(F.when(F.col(turn) == i, F.col(text))) for i in (0, 1)}
    pairs = df.filter(F.col(turn).isin(0, 1)).groupBy(conversation).agg(at[0].alias("_first"), at[1].alias("_second"))
    return _canonical(pairs, F.col("_first"), F.lit(""), F.col("_second"), language, [conversation])


def from_qa(df: DataFrame, language: str, keep: Sequence[str] = ()) -> DataFrame:
    return _canonical(df, F.col("question"), F.lit(""), F.col("answer"), language, keep)


def from_documents(df: DataFrame, text: str = "text", min_chars: int = MIN_DOCUMENT_CHARS) -> DataFrame:
    """Stripped documents of more than ``min_chars`` characters."""
    return df.withColumn(text, strip(F.col(text))).filter(F.length(text) > min_chars)


@dataclass(frozen=True)
class Source:
    """A named loader; ``corpus`` sources hold plain documents, unfiltered, and are not instruction records."""

    name: str
    load: Callable[[], DataFrame]
    corpus: bool = False


def load_all(
    sources: Sequence[Source], skip_corpus: bool = False, stage: Callable[[str, DataFrame], DataFrame] | None = None
) -> tuple[DataFrame | None, dict[str, str]]:
    """Union of all instruction and corpus sources, with a ``source`` column, and what failed.

    A source that fails is left out whole and reported by name; the rest goes on. Without ``stage``
    only failures of opening and analysing are noticed. ``stage`` is called with a source's name and
    rows, writes them somewhere and returns what it wrote, so that files that cannot be read show, too.
    Differing columns are kept and filled with null.
    """
    loaded: list[DataFrame] = []
    failures: dict[str, str] = {}
    for source in sources:
        if source.corpus and skip_corpus:
            continue
        try:
            df = source.load()
            df.schema  # analysis errors surface here, not in the job that reads the union
            df = df if stage is None else stage(source.name, df)
        except Exception as error:  # any failure of one source must not stop the others
            failures[source.name] = str(error)
            continue
        loaded.append(df.withColumn("source", F.lit(source.name)).withColumn("is_corpus", F.lit(source.corpus)))
    if not loaded:
        return None, failures
    union = loaded[0]
    for df in loaded[1:]:
        union = union.unionByName(df, allowMissingColumns=True)
    return union, failures


def source_counts(loaded: DataFrame) -> DataFrame:
    """Rows per source; documents count as read, before their length is judged."""
    return loaded.groupBy("source", "is_corpus").agg(F.count(F.lit(1)).alias("n_rows"))


def source_totals(loaded: DataFrame) -> DataFrame:
    """One row: instruction records in total, and corpus documents."""
    return loaded.agg(
        F.count_if(~F.col("is_corpus")).alias("sft_total"), F.count_if("is_corpus").alias("corpus_docs")
    )
