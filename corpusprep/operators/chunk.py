"""Token windows and truncation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.tokenizers import NativeTokenizer, Tokenizer

# Fixed values.
MAX_TOKENS = 1024
MIN_CHUNK_TOKENS = 64


def window_arrays(tokens: Column, max_len: int = MAX_TOKENS, min_len: int = MIN_CHUNK_TOKENS) -> Column:
    """Cut a token array into windows of ``max_len``; a last window under ``min_len`` is dropped."""
    starts = F.sequence(F.lit(1), F.size(tokens), F.lit(max_len))
    kept = F.filter(starts, lambda s: F.size(tokens) - s + 1 >= min_len)
    cut = F.transform(kept, lambda s: F.slice(tokens, s, F.lit(max_len)))
    # sequence() would count down from 1 to 0 for an empty array.
    return F.when(F.size(tokens) >= min_len, cut)


def windows(
    df: DataFrame,
    text: str = "text",
    tokenizer: Tokenizer | None = None,
    max_len: int = MAX_TOKENS,
    min_len: int = MIN_CHUNK_TOKENS,
) -> DataFrame:
    """One row per token window: ``chunk_no``, ``n_tokens`` and the decoded ``text``."""
    tokenizer = tokenizer or NativeTokenizer()
    keep = [c for c in df.columns if c != text]
    return (
        df.select(*keep, tokenizer.encode(F.col(text)).alias("_tokens"))
        .select(*keep, F.posexplode(window_arrays(F.col("_tokens"), max_len, min_len)).alias("chunk_no", "_window"))
        .select(
            *keep,
            F.col("chunk_no").cast("bigint").alias("chunk_no"),
            F.size("_window").cast("bigint").alias("n_tokens"),
            tokenizer.decode(F.col("_window")).alias(text),
        )
    )


def truncate(df: DataFrame, text: str = "text", tokenizer: Tokenizer | None = None, max_len: int = MAX_TOKENS) -> DataFrame:
    """Replace the text by its first ``max_len`` tokens in a column ``tokens``; no padding."""
    tokenizer = tokenizer or NativeTokenizer()
    return df.withColumn("tokens", F.slice(tokenizer.encode(F.col(text)), 1, max_len)).drop(text)
