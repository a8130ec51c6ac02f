"""Token stage with two back ends: native Spark expressions, or a real tokenizer over Arrow."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Tokenizer(Protocol):
    """``count``, ``encode`` and ``decode`` as column expressions; a null text gives null."""

    def count(self, text: Column) -> Column: ...

    def encode(self, text: Column) -> Column: ...

    def decode(self, tokens: Column) -> Column: ...


class NativeTokenizer:
    """Pieces cut by a regular expression; stays inside the JVM.

    The default piece is up to three non-space characters with the spaces before them, so that
    joining pieces gives back the text they came from.
    """

    SPACES = " \\t\\n\\r\\f\\x0B"
    PATTERN = f"[{SPACES}]*[^{SPACES}]{{1,3}}"

    name = "pieces by pattern"

    def __init__(self, pattern: str = PATTERN):
        self.pattern = pattern

    def count(self, text: Column) -> Column:
        if self.pattern != self.PATTERN:
            return F.regexp_count(text, F.lit(self.pattern))
        # A word of any length is as many pieces as it has threes of characters, begun ones included.
        pieces = F.aggregate(F.split(text, f"[{self.SPACES}]+"), F.lit(0), lambda n, word: n + F.floor((F.length(word) + 2) / 3).cast("int"))
        return pieces

    def encode(self, text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(self.pattern), F.lit(0))

    def decode(self, tokens: Column) -> Column:
        return F.array_join(tokens, "")


_LOADED: dict[str, Any] = {}


def _loaded(name: str, loader: Callable[[], Any]) -> Any:
    """One tokenizer per Python worker, built the first time that worker needs it."""
    if name not in _LOADED:
        _LOADED[name] = loader()
    return _LOADED[name]


def _ids(encoding: Any) -> list[int]:
    return list(getattr(encoding, "ids", encoding))


class ArrowTokenizer:
    """A real tokenizer, given as a loader that workers call.

    The loaded object needs ``encode_batch(list[str])``, which returns id lists or objects with
    ``ids``, and ``decode(list[int])``. Null texts are never sent to it, so a caller that nulls the
    rows it can settle without tokens pays only for the rest. The functions are marked
    nondeterministic: a filter on their result would otherwise make Spark plan them twice.
    """

    def __init__(self, loader: Callable[[], Any], batch_size: int = 2048):
        self.loader = loader
        self.batch_size = batch_size
        self.name = uuid.uuid4().hex

    def _batches(self, texts: pd.Series) -> Iterator[tuple[Any, list[list[int]]]]:
        texts = texts.dropna()
        for start in range(0, len(texts), self.batch_size):
            part = texts.iloc[start : start + self.batch_size]
            encoded = _loaded(self.name, self.loader).encode_batch(part.tolist())
            yield part.index, [_ids(e) for e in encoded]

    def count(self, text: Column) -> Column:
        @F.pandas_udf("int")
        def count_tokens(texts: pd.Series) -> pd.Series:
            out = pd.Series(pd.NA, index=texts.index, dtype="Int32")
            for index, ids in self._batches(texts):
                out.loc[index] = [len(i) for i in ids]
            return out

        return count_tokens.asNondeterministic()(text)

    def encode(self, text: Column) -> Column:
        @F.pandas_udf("array<int>")
        def encode_tokens(texts: pd.Series) -> pd.Series:
            out = {}
            for index, ids in self._batches(texts):
                out.update(zip(index, ids))
            return pd.Series([out.get(i) for i in texts.index], index=texts.index, dtype="object")

        return encode_tokens.asNondeterministic()(text)

    def decode(self, tokens: Column) -> Column:
        @F.pandas_udf("string")
        def decode_tokens(lists: pd.Series) -> pd.Series:
            given = lists[lists.notna()]
            out = pd.Series(None, index=lists.index, dtype="object")
            if len(given):
                tokenizer = _loaded(self.name, self.loader)
                ids = [list(map(int, x)) for x in given]
                # Many at once where the tokenizer can.
                many = getattr(tokenizer, "decode_batch", None)
                out.loc[given.index] = many(ids) if many else [tokenizer.decode(x) for x in ids]
            return out

        return decode_tokens.asNondeterministic()(tokens)
