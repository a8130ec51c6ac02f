"""Seeded, engine-independent hash expressions that stand in for random draws."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SHORT_KEY_HEX = 16


def seeded_hash(seed: int, *cols: Column) -> Column:
    """Hex SHA-256 of ``seed:col[:col...]``. Sorting by it is a random order fixed by the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.concat_ws(":", *[c.cast("string") for c in cols]))
    return F.sha2(text, 256)


def hash_index(hex_hash: Column, size: Column) -> Column:
    """A number in ``0..size-1`` from the first 60 bits of a hex hash."""
    return F.pmod(F.conv(F.substring(hex_hash, 1, 15), 16, 10).cast("bigint"), size.cast("bigint"))


def hash_choice(hex_hash: Column, options: Sequence[str]) -> Column:
    """Pick one of a fixed list of strings by hash."""
    return F.get(F.array(*[F.lit(o) for o in options]), hash_index(hex_hash, F.lit(len(options))).cast("int"))


def pair_digest(left: Column, right: Column) -> Column:
    """Hex SHA-256 of ``left NUL right``; null counts as empty. No case or space folding."""
    empty = F.lit("")
    return F.sha2(F.concat(F.coalesce(left, empty), F.char(F.lit(0)), F.coalesce(right, empty)), 256)


def short_key(digest: Column) -> Column:
    """The 64-bit form of a digest used to name a record."""
    return F.substring(digest, 1, SHORT_KEY_HEX)
