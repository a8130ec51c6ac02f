"""Column helpers for text: trimming, coercion of JSON values, script tests."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that Python's str.strip() removes.
WHITESPACE_CODES = (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
    *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE = "".join(map(chr, WHITESPACE_CODES))
# The same set as the inside of a regular-expression class.
WHITESPACE_CLASS = "".join(f"\\x{{{c:X}}}" for c in WHITESPACE_CODES)

# The Devanagari block and the run that counts as an English word.
DEVANAGARI_CLASS = "\\x{900}-\\x{97F}"
LATIN_WORD = "[a-zA-Z]{3,}"
PREVIEW_CHARS = 300


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def strip_long(c: Column) -> Column:
    """As :func:`strip`, for a plain column of long texts.

    Trimming on the right walks the whole text; looking at its end does not, and most texts end
    without white space. The column is named many times, so it must not be a costly expression.
    """
    ends_blank = reduce(or_, [c.endswith(w) for w in WHITESPACE])
    return F.when(ends_blank, strip(c)).otherwise(F.ltrim(c, F.lit(WHITESPACE)))


def n_chars(c: Column) -> Column:
    """Length in code points, as BIGINT."""
    return F.length(c).cast("bigint")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


# --- JSON values (VARIANT) -----------------------------------------------------------------


def json_kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return F.coalesce(json_kind(v) == "STRING", F.lit(False))


def is_falsy(v: Column) -> Column:
    """Missing, null, empty string, zero, false, empty list and empty object."""
    kind = json_kind(v)
    return (
        F.when(kind.isNull() | (kind == "VOID"), True)
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") == "")
        .when(kind == "BOOLEAN", ~F.try_variant_get(v, "$", "boolean"))
        .when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), F.to_json(v).isin("[]", "{}"))
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") == 0, F.lit(False)))
    )


def or_empty(v: Column) -> Column:
    """Falsy becomes ''; a string stays; anything else is null, which callers read as malformed."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string")).when(is_falsy(v), "")


def or_empty_any(v: Column) -> Column:
    """As :func:`or_empty`, but other values become their JSON text."""
    return F.coalesce(or_empty(v), F.to_json(v))


def as_str(v: Column) -> Column:
    """String: stripped. List that starts with a string: its strings, stripped, joined by a space."""
    items = F.try_variant_get(v, "$", "array<variant>")
    strings = F.transform(F.filter(items, is_string), lambda x: strip(F.try_variant_get(x, "$", "string")))
    return (
        F.when(is_string(v), strip(F.try_variant_get(v, "$", "string")))
        .when(
            F.coalesce(json_kind(v).startswith("ARRAY") & is_string(F.get(items, F.lit(0))), F.lit(False)),
            strip(F.array_join(strings, " ")),
        )
        .otherwise("")
    )


# --- scripts -------------------------------------------------------------------------------


def has_script(c: Column, char_class: str = DEVANAGARI_CLASS) -> Column:
    return F.coalesce(c.rlike(f"[{char_class}]"), F.lit(False))


def has_ascii_word(c: Column) -> Column:
    """True if some whitespace-separated word is pure ASCII; digits and punctuation count."""
    ascii_word = "[\\x00-\\x08\\x0E-\\x1B!-\\x7F]+"
    edge = f"[{WHITESPACE_CLASS}]"
    return F.coalesce(c.rlike(f"(?:^|{edge}){ascii_word}(?:{edge}|\\z)"), F.lit(False))


def is_code_mixed(c: Column, char_class: str = DEVANAGARI_CLASS) -> Column:
    return has_script(c, char_class) & has_ascii_word(c)


def has_latin_word(c: Column) -> Column:
    return F.coalesce(c.rlike(LATIN_WORD), F.lit(False))


def preview(c: Column, limit: int = PREVIEW_CHARS) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)
