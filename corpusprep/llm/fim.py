"""Fill-in-the-middle: texts cut at two unit boundaries and put together in another order.

The places where the units of a text end make a compressed set: the numbers with the same upper 16 bits
share a container, which is a sorted array, a bitmap or a list of runs, whichever is smallest, and
cumulative cardinalities lead from a rank to its container. A cut after so many units is one search among the
containers and one selection inside; both cuts of a text come from the same set.

Only the search for the cuts is Python's, as an Arrow function of the text; rows stay where they are, and the
output and the text rebuilt from it are DataFrame expressions. Nothing is shuffled.

Defined results: a null text is empty, and an empty text stays as it is, in the form ``plain``; so does a
text that contains a marker, which no reader could tell from ours. Draws depend on id and seed alone, so
that repeated rows are transformed alike; a null id draws like the empty string. Other columns stay
with their rows: the new ones are in one struct, whose name is a parameter.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("<P>", "<S>", "<M>")

# --- the boundary set --------------------------------------------------------------------------

SPAN = 1 << 16  # values of a container
#: Number of ones in each value of 16 bits, for selection in a bitmap.
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_ONES = (_ONES[:, None] + _ONES[None, :]).ravel()


class ArrayContainer:
    """The values themselves, two bytes each."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return 2 * len(low)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.low[ranks]


class BitmapContainer:
    """One bit for each possible value, in words of 16 bits with the ones up to each."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[low] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u2")
        self.up_to = np.cumsum(_ONES[self.words], dtype=np.uint32)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return SPAN // 8

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.up_to, ranks, side="right")
        inside = ranks - (self.up_to[word] - _ONES[self.words[word]])
        ones = (self.words[word][:, None] >> np.arange(16)) & 1
        bit = np.argmax(np.cumsum(ones, axis=1) == (inside + 1)[:, None], axis=1)
        return word * 16 + bit


class RunContainer:
    """Runs of consecutive values: the first of each, and how many values come before the run."""

    def __init__(self, low: np.ndarray):
        begins = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.first, self.before = low[begins].astype(np.uint16), begins.astype(np.uint32)

    @staticmethod
    def size(low: np.ndarray) -> int:
        return 4 * int((np.diff(low, prepend=low[0] - 2) != 1).sum())

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, ranks, side="right") - 1
        return self.first[run].astype(np.int64) + (ranks - self.before[run])


class BoundarySet:
    """A set of numbers from 0 on, from their sorted array; ``select`` gives the number of a rank."""

    def __init__(self, values: np.ndarray):
        values = np.asarray(values, np.int64)
        begins = np.flatnonzero(np.diff(values >> 16, prepend=-1)) if len(values) else np.empty(0, np.int64)
        ends = np.append(begins[1:], len(values))[: len(begins)]
        self.high = values[begins] >> 16
        self.up_to = ends  # cumulative cardinalities
        self.containers = [self._smallest(values[a:b] & (SPAN - 1)) for a, b in zip(begins, ends)]

    @staticmethod
    def _smallest(low: np.ndarray):
        return min((ArrayContainer, RunContainer, BitmapContainer), key=lambda kind: kind.size(low))(low)

    def __len__(self) -> int:
        return int(self.up_to[-1]) if len(self.up_to) else 0

    def select(self, ranks: Sequence[int]) -> np.ndarray:
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) and not (0 <= ranks.min() and ranks.max() < len(self)):
            raise IndexError("no number of that rank")
        found = np.empty(len(ranks), np.int64)
        at = np.searchsorted(self.up_to, ranks, side="right")
        for which in np.unique(at):
            own = at == which
            before = self.up_to[which - 1] if which else 0
            found[own] = (self.high[which] << 16) + self.containers[which].select(ranks[own] - before)
        return found


# --- units -------------------------------------------------------------------------------------


def line_ends(text: str) -> np.ndarray:
    """The places after each line; a last line without a line feed ends with the text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.flatnonzero(points == 10) + 1
    return ends if not text or text[-1] == "\n" else np.append(ends, len(points))


def character_ends(text: str) -> np.ndarray:
    return np.arange(1, len(text) + 1)


UNITS = {"line": line_ends, "character": character_ends}


def _cuts(unit: str):
    """(number of units, characters up to the first cut, characters up to the second) of (text, draw, draw)."""
    ends_of = UNITS[unit]

    @F.arrow_udf("struct<n: long, first: long, second: long>")
    def cuts(texts, one, other):
        import pyarrow as pa

        rows = []
        for text, a, b in zip(texts, one.to_pylist(), other.to_pylist()):
            ends = BoundarySet(ends_of(text.as_py()))
            n = len(ends)
            # Rank 0 is the place before the first unit.
            ranks = sorted((a % (n + 1), b % (n + 1)))
            found = iter(ends.select([r - 1 for r in ranks if r]).tolist())
            rows.append((n, *(next(found) if r else 0 for r in ranks)))
        n, first, second = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (n, first, second)], names=["n", "first", "second"])

    return cuts


# --- the transformation ------------------------------------------------------------------------


def _checked(markers: Sequence[str]) -> None:
    """The first marker found in an output must be ours: no marker may begin where another one ends."""
    for a in markers:
        for b in markers:
            inside = a in b and a != b
            overlap = any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) if a == b else min(len(a), len(b)) + 1))
            if not a or inside or overlap:
                raise ValueError(f"the markers {a!r} and {b!r} may be mistaken for each other")
    if len(set(markers)) != len(markers):
        raise ValueError("the markers must differ")


def transform(
    docs: DataFrame,
    seed: int = 7,
    percent: int = 100,
    spm_percent: int = 50,
    unit: str = "line",
    markers: tuple[str, str, str] = MARKERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    name: str = "fim",
) -> DataFrame:
    """``docs`` with a struct (n, form, prefix_chars, middle_chars, output).

    ``percent`` of the texts are transformed, ``spm_percent`` of those with the suffix in front (``spm``),
    the others with the prefix in front (``psm``); ``n`` is the number of units.
    """
    _checked(markers)
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    prefix_mark, suffix_mark, middle_mark = map(F.lit, markers)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    draw = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cut = _cuts(unit)(text, draw[0], draw[1])
    marked = F.lit(False)
    for marker in markers:
        marked = marked | F.contains(text, F.lit(marker))
    plain = (text == "") | marked | (draw[2] % 100 >= percent)
    form = F.when(plain, "plain").when(draw[3] % 100 < spm_percent, "spm").otherwise("psm")
    # The struct is made step by step, each from the columns before: long expressions are computed once.
    step = docs.withColumn(name, F.struct(cut.alias("cut"), form.alias("form")))
    own = F.col(name)
    first, second = own["cut"]["first"], own["cut"]["second"]
    prefix, middle = F.substring(text, F.lit(1), first.cast("int")), F.substring(text, (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring(text, (second + 1).cast("int"), F.char_length(text))
    output = (
        F.when(own["form"] == "plain", text)
        .when(own["form"] == "psm", F.concat(prefix_mark, prefix, suffix_mark, suffix, middle_mark, middle))
        .otherwise(F.concat(suffix_mark, suffix, prefix_mark, prefix, middle_mark, middle))
    )
    transformed = own["form"] != "plain"
    return step.withColumn(
        name,
        F.struct(
            own["cut"]["n"].alias("n"),
            own["form"].alias("form"),
            F.when(transformed, first).alias("prefix_chars"),
            F.when(transformed, second - first).alias("middle_chars"),
            output.alias("output"),
        ),
    )


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text of which ``output`` was made."""
    prefix_mark, suffix_mark, middle_mark = markers

    def before(part: Column, marker: str) -> Column:
        return F.substring_index(part, marker, 1)

    def after(part: Column, marker: str) -> Column:
        return F.substring(part, F.instr(part, F.lit(marker)) + len(marker), F.char_length(part))

    psm = F.concat(
        before(after(output, prefix_mark), suffix_mark), after(output, middle_mark), before(after(output, suffix_mark), middle_mark)
    )
    spm = F.concat(before(after(output, prefix_mark), middle_mark), after(output, middle_mark), before(after(output, suffix_mark), prefix_mark))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
