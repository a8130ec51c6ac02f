"""Scoring of a table of model responses by the script they are written in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import exp
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.hashing import seeded_hash
from corpusprep.functions.text import DEVANAGARI_CLASS, WHITESPACE_CLASS, has_latin_word, has_script, is_code_mixed
from corpusprep.operators.sample import first_k_per_group
from corpusprep.operators.split import DEFAULT_SEED
from corpusprep.session import materialize

# Prompt categories.
HINDI = "hindi"
HINGLISH = "hinglish"
ENGLISH = "english_retention"
DEFAULT_NUM_TESTS = 3
# Rows of the evaluation job, gain that continued training must bring, loss that is accepted.
EVALUATION_ROWS = 20
LEAST_GAIN = 0.05
MOST_LOSS = 0.02
REPLICATES = 200
# Rows whose n-grams are numbered together.
GRAM_ROWS = 512


def script_flag(category: Column, response: Column, char_class: str = DEVANAGARI_CLASS) -> Column:
    """Hindi needs the script, Hinglish the script and an ASCII word, English a run of letters."""
    return (
        F.when(category == HINDI, has_script(response, char_class))
        .when(category == HINGLISH, is_code_mixed(response, char_class))
        .when(category == ENGLISH, has_latin_word(response))
    )


def attach(
    prompts: DataFrame,
    responses: DataFrame,
    num_tests: int | None = None,
    on: Sequence[str] = ("category", "prompt"),
) -> DataFrame:
    """Give each prompt its response; of each category only the first ``num_tests`` by ``pos``.

    ``responses`` holds at most one row per ``on``, so the join never multiplies rows. Which side to
    broadcast, if any, is left to the optimizer, which sees the real sizes at run time.
    """
    wanted = prompts if num_tests is None else first_k_per_group(prompts, num_tests, ["category"], ["pos"])
    return wanted.join(responses.select(*on, "response"), list(on), "left")


def score(attached: DataFrame, char_class: str = DEVANAGARI_CLASS) -> DataFrame:
    """Add the ``flag`` of each response."""
    response = F.coalesce("response", F.lit(""))
    return attached.withColumn("flag", script_flag(F.col("category"), response, char_class))


def results(scored: DataFrame) -> DataFrame:
    """The rows of the result file: one per prompt, to be written by category."""
    return scored.select("category", "pos", "prompt", "response", "flag")


def pass_rates(scored: DataFrame, num_tests: int = DEFAULT_NUM_TESTS) -> DataFrame:
    """Passed responses per category over the *requested* number of tests, and the rows there were."""
    return (
        scored.groupBy("category")
        .agg(F.count_if("flag").alias("passed"), F.count(F.lit(1)).alias("n_rows"))
        .withColumn("num_tests", F.lit(num_tests).cast("bigint"))
        .withColumn("pass_rate", F.round(F.col("passed") / F.col("num_tests"), 6))
    )


def words(text: Column) -> Column:
    """Lower-cased words of a text, as an array; punctuation stays with its word."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), f"[{WHITESPACE_CLASS}]+"), lambda w: w != "")


def short_answer(df: DataFrame, prediction: str, gold: str, order: Sequence[str], limit: int | None = EVALUATION_ROWS) -> DataFrame:
    """Whether each prediction equals its gold answer, and whether it contains it, word by word.

    Our own definition: case and white space do not count; an empty gold answer is contained in
    nothing but an empty prediction. ``limit`` takes the first rows in the given order; null takes all.
    """
    rows = df if limit is None else df.orderBy(*order).limit(limit)
    # A space at either end, so that only whole words match.
    said, wanted = (F.concat(F.lit(" "), F.array_join(words(F.col(c)), " "), F.lit(" ")) for c in (prediction, gold))
    return rows.select(*order, (said == wanted).alias("exact"), F.when(wanted == "  ", said == wanted).otherwise(said.contains(wanted)).alias("contained"))


def ngrams(w: Column, n: int) -> Column:
    """All ``n`` successive words of an array of words, as an array of strings. ``w`` is a plain column: it
    is looked at for every place."""
    if n == 1:
        return w
    places = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.array_join(F.slice(w, i, n), " "))


def _counts_by_row(ids: Sequence[str], lengths: Sequence[int], slice_rows: int):
    """The task of :func:`gram_counts` for rows that stand alone; made here, so that workers get it by value."""

    def common(said, wanted, grams: int, rows: int):
        import numpy as np

        (a, n_a), (b, n_b) = (np.unique(keys, return_counts=True) for keys in (said, wanted))
        both, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        return np.bincount(both // grams, np.minimum(n_a[at_a], n_b[at_b]), rows).astype(np.int64)

    def counted(batch):
        import numpy as np
        import pyarrow as pa

        rows = batch.num_rows
        sides = [batch.column(c) for c in ("_said", "_wanted")]
        # Words of candidates, row by row, and then of references.
        sizes = np.concatenate([pa.compute.list_value_length(c).to_numpy(zero_copy_only=False) for c in sides]).astype(np.int64)
        numbered = pa.concat_arrays([c.flatten() for c in sides]).dictionary_encode()
        word, words = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(numbered.dictionary) + 1
        text = np.repeat(np.arange(2 * rows), sizes)
        end = np.repeat(np.cumsum(sizes), sizes)
        at, gram, grams = np.arange(len(word)), word, words
        for n in range(1, max(lengths) + 1):
            if n > 1:
                # The n-gram from a place on is the one that is a word shorter, and the word after it.
                inside = at + n <= end[at]
                at, gram = at[inside], gram[inside]
                different, gram = np.unique(gram * words + word[at + n - 1], return_inverse=True)
                grams = len(different) + 1
            if n in lengths:
                keys = (text[at] % rows) * grams + gram
                of_candidate = text[at] < rows
                found = common(keys[of_candidate], keys[~of_candidate], grams, rows)
                there = np.maximum(sizes - (n - 1), 0)
                columns = [pa.array(np.full(rows, n, np.int32)), pa.array(there[:rows]), pa.array(there[rows:]), pa.array(found)]
                names = [*ids, "n", "n_candidate", "n_reference", "n_common"]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ids), *columns], names=names)

    def run(batches):
        import pyarrow.compute  # noqa: F401

        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                yield from counted(batch.slice(start, slice_rows))

    return run


def _counts_by_id(df: DataFrame, candidate: str, reference: str, ids: Sequence[str], lengths: Sequence[int]) -> DataFrame:
    """:func:`gram_counts` for rows that share ids: the n-grams of all rows of an id are counted together.

    Each text is cut into words once, whatever the lengths: a generator stands between the words and the n-grams,
    through which Spark does not move the cutting. Both sides are counted in one grouping by (row, length,
    n-gram), which combines before it is shuffled.
    """
    sides = []
    for column in (candidate, reference):
        cut = df.select(*ids, F.explode(F.array(words(F.col(column)))).alias("_words"))
        grams = F.array(*(F.struct(F.lit(n).alias("n"), ngrams(F.col("_words"), n).alias("grams")) for n in lengths))
        by_length = cut.select(*ids, F.inline(grams)).select(*ids, "n", F.explode_outer("grams").alias("_gram"))
        sides.append(by_length.withColumn("_said", F.lit(column == candidate)))
    there = F.col("_gram").isNotNull()
    counts = sides[0].union(sides[1]).groupBy(*ids, "n", "_gram").agg(
        F.count_if(there & F.col("_said")).alias("_said"), F.count_if(there & ~F.col("_said")).alias("_wanted")
    )
    return counts.groupBy(*ids, "n").agg(
        F.sum("_said").alias("n_candidate"), F.sum("_wanted").alias("n_reference"), F.sum(F.least("_said", "_wanted")).alias("n_common")
    )


def gram_counts(
    df: DataFrame, candidate: str, reference: str, ids: Sequence[str], lengths: Sequence[int], slice_rows: int = GRAM_ROWS
) -> DataFrame:
    """Per id and length ``n``: n-grams of candidate and reference, and those in common (each as often as both have it).

    A row that has its id alone is counted where it is: Spark cuts its texts into words, and each n-gram gets a number
    from that of the shorter one before it, so that nothing but counts leaves the task. Ids are looked at before, and
    rows that share them are grouped. A row without n-grams of a length has zeros.
    """
    often = df.groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    often = materialize(often.select(*(F.col(c).alias(f"_often{i}") for i, c in enumerate(ids))), "often")
    alike = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_often{i}")) for i, c in enumerate(ids)))
    all_once = often.isEmpty()
    once = df if all_once else df.join(often, alike, "left_anti")
    cut = once.select(*ids, words(F.col(candidate)).alias("_said"), words(F.col(reference)).alias("_wanted"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*ids).schema)
    counts = cut.mapInArrow(_counts_by_row(list(ids), sorted(set(lengths)), slice_rows), f"{kinds}, n int, n_candidate long, n_reference long, n_common long")
    if all_once:
        return counts
    return counts.unionByName(_counts_by_id(df.join(often, alike, "left_semi"), candidate, reference, ids, lengths))


def ngram_overlap(df: DataFrame, candidate: str, reference: str, ids: Sequence[str], n: int = 1) -> DataFrame:
    """Per row: n-grams of candidate and reference, those in common, and the recall, precision and F1 that are
    known as ROUGE-N."""
    sums = gram_counts(df, candidate, reference, ids, [n]).drop("n")
    recall, precision = (F.coalesce(F.try_divide("n_common", c), F.lit(0.0)) for c in ("n_reference", "n_candidate"))
    f1 = F.coalesce(F.try_divide(2 * F.col("n_common"), F.col("n_candidate") + F.col("n_reference")), F.lit(0.0))
    return sums.withColumns({"recall": F.round(recall, 6), "precision": F.round(precision, 6), "f1": F.round(f1, 6)})


def corpus_bleu(df: DataFrame, candidate: str, reference: str, ids: Sequence[str], longest: int = 4) -> DataFrame:
    """One row: BLEU of a corpus of one reference each, without smoothing."""
    lengths = list(range(1, longest + 1))
    counted = gram_counts(df, candidate, reference, ids, lengths).groupBy("n").agg(
        *[F.sum(c).alias(c) for c in ("n_common", "n_candidate", "n_reference")]
    )
    # One row per length; an empty corpus has none.
    one = F.col("n") == 1
    said, wanted = F.max(F.when(one, F.col("n_candidate"))), F.max(F.when(one, F.col("n_reference")))
    fit = F.exp(F.avg(F.log(F.try_divide("n_common", "n_candidate"))))
    short = F.when(said >= wanted, 1.0).otherwise(F.exp(1 - F.try_divide(wanted, said)))
    found = F.coalesce(F.min("n_common") > 0, F.lit(False))
    return counted.agg(F.round(F.when(found, fit * short).otherwise(0.0), 6).alias("bleu"))


def compare_runs(base: DataFrame, tuned: DataFrame, column: str = "pass_rate", least_gain: float = LEAST_GAIN, most_loss: float = MOST_LOSS) -> DataFrame:
    """Per category: the rates of two runs, the gain relative to the first, whether that is enough to go on,
    and whether a loss is small enough to accept. A rate of 0 is improved by anything above."""
    joined = base.select("category", F.col(column).alias("base")).join(tuned.select("category", F.col(column).alias("tuned")), "category", "full")
    gain = F.round(F.try_divide(F.col("tuned") - F.col("base"), F.col("base")), 6)
    return joined.withColumn("gain", gain).withColumns(
        {
            "improves": F.coalesce(F.col("gain") > least_gain, (F.col("base") == 0) & (F.col("tuned") > 0)),
            "keeps": F.coalesce(F.col("gain") >= -most_loss, F.col("base") == 0),
        }
    )


def _poisson_limits(bits: int = 32) -> list[int]:
    """Numbers of ``bits`` bits below which a uniform draw stands for 0, 1, 2, ... of a Poisson variable of mean 1."""
    limits, term, total, n = [], exp(-1), 0.0, 0
    while (total + term) * 2**bits < 2**bits - 1 and n < 12:
        total += term
        limits.append(int(total * 2**bits))
        n += 1
        term /= n
    return limits


POISSON_LIMITS = _poisson_limits()


def poisson_weight(draw: Column) -> Column:
    """How often a row counts in a replicate, from 32 uniform bits."""
    weight = F.lit(len(POISSON_LIMITS))
    for n, limit in reversed(list(enumerate(POISSON_LIMITS))):
        weight = F.when(draw < limit, n).otherwise(weight)
    return weight


def gain_interval(
    paired: DataFrame,
    group: Sequence[str],
    ids: Sequence[str],
    base: str,
    tuned: str,
    replicates: int = REPLICATES,
    level: float = 0.95,
    least_gain: float = LEAST_GAIN,
    most_loss: float = MOST_LOSS,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Per group: the gain of ``tuned`` over ``base``, relative to it, and an interval for it by a paired bootstrap.

    Both scores of a row, flags or numbers such as F1, are drawn together: in each replicate a row counts as often
    as a Poisson variable of mean 1 that its id and the replicate's number decide, so that reruns agree. All
    replicates are sums of one aggregation, which combines before it is shuffled. The interval goes from one
    order statistic of the replicates to another. ``improves`` and ``keeps`` ask of its lower end what
    :func:`compare_runs` asks of the gain. Replicates in which the base has nothing have no gain and are left out.
    """
    scored = paired.select(*group, *ids, F.col(base).cast("double").alias("_base"), F.col(tuned).cast("double").alias("_tuned"))
    drawn = scored.withColumn("_replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    draw = F.conv(F.substring(seeded_hash(seed, F.col("_replicate"), *[F.col(c) for c in (*group, *ids)]), 1, 8), 16, 10).cast("bigint")
    # Replicate 0 is the sample itself.
    weighted = drawn.withColumn("_weight", F.when(F.col("_replicate") == 0, 1).otherwise(poisson_weight(draw)))
    sums = weighted.groupBy(*group, "_replicate").agg(*[F.sum(F.col(c) * F.col("_weight")).alias(c) for c in ("_base", "_tuned")])
    gains = sums.withColumn("_gain", F.round(F.try_divide(F.col("_tuned") - F.col("_base"), F.col("_base")), 6))
    found = gains.groupBy(*group).agg(
        F.max(F.when(F.col("_replicate") == 0, F.col("_gain"))).alias("gain"),
        F.sort_array(F.collect_list(F.when(F.col("_replicate") > 0, F.col("_gain")))).alias("_gains"),  # as many as replicates
    )
    cut = F.floor(F.size("_gains") * ((1 - level) / 2)).cast("int")
    ends = found.select(*group, "gain", F.get("_gains", cut).alias("low"), F.get("_gains", F.size("_gains") - 1 - cut).alias("high"))
    return ends.withColumns({"improves": F.coalesce(F.col("low") > least_gain, F.lit(False)), "keeps": F.coalesce(F.col("low") >= -most_loss, F.lit(False))})
