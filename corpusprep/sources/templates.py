"""Record synthesis from prompt templates and canned responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.functions.hashing import hash_index, seeded_hash
from corpusprep.operators.split import DEFAULT_SEED

SALTS = 256
REPEATS_AT_ONCE = 4096

# Fixed values.
DEFAULT_PER_CATEGORY = 200
NO_RESPONSE = "Yeh abhi available nahi hai."
HINGLISH_CATEGORIES = ("casual_chat", "coding_help", "creative_writing")


def from_templates(
    templates: DataFrame,
    responses: DataFrame,
    num_samples: int = DEFAULT_PER_CATEGORY,
    seed: int = DEFAULT_SEED,
    hinglish: Sequence[str] = HINGLISH_CATEGORIES,
) -> DataFrame:
    """Repeat every category's templates and give each repeat a response picked by seeded hash.

    ``templates`` has (category, category_pos, template_pos, template) and ``responses`` has
    (category, response_pos, response), with positions from 0 without gaps. A category of ``t``
    templates is repeated ``num_samples // t + 1`` times, and the whole stops after ``num_samples``
    times the number of categories, in category order. Rows carry their place ``idx`` in the
    category. A category without responses gets a fixed text.
    """
    sizes = templates.groupBy("category", "category_pos").agg(F.count(F.lit(1)).alias("_size"))
    repeats = F.floor(F.lit(num_samples) / F.col("_size")).cast("bigint") + 1
    # One row per category from here to the join.
    before = Window.orderBy("category_pos").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plan = (
        sizes.withColumn("_repeats", repeats)
        .withColumn("_start", F.coalesce(F.sum(F.col("_repeats") * F.col("_size")).over(before), F.lit(0)))
        .withColumn("_cap", F.lit(num_samples) * F.count(F.lit(1)).over(whole))
        .drop("category_pos")
    )
    # One category may hold most templates: each meets its category's row in one of many copies.
    salt = F.pmod(F.xxhash64("template_pos"), F.lit(SALTS)).alias("_salt")
    salted_plan = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    choices = responses.groupBy("category").agg(F.count(F.lit(1)).alias("_choices"))
    rows = (
        templates.select("category", "template_pos", "template", salt)
        .join(salted_plan.join(choices, "category", "left"), ["category", "_salt"])
        # In two steps, so that a template with many repeats is never one long array.
        .withColumn("_first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_repeats") - 1, F.lit(REPEATS_AT_ONCE))))
        .withColumn("_repeat", F.explode(F.sequence("_first", F.least(F.col("_first") + (REPEATS_AT_ONCE - 1), F.col("_repeats") - 1))))
        .withColumn("idx", F.col("_repeat") * F.col("_size") + F.col("template_pos"))
        .filter(F.col("_start") + F.col("idx") < F.col("_cap"))
    )
    pick = seeded_hash(seed, F.col("category"), F.col("idx"))
    # The response join is on (category, position), so a large category spreads over its responses.
    picked = rows.withColumn("response_pos", hash_index(pick, F.col("_choices"))).join(
        responses.select("category", F.col("response_pos").cast("bigint").alias("response_pos"), "response"),
        ["category", "response_pos"],
        "left",
    )
    return picked.select(
        "category",
        "idx",
        F.col("template").alias("instruction"),
        F.lit("").alias("input"),
        F.coalesce("response", F.lit(NO_RESPONSE)).alias("output"),
        F.when(F.col("category").isin(*hinglish), "hinglish").otherwise("hindi").alias("language"),
    )


def category_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n_rows"))
