"""Which passages stand, word by word, in which texts: a join through an index of word n-grams.

Case and the kind and amount of white space do not count; only whole words match. A passage that stands in
a text brings all its n-grams with it, so that it is enough to look at the texts that hold the rarest of them:

1. The n-grams of all passages make a filter of bounded size. N-grams of texts that pass it are counted by text.
2. Each passage chooses the n-gram that the fewest texts hold. One without texts ends the search for its passage.
3. Passages meet the texts that hold their n-gram. Each n-gram is dealt over ``SALTS`` keys by text, as one that a
   third of all texts hold would otherwise be one key.
4. The words of each pair are compared. Only the texts of pairs are moved, once each.

A passage shorter than an n-gram is looked up by all its words. Defined results: a null or blank passage is
contained in nothing, and a null or blank text contains nothing; rows without id, on either side, are left out.
Ids may repeat: a text id contains a passage id if any of their rows do. Each pair comes once. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusprep.functions.filters import maybe_in
from corpusprep.operators.scoring import words
from corpusprep.session import materialize

GRAM_WORDS = 5
SALTS = 64


def _cut(df: DataFrame, *columns: Column, text: str) -> DataFrame:
    """The columns and the words of a text, which are cut once: a generator stands behind them."""
    return df.select(*columns, F.explode(F.array(words(F.col(text)))).alias("words")).filter(F.size("words") > 0)


def _grams(size: Column) -> Column:
    """Digests of all ``size`` successive words of the column ``words``."""
    places = F.when(F.size("words") >= size, F.sequence(F.lit(1), F.size("words") - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.slice("words", i, size)))


def _spaced() -> Column:
    """The words as one text, a space around each."""
    return F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))


def contained(
    texts: DataFrame,
    passages: DataFrame,
    text_id: str,
    passage_id: str,
    text: str = "text",
    passage: str = "text",
    gram_words: int = GRAM_WORDS,
) -> DataFrame:
    """(passage_id, text_id) of every passage that stands in a text."""
    named = passages.filter(F.col(passage_id).isNotNull())
    cut = _cut(named, F.col(passage_id).alias("passage_id"), text=passage)
    sized = cut.withColumn("size", F.least(F.size("words"), F.lit(gram_words))).withColumn("spaced", _spaced())
    sized = sized.withColumn("passage", F.sha2("spaced", 256))
    ids = sized.select("passage", "passage_id").distinct()
    wanted = materialize(sized.dropDuplicates(["passage"]).select("passage", "spaced", "size", "words"), "passages")
    index = materialize(wanted.select("passage", "size", F.posexplode(_grams(F.col("size"))).alias("place", "gram")), "index")
    sizes = sorted(r["size"] for r in index.select("size").distinct().collect())  # as many as words of an n-gram

    own = texts.filter(F.col(text_id).isNotNull()).select(F.col(text_id).alias("text_id"), F.col(text).alias("text"))
    read = _cut(own, F.col("text_id"), text="text")
    grams = F.array(*(_grams(F.lit(n)) for n in sizes)) if sizes else F.array().cast("array<array<bigint>>")
    keys = index.select("gram").distinct()
    seen = maybe_in(read.select("text_id", F.explode(F.flatten(grams)).alias("gram")), "gram", keys, "gram")
    hits = materialize(seen.distinct().join(keys, "gram", "left_semi"), "hits")

    held = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = index.join(held, "gram", "left").groupBy("passage").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "gram")).alias("rarest"))
    probes = rarest.filter(F.col("rarest.n") > 0).select("passage", F.col("rarest.gram").alias("gram"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("text_id"), F.lit(SALTS)).cast("int"))
    pairs = materialize(probes.join(salted, ["gram", "salt"]).select("passage", "text_id"), "pairs")

    # Only texts of pairs are cut again.
    near = maybe_in(own, "text_id", pairs.select("text_id").distinct(), "text_id")
    spaced = _cut(near, F.col("text_id"), text="text").select("text_id", _spaced().alias("said"))
    checked = pairs.join(wanted.select("passage", "spaced"), "passage").join(spaced, "text_id").filter(F.col("said").contains(F.col("spaced")))
    found = checked.select("passage", "text_id").join(ids, "passage").select("passage_id", "text_id").distinct()
    return found.select(F.col("passage_id").alias(passage_id), F.col("text_id").alias(text_id))
