"""Exact dedup against a persistent index of digests.

The index is a table bucketed and sorted by digest. A batch is reduced to one row per digest before it
is shuffled, meets the index in a sort-merge anti join that reads the index bucket by bucket without a
shuffle, and what is new is appended in the same buckets. A later batch is thus compared with
everything before it at the cost of its own rows plus one sequential read of the index.

Only DataFrame functions are used.

Defined results: a null text counts as empty; the row with the smallest id of a group stays. Rows
without an id come after all rows with one. Repeated rows (same id and text) share one verdict, and
each of them counts in the group's size. Other columns of the input are never read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.llm.common import drop_rows, text_or_empty
from corpusprep.session import materialize, scratch_path

#: Digests of a bucket, about: some 80 MB, so that a bucket is sorted in memory.
BUCKET_ROWS = 1 << 21
LEAST_BUCKETS = 8

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(column: str = "text") -> Column:
    """The text with each run of ASCII white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(column), WHITE_SPACE, " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest): the SHA-256 of each normalised text, as 32 bytes."""
    return docs.select(
        F.col(id_col).alias("id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("digest")
    )


class DigestIndex:
    """A table (digest, keep_id), bucketed and sorted by digest.

    ``path`` is a folder that all executors share; by default one under ``spark.checkpoint.dir``.
    An index that already lies at ``path`` is taken up again.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = LEAST_BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_path(spark, "digest-index")
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex}"
        if not spark.catalog.tableExists(self.name):
            # The path may hold the rows of an earlier session: declare the table over them.
            spark.sql(
                f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
            )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def new(self, batch: DataFrame) -> DataFrame:
        """One row (digest, keep_id) for each digest of ``batch`` that the index lacks."""
        firsts = batch.groupBy("digest").agg(F.min("id").alias("keep_id"))
        return firsts.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Append the digests of ``batch`` that are new. Adding a batch again adds nothing."""
        (
            self.new(batch)
            .select("digest", F.col("keep_id").cast("bigint"))
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def batches(rows: DataFrame, count: int) -> list[DataFrame]:
    """``rows`` cut by id into ``count`` ranges of equal width, in order; rows without id are in the last."""
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    if low is None:
        return [rows]
    step = (high - low) // count + 1
    place = F.coalesce(F.floor((F.col("id") - low) / step), F.lit(count - 1))
    return [rows.filter(place == i) for i in range(count)]


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None, n_batches: int = 2
) -> DataFrame:
    """(id, digest, keep_id, group_size, kept) for every row of ``docs``.

    Batches enter the index in the order of their ids, so that the smallest id of a group is always
    met first. With an index that already holds rows, ``keep_id`` may be one of those; the group's
    size counts the rows of ``docs``.
    """
    rows = materialize(digests(docs, id_col, text_col), "digests")
    index = index or DigestIndex(docs.sparkSession, buckets=max(LEAST_BUCKETS, -(-rows.count() // BUCKET_ROWS)))
    for batch in batches(rows, n_batches):
        index.add(batch)
    # One row per digest on either side: no skew here. Only groups of several rows, and rows that an
    # earlier id stands for, go on; Spark can split their skewed join with the rows.
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min("id").alias("first"))
    groups = materialize(
        sizes.join(index.rows().hint("merge"), "digest")
        .filter((F.col("group_size") > 1) | ~F.col("first").eqNullSafe(F.col("keep_id")))
        .select("digest", "keep_id", "group_size", F.lit(True).alias("several")),
        "groups",
    )
    several = F.coalesce("several", F.lit(False))
    keep_id = F.when(several, F.col("keep_id")).otherwise(F.col("id"))
    return rows.join(groups, "digest", "left").select(
        "id",
        "digest",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep_id).alias("kept"),
    )


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that stay; of rows alike in id and text one stays."""
    id_name, digest_name = f"{id_col}_of_dropped", f"{id_col}_digest_of_dropped"
    rows = dedup(docs, id_col, text_col, index)
    dropped = rows.filter(~F.col("kept")).select(F.col("id").alias(id_name), F.col("digest").alias(digest_name)).distinct()
    own = F.unhex(F.sha2(normalised(text_col), 256))
    stay = drop_rows(docs, materialize(dropped, "dropped"), id_col, id_name, own == F.col(digest_name), nulls=True)
    # Repeated rows are told apart by nothing; only where there are any, their texts are brought together.
    several = rows.filter("kept").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    several = materialize(several.select(F.col("id").alias(id_name), F.col("digest").alias(digest_name)), "repeated")
    if several.isEmpty():
        return stay
    alike = F.col(id_col).eqNullSafe(F.col(id_name)) & (own == F.col(digest_name))
    repeated = stay.join(several, alike, "left_semi").withColumn(digest_name, own).dropDuplicates([id_col, digest_name])
    return stay.join(several, alike, "left_anti").union(repeated.drop(digest_name))
