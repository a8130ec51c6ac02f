"""Continuous validation of arriving records with Structured Streaming."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusprep.functions.hashing import pair_digest
from corpusprep.functions.text import strip
from corpusprep.functions.tokenizers import NativeTokenizer, Tokenizer
from corpusprep.operators import scan
from corpusprep.operators.report import status_counts
from corpusprep.operators.validate import (
    MAX_RECORD_TOKENS,
    early_status,
    length_class,
    token_limit,
    with_prompt,
)
from corpusprep.sources.ingest import parse_records, sft_records
from corpusprep.streaming.lines import numbered_lines

INGEST_TIME = "ingest_time"
# Rows that need no state are dealt over so many keys.
SPREAD = 4096


def stream_jsonl(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """JSONL files as they arrive, parsed and typed, with the place of each line; blank lines are skipped."""
    lines = numbered_lines(spark, path, suffix).withColumn("value", strip(F.col("value"))).filter(F.col("value") != "")
    return sft_records(parse_records(lines, "value"))


def _length_status(df: DataFrame, max_tokens: int, tokenizer: Tokenizer | None, settled: Column | None = None) -> DataFrame:
    """Add ``status``: the settled one where there is one, else by length."""
    sized = with_prompt(df)
    by_length = length_class(F.col("_chars"), max_tokens)
    staged = sized.withColumn("status", by_length if settled is None else F.coalesce(settled, by_length))
    judged = token_limit(staged, F.col("_prompt"), "status", max_tokens, tokenizer or NativeTokenizer())
    return judged.drop("_prompt", "_chars")


def validate_stream(
    records: DataFrame,
    tokenizer: Tokenizer | None = None,
    max_tokens: int = MAX_RECORD_TOKENS,
    keep_keys_for: str | None = None,
) -> DataFrame:
    """Records of a stream that are neither malformed, empty nor repeats, with their length status.

    The state holds one digest per distinct record and lets the first that arrives pass; which of
    two repeats in one micro-batch that is, Spark does not say. The state grows with the stream
    unless ``keep_keys_for`` (such as "7 days") bounds it: a repeat that comes later than that
    passes again. The clock decides there; :func:`mark_repeats` goes by a time of the data. Use
    :func:`run_first_wins` where source order must decide.
    """
    survivors = records.filter(early_status(records).isNull()).withColumn(
        "digest", pair_digest(F.col("instruction"), F.col("output"))
    )
    if keep_keys_for is None:
        unique = survivors.dropDuplicates(["digest"])
    else:
        unique = (
            survivors.withColumn(INGEST_TIME, F.current_timestamp())
            .withWatermark(INGEST_TIME, keep_keys_for)
            .dropDuplicatesWithinWatermark(["digest"])
            .drop(INGEST_TIME)
        )
    return _length_status(unique, max_tokens, tokenizer)


def _repeats(key_columns: Sequence[str], place: Sequence[str], kinds: str, keep_ms: int):
    """The processor of :func:`mark_repeats`; made here, so that workers get it by value."""
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    def in_order(row):
        # Nulls first; they are never compared with values.
        return [(v is not None, v) for v in (row["_ms"], *(row[c] for c in place))]

    class Repeats(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            # The last times of a bucket's keys, key by key, and when the first of them may be forgotten.
            self.held = handle.getValueState("held", f"due long, ms array<long>, {kinds}")

        def known(self) -> tuple[int | None, dict]:
            if not self.held.exists():
                return None, {}
            due, ms, *keys = self.held.get()
            return due, dict(zip(zip(*keys), ms))

        def hold(self, due: int | None, last: dict) -> None:
            first = min(last.values()) + keep_ms if last else None
            if first != due:
                if due is not None:
                    self.handle.deleteTimer(due)
                if first is not None:
                    self.handle.registerTimer(first)
            if last:
                self.held.update((first, list(last.values()), *(list(values) for values in zip(*last))))
            else:
                self.held.clear()

        def handleInputRows(self, key, rows, timerValues):
            due, last = self.known()
            # A bucket's rows of one batch; they are few, or else one key is most of the stream.
            for row in sorted(rows, key=in_order):
                of, ms = tuple(row[c] for c in key_columns), row["_ms"]
                seen = last.get(of)
                yield Row(**{c: row[c] for c in place}, repeat=seen is not None and ms is not None and ms - seen < keep_ms)
                if ms is not None:
                    last[of] = ms if seen is None else max(seen, ms)
            self.hold(due, last)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            due, last = self.known()
            now = expiredTimerInfo.getExpiryTimeInMs()
            if due == now:
                passed = max(now, timerValues.getCurrentWatermarkInMs())
                self.hold(None, {of: ms for of, ms in last.items() if ms + keep_ms > passed})
            return iter(())

        def close(self) -> None:
            pass

    return Repeats()


def mark_repeats(
    stream: DataFrame, key: Sequence[str], event_time: str, place: Sequence[str], keep_keys_for: timedelta, delay: str, buckets: int = SPREAD
) -> DataFrame:
    """(place, repeat): whether the same key came less than ``keep_keys_for`` before, by the time in the data.

    A key is forgotten when the watermark, ``delay`` behind the latest time seen, has passed its last time by that
    much: the state holds the key and one number per key that may still matter. Keys are dealt into ``buckets``, whose
    state is read and written once a batch; their number stays with a checkpoint. Rows that come behind the watermark are
    not judged; :func:`late_rows` counts them. ``place`` names columns that are unique per row and decide
    between equal times.
    """
    timed = stream.withWatermark(event_time, delay).withColumn("_ms", F.unix_millis(event_time))
    fields = stream.select(*place).schema
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    held = ", ".join(f"key{i} array<{f.dataType.simpleString()}>" for i, f in enumerate(stream.select(*key).schema))
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("_bucket")
    narrow = timed.select(bucket, *dict.fromkeys([*key, *place]), event_time, "_ms")
    processor = _repeats(list(key), list(place), held, int(keep_keys_for.total_seconds() * 1000))
    return narrow.groupBy("_bucket").transformWithState(processor, f"{out}, repeat boolean", "append", "eventTime")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark in the batches of a query that are still remembered."""
    return sum(op["numRowsDroppedByWatermark"] for progress in query.recentProgress for op in progress["stateOperators"])


def early_status_counts(records: DataFrame) -> DataFrame:
    """Running counts of the statuses that need no other record; ``checked`` rows go on to dedup."""
    return records.groupBy(F.coalesce(early_status(records), F.lit("checked")).alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _least_place(order: Sequence[str], columns: Sequence[str]):
    """The processor of :func:`run_first_wins`; made here, so that workers get it by value."""
    from pyspark.sql import Row
    from pyspark.sql.streaming import StatefulProcessor

    class LeastPlace(StatefulProcessor):
        def init(self, handle) -> None:
            self.won = handle.getValueState("won", "here boolean")

        def judged(self, row, repeat: bool):
            settled = {"status": "duplicates", "n_tokens": None} if repeat else {}
            return Row(**({c: row[c] for c in columns} | settled))

        def handleInputRows(self, key, rows, timerValues):
            if key[0].startswith("early"):
                yield from (self.judged(row, False) for row in rows)
                return
            known = self.won.exists()
            first = None
            # The least place so far is held back: no more than one row of a key is, however many there are.
            for row in rows:
                if known:
                    yield self.judged(row, True)
                elif first is None:
                    first = row
                else:
                    before = [row[c] for c in order] < [first[c] for c in order]
                    yield self.judged(first if before else row, True)
                    first = row if before else first
            if first is not None:
                self.won.update((True,))
                yield self.judged(first, False)

        def close(self) -> None:
            pass

    return LeastPlace()


def first_wins(
    records: DataFrame, order: Sequence[str], keep: Sequence[str] = (), tokenizer: Tokenizer | None = None, max_tokens: int = MAX_RECORD_TOKENS
) -> DataFrame:
    """(order, keep, status, n_tokens) of a stream: every record gets one status, a repeat ``duplicates``.

    State keyed by digest says whether an earlier batch has the record; of the records of one batch the one with
    the least place in ``order`` wins. A batch is compared with state alone, and no row of an earlier one is
    read again. Lengths are judged before, so that no text is shuffled unless ``keep`` names it.
    """
    early = early_status(records)
    digest = F.when(F.col("_early").isNull(), pair_digest(F.col("instruction"), F.col("output")))
    alone = F.concat(F.lit("early"), F.pmod(F.xxhash64(*order), F.lit(SPREAD)).cast("string"))
    judged = _length_status(records.withColumn("_early", early), max_tokens, tokenizer, F.col("_early"))
    columns = [*order, *[c for c in keep if c not in order], "status", "n_tokens"]
    narrow = judged.withColumn("_key", F.coalesce(digest, alone)).select("_key", *columns)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.select(*columns).schema)
    return narrow.groupBy("_key").transformWithState(_least_place(list(order), columns), kinds, "append", "none")


def run_first_wins(
    records: DataFrame,
    order: Sequence[str],
    out: str,
    checkpoint: str,
    keep: Sequence[str] = (),
    tokenizer: Tokenizer | None = None,
    max_tokens: int = MAX_RECORD_TOKENS,
) -> StreamingQuery:
    """Write the statuses of :func:`first_wins` to ``out/status`` and what each batch adds to the totals to ``out/totals``.

    Both have one folder per batch. A batch that is run again meets the state of its first run and overwrites its
    own folders, so that a restart changes nothing and a repeated batch adds nothing.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        statuses = f"{out}/status/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(statuses)
        added = status_counts(batch.sparkSession.read.schema(batch.schema).parquet(statuses))
        added.write.mode("overwrite").parquet(f"{out}/totals/batch_id={batch_id}")

    return (
        first_wins(records, order, keep, tokenizer, max_tokens)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def status_table(spark: SparkSession, out: str) -> DataFrame:
    """All statuses that :func:`run_first_wins` has written so far."""
    return spark.read.parquet(f"{out}/status")


def running_totals(spark: SparkSession, out: str) -> DataFrame:
    """(batch_id, counts of all statuses): the totals after each batch, in the columns of ``report.status_counts``."""
    added = spark.read.parquet(f"{out}/totals")
    names = [c for c in added.columns if c != "batch_id"]
    known = scan.before(added, [], ["batch_id"], dict.fromkeys(names, scan.SUM))
    return known.select("batch_id", *[(F.col(c) + F.coalesce(F.col(f"{c}_before"), F.lit(0))).alias(c) for c in names])


def totals(spark: SparkSession, out: str) -> DataFrame:
    """One row: the counts of all statuses over all batches so far."""
    added = spark.read.parquet(f"{out}/totals")
    return added.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added.columns if c != "batch_id"])
