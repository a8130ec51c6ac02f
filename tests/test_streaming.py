import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from corpusprep.operators import report, validate
from corpusprep.session import prepare
from corpusprep.sources import ingest
from corpusprep.streaming import validation
from corpusprep.streaming.lines import PLACE, numbered_lines


def line(instruction, output, **more):
    return json.dumps({"instruction": instruction, "output": output, **more})


FILES = {
    "1.jsonl": [line("first", "answer", input="winner"), "", "broken", line("long " * 1500, "answer")],
    "2.jsonl": [line("first", "answer", input="late"), line("second", "answer"), line("second", "answer", input="twin"), line("a", "b")],
    "3.jsonl": [line("long " * 1500, "answer"), line("third", "x" * 9000), line("w " * 1400, "borderline")],
}


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)


def arrive(folder, lines_file, names=FILES):
    folder.mkdir(exist_ok=True)
    for name in names:
        lines_file(folder / name, FILES[name])
    return str(folder)


def run(spark, folder, base):
    records = validation.stream_jsonl(spark, folder)
    query = validation.run_first_wins(records, PLACE, f"{base}/out", f"{base}/checkpoint", keep=["instruction", "input"])
    query.awaitTermination()
    return query


def counts(df):
    return {r.status: r["count"] for r in df.groupBy("status").count().collect()}


def test_first_wins_over_batches(spark, tmp_path, lines_file):
    folder = arrive(tmp_path / "in", lines_file, ["1.jsonl"])
    run(spark, folder, tmp_path)
    # A restart picks up the files that came in between, and knows the keys of the first run.
    arrive(tmp_path / "in", lines_file, ["2.jsonl", "3.jsonl"])
    query = run(spark, folder, tmp_path)
    assert query.lastProgress["numInputRows"] == 7  # its own rows: what came before is not read again
    got = validation.status_table(spark, f"{tmp_path}/out")
    batch = validate.classify(ingest.sft_records(ingest.jsonl(spark, folder + "/*.jsonl")), ingest.ORDER)
    assert counts(got) == counts(batch) == {"malformed": 1, "empty_fields": 1, "duplicates": 3, "valid": 3, "too_long": 2}
    assert [r.input for r in got.filter("instruction = 'first' and status = 'valid'").collect()] == ["winner"]
    assert [r.input for r in got.filter("instruction = 'second' and status = 'valid'").collect()] == [""]
    want = report.status_counts(batch).first().asDict()
    assert validation.totals(spark, f"{tmp_path}/out").first().asDict() == want
    running = [r.asDict() for r in validation.running_totals(spark, f"{tmp_path}/out").orderBy("batch_id").collect()]
    assert [r["total"] for r in running] == [3, 10] and running[1] == want | {"batch_id": 1}


def test_a_repeated_batch_changes_nothing(spark, tmp_path, lines_file):
    folder = arrive(tmp_path / "in", lines_file, ["1.jsonl"])
    run(spark, folder, tmp_path)
    arrive(tmp_path / "in", lines_file)
    run(spark, folder, tmp_path)
    before = validation.totals(spark, f"{tmp_path}/out").first(), sorted(validation.status_table(spark, f"{tmp_path}/out").collect(), key=str)
    # Forget the last commit, as if the driver had died right after writing the batch.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    commits[-1].with_name(f".{commits[-1].name}.crc").unlink()
    run(spark, folder, tmp_path)
    assert before == (validation.totals(spark, f"{tmp_path}/out").first(), sorted(validation.status_table(spark, f"{tmp_path}/out").collect(), key=str))


def test_one_frequent_record_in_many_ranges(spark, tmp_path, lines_file):
    hot, other = line("the hot record", "answer"), [line(f"record {i}", "answer") for i in range(200)]
    (tmp_path / "in").mkdir()
    lines_file(tmp_path / "in" / "b.jsonl", [hot] * 9000 + other)
    lines_file(tmp_path / "in" / "a.jsonl", [*other, *[hot] * 9000])
    lines = numbered_lines(spark, str(tmp_path / "in"), range_bytes=10_000)
    records = ingest.sft_records(ingest.parse_records(lines, "value"))
    validation.run_first_wins(records, PLACE, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    valid = validation.status_table(spark, f"{tmp_path}/out").filter("status = 'valid'").orderBy(*PLACE).collect()
    assert len(valid) == 201 and {r.src_file for r in valid} == {"a.jsonl"}
    assert valid[-1].src_byte == sum(len(x) + 1 for x in other)  # the first of 18,000


def test_numbered_lines_are_all_lines_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = {"a.txt": "one\r\ntwo\n\nlast without end", "b.txt": "é" * 5000 + "\n" + "x\n" * 4000, "c.txt": "", "_hidden.txt": "no\n", "d.other": "no\n"}
    for name, text in texts.items():
        (tmp_path / "in" / name).write_bytes(text.encode())

    def read(base):
        query = numbered_lines(spark, str(tmp_path / "in"), ".txt", range_bytes=777).writeStream.format("parquet")
        query.option("checkpointLocation", f"{base}/c").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
        return sorted((r.src_file, r.src_byte, r.value) for r in spark.read.parquet(f"{base}/out").collect())

    def plain():
        rows = []
        for name in ("a.txt", "b.txt"):
            at = 0
            for part in (tmp_path / "in" / name).read_bytes().splitlines(keepends=True):
                rows.append((name, at, part.decode().rstrip("\r\n")))
                at += len(part)
        return sorted(rows)

    assert read(tmp_path) == plain()
    # Lines that are added to a file come in the next batch, those before them not again.
    with open(tmp_path / "in" / "b.txt", "ab") as grown:
        grown.write(b"more\nand more\n")
    assert read(tmp_path) == plain()


def test_repeats_within_and_beyond_a_bound(spark, tmp_path):
    schema = "event_id long, ts timestamp, key string"
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    # (minutes, key): the bound is an hour, the watermark ten minutes behind.
    batches = [
        [(0, "a"), (59, "a"), (118, "a"), (0, "b"), (60, "b"), *[(1, f"only once {i}") for i in range(50)]],
        [(170, "a"), (240, "c"), (300, "c")],
        [(299, "a"), (20, "b"), (301, "b")],  # the second comes behind the watermark of minute 290
    ]
    number = 0
    for i, rows in enumerate(batches):
        events = [(number + j, start + timedelta(minutes=m), k) for j, (m, k) in enumerate(rows)]
        number += len(rows)
        spark.createDataFrame(events, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    marked = validation.mark_repeats(arriving, ["key"], "ts", ["event_id"], timedelta(hours=1), "10 minutes")
    query = marked.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination()
    got = {r.event_id: r.repeat for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert all(got.pop(i) is False for i in range(5, 55))
    assert got == {0: False, 1: True, 2: True, 3: False, 4: False, 55: True, 56: False, 57: False, 58: False, 60: False}
    assert validation.late_rows(query) == 1
    # What the watermark has passed is forgotten: of 53 keys, those of the last hour are left, with their timers.
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert held[0] >= 52 and held[-1] <= 9


def test_repeats_of_many_keys_in_few_buckets(spark, tmp_path):
    """State follows the buckets, not the keys; marks are those of a plain walk through all events."""
    schema = "event_id long, ts timestamp, user long, kind string"
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rng = random.Random(9)
    rows = [(i, rng.choice([None, 2**53 + 1, 2**53 + 2, *range(120)]), rng.choice([None, "", "a"])) for i in range(3000)]
    times = sorted(rng.randrange(0, 3000) for _ in rows)
    events = [(i, start + timedelta(minutes=m), user, kind) for (i, user, kind), m in zip(rows, times)]
    for part in range(3):
        spark.createDataFrame(events[part * 1000 : part * 1000 + 1000], schema).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        arriving = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        marked = validation.mark_repeats(arriving, ["user", "kind"], "ts", ["event_id"], timedelta(hours=6), "1 hour", buckets=8)
        query = marked.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
        query.awaitTermination()
        # A value and a timer for each bucket.
        assert query.recentProgress[0]["stateOperators"][0]["numRowsTotal"] <= 2 * 2 * 8
    want, last = {}, {}
    for i, ts, *key in events:
        seen = last.get(tuple(key))
        want[i] = seen is not None and ts - seen < timedelta(hours=6)
        last[tuple(key)] = ts
    assert {r.event_id: r.repeat for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want


def drain(df, base, mode="append"):
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return df.sparkSession.read.parquet(f"{base}/out")


def test_state_keeps_distinct_records(spark, tmp_path, lines_file):
    folder = arrive(tmp_path / "in", lines_file)
    for name, keep in (("all", None), ("bounded", "1 hour")):
        unique = validation.validate_stream(validation.stream_jsonl(spark, folder), keep_keys_for=keep)
        got = drain(unique.select("digest", "status"), tmp_path / name)
        assert counts(got) == {"valid": 3, "too_long": 2}
        assert got.select("digest").distinct().count() == 5


def test_running_early_counts(spark, tmp_path, lines_file):
    folder = arrive(tmp_path / "in", lines_file)
    totals = []
    (
        validation.early_status_counts(validation.stream_jsonl(spark, folder))
        .writeStream.outputMode("complete")
        .foreachBatch(lambda df, _: totals.append({r.status: r.n_rows for r in df.collect()}))
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    assert totals[-1] == {"malformed": 1, "empty_fields": 1, "checked": 8}
