"""Time the headline queries: ``BENCH_SF_DIR``, ``BENCH_CPUS``; prints one JSON line.

Every query runs once untimed and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from corpusprep.plans import jobs, views  # noqa: E402
from corpusprep.plans.catalog import QUERIES  # noqa: E402
from corpusprep.session import local_session  # noqa: E402

HEADLINE = (
    "q_sft_status",
    "q_sft_status_exact",
    "q_status_counts",
    "q_length_class",
    "q_token_limit",
    "q_dedup_exact",
    "q_split_exact",
    "q_holdout_split",
    "q_report",
    "q_ingest_jsonl",
    "q_as_str",
    "q_union_sources",
    "q_lcpt_filter",
    "q_chunk",
    "q_sample_lines",
    "q_train_subset",
    "q_to_messages",
    "q_chat_render",
    "q_pair_lines",
    "q_stories",
    "q_translation_sample",
    "q_script_pass_rates",
    "q_synthesize",
    "q_mix",
    "q_fertility",
    "q_rouge1",
    "q_contained",
    "q_mix_tokens",
)


def copies(df, n: int, key: str):
    """``n`` copies of a table under new keys, for throughput beyond the fixed cost of a job."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(key, F.col(key) * n + F.col("copy"))


def size(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def throughput(spark, sf_dir: str) -> dict[str, float]:
    """Rows and megabytes per second of the two jobs the baseline has figures for, from files to files."""
    rates = {}
    with tempfile.TemporaryDirectory(prefix="bench-") as work:
        # Every third copy repeats the records of the first; the others differ by their number.
        docs = copies(views.sft_view(spark, sf_dir), 30, "doc_id").withColumn(
            "instruction", F.when(F.col("copy") % 3 > 0, F.concat("instruction", F.lit(" "), "copy")).otherwise(F.col("instruction"))
        )
        docs.select("instruction", "input", "output", "language").repartition(8).write.json(f"{work}/records")
        user = F.col("role") == "user"
        line = F.concat(F.when(user, "EN: ").otherwise("HI: "), F.translate("text", "\n", " "))
        turns = copies(views.table(spark, sf_dir, "conversations"), 300, "conv_id")
        turns.repartition(8, "conv_id").sortWithinPartitions("conv_id", "turn").select(line).write.text(f"{work}/turns")
        for name, bytes_in, run in (
            ("validate", size(f"{work}/records"), lambda out: jobs.validate_files(spark, f"{work}/records", None, out).first()["total_rows_read"]),
            ("pairs", size(f"{work}/turns"), lambda out: jobs.parse_parallel(spark, f"{work}/turns", f"{out}-s", f"{out}-r").first()["pairs"]),
        ):
            run(f"{work}/{name}-warm")
            start = time.perf_counter()
            rows = run(f"{work}/{name}-timed")
            took = time.perf_counter() - start
            rates |= {f"{name}_rows_per_sec": round(rows / took, 1), f"{name}_mb_per_sec": round(bytes_in / 1e6 / took, 1), f"{name}_sec": round(took, 1)}
    return rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    # Untimed: loads classes and lets the JVM compile the code paths.
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "documents": documents,
    }
    if names is HEADLINE:
        result["throughput"] = throughput(spark, sf_dir)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
