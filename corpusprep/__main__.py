"""``python -m corpusprep JOB ...`` under spark-submit or a local session."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from corpusprep.operators import pairs, sample, scoring, split
from corpusprep.plans import jobs
from corpusprep.session import prepare
from corpusprep.sources import records, sinks, templates
from corpusprep.streaming import validation
from corpusprep.streaming.lines import PLACE


def count(value: str) -> int | None:
    """A number of rows, or ``all``."""
    return None if value == "all" else int(value)


def shares(value: str) -> dict[str, int]:
    """``hindi=70,english=30``: percent by language."""
    return {name: int(percent) for name, percent in (part.split("=") for part in value.split(","))}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="corpusprep", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    validate = commands.add_parser("validate", help="validate, deduplicate, split and report")
    validate.add_argument("--jsonl", nargs="+", required=True)
    validate.add_argument("--text", nargs="*")
    validate.add_argument("--out", required=True)
    validate.add_argument("--seed", type=int, default=split.DEFAULT_SEED)

    parallel = commands.add_parser("pairs", help="stories and translation records from an EN:/HI: file")
    parallel.add_argument("--input", required=True)
    parallel.add_argument("--stories-out", required=True)
    parallel.add_argument("--records-out", required=True)
    parallel.add_argument("--max-pairs", type=count, default=pairs.MAX_PAIRS)
    parallel.add_argument("--max-stories", type=count, default=pairs.MAX_STORIES)
    parallel.add_argument("--seed", type=int, default=split.DEFAULT_SEED)

    messages = commands.add_parser("messages", help="records to message format")
    messages.add_argument("--jsonl", nargs="+", required=True)
    messages.add_argument("--out", required=True)

    lcpt = commands.add_parser("lcpt-examples", help="sampled token windows of a text corpus, as JSONL")
    lcpt.add_argument("--text", nargs="+", required=True)
    lcpt.add_argument("--out", required=True)
    lcpt.add_argument("--max-stories", type=count)
    lcpt.add_argument("--max-len", type=int, default=1024)
    lcpt.add_argument("--seed", type=int, default=split.DEFAULT_SEED)

    sft = commands.add_parser("sft-examples", help="chat text of the first records, as JSONL")
    sft.add_argument("--jsonl", nargs="+", required=True)
    sft.add_argument("--out", required=True)
    sft.add_argument("--max-rows", type=count, default=sample.DEFAULT_TRAIN_ROWS)

    sources = commands.add_parser("sources", help="load Parquet or JSON sources into records and corpus text")
    sources.add_argument("--source", nargs=4, action="append", required=True, metavar=("NAME", "SHAPE", "LANGUAGE", "PATH"),
                         help="SHAPE is triples, messages, conversations, qa or documents; a path ending in .parquet is Parquet, others JSON")
    sources.add_argument("--records-out", required=True)
    sources.add_argument("--corpus-out", required=True)
    sources.add_argument("--skip-corpus", action="store_true")

    synth = commands.add_parser("synthesize", help="records from templates and responses in JSONL")
    synth.add_argument("--templates", required=True)
    synth.add_argument("--responses", required=True)
    synth.add_argument("--out", required=True)
    synth.add_argument("--per-category", type=int, default=templates.DEFAULT_PER_CATEGORY)
    synth.add_argument("--seed", type=int, default=split.DEFAULT_SEED)

    score = commands.add_parser("score", help="result file and pass rates of model responses in JSONL")
    score.add_argument("--prompts", required=True)
    score.add_argument("--responses", required=True)
    score.add_argument("--out", required=True)
    score.add_argument("--num-tests", type=int, default=scoring.DEFAULT_NUM_TESTS)

    stream = commands.add_parser("stream", help="statuses of JSONL files as they arrive, up to now")
    stream.add_argument("--input", required=True)
    stream.add_argument("--out", required=True)
    stream.add_argument("--checkpoint", required=True)

    mix = commands.add_parser("mix", help="records with given shares of languages")
    mix.add_argument("--jsonl", nargs="+", required=True)
    mix.add_argument("--out", required=True)
    mix.add_argument("--weights", type=shares, required=True)
    mix.add_argument("--by-tokens", action="store_true")
    mix.add_argument("--seed", type=int, default=split.DEFAULT_SEED)

    corpus = commands.add_parser("corpus", help="size and fertility of text lines, and whether they are enough")
    corpus.add_argument("--text", nargs="+", required=True)

    lines = commands.add_parser("dedup-lines", help="the first of equal text lines")
    lines.add_argument("--text", nargs="+", required=True)
    lines.add_argument("--out", required=True)
    lines.add_argument("--exact", action="store_true")

    overlap = commands.add_parser("overlap", help="ROUGE-N and BLEU of candidates against references")
    overlap.add_argument("--input", required=True)
    overlap.add_argument("--candidate", default="candidate")
    overlap.add_argument("--reference", default="reference")
    overlap.add_argument("--out", required=True)
    overlap.add_argument("--n", type=int, default=1)

    gate = commands.add_parser("gate", help="the gain of one run over another, with an interval")
    gate.add_argument("--base", required=True)
    gate.add_argument("--tuned", required=True)
    gate.add_argument("--score", default="flag")

    contained = commands.add_parser("contained", help="which passages stand in which texts")
    contained.add_argument("--texts", required=True)
    contained.add_argument("--passages", required=True)
    contained.add_argument("--out", required=True)
    return parser


def _source(spark: SparkSession, name: str, shape: str, language: str, path: str) -> records.Source:
    def load():
        rows = spark.read.parquet(path) if path.endswith(".parquet") else spark.read.json(path)
        return {
            "triples": lambda: records.from_triples(rows, language),
            "messages": lambda: records.from_turns(rows, "messages", "content", language),
            "conversations": lambda: records.from_turns(rows, "conversations", "value", language),
            "qa": lambda: records.from_qa(rows, language),
            "documents": lambda: rows.select("text"),
        }[shape]()

    return records.Source(name, load, corpus=shape == "documents")


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"corpusprep-{args.job}").getOrCreate()
    if args.job == "validate":
        report = jobs.validate_files(spark, args.jsonl, args.text or None, args.out, seed=args.seed)
        report.show(vertical=True, truncate=False)
    elif args.job == "pairs":
        counts = jobs.parse_parallel(
            spark, args.input, args.stories_out, args.records_out, args.max_pairs, args.max_stories, args.seed
        )
        counts.show()
    elif args.job == "messages":
        jobs.convert_messages(spark, args.jsonl, args.out).show()
    elif args.job == "lcpt-examples":
        sinks.jsonl(jobs.lcpt_training(spark, args.text, args.max_stories, args.max_len, seed=args.seed), args.out)
    elif args.job == "sources":
        counts, failures = jobs.collect_sources(
            [_source(spark, *given) for given in args.source], args.records_out, args.corpus_out, args.skip_corpus
        )
        counts.show(truncate=False)
        for name, problem in failures.items():
            print(f"left out: {name}: {problem.splitlines()[0]}")
    elif args.job == "synthesize":
        jobs.synthesize_files(spark, args.templates, args.responses, args.out, args.per_category, args.seed).show()
    elif args.job == "score":
        jobs.score_files(spark, args.prompts, args.responses, args.out, args.num_tests).show()
    elif args.job == "mix":
        jobs.mix_files(spark, args.jsonl, args.out, args.weights, args.by_tokens, args.seed).show()
    elif args.job == "corpus":
        jobs.corpus_report(spark, args.text).show()
    elif args.job == "dedup-lines":
        jobs.dedup_lines(spark, args.text, args.out, args.exact).show()
    elif args.job == "overlap":
        jobs.overlap_files(spark, args.input, args.candidate, args.reference, args.out, args.n).show()
    elif args.job == "gate":
        jobs.gate_files(spark, args.base, args.tuned, args.score).show()
    elif args.job == "contained":
        jobs.contained_files(spark, args.texts, args.passages, args.out).show()
    elif args.job == "stream":
        prepare(spark)
        arriving = validation.stream_jsonl(spark, args.input)
        validation.run_first_wins(arriving, PLACE, args.out, args.checkpoint).awaitTermination()
        validation.totals(spark, args.out).show()
    else:
        sinks.jsonl(jobs.sft_training(spark, args.jsonl, args.max_rows), args.out)


if __name__ == "__main__":
    main()
