"""End-to-end jobs from files to files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from corpusprep.functions.hashing import pair_digest, seeded_hash
from corpusprep.functions.tokenizers import NativeTokenizer, Tokenizer
from corpusprep.operators import chat, chunk, containment, dedup, pairs, report, sample, scan, scoring, split, validate
from corpusprep.session import materialize, prepare, remove
from corpusprep.sources import ingest, records, sinks, templates

Paths = str | Sequence[str]


def collect_sources(sources: Sequence[records.Source], records_out: str, corpus_out: str, skip_corpus: bool = False):
    """Load all sources, write records as JSONL by source and documents as text.

    Returns the counts per source and the sources that failed, which are left out whole: each source is
    written on its own first, so that one that breaks off half-way leaves nothing behind.
    """
    work = f"{records_out}_work"
    spark = SparkSession.getActiveSession()

    def stage(name: str, df: DataFrame) -> DataFrame:
        return materialize(df, f"source-{uuid.uuid5(uuid.NAMESPACE_URL, name).hex}", work)

    loaded, failures = records.load_all(sources, skip_corpus, stage)
    if loaded is None:
        raise ValueError(f"no source could be loaded: {failures}")
    counts = records.source_counts(loaded).collect()  # one row per source
    sinks.splits(loaded.filter(~F.col("is_corpus")).select(*records.CANONICAL, "source"), records_out, "source")
    if "text" in loaded.columns:
        sinks.text(records.from_documents(loaded.filter("is_corpus")), corpus_out)
    remove(spark, work)
    return spark.createDataFrame(counts, "source string, is_corpus boolean, n_rows long"), failures


def synthesize_files(spark: SparkSession, templates_in: str, responses_in: str, out: str, num_samples: int, seed: int = split.DEFAULT_SEED) -> DataFrame:
    """Records from template and response tables in JSONL; returns the counts per category."""
    rows = templates.from_templates(
        spark.read.schema("category string, category_pos int, template_pos long, template string").json(templates_in),
        spark.read.schema("category string, response_pos long, response string").json(responses_in),
        num_samples,
        seed,
    )
    sinks.jsonl(rows.select(*records.CANONICAL), out)
    return templates.category_counts(rows)


def score_files(spark: SparkSession, prompts_in: str, responses_in: str, out: str, num_tests: int = scoring.DEFAULT_NUM_TESTS) -> DataFrame:
    """The result file of responses to the first prompts of each category; returns the pass rates."""
    prompts = spark.read.schema("category string, pos long, prompt string").json(prompts_in)
    responses = spark.read.schema("category string, prompt string, response string").json(responses_in)
    scored = scoring.score(scoring.attach(prompts, responses, num_tests))
    sinks.by_category(scoring.results(scored), out)
    return scoring.pass_rates(scored, num_tests)


def validate_files(
    spark: SparkSession,
    jsonl: Paths,
    text: Paths | None,
    out: str,
    tokenizer: Tokenizer | None = None,
    vocab_size: int | None = None,
    seed: int = split.DEFAULT_SEED,
) -> DataFrame:
    """Validate records, split them 80/10/10 and write ``sft/split=...``, ``lcpt_corpus``, ``running`` (totals
    up to each file) and ``validation_report`` under ``out``; returns the report.

    Texts are read twice. The first time, one narrow row per record is written, with its place, digest
    and what its length says; repeats, split and report come from those rows. The second time, lines are not
    parsed again: they are moved once, with the narrow rows of valid records, and go to their splits in source order.
    """
    started = time.time()
    prepare(spark)
    work = f"{out}/_work"
    tokenizer = tokenizer or NativeTokenizer()
    parsed = ingest.sft_records(ingest.jsonl(spark, jsonl))
    judged = materialize(_judged(parsed, tokenizer, work), "judged", work)
    valid = validate.valid_records(judged)
    # Digests are unique among valid records, and do not depend on how files were cut into splits.
    order = seeded_hash(seed, F.col("digest"))
    ends = materialize(spark.range(1).select(split.cut_hashes(valid, order).alias("ends")), "ends", work).first()["ends"]
    parts = valid.withColumn("split", split.label(order, [F.lit(end) for end in ends]))

    sinks.record_splits(ingest.lines(spark, jsonl), parts, f"{out}/sft", ingest.ORDER, ingest.ORDER[:2])
    if text is None:
        lines = spark.createDataFrame([], "text string, status string")
    else:
        lines = materialize(validate.lcpt_lines(ingest.lines(spark, text), tokenizer=tokenizer), "lines", work)
        sinks.text(lines.filter("status = 'valid'"), f"{out}/lcpt_corpus")
    sinks.jsonl(report.running_by_file(judged, "src_file"), f"{out}/running")
    built = report.build(judged, parts, lines, vocab_size, time.time() - started, getattr(tokenizer, "name", type(tokenizer).__name__))
    sinks.jsonl(built, f"{out}/validation_report")
    remove(spark, work)
    return spark.read.schema(built.schema).json(f"{out}/validation_report")


def _judged(parsed: DataFrame, tokenizer: Tokenizer, work: str) -> DataFrame:
    """One narrow row per record: its place, digest, language, status and tokens."""
    sized = validate.with_prompt(parsed.withColumn("early", validate.early_status(parsed)))
    state = F.coalesce("early", validate.length_class(F.col("_chars"), validate.MAX_RECORD_TOKENS))
    counted = validate.token_limit(sized.withColumn("status", state), F.col("_prompt"), "status", validate.MAX_RECORD_TOKENS, tokenizer)
    narrow = materialize(
        counted.select(
            *ingest.ORDER,
            "language",
            F.when(F.col("early").isNull(), pair_digest(F.col("instruction"), F.col("output"))).alias("digest"),
            "status",
            "n_tokens",
        ),
        "narrow",
        work,
    )
    # A number in source order, one for each record: file splits are few, and numbered on their own.
    cuts = narrow.groupBy("src_file", "src_block").agg(F.min("src_row").alias("_least"), (F.max("src_row") - F.min("src_row") + 1).alias("_rows"))
    starts = scan.before(cuts, [], ["src_file", "src_block"], {"_rows": scan.SUM}, folder=f"{work}/starts")
    starts = starts.select("src_file", "src_block", "_least", F.coalesce("_rows_before", F.lit(0)).alias("_start"))
    placed = narrow.join(starts, ["src_file", "src_block"]).withColumn(
        "pos", F.col("_start") + F.col("src_row") - F.col("_least")
    )
    passed = F.col("digest").isNotNull()
    firsts = dedup.first_rows(placed.filter(passed), F.col("digest"), ["pos"])
    repeat = passed & ~F.col("_is_first")
    return (
        dedup.mark_first(placed, firsts, ["pos"], "_is_first")
        .withColumn("status", F.when(repeat, "duplicates").otherwise(F.col("status")))
        .withColumn("n_tokens", F.when(~repeat, F.col("n_tokens")))
        .select(*ingest.ORDER, "language", "digest", "status", "n_tokens")
    )


def parse_parallel(
    spark: SparkSession,
    path: str,
    stories_out: str,
    records_out: str,
    max_pairs: int | None = pairs.MAX_PAIRS,
    max_stories: int | None = pairs.MAX_STORIES,
    seed: int = split.DEFAULT_SEED,
) -> DataFrame:
    """Stories and translation records from an EN:/HI: file; returns the counts."""
    work = f"{records_out}_work"
    paired = pairs.read_pairs(spark, path, work)
    sinks.text(pairs.stories(paired, max_stories, ingest.ORDER, [ingest.split()]), stories_out)
    # Line numbers are unique across files.
    sinks.jsonl(pairs.translation_sample(paired, ["src_row"], max_pairs, seed).drop("src_row"), records_out)
    counts = pairs.counts(paired, max_stories).collect()  # one row
    remove(spark, work)
    return spark.createDataFrame(counts)


def convert_messages(spark: SparkSession, jsonl: Paths, out: str) -> DataFrame:
    """JSONL records to ``{id, messages}`` JSONL; returns the kept and dropped counts.

    A record without an id gets one with the number of its line in its file.
    """
    placed = ingest.with_line_number(chat.fields_as_text(ingest.jsonl(spark, jsonl)), ingest.line_starts(spark, jsonl))
    # The writing pass counts what it sees.
    seen = Observation()
    sinks.jsonl(chat.to_messages(placed.observe(seen, *chat.conversion_metrics()), F.col("line_no")), out)
    return spark.createDataFrame([seen.get], "kept bigint, dropped bigint")


def lcpt_training(
    spark: SparkSession,
    text: Paths,
    max_stories: int | None = None,
    max_len: int = chunk.MAX_TOKENS,
    tokenizer: Tokenizer | None = None,
    seed: int = split.DEFAULT_SEED,
) -> DataFrame:
    """Corpus lines, sampled, cut into token windows and tokenized: one row per training example."""
    lines = sample.fixed_size(ingest.lines(spark, text), max_stories, ["src_row"], seed)
    return chunk.truncate(chunk.windows(lines, "text", tokenizer, max_len), "text", tokenizer, max_len).select("tokens")


def sft_training(spark: SparkSession, jsonl: Paths, max_rows: int | None = sample.DEFAULT_TRAIN_ROWS) -> DataFrame:
    """The first records in source order as chat text; any bad line fails the job."""
    parsed = ingest.sft_records(ingest.jsonl(spark, jsonl, strict=True))
    first = sample.first_k(parsed, max_rows, ingest.ORDER, [ingest.split()])
    return chat.training_text(first).select("text")


def mix_files(spark: SparkSession, jsonl: Paths, out: str, weights: dict[str, int], by_tokens: bool = False, seed: int = split.DEFAULT_SEED) -> DataFrame:
    """Records sampled so that their languages have the given shares in percent, of rows or of tokens; returns rows per language.

    Lines go out as they came, in source order within each file that is written.
    """
    prepare(spark)
    work = f"{out}_work"
    parsed = ingest.sft_records(ingest.jsonl(spark, jsonl, keep_line=True)).filter(~F.col("malformed"))
    tokens = NativeTokenizer().count(validate.prompt_text(F.col("instruction"), F.col("input"), F.col("output"))).cast("bigint")
    rows = materialize(parsed.select(*ingest.ORDER, "language", tokens.alias("n_tokens"), "text"), "rows", work)
    mixed = sample.mix_tokens(rows, weights, "language", "n_tokens", ["src_row"], seed=seed) if by_tokens else sample.mix(rows, weights, "language", ["src_row"], seed=seed)
    sinks.text(mixed.sortWithinPartitions(*ingest.ORDER), out)
    counts = mixed.groupBy("language").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_tokens").alias("n_tokens")).collect()  # one per language
    remove(spark, work)
    return spark.createDataFrame(counts, "language string, n_rows long, n_tokens long")


def corpus_report(spark: SparkSession, text: Paths, tokenizer: Tokenizer | None = None) -> DataFrame:
    """One row: size and fertility of a text corpus, and whether its tokens are enough to train on."""
    lines = ingest.lines(spark, text).withColumn("corpus", F.lit("all"))
    counted = report.fertility(lines, "text", "corpus", tokenizer)
    return counted.drop("corpus").withColumn("enough", F.col("n_tokens") >= report.LEAST_CORPUS_TOKENS)


def dedup_lines(spark: SparkSession, text: Paths, out: str, exact: bool = False) -> DataFrame:
    """The first of all lines that are equal, without regard to case and white space unless ``exact``, in source order;
    returns the counts."""
    lines = ingest.lines(spark, text)
    key = F.sha2(F.col("text") if exact else dedup.normalized(F.col("text")), 256)
    kept = dedup.first_wins(lines, key, ingest.ORDER)
    sinks.text(kept.repartitionByRange(*ingest.ORDER).sortWithinPartitions(*ingest.ORDER), out)
    seen, stayed = lines.count(), spark.read.text(out).count()
    return spark.createDataFrame([(seen, stayed)], "seen long, kept long")


def overlap_files(spark: SparkSession, pairs_in: str, candidate: str, reference: str, out: str, n: int = 1) -> DataFrame:
    """ROUGE-N of each row of a JSONL file with an ``id``, written to ``out``; returns its means and the corpus BLEU."""
    rows = spark.read.schema(f"id string, `{candidate}` string, `{reference}` string").json(pairs_in)
    sinks.jsonl(scoring.ngram_overlap(rows, candidate, reference, ["id"], n), out)
    scores = spark.read.schema("recall double, precision double, f1 double").json(out)
    means = scores.agg(*[F.round(F.avg(c), 6).alias(c) for c in ("recall", "precision", "f1")])
    return means.withColumn("bleu", scoring.corpus_bleu(rows, candidate, reference, ["id"]).scalar())


def gate_files(spark: SparkSession, base: str, tuned: str, score: str = "flag") -> DataFrame:
    """Per category: the gain of one run's results over another's, with an interval, and what it allows.

    Both are result files with ``category``, ``pos`` and a score that is a flag or a number.
    """
    runs = [
        spark.read.json(path).select("category", "pos", F.col(score).cast("double").alias(name)) for path, name in ((base, "base"), (tuned, "tuned"))
    ]
    return scoring.gain_interval(runs[0].join(runs[1], ["category", "pos"]), ["category"], ["pos"], "base", "tuned")


def contained_files(spark: SparkSession, texts: str, passages: str, out: str) -> DataFrame:
    """Which passages stand in which texts, both JSONL with ``id`` and ``text``; returns the counts."""
    given = [spark.read.schema("id string, text string").json(path) for path in (texts, passages)]
    found = containment.contained(given[0].withColumnRenamed("id", "text_id"), given[1].withColumnRenamed("id", "passage_id"), "text_id", "passage_id")
    sinks.jsonl(found, out)
    written = spark.read.schema(found.schema).json(out)
    return written.agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("text_id").alias("texts"), F.countDistinct("passage_id").alias("passages"))
