"""Every operator as a named query over the given Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.functions.hashing import pair_digest, short_key
from corpusprep.functions.tokenizers import NativeTokenizer
from corpusprep.operators import chat, chunk, containment, dedup, pairs, ranks, report, sample, scoring, split, validate
from corpusprep.plans.views import TURN_BLOCK_BITS, document_lines, documents, sft_view, table, turn_view
from corpusprep.session import materialize, prepare, scratch_path
from corpusprep.sources import ingest, records, sinks, templates
from corpusprep.streaming import validation
from corpusprep.streaming.lines import PLACE

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the queries whose feature is a limit.
SAMPLE_ROWS = 300
BIG_SAMPLE_ROWS = 10_000
STORY_LIMIT = 100
PAIR_SAMPLE = 60
NUM_TESTS = 150
SYNTH_PER_CATEGORY = 400
# The tables hold no Devanagari; accented Latin letters stand in for it.
STAND_IN_CLASS = "\\x{C0}-\\x{FF}"
# The tables' languages as response categories.
CATEGORY_OF_LANGUAGE = {"fr": scoring.HINDI, "de": scoring.HINDI, "es": scoring.HINGLISH, "en": scoring.ENGLISH}


def _big(c: str) -> Column:
    return F.col(c).cast("bigint").alias(c)


# --- validation ------------------------------------------------------------------------------


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.classify(sft_view(spark, sf_dir), ["doc_id"])


def sft_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).select("doc_id", "status", _big("n_tokens"))


def sft_status_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = validate.classify(sft_view(spark, sf_dir), ["doc_id"], exact=True, include_output=True)
    return judged.select("doc_id", "status", _big("n_tokens"))


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.status_counts(classified(spark, sf_dir))


def running_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.running_by_file(classified(spark, sf_dir), "source")


def length_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = validate.prompt_text(F.col("instruction"), F.col("input"))
    return sft_view(spark, sf_dir).select("doc_id", tx.n_chars(prompt).alias("n_chars")).withColumn(
        "length_class", validate.length_class(F.col("n_chars"), validate.MAX_RECORD_TOKENS)
    )


def token_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompt = validate.prompt_text(F.col("instruction"), F.col("input"))
    staged = sft_view(spark, sf_dir).select("doc_id", prompt.alias("prompt")).withColumn(
        "status", validate.length_class(F.length("prompt"), validate.MAX_RECORD_TOKENS)
    )
    borderline = staged.filter(F.col("status") == validate.BORDERLINE)
    settled = validate.token_limit(borderline, F.col("prompt"), "status", validate.MAX_RECORD_TOKENS, NativeTokenizer())
    return settled.select("doc_id", "status", _big("n_tokens"))


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The first row of each key is all that is asked for: one grouped minimum, no join back.
    digest = pair_digest(F.col("instruction"), F.col("output")).alias("digest")
    return sft_view(spark, sf_dir).groupBy(digest).agg(F.min("doc_id").alias("doc_id")).select(
        "doc_id", short_key(F.col("digest")).alias("dedup_key")
    )


def dedup_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First documents by text without regard to case and white space."""
    keyed = documents(spark, sf_dir).select("doc_id", F.sha2(dedup.normalized(F.col("text")), 256).alias("digest"))
    return dedup.first_wins(keyed, F.col("digest"), ["doc_id"]).select("doc_id", short_key(F.col("digest")).alias("dedup_key"))


def dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct corpus lines, with their first place and how often they occur."""
    lines = validate.lcpt_lines(document_lines(spark, sf_dir))
    key = F.sha2(F.col("text"), 256).alias("digest")
    place = F.struct("doc_id", F.col("line_no").cast("bigint").alias("line_no"))
    return lines.groupBy(key).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n_lines")).select(
        "first.doc_id", "first.line_no", "n_lines", short_key(F.col("digest")).alias("dedup_key")
    )

def valid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid records, written once: the split reads them three times."""
    return materialize(validate.valid_records(classified(spark, sf_dir)).select("doc_id", "language"), "valid")


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.exact(valid_ids(spark, sf_dir), ["doc_id"]).select("doc_id", "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.split_counts(split.exact(valid_ids(spark, sf_dir), ["doc_id"]))


def language_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.language_dist(split.exact(valid_ids(spark, sf_dir), ["doc_id"]))


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return split.exact(lines, ["l_orderkey", "l_linenumber"], cuts=split.HOLDOUT_CUTS, names=split.HOLDOUT)


def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = materialize(classified(spark, sf_dir).select("doc_id", "language", "status", "n_tokens"), "classified")
    parts = split.exact(validate.valid_records(judged), ["doc_id"])
    lcpt = validate.lcpt_lines(document_lines(spark, sf_dir))
    return report_columns(report.build(judged, parts, lcpt))


def report_columns(built: DataFrame, *more: str) -> DataFrame:
    """The report as plain columns."""
    languages = F.transform(F.map_entries("language_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return built.select(
        *["total_rows_read", "malformed", "empty_fields", "duplicates_removed", "valid", "too_long", "lcpt_kept"],
        *[F.col("splits")[n].alias(f"split_{n}") for n in (*split.THREE_WAY, "total")],
        F.array_join(F.array_sort(languages), ",").alias("languages"),
        *more,
    )


# --- reading -----------------------------------------------------------------------------------


def ingest_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ingest.parse_records(table(spark, sf_dir, "events").select("event_type", "props"), "props")
    k = F.try_variant_get(F.col("fields")["k"], "$", "bigint")
    return fields.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("fields").isNull()).alias("malformed"),
        F.count_if(tx.is_falsy(F.col("fields")["k"])).alias("falsy_k"),
        F.sum(k).alias("sum_k"),
    )


def ingest_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record lines, other JSON objects and plain text lines through the permissive reader."""
    as_records = sft_view(spark, sf_dir).select(
        F.lit("records").alias("origin"),
        F.to_json(F.struct("doc_id", "instruction", "input", "output", "language")).alias("line"),
    )
    props = table(spark, sf_dir, "events").select(F.lit("props").alias("origin"), F.col("props").alias("line"))
    plain = document_lines(spark, sf_dir).select(F.lit("text").alias("origin"), tx.strip(F.col("text")).alias("line"))
    lines = as_records.unionByName(props).unionByName(plain).filter(F.col("line") != "")
    typed = ingest.sft_records(ingest.parse_records(lines, "line"))
    early = F.col("early")
    return typed.withColumn("early", validate.early_status(typed)).groupBy("origin").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(early == "malformed").alias("malformed"),
        F.count_if(early == "empty_fields").alias("empty_fields"),
        F.count_if(early.isNull()).alias("passed"),
    )


def as_str(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lists of lines, coerced back to one string."""
    listed = documents(spark, sf_dir).select("doc_id", F.to_json(F.struct(F.split("text", "\n").alias("output"))).alias("line"))
    parsed = ingest.parse_records(listed, "line")
    return parsed.select("doc_id", tx.as_str(F.col("fields")["output"]).alias("text"))


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.from_triples(sft_view(spark, sf_dir), "hinglish", ["doc_id"])


def first_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.from_turn_rows(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", "hindi")


def qa_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.from_qa(turn_view(spark, sf_dir), "hindi", ["conv_id", "turn"])


def doc_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = records.from_documents(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", tx.n_chars(F.col("text")).alias("n_chars"))


def _all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, _ = records.load_all(
        [
            records.Source("documents", lambda: triples(spark, sf_dir)),
            records.Source("turns", lambda: first_turns(spark, sf_dir)),
            records.Source("answers", lambda: qa_records(spark, sf_dir)),
            records.Source("corpus", lambda: documents(spark, sf_dir).select("doc_id", "text"), corpus=True),
        ]
    )
    return loaded


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.source_counts(_all_sources(spark, sf_dir))


def source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.source_totals(_all_sources(spark, sf_dir))


# --- text corpus -------------------------------------------------------------------------------


def lcpt_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = validate.lcpt_lines(document_lines(spark, sf_dir))
    return lines.select("doc_id", _big("line_no"), "status", _big("n_tokens"), tx.n_chars(F.col("text")).alias("n_chars"))


def lcpt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.lcpt_counts(validate.lcpt_lines(document_lines(spark, sf_dir)))


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk.windows(documents(spark, sf_dir).select("doc_id", "text"))


def truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = chunk.truncate(documents(spark, sf_dir).select("doc_id", "text"))
    return cut.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), NativeTokenizer().decode(F.col("tokens")).alias("text")
    )


# --- samples -----------------------------------------------------------------------------------


def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sample.fixed_size(docs, SAMPLE_ROWS, ["doc_id"])


def sample_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return sample.fixed_size(lines, BIG_SAMPLE_ROWS, ["l_orderkey", "l_linenumber"])


def sample_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir).filter(tx.strip(F.col("text")) != "")
    return sample.sizes(lines, BIG_SAMPLE_ROWS)


def first_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample.first_k(table(spark, sf_dir, "documents").select("doc_id", "text"), SAMPLE_ROWS, ["doc_id"])


def train_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    # One order has few lines, so ranges of the order key are enough.
    return sample.first_k(
        lines, sample.DEFAULT_TRAIN_ROWS, ["l_orderkey", "l_linenumber"], ranks.id_buckets(lines, "l_orderkey")
    )


# --- chat --------------------------------------------------------------------------------------


def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_columns(chat.to_messages(sft_view(spark, sf_dir), F.col("doc_id")))


def message_columns(converted: DataFrame) -> DataFrame:
    message = F.col("messages")
    return converted.select(
        "id",
        F.size(message).cast("bigint").alias("n_messages"),
        F.get(message, F.lit(0))["content"].alias("user_content"),
        F.get(message, F.lit(1))["content"].alias("assistant_content"),
    )


def conversion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.conversion_counts(sft_view(spark, sf_dir))


def chat_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.training_text(sft_view(spark, sf_dir)).select("doc_id", "text")


def prompt_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", chat.prompt_chat(F.col("text")).alias("text"))


# --- parallel pairs ----------------------------------------------------------------------------


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as EN markers and assistant turns as HI markers; other turns are no markers."""
    kind = F.when(F.col("role") == "user", "EN").when(F.col("role") == "assistant", "HI")
    marked = (
        table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", F.shiftright("turn", TURN_BLOCK_BITS).alias("turn_block"), kind.alias("kind"), tx.strip(F.col("text")).alias("body"))
        .filter(F.col("kind").isNotNull())
    )
    return pairs.pair_markers(marked, ["conv_id"], "turn_block", "turn").drop("turn_block")


def _conversation_buckets(df: DataFrame) -> list[Column]:
    return [
        *ranks.id_buckets(df, "conv_id"),
        F.struct("conv_id", F.shiftright("turn", TURN_BLOCK_BITS)),
    ]


def pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).withColumns({c: F.col(c).cast("bigint") for c in ("en_chars", "hi_chars")})


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = materialize(_pairs(spark, sf_dir), "pairs")
    return pairs.stories(paired, STORY_LIMIT, ["conv_id", "turn"], _conversation_buckets(paired))


def translation_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    paired = materialize(_pairs(spark, sf_dir), "pairs")
    return pairs.translation_sample(paired, ["conv_id", "turn"], PAIR_SAMPLE)


def pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.counts(_pairs(spark, sf_dir), STORY_LIMIT)


# --- scoring -----------------------------------------------------------------------------------


def script_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        tx.has_script(text).alias("has_devanagari"),
        tx.has_script(text, STAND_IN_CLASS).alias("has_script"),
        tx.is_code_mixed(text, STAND_IN_CLASS).alias("is_code_mixed"),
        tx.has_latin_word(text).alias("has_latin_word"),
    )


def scored(spark: SparkSession, sf_dir: str, response: str = "output") -> DataFrame:
    known = F.create_map(*[F.lit(x) for kv in CATEGORY_OF_LANGUAGE.items() for x in kv])[F.col("language")]
    category = F.coalesce(known, F.lit(scoring.ENGLISH))
    view = sft_view(spark, sf_dir).withColumn("category", category).withColumn("pos", F.col("doc_id"))
    prompts = view.select("category", "pos", F.col("instruction").alias("prompt"))
    responses = view.select("category", "pos", F.col(response).alias("response"))
    attached = scoring.attach(prompts, responses, NUM_TESTS, on=("category", "pos"))
    return scoring.score(attached, STAND_IN_CLASS)


def eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.results(scored(spark, sf_dir)).withColumn("preview", tx.preview(F.col("response")))


def script_pass_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.pass_rates(scored(spark, sf_dir), NUM_TESTS)


MIX = {"en": 50, "fr": 35, "de": 15}


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"))
    return sample.mix(docs, MIX, "language", ["doc_id"])


def mixed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix by share of tokens."""
    count = NativeTokenizer().count(F.col("text")).cast("bigint").alias("n_tokens")
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"), count)
    return sample.mix_tokens(materialize(docs, "tokens"), MIX, "language", "n_tokens", ["doc_id"])


def fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.fertility(documents(spark, sf_dir), "text", "lang")


def token_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.token_budget(documents(spark, sf_dir), "text")


def short_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of a document as the answer to its last line."""
    return scoring.short_answer(sft_view(spark, sf_dir), "instruction", "output", ["doc_id"])


def short_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_short_answer without its limit, summed up by language."""
    view = sft_view(spark, sf_dir)
    judged = scoring.short_answer(view, "instruction", "output", ["language", "doc_id"], None)
    return judged.groupBy("language").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("exact").alias("exact"), F.count_if("contained").alias("contained"))


def rouge1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.ngram_overlap(sft_view(spark, sf_dir), "instruction", "output", ["doc_id"], 1)


def rouge2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.ngram_overlap(sft_view(spark, sf_dir), "instruction", "output", ["doc_id"], 2)


def first_line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the first document that begins with the same line: copies and near copies for the most part."""
    keyed = documents(spark, sf_dir).select("doc_id", "text", F.sha2(F.split_part("text", F.lit("\n"), F.lit(1)), 256).alias("line"))
    firsts = keyed.groupBy("line").agg(F.min("doc_id").alias("first"))
    later = keyed.join(firsts, "line").filter(F.col("doc_id") > F.col("first"))
    texts = documents(spark, sf_dir).select(F.col("doc_id").alias("first"), F.col("text").alias("reference"))
    return later.join(texts, "first").select("doc_id", F.col("text").alias("candidate"), "reference")


def bleu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against the first with the same first line, with n-grams of one to four words."""
    return scoring.corpus_bleu(first_line_pairs(spark, sf_dir), "candidate", "reference", ["doc_id"])


def contained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which items of the benchmark stand in which documents."""
    return containment.contained(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), "doc_id", "item_id")


def run_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last lines as the responses of one run, first lines as those of the other."""
    base, tuned = (scoring.pass_rates(scored(spark, sf_dir, c), NUM_TESTS) for c in ("output", "instruction"))
    return scoring.compare_runs(base, tuned)


def gate_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of q_run_gate, prompt by prompt, with an interval for the gain."""
    base, tuned = (scored(spark, sf_dir, c).select("category", "pos", F.col("flag").cast("int").alias(name)) for c, name in (("output", "base"), ("instruction", "tuned")))
    return scoring.gain_interval(base.join(tuned, ["category", "pos"]), ["category"], ["pos"], "base", "tuned")


def marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns written as marker lines, and read again."""
    tag = F.when(F.col("role") == "user", "EN: ").when(F.col("role") == "assistant", "HI: ").otherwise("")
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", tx.strip(F.concat(tag, F.translate("text", "\n", " "))).alias("text"))
    return pairs.markers(lines)


# --- synthesis ---------------------------------------------------------------------------------


def synthesized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First lines of documents as templates and last lines as responses, by language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("category"))
    # Numbers are given to (category, id) alone and written once; texts are joined last.
    buckets = F.struct(*ranks.id_buckets(docs, "doc_id"))
    placed = materialize(ranks.with_position(docs, ["category"], [F.col("doc_id")], buckets), "placed")
    order = placed.select("category").distinct().withColumn("category_pos", F.row_number().over(Window.orderBy("category")) - 1)
    view = sft_view(spark, sf_dir).select("doc_id", "instruction", "output")
    texts = placed.join(view, "doc_id").join(order, "category")
    return templates.from_templates(
        texts.select("category", "category_pos", F.col("position").alias("template_pos"), F.col("instruction").alias("template")),
        texts.select("category", F.col("position").alias("response_pos"), F.col("output").alias("response")),
        SYNTH_PER_CATEGORY,
        hinglish=("es",),
    )


def synth_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.category_counts(synthesized(spark, sf_dir))


# --- streaming ---------------------------------------------------------------------------------


def _record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    schema = table(spark, sf_dir, "documents").schema
    raw = spark.readStream.schema(schema).parquet(f"{sf_dir}/documents*.parquet")
    newline = F.instr("text", F.lit("\n"))
    return raw.select(
        "doc_id",
        F.col("lang").alias("language"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("instruction"),
        F.when(newline > 0, F.substr("text", newline + 1)).otherwise("").alias("input"),
        F.split_part("text", F.lit("\n"), F.lit(-1)).alias("output"),
    )


def _first_wins(records: DataFrame, order: list[str], keep: tuple[str, ...] = ()) -> str:
    """The folder with the statuses of a stream that was drained once."""
    base = scratch_path(records.sparkSession, "stream")
    validation.run_first_wins(records, order, f"{base}/out", f"{base}/checkpoint", keep).awaitTermination()
    return f"{base}/out"


def stream_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole waterfall as a stream, drained once."""
    out = _first_wins(_record_stream(spark, sf_dir), ["doc_id"])
    return validation.status_table(spark, out).select("doc_id", "status", _big("n_tokens"))


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of all statuses of a stream, from what its batches add."""
    return validation.totals(spark, _first_wins(_record_stream(spark, sf_dir), ["doc_id"]))


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written to JSONL files in order and read as a stream of numbered lines: place decides among repeats."""
    prepare(spark)
    folder = scratch_path(spark, "lines")
    fields = ("doc_id", "instruction", "input", "output", "language")
    sinks.jsonl(sinks.in_order(sft_view(spark, sf_dir).select(*fields), "doc_id", least=3), folder)
    fields_of = validation.stream_jsonl(spark, folder.removeprefix("file://"), ".json")
    numbered = fields_of.withColumn("doc_id", F.try_variant_get(F.col("fields")["doc_id"], "$", "bigint"))
    out = _first_wins(numbered, list(PLACE), ("doc_id",))
    return validation.status_table(spark, out).select("doc_id", "status", _big("n_tokens"))


def stream_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that repeat one of the same user and kind within six hours; three parts arrive one after the other."""
    prepare(spark)
    base = scratch_path(spark, "events")
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    ends = events.agg(F.unix_millis(F.min("ts")).alias("low"), F.unix_millis(F.max("ts")).alias("high")).first()
    part = F.width_bucket(F.unix_millis("ts").cast("double"), F.lit(float(ends["low"] or 0)), F.lit(float((ends["high"] or 0) + 1)), F.lit(3))
    for number in (1, 2, 3):
        # All files of a part are one batch; the next run goes on from the checkpoint.
        events.filter(part == number).write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema(events.schema).parquet(f"{base}/in")
        marked = validation.mark_repeats(arriving, ["user_id", "event_type"], "ts", ["event_id"], timedelta(hours=6), "1 hour")
        writer = marked.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
        writer.start(f"{base}/out").awaitTermination()
    return spark.read.schema("event_id bigint, repeat boolean").parquet(f"{base}/out")


def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct surviving records of a stream with keyed state."""
    base = scratch_path(spark, "stream")
    unique = validation.validate_stream(_record_stream(spark, sf_dir)).select(short_key(F.col("digest")).alias("dedup_key"))
    (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
        .awaitTermination()
    )
    return spark.read.schema("dedup_key string").parquet(f"{base}/out")


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As q_stream_unique, with keys that are forgotten after a week; the stream is shorter than that."""
    base = scratch_path(spark, "stream")
    unique = validation.validate_stream(_record_stream(spark, sf_dir), keep_keys_for="7 days").select(short_key(F.col("digest")).alias("dedup_key"))
    (
        unique.writeStream.format("parquet")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{base}/out")
        .awaitTermination()
    )
    return spark.read.schema("dedup_key string").parquet(f"{base}/out")


def stream_early_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running early-status totals of a stream; the last total of each status."""
    base = scratch_path(spark, "stream")

    def write_totals(totals: DataFrame, batch_id: int) -> None:
        totals.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

    (
        validation.early_status_counts(_record_stream(spark, sf_dir))
        .writeStream.outputMode("complete")
        .foreachBatch(write_totals)
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.parquet(f"{base}/out").groupBy("status").agg(F.max_by("n_rows", "batch_id").alias("n_rows"))


QUERIES: dict[str, Query] = {
    "q_sft_status": sft_status,
    "q_sft_status_exact": sft_status_exact,
    "q_status_counts": status_counts,
    "q_running_by_source": running_by_source,
    "q_length_class": length_class,
    "q_token_limit": token_limit,
    "q_dedup_exact": dedup_exact,
    "q_dedup_normalized": dedup_normalized,
    "q_dedup_lines": dedup_lines,
    "q_split_exact": split_exact,
    "q_split_counts": split_counts,
    "q_language_dist": language_dist,
    "q_holdout_split": holdout_split,
    "q_report": validation_report,
    "q_ingest_props": ingest_props,
    "q_ingest_jsonl": ingest_jsonl,
    "q_as_str": as_str,
    "q_triples": triples,
    "q_first_turns": first_turns,
    "q_qa_records": qa_records,
    "q_doc_filter": doc_filter,
    "q_union_sources": union_sources,
    "q_source_totals": source_totals,
    "q_lcpt_filter": lcpt_filter,
    "q_lcpt_counts": lcpt_counts,
    "q_chunk": chunks,
    "q_truncate": truncated,
    "q_sample_k": sample_k,
    "q_sample_lines": sample_lines,
    "q_sample_sizes": sample_sizes,
    "q_first_k": first_k,
    "q_train_subset": train_subset,
    "q_to_messages": to_messages,
    "q_conversion_counts": conversion_counts,
    "q_chat_render": chat_render,
    "q_prompt_chat": prompt_chat,
    "q_pair_lines": pair_lines,
    "q_stories": stories,
    "q_translation_sample": translation_sample,
    "q_pair_counts": pair_counts,
    "q_script_flags": script_flags,
    "q_eval_results": eval_results,
    "q_script_pass_rates": script_pass_rates,
    "q_mix": mixed,
    "q_mix_tokens": mixed_tokens,
    "q_fertility": fertility,
    "q_token_budget": token_budget,
    "q_short_answer": short_answer,
    "q_short_answers": short_answers,
    "q_rouge1": rouge1,
    "q_rouge2": rouge2,
    "q_bleu": bleu,
    "q_contained": contained,
    "q_run_gate": run_gate,
    "q_gate_interval": gate_interval,
    "q_marker_lines": marker_lines,
    "q_synthesize": synthesized,
    "q_synth_counts": synth_counts,
    "q_stream_status": stream_status,
    "q_stream_counts": stream_counts,
    "q_stream_lines": stream_lines,
    "q_stream_expiry": stream_expiry,
    "q_stream_unique": stream_unique,
    "q_stream_bounded": stream_bounded,
    "q_stream_early_counts": stream_early_counts,
}
