"""Pairing of alternating EN:/HI: marker lines, and what is made from the pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusprep.functions.hashing import hash_choice, seeded_hash
from corpusprep.functions.text import WHITESPACE
from corpusprep.operators import scan
from corpusprep.operators.sample import first_k, fixed_size
from corpusprep.operators.split import DEFAULT_SEED
from corpusprep.session import materialize
from corpusprep.sources.ingest import ordered_text

# Markers, character limits, default sizes and instruction wordings.
EN_MARKER = "EN:"
HI_MARKER = "HI:"
STORY_CHARS = (100, 8000)
PAIR_CHARS = (60, 1500)
MAX_STORIES = 400_000
MAX_PAIRS = 25_000
PAIR_LANGUAGE = "hindi_translation"
TRANSLATE_INSTRUCTIONS = (
    "Translate the following story to Hindi:",
    "निम्नलिखित कहानी का हिंदी में अनुवाद करें:",
    "Translate this English text into natural Hindi:",
)


def markers(lines: DataFrame, text: str = "text") -> DataFrame:
    """Keep marker lines; add ``kind`` (EN or HI) and ``body`` (rest of the line, stripped).

    Lines are taken as stripped, as :func:`corpusprep.sources.ingest.lines` gives them.
    """
    line = F.col(text)
    body = F.substring(line, len(EN_MARKER) + 1, 2**31 - 1)
    return (
        lines.filter(line.startswith(EN_MARKER) | line.startswith(HI_MARKER))
        .withColumn("kind", F.when(line.startswith(EN_MARKER), "EN").otherwise("HI"))
        .withColumn("body", F.ltrim(body, F.lit(WHITESPACE)))
        .drop(text)
    )


def candidates(
    marked: DataFrame, source: Sequence[str], bucket: str, order: str, within: Sequence[str] | None = None
) -> DataFrame:
    """Pairs inside one bucket, and the first and last marker of every bucket.

    Rows are sorted per (source, bucket), so that one long source is spread over many tasks.
    ``within`` may name cheaper columns to sort by, if along (``within``, ``order``) the rows of a
    bucket stand together in order.
    """
    along = Window.partitionBy(*(within or [*source, bucket])).orderBy(order)
    place = F.struct(*source, bucket)
    is_hi = F.col("kind") == "HI"
    seen = (
        marked.withColumn("_before", F.lag(F.struct(place.alias("place"), "kind", "body")).over(along))
        .withColumn("_after", F.lead(place).over(along))
        .withColumn("_starts", ~F.col("_before.place").eqNullSafe(place))
        .withColumn("is_first", F.col("_starts") & is_hi)
        .withColumn("is_last", ~F.col("_after").eqNullSafe(place))
    )
    before = F.col("_before")
    paired = ~F.col("_starts") & is_hi & (F.col("body") != "") & (before["kind"] == "EN") & (before["body"] != "")
    seen = seen.withColumn("is_pair", F.coalesce(paired, F.lit(False)))
    # Only an EN that ends its bucket, or a HI that starts one, needs its text beyond this point.
    edge_text = F.when(F.col("is_first") | (F.col("is_last") & ~is_hi), F.col("body"))
    found = seen.filter(F.col("is_pair") | F.col("is_first") | F.col("is_last")).select(
        *source, bucket, order, "is_pair", "is_first", "is_last", "kind",
        F.when(F.col("is_pair"), before["body"]).alias("en"),
        F.when(F.col("is_pair"), F.col("body")).otherwise(edge_text).alias("hi"),
    )
    # Lengths in characters, so that later steps can choose pairs without reading texts.
    return found.withColumn("en_chars", F.length("en")).withColumn("hi_chars", F.length("hi"))


def join_edges(found: DataFrame, source: Sequence[str], bucket: str, order: str, folder: str | None = None) -> DataFrame:
    """All pairs: those found inside buckets, and those whose EN ends the bucket before.

    ``found`` is written once. Of each bucket its last marker is a summary without text; a prefix scan tells every
    bucket the last marker before it, however many buckets a source has. Only texts of pairs across buckets meet.
    """
    found = materialize(found, "markers", folder)
    pair = [*source, bucket, order, "en", "hi", "en_chars", "hi_chars"]
    last = F.struct(F.col(bucket).alias("place"), "kind", F.col("hi_chars").alias("chars"))
    ends = found.filter("is_last").select(*source, bucket, last.alias("last"))
    known = scan.before(ends, source, [bucket], {"last": scan.LAST}, folder=folder and f"{folder}/edges")
    ended = F.col("last_before")
    waiting = known.filter((ended["kind"] == "EN") & (ended["chars"] > 0)).select(*source, bucket, ended["place"].alias("_place"))
    begun = found.filter(F.col("is_first") & (F.col("hi_chars") > 0)).select(*source, bucket, order, "hi", "hi_chars")
    texts = found.filter(F.col("is_last") & (F.col("kind") == "EN")).select(
        *source, F.col(bucket).alias("_place"), F.col("hi").alias("en"), F.col("hi_chars").alias("en_chars")
    )
    across = begun.join(waiting, [*source, bucket]).join(texts, [*source, "_place"])
    return found.filter("is_pair").select(*pair).unionByName(across.select(*pair))


def pair_markers(marked: DataFrame, source: Sequence[str], bucket: str, order: str) -> DataFrame:
    """Pair each HI marker with the EN marker right before it in the same source.

    A HI marker pairs if the marker before it is EN and both bodies have text; so a later EN
    replaces an earlier one and an empty HI uses up its EN. Source order is (``bucket``, ``order``).
    """
    return join_edges(candidates(marked, source, bucket, order), source, bucket, order)


def pair_lines(lines: DataFrame) -> DataFrame:
    """(en, hi) pairs of marker lines read by :func:`corpusprep.sources.ingest.lines`.

    A scan task reads its file splits one after the other and numbers rows as it goes, with its own
    number in the bits above the lowest 33: sorting by those two numbers needs no file names.
    """
    numbered = markers(lines).withColumn("_task", F.shiftright("src_row", 33))
    place = (["src_file"], "src_block", "src_row")
    return join_edges(candidates(numbered, *place, within=["_task"]), *place)


def split_candidates(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """As :func:`candidates`, for the lines of marker files; buckets are file splits.

    A scan task reads a split's lines in order. They are walked in Arrow batches, and no more than the
    last marker is carried from one batch to the next: nothing is shuffled or sorted, and it does not
    matter how far apart markers are.
    """
    schema = (
        "src_file string, src_block long, src_row long, is_pair boolean, is_first boolean, is_last boolean, "
        "kind string, en string, hi string, en_chars int, hi_chars int"
    )

    def run(batches):
        import pyarrow as pa

        held = None  # the last marker, of which it is not known yet whether it ends its split
        for batch in batches:
            found = _judged_markers(batch, held)
            if found.num_rows:
                found = found if held is None else pa.concat_tables([held, found])
                yield from _known_edges(found, False)
                held = found.slice(found.num_rows - 1)
        if held is not None:
            yield from _known_edges(held, True)

    return ordered_text(spark, paths).mapInArrow(run, schema)


def _judged_markers(batch, held):
    """The marker lines of a batch, with what the marker before each of them decides."""
    import pyarrow as pa
    import pyarrow.compute as pc

    text = pc.utf8_ltrim(batch.column("text"), characters=WHITESPACE)
    is_en = pc.starts_with(text, EN_MARKER)
    own = pa.table({"src_file": batch.column("src_file"), "src_block": batch.column("src_block"), "src_row": batch.column("src_row"), "is_en": is_en, "text": text})
    own = own.filter(pc.or_(is_en, pc.starts_with(text, HI_MARKER)))
    body = pc.utf8_trim(pc.utf8_slice_codeunits(own.column("text"), len(EN_MARKER)), characters=WHITESPACE)
    own = own.drop_columns("text").append_column("body", body).combine_chunks()
    first = held.select(own.column_names) if held is not None else own.slice(0, 0)
    before = pa.concat_tables([first, own]).slice(0, max(0, first.num_rows + own.num_rows - 1)).combine_chunks()
    after = own.slice(own.num_rows - before.num_rows)  # without the very first marker of a task, which has none before it
    same = pc.and_(pc.equal(after["src_block"], before["src_block"]), pc.equal(after["src_file"], before["src_file"]))
    filled = pc.and_(pc.not_equal(after["body"], ""), pc.not_equal(before["body"], ""))
    pair = pc.and_(pc.and_(same, filled), pc.and_(before["is_en"], pc.invert(after["is_en"])))
    en = pc.if_else(pair, before["body"], None)
    starts = pc.invert(same)
    if after.num_rows < own.num_rows:
        pair = pa.chunked_array([pa.array([False]), *_chunks(pair)], pa.bool_())
        starts = pa.chunked_array([pa.array([True]), *_chunks(starts)], pa.bool_())
        en = pa.chunked_array([pa.nulls(1, pa.string()), *_chunks(en)], pa.string())
    return own.append_column("is_pair", pair).append_column("is_first", pc.and_(starts, pc.invert(own["is_en"]))).append_column("en", en)


def _chunks(array) -> list:
    return array.chunks if hasattr(array, "chunks") else [array]


def _known_edges(found, at_end: bool):
    """The rows that go on, of all markers but the last one, or at the end of a task of that one."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if at_end:
        own, last = found, pa.array([True])
    else:
        own, after = found.slice(0, found.num_rows - 1), found.slice(1)
        last = pc.or_(pc.not_equal(own["src_block"], after["src_block"]), pc.not_equal(own["src_file"], after["src_file"]))
    own = own.append_column("is_last", last)
    own = own.filter(pc.or_(pc.or_(own["is_pair"], own["is_first"]), own["is_last"])).combine_chunks()
    needed = pc.or_(pc.or_(own["is_pair"], own["is_first"]), pc.and_(own["is_last"], own["is_en"]))
    hi = pc.if_else(needed, own["body"], None)
    out = {name: own[name] for name in ("src_file", "src_block", "src_row", "is_pair", "is_first", "is_last")}
    out |= {"kind": pc.if_else(own["is_en"], "EN", "HI"), "en": own["en"], "hi": hi}
    out |= {"en_chars": pc.utf8_length(own["en"]), "hi_chars": pc.utf8_length(hi)}
    yield from pa.table(out).combine_chunks().to_batches()


def read_pairs(spark: SparkSession, paths: str | Sequence[str], folder: str | None = None) -> DataFrame:
    """(en, hi) pairs of marker files with their source order; only the edges of file splits are shuffled."""
    return join_edges(split_candidates(spark, paths), ["src_file"], "src_block", "src_row", folder)


def is_story() -> Column:
    return F.col("hi_chars").between(*STORY_CHARS)


def is_eligible() -> Column:
    return F.col("en_chars").between(*PAIR_CHARS) & F.col("hi_chars").between(*PAIR_CHARS)


def stories(pairs: DataFrame, limit: int | None, order: Sequence[str], buckets: Sequence[Column] | None = None) -> DataFrame:
    """HI texts of story length, the first ``limit`` in source order, as text lines."""
    return first_k(pairs.filter(is_story()), limit, order, buckets).select(*order, F.col("hi").alias("text"))


def eligible(pairs: DataFrame) -> DataFrame:
    return pairs.filter(is_eligible())


def counts(pairs: DataFrame, story_limit: int | None) -> DataFrame:
    """One row: pairs seen, pairs that qualify for the sample, and stories kept."""
    n_stories = F.count_if(is_story())
    return pairs.agg(
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(is_eligible()).alias("eligible"),
        (n_stories if story_limit is None else F.least(n_stories, F.lit(story_limit).cast("bigint"))).alias("stories"),
    )


def to_triples(pairs: DataFrame, ids: Sequence[str], seed: int = DEFAULT_SEED) -> DataFrame:
    """Translation records; the instruction is one of the fixed wordings, picked by hash."""
    pick = seeded_hash(seed, F.lit("instruction"), *[F.col(c) for c in ids])
    return pairs.select(
        *ids,
        hash_choice(pick, TRANSLATE_INSTRUCTIONS).alias("instruction"),
        F.col("en").alias("input"),
        F.col("hi").alias("output"),
        F.lit(PAIR_LANGUAGE).alias("language"),
    )


def translation_sample(pairs: DataFrame, ids: Sequence[str], k: int | None = MAX_PAIRS, seed: int = DEFAULT_SEED) -> DataFrame:
    """A fixed-size uniform sample of the eligible pairs, as translation records."""
    return to_triples(fixed_size(eligible(pairs), k, ids, seed), ids, seed)
