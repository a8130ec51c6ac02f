"""Every operator on rows with nulls, empty, long and repeated texts, clashing columns, and on no rows."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusprep.llm import bpe_transducer, embed_dedup, exact_index, hash_tree, html_main, langid, minhash_forest, packing, suffix_dedup, token_count, url_filter
from corpusprep.llm.common import on_workers

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
CLASHING = "id node n kept digest group tag rest bucket shard size text_crc32 region family component score lang_pred host path band".split()
LONG = "lorem ipsum dolor sit amet " * 8000
ROWS = [
    (1, "a short text of seven plain words", "en", "s", 33),
    (2, "a short text of seven plain words", "en", "s", 33),
    (2, "a short text of seven plain words", "en", "s", 33),
    (3, None, None, None, None),
    (4, "", "de", "s", 0),
    (5, " \t\n ", "de", None, 4),
    (6, LONG, "la", "s", len(LONG)),
    (7, "x" * 30_000, None, "s", 30_000),
    (None, "a short text of seven plain words", "en", "s", 33),
    (None, None, None, None, None),
    (8, "123 456 !!", "en", "s", 10),
    (9, "été 漢字 🎉 \u0000 \u2028 end", "fr", "s", 14),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(df):
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING))


@pytest.fixture(params=["odd", "empty"], scope="module")
def docs(request, spark):
    on_workers(spark)
    return clashing(spark.createDataFrame(ROWS if request.param == "odd" else [], SCHEMA)).repartition(3)


def expected(docs, n=None):
    return (n or len(ROWS)) if docs.take(1) else 0


def test_suffix_dedup(docs):
    rows = suffix_dedup.clean(docs, carry=("source", "n_chars")).collect()
    assert len(rows) == expected(docs)
    for r in rows:
        if r.id in (1, 2, 3, 4, 5, 8, 9):  # shorter than a string
            assert not r.spans
        if r.id == 7:  # the first string stays, its repeats inside the text go
            assert bytes(r.kept) == b"x" and [tuple(s) for s in r.spans] == [(1, 30_000)]
        if r.id == 3:
            assert r.n_bytes == 0 and bytes(r.kept) == b"" and r.rest.source is None


def test_hash_tree(docs):
    rows = hash_tree.shard(docs, hash_tree.balanced(3), hash_tree.joined(hash_tree.balanced(3), 3)).collect()
    assert len(rows) == expected(docs)
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r["size"] == 1 and r.text_crc32 == 0 for r in rows if r.id in (3, 4))


def test_packing(docs):
    rows = packing.pack(docs, JSON, size=64).collect()
    assert sum(1 for r in rows if r.piece == 0) == expected(docs)
    assert all(r.length == 1 for r in rows if r.id in (3, 4))


def test_transducer(docs):
    rows = bpe_transducer.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == expected(docs)
    assert all(r.n_tokens == 0 for r in rows if r.id in (3, 4))


def test_token_counts(docs):
    rows = token_count.count(docs, JSON).collect()
    assert len(rows) == expected(docs)
    assert all((r.n_bytes, r.n_tokens, r.over_limit) == (0, 0, False) for r in rows if r.id in (3, 4))
    assert all(r.over_limit for r in rows if r.id in (6, 7))


def test_language(docs):
    model = langid.fit(docs, F.lit(True))
    rows = langid.predict(docs, model).collect()
    assert len(rows) == expected(docs)
    unknown = {r.id for r in rows if r.lang_pred == "und"}
    assert unknown <= {None, 3, 4, 5, 8} and {3, 4, 5, 8} <= unknown or not rows
    assert all(r.rejected and r.score == 0 for r in rows if r.lang_pred == "und")
    assert {r.doc_id for r in langid.keep(docs, model).collect()} <= {None, 1, 2, 6, 7, 9}


def test_language_without_labels(docs):
    rows = langid.predict(docs, langid.fit(docs, F.lit(False))).collect()
    assert len(rows) == expected(docs) and all(r.lang_pred == "und" for r in rows)


def test_near_duplicates(docs):
    rows = minhash_forest.near(docs).collect()
    assert len(rows) == expected(docs)
    found = {r.id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.id is not None}
    if rows:
        assert found[1] == (3, 1, True) and found[2] == (3, 1, False) and found[3] == (0, 3, True) and found[5] == (0, 5, True)
        assert found[4] == (0, 4, True) and found[6] == (5, 6, True) and found[8] == (1, 8, True)
        assert all(r.component_id is None and r.kept for r in rows if r.id is None)


def test_exact_index(docs):
    rows = exact_index.dedup(docs).collect()
    assert len(rows) == expected(docs)
    if rows:
        by = {(r.id, r.group_size): r for r in rows}
        assert by[1, 4].kept and by[2, 4].keep_id == 1 and not by[None, 4].kept
        assert by[3, 3].kept and by[4, 3].keep_id == 3 and by[None, 3].keep_id == 3
    stay = exact_index.keep(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect() if r.doc_id is not None) == ([1, 3, 5, 6, 7, 8, 9] if rows else [])


def test_exact_index_keeps_one_of_repeated_rows(spark):
    rows = spark.createDataFrame([(5, "only here"), (5, "only here"), (6, "else"), (6, "other")], "doc_id long, text string")
    assert sorted(map(tuple, exact_index.keep(rows).collect())) == [(5, "only here"), (6, "else"), (6, "other")]


def test_exact_index_keeps_each_of_several_repeated_texts(spark):
    rows = [(5, "a"), (5, "a"), (5, "b"), (5, "b"), (None, "c"), (None, "c"), (None, "d"), (None, "d"), (None, "e"), (None, "a")]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    # The copy without id of a text that 5 has goes; all other texts stay once.
    stay = sorted(map(tuple, exact_index.keep(rows).collect()), key=str)
    assert stay == [(5, "a"), (5, "b"), (None, "c"), (None, "d"), (None, "e")]


def test_pipeline_stages(spark, docs, tmp_path):
    named = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, named, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and out.dtypes == named.dtypes
        out.write.parquet(str(tmp_path / name))
        named = spark.read.parquet(str(tmp_path / name))
    assert (named.count() > 0) == (expected(docs) > 0)


@pytest.mark.parametrize("empty", [False, True])
def test_embeddings(spark, empty):
    on_workers(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1.0, 0.1]), (None, [0.0, 1.0]), (11, [0.0, 1.0]), (12, [1e-30, 0.0]),
    ]
    vectors = clashing(spark.createDataFrame([] if empty else rows, "vec_id long, embedding array<float>"))
    out = embed_dedup.link(vectors).collect()
    assert len(out) == (0 if empty else len(rows))
    if not empty:
        found = {r.id: (r.n_links, r.component_id, r.kept) for r in out if r.id is not None}
        assert found[1] == (4, 1, True) and found[2] == (4, 1, False) and found[10] == (4, 1, False) and found[12] == (4, 1, False)
        assert all(found[i] == (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9))
        assert found[11] == (1, 11, True)


@pytest.mark.parametrize("empty", [False, True])
def test_pages(spark, empty):
    on_workers(spark)
    rows = [
        (1, "http://A.example.org/en/1?x", "<article><p>one</p></article>"), (1, "http://A.example.org/en/1?x", "<article><p>one</p></article>"),
        (2, None, None), (3, "", ""), (4, "no scheme", "<p>"), (5, "http://", "<" * 5000), (None, "x://h", "text &amp"),
        (6, "http://long/" + "p" * 20_000, "<article>" + "<p>w</p>" * 5000),
    ]
    pages = clashing(spark.createDataFrame([] if empty else rows, "page_id long, url string, html string"))
    judged = url_filter.judge(pages).collect()
    texts = html_main.extract(pages).collect()
    assert len(judged) == len(texts) == (0 if empty else len(rows))
    if not empty:
        by = {r.id: r for r in judged}
        assert (by[1].host, by[1].path, by[1].rule, by[1].verdict) == ("a.example.org", "/en/1", "example.org/en/1", "block")
        assert all((by[i].host, by[i].path, by[i].rule) == ("", "", None) for i in (2, 3, 4, 5))
        found = {r.id: r.text for r in texts}
        assert found[1] == "one" and found[2] == found[3] == found[4] == "" and found[None] == "text &" and found[6].count("\n\n") == 4999
