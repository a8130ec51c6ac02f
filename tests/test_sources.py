import json

from pyspark.sql import functions as F

from corpusprep.operators import validate
from corpusprep.session import materialize
from corpusprep.sources import ingest, records, sinks, templates


def test_turn_arrays(spark):
    messages = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", "b")]), (2, [("system", "s"), ("user", "u"), ("x", "y")]), (3, [("user", "alone")]), (4, [])],
        "id int, messages array<struct<role:string,content:string>>",
    )
    got = [tuple(r) for r in records.from_turns(messages, "messages", "content", "hindi", ["id"]).orderBy("id").collect()]
    assert got == [(1, "a", "", "b", "hindi"), (2, "s", "", "u", "hindi"), (3, "alone", "", None, "hindi"), (4, None, "", None, "hindi")]
    conversations = spark.createDataFrame([([("human", "q"), ("gpt", "r")],)], "conversations array<struct<from:string,value:string>>")
    assert tuple(records.from_turns(conversations, "conversations", "value", "hindi").first()) == ("q", "", "r", "hindi")
    # A conversation cut short ends up as empty, not as an error.
    short = records.from_turns(messages.filter("id = 3"), "messages", "content", "hindi", ["id"])
    assert validate.classify(short, ["id"]).first().status == "empty_fields"


def test_triples_and_answers(spark):
    full = spark.createDataFrame([("i", None, "o")], "instruction string, input string, output string")
    assert tuple(records.from_triples(full, "hinglish").first()) == ("i", "", "o", "hinglish")
    assert tuple(records.from_triples(full.drop("input"), "hindi").first()) == ("i", "", "o", "hindi")
    qa = spark.createDataFrame([("q", "a")], "question string, answer string")
    assert tuple(records.from_qa(qa, "hindi").first()) == ("q", "", "a", "hindi")


def test_documents(spark, tmp_path):
    texts = [" " + "x" * 100 + "\n", "y" * 101, "line one " * 10 + "\n" + "line two " * 10]
    kept = records.from_documents(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert sorted(r.text for r in kept.collect()) == sorted(t.strip() for t in texts if len(t.strip()) > 100)
    # An inner line break makes two corpus lines of one document.
    sinks.text(kept, str(tmp_path / "wiki"))
    assert ingest.lines(spark, str(tmp_path / "wiki")).count() == 3


def test_a_failing_source_is_left_out(spark):
    good = spark.createDataFrame([("q", "a")], "question string, answer string")

    def broken():
        raise OSError("not there")

    sources = [
        records.Source("good", lambda: records.from_qa(good, "hindi")),
        records.Source("missing", lambda: spark.read.parquet("/nonexistent/path")),
        records.Source("wrong_schema", lambda: records.from_qa(good.drop("answer"), "hindi")),
        records.Source("broken", broken),
        records.Source("wiki", lambda: records.from_documents(spark.createDataFrame([("x" * 200,), ("short",)], "text string")), corpus=True),
    ]
    loaded, failures = records.load_all(sources)
    assert set(failures) == {"missing", "wrong_schema", "broken"}
    assert {(r.source, r.n_rows) for r in records.source_counts(loaded).collect()} == {("good", 1), ("wiki", 1)}
    assert tuple(records.source_totals(loaded).first()) == (1, 1)
    assert {"instruction", "text"} <= set(loaded.columns)
    without, _ = records.load_all(sources, skip_corpus=True)
    assert records.source_counts(without).count() == 1
    assert records.load_all([sources[3]]) == (None, {"broken": "not there"})


def test_unknown_fields_survive_and_nulls_are_written(spark, tmp_path, lines_file):
    rows = [
        {"instruction": "Keep all", "input": None, "output": "of these", "tags": ["a", 1], "n_tokens": 99, "meta": {"k": 0.5}},
        {"instruction": "हिंदी में", "output": "लिखें", "language": "hindi"},
    ]
    path = lines_file(tmp_path / "in.jsonl", [json.dumps(r, ensure_ascii=False) for r in rows])
    judged = validate.classify(ingest.sft_records(ingest.jsonl(spark, path)), ingest.ORDER)
    out = str(tmp_path / "out")
    sinks.record_splits(ingest.lines(spark, path), judged.withColumn("split", F.lit("train")), out, ingest.ORDER, ingest.ORDER[:2])
    written = [r.value for r in spark.read.text(out + "/split=train").collect()]
    assert sorted(map(json.loads, written), key=str) == sorted([{**r, "n_tokens": None} for r in rows], key=str)
    assert any("हिंदी" in line for line in written)


def test_lines_are_moved_once_and_meet_their_marks(spark, tmp_path, lines_file, small_splits):
    for name in ("b", "a"):
        lines_file(tmp_path / f"{name}.jsonl", [json.dumps({"file": name, "line": i, "n\u005ftokens": 1} if i % 50 == 0 else {"file": name, "line": i}) for i in range(400)])
    lines = ingest.lines(spark, str(tmp_path))
    # Marks as they are after a job of their own; every third line goes out.
    number = F.get_json_object("text", "$.line").cast("int")
    marks = lines.filter(number % 3 == 0).select(*ingest.ORDER, F.when(number % 2 == 0, "x").otherwise("y").alias("split"), number.alias("n_tokens"))
    marks = materialize(marks, "marks", str(tmp_path / "_work"))
    placed = sinks.record_lines(lines, marks, ingest.ORDER, ingest.ORDER[:2])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    sinks.record_splits(lines, marks, str(tmp_path / "out"), ingest.ORDER, ingest.ORDER[:2])
    for split, odd in (("x", 0), ("y", 1)):
        back = [json.loads(r.text) for r in ingest.lines(spark, f"{tmp_path}/out/split={split}").orderBy(*ingest.ORDER).collect()]
        assert back == [{"file": name, "line": i, "n_tokens": i} for name in "ab" for i in range(0, 400, 3) if i % 2 == odd]


def test_typed_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "train"), ("b", 5, "val"), ("c", 6, "train")], "text string, n_tokens int, split string")
    sinks.splits(df, str(tmp_path / "s"))
    assert json.loads(spark.read.text(str(tmp_path / "s/split=train")).orderBy("value").first().value) == {"text": "a", "n_tokens": None}
    sinks.jsonl(df.select(F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages")), str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).count() == 3


def synth_inputs(spark):
    categories = ["casual", "qa", "code", "translate", "story"]
    t = [(c, i, p, f"{c} template {p}") for i, c in enumerate(categories) for p in range(8)]
    r = [(c, p, f"{c} reply {p}") for i, c in enumerate(categories[:-1]) for p in range(3 + i)]
    return (
        spark.createDataFrame(t, "category string, category_pos int, template_pos int, template string"),
        spark.createDataFrame(r, "category string, response_pos int, response string"),
    )


def test_synthesis_counts(spark):
    t, r = synth_inputs(spark)
    rows = templates.from_templates(t, r, 200, hinglish=("casual",))
    counts = {x.category: x.n_rows for x in templates.category_counts(rows).collect()}
    assert counts == {"casual": 208, "qa": 208, "code": 208, "translate": 208, "story": 168}
    got = rows.collect()
    assert all(x.instruction == f"{x.category} template {x.idx % 8}" for x in got)
    assert {x.output for x in got if x.category == "qa"} == {f"qa reply {p}" for p in range(4)}
    assert {x.output for x in got if x.category == "story"} == {templates.NO_RESPONSE}
    assert {x.category for x in got if x.language == "hinglish"} == {"casual"}
    assert sorted(got) == sorted(templates.from_templates(t.repartition(7), r, 200, hinglish=("casual",)).collect())


def test_jsonl_order_over_splits(spark, tmp_path, lines_file, small_splits):
    for name in ("b", "a"):
        lines_file(tmp_path / f"{name}.jsonl", [json.dumps({"n": f"{name}{i:04d}", "pad": "x" * 40}) for i in range(200)])
    df = ingest.jsonl(spark, str(tmp_path / "*.jsonl"))
    got = [r.n for r in df.orderBy(*ingest.ORDER).select(F.try_variant_get(F.col("fields")["n"], "$", "string").alias("n")).collect()]
    assert got == [f"{x}{i:04d}" for x in "ab" for i in range(200)]
    assert df.rdd.getNumPartitions() > 4


def test_ranges_follow_the_size_of_the_texts(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else f"{i} " * 50, "x" * (i % 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string, more string").repartition(5)
    held = sum(len(t or "") + len(m) for _, t, m in rows)
    for limit, least, files in ((1 << 20, 1, 1), (1 << 20, 3, 3), (5000, 3, -(-held // 5000))):
        placed = sinks.in_order(df, "id", least=least, range_bytes=limit)
        assert placed.rdd.getNumPartitions() == files
        sizes = [sum(len(r.text or "") for r in part) for part in placed.rdd.glom().collect()]
        assert max(sizes) <= 2 * max(limit, held / least)
        sinks.jsonl(placed, f"{tmp_path}/{limit}-{least}")
        read = [json.loads(x)["id"] for f in sorted((tmp_path / f"{limit}-{least}").glob("part-*")) for x in f.read_text().splitlines()]
        assert read == list(range(400))
    assert sinks.in_order(df.limit(0), "id").count() == 0


def test_lines_are_numbered_where_they_are(spark, tmp_path, lines_file, small_splits):
    """No line is moved, whatever size the splits are taken for."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        path = lines_file(tmp_path / "a.txt", [f"line {i}" for i in range(900)])
        numbered = ingest.with_line_number(ingest.ordered_text(spark, path), ingest.line_starts(spark, path))
        assert sorted((r.line_no, r.text) for r in numbered.collect()) == [(i, f"line {i}") for i in range(900)]
        assert "BroadcastHashJoin" in numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
