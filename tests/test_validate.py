import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from corpusprep.functions.hashing import pair_digest, short_key
from corpusprep.functions.tokenizers import ArrowTokenizer
from corpusprep.operators import dedup, report, validate
from corpusprep.sources import ingest


def judged(spark, *paths, **kw):
    records = ingest.sft_records(ingest.jsonl(spark, list(paths)))
    return validate.classify(records, ingest.ORDER, **kw)


def statuses(df):
    return [r.status for r in df.orderBy(*ingest.ORDER).collect()]


def record(instruction="Write a poem", output="Roses are red", **more):
    return json.dumps({"instruction": instruction, "input": "", "output": output, "language": "hindi", **more}, ensure_ascii=False)


BAD = [
    ("", None),
    ("   　", None),
    ("not json", "malformed"),
    ("null", "malformed"),
    ("[1, 2]", "malformed"),
    ("5", "malformed"),
    ('"text"', "malformed"),
    (record(instruction=["a", "b"]), "malformed"),
    (record(instruction=0), "empty_fields"),
    (record(instruction=7), "malformed"),
    (record(instruction=None), "empty_fields"),
    (record(output=["one", "two"]), "malformed"),
    (record(output=[]), "empty_fields"),
    (record(output={}), "empty_fields"),
    (record(output=True), "malformed"),
    (record(output=False), "empty_fields"),
    ("{}", "empty_fields"),
    ('{"instruction": 3, "instruction": "said twice", "output": "last wins"}', "valid"),
    (record(output="junk follows") + " junk", "malformed"),
    (record(output="another follows") + record(output="b"), "malformed"),
    (record(output="a list follows") + "," + record(output="b"), "malformed"),
    (record(output="closed early") + "] }", "malformed"),
    (record(output="nested ok", extra=[{"a": [{}]}]), "valid"),
    ('{"instruction": "not a number", "output": "ok then", "score": NaN}', "valid"),
    ("{'instruction': 'single quotes', 'output': 'are no JSON'}", "malformed"),
    (record(instruction=" a "), "empty_fields"),
    (record(instruction=" abc "), "valid"),
    (record(output=" a "), "empty_fields"),
    (record(instruction="two chars", output=" ab "), "valid"),
]


def test_bad_lines(spark, tmp_path, lines_file):
    path = lines_file(tmp_path / "bad.jsonl", [line for line, _ in BAD])
    assert statuses(judged(spark, path)) == [s for _, s in BAD if s]


def test_first_wins_across_files(spark, tmp_path, lines_file, small_splits):
    long = "x" * 6000
    a = [record(input="first"), record(instruction=long), record(instruction="write a poem")]
    b = [record(input="second"), record(instruction=long, input="again"), record(output="Roses are red ")]
    # Written in the other order: names decide, not times.
    second = lines_file(tmp_path / "b.jsonl", b * 40)
    first = lines_file(tmp_path / "a.jsonl", a)
    df = judged(spark, first, second).cache()
    assert statuses(df)[:6] == ["valid", "too_long", "valid", "duplicates", "duplicates", "valid"]
    assert statuses(df)[6:] == ["duplicates"] * 117
    kept = {r.input for r in df.filter("status = 'valid' and instruction = 'Write a poem' and output = 'Roses are red'").collect()}
    assert kept == {"first"}


@pytest.mark.parametrize(
    "n, status",
    [(2048, "valid"), (2049, "borderline"), (5120, "borderline"), (5121, "too_long")],
)
def test_length_edges(spark, n, status):
    got = spark.range(1).select(validate.length_class(F.lit(n), 1024)).first()[0]
    assert got == status


def test_prompt_ignores_output_and_null_input(spark, tmp_path, lines_file):
    rows = [
        record(instruction="short one", output="y" * 9000),
        record(instruction="i" * 2048, input=None, output="null input adds nothing"),
        record(instruction="i" * 2046, input="j", output="one char over by the space") + "",
        record(instruction="k " * 2500, input="", output="borderline, many pieces"),
    ]
    df = judged(spark, lines_file(tmp_path / "l.jsonl", rows))
    got = [(r.status, r.n_tokens) for r in df.orderBy(*ingest.ORDER).collect()]
    assert got == [("valid", None), ("valid", None), ("valid", None), ("too_long", 2500)]
    whole = judged(spark, lines_file(tmp_path / "l.jsonl", rows), include_output=True, exact=True)
    assert [r.status for r in whole.orderBy(*ingest.ORDER).collect()] == ["too_long", "valid", "valid", "too_long"]


# Parts of records by what is to become of them. Pieces of the tokenizer have three characters, and a
# record may have 1,024 of them: eight words of 300 letters are 800 pieces, 1,100 single letters as many pieces.
SHORT_FIELDS = [("", "fine"), (" a ", "fine"), ("\t\n", "fine"), ("good enough", ""), ("good enough", " x ")]
INPUTS = {
    "valid": ["", "some input", "w" * 300 + " " + "v" * 300, " ".join(["w" * 300] * 8)],
    "too_long": [" ".join("b" * 1100), "c" * 6000, " ".join(["word"] * 1200)],
}


def scripted(rng, n):
    """(instruction, input, output, status) of ``n`` records, each made for the status; a third repeat one record."""
    rows, passed = [], []
    for i in range(n):
        status = rng.choice(["empty_fields", "valid", "valid", "too_long", "duplicates", "hot"])
        if status == "empty_fields":
            instruction, output = rng.choice(SHORT_FIELDS)
            rows.append((instruction, rng.choice(INPUTS["valid"]), output, status))
        elif status == "duplicates" and passed:
            instruction, output = rng.choice(passed)
            # Whatever the input: neither it nor the length is looked at any more.
            rows.append((instruction, rng.choice(INPUTS["valid"] + INPUTS["too_long"]), output, status))
        elif status == "hot" or status == "duplicates":
            rows.append(("the hot record", "", "same answer", "duplicates" if ("the hot record", "same answer") in passed else "valid"))
            passed.append(("the hot record", "same answer"))
        else:
            rows.append((f"record {i}", rng.choice(INPUTS[status]), rng.choice(["ok", f"answer {i}"]), status))
            passed.append((rows[-1][0], rows[-1][2]))
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 13])
def test_every_record_gets_the_status_it_was_made_for(spark, partitions):
    rows = scripted(random.Random(partitions), 600)
    assert {r[3] for r in rows} == {"empty_fields", "valid", "too_long", "duplicates"}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        df = spark.createDataFrame([(i, *r[:3]) for i, r in enumerate(rows)], "id bigint, instruction string, input string, output string")
        got = validate.classify(df.repartition(partitions), ["id"]).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r.status for r in got] == [r[3] for r in rows]


def test_counts_add_up(spark, tmp_path, lines_file):
    path = lines_file(tmp_path / "bad.jsonl", [line for line, _ in BAD])
    row = report.status_counts(judged(spark, path)).first()
    assert row.total == sum(row[s] for s in validate.STATUSES) == sum(1 for _, s in BAD if s)


def test_dedup_key_and_idempotence(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, "A", "b"), (4, "ab", ""), (5, None, "हिंदी")], "id bigint, i string, o string")
    digest = pair_digest(F.col("i"), F.col("o"))
    keys = {r.id: r.k for r in df.select("id", short_key(digest).alias("k")).collect()}
    assert keys[5] == hashlib.sha256("\x00हिंदी".encode()).hexdigest()[:16]
    once = dedup.first_wins(df, digest, ["id"])
    assert sorted(r.id for r in once.collect()) == [1, 3, 4, 5]
    assert dedup.first_wins(once, digest, ["id"]).count() == 4


def words_loader():
    """A stand-in tokenizer that fails on texts it should never see."""

    # Defined here, so that it travels to the workers by value.
    class ByWords:
        def encode_batch(self, texts):
            assert all(len(t) > 2048 for t in texts)
            return [list(range(len(t.split()))) for t in texts]

    def load():
        return ByWords()

    return load


def test_python_tokenizer_sees_borderline_rows_only(spark):
    rows = [(i, "w " * n + "end", "", f"output {i}") for i, n in enumerate([5, 1500, 1020, 1030, 4000, 1022, 1023])]
    df = spark.createDataFrame(rows, "id bigint, instruction string, input string, output string")
    out = validate.classify(df, ["id"], tokenizer=ArrowTokenizer(words_loader(), batch_size=2))
    got = {r.id: (r.status, r.n_tokens) for r in out.collect()}
    # 1,022 words are 2,047 characters: settled without tokens.
    assert got == {
        0: ("valid", None), 1: ("too_long", 1501), 2: ("valid", None), 3: ("too_long", 1031),
        4: ("too_long", None), 5: ("valid", None), 6: ("valid", 1024),
    }


def test_python_tokenizer_is_planned_once(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.col("text").alias("instruction"), F.lit("").alias("input"), F.lit("answer").alias("output")
    )
    out = validate.valid_records(validate.classify(df, ["doc_id"], tokenizer=ArrowTokenizer(words_loader())))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_no_text_in_the_join_for_counts(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", F.col("text").alias("instruction"), F.col("source").alias("input"), F.col("lang").alias("output")
    )
    plan = report.status_counts(validate.classify(df, ["doc_id"]))._jdf.queryExecution().optimizedPlan().toString()
    join_output = plan[plan.index("Join"):].split("\n")[1]
    assert "instruction" not in join_output and "text" not in join_output


def test_lcpt_lines(spark, tmp_path, lines_file):
    rows = ["x" * 9, "  " + "x" * 9 + "  ", "x" * 10, "y" * 4096, "y" * 4097, "y" * 10240, "y" * 10241, "z " * 2100, "", "ab " * 2049]
    df = ingest.lines(spark, lines_file(tmp_path / "lcpt.txt", rows))
    out = validate.lcpt_lines(df)
    got = [(r.status, r.n_tokens) for r in out.orderBy(*ingest.ORDER).collect()]
    assert got == [("valid", None), ("valid", None), ("valid", 1366), ("too_long", 3414), ("too_long", None), ("too_long", 2100), ("too_long", 2049)]
    assert report.lcpt_counts(out).first().asDict() == {"kept": 3, "total": 7, "too_long": 4}


def test_strict_reader(spark, tmp_path, lines_file):
    good = lines_file(tmp_path / "good.jsonl", [record(), record(output="more")])
    assert ingest.jsonl(spark, good, strict=True).count() == 2
    for name, line in (("blank", ""), ("bad", "{")):
        path = lines_file(tmp_path / f"{name}.jsonl", [record(), line])
        with pytest.raises(Exception, match="bad JSON line"):
            ingest.jsonl(spark, path, strict=True).collect()
