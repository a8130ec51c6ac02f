import json

import pytest

from corpusprep.__main__ import main
from corpusprep.plans import jobs
from corpusprep.sources import records


@pytest.fixture
def raw(tmp_path, lines_file):
    folder = tmp_path / "raw"
    folder.mkdir()
    rows = [{"instruction": f"question {i}", "input": "", "output": f"उत्तर {i}", "language": "hindi" if i % 3 else "hinglish", "extra": i} for i in range(203)]
    rows += [{"instruction": "question 7", "input": "again", "output": "उत्तर 7"}, {"instruction": "x", "output": "y"}]
    rows += [{"instruction": "no language", "output": "here"}, {"instruction": "long " * 1500, "output": "text"}]
    lines_file(folder / "a.jsonl", [json.dumps(r, ensure_ascii=False) for r in rows[:150]] + ["", "broken"])
    lines_file(folder / "b.jsonl", [json.dumps(r, ensure_ascii=False) for r in rows[150:]])
    lines_file(folder / "c.txt", ["short", "a line of the corpus", "लंबी पंक्ति " * 1000, "another line here"])
    return folder


def test_validate_split_report_convert(spark, tmp_path, raw, small_splits):
    out = str(tmp_path / "out")
    row = jobs.validate_files(spark, f"{raw}/*.jsonl", f"{raw}/*.txt", out, vocab_size=64000).first().asDict()
    assert row.pop("wall_time_seconds") > 0
    languages = row.pop("language_distribution")
    assert row == {
        "total_rows_read": 208, "malformed": 1, "unreadable": 0, "tokenizer": "pieces by pattern", "empty_fields": 1, "duplicates_removed": 1, "valid": 204, "too_long": 1,
        "splits": {"train": 163, "val": 20, "test": 21, "total": 204}, "lcpt_kept": 2, "tokenizer_vocab_size": 64000,
    }
    train = [json.loads(r.value) for r in spark.read.text(f"{out}/sft/split=train").collect()]
    assert len(train) == 163 and all(r["n_tokens"] is None for r in train)
    assert all(r["extra"] == int(r["output"].split()[1]) for r in train if "extra" in r)
    want = {}
    for r in train:
        want[r.get("language", "unknown")] = want.get(r.get("language", "unknown"), 0) + 1
    assert languages == want
    assert sorted(r.value for r in spark.read.text(f"{out}/lcpt_corpus").collect()) == ["a line of the corpus", "another line here"]

    counts = jobs.convert_messages(spark, f"{out}/sft/split=train", str(tmp_path / "messages")).first()
    assert (counts.kept, counts.dropped) == (163, 0)
    text = jobs.sft_training(spark, f"{out}/sft/split=train", 40).collect()
    assert len(text) == 40 and all(r.text.startswith("<|im_start|>user\n") for r in text)
    # What was written validates again without loss.
    again = jobs.validate_files(spark, f"{out}/sft/*", None, str(tmp_path / "again")).first()
    assert (again.total_rows_read, again.valid, again.lcpt_kept) == (204, 204, 0)


def test_same_split_however_files_are_cut(spark, tmp_path, raw):
    def train(name):
        out = str(tmp_path / name)
        jobs.validate_files(spark, f"{raw}/*.jsonl", None, out)
        return {r.value for r in spark.read.text(f"{out}/sft/split=train").collect()}

    whole = train("whole")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    try:
        assert train("cut") == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parallel_file(spark, tmp_path, lines_file, small_splits):
    lines = [x for i in range(120) for x in (f"EN: story {i} " + "word " * 20, f"HI: कहानी {i} " + "शब्द " * 40)]
    path = lines_file(tmp_path / "tiny.txt", lines)
    counts = jobs.parse_parallel(spark, path, str(tmp_path / "stories"), str(tmp_path / "pairs"), max_pairs=25, max_stories=50).first()
    assert counts.asDict() == {"pairs": 120, "eligible": 120, "stories": 50}
    stories = {r.value for r in spark.read.text(str(tmp_path / "stories")).collect()}
    assert stories == {x[4:].strip() for x in lines[1:100:2]}
    rows = spark.read.json(str(tmp_path / "pairs")).collect()
    assert len(rows) == 25 and set(rows[0].asDict()) == {"instruction", "input", "output", "language"}
    examples = jobs.lcpt_training(spark, str(tmp_path / "stories"), max_stories=30, max_len=64)
    # 83 pieces each: one full window, and a rest that is too short.
    assert [len(r.tokens) for r in examples.collect()] == [64] * 30


def test_sources_to_files(spark, tmp_path):
    qa = spark.createDataFrame([("q", "a"), ("r", "b")], "question string, answer string")
    wiki = spark.createDataFrame([("w" * 150,), ("short",)], "text string")
    counts, failures = jobs.collect_sources(
        [
            records.Source("qa", lambda: records.from_qa(qa, "hindi")),
            records.Source("gone", lambda: spark.read.json("/nonexistent")),
            records.Source("wiki", lambda: wiki, corpus=True),
        ],
        str(tmp_path / "sft"),
        str(tmp_path / "corpus"),
    )
    assert {r.source: r.n_rows for r in counts.collect()} == {"qa": 2, "wiki": 2} and list(failures) == ["gone"]
    assert spark.read.json(f"{tmp_path}/sft/source=qa").count() == 2
    assert spark.read.text(f"{tmp_path}/corpus").count() == 1


def test_command_line(spark, tmp_path, raw):
    main(["validate", "--jsonl", f"{raw}/a.jsonl", f"{raw}/b.jsonl", "--out", f"{tmp_path}/cli"])
    main(["messages", "--jsonl", f"{tmp_path}/cli/sft/split=val", "--out", f"{tmp_path}/messages"])
    main(["sft-examples", "--jsonl", f"{tmp_path}/cli/sft/split=val", "--out", f"{tmp_path}/sft"])
    assert spark.read.json(f"{tmp_path}/messages").count() == spark.read.json(f"{tmp_path}/sft").count() == 20


def test_command_lines_of_the_other_jobs(spark, tmp_path, lines_file):
    triples = lines_file(tmp_path / "t.json", [json.dumps({"instruction": f"i{n}", "output": f"o{n}"}) for n in range(4)])
    wiki = lines_file(tmp_path / "w.json", [json.dumps({"text": "w" * n}) for n in (50, 150)])
    broken = lines_file(tmp_path / "b.parquet", ["no Parquet at all"])
    given = [("t", "triples", "hindi", triples), ("w", "documents", "-", wiki), ("b", "triples", "hindi", broken)]
    main(["sources", *[x for g in given for x in ("--source", *g)], "--records-out", f"{tmp_path}/sft", "--corpus-out", f"{tmp_path}/corpus"])
    assert spark.read.json(f"{tmp_path}/sft").count() == 4 and spark.read.text(f"{tmp_path}/corpus").count() == 1
    assert not (tmp_path / "sft_work").exists()

    t = lines_file(tmp_path / "templates.json", [json.dumps({"category": "qa", "category_pos": 0, "template_pos": i, "template": f"t{i}"}) for i in range(3)])
    r = lines_file(tmp_path / "responses.json", [json.dumps({"category": "qa", "response_pos": 0, "response": "r"})])
    main(["synthesize", "--templates", t, "--responses", r, "--out", f"{tmp_path}/synth", "--per-category", "7"])
    assert spark.read.json(f"{tmp_path}/synth").count() == 7

    p = lines_file(tmp_path / "prompts.json", [json.dumps({"category": "english_retention", "pos": i, "prompt": f"p{i}"}) for i in range(5)])
    a = lines_file(tmp_path / "answers.json", [json.dumps({"category": "english_retention", "prompt": f"p{i}", "response": "yes" if i else "1"}) for i in range(5)])
    main(["score", "--prompts", p, "--responses", a, "--out", f"{tmp_path}/scored", "--num-tests", "4"])
    assert sorted(x.flag for x in spark.read.json(f"{tmp_path}/scored").collect()) == [False, True, True, True]

    (tmp_path / "in").mkdir()
    lines_file(tmp_path / "in" / "a.jsonl", [json.dumps({"instruction": f"question {n % 3}", "output": "answer"}) for n in range(5)])
    main(["stream", "--input", f"{tmp_path}/in", "--out", f"{tmp_path}/live", "--checkpoint", f"{tmp_path}/check"])
    assert sorted(x.status for x in spark.read.parquet(f"{tmp_path}/live/status").collect()) == ["duplicates"] * 2 + ["valid"] * 3
    assert not list((tmp_path / "live" / "staged").glob("batch_id=*"))


def test_command_lines_that_choose_and_compare(spark, tmp_path, lines_file):
    records = lines_file(tmp_path / "r.jsonl", [json.dumps({"instruction": f"question {n}", "output": "answer", "language": "hi" if n % 4 else "en"}) for n in range(40)])
    for flags in ([], ["--by-tokens"]):
        main(["mix", "--jsonl", records, "--out", f"{tmp_path}/mix{len(flags)}", "--weights", "hi=50,en=50", *flags])
        got = {x.language: x["count"] for x in spark.read.json(f"{tmp_path}/mix{len(flags)}").groupBy("language").count().collect()}
        assert got["hi"] == 10 and 9 <= got["en"] <= 10
    text = lines_file(tmp_path / "t.txt", ["One line", "one  LINE", "two", "One line", ""])
    main(["dedup-lines", "--text", text, "--out", f"{tmp_path}/lines"])
    main(["dedup-lines", "--text", text, "--out", f"{tmp_path}/exact", "--exact"])
    assert [x.value for x in spark.read.text(f"{tmp_path}/lines").collect()] == ["One line", "two"]
    assert [x.value for x in spark.read.text(f"{tmp_path}/exact").collect()] == ["One line", "one  LINE", "two"]
    row = jobs.corpus_report(spark, text).first()
    assert (row.n_chars, row.n_words, row.n_tokens, row.enough) == (8 + 9 + 3 + 8, 7, 10, False)

    said = lines_file(tmp_path / "said.json", [json.dumps({"id": str(i), "candidate": "a b c d e", "reference": "a b c d" + " e" * i}) for i in range(3)])
    row = jobs.overlap_files(spark, said, "candidate", "reference", f"{tmp_path}/rouge").first()
    assert row.f1 == round((8 / 9 + 1 + 10 / 11) / 3, 6) and 0 < row.bleu < 1
    main(["overlap", "--input", said, "--out", f"{tmp_path}/rouge2", "--n", "2"])
    runs = [lines_file(tmp_path / f"{name}.json", [json.dumps({"category": "qa", "pos": i, "flag": i % 4 < good}) for i in range(80)]) for name, good in (("base", 2), ("tuned", 4))]
    row = jobs.gate_files(spark, *runs).first()
    assert (row.category, row.gain, row.improves, row.keeps) == ("qa", 1.0, True, True) and 0 < row.low < 1 < row.high
    main(["gate", "--base", runs[0], "--tuned", runs[1]])
    passages = lines_file(tmp_path / "p.json", [json.dumps({"id": "p", "text": "A  b C"}), json.dumps({"id": "q", "text": "nowhere"})])
    texts = lines_file(tmp_path / "x.json", [json.dumps({"id": str(i), "text": "so a b c it is" if i else "ab c"}) for i in range(3)])
    main(["contained", "--texts", texts, "--passages", passages, "--out", f"{tmp_path}/found"])
    assert sorted((x.passage_id, x.text_id) for x in spark.read.json(f"{tmp_path}/found").collect()) == [("p", "1"), ("p", "2")]


def test_all_rows_on_the_command_line(spark, tmp_path, lines_file):
    lines = [x for i in range(40) for x in (f"EN: story {i} " + "word " * 20, f"HI: कहानी {i} " + "शब्द " * 40)]
    path = lines_file(tmp_path / "p.txt", lines)
    main(["pairs", "--input", path, "--stories-out", f"{tmp_path}/s", "--records-out", f"{tmp_path}/r", "--max-pairs", "all", "--max-stories", "all"])
    assert spark.read.text(f"{tmp_path}/s").count() == spark.read.json(f"{tmp_path}/r").count() == 40
    main(["sft-examples", "--jsonl", f"{tmp_path}/r", "--out", f"{tmp_path}/x", "--max-rows", "all"])
    assert spark.read.json(f"{tmp_path}/x").count() == 40


@pytest.fixture
def unmerged(spark):
    """Partitions are not merged and many, so that order is not kept by chance."""
    new = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_training_subset_keeps_source_order(spark, tmp_path, lines_file, small_splits, unmerged):
    (tmp_path / "raw").mkdir()
    for f in "ab":
        rows = [{"instruction": f"question {f}{i:04d} " + "x" * 40, "output": "an answer"} for i in range(700)]
        lines_file(tmp_path / "raw" / f"{f}.jsonl", [json.dumps(r) for r in rows])
    jobs.validate_files(spark, f"{tmp_path}/raw/*.jsonl", None, str(tmp_path / "out"))
    train = {json.loads(r.value)["instruction"].split()[1] for r in spark.read.text(f"{tmp_path}/out/sft/split=train").collect()}
    assert len(train) == 1120
    got = [r.text.split()[2] for r in jobs.sft_training(spark, f"{tmp_path}/out/sft/split=train", 60).collect()]
    assert sorted(got) == sorted(train)[:60]
    assert not (tmp_path / "out" / "_work").exists()
    running = [(r.src_file[-7:], r.total) for r in spark.read.json(f"{tmp_path}/out/running").orderBy("total").collect()]
    assert running == [("a.jsonl", 700), ("b.jsonl", 1400)]


def test_first_file_by_its_name_on_storage_wins(spark, tmp_path, lines_file):
    (tmp_path / "raw").mkdir()
    for name in ("a!b", "a b", "a%20b", "a#b", "a+b"):
        lines_file(tmp_path / "raw" / f"{name}.jsonl", [json.dumps({"instruction": "the same", "output": "answer", "from": name})])
    jobs.validate_files(spark, f"{tmp_path}/raw", None, str(tmp_path / "out"))
    kept = [json.loads(r.value) for r in spark.read.text(f"{tmp_path}/out/sft").collect()]
    assert [r["from"] for r in kept] == ["a b"]


def test_records_leave_as_they_came(spark, tmp_path, lines_file):
    line = '{"instruction": "keep this", "output": "as it is", "z": 1.0, "a": 1.50, "n": ' + "9" * 60 + ', "s": "\\ud800", "x": NaN}'
    own = '{"instruction": "own count", "output": "replaced", "n_tokens": 7}'
    jobs.validate_files(spark, lines_file(tmp_path / "r.jsonl", [line, own, "{}"]), None, str(tmp_path / "out"))
    written = sorted(r.value for r in spark.read.text(f"{tmp_path}/out/sft").collect())
    assert written[0] == line[:-1] + ', "n_tokens": null}' and json.loads(written[1]) == {**json.loads(own), "n_tokens": None}


def test_texts_are_not_sorted_for_repeats(spark, tmp_path, lines_file):
    path = lines_file(tmp_path / "r.jsonl", [json.dumps({"instruction": "some text", "output": "answer"})])
    parsed = jobs.ingest.sft_records(jobs.ingest.jsonl(spark, path, keep_line=True))
    judged = jobs._judged(parsed, jobs.NativeTokenizer(), str(tmp_path / "work"))
    judged.collect()
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "instruction" not in plan


def test_deep_and_long_values(spark, tmp_path, lines_file):
    deep = "[" * 1100 + "]" * 1100
    rows = ['{"instruction": "deep value", "output": "fine", "v": ' + deep + "}", '{"instruction": "long number", "output": "fine", "v": ' + "1" * 1100 + "}"]
    rows.append(json.dumps({"instruction": "long text", "output": "fine", "v": "x" * 25_000_000}))
    report = jobs.validate_files(spark, lines_file(tmp_path / "r.jsonl", rows), None, str(tmp_path / "out")).first()
    assert (report.valid, report.malformed, report.unreadable, report.tokenizer) == (3, 0, 0, "pieces by pattern")


def test_generated_ids_carry_the_line_of_the_file(spark, tmp_path, lines_file, small_splits):
    (tmp_path / "raw").mkdir()
    for f in "ab":
        rows = [json.dumps({"instruction": f"{f}-{i}", "output": "answer " + "x" * 60}) if i % 7 else "" for i in range(120)]
        lines_file(tmp_path / "raw" / f"{f}.jsonl", [*rows, json.dumps({"id": "own", "instruction": f, "output": "o"})])
    jobs.convert_messages(spark, f"{tmp_path}/raw", f"{tmp_path}/out")
    rows = spark.read.json(f"{tmp_path}/out").collect()
    assert len(rows) == 206 and sum(r.id == "own" for r in rows) == 2
    assert all(r.id.split("-")[1] == r.messages[0].content.split("-")[1] for r in rows if r.id != "own")
