import json

from pyspark.sql import functions as F

from corpusprep.operators import chat
from corpusprep.sources import ingest

ROWS = [
    {"id": "given", "instruction": " Ask ", "input": "", "output": " Answer "},
    {"id": 0, "instruction": "Ask", "input": " More ", "output": "Answer"},
    {"instruction": ["Translate", " this "], "input": None, "output": ["a", 5, "b"]},
    {"instruction": [5, "x"], "output": "Answer"},
    {"instruction": "Ask", "output": "  "},
    {"instruction": "Ask", "output": 7},
]


def test_messages_from_records(spark, tmp_path, lines_file):
    path = lines_file(tmp_path / "r.jsonl", [json.dumps(r) for r in ROWS] + ["", "broken"])
    text = chat.fields_as_text(ingest.jsonl(spark, path))
    out = chat.to_messages(text, F.col("src_row")).collect()
    assert [[tuple(m) for m in r.messages] for r in out] == [
        [("user", "Ask"), ("assistant", "Answer")],
        [("user", "Ask\n\nMore"), ("assistant", "Answer")],
        [("user", "Translate this"), ("assistant", "a b")],
    ]
    assert out[0].id == "given"
    assert [r.id.rsplit("-", 1)[0] for r in out[1:]] == ["sample-1", "sample-2"]
    assert all(len(r.id.rsplit("-", 1)[1]) == 8 and int(r.id.rsplit("-", 1)[1], 16) >= 0 for r in out[1:])
    # The blank line counts nowhere, the broken one as dropped.
    assert chat.conversion_counts(text).first().asDict() == {"kept": 3, "dropped": 4}


def test_training_text(spark):
    df = spark.createDataFrame([("Hi", "there", "Hello", "hindi", 1), ("Hi", None, "Hello", None, 2)], "instruction string, input string, output string, language string, n int")
    out = chat.training_text(df)
    assert out.columns == ["n", "text"]
    assert [r.text for r in out.collect()] == [
        "<|im_start|>user\nHi there<|im_end|>\n<|im_start|>assistant\nHello<|im_end|>\n",
        "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nHello<|im_end|>\n",
    ]
    # Columns that are missing are simply not dropped.
    assert chat.training_text(df.drop("input", "language")).columns == ["n", "text"]


def test_prompt_chat(spark):
    got = spark.range(1).select(chat.prompt_chat(F.lit("नमस्ते"))).first()[0]
    assert got == "<|im_start|>user\nनमस्ते<|im_end|>\n<|im_start|>assistant\n"
