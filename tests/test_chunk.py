
import pytest
from pyspark.sql import functions as F

from corpusprep.functions.tokenizers import ArrowTokenizer, NativeTokenizer
from corpusprep.operators import chunk


@pytest.mark.parametrize("n, sizes", [(0, []), (1, []), (63, []), (64, [64]), (1024, [1024]), (1087, [1024]), (1088, [1024, 64]), (2500, [1024, 1024, 452])])
def test_window_sizes(spark, n, sizes):
    df = spark.createDataFrame([("a " * n,)], "text string")
    rows = chunk.windows(df).orderBy("chunk_no").collect()
    assert [r.n_tokens for r in rows] == sizes
    assert "".join(r.text for r in rows) == " ".join(["a"] * sum(sizes))


def test_windows_rejoin_to_the_text(spark):
    text = "हिंदी कहानी:\n\tएक  लंबी बात " * 300
    rows = chunk.windows(spark.createDataFrame([(7, text)], "id int, text string"), max_len=100, min_len=1).orderBy("chunk_no").collect()
    assert "".join(r.text for r in rows) == text.rstrip(" ") and {r.id for r in rows} == {7}


def test_truncate(spark):
    df = spark.createDataFrame([("abcdefgh ij",), ("",)], "text string")
    assert [r.tokens for r in chunk.truncate(df, max_len=3).collect()] == [["abc", "def", "gh"], []]


def test_native_count_matches_encode(spark):
    tokenizer = NativeTokenizer()
    df = spark.createDataFrame([("ab  cde fghi\n",), ("",), ("   ",), (None,)], "t string")
    assert [tuple(r) for r in df.select(tokenizer.count(F.col("t")), F.size(tokenizer.encode(F.col("t")))).collect()][:3] == [(4, 4), (0, 0), (0, 0)]


def word_level_loader():
    vocab = {"[UNK]": 0, **{f"w{i}": i + 1 for i in range(200)}}
    from tokenizers import Tokenizer, models, pre_tokenizers

    tokenizer = Tokenizer(models.WordLevel(vocab, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    saved = tokenizer.to_str()

    def load():
        from tokenizers import Tokenizer as Loaded

        return Loaded.from_str(saved)

    return load


def test_real_tokenizer_over_arrow(spark):
    text = " ".join(f"w{i % 200}" for i in range(300))
    df = spark.createDataFrame([(1, text), (2, "w1 unknown"), (3, None)], "id int, text string")
    tokenizer = ArrowTokenizer(word_level_loader(), batch_size=1)
    assert [r.n for r in df.select("id", tokenizer.count(F.col("text")).alias("n")).orderBy("id").collect()] == [300, 2, None]
    rows = chunk.windows(df, tokenizer=tokenizer, max_len=128).orderBy("chunk_no").collect()
    assert [r.n_tokens for r in rows] == [128, 128]
    assert " ".join(r.text for r in rows) == " ".join(f"w{i % 200}" for i in range(256))
