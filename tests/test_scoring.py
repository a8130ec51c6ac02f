from corpusprep.operators import scoring
from corpusprep.sources import sinks

PROMPTS = (
    [("hindi", i, f"हिंदी प्रश्न {i}") for i in range(8)]
    + [("hinglish", i, f"sawal {i}") for i in range(6)]
    + [("english_retention", i, f"question {i}") for i in range(4)]
)
RESPONSES = {
    "hindi": ["केवल देवनागरी", "no script", "मिला jula", "", "क", None, "x", "ख"],
    "hinglish": ["केवल देवनागरी", "उत्तर 2", "हाँ bilkul", "only roman", "", "देव!"],
    "english_retention": ["Paris", "ab 12", "हिंदी", "The end"],
}


def scored(spark, num_tests):
    prompts = spark.createDataFrame([(c, p, t, "what it tests") for c, p, t in PROMPTS], "category string, pos int, prompt string, description string")
    responses = spark.createDataFrame([(c, t, RESPONSES[c][p]) for c, p, t in PROMPTS], "category string, prompt string, response string")
    return scoring.score(scoring.attach(prompts, responses, num_tests))


def test_flags(spark):
    got = {(r.category, r.pos): r.flag for r in scored(spark, None).collect()}
    assert [got["hindi", i] for i in range(8)] == [True, False, True, False, True, False, False, True]
    assert [got["hinglish", i] for i in range(6)] == [False, True, True, False, False, False]
    assert [got["english_retention", i] for i in range(4)] == [True, False, False, True]


def test_rates_divide_by_the_request(spark):
    got = {r.category: (r.passed, r.n_rows, r.pass_rate) for r in scoring.pass_rates(scored(spark, 5), 5).collect()}
    assert got == {"hindi": (3, 5, 0.6), "hinglish": (2, 5, 0.4), "english_retention": (2, 4, 0.4)}


def test_result_file(spark, tmp_path):
    sinks.by_category(scoring.results(scored(spark, 2)), str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert {(r.category, r.n) for r in back.groupBy("category").count().withColumnRenamed("count", "n").collect()} == {
        ("hindi", 2), ("hinglish", 2), ("english_retention", 2)
    }
    assert back.filter("category = 'hindi' and pos = 0").first().response == "केवल देवनागरी"
