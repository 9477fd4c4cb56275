from pyspark.sql import functions as F

from vocalake.functions import nested as N
from vocalake.functions import text as T


def _one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


def test_numbers_are_spelt(spark):
    for digits, words in {"0": "zero", "42": "forty-two", "100": "one hundred", "101": "one hundred and one", "1001": "one thousand and one", "1999": "one thousand, nine hundred and ninety-nine", "1000000": "one million", "007": "zero zero seven", "12000": "twelve thousand"}.items():
        assert _one(spark, f"a{digits}b", T.spell_numbers) == f"a{words}b"


def test_utterances(spark):
    en = lambda c: T.split_utterances(c, "en")
    assert _one(spark, "A b. C d? tail", en) == ["A b.", " C d?"]
    assert _one(spark, "no mark", en) == ["no mark."]
    assert _one(spark, 'He said "go." Then?! Left.', en) == ['He said "go."', " Then?", " Left."]
    assert _one(spark, '."A.', en) == ["A."]
    assert _one(spark, "你好。世界！尾", lambda c: T.split_utterances(c, "zh")) == ["你好。", "世界！"]


def test_packed_utterances(spark):
    got = _one(spark, "x" * 50 + "." + "y" * 40 + "." + "z.", lambda c: T.pack_utterances(T.split_utterances(c, "en"), F.length, 80, 40, 20))
    assert got == ["x" * 50 + ".", "y" * 40 + ".z."]


def test_markdown_and_emoji(spark):
    assert _one(spark, "## T\n\n- a `b` [c](d) ![e](f) <i>g</i>\n```x\ny```", T.clean_markdown) == "T\na  c  g"
    assert _one(spark, "ok \U0001f600 ❤️ 1️ 2", T.strip_emoji) == "ok    2"
    assert _one(spark, "你 好 a b c　d", T.tighten_blanks) == "你好a b c　d"


def test_tracks(spark):
    row = spark.sql("SELECT array(7, 8) AS ids, 3 AS a, 2 AS r, false AS p")
    got = row.select(N.pack_target(F.col("ids"), F.col("a"), F.col("p")).alias("x")).first()["x"]
    assert got["tokens"] == [7, 8, 101, 0, 0, 0, 102] and got["text_mask"] == [1, 1, 1, 0, 0, 0, 1] and got["audio_mask"] == got["loss_mask"] == [0, 0, 0, 1, 1, 1, 0] and got["labels"] == [0, 0, 0, 0, 0, 1, 0]
    got = spark.sql("SELECT array(7) AS ids, 2 AS a, 2 AS r").select(N.pack_with_reference(F.col("r"), F.col("ids"), F.col("a")).alias("x")).first()["x"]
    assert got["tokens"] == [103, 0, 0, 104, 7, 101, 0, 0, 102] and got["audio_mask"] == [0, 1, 1, 0, 0, 0, 1, 1, 0] and got["loss_mask"] == [0, 0, 0, 0, 0, 0, 1, 1, 0] and got["labels"].index(1) == 7


def test_bucketize(spark):
    assert [r[0] for r in spark.sql("SELECT explode(array(20000, 20001, 48000)) AS v").select(N.bucketize(F.col("v"))).collect()] == [0, 1, 3]
