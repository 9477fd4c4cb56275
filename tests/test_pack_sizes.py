"""Packs of utterances, where the sizes of pieces add up."""

from pyspark.sql import functions as F

from vocalake.functions import text as T


def test_additive_packs_equal_those_that_are_measured_anew(spark):
    texts = ["", "no mark", "One. Two? " * 90, 'He said "no." Then: yes; and “so.” ' * 40, "a" * 300 + ". b. c.", "x1.y2;z3: " * 100 + "tail", "数据。 ok. " * 60, "w. " * 30]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    tokens = lambda x: F.size(T.base_tokens(x))
    for size in (tokens, F.length):
        both = [T.pack_utterances(T.split_utterances(F.col("t"), "en"), size, additive=a) for a in (False, True)]
        for plain, summed in df.select(*both).collect():
            assert plain == summed
    empty = spark.createDataFrame([([],), (["", ""],), (["a.", ""],)], "u array<string>")
    for plain, summed in empty.select(*[T.pack_utterances(F.col("u"), F.length, additive=a) for a in (False, True)]).collect():
        assert plain == summed


def test_pieces_are_measured_once(spark):
    plan = lambda a: spark.range(1).select(T.pack_utterances(F.array(F.lit("a."), F.col("id").cast("string")), lambda x: F.size(T.base_tokens(x)), additive=a).alias("x"))._jdf.queryExecution().analyzed().toString().count("regexp_extract_all")
    assert plan(True) == 1 < plan(False)
