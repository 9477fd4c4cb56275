"""Lines of a manifest are parsed once."""

from vocalake.operators import validation as V


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([(1, '{"text": "a", "audio": "p"}'), (2, "x"), (3, None), (4, " "), (5, "1, 2"), (6, "null"), (7, '{"text": null, "audio": "q"} ')], "line_no bigint, raw string")
    media = spark.createDataFrame([("p", 1, 16000, True, 1.0)], "path string, frames bigint, sample_rate int, readable boolean, duration double")
    out = V.checked(lines, media)
    got = {r.sample_id: (r.line_errors, r.media_error, r.valid) for r in out.collect()}
    assert got == {1: ([], None, True), 2: (["invalid_json"], None, False), 3: (["invalid_json"], None, False), 5: (["invalid_json"], None, False), 6: (["not_object"], None, False), 7: ([], "not_found", False)}
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parse_json") + plan.count("parsejson") == 1
