"""Request plans, attempts, dialogues and alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalake.functions.text import SPACE, compose_text
from vocalake.operators import alignment as A
from vocalake.operators import prompts as P
from vocalake.operators import requests as R
from vocalake.registry import query


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def _g(x: str) -> str:
    return f"({_strip(f'''coalesce({x}, '')''')} <> '')"


_P = f"({_g('prompt_text')} OR {_g('prompt_file')})"
_RULES = {
    "blank_text": f"NOT {_g('text')}", "prompt_text_and_file": f"{_g('prompt_text')} AND {_g('prompt_file')}", "prompt_audio_without_text": f"{_g('prompt_audio')} AND NOT {_P}",
    "prompt_text_without_audio": f"{_P} AND NOT {_g('prompt_audio')}", "control_with_prompt_text": f"{_g('control')} AND {_P}", "design_with_audio": f"command = 'design' AND ({_g('prompt_audio')} OR {_g('reference_audio')})",
    "clone_without_audio": f"command = 'clone' AND NOT {_g('prompt_audio')} AND NOT {_g('reference_audio')}", "reference_needs_v2": f"{_g('reference_audio')} AND arch = 'v1'",
    "cfg_range": "NOT cfg BETWEEN 0.1 AND 10", "steps_range": "NOT steps BETWEEN 1 AND 100",
}


@query("p13_request_rules", "SELECT request_id, concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _RULES.items()) + ") AS broken FROM requests", "requests")
def _(r):
    return r.select("request_id", F.array_join(R.violations(), ",").alias("broken"))


_ADAPTED = "(SELECT *, (steps % 9)::INT AS rank, (steps % 7) / 2e0 AS alpha, (steps % 13) / 10e0 AS dropout FROM requests)"


@query("p13_request_findings", "WITH f AS (SELECT DISTINCT prompt_file FROM requests WHERE request_id % 16 < 8) SELECT request_id, concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _RULES.items())
 + f", CASE WHEN {_g('prompt_file')} AND prompt_file NOT IN (SELECT prompt_file FROM f WHERE prompt_file IS NOT NULL) THEN 'prompt_file_missing' END, CASE WHEN NOT (rank > 0 AND alpha > 0 AND dropout BETWEEN 0 AND 1) THEN 'adapter_range' END) AS broken FROM {_ADAPTED}", "requests")
def _(r):
    adapted = r.withColumns({"rank": (F.col("steps") % 9).cast("int"), "alpha": (F.col("steps") % 7) / 2, "dropout": (F.col("steps") % 13) / 10})
    return R.request_findings(adapted, r.where("request_id % 16 < 8").select("prompt_file")).select("request_id", F.array_join("broken", ",").alias("broken"))


def _compose(c: str) -> str:
    return f"CASE WHEN {c} <> '' THEN concat('(', {c}, ')', text) ELSE text END"


@query("p14_compose_text", f"SELECT request_id, {_compose(_strip('''coalesce(control, '')'''))} AS composed, {_compose(_strip('''regexp_replace(coalesce(control, ''), '[()（）]', '', 'g')'''))} AS composed_app FROM requests", "requests")
def _(r):
    return r.select("request_id", compose_text(F.col("text"), F.col("control")).alias("composed"), compose_text(F.col("text"), F.col("control"), True).alias("composed_app"))


_FILES = "f AS (SELECT DISTINCT prompt_file, CASE WHEN prompt_file LIKE '%3.txt' THEN concat(' body of ', prompt_file, chr(10)) ELSE ' ' END AS body FROM requests WHERE prompt_file IS NOT NULL)"


def _full(x: str) -> str:
    return f"nullif({_strip(x)}, '')"


@query("p15_resolve_prompt_text", f"WITH {_FILES} SELECT request_id, coalesce({_full('prompt_text')}, {_full('body')}) AS resolved FROM requests LEFT JOIN f USING (prompt_file)", "requests")
def _(r):
    body = F.when(F.col("prompt_file").endswith("3.txt"), F.concat(F.lit(" body of "), "prompt_file", F.lit("\n"))).otherwise(" ")
    files = r.where("prompt_file is not null").select("prompt_file", body.alias("body")).distinct()
    return R.resolve_prompt_text(r, files).select("request_id", "resolved")


_MODE = "CASE WHEN reference_audio IS NOT NULL AND prompt_audio IS NOT NULL THEN 'ref_continuation' WHEN reference_audio IS NOT NULL THEN 'reference' WHEN prompt_audio IS NOT NULL THEN 'continuation' ELSE 'zero_shot' END"


@query("p16_generation_mode", f"SELECT request_id, {_MODE} AS mode, md5(CASE WHEN prompt_audio IS NOT NULL THEN concat(coalesce(prompt_text, ''), text) ELSE text END) AS text_md5 FROM requests", "requests")
def _(r):
    mode = R.generation_mode(F.col("reference_audio").isNotNull(), F.col("prompt_audio").isNotNull())
    return r.select("request_id", mode.alias("mode"), F.md5(R.effective_text(mode, F.col("prompt_text"), F.col("text"))).alias("text_md5"))


@query("p18_length_budget", "SELECT request_id, least(length(text) * 6 + 10, 2000)::INT AS budget FROM requests", "requests")
def _(r):
    return r.select("request_id", R.length_budget(F.length("text"), 2000).alias("budget"))


@query("p19_badcase", "SELECT request_id, attempt, frames >= target_len * 6 AND attempt % 4 > 0 AS bad FROM attempts", "attempts")
def _(a):
    return a.select("request_id", "attempt", R.badcase(F.col("frames"), F.col("target_len"), 6.0, F.col("attempt") % 4 == 0).alias("bad"))


@query("st5_retry_guard", "SELECT request_id, (steps % 2 = 0) AND NOT (steps % 3 = 0) AS retry, CASE WHEN steps % 2 = 0 AND steps % 3 = 0 THEN 'retry is off while streaming' END AS warning FROM requests", "requests")
def _(r):
    return r.select("request_id", R.retry_guard(F.col("steps") % 2 == 0, F.col("steps") % 3 == 0).alias("g")).select("request_id", "g.retry", "g.warning")


@query("p20_materialise_seed", "SELECT request_id, coalesce(seed & 4294967295, ('0x' || md5(request_id::VARCHAR)[1:8])::BIGINT) AS seed FROM requests", "requests")
def _(r):
    return r.select("request_id", R.materialise_seed(F.col("seed"), F.col("request_id")).alias("seed"))


@query("p21_clip_duration", "SELECT path, round(frames / sample_rate::DOUBLE, 6) AS seconds FROM media", "media")
def _(m):
    return m.select("path", F.round(R.clip_duration(F.col("frames"), F.col("sample_rate")), 6).alias("seconds"))


@query("p22_default_by_position", "SELECT doc_id AS i, coalesce(b.text, 'none') AS text FROM documents d LEFT JOIN benchmark b ON d.doc_id = b.item_id", "documents", "benchmark")
def _(d, b):
    return R.default_by_position(d.select(F.col("doc_id").alias("i")), b.select(F.col("item_id").alias("i"), "text"), "none").select("i", "text")


@query("j5_attach_prompt_cache", "WITH c AS (SELECT voice_id, min(request_id) AS first FROM requests GROUP BY voice_id) SELECT request_id, voice_id, first FROM requests LEFT JOIN c USING (voice_id)", "requests")
def _(r):
    return R.attach_prompt_cache(r, r.groupBy("voice_id").agg(F.min("request_id").alias("first"))).select("request_id", "voice_id", "first")


@query("w4_attempt_resolution", """WITH t AS (SELECT *, frames >= target_len * 6 AS bad FROM attempts WHERE attempt <= 3), r AS (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY bad, CASE WHEN bad THEN -attempt ELSE attempt END) AS k FROM t)
SELECT request_id, attempt, frames, bad, seed + attempt - 1 AS seed FROM r WHERE k = 1""", "attempts")
def _(a):
    return R.attempt_resolution(a)


def _polynomial(text: str, base: int, modulus: int) -> str:
    return f"list_reduce(list_concat([0::BIGINT], list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), lambda a, c: (a * {base} + c) % {modulus})"


# Every turn has a feature for each four characters and one more; the references come with a conversation's third turn.
_TURNS = "t AS (SELECT conv_id, turn, text, length(text) // 4 + 1 AS n_feats, ref_audio IS NOT NULL AND turn >= 2 AS ref FROM dialogue), r AS (SELECT conv_id, turn, string_agg(text, '') OVER w AS prompt, sum(n_feats) OVER w AS feats, bool_or(ref) OVER w AS ref FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"


@query("w5_merge_prompt_cache", f"WITH {_TURNS} SELECT conv_id, turn, {_polynomial('prompt', 1000003, 2147483647)} * 2147483648 + {_polynomial('prompt', 1000033, 2147483629)} AS prompt_hash, length(prompt)::BIGINT AS prompt_chars, feats::BIGINT AS prompt_feats, CASE WHEN ref THEN 'ref_continuation' ELSE 'continuation' END AS mode FROM r", "dialogue")
def _(turns):
    own = turns.withColumns({"n_feats": F.floor(F.length("text") / 4) + 1, "ref_audio": F.when(F.col("turn") >= 2, F.col("ref_audio"))})
    return P.merge_prompts(own)


@query("a12_batch_ledger", "SELECT count(*) AS attempted, count(*) FILTER (frames < 100) AS succeeded, count(*) FILTER (frames >= 100) AS failed FROM attempts", "attempts")
def _(a):
    return R.batch_ledger(a.withColumn("error", F.when(F.col("frames") >= 100, F.concat(F.lit("line "), "attempt"))))


# Lines are requests; what was made of them has no row for every 10th, and an error where the first attempt has too many frames.
_MADE = "lines AS (SELECT request_id AS i, text FROM requests), made AS (SELECT request_id AS i, frames / 25e0 AS duration, CASE WHEN frames >= 100 THEN concat('frames: ', frames::VARCHAR) END AS error FROM attempts WHERE attempt = 1 AND request_id % 10 > 0), res AS (SELECT i, CASE WHEN made.i IS NULL THEN 'no result' ELSE error END AS error, duration FROM lines LEFT JOIN made USING (i))"


def _batch(r, a):
    made = a.where("attempt = 1 and request_id % 10 > 0").select(F.col("request_id").alias("i"), (F.col("frames") / 25).alias("duration"), F.when(F.col("frames") >= 100, F.concat(F.lit("frames: "), F.col("frames").cast("string"))).alias("error"))
    return R.batch_results(r.select(F.col("request_id").alias("i"), "text"), made)


@query("a12_batch_results", f"WITH {_MADE} SELECT i, CASE WHEN error IS NULL THEN duration END AS duration, error FROM res", "requests", "attempts")
def _(r, a):
    return _batch(r, a).select("i", "duration", "error")


@query("a12_batch_failures", f"WITH {_MADE} SELECT i, concat('Failed on line ', i::VARCHAR, ': ', error) AS message FROM res WHERE error IS NOT NULL", "requests", "attempts")
def _(r, a):
    return R.batch_failures(_batch(r, a))


@query("s7_output_naming", "WITH o AS (SELECT request_id, CASE WHEN request_id % 5 = 0 THEN concat('x.y/', request_id::VARCHAR, '.take.mp3') ELSE concat('out/output_', CASE WHEN request_id < 1000 THEN lpad(request_id::VARCHAR, 3, '0') ELSE request_id::VARCHAR END, '.wav') END AS path FROM requests) SELECT request_id, path, concat(regexp_replace(path, '\\.[^./]*$', ''), '.timestamps.json') AS sidecar FROM o", "requests")
def _(r):
    path = R.output_name(F.col("request_id"), "out/", F.when(F.col("request_id") % 5 == 0, F.concat(F.lit("x.y/"), "request_id", F.lit(".take.mp3"))))
    return r.select("request_id", path.alias("path"), R.sidecar_name(path).alias("sidecar"))


# Alignments made of conversations: a segment per turn, words evenly spaced in time.
def _segments(c):
    words = F.transform(F.split("text", " "), lambda w, i: F.struct(F.when(i % 3 > 0, w).alias("word"), w.alias("text"), (i * 0.5).alias("start"), F.when(i % 7 > 0, i * 0.5 + F.length(w) * 0.25).alias("end")))
    return c.select(F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(".wav")).alias("audio"), F.col("turn").alias("pos"), F.concat(F.lit(" "), F.when(F.col("turn") % 5 == 4, "").otherwise(F.col("text")), F.lit("\n")).alias("text"), F.when(F.col("turn") % 4 > 0, F.col("turn") * 2.0).alias("start"), (F.col("turn") * 2.0 + 1.5).alias("end"), words.alias("words"))


_SEG = f"""seg AS (SELECT concat('c', conv_id::VARCHAR, '.wav') AS audio, turn AS pos, {_strip("concat(' ', CASE WHEN turn % 5 = 4 THEN '' ELSE text END, chr(10))")} AS text, CASE WHEN turn % 4 > 0 THEN turn * 2e0 ELSE 0 END AS start, turn * 2e0 + 1.5 AS "end", text AS raw FROM conversations),
w0 AS (SELECT audio, pos, unnest(string_split(raw, ' ')) AS w, unnest(range(len(string_split(raw, ' ')))) AS i FROM seg),
words AS (SELECT audio, pos, i::INT AS wpos, {_strip('w')} AS text, i * 0.5::DOUBLE AS start, CASE WHEN i % 7 > 0 THEN i * 0.5::DOUBLE + length(w) * 0.25::DOUBLE ELSE 0 END AS "end" FROM w0 WHERE {_strip('w')} <> '')"""


@query("n12_segment_items", f"WITH {_SEG} SELECT audio, pos, text, start, \"end\", 'segment' AS level FROM seg WHERE text <> ''", "conversations")
def _(c):
    return A.segment_items(_segments(c))


@query("n12_word_items", f"WITH {_SEG} SELECT audio, pos, wpos, text, start, \"end\", 'word' AS level FROM words", "conversations")
def _(c):
    return A.word_items(_segments(c))


@query("n13_word_to_chars", f"""WITH {_SEG}, k AS (SELECT *, unnest(range(length(text)))::INT AS cpos, greatest("end" - start, 0) / length(text) AS d FROM words)
SELECT audio, pos, wpos, cpos, text[cpos + 1] AS text, round(start + d * cpos, 6) AS start, round(start + d * (cpos + 1), 6) AS "end", 'char' AS level FROM k""", "conversations")
def _(c):
    return A.word_to_chars(A.word_items(_segments(c))).withColumns({k: F.round(k, 6) for k in ("start", "end")})


@query("n14_alignment_record", f"""WITH {_SEG} SELECT audio AS audio_path, 16000 AS sample_rate, 'stable_ts' AS backend, 'segment' AS level, md5(string_agg(text, ' ' ORDER BY pos)) AS text_md5, count(*)::INT AS n_items, string_agg((start * 10)::INT::VARCHAR, ',' ORDER BY pos) AS starts, NULL::VARCHAR AS warning FROM seg WHERE text <> '' GROUP BY audio""", "conversations")
def _(c):
    r = A.alignment_record(A.segment_items(_segments(c)), "stable_ts", "segment")
    return r.select("audio_path", "sample_rate", "backend", "level", F.md5("text").alias("text_md5"), F.size("items").alias("n_items"), F.array_join(F.transform("items", lambda x: (x["start"] * 10).cast("int").cast("string")), ",").alias("starts"), "warning")


@query("s6_alignment_sidecars", f"""WITH {_SEG} SELECT audio AS audio_path, concat('{{"audio_path":"', audio, '","sample_rate":16000,"backend":"stable_ts","level":"segment","text":', to_json(string_agg(text, ' ' ORDER BY pos))::VARCHAR, ',"items":[', string_agg(concat('{{"text":', to_json(text)::VARCHAR, ',"start":', start::VARCHAR, ',"end":', "end"::VARCHAR, ',"level":"segment"}}'), ',' ORDER BY pos), '],"warning":null}}') AS payload FROM seg WHERE text <> '' GROUP BY audio""", "conversations")
def _(c):
    r = A.alignment_record(A.segment_items(_segments(c)), "stable_ts", "segment")
    return r.select("audio_path", A.sidecar_json(r).alias("payload"))


@query("f2_pluggable_aligner", "SELECT doc_id::VARCHAR AS audio, CASE WHEN doc_id % 10 = 3 THEN 0 ELSE len(string_split(text, ' ')) END::INT AS n_items, CASE WHEN doc_id % 10 = 3 THEN 'no audio' END AS warning FROM documents", "documents")
def _(d):
    def aligner(audio, text):
        if int(audio) % 10 == 3:
            raise ValueError("no audio")
        return [{"text": w, "start": i * 1.0, "end": i + 1.0, "level": "word"} for i, w in enumerate(text.split(" "))]

    return A.aligned(d.select(F.col("doc_id").cast("string").alias("audio"), "text"), aligner).select("audio", F.size("items").alias("n_items"), "warning")


@query("f3_strict_aligner", "SELECT doc_id::VARCHAR AS audio, len(string_split(text, ' '))::INT AS n_items, NULL::VARCHAR AS warning FROM documents", "documents")
def _(d):
    aligner = lambda audio, text: [{"text": w, "start": i * 1.0, "end": i + 1.0, "level": "word"} for i, w in enumerate(text.split(" "))]
    return A.aligned(d.select(F.col("doc_id").cast("string").alias("audio"), "text"), aligner, strict=True).select("audio", F.size("items").alias("n_items"), "warning")
