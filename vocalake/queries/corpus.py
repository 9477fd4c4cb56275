"""Lengths, batches, packing tracks and sets of samples."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from vocalake.functions import nested as N
from vocalake.functions.text import base_tokens
from vocalake.operators import lengths as L
from vocalake.operators import runs as R
from vocalake.operators.hooks import PerWorker
from vocalake.registry import query
from vocalake.sources.manifest import read_splits
from vocalake.tables import numbered, spread, stored


def _joined(c, sep=","):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), sep)


def _list(x: str) -> str:
    return f"array_to_string({x}, ',')"


_LEN = "(length(text) + ceil(ceil(duration * 25) / 4) + CASE WHEN coalesce(ref_duration, 0) > 0 THEN ceil(ceil(ref_duration * 25) / 4) + 4 ELSE 2 END)::BIGINT"
_SPLIT = "CASE WHEN sample_id % 10 = 0 THEN 'validation' ELSE 'train' END"


def _sized(m):
    return m.withColumn("length", L.estimate_length(F.length("text"), F.col("duration"), F.col("ref_duration"))).withColumn("split", F.when(F.col("sample_id") % 10 == 0, "validation").otherwise("train"))


@query("p11_estimate_length", f"SELECT sample_id, {_LEN} AS length FROM manifest", "manifest")
def _(m):
    return _sized(m).select("sample_id", "length")


@query("p12_token_budget_filter", f"SELECT sample_id, split, length FROM (SELECT sample_id, {_SPLIT} AS split, {_LEN} AS length FROM manifest) WHERE split <> 'train' OR length <= 2048", "manifest")
def _(m):
    return L.token_budget_filter(_sized(m), 8192, 4).select("sample_id", "split", "length")


@query("p12_budget_report", f"SELECT count(*) AS total, count(*) FILTER (length > 2048) AS dropped, 2048::BIGINT AS most FROM (SELECT {_SPLIT} AS split, {_LEN} AS length FROM manifest) WHERE split = 'train'", "manifest")
def _(m):
    return L.budget_report(_sized(m), 8192, 4)


@query("a6_dataset_count", "SELECT (max(dataset_id) + 1)::INT AS n FROM manifest", "manifest")
def _(m):
    return L.dataset_count(m)


@query("a6_dataset_count_by_batch", "SELECT sample_id // 3 AS batch_id, greatest(2, coalesce(max(dataset_id) + 1, 0), 1)::INT AS n FROM manifest GROUP BY ALL", "manifest")
def _(m):
    return L.dataset_count_by_batch(m.withColumn("batch_id", F.floor(F.col("sample_id") / 3)), 2)


_ORDER = "SELECT sample_id, row_number() OVER (ORDER BY md5(concat('7:1:', sample_id::VARCHAR)), sample_id) - 1 AS position FROM manifest"


@query("w1_epoch_shuffle", _ORDER, "manifest")
def _(m):
    return L.epoch_shuffle(m.select("sample_id"), "sample_id", 7, 1)


@query("w2_assign_batches", f"WITH o AS ({_ORDER}) SELECT sample_id, position, position // 16 AS batch_id, (position % 16)::INT AS pos_in_batch FROM o WHERE position // 16 < (SELECT count(*) // 16 FROM o)", "manifest")
def _(m):
    return L.assign_batches(L.epoch_shuffle(m.select("sample_id"), "sample_id", 7, 1), 16, True)


@query("w3_shard_ranks", f"WITH o AS ({_ORDER}) SELECT sample_id, position, (position % 8)::INT AS rank FROM o", "manifest")
def _(m):
    return L.shard_ranks(L.epoch_shuffle(m.select("sample_id"), "sample_id", 7, 1), 8)


@query("u1_split_union", "SELECT split, text FROM (SELECT 'train' AS split, text FROM documents UNION ALL SELECT 'validation', text FROM benchmark)", "documents", "benchmark")
def _(d, b):
    return read_splits(d.select("text"), b.select("text")).select("split", "text")


@query("u2_loaded_keys", "SELECT target_key AS key FROM param_keys WHERE target_key IN (SELECT state_key FROM param_keys)", "param_keys")
def _(k):
    return R.loaded_keys(k)


@query("u2_skipped_keys", "SELECT target_key AS key FROM param_keys WHERE target_key NOT IN (SELECT state_key FROM param_keys)", "param_keys")
def _(k):
    return R.skipped_keys(k)


@query("u3_select_kept", f"SELECT sample_id FROM manifest WHERE {_LEN} <= 2048", "manifest")
def _(m):
    return L.select_kept(_sized(m), 2048).select("sample_id")


@query("o3_head_samples", "SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 2", "benchmark")
def _(b):
    return L.head_samples(b, "item_id", 2).select("item_id", "text")


_TOK = r"regexp_extract_all(text, '[\x{4E00}-\x{9FFF}]+|[A-Za-z\x{C0}-\x{24F}]+|[0-9]+|[^\sA-Za-z0-9\x{C0}-\x{24F}\x{4E00}-\x{9FFF}]')"


_ENCODED = f"""WITH t AS (SELECT doc_id, {_TOK} AS l FROM documents), e AS (SELECT doc_id, unnest(l) AS token, unnest(range(1, len(l) + 1)) AS pos FROM t),
v AS (SELECT token, (row_number() OVER (ORDER BY encode(token)))::INT AS id FROM (SELECT token FROM e GROUP BY token HAVING count(*) >= 20)),
g AS (SELECT doc_id, string_agg(coalesce(id, 0)::VARCHAR, ',' ORDER BY pos) AS ids FROM e LEFT JOIN v USING (token) GROUP BY doc_id) SELECT d.doc_id AS key, coalesce(ids, '') AS ids FROM documents d LEFT JOIN g USING (doc_id)"""


@query("j4_vocab_encode", _ENCODED, "documents")
def _(d):
    tokens = stored(spread(d).select(F.col("doc_id").alias("key"), base_tokens(F.col("text")).alias("tokens")))
    return L.vocab_encode(tokens, _vocabulary(tokens)).select("key", _joined(F.col("ids")).alias("ids"))


@query("j4_vocab_encode_joined", _ENCODED, "documents")
def _(d):
    """The same where the vocabulary is taken as too large to be broadcast."""
    tokens = stored(spread(d).select(F.col("doc_id").alias("key"), base_tokens(F.col("text")).alias("tokens")))
    return L.vocab_encode(tokens, _vocabulary(tokens), most=0).select("key", _joined(F.col("ids")).alias("ids"))


def _vocabulary(tokens):
    vocab = tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n >= 20")
    return numbered(stored(vocab.select("token")), "token").select("token", (F.col("position") + 1).cast("int").alias("id"))


# Packed tracks: a document's ids are the lengths of all its words; its audio and reference have the patches of the manifest's durations.
def _samples(d):
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    patches = lambda seconds: F.ceil(F.ceil(seconds * 25) / 4).cast("int")
    return spread(d).select("doc_id", ids.alias("ids"), patches(F.col("n_chars") / 15).alias("a"), patches(F.col("n_chars") % 97 / 10).alias("r"), (F.col("doc_id") % 7 == 0).alias("is_prompt"), (F.col("doc_id") % 3).cast("int").alias("dataset_id"), F.floor(F.col("doc_id") / 8).alias("batch_id"))


_S = "WITH s AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) AS ids, ceil(ceil(n_chars / 15e0 * 25) / 4)::INT AS a, ceil(ceil(n_chars % 97 / 10e0 * 25) / 4)::INT AS r, doc_id % 7 = 0 AS is_prompt, (doc_id % 3)::INT AS dataset_id, doc_id // 8 AS batch_id FROM documents)"


def _rep(x, n: str) -> str:
    return f"list_transform(range({n}), lambda i: {x})"


def _cat(*xs: str) -> str:
    return "list_concat(" + ", ".join(xs) + ")" if len(xs) == 2 else f"list_concat({xs[0]}, {_cat(*xs[1:])})"


_MASK = _cat(_rep(0, "len(ids) + 1"), _rep(1, "a"), "[0]")
_TARGET = {
    "tokens": _cat("ids", "[CASE WHEN is_prompt THEN 103 ELSE 101 END]", _rep(0, "a"), "[CASE WHEN is_prompt THEN 104 ELSE 102 END]"), "text_mask": f"list_transform({_MASK}, lambda x: 1 - x)", "audio_mask": _MASK,
    "loss_mask": f"CASE WHEN is_prompt THEN {_rep(0, 'len(ids) + a + 2')} ELSE {_MASK} END", "labels": _cat(_rep(0, "len(ids) + a"), "[1, 0]"),
}
_RMASK = _cat("[0]", _rep(1, "r"), _rep(0, "len(ids) + 2"), _rep(1, "a"), "[0]")
_REF = {
    "tokens": _cat("[103]", _rep(0, "r"), "[104]", "ids", "[101]", _rep(0, "a"), "[102]"), "text_mask": f"list_transform({_RMASK}, lambda x: 1 - x)", "audio_mask": _RMASK,
    "loss_mask": _cat(_rep(0, "r + len(ids) + 3"), _rep(1, "a"), "[0]"), "labels": _cat(_rep(0, "r + len(ids) + a + 2"), "[1, 0]"),
}


def _tracks(p, names=_TARGET):
    return [_joined(F.col(p)[n]).alias(n) for n in names]


@query("n4_pack_target", f"{_S} SELECT doc_id, " + ", ".join(f"{_list(x)} AS {n}" for n, x in _TARGET.items()) + " FROM s", "documents")
def _(d):
    return _samples(d).withColumn("p", N.pack_target(F.col("ids"), F.col("a"), F.col("is_prompt"))).select("doc_id", *_tracks("p"))


# The same over ids of a vocabulary, as samples for training are made.
_PACKED_IDS = f"WITH enc AS ({_ENCODED}), s AS (SELECT key AS doc_id, CASE WHEN ids = '' THEN []::INT[] ELSE list_transform(string_split(ids, ','), lambda x: x::INT) END AS ids, ceil(ceil(n_chars / 15e0 * 25) / 4)::INT AS a, key % 7 = 0 AS is_prompt FROM enc JOIN documents ON key = documents.doc_id) SELECT doc_id, " + ", ".join(f"{_list(x)} AS {n}" for n, x in _TARGET.items()) + " FROM s"


@query("n4_pack_vocabulary_ids", _PACKED_IDS, "documents")
def _(d):
    tokens = stored(spread(d).select(F.col("doc_id").alias("key"), base_tokens(F.col("text")).alias("tokens")))
    ids = L.vocab_encode(tokens, _vocabulary(tokens)).withColumnRenamed("key", "doc_id")
    s = ids.join(_samples(d).drop("ids"), "doc_id").withColumn("p", N.pack_target(F.col("ids"), F.col("a"), F.col("is_prompt")))
    return s.select("doc_id", *_tracks("p"))


@query("n5_pack_with_reference", f"{_S} SELECT doc_id, " + ", ".join(f"{_list(x)} AS {n}" for n, x in _REF.items()) + " FROM s", "documents")
def _(d):
    return _samples(d).withColumn("p", N.pack_with_reference(F.col("r"), F.col("ids"), F.col("a"))).select("doc_id", *_tracks("p"))


@query("n1_unpad", f"{_S} SELECT doc_id, {_list('ids')} AS out FROM s", "documents")
def _(d):
    padded = F.concat("ids", F.array_repeat(F.lit(-100), F.col("a")))
    return _samples(d).select("doc_id", _joined(N.unpad(padded)).alias("out"))


def _clip(x: str, n: str, pad: int) -> str:
    return f"list_concat({x}[1:{n}], {_rep(pad, f'greatest({n} - len({x}), 0)')})"


@query("n2_pad_batch", f"{_S}, m AS (SELECT batch_id, max(len(ids)) AS n FROM s GROUP BY batch_id) SELECT doc_id, {_list(_clip('ids', 'n', -100))} AS ids FROM s JOIN m USING (batch_id)", "documents")
def _(d):
    return L.clip_pad(_samples(d), "ids", "batch_id", 1 << 30, -100).select("doc_id", _joined(F.col("ids")).alias("ids"))


@query("n3_clip_pad", f"{_S}, t AS (SELECT doc_id, batch_id, {_TARGET['tokens']} AS k FROM s), m AS (SELECT batch_id, least(max(len(k)), 20) AS n FROM t GROUP BY batch_id) SELECT doc_id, {_list(_clip('k', 'n', 0))} AS tokens FROM t JOIN m USING (batch_id)", "documents")
def _(d):
    s = _samples(d).withColumn("tokens", N.pack_target(F.col("ids"), F.col("a"), F.col("is_prompt"))["tokens"])
    return L.clip_pad(s, "tokens", "batch_id", 20, 0).select("doc_id", _joined(F.col("tokens")).alias("tokens"))


@query("n6_position_ids", f"{_S} SELECT doc_id, {_list(_clip('range(len(ids) + a + 2)', '20', 0))} AS out FROM s", "documents")
def _(d):
    return _samples(d).select("doc_id", _joined(N.position_ids(F.size("ids") + F.col("a") + 2, F.lit(20))).alias("out"))


@query("n7_id_tracks", f"{_S} SELECT doc_id, {_list(_MASK)} AS task_ids, {_list(f'list_transform({_MASK}, lambda x: x * (dataset_id + 1))')} AS dataset_ids FROM s", "documents")
def _(d):
    s = _samples(d).withColumn("m", N.pack_target(F.col("ids"), F.col("a"), F.col("is_prompt"))["audio_mask"])
    return s.select("doc_id", _joined(N.id_track(F.col("m"), F.lit(N.TTS))).alias("task_ids"), _joined(N.id_track(F.col("m"), F.col("dataset_id") + 1)).alias("dataset_ids"))


@query("n8_latent_track", "SELECT vec_id, concat(repeat('0,', (vec_id % 4 + 1)::INT), array_to_string(list_transform(embedding, lambda x: (round(x::DOUBLE * 10000))::BIGINT::VARCHAR), ','), ',0') AS out FROM latents", "latents")
def _(x):
    zero = F.array_repeat(F.lit(0).cast("bigint"), (F.col("vec_id") % 4 + 1).cast("int"))
    patch = F.transform("embedding", lambda v: F.round(v.cast("double") * 10000).cast("bigint"))
    return x.select("vec_id", _joined(F.concat(zero, patch, F.array(F.lit(0).cast("bigint")))).alias("out"))


@query("n8_latent_track_packed", """WITH v AS (SELECT vec_id // 4 AS clip, embedding, row_number() OVER (PARTITION BY vec_id // 4 ORDER BY vec_id) AS k FROM latents), c AS (SELECT clip, count(*) AS a, clip % 4 + 1 AS n FROM v GROUP BY clip), w AS (SELECT max(len(embedding)) AS w FROM latents),
z AS (SELECT clip, unnest(list_append(range(0, n + 1), n + a + 1)) AS pos FROM c)
SELECT clip, clip % 4 + 1 + k AS pos, array_to_string(list_transform(embedding, lambda x: (round(x::DOUBLE * 10000))::BIGINT::VARCHAR), ',') AS out FROM v UNION ALL SELECT clip, pos, concat('0', repeat(',0', (w - 1)::INT)) FROM z, w""", "latents")
def _(x):
    clip = F.floor(F.col("vec_id") / 4)
    latents = x.select(clip.alias("key"), (F.row_number().over(Window.partitionBy(clip).orderBy("vec_id")) - 1).alias("patch"), F.col("embedding").cast("array<double>").alias("values"))
    sized = latents.groupBy("key").agg(F.count("*").alias("a")).withColumn("ids", F.sequence(F.lit(1), (F.col("key") % 4 + 1).cast("int")))
    packed = sized.select("key", N.pack_target(F.col("ids"), F.col("a"), F.lit(False))["audio_mask"].alias("audio_mask"))
    return L.latent_track(packed, latents).select(F.col("key").alias("clip"), F.col("pos").cast("bigint").alias("pos"), _joined(F.transform("values", lambda v: F.round(v * 10000).cast("bigint"))).alias("out"))


_MODES = "CASE doc_id % 4 WHEN 0 THEN 'zero_shot' WHEN 1 THEN 'continuation' WHEN 2 THEN 'reference' ELSE 'ref_continuation' END"
_FRONT = _cat("[103]", _rep(0, "r"), "[104]", "ids", "[101]")


@query("n9_generation_prefix", f"{_S} SELECT doc_id, {_list(f'''CASE doc_id % 4 WHEN 0 THEN {_cat('ids', '[101]')} WHEN 1 THEN {_cat('ids', '[101]', _rep(0, 'a'))} WHEN 2 THEN {_FRONT} ELSE list_concat({_FRONT}, {_rep(0, 'a')}) END''')} AS out FROM s", "documents")
def _(d):
    mode = F.element_at(F.array(*[F.lit(x) for x in ("zero_shot", "continuation", "reference", "ref_continuation")]), (F.col("doc_id") % 4 + 1).cast("int"))
    return _samples(d).select("doc_id", _joined(N.generation_prefix(mode, F.col("ids"), F.col("r"), F.col("a"))).alias("out"))


@query("n10_pad_to_multiple", f"{_S} SELECT doc_id, {_list(f'list_concat(ids, {_rep(0, chr(40) + "4 - len(ids) % 4) % 4")})')} AS right_side, {_list(f'list_concat({_rep(0, "(4 - len(ids) % 4) % 4")}, ids)')} AS left_side FROM s", "documents")
def _(d):
    return _samples(d).select("doc_id", _joined(N.pad_to_multiple(F.col("ids"), 4, "right", 0)).alias("right_side"), _joined(N.pad_to_multiple(F.col("ids"), 4, "left", 0)).alias("left_side"))


@query("n11_patchify", f"{_S}, p AS (SELECT doc_id, ids, list_concat(ids, {_rep(0, '(4 - len(ids) % 4) % 4')}) AS f FROM s) SELECT doc_id, array_to_string(list_transform(range(len(f) // 4), lambda i: array_to_string(f[i * 4 + 1:i * 4 + 4], ',')), '|') AS patches, {_list('f')} AS back FROM p", "documents")
def _(d):
    s = _samples(d).withColumn("p", N.patchify(F.col("ids"), 4, 0))
    return s.select("doc_id", F.array_join(F.transform("p", lambda x: _joined(x)), "|").alias("patches"), _joined(F.flatten("p")).alias("back"))


@query("w6_context_before", f"{_S} SELECT doc_id, {_list('CASE WHEN doc_id % 2 = 1 THEN range(len(ids) + 1 + greatest(a - 3, 0), len(ids) + 1 + a) ELSE [] END')} AS at FROM s", "documents")
def _(d):
    mask = F.concat(F.transform("ids", lambda x: x * 0), F.array(F.lit(0)), F.when(F.col("doc_id") % 2 == 1, F.array_repeat(F.lit(1), F.col("a"))).otherwise(F.array().cast("array<int>")))
    return _samples(d).select("doc_id", _joined(N.context_before(mask, 4)).alias("at"))


@query("n15_quantize_vector", "SELECT vec_id, array_to_string(list_transform(embedding, lambda x: round_even(tanh(x::DOUBLE) * 9, 0)::INT), ',') AS out FROM latents", "latents")
def _(x):
    return x.select("vec_id", _joined(F.transform(N.quantize_vector(F.col("embedding")), lambda v: F.rint(v * 9).cast("int"))).alias("out"))


@query("n16_bucketize", "SELECT sample_rate, frames, (frames > 20000)::INT + (frames > 30000)::INT + (frames > 40000)::INT AS bucket FROM media", "media")
def _(m):
    return m.select("sample_rate", "frames", N.bucketize(F.col("frames")).alias("bucket"))


@query("a7_consumption_by_dataset", f"""{_S}, g AS (SELECT batch_id, dataset_id, floor(sum((a + r) * 4) / 25e0)::BIGINT AS audio_seconds, sum(len(ids))::BIGINT AS text_tokens FROM s GROUP BY ALL),
i AS (SELECT DISTINCT batch_id, unnest([0, 1, 2, 3]) AS dataset_id FROM s) SELECT batch_id, dataset_id, coalesce(audio_seconds, 0) AS audio_seconds, coalesce(text_tokens, 0) AS text_tokens FROM i LEFT JOIN g USING (batch_id, dataset_id)""", "documents")
def _(d):
    return L.consumption_by_dataset(_samples(d).select("batch_id", "dataset_id", ((F.col("a") + F.col("r")) * 4).alias("frames"), F.size("ids").alias("text_tokens")), 4)


class _Sizes:
    """A tokenizer that has to be made: the ids are the sizes of words."""

    def __init__(self):
        self.words = re.compile(" ").split

    def __call__(self, texts):
        return [list(map(len, self.words(t))) for t in texts]


@query("f1_tokenized", "SELECT doc_id, array_to_string(list_transform(string_split(text, ' '), lambda w: length(w)), ',') AS ids FROM documents", "documents")
def _(d):
    out = L.tokenized(d.select("doc_id", "text"), PerWorker(_Sizes), remove=("text",))
    return out.select("doc_id", _joined(F.col("text_ids")).alias("ids"))


@query("f4_task_dispatch", f"{_S} SELECT doc_id, {_list(_TARGET['tokens'])} AS tokens FROM s", "documents")
def _(d):
    return _samples(d).select("doc_id", _joined(N.pack("tts", F.col("ids"), F.col("a"), F.col("is_prompt"))["tokens"]).alias("tokens"))
