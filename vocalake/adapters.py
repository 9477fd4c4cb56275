"""Views that shape the given tables like the corpora this package is for. One SQL text each, for Spark and the oracle."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    "manifest": """SELECT doc_id AS sample_id, text, concat('clips/', CAST(doc_id AS STRING), '.wav') AS audio, n_chars / 15e0 AS duration,
        CAST(substr(source, 4) AS INT) AS dataset_id, CASE WHEN doc_id % 5 = 0 THEN concat('clips/', CAST(doc_id + 1 AS STRING), '.wav') END AS ref_audio,
        CASE WHEN doc_id % 5 = 0 THEN (n_chars % 97) / 10e0 END AS ref_duration, doc_id % 7 = 0 AS is_prompt FROM documents""",
    "media": """SELECT concat('clips/', CAST(d.doc_id AS STRING), '.wav') AS path, CASE WHEN d.doc_id % 11 = 0 THEN 0 ELSE d.n_chars * 1000 END AS frames,
        CASE WHEN l.quality = 1 THEN 16000 ELSE 8000 END AS sample_rate, d.doc_id % 13 <> 0 AS readable,
        (CASE WHEN d.doc_id % 11 = 0 THEN 0 ELSE d.n_chars * 1000 END) / (CASE WHEN l.quality = 1 THEN 16e3 ELSE 8e3 END) AS duration
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "raw_lines": """SELECT event_id + 1 AS line_no, CASE event_id % 9
        WHEN 0 THEN concat('{"text": "', event_type, ' ', CAST(event_id AS STRING), '", "audio": "clips/', CAST(user_id AS STRING), '.wav", "props": ', props, '}')
        WHEN 1 THEN concat('{"text": "', event_type) WHEN 2 THEN concat('[', CAST(user_id AS STRING), ', 2]') WHEN 3 THEN CAST(user_id AS STRING) WHEN 4 THEN '  '
        WHEN 5 THEN concat('{"text": "', event_type, '"}') WHEN 6 THEN concat('{"text": null, "audio": {"path": "clips/', CAST(user_id AS STRING), '.wav"}}')
        WHEN 7 THEN concat('{"text": "   ", "audio": ', CAST(user_id AS STRING), '}') ELSE concat(props, ' x') END AS raw FROM events""",
    "decorated": """SELECT doc_id, concat(CASE doc_id % 12 WHEN 0 THEN concat('Use ```let a = 1', chr(10), 'b```then ') WHEN 1 THEN 'Run `make all` now. ' WHEN 2 THEN 'See ![a plot](img/p.png) here. '
        WHEN 3 THEN 'Read [the notes](http://example.com/n) first. ' WHEN 4 THEN concat('## Head', chr(10), '- one', chr(10), '  - two', chr(10), chr(10), ' ', chr(10)) WHEN 5 THEN 'A <b>bold</b> word<br/>. '
        WHEN 6 THEN 'Nice 😀 and ❤️ 1️ ok. ' WHEN 7 THEN concat('“', 'Quoted', '”', ' text; fine: yes! ') WHEN 8 THEN 'In 1999 we had 42 of 1000000 at 007. '
        WHEN 9 THEN concat('你', '好', ' a=b-1 ', '，', '世', '界', '。') WHEN 10 THEN concat('x', '²', ' + y', '³', ' ', '≈', ' 9 ', '（', 'm', '）', '【', 'n', '】', '`q`', '—', '—')
        ELSE concat('Plain', chr(9), 'text', '　', 'here, ok? ') END, text) AS text FROM documents""",
    "requests": """SELECT doc_id AS request_id, CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE text END AS text, CASE WHEN doc_id % 4 = 1 THEN ' calm (slow) ' WHEN doc_id % 4 = 2 THEN '' END AS control,
        CASE WHEN doc_id % 3 = 0 THEN 'p.wav' END AS prompt_audio, CASE WHEN doc_id % 6 = 0 THEN ' said so ' WHEN doc_id % 6 = 5 THEN '' END AS prompt_text,
        CASE WHEN doc_id % 8 = 3 THEN concat('prompts/', CAST(doc_id % 16 AS STRING), '.txt') END AS prompt_file, CASE WHEN doc_id % 5 = 2 THEN 'r.wav' END AS reference_audio,
        CASE WHEN doc_id % 10 = 7 THEN 'design' WHEN doc_id % 10 = 8 THEN 'clone' ELSE 'auto' END AS command, CASE WHEN doc_id % 20 = 3 THEN 'v1' ELSE 'v2' END AS arch,
        (doc_id % 25) / 2e0 AS cfg, CAST(doc_id % 110 AS INT) AS steps, CAST(doc_id % 4 AS INT) AS voice_id, CASE WHEN doc_id % 3 = 1 THEN doc_id * 7919 END AS seed FROM documents""",
    "attempts": """SELECT user_id AS request_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS attempt, CAST(floor(value) AS INT) AS frames, CAST(user_id % 5 + 3 AS INT) AS target_len, user_id * 7919 AS seed FROM events""",
    "dialogue": """SELECT conv_id, turn, text, CASE WHEN conv_id % 3 = 0 THEN 'r.wav' END AS ref_audio FROM conversations""",
    "signal": """SELECT user_id AS clip_id, CAST(event_id % 2 AS INT) AS channel, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS idx,
        CASE WHEN user_id % 17 = 0 THEN 0e0 WHEN event_id % 3 = 0 THEN value / 5e4 ELSE value / 5e2 END AS value FROM events""",
    "latents": """SELECT vec_id, label, embedding FROM embeddings""",
    "metrics": """SELECT ts, CAST(event_id % 4 AS INT) AS rank, CASE WHEN event_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, event_id AS micro_step, CAST(floor(event_id / 8) AS BIGINT) AS step,
        CASE WHEN event_type = 'click' THEN 'lr' ELSE concat('loss/', event_type) END AS key, value FROM events""",
    "param_keys": """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN concat('layer.', CAST(p_partkey AS STRING), '.weight') ELSE concat('layer.', CAST(p_partkey + 1 AS STRING), '.weight') END AS state_key,
        CASE WHEN p_partkey % 2 = 0 THEN concat('layer._orig_mod.', CAST(p_partkey AS STRING), '.weight') ELSE concat('layer.', CAST(p_partkey AS STRING), '.weight') END AS target_key FROM part""",
    "files": """SELECT concat('run_', CAST(o_custkey AS STRING), '/', CASE WHEN o_orderkey % 7 = 0 THEN 'latest' ELSE concat('step_', lpad(CAST(o_orderkey AS STRING), 7, '0')) END) AS dir,
        CASE WHEN o_orderkey % 4 = 0 THEN 'weights.safetensors' WHEN o_orderkey % 4 = 1 THEN 'config.json' ELSE 'training_state.json' END AS name,
        CASE WHEN o_orderkey % 4 = 1 AND o_orderkey % 3 = 0 THEN '{"rank": 8}' WHEN o_orderkey % 4 = 1 THEN concat('{"base_model": "m', CAST(o_custkey AS STRING), '"}')
        WHEN o_orderkey % 4 >= 2 AND o_orderkey % 3 > 0 THEN concat('{"step": ', CAST(o_orderkey AS STRING), '}') WHEN o_orderkey % 4 >= 2 THEN '{}' END AS body FROM orders""",
}


def oracle(query: str) -> str:
    """SQL for DuckDB: the views that the query names, then the query."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", query)]
    views = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in used)
    if not used:
        return query
    return f"WITH {views}\n{query}" if not query.lstrip().upper().startswith("WITH") else f"WITH {'RECURSIVE ' if 'RECURSIVE' in query[:20] else ''}{views},\n{re.sub(r'^\s*WITH (RECURSIVE )?', '', query)}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b(?:FROM|JOIN) {t}\b", sql)]
    literal = sql.replace("{", "{{").replace("}", "}}")
    return spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)", r"\1 {\2}", literal), **{t: view(spark, sf_dir, t) for t in used})
