"""Text functions over documents, decorated documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from vocalake.functions import text as T
from vocalake.registry import query
from vocalake.tables import spread

S = T.SPACE


def _re(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


# The steps' patterns as DuckDB's engine writes them.
_STEPS = {name: lambda x, p=pattern.replace("(?md)", "(?m)"), to=to.replace("$", "\\"): _re(x, p, to) for name, (pattern, to) in T.MARKDOWN.items()}


def _strip(x: str) -> str:
    return _re(x, f"^{S}+|{S}+$")


def _squeeze(x: str) -> str:
    return _strip(_re(x, rf"\n{S}*\n", "\n"))


def _markdown(x: str) -> str:
    for f in _STEPS.values():
        x = f(x)
    return _squeeze(x)


def _clean(x: str) -> str:
    return f"translate({_re(_markdown(x), T.EMOJI)}, concat(chr(10), chr(9), chr(8220), chr(8221)), '  \"\"')"


_CJK = r"regexp_matches(text, '[\x{4E00}-\x{9FFF}]')"


def _simple(name: str, sql: str, f, table: str = "decorated", key: str = "doc_id", column: str = "text"):
    query(name, f"SELECT {key}, {sql} AS out FROM {table}", table)(lambda df: spread(df).select(key, f(F.col(column)).alias("out")))


_simple("t1_contains_cjk", _CJK, T.contains_cjk)
_simple("t2_route_lang", f"CASE WHEN {_CJK} THEN 'zh' ELSE 'en' END", T.route_lang)
for _letter, _name in zip("abcdefg", _STEPS, strict=True):
    _simple(f"t3{_letter}_{_name}", _STEPS[_name]("text"), lambda c, n=_name: T.markdown_step(n, c))
_simple("t3f_strip_tags_pages", _STEPS["strip_tags"]("html"), lambda c: T.markdown_step("strip_tags", c), "pages", "page_id", "html")
_simple("t3h_squeeze_blank_lines", _squeeze("text"), T.squeeze_blank_lines)
_simple("t3_clean_markdown", _markdown("text"), T.clean_markdown)
_simple("t4_strip_emoji", _re("text", T.EMOJI), T.strip_emoji)
_simple("t5_clean_text", _clean("text"), T.clean_text)


def _corner(x: str) -> str:
    for mark, word in T.CORNER_MARKS:
        x = f"replace({x}, '{mark}', '{word}')"
    return x


def _brackets(x: str) -> str:
    return f"replace(translate(replace({x}, '`', ''), '（）【】', '    '), '——', ' ')"


def _equals(x: str) -> str:
    e = f"replace({x}, '=', '等于')"
    return f"CASE WHEN regexp_matches({e}, '[\\d$%^*_+≥≤≠×÷?=]') THEN {_re(_re(e, '([a-zA-Z0-9])-([0-9])', r'\1 - \2'), '([a-zA-Z0-9])-([0-9])', r'\1 - \2')} ELSE {e} END"


_simple("t6_corner_marks", _corner("text"), T.corner_marks)
_simple("t7_strip_brackets", _brackets("text"), T.strip_brackets)
_simple("t9_zh_equals_minus", _equals("text"), T.zh_equals_minus)
_ASCII = "coalesce(unicode({}) BETWEEN 1 AND 127 AND {} <> ' ', false)"
query("t10_tighten_blanks", f"""WITH c AS (SELECT doc_id, string_split(text, '') AS l FROM decorated)
SELECT doc_id, array_to_string(list_transform(range(1, len(l) + 1), lambda i: CASE WHEN l[i] <> ' ' OR ({_ASCII.format("l[i + 1]", "l[i + 1]")} AND i > 1 AND {_ASCII.format("l[i - 1]", "l[i - 1]")}) THEN l[i] ELSE '' END), '') AS out FROM c""", "decorated")(lambda df: spread(df).select("doc_id", T.tighten_blanks(F.col("text")).alias("out")))


def _quoted(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _bind(x: str, f) -> str:
    """f of a name for x."""
    return f"list_transform([{x}], lambda b: {f('b')})[1]"


_TEN = lambda n: f"CASE WHEN {n} < 20 THEN {_quoted(T.ONES)}[{n} + 1] ELSE concat({_quoted(T.TENS)}[{n} // 10 - 1], CASE WHEN {n} % 10 > 0 THEN concat('-', {_quoted(T.ONES)}[{n} % 10 + 1]) ELSE '' END) END"
_HUNDRED = lambda n: f"CASE WHEN {n} < 100 THEN {_TEN(n)} ELSE concat({_quoted(T.ONES)}[{n} // 100 + 1], ' hundred', CASE WHEN {n} % 100 > 0 THEN concat(' and ', {_TEN(f'({n} % 100)')}) ELSE '' END) END"


def _spell(x: str) -> str:
    """Runs of digits in groups of three: each group by name, the last with `and` where it is below a hundred."""
    group = lambda n, k: f"(({n} // {10**k}) % 1000)"
    high = lambda n: ", ".join(f"CASE WHEN {group(n, k)} > 0 THEN concat({_HUNDRED(group(n, k))}, ' {w}') END" for k, w in ((12, "trillion"), (9, "billion"), (6, "million"), (3, "thousand")))
    low = lambda n: f"({n} % 1000)"
    whole = lambda n: f"CASE WHEN {n} < 1000 THEN {_HUNDRED(n)} ELSE concat(concat_ws(', ', {high(n)}), CASE WHEN {low(n)} = 0 THEN '' WHEN {low(n)} < 100 THEN concat(' and ', {_HUNDRED(low(n))}) ELSE concat(', ', {_HUNDRED(low(n))}) END) END"
    single = f"array_to_string(list_transform(string_split(t, ''), lambda d: {_quoted(T.ONES)}[d::INT + 1]), ' ')"
    run = f"CASE WHEN NOT regexp_matches(t, '^[0-9]') THEN t WHEN length(t) > 15 OR (length(t) > 1 AND t LIKE '0%') THEN {single} ELSE {_bind('t::BIGINT', whole)} END"
    return f"array_to_string(list_transform(regexp_extract_all({x}, '[0-9]+|[^0-9]+'), lambda t: {run}), '')"


_simple("t8_spell_numbers", _spell("text"), T.spell_numbers)


def _tighten(x: str) -> str:
    keep = lambda l: f"list_transform(range(1, len({l}) + 1), lambda i: CASE WHEN {l}[i] <> ' ' OR ({_ASCII.format(f'{l}[i + 1]', f'{l}[i + 1]')} AND i > 1 AND {_ASCII.format(f'{l}[i - 1]', f'{l}[i - 1]')}) THEN {l}[i] ELSE '' END)"
    letters = f"string_split({x}, '')"
    return f"array_to_string({_bind(letters, keep)}, '')"


_C = f"(SELECT doc_id, text, {_clean('text')} AS c FROM decorated)"
_E = f"(SELECT doc_id, text, c, {_equals('c')} AS e FROM {_C})"
query("t11_normalize_text", f"SELECT doc_id, CASE WHEN {_CJK} THEN {_brackets(_corner(_tighten('e')))} ELSE {_spell('c')} END AS out FROM {_E}", "decorated")(lambda df: spread(df).select("doc_id", T.normalize_text(F.col("text")).alias("out")))


def _utterances(x: str, lang: str) -> str:
    m = T.marks(lang)
    out = m.replace("[", "[^", 1)
    body = f"regexp_replace({x}, '^({m}[\"”]?)+', '')"
    pieces = f"list_transform(regexp_extract_all({body}, '{out}+{m}[\"”]?(?:{m}[\"”]?)*'), lambda p: concat(regexp_extract(p, '^{out}+{m}'), {_re(f"regexp_replace(p, '^{out}+{m}', '')", m)}))"
    return f"CASE WHEN len({pieces}) > 0 THEN {pieces} ELSE [concat({x}, '{'。' if lang == 'zh' else '.'}')] END"


query("t12_split_utterances", f"SELECT doc_id, array_to_string(CASE WHEN {_CJK} THEN {_utterances('text', 'zh')} ELSE {_utterances('text', 'en')} END, '|') AS out FROM decorated", "decorated")(
    lambda df: spread(df).select("doc_id", F.array_join(F.when(T.contains_cjk(F.col("text")), T.split_utterances(F.col("text"), "zh")).otherwise(T.split_utterances(F.col("text"), "en")), "|").alias("out"))
)

_FOLD = """WITH u AS (SELECT doc_id, {} AS l FROM decorated),
f AS (SELECT doc_id, list_reduce(list_transform(l, lambda x: {{'done': []::VARCHAR[], 'cur': x}}), lambda a, x: CASE WHEN length(a.cur) + length(x.cur) > 80 AND length(a.cur) > 60
 THEN {{'done': list_append(a.done, a.cur), 'cur': x.cur}} ELSE {{'done': a.done, 'cur': concat(a.cur, x.cur)}} END, {{'done': []::VARCHAR[], 'cur': ''}}) AS r FROM u)
SELECT doc_id, array_to_string(CASE WHEN r.cur = '' THEN r.done WHEN length(r.cur) < 20 AND len(r.done) > 0 THEN list_append(r.done[1:len(r.done) - 1], concat(r.done[len(r.done)], r.cur)) ELSE list_append(r.done, r.cur) END, '|') AS out FROM f"""
query("t13_pack_utterances", _FOLD.format(_utterances("text", "en")), "decorated")(lambda df: spread(df).select("doc_id", F.array_join(T.pack_utterances(T.split_utterances(F.col("text"), "en"), F.length), "|").alias("out")))
query("t13_pack_utterances_zh", _FOLD.format(_utterances("text", "zh")), "decorated")(lambda df: spread(df).select("doc_id", F.array_join(T.pack_utterances(T.split_utterances(F.col("text"), "zh"), F.length), "|").alias("out")))

_simple("t14_collapse_space", _re("replace(text, chr(10), ' ')", f"{S}+", " "), T.collapse_space)
_TOKENS = r"regexp_extract_all(text, '[\x{4E00}-\x{9FFF}]+|[A-Za-z\x{C0}-\x{24F}]+|[0-9]+|[^\sA-Za-z0-9\x{C0}-\x{24F}\x{4E00}-\x{9FFF}]')"
query("t15_split_cjk_tokens", f"SELECT doc_id, array_to_string(flatten(list_transform({_TOKENS}, lambda t: CASE WHEN regexp_matches(replace(t, '▁', ''), '^[\\x{{4E00}}-\\x{{9FFF}}]{{2,}}$') THEN string_split(replace(t, '▁', ''), '') ELSE [t] END)), ' ') AS out FROM decorated", "decorated")(
    lambda df: spread(df).select("doc_id", F.array_join(T.split_cjk_tokens(T.base_tokens(F.col("text"))), " ").alias("out"))
)
# With a vocabulary: only its entries are split.
query("t15_split_cjk_in_vocab", f"SELECT doc_id, array_to_string(flatten(list_transform({_TOKENS}, lambda t: CASE WHEN replace(t, '▁', '') IN ('世界', '数据') THEN string_split(replace(t, '▁', ''), '') ELSE [t] END)), ' ') AS out FROM decorated", "decorated")(
    lambda df: spread(df).select("doc_id", F.array_join(T.split_cjk_tokens(T.base_tokens(F.col("text")), lambda t: t.isin("世界", "数据", "word")), " ").alias("out"))
)
# Lengths in tokens, as for languages with spaces.
_COUNT = lambda x: f"len({_TOKENS.replace('regexp_extract_all(text', f'regexp_extract_all({x}')})"
_whole = lambda x: x.replace("{", "{{").replace("}", "}}")
_TOKEN_FOLD = _FOLD.replace("length(a.cur) + length(x.cur) > 80 AND length(a.cur) > 60", _whole(f"{_COUNT('concat(a.cur, x.cur)')} > 80 AND {_COUNT('a.cur')} > 60")).replace("length(r.cur) < 20", _whole(f"{_COUNT('r.cur')} < 20"))
query("t13_pack_utterances_tokens", _TOKEN_FOLD.format(_utterances("text", "en")), "decorated")(lambda df: spread(df).select("doc_id", F.array_join(T.pack_utterances(T.split_utterances(F.col("text"), "en"), lambda x: F.size(T.base_tokens(x)), additive=True), "|").alias("out")))
query("t16_strip_asr_tags", "SELECT doc_id, list_last(string_split(t, '|>')) AS out FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN concat('<|en|><|NEUTRAL|>', text) ELSE text END AS t FROM documents)", "documents")(
    lambda df: df.select("doc_id", T.strip_asr_tags(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<|en|><|NEUTRAL|>"), "text")).otherwise(F.col("text"))).alias("out"))
)
