"""Text functions as native column expressions; none needs a session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it, spelt so that Java and RE2 read it alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Unicode's Emoji_Presentation (17.0), and what else of Emoji there is.
EMOJI_SHOWN = (
    r"[\x{231A}\x{231B}\x{23E9}-\x{23EC}\x{23F0}\x{23F3}\x{25FD}\x{25FE}\x{2614}\x{2615}\x{2648}-\x{2653}\x{267F}\x{2693}\x{26A1}\x{26AA}\x{26AB}\x{26BD}\x{26BE}\x{26C4}\x{26C5}\x{26CE}\x{26D4}"
    r"\x{26EA}\x{26F2}\x{26F3}\x{26F5}\x{26FA}\x{26FD}\x{2705}\x{270A}\x{270B}\x{2728}\x{274C}\x{274E}\x{2753}-\x{2755}\x{2757}\x{2795}-\x{2797}\x{27B0}\x{27BF}\x{2B1B}\x{2B1C}\x{2B50}\x{2B55}"
    r"\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}\x{1F201}\x{1F21A}\x{1F22F}\x{1F232}-\x{1F236}\x{1F238}-\x{1F23A}\x{1F250}\x{1F251}\x{1F300}-\x{1F320}\x{1F32D}-\x{1F335}"
    r"\x{1F337}-\x{1F37C}\x{1F37E}-\x{1F393}\x{1F3A0}-\x{1F3CA}\x{1F3CF}-\x{1F3D3}\x{1F3E0}-\x{1F3F0}\x{1F3F4}\x{1F3F8}-\x{1F43E}\x{1F440}\x{1F442}-\x{1F4FC}\x{1F4FF}-\x{1F53D}\x{1F54B}-\x{1F54E}"
    r"\x{1F550}-\x{1F567}\x{1F57A}\x{1F595}\x{1F596}\x{1F5A4}\x{1F5FB}-\x{1F64F}\x{1F680}-\x{1F6C5}\x{1F6CC}\x{1F6D0}-\x{1F6D2}\x{1F6D5}-\x{1F6D9}\x{1F6DC}-\x{1F6DF}\x{1F6EB}\x{1F6EC}"
    r"\x{1F6F4}-\x{1F6FC}\x{1F7E0}-\x{1F7EB}\x{1F7F0}\x{1F90C}-\x{1F93A}\x{1F93C}-\x{1F945}\x{1F947}-\x{1F9FF}\x{1FA70}-\x{1FA7C}\x{1FA80}-\x{1FAC6}\x{1FAC8}\x{1FACC}-\x{1FADD}\x{1FADF}-\x{1FAEB}\x{1FAEF}-\x{1FAFA}]"
)
EMOJI_BEFORE_MARK = (
    r"[\x{23}\x{2A}\x{30}-\x{39}\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{2199}\x{21A9}\x{21AA}\x{2328}\x{23CF}\x{23ED}-\x{23EF}\x{23F1}\x{23F2}\x{23F8}-\x{23FA}\x{24C2}"
    r"\x{25AA}\x{25AB}\x{25B6}\x{25C0}\x{25FB}\x{25FC}\x{2600}-\x{2604}\x{260E}\x{2611}\x{2618}\x{261D}\x{2620}\x{2622}\x{2623}\x{2626}\x{262A}\x{262E}\x{262F}\x{2638}-\x{263A}\x{2640}"
    r"\x{2642}\x{265F}\x{2660}\x{2663}\x{2665}\x{2666}\x{2668}\x{267B}\x{267E}\x{2692}\x{2694}-\x{2697}\x{2699}\x{269B}\x{269C}\x{26A0}\x{26A7}\x{26B0}\x{26B1}\x{26C8}\x{26CF}\x{26D1}"
    r"\x{26D3}\x{26E9}\x{26F0}\x{26F1}\x{26F4}\x{26F7}-\x{26F9}\x{2702}\x{2708}\x{2709}\x{270C}\x{270D}\x{270F}\x{2712}\x{2714}\x{2716}\x{271D}\x{2721}\x{2733}\x{2734}\x{2744}\x{2747}"
    r"\x{2763}\x{2764}\x{27A1}\x{2934}\x{2935}\x{2B05}-\x{2B07}\x{3030}\x{303D}\x{3297}\x{3299}\x{1F170}\x{1F171}\x{1F17E}\x{1F17F}\x{1F202}\x{1F237}\x{1F321}\x{1F324}-\x{1F32C}\x{1F336}"
    r"\x{1F37D}\x{1F396}\x{1F397}\x{1F399}-\x{1F39B}\x{1F39E}\x{1F39F}\x{1F3CB}-\x{1F3CE}\x{1F3D4}-\x{1F3DF}\x{1F3F3}\x{1F3F5}\x{1F3F7}\x{1F43F}\x{1F441}\x{1F4FD}\x{1F549}\x{1F54A}"
    r"\x{1F56F}\x{1F570}\x{1F573}-\x{1F579}\x{1F587}\x{1F58A}-\x{1F58D}\x{1F590}\x{1F5A5}\x{1F5A8}\x{1F5B1}\x{1F5B2}\x{1F5BC}\x{1F5C2}-\x{1F5C4}\x{1F5D1}-\x{1F5D3}\x{1F5DC}-\x{1F5DE}"
    r"\x{1F5E1}\x{1F5E3}\x{1F5E8}\x{1F5EF}\x{1F5F3}\x{1F5FA}\x{1F6CB}\x{1F6CD}-\x{1F6CF}\x{1F6E0}-\x{1F6E5}\x{1F6E9}\x{1F6F0}\x{1F6F3}]"
)
#: Of the latter, those before U+FE0F.
EMOJI = EMOJI_SHOWN + "|" + EMOJI_BEFORE_MARK + r"\x{FE0F}"


#: Every emoji match holds one of these: a quick test that spares nearly all texts the long class.
MAY_HOLD_EMOJI = r"[\x{231A}-\x{2B55}\x{FE0F}\x{1F004}-\x{1FAFA}]"


def bound(c: Column, f) -> Column:
    """f(c), with c worked out once however often f uses it."""
    return F.get(F.transform(F.array(c), f), 0)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def contains_cjk(c: Column) -> Column:
    return c.rlike(r"[\x{4E00}-\x{9FFF}]")


def route_lang(c: Column) -> Column:
    return F.when(contains_cjk(c), "zh").otherwise("en")


# The steps of `clean_markdown`, in order: pattern, replacement.
MARKDOWN = {
    "strip_code_fences": (r"(?s)```.*?```", ""),
    "strip_inline_code": (r"`[^`]*`", ""),
    "strip_images": (r"!\[[^\]]*\]\([^\)]+\)", ""),
    "unlink": (r"\[([^\]]+)\]\([^\)]+\)", "$1"),
    "strip_bullets": (rf"(?md)^({SPACE}*)-{SPACE}+", "$1"),
    "strip_tags": (r"<[^>]+>", ""),
    "strip_headings": (rf"(?md)^#{{1,6}}{SPACE}*", ""),
}


def markdown_step(name: str, c: Column) -> Column:
    return F.regexp_replace(c, *MARKDOWN[name])


def squeeze_blank_lines(c: Column) -> Column:
    return strip(F.regexp_replace(c, rf"\n{SPACE}*\n", "\n"))


def clean_markdown(c: Column) -> Column:
    for name in MARKDOWN:
        c = markdown_step(name, c)
    return squeeze_blank_lines(c)


def strip_emoji(c: Column) -> Column:
    return bound(c, lambda x: F.when(x.rlike(MAY_HOLD_EMOJI), F.regexp_replace(x, EMOJI, "")).otherwise(x))


def clean_text(c: Column) -> Column:
    return F.translate(strip_emoji(clean_markdown(c)), "\n\t“”", '  ""')


# Marks and the words for them.
CORNER_MARKS = (("²", "平方"), ("³", "立方"), ("√", "根号"), ("≈", "约等于"), ("<", "小于"))


def corner_marks(c: Column) -> Column:
    for mark, word in CORNER_MARKS:
        c = F.replace(c, F.lit(mark), F.lit(word))
    return c


def strip_brackets(c: Column) -> Column:
    return F.replace(F.translate(F.replace(c, F.lit("`"), F.lit("")), "（）【】", "    "), F.lit("——"), F.lit(" "))


ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


def _below_thousand(n: int) -> str:
    if n < 20:
        return ONES[n]
    if n < 100:
        return TENS[n // 10 - 2] + (f"-{ONES[n % 10]}" if n % 10 else "")
    return f"{ONES[n // 100]} hundred" + (f" and {_below_thousand(n % 100)}" if n % 100 else "")


def spell_number(digits: Column) -> Column:
    """English words of a run of ASCII digits; digit by digit if it has leading zeros or over 15 digits."""
    words = F.array(*[F.lit(_below_thousand(n)) for n in range(1000)])
    single = F.array_join(F.transform(F.split(digits, ""), lambda d: F.get(words, d.cast("int"))), " ")
    n = F.when(F.length(digits) <= 15, digits.cast("bigint"))
    group = lambda k: F.floor(n / F.lit(10**k)) % 1000
    high = F.concat_ws(", ", *[F.when(group(k) > 0, F.concat(F.get(words, group(k).cast("int")), F.lit(f" {name}"))) for k, name in ((12, "trillion"), (9, "billion"), (6, "million"), (3, "thousand"))])
    low = (n % 1000).cast("int")
    joined = F.when(n < 1000, F.get(words, low)).when(low == 0, high).otherwise(F.concat(high, F.when(low < 100, " and ").otherwise(", "), F.get(words, low)))
    return F.when((F.length(digits) > 15) | ((F.length(digits) > 1) & digits.startswith("0")), single).otherwise(joined)


def spell_numbers(c: Column) -> Column:
    parts = F.regexp_extract_all(c, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), spell_number(x)).otherwise(x)), "")


def zh_equals_minus(c: Column) -> Column:
    equal = F.replace(c, F.lit("="), F.lit("等于"))
    # The digits and signs that make a text a formula.
    return F.when(equal.rlike(r"[\d$%^*_+≥≤≠×÷?=]"), F.regexp_replace(equal, r"(?<=[a-zA-Z0-9])-(?=\d)", " - ")).otherwise(equal)


def tighten_blanks(c: Column) -> Column:
    """A space stays only between two ASCII characters that aren't spaces."""
    return F.regexp_replace(c, r"(?<![\x00-\x1f\x21-\x7f]) | (?![\x00-\x1f\x21-\x7f])", "")


def normalize_text(c: Column) -> Column:
    zh = strip_brackets(corner_marks(tighten_blanks(zh_equals_minus(clean_text(c)))))
    return F.when(contains_cjk(c), zh).otherwise(spell_numbers(clean_text(c)))


# The marks that end an utterance.
def marks(lang: str, comma_split: bool = False) -> str:
    return ("[。？！；：、.?!;" if lang == "zh" else "[.?!;:") + (",，" if comma_split else "") + "]"


def split_utterances(c: Column, lang: str, comma_split: bool = False) -> Column:
    """Pieces that end with a mark; quotes right after a mark belong to its piece, marks with nothing before them are
    dropped, and so is what follows the last mark. Without a piece, the text with a full stop is the only one."""
    m = marks(lang, comma_split)
    out = m.replace("[", "[^", 1)
    # What follows the last mark is matched too, up to the end, and left out after that: else the search would start anew at each of its characters.
    found = lambda x: F.regexp_extract_all(F.regexp_replace(x, f'^({m}["”]?)+', ""), F.lit(rf'{out}++(?:{m}["”]?(?:{m}["”]?)*|\z)'), F.lit(0))
    piece = lambda p: F.concat(F.regexp_extract(p, f"^{out}+{m}", 0), F.regexp_replace(F.regexp_replace(p, f"^{out}++{m}", ""), m, ""))
    pieces = lambda x: F.transform(F.filter(found(x), lambda p: p.rlike(m)), piece)
    return bound(c, lambda x: bound(pieces(x), lambda all: F.when(F.size(all) > 0, all).otherwise(F.array(F.concat(x, F.lit("。" if lang == "zh" else "."))))))


def pack_utterances(utts: Column, size, max_n: int = 80, min_n: int = 60, merge_len: int = 20, additive: bool = False) -> Column:
    """Joins pieces until the next would pass max_n and there are more than min_n; a short last piece goes to the one before. size: column -> length.

    The walk over the pieces keeps where packs begin, not the packs themselves, which are cut out at the end. additive: the
    size of joined pieces is the sum of theirs, so each is measured once. Characters are so, and `base_tokens` of pieces
    that end with a mark or quote (a token by itself), as those of `split_utterances` do.
    """
    if additive:
        return _packed_by_sums(utts, size, max_n, min_n, merge_len)
    zero = F.struct(F.array(F.lit(0)).alias("starts"), F.lit("").alias("cur"), F.lit(0).alias("i"))

    def step(a: Column, u: Column) -> Column:
        flush = (size(F.concat(a["cur"], u)) > max_n) & (size(a["cur"]) > min_n)
        return F.struct(F.when(flush, F.concat(a["starts"], F.array(a["i"]))).otherwise(a["starts"]).alias("starts"), F.when(flush, u).otherwise(F.concat(a["cur"], u)).alias("cur"), (a["i"] + 1).alias("i"))

    def cut(all: Column, a: Column) -> Column:
        n = F.size(a["starts"])
        short = (size(a["cur"]) < merge_len) & (n > 1)
        starts = F.when((a["cur"] == "") | short, F.slice(a["starts"], F.lit(1), F.greatest(n - 1, F.lit(1)))).otherwise(a["starts"])
        return _cut_at(all, starts)

    packs = lambda all: bound(F.aggregate(all, zero, step), lambda a: F.when((F.size(a["starts"]) == 1) & (a["cur"] == ""), F.array().cast("array<string>")).otherwise(cut(all, a)))
    return bound(utts, packs)


def _cut_at(all: Column, starts: Column) -> Column:
    """The pieces joined from each start to the next."""
    return bound(starts, lambda s: F.transform(s, lambda x, k: F.array_join(F.slice(all, x + 1, F.coalesce(F.get(s, k + 1), F.size(all)) - x), "")))


def _packed_by_sums(utts: Column, size, max_n: int, min_n: int, merge_len: int) -> Column:
    """`pack_utterances` where sizes add up: the walk is over numbers; n is the size of the running pack, chars tells whether it is empty."""
    zero = F.struct(F.array(F.lit(0)).alias("starts"), F.lit(0).alias("n"), F.lit(0).alias("chars"), F.lit(0).alias("i"))

    def step(a: Column, u: Column) -> Column:
        flush = (a["n"] + u["n"] > max_n) & (a["n"] > min_n)
        total = lambda c: (F.when(flush, u[c]).otherwise(a[c] + u[c])).alias(c)
        return F.struct(F.when(flush, F.concat(a["starts"], F.array(a["i"]))).otherwise(a["starts"]).alias("starts"), total("n"), total("chars"), (a["i"] + 1).alias("i"))

    def cut(all: Column, a: Column) -> Column:
        n = F.size(a["starts"])
        drop = (a["chars"] == 0) | ((a["n"] < merge_len) & (n > 1))
        starts = F.when(drop, F.slice(a["starts"], F.lit(1), F.greatest(n - 1, F.lit(1)))).otherwise(a["starts"])
        return F.when((n == 1) & (a["chars"] == 0), F.array().cast("array<string>")).otherwise(_cut_at(all, starts))

    sizes = lambda all: F.transform(all, lambda u: F.struct(size(u).alias("n"), F.length(u).alias("chars")))
    return bound(utts, lambda all: bound(F.aggregate(sizes(all), zero, step), lambda a: cut(all, a)))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("\n"), F.lit(" ")), f"{SPACE}+", " ")


def base_tokens(c: Column) -> Column:
    """Words, CJK runs and single marks."""
    return F.regexp_extract_all(c, F.lit(r"[\x{4E00}-\x{9FFF}]+|[A-Za-z\x{C0}-\x{24F}]+|[0-9]+|[^\sA-Za-z0-9\x{C0}-\x{24F}\x{4E00}-\x{9FFF}]"), F.lit(0))


def split_cjk_tokens(tokens: Column, in_vocab=None) -> Column:
    """Tokens of several CJK characters (after removing the word mark) become single characters; others stay. in_vocab: token -> boolean column."""
    def one(t: Column) -> Column:
        bare = F.replace(t, F.lit("▁"), F.lit(""))
        cut = bare.rlike(r"^[\x{4E00}-\x{9FFF}]{2,}$")
        return F.when(cut & in_vocab(bare) if in_vocab else cut, F.split(bare, "")).otherwise(F.array(t))

    return F.flatten(F.transform(tokens, one))


def strip_asr_tags(c: Column) -> Column:
    return F.element_at(F.split(c, r"\|>"), -1)


def compose_text(text: Column, control: Column, strip_parens: bool = False) -> Column:
    told = F.coalesce(control, F.lit(""))
    told = strip(F.regexp_replace(told, "[()（）]", "") if strip_parens else told)
    return F.when(told != "", F.concat(F.lit("("), told, F.lit(")"), text)).otherwise(text)
