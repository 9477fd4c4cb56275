"""Text functions against rules told in other words than the library's patterns: goldens by hand, walks over characters, Unicode's own classes."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from vocalake.functions import text as T


def _map(spark, f, inputs):
    rows = spark.createDataFrame(list(enumerate(inputs)), "i int, x string").select("i", f(F.col("x")).alias("out")).collect()
    return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]


MARKDOWN = {
    "strip_code_fences": [("a ```x\ny``` b ```z```", "a  b "), ("```open", "```open"), ("``````", "")],
    "strip_inline_code": [("run `make all` now", "run  now"), ("a ` b", "a ` b"), ("`a\nb`c", "c"), ("``x``", "x")],
    "strip_images": [("see ![a plot](i.png) here", "see  here"), ("![](x)", ""), ("![a]()", "![a]()"), ("! [a](b)", "! [a](b)")],
    "unlink": [("read [the notes](http://e.org/n) first", "read the notes first"), ("[](x)", "[](x)"), ("[a][b](c)", "[a]b"), ("[a](b)(c)", "a(c)")],
    "strip_bullets": [("- a\n  - b\n-c\n", "a\n  b\n-c\n"), ("x - y", "x - y"), ("-\ta\n- - b", "a\n- b"), ("a\n\n- b", "a\n\nb")],
    "strip_tags": [("a <b>bold</b><br/> 1 < 2", "a bold 1 < 2"), ("<>", "<>"), ("<a\nb>c", "c")],
    "strip_headings": [("# a\n###### b\n####### c\nx # y", "a\nb\n# c\nx # y"), ("#", ""), ("##\ta", "a"), ("#\n#\nb", "b")],
}


@pytest.mark.parametrize("name", MARKDOWN)
def test_steps_of_markdown(spark, name):
    inputs, expected = zip(*MARKDOWN[name])
    assert _map(spark, lambda c: T.markdown_step(name, c), inputs) == list(expected)


def test_markdown_whole(spark):
    cases = [("# Head\n\n- one\n  - [two](u) `x`\n\n \n<i>three</i>![p](q)\n", "Head\none\n  two \nthree"), (" \n\n ", ""), ("a\n \n\n \nb", "a\nb"), ("```\n# x\n```　y ", "y")]
    assert _map(spark, T.clean_markdown, [x for x, _ in cases]) == [y for _, y in cases]
    cases = [("“a”\tb\n\nc 😀", '"a" b c '), ("1️⃣ ☎️ ☎ ❤️x", "⃣  ☎ x")]
    assert _map(spark, T.clean_text, [x for x, _ in cases]) == [y for _, y in cases]


def test_emoji_are_those_of_unicode(spark):
    """Every character by itself and before U+FE0F, as the `regex` module's tables class them."""
    shown, any_emoji = regex.compile(r"\p{Emoji_Presentation}"), regex.compile(r"\p{Emoji}")
    points = [i for i in range(1, 0x20000) if not 0xD800 <= i < 0xE000]
    out = spark.createDataFrame([(i, chr(i)) for i in points], "i int, c string").select("i", T.strip_emoji(F.col("c")).alias("alone"), T.strip_emoji(F.concat(F.col("c"), F.lit("️"))).alias("pair")).collect()
    for r in out:
        c = chr(r["i"])
        assert (r["alone"] == "") == bool(shown.match(c)), hex(r["i"])
        if not shown.match(c):
            assert r["pair"] == ("" if any_emoji.match(c) else c + "\ufe0f"), hex(r["i"])


def _said(n: int) -> str:
    """English as it is spoken, from the largest part down."""
    small = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
    if n < 20:
        return small[n]
    if n < 100:
        ten = {2: "twenty", 3: "thirty", 4: "forty", 5: "fifty", 6: "sixty", 7: "seventy", 8: "eighty", 9: "ninety"}[n // 10]
        return ten if n % 10 == 0 else f"{ten}-{_said(n % 10)}"
    if n < 1000:
        rest = f" and {_said(n % 100)}" if n % 100 else ""
        return f"{_said(n // 100)} hundred{rest}"
    for size, word in ((10**12, "trillion"), (10**9, "billion"), (10**6, "million"), (1000, "thousand")):
        if n >= size:
            rest = n % size
            return f"{_said(n // size)} {word}" + ("" if not rest else f" and {_said(rest)}" if rest < 100 else f", {_said(rest)}")


def test_numbers_are_spoken(spark):
    rng = random.Random(1)
    numbers = [*range(0, 1100), *(10**k for k in range(15)), *(10**k - 1 for k in range(1, 16)), *(rng.randrange(10 ** rng.randint(1, 15)) for _ in range(400)), 1_000_001, 1_000_100, 2_000_000_019, 100_000]
    assert _map(spark, T.spell_numbers, [f"a {n}, b" for n in numbers]) == [f"a {_said(n)}, b" for n in numbers]
    cases = [("007", "zero zero seven"), ("1" * 16, " ".join(["one"] * 16)), ("3.14", "three.fourteen"), ("x2y30", "xtwoythirty"), ("", ""), ("none", "none"), ("0", "zero")]
    assert _map(spark, T.spell_numbers, [x for x, _ in cases]) == [y for _, y in cases]


def _utterances(text: str, lang: str, commas: bool) -> list[str]:
    """A walk: what lies between marks is a piece with the mark after it; a quote right after a mark goes with the piece."""
    marks = set(".?!;:") | (set("。？！；：、") - set(":") if lang == "zh" else set()) | (set(",，") if commas else set())
    if lang == "zh":
        marks -= {":"}
    pieces, held, at = [], "", 0
    while at < len(text):
        c = text[at]
        if c not in marks:
            held += c
        else:
            if held:
                pieces.append(held + c)
            held = ""
            if text[at + 1 : at + 2] in ('"', "”"):
                if pieces:
                    pieces[-1] += text[at + 1]
                at += 1
        at += 1
    return pieces or [text + ("。" if lang == "zh" else ".")]


@pytest.mark.parametrize("lang", ["en", "zh"])
@pytest.mark.parametrize("commas", [False, True])
def test_utterances_are_walked(spark, lang, commas):
    rng = random.Random(5)
    inputs = ["".join(rng.choice('ab ."”?!;:。？！；：、,，\n') for _ in range(rng.randint(1, 40))) for _ in range(600)] + ["A b. C d? tail", "no mark", "", '."a.', "..", '“Quoted.” she said. "x!"']
    assert _map(spark, lambda c: T.split_utterances(c, lang, commas), inputs) == [_utterances(x, lang, commas) for x in inputs]
