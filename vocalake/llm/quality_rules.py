"""Risk-controlled quality rules.

Each rule compares one ratio with a fixed grid of cutoffs, from lenient to strict. On labelled documents, the number of
good ones that a cutoff would reject is tested against a limit with the exact binomial tail. Within a rule the grid is
tested in order until a test fails (a fixed sequence needs no correction); the rules of all strata share the error
probability by Bonferroni, and the rules of a stratum share its limit on false rejections. So with probability
1 - delta, no stratum loses more than `limit` of its good documents to the rules. All of it is DataFrame functions.

Defined cases: a null or empty text has no words, so all its counts are 0 and it fails the base rule; a null language
is the stratum "other"; without labels nothing is certified and only the base rule rejects; repeated rows are judged
alike, each on its own; further columns are passed through by `apply_rules`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalake.llm.common import SPACES, SPACES_RE, held_out, stored, table

#: Languages with strata of their own; all others are one stratum, so there are at most five.
STRATA = ("en", "de", "fr", "es")
#: Rule, and cutoffs from lenient to strict. A rule fires above its cutoff.
RULES: dict[str, tuple[float, ...]] = {
    "symbols": (3.0, 2.0, 1.5, 1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.08, 0.05),
    "long_words": (40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 14.0, 13.0, 12.0, 11.0, 10.0),
    "short_words": (-1.2, -1.5, -1.8, -2.0, -2.2, -2.5, -2.8, -3.0),
    "dup_lines": (0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2),
    "repeats": (0.19, 0.17, 0.15, 0.13, 0.11, 0.09, 0.07, 0.05),
}
LIMIT, DELTA = 0.02, 0.05
WINDOW = 5
#: Terms of a binomial tail that are summed before the rest is bounded by a geometric series.
TERMS = 256


def counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    The words of repeated windows are found within the row: window hashes (64 bits of five 64-bit word hashes) are sorted
    with their positions, equal neighbours are repeats, and the gaps between repeated positions give the words covered.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    bare = F.translate(t, SPACES, "")
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    trimmed = F.btrim(t, F.lit(SPACES))
    hashes = F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(trimmed, SPACES_RE), lambda x: F.xxhash64(x)))
    out = df.select(
        "*",
        F.length(bare).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        hashes.alias("_h"),
    )
    at = lambda i, k: F.get("_h", i + k if k else i)
    windows = F.transform(F.sequence(F.lit(0), F.size("_h") - WINDOW), lambda i: F.xxhash64(*[at(i, k) for k in range(WINDOW)]))
    out = out.select(
        *[c for c in out.columns if c not in ("_lines", "_h")],
        F.size("_h").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_h") > WINDOW, windows).alias("_w"),
    )
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    out = out.withColumn("_s", F.when(repeats, F.sort_array(F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))).drop("_w")
    same = lambda x, i: (F.get("_s", i - 1)["h"] == x["h"]) | F.coalesce(F.get("_s", i + 1)["h"] == x["h"], F.lit(False))
    out = out.withColumn("_p", F.sort_array(F.transform(F.filter("_s", lambda x, i: F.coalesce(same(x, i), F.get("_s", i + 1)["h"] == x["h"])), lambda x: x["p"]))).drop("_s")
    covered = F.transform("_p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(x - F.get("_p", i - 1), F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0), lambda a, x: a + x)
    return out.withColumn("n_repeat_words", F.coalesce(total, F.lit(0)).cast("long")).drop("_p")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def stratum(lang: str = "lang") -> Column:
    return F.when(F.col(lang).isin(*STRATA), F.col(lang)).otherwise("other")


def ratios() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / n,
        "long_words": F.col("word_chars") / n,
        "short_words": -(F.col("word_chars") / n),
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / n,
    }


def levels() -> Column:
    """For each rule, the first cutoff (from 1) of its grid that the document exceeds; one past the grid if none."""
    def first(ratio: Column, grid: tuple[float, ...]) -> Column:
        out = F.lit(len(grid) + 1)
        for i, c in reversed(list(enumerate(grid, 1))):
            out = F.when(ratio > c, F.lit(i)).otherwise(out)
        return out

    return F.array(*[F.struct(F.lit(r).alias("rule"), first(x, RULES[r]).alias("level")) for r, x in ratios().items()])


def _log_gamma(x: Column) -> Column:
    """Stirling's series after eight steps of the recurrence; absolute error below 1e-11 for x >= 1."""
    y, shift = x + 8, F.lit(0.0)
    for k in range(8):
        shift = shift + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k): the largest terms summed exactly, what is left bounded from above; 1 where k >= n p."""
    n, k = n.cast("double"), k.cast("double")
    top = _log_gamma(n + 1) - _log_gamma(k + 1) - _log_gamma(n - k + 1) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    ratio = lambda i: i / (n - i + 1) * (1 - p) / p  # noqa: E731  the term of i - 1 over that of i
    steps = F.when(k >= 1, F.sequence(F.lit(0), F.least(k, F.lit(TERMS)).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))
    step = lambda a, j: F.struct((a["term"] * ratio(k - j)).alias("term"), (a["sum"] + a["term"] * ratio(k - j)).alias("sum"))
    last = F.when(k > TERMS, ratio(k - TERMS)).otherwise(0.0)
    tail = F.aggregate(steps, zero, step, lambda a: a["sum"] + a["term"] * last / (1 - last))
    return F.when(k >= n * p, 1.0).otherwise(F.least(F.lit(1.0), F.exp(top) * tail))


def certify(labelled: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """labelled: stratum, levels, quality. One row per stratum: limits, a map from rule to the strictest certified step.

    Only good documents (quality 1) that the base rule keeps count. The grid is small and fixed, so the result has at
    most five rows, whatever the input.
    """
    good = labelled.where("quality = 1").select("stratum", F.explode("levels").alias("x")).groupBy("stratum", "x.rule", "x.level").agg(F.count("*").alias("n"))
    hist = good.groupBy("stratum", "rule").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("level", "n"))).alias("at"))
    grid = F.create_map(*[x for r, g in RULES.items() for x in (F.lit(r), F.lit(len(g)))])
    steps = hist.select("stratum", "rule", "n", "at", F.explode(F.sequence(F.lit(1), grid[F.col("rule")])).alias("step"))
    below = F.aggregate(F.sequence(F.lit(1), F.col("step")), F.lit(0).cast("long"), lambda a, j: a + F.coalesce(F.try_element_at("at", j), F.lit(0)))
    steps = steps.select("stratum", "rule", "step", binomial_tail(F.col("n"), below, limit / len(RULES)).alias("p"))
    tests = len(RULES) * (len(STRATA) + 1)
    failed = F.min(F.when(F.col("p") > delta / tests, F.col("step")))
    chosen = steps.groupBy("stratum", "rule").agg(F.coalesce(failed - 1, F.max("step")).alias("step"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "step"))).alias("limits"))


def judge(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """One row per row of docs: doc_id, the counts, stratum, base_failed, fired (the rules that reject it), kept."""
    plain = docs.select("doc_id", F.col("lang"), F.col("text"))
    seen = stored(counts(plain).select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", stratum().alias("stratum")))
    seen = seen.withColumn("base_failed", base_failed())
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality")).where(~held_out())
    limits = certify(seen.where("not base_failed").withColumn("levels", levels()).join(known, "doc_id"), limit, delta)
    judged = seen.withColumn("levels", levels()).join(F.broadcast(limits), "stratum", "left")
    step = lambda x: F.coalesce(F.try_element_at("limits", x["rule"]), F.lit(0))
    fired = F.transform(F.filter("levels", lambda x: x["level"] <= step(x)), lambda x: x["rule"])
    return judged.withColumn("fired", fired).withColumn("kept", ~F.col("base_failed") & (F.size("fired") == 0)).drop("levels", "limits")


def apply_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns. Rows that share a doc_id and differ in text stay or go together: kept only if each is."""
    kept = judge(docs, labels).groupBy("doc_id").agg(F.min("kept").alias("_kept")).where("_kept").select(F.col("doc_id").alias("_id"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
