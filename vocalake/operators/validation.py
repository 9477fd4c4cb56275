"""Validation of manifests by expressions and joins: what a line is, what it lacks, what its media are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalake.functions.text import strip
from vocalake.tables import stored, upper_median

SAMPLE_RATE = 16000


def _kind(v: Column) -> Column:
    """Of a variant: array, object, string, boolean, null, number."""
    s = F.schema_of_variant(v)
    return F.when(s.startswith("OBJECT"), "object").when(s.startswith("ARRAY"), "array").when(s == "STRING", "string").when(s == "BOOLEAN", "boolean").when((s == "VOID") | s.isNull(), "null").otherwise("number")


def parsed(lines: DataFrame) -> DataFrame:
    """lines (line_no, raw) with class: blank, invalid_json, not_object(kind) or object; and v, the object as a variant.

    A line is parsed once. The kind of a whole value is told from its first character.
    """
    bare = strip(F.col("raw"))
    one = F.col("_b").isNotNull() & F.try_variant_get("_b", "$[0]", "variant").isNotNull() & F.try_variant_get("_b", "$[1]", "variant").isNull()
    out = lines.withColumns({"_b": F.try_parse_json(F.concat(F.lit("["), F.col("raw"), F.lit("]"))), "_s": bare})
    first = F.substring("_s", 1, 1)
    kind = F.when(first == "{", "object").when(first == "[", "array").when(first == '"', "string").when(first.isin("t", "f"), "boolean").when(first == "n", "null").otherwise("number")
    out = out.withColumn("_k", F.when(one, kind))
    told = F.when((F.col("_k") == "object") & F.col("_s").endswith("}"), "object").when(F.col("_k").isNull() | (F.col("_k") == "object"), "invalid_json").otherwise(F.concat(F.lit("not_object("), F.col("_k"), F.lit(")")))
    out = out.withColumn("class", F.when(F.col("_s") == "", "blank").otherwise(told))
    return out.withColumn("v", F.when(F.col("class") == "object", F.try_variant_get("_b", "$[0]", "variant"))).drop("_b", "_s", "_k")


def has_key(name: str) -> Column:
    return F.try_variant_get("v", f"$.{name}", "variant").isNotNull()


def text_present() -> Column:
    text = F.try_variant_get("v", "$.text", "variant")
    return (_kind(text) == "string") & (strip(F.try_variant_get("v", "$.text", "string")) != "")


def media_path(field: str = "audio") -> Column:
    """The path in a string, or in an object's `path` ("" without one); null otherwise."""
    v = F.try_variant_get("v", f"$.{field}", "variant")
    return F.when(_kind(v) == "string", F.try_variant_get("v", f"$.{field}", "string")).when(_kind(v) == "object", F.when(_kind(F.try_variant_get("v", f"$.{field}.path", "variant")) == "string", F.try_variant_get("v", f"$.{field}.path", "string")).otherwise(""))


def from_lines(lines: DataFrame) -> DataFrame:
    """lines (line_no, raw) that aren't blank as rows of a manifest: file (if lines have it), sample_id (the line's number), text, audio, ref_audio, line_errors.

    A line that isn't an object or lacks a key stops there: it has its errors (one for each key) and nothing else.
    """
    rows = parsed(lines.where(~F.coalesce(strip(F.col("raw")) == "", F.lit(False))))  # by the raw line: a filter on its class would parse it again
    error = F.when(F.col("class") == "invalid_json", "invalid_json").when(F.col("class") != "object", "not_object")
    missing = lambda c: F.when((F.col("class") == "object") & ~has_key(c), "missing_key")
    rows = rows.withColumn("_e", F.array_compact(F.array(error, missing("text"), missing("audio"))))
    whole = F.size("_e") == 0
    given = lambda c: F.when(whole, F.nullif(media_path(c), F.lit("")))
    file = [c for c in ("file",) if c in lines.columns]
    rows = rows.select(*file, F.col("line_no").alias("sample_id"), F.when(whole & text_present(), F.try_variant_get("v", "$.text", "string")).alias("text"), given("audio").alias("audio"), given("ref_audio").alias("ref_audio"), "_e")
    return rows.select(*file, "sample_id", "text", "audio", "ref_audio", F.when((F.size("_e") == 0) & F.col("audio").isNull(), F.array(F.lit("invalid_path"))).otherwise(F.col("_e")).alias("line_errors"))


def resolve_path(path: Column, base: str) -> Column:
    return F.when(path.startswith("/") | path.isNull(), path).otherwise(F.concat_ws("/", F.lit(base.rstrip("/")), path))


def media_error(rate: int = SAMPLE_RATE, prefix: str = "") -> Column:
    """Of the columns path, frames, sample_rate and readable, each with the prefix."""
    c = lambda name: F.col(prefix + name)
    return F.when(c("path").isNull(), "not_found").when(c("frames") == 0, "zero_frames").when(c("sample_rate") != rate, "sample_rate").when(~c("readable"), "unreadable")


def known_media(media: DataFrame, prefix: str = "_m_") -> DataFrame:
    """One row per path: path, frames, sample_rate, readable and duration, with the prefix. Of several entries for a path, a readable one comes first, then the one with most frames."""
    best = F.max(F.struct(F.coalesce("readable", F.lit(False)).alias("r"), "frames", "sample_rate", "readable", "duration"))
    out = media.where("path is not null").groupBy(F.col("path").alias(f"{prefix}path")).agg(best.alias(f"{prefix}best"))
    return out.select(f"{prefix}path", *[F.col(f"{prefix}best")[c].alias(prefix + c) for c in ("frames", "sample_rate", "readable", "duration")])


def cap_samples(lines: DataFrame, most: int) -> DataFrame:
    """The first `most` lines of a manifest by number; all with 0."""
    return lines.where(F.col("line_no") <= most) if most > 0 else lines


def manifest_media_join(manifest: DataFrame, media: DataFrame) -> DataFrame:
    """manifest with _m_path, _m_frames, _m_sample_rate, _m_readable, _m_duration of its audio; null where there is none."""
    return manifest.join(known_media(media), F.col("audio") == F.col("_m_path"), "left")


def missing_media(manifest: DataFrame, media: DataFrame) -> DataFrame:
    """The rows whose audio isn't among the media."""
    return manifest.join(known_media(media), F.col("audio") == F.col("_m_path"), "left_anti")


def rows_with_ref(manifest: DataFrame, media: DataFrame) -> DataFrame:
    """The rows whose reference audio is among the media."""
    return manifest.join(known_media(media), F.col("ref_audio") == F.col("_m_path"), "left_semi")


def duration_band(duration: Column) -> Column:
    return F.when(duration < 0.3, "very_short").when(duration > 30.0, "very_long").otherwise("ok")


def checked(manifest: DataFrame, media: DataFrame, rate: int = SAMPLE_RATE) -> DataFrame:
    """manifest with media_error, media_duration, band, blank_text, ref (ok, missing or null), valid.

    manifest: rows, or lines (line_no, raw), which are parsed first. The paths of a row, each with its role, meet the media
    in one join and are folded by row again; what isn't asked of the result, as the text, isn't shuffled. Rows without a
    path get keys of their own, so they don't gather in one task. A stream of rows is joined once for each role.
    """
    manifest = from_lines(manifest) if "raw" in manifest.columns else manifest
    columns = manifest.columns
    known = known_media(media)
    key = lambda c: F.coalesce(c, F.concat(F.lit("\0"), F.col("sample_id").cast("string")))
    given = F.coalesce("ref_audio", F.lit("")) != ""
    own = manifest.withColumns({"_blank": strip(F.coalesce("text", F.lit(""))) == "", "_given": given})
    if manifest.isStreaming:
        refs = media.where("path is not null").select(F.col("path").alias("_ref")).distinct()
        out = own.join(known, key("audio") == F.col("_m_path"), "left").join(refs, key("ref_audio") == F.col("_ref"), "left").withColumn("_there", F.col("_ref").isNotNull())
    else:
        role = lambda n, c: F.struct(F.lit(n).alias("role"), c.alias("path"))
        each = own.withColumn("_id", F.monotonically_increasing_id()).select("*", F.explode(F.array(role(0, key("audio")), F.when(given, role(1, F.col("ref_audio"))))).alias("_p")).where("_p is not null")
        first = F.col("_p.role") == 0
        carried = [*columns, "_blank", "_given"]
        each = each.select("_id", F.col("_p.role").alias("_role"), F.col("_p.path").alias("_path"), *[F.when(first, F.col(c)).alias(c) for c in carried])
        met = each.join(known, F.col("_path") == F.col("_m_path"), "left")
        facts = [F.max(F.when(F.col("_role") == 0, F.col(c))).alias(c) for c in ("_m_path", "_m_frames", "_m_sample_rate", "_m_readable", "_m_duration")]
        out = met.groupBy("_id").agg(*[F.any_value(c, True).alias(c) for c in carried], *facts, F.max((F.col("_role") == 1) & F.col("_m_path").isNotNull()).alias("_there"))
    broken = F.size("line_errors") > 0 if "line_errors" in columns else F.lit(False)
    stopped = broken & ~F.array_contains("line_errors", "invalid_path") if "line_errors" in columns else F.lit(False)
    out = out.withColumn("_error", F.when(~broken, media_error(rate, "_m_"))).withColumn("_valid", ~broken & F.col("_error").isNull())
    ref = F.when(~F.col("_given"), None).when(F.col("_there"), "ok").otherwise("missing")
    made = {"media_error": F.col("_error"), "media_duration": F.when(F.col("_valid"), F.col("_m_duration")), "band": F.when(F.col("_valid"), duration_band(F.col("_m_duration"))), "blank_text": ~stopped & F.col("_blank"), "ref": ref, "valid": F.col("_valid")}
    return out.select(*[F.col(c) for c in columns if c not in made], *[v.alias(k) for k, v in made.items()])


def findings(rows: DataFrame) -> DataFrame:
    """sample_id, severity, category, seq of everything that `checked` found; seq is the order within a row, as a reader of the row would find it: what stops it, its text, its audio, its length, its reference."""
    at = lambda seq, severity, category: F.struct(F.lit(severity).alias("severity"), (F.lit(category) if isinstance(category, str) else category).alias("category"), F.lit(seq).alias("seq"))
    found = F.array(
        F.when(F.col("blank_text"), at(10, "warning", "blank_text")),
        F.when(F.col("media_error").isNotNull(), at(11, "error", "media")),
        F.when(F.col("band").isin("very_short", "very_long"), at(12, "warning", F.col("band"))),
        F.when(F.col("ref") == "missing", at(13, "warning", "ref_missing")),
    )
    found = F.array_compact(found)
    if "line_errors" in rows.columns:
        found = F.concat(F.transform("line_errors", lambda x, i: F.struct(F.lit("error").alias("severity"), x.alias("category"), i.alias("seq"))), found)
    return rows.select("sample_id", F.explode(found).alias("f")).select("sample_id", "f.severity", "f.category", "f.seq")


#: Categories of which a report has the first `CAP` and one row for how many more there are.
CAPPED, CAP = ("media", "blank_text"), 5


def summary(rows: DataFrame, *by: str) -> DataFrame:
    """The counts of a manifest; of each of several, by columns that tell them apart (then also of a stream).

    n_errors and n_warnings count what a report has (of repeated categories the first ones, and one more for the rest);
    found_errors and found_warnings count all that was found.
    """
    listed = lambda n: n - F.greatest(n - (CAP + 1), F.lit(0))
    media, blank = F.count_if(F.col("media_error").isNotNull()), F.count_if("blank_text")
    lines = F.coalesce(F.sum(F.size("line_errors")), F.lit(0)) if "line_errors" in rows.columns else F.lit(0).cast("bigint")
    others = F.count_if(F.col("band").isin("very_short", "very_long")) + F.count_if(F.col("ref") == "missing")
    out = rows.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if("valid").alias("valid"), F.count_if(F.col("ref") == "ok").alias("with_ref"), (lines + listed(media)).alias("n_errors"), (others + listed(blank)).alias("n_warnings"), (lines + media).alias("found_errors"), (others + blank).alias("found_warnings")
    )
    return out.withColumn("is_valid", (F.col("n_errors") == 0) & (F.col("valid") > 0))


def _listed(found: DataFrame, cap: int) -> DataFrame:
    """sample_id, severity, category, seq, more of what a report has: the rows that say how many more there are have no sample_id and come last."""
    few = found.where(F.col("category").isin(*CAPPED))
    rank = F.row_number().over(Window.partitionBy("category").orderBy("sample_id"))
    first = few.withColumn("_r", rank).where(F.col("_r") <= cap).drop("_r")  # Spark limits each task's rows before the exchange
    more = few.groupBy("severity", "category").agg(F.count("*").alias("n")).where(F.col("n") > cap)
    listed = first.unionByName(found.where(~F.col("category").isin(*CAPPED))).select("sample_id", "severity", "category", "seq", F.lit(None).cast("bigint").alias("more"))
    return listed.unionByName(more.select(F.lit(None).cast(dict(found.dtypes)["sample_id"]).alias("sample_id"), "severity", "category", F.lit(99).alias("seq"), (F.col("n") - cap).alias("more")))


def findings_capped(found: DataFrame, cap: int = CAP) -> DataFrame:
    """The first `cap` findings of the categories that a large corpus repeats, with a row for how many more there are; other categories whole.

    The first ones are the smallest of each task first, so a category that all rows have is no burden to one task. What was
    found is written once and read for each of the parts.
    """
    return _listed(stored(found), cap).drop("seq")


def top_findings(found: DataFrame, errors: int = 20, warnings: int = 10, cap: int = CAP) -> DataFrame:
    """The first errors and warnings of what a report has, in order of rows and within them, and how many of it were left out: sample_id, severity, category, more, omitted.

    What was found is written once and read for each of the parts.
    """
    listed, out = _listed(stored(found), cap), None
    for severity, k in (("error", errors), ("warning", warnings)):
        own = listed.where(F.col("severity") == severity)
        part = own.orderBy(F.asc_nulls_last("sample_id"), "seq").limit(k).select("sample_id", "severity", "category", "more", F.lit(None).cast("bigint").alias("omitted"))
        left = own.agg((F.count("*") - k).alias("omitted")).where("omitted > 0").select(F.lit(None).cast(dict(found.dtypes)["sample_id"]).alias("sample_id"), F.lit(severity).alias("severity"), F.lit(None).cast("string").alias("category"), F.lit(None).cast("bigint").alias("more"), "omitted")
        part = part.unionByName(left)
        out = part if out is None else out.unionByName(part)
    return out


_COUNTS = ("total", "valid", "with_ref", "n_errors", "n_warnings", "found_errors", "found_warnings")
_DURATIONS = ("hours", "min_duration", "median_duration", "max_duration")
_LENGTHS = ("min_length", "max_length")


def narrow(rows: DataFrame) -> DataFrame:
    """What reports need of checked rows, written once: no text, its length instead."""
    errors = ["line_errors"] if "line_errors" in rows.columns else []
    return stored(rows.select("sample_id", F.length("text").alias("text_length"), "media_error", "media_duration", "band", "blank_text", "ref", "valid", *errors))


def report(rows: DataFrame, means: bool = False) -> DataFrame:
    """item, value: the header counts, statistics (only those that have data; with means if asked for), and the verdict."""
    rows = rows if "text_length" in rows.columns else narrow(rows)
    stats = summary(rows).crossJoin(duration_stats(rows)).crossJoin(text_length_stats(rows))  # of one row each
    named = [*_COUNTS, *_DURATIONS, *_LENGTHS, *(("mean_duration", "mean_length") if means else ())]
    items = [*(F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in named), F.struct(F.lit("passed").alias("item"), F.col("is_valid").cast("double").alias("value"))]
    return stats.select(F.explode(F.array(*items)).alias("x")).select("x.item", F.round("x.value", 6).alias("value")).where("value is not null")


def full_report(rows: DataFrame, errors: int = 20, warnings: int = 10) -> DataFrame:
    """section (report, error, warning), item, sample_id, value: the report with means, then the first errors and warnings (item is the category; value, in a row without a sample, is how many more of it there are) and how many were left out (item is omitted)."""
    rows = narrow(rows)
    head = report(rows, means=True).select(F.lit("report").alias("section"), "item", F.lit(None).cast("bigint").alias("sample_id"), "value")
    listed = top_findings(findings(rows), errors, warnings)
    return head.unionAll(listed.select("severity", F.coalesce("category", F.lit("omitted")), F.col("sample_id").cast("bigint"), F.coalesce("more", "omitted").cast("double")))


def validate_manifest(lines: DataFrame, media: DataFrame, base: str = "", most: int = 0, rate: int = SAMPLE_RATE) -> DataFrame:
    """The lines (line_no, raw) of a manifest, checked: the first `most` of them (0: all), their relative paths under base. `summary`, `findings_capped`, `report` and `full_report` take what this returns.

    Defined cases: without lines, or with blank ones only, there are no rows: the summary counts 0 and isn't valid.
    """
    rows = from_lines(cap_samples(lines, most))
    if base:
        rows = rows.withColumns({c: resolve_path(F.col(c), base) for c in ("audio", "ref_audio")})
    return checked(rows, media, rate)


def duration_stats(rows: DataFrame) -> DataFrame:
    d, own = F.col("media_duration"), rows.where("media_error is null")
    out = own.agg(F.round(F.sum(d) / 3600, 6).alias("hours"), F.round(F.min(d), 6).alias("min_duration"), F.round(F.max(d), 6).alias("max_duration"), F.round(F.avg(d), 6).alias("mean_duration"))
    return out.crossJoin(upper_median(own, "media_duration").select(F.round("median", 6).alias("median_duration")))  # of one row each


def text_length_stats(rows: DataFrame) -> DataFrame:
    n = F.col("text_length") if "text_length" in rows.columns else F.length("text")
    return rows.where("not blank_text").agg(F.min(n).alias("min_length"), F.max(n).alias("max_length"), F.round(F.avg(n), 6).alias("mean_length"))
