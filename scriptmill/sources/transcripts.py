"""Transcript artifacts (version-1 JSON, one file each) as two tables: transcripts and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptmill.functions.text import clean_text, comparison_key
from scriptmill.functions.timing import duration, metadata_double, parse_timestamp, reference_duration
from scriptmill.runtime import ship
from scriptmill.schema import TranscriptFormatError

#: Extensions of media that are taken as input (fixed values).
VIDEO = ("mp4", "mkv", "mov", "avi", "webm", "m4v", "mpg", "mpeg", "ts", "wmv", "flv", "ogv")


def _kind(v: Column) -> Column:
    """number, string or other, of a VARIANT."""
    t = F.schema_of_variant(v)
    return F.when(t.rlike("^(BIGINT|INT|DOUBLE|FLOAT|DECIMAL|TINYINT|SMALLINT)"), "number").when(t == "STRING", "string").otherwise("other")


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _string(v: Column, path: str) -> Column:
    """A member that is a JSON string, else null."""
    x = _get(v, path, "variant")
    return F.when(F.schema_of_variant(x) == "STRING", _get(v, path, "string"))


def parse_transcripts(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tables (transcripts, segments) of rows (transcript_id, json).

    transcripts has a column ``error``, null for a valid artifact; segments
    holds valid artifacts only. Text with bare NaN, which strict JSON lacks, is
    read with string fields instead.
    """
    v = F.try_parse_json("json")
    # NaN, Infinity as bare words fail strict parsing; quoting them keeps the rest of the document typed
    quoted = F.regexp_replace("json", r"(?<=[:\[,])\s*(-?(?:NaN|Infinity))\s*(?=[,}\]])", ' "\ue000$1"')
    rows = files.select("transcript_id", F.coalesce(v, F.try_parse_json(quoted)).alias("v"))
    segments = _get(F.col("v"), "$.segments", "variant")
    seg_type = F.schema_of_variant(segments)
    version = _get(F.col("v"), "$.schema_version", "variant")
    text = _string(F.col("v"), "$.transcript")
    items = _get(F.col("v"), "$.segments", "array<variant>")
    bad_item = F.exists(F.coalesce(items, F.array().cast("array<variant>")), lambda s: ~F.coalesce(F.schema_of_variant(s).startswith("OBJECT"), F.lit(False)))
    error = (
        F.when(F.col("v").isNull(), "not JSON")
        .when(~F.schema_of_variant("v").startswith("OBJECT"), "not an object")
        .when(F.schema_of_variant(version).isin("BIGINT") & (_get(F.col("v"), "$.schema_version", "bigint") != 1), "unsupported schema version")
        .when(text.isNull(), "transcript text is missing or not a string")
        .when(seg_type.isNotNull() & ~seg_type.startswith("ARRAY") & (seg_type != "VOID"), "segments is not a list")
        .when(bad_item, "a segment is not an object")
    )

    def number(path):
        x = _get(F.col("v"), path, "variant")
        return metadata_double(_get(F.col("v"), path, "string"), _kind(x))

    transcripts = rows.select(
        "transcript_id", text.alias("text"), _string(F.col("v"), "$.transcription_model").alias("model"), _string(F.col("v"), "$.requested_language").alias("language"),
        number("$.processed_duration_seconds").alias("processed_s"), number("$.api_reported_duration_seconds").alias("api_s"),
        _string(F.col("v"), "$.source_file").alias("source_file"), _string(F.col("v"), "$.source_path").alias("source_path"), error.alias("error"), F.col("v").alias("metadata"),
    )
    transcripts = transcripts.withColumn("reference_s", reference_duration("processed_s", "api_s"))
    seg = rows.filter(error.isNull()).select("transcript_id", F.posexplode(items).alias("idx", "s"))
    start, end, s = _get(F.col("s"), "$.start", "variant"), _get(F.col("s"), "$.end", "variant"), F.col("s")

    def raw(x, path):
        t = _get(s, path, "string")
        special = t.startswith("\ue000")
        return F.when(special, F.substring(t, 2, 20)).otherwise(t), F.when(special, "number").otherwise(_kind(x))

    (start_raw, start_kind), (end_raw, end_kind) = raw(start, "$.start"), raw(end, "$.end")
    segments = seg.select(
        "transcript_id", "idx", F.coalesce(_get(s, "$.id", "string"), F.col("idx").cast("string")).alias("key"), F.coalesce(_string(s, "$.text"), F.lit("")).alias("text"),
        start_raw.alias("start_raw"), end_raw.alias("end_raw"), parse_timestamp(start_raw, start_kind).alias("_start"), parse_timestamp(end_raw, end_kind).alias("_end"),
    )
    return transcripts, segments.select("transcript_id", "idx", "key", "text", "start_raw", "end_raw", F.col("_start.value").alias("start"), F.col("_start.valid").alias("start_valid"), F.col("_end.value").alias("end"), F.col("_end.valid").alias("end_valid"))


def read_transcripts(spark: SparkSession, path: str | list[str], strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Tables (transcripts, segments) of JSON files; the file path is the transcript id. ``strict`` raises on the first invalid artifact."""
    ship(spark)
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("transcript_id"), F.col("value").alias("json"))
    transcripts, segments = parse_transcripts(files)
    if strict and (bad := transcripts.filter("error IS NOT NULL").select("transcript_id", "error").head(1)):
        raise TranscriptFormatError(f"{bad[0][0]}: {bad[0][1]}")
    return transcripts.filter("error IS NULL"), segments


def segment_table(df: DataFrame, start: Column, end: Column) -> DataFrame:
    """Segments from rows (transcript_id, idx, key, text) whose times are plain numbers already."""
    value = lambda c: F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")), c)
    s, e = value(start.cast("double")), value(end.cast("double"))
    return df.select("transcript_id", "idx", "key", "text", start.cast("string").alias("start_raw"), end.cast("string").alias("end_raw"), s.alias("start"), F.coalesce(s >= 0, F.lit(False)).alias("start_valid"), e.alias("end"), F.coalesce(e >= 0, F.lit(False)).alias("end_valid"))


def bind(segments: DataFrame, compatibility: bool = True) -> DataFrame:
    """Segments with what the checks need, computed once: cleaned text, comparison key, duration."""
    return segments.select("*", clean_text("text", compatibility).alias("cleaned"), comparison_key("text", compatibility).alias("norm"), duration("start", "end").alias("duration"))


def has_timestamps(segments: DataFrame) -> DataFrame:
    """(transcript_id, has_timestamps): any segment with both times."""
    return segments.groupBy("transcript_id").agg(F.coalesce(F.bool_or(F.col("start").isNotNull() & F.col("end").isNotNull()), F.lit(False)).alias("has_timestamps"))


def normalize_response(df: DataFrame, response: str = "response") -> DataFrame:
    """API answers (id, JSON text) in tolerant forms: an object, or a bare string as the text; segments without usable numbers are dropped, ids default to positions."""
    v = F.try_parse_json(response)
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    text = F.when(is_object, _string(v, "$.text")).when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.when(v.isNull(), F.col(response)))
    items = F.coalesce(_get(v, "$.segments", "array<variant>"), F.array().cast("array<variant>"))
    usable = F.filter(F.transform(items, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), lambda x: (_kind(_get(x["s"], "$.start", "variant")) == "number") & (_kind(_get(x["s"], "$.end", "variant")) == "number"))
    shaped = F.transform(usable, lambda x: F.struct(F.coalesce(_get(x["s"], "$.id", "string"), x["i"].cast("string")).alias("id"), _get(x["s"], "$.start", "double").alias("start"), _get(x["s"], "$.end", "double").alias("end"), F.coalesce(F.trim(_string(x["s"], "$.text")), F.lit("")).alias("text")))
    rest = [c for c in df.columns if c != response]
    return df.select(*rest, F.nullif(F.trim(text), F.lit("")).alias("text"), F.when(is_object, _string(v, "$.language")).alias("language"), F.when(is_object, _get(v, "$.duration", "double")).alias("duration"), shaped.alias("segments"))


def list_candidates(spark: SparkSession, folder: str, extensions: tuple[str, ...] = VIDEO) -> DataFrame:
    """Media files of one folder, case-insensitively by extension, sorted by lower-case name; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return candidates(files, extensions).orderBy(F.lower("name"))


def candidates(files: DataFrame, extensions: tuple[str, ...] = VIDEO) -> DataFrame:
    """(path, name, length, other columns) of the files with one of the extensions, in either case; a row for each row of ``files``, also where paths repeat."""
    rest = [c for c in files.columns if c not in ("path", "length")]
    rows = files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", *rest)
    return rows.filter(F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin(*extensions))
