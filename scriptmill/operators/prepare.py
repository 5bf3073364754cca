"""Prepared transcripts: suspects, merges backed by verification, segments, texts, status and notes.

Deviation from a sequential walk, on purpose: when the members of a merged
group are not neighbours, the segments between them are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.functions.text import clean_text, comparison_key, join_texts, word_tokens
from scriptmill.operators.verify import AGAINST
from scriptmill.schema import DUPLICATE_TYPES


def suspect_keys(findings: DataFrame) -> DataFrame:
    """(transcript_id, key) of segments whose wording is doubtful."""
    f = findings.filter(F.col("type").isin(*DUPLICATE_TYPES) & F.col("severity").isin("critical", "high"))
    return f.select("transcript_id", F.explode("segment_ids").alias("key")).distinct()


def merge_plan(segments: DataFrame, verdicts: DataFrame, outcome: DataFrame, suspects: DataFrame, alternative_segments: DataFrame, compatibility: bool = True) -> DataFrame:
    """(transcript_id, idx, merge_first): the segments of every merge, with the first member's place.

    Only where verification contradicted the repetition, the phrase is no
    segment of the second transcription, and two or more members are suspect.
    """
    ok = outcome.filter("status = 'duplicate_contradicted'").select("transcript_id")
    alt = alternative_segments.select("transcript_id", comparison_key("text", compatibility).alias("phrase")).distinct()
    v = verdicts.filter(F.col("verdict").isin(*AGAINST) & (F.col("phrase") != "")).join(ok, "transcript_id", "left_semi").join(alt, ["transcript_id", "phrase"], "left_anti")
    # an id stands for its last segment
    places = segments.groupBy("transcript_id", "key").agg(F.max("idx").alias("idx"))
    members = v.select("transcript_id", "first_idx", F.explode("segment_ids").alias("key")).distinct().join(suspects, ["transcript_id", "key"], "left_semi").join(places, ["transcript_id", "key"])
    g = members.groupBy("transcript_id", "first_idx").agg(F.array_sort(F.collect_set("idx")).alias("_m")).filter(F.size("_m") > 1)
    return g.select("transcript_id", F.col("_m")[0].alias("merge_first"), F.explode("_m").alias("idx"))


def prepared_segments(transcripts: DataFrame, bound: DataFrame, flags: DataFrame, suspects: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """The segments of the prepared transcript, in order of ``place``."""
    s = bound.join(flags, ["transcript_id", "key"], "left").join(suspects.withColumn("_suspect", F.lit(True)), ["transcript_id", "key"], "left")
    s = s.withColumn("flags", F.coalesce("flags", F.array().cast("array<string>")))
    plan = merges.withColumnRenamed("idx", "_idx").withColumnRenamed("transcript_id", "_t") if merges is not None else None
    s = s.join(plan, (F.col("transcript_id") == F.col("_t")) & (F.col("idx") == F.col("_idx")), "left").drop("_t", "_idx") if plan is not None else s.withColumn("merge_first", F.lit(None).cast("int"))
    usable = F.col("start_valid") & F.col("end_valid")
    confidence = F.when(~usable, "missing").when(F.col("end") <= F.col("start"), "suspect").otherwise("reliable")
    none = F.array().cast("array<string>")
    single = s.filter("merge_first IS NULL").select(
        "transcript_id", F.col("idx").alias("place"), F.col("key").alias("segment_id"), F.array("key").alias("source_segment_ids"), F.col("start").alias("start_seconds"), F.col("end").alias("end_seconds"), F.col("text").alias("raw_text"), F.col("cleaned").alias("cleaned_text"),
        F.col("flags").alias("quality_flags"), F.when(F.col("_suspect"), "uncertain").otherwise("unchanged").alias("correction_status"), confidence.alias("timestamp_confidence"),
    )
    m = s.filter("merge_first IS NOT NULL").groupBy("transcript_id", "merge_first").agg(F.array_sort(F.collect_list(F.struct("idx", "key", "text", "cleaned", "flags"))).alias("_m"), F.min("start").alias("start_seconds"), F.max("end").alias("end_seconds"))
    keys = F.col("_m.key")
    merged = m.select(
        "transcript_id", F.col("merge_first").alias("place"), F.concat_ws("-", keys[0], F.element_at(keys, -1)).alias("segment_id"), keys.alias("source_segment_ids"), "start_seconds", "end_seconds",
        F.array_join(F.filter(F.transform(F.col("_m.text"), F.trim), lambda t: t != ""), " ").alias("raw_text"), join_texts(F.col("_m.cleaned")).alias("cleaned_text"),
        F.concat(F.array_sort(F.array_distinct(F.flatten(F.col("_m.flags")))), F.array(F.lit("merged_verbatim"))).alias("quality_flags"), F.lit("verified").alias("correction_status"), F.lit("suspect").alias("timestamp_confidence"),
    )
    bare = transcripts.filter(F.trim("text") != "").join(bound.select("transcript_id").distinct(), "transcript_id", "left_anti").select(
        "transcript_id", F.lit(0).alias("place"), F.lit("0").alias("segment_id"), none.alias("source_segment_ids"), F.lit(None).cast("double").alias("start_seconds"), F.lit(None).cast("double").alias("end_seconds"), F.col("text").alias("raw_text"), clean_text("text").alias("cleaned_text"),
        F.array(F.lit("no_segments")).alias("quality_flags"), F.lit("uncertain").alias("correction_status"), F.lit("missing").alias("timestamp_confidence"),
    )
    return single.unionByName(merged).unionByName(bare)


def assembled(transcripts: DataFrame, prepared: DataFrame, compatibility: bool = True) -> DataFrame:
    """(transcript_id, cleaned_transcript, raw_word_count, cleaned_word_count, unexpected_new_words)."""
    texts = prepared.groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "cleaned_text"))), lambda x: x["cleaned_text"]).alias("_t"))
    t = transcripts.select("transcript_id", "text").join(texts, "transcript_id", "left")
    joined, combined = F.coalesce(join_texts(F.col("_t")), F.lit("")), F.array_join(F.coalesce("_t", F.array().cast("array<string>")), "\n")
    t = t.select("transcript_id", F.when(joined != "", joined).otherwise(clean_text("text", compatibility)).alias("cleaned_transcript"), word_tokens("text", compatibility).alias("_a"), word_tokens(combined, compatibility).alias("_b"))
    return t.select("transcript_id", "cleaned_transcript", F.size("_a").alias("raw_word_count"), F.size("_b").alias("cleaned_word_count"), F.array_sort(F.array_except("_b", "_a")).alias("unexpected_new_words"))


def run_status(summary: DataFrame, status: DataFrame) -> DataFrame:
    """(transcript_id, run_status): what a reviewer must look at."""
    s = summary.select("transcript_id", "needs_review").join(status, "transcript_id", "left")
    return s.select("transcript_id", F.when(F.col("needs_review") | F.coalesce(F.col("status").isin("duplicate_confirmed", "inconclusive", "failed"), F.lit(False)), "needs_review").otherwise("ok").alias("run_status"))


def review_notes(findings: DataFrame, groups: DataFrame, status: DataFrame, prepared: DataFrame) -> DataFrame:
    """(transcript_id, notes): merges, groups left open, and every finding of high severity or worse, in report order."""
    merged = prepared.filter(F.array_contains("quality_flags", "merged_verbatim")).select("transcript_id", F.lit(0).alias("_kind"), F.col("place").cast("double").alias("_at"), F.lit("").alias("_type"), F.concat(F.lit("merged "), F.array_join("source_segment_ids", ", "), F.lit(" as "), F.col("segment_id")).alias("note"))
    open_ = groups.join(status.filter("status <> 'duplicate_contradicted'"), "transcript_id", "left_semi").select("transcript_id", F.lit(1).alias("_kind"), F.col("first_idx").cast("double").alias("_at"), F.lit("").alias("_type"), F.concat(F.lit("unresolved repetition in "), F.array_join("segment_ids", ", "), F.lit(": "), F.substring("normalized_text", 1, 120)).alias("note"))
    bad = findings.filter("rank <= 1").select("transcript_id", (F.col("rank") + 2).alias("_kind"), F.coalesce("range_start", F.lit(0.0)).alias("_at"), F.col("type").alias("_type"), F.concat(F.lit("["), F.col("severity"), F.lit("] "), F.col("type"), F.lit(" "), F.array_join("segment_ids", ", ")).alias("note"))
    rows = merged.unionByName(open_).unionByName(bad)
    return rows.groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("_kind", "_at", "_type", "note"))), lambda x: x["note"]).alias("notes"))
