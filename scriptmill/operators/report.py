"""Roll-ups of findings: order, counts, summaries, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.schema import SEVERITIES


def report_order():
    """Sort keys of a report: severity, start of range, type, then the order in which findings arose."""
    return [F.col("rank"), F.coalesce("range_start", F.lit(0.0)), F.col("type"), F.col("check_seq"), F.col("emit_seq")]


def ordered(findings: DataFrame) -> DataFrame:
    """Findings with their place in the report of their transcript."""
    from pyspark.sql.window import Window

    return findings.withColumn("place", F.row_number().over(Window.partitionBy("transcript_id").orderBy(*report_order())))


def severity_counts(findings: DataFrame) -> DataFrame:
    """One row a transcript with findings, all levels present."""
    return findings.groupBy("transcript_id").agg(*[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES])


def type_counts(findings: DataFrame) -> DataFrame:
    """(transcript_id, by_type map)."""
    n = findings.groupBy("transcript_id", "type").agg(F.count("*").alias("n"))
    return n.groupBy("transcript_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "n")))).alias("by_type"))


def max_severity():
    return F.min_by("severity", "rank")


def needs_review():
    """Whether anything of medium severity or worse was found."""
    return F.bool_or(F.col("rank") <= 2)


def segment_flags(findings: DataFrame) -> DataFrame:
    """(transcript_id, key, flags): the types found on each segment, sorted; annotations are no flags."""
    f = findings.filter("type <> 'terminology_detected'").select("transcript_id", "type", F.explode("segment_ids").alias("key"))
    return f.groupBy("transcript_id", "key").agg(F.array_sort(F.collect_set("type")).alias("flags"))


def summary(transcripts: DataFrame, findings: DataFrame, groups: DataFrame | None = None, times: DataFrame | None = None) -> DataFrame:
    """One row a transcript, with or without findings."""
    by = findings.groupBy("transcript_id").agg(F.count("*").alias("total_findings"), *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES], max_severity().alias("max_severity"), needs_review().alias("needs_review"))
    out = transcripts.select(F.col("transcript_id").cast("string").alias("transcript_id"), *([F.col("reference_s")] if "reference_s" in transcripts.columns else [])).join(by, "transcript_id", "left")
    out = out.fillna(0, ["total_findings", *SEVERITIES]).fillna(False, ["needs_review"])
    if groups is not None:
        out = out.join(groups.groupBy("transcript_id").agg(F.count("*").alias("duplicate_group_count")), "transcript_id", "left").fillna(0, ["duplicate_group_count"])
    if times is not None:
        out = out.join(times, "transcript_id", "left").fillna(False, ["has_timestamps"])
    return out
