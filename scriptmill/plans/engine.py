"""The engine: transcripts and segments in, findings and prepared documents out, all lazy."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.functions.timing import prepared_duration
from scriptmill.operators import checks, prepare, report, verify
from scriptmill.operators.terms import annotations, confusion_summary, term_ids
from scriptmill.operators.wording import worded
from scriptmill.runtime import Workspace
from scriptmill.schema import FINDING_TYPES, SEVERITIES, Thresholds
from scriptmill.sources.glossary import Glossary
from scriptmill.sources.transcriber import transcribe_all
from scriptmill.sources.transcripts import bind, has_timestamps, normalize_response


@dataclass
class Report:
    """Lazy tables of one analysis."""

    transcripts: DataFrame
    segments: DataFrame  # bound
    findings: DataFrame
    groups: DataFrame

    def by_type(self, name: str) -> DataFrame:
        return self.findings.filter(F.col("type") == name)

    def ordered(self) -> DataFrame:
        return report.ordered(self.findings)

    def flags(self) -> DataFrame:
        return report.segment_flags(self.findings)

    def summary(self) -> DataFrame:
        return report.summary(self.transcripts, self.findings, self.groups, has_timestamps(self.segments))


def _with_reference(segments: DataFrame, transcripts: DataFrame) -> DataFrame:
    if "reference_s" in segments.columns:
        return segments
    return segments.join(transcripts.select("transcript_id", "reference_s"), "transcript_id", "left")


def analyze(transcripts: DataFrame, segments: DataFrame, glossary: Glossary | None = None, thresholds: Thresholds | None = None, compatibility: bool = True, workspace: Workspace | None = None) -> Report:
    """Run every check on every transcript.

    ``transcripts``: transcript_id, text, reference_s. ``segments``: the table
    of :mod:`scriptmill.sources.transcripts`. All window and grouping steps are
    keyed by transcript, so they share one partitioning. With a ``workspace``,
    transcripts, bound segments and findings are written once instead of being derived anew
    for every check and every later use.
    """
    th = thresholds or Thresholds()
    transcripts = transcripts.withColumn("transcript_id", F.col("transcript_id").cast("string"))
    bound = bind(_with_reference(segments.withColumn("transcript_id", F.col("transcript_id").cast("string")), transcripts), compatibility)
    if workspace is not None:
        transcripts, bound = workspace.save(transcripts, "transcripts"), workspace.save(bound, "segments")
    groups = checks.duplicate_groups(bound)
    parts = [
        checks.structure_check(transcripts, bound),
        checks.segment_checks(bound, th),
        checks.consistency_check(transcripts, bound, th, compatibility),
        checks.duplicate_checks(groups, th, compatibility),
        checks.phrase_checks(transcripts, bound, th, compatibility),
    ]
    if glossary is not None:
        parts += [checks.term_checks(transcripts, bound, glossary), checks.confusable_checks(transcripts, bound, glossary, compatibility)]
    findings = reduce(DataFrame.unionByName, parts)
    return Report(transcripts, bound, workspace.save(findings, "findings") if workspace is not None else findings, groups)


@dataclass
class Prepared:
    segments: DataFrame
    documents: DataFrame  # one row a transcript
    status: DataFrame  # (transcript_id, status) of verification
    verification: DataFrame  # the whole record of verification


def prepare_transcripts(r: Report, glossary: Glossary | None = None, alternative: tuple[DataFrame, DataFrame] | None = None, failures: DataFrame | None = None, compatibility: bool = True) -> Prepared:
    """Prepared segments and documents of a report. ``alternative``: (transcripts, segments) of second transcriptions; ``failures``: (transcript_id, error) of those that could not be made."""
    suspects, merges, verdicts, outcome, alt_text, alt_segments = prepare.suspect_keys(r.findings), None, None, None, None, None
    requested = alternative is not None or failures is not None
    if alternative is not None:
        alt_text, alt_segments = (x.withColumn("transcript_id", F.col("transcript_id").cast("string")) for x in alternative)
        verdicts = verify.group_verdicts(r.transcripts, r.groups, alt_text, compatibility)
        outcome = verify.outcomes(verdicts)
        merges = prepare.merge_plan(r.segments, verdicts, outcome, suspects, alt_segments, compatibility)
    status = verify.statuses(r.transcripts, r.groups, outcome, requested, failures)
    record = verify.verification(status, r.groups, requested, verdicts, outcome, alt_text, alt_segments, failures)
    segments = prepare.prepared_segments(r.transcripts, r.segments, r.flags(), suspects, merges)
    if glossary is not None:
        segments = segments.withColumn("terminology", annotations("cleaned_text", glossary))
    summary = r.summary()
    listed = segments.withColumn("duration_seconds", prepared_duration("start_seconds", "end_seconds"))
    fields = [c for c in listed.columns if c != "transcript_id"]
    nested = listed.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("segments"))
    documents = (
        r.transcripts.withColumnRenamed("text", "raw_transcript")
        .join(prepare.assembled(r.transcripts, segments, compatibility), "transcript_id", "left")
        .join(nested, "transcript_id", "left")
        .join(record, "transcript_id", "left")
        .join(summary.drop("reference_s"), "transcript_id", "left")
        .join(report.type_counts(r.findings), "transcript_id", "left")
        .join(prepare.run_status(summary, status), "transcript_id", "left")
        .join(prepare.review_notes(r.findings, r.groups, status, segments), "transcript_id", "left")
    ).withColumn("verification_status", F.col("verification.status"))
    if glossary is not None:
        words = documents.select("transcript_id", F.coalesce("cleaned_transcript", F.lit("")).alias("text"))
        found = confusion_summary(words, glossary, compatibility).groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("word", "suspected_word", "occurrences", "source", "example_context"))).alias("known_confusions_detected"))
        documents = documents.withColumn("term_ids_detected", term_ids("cleaned_transcript", glossary)).join(found, "transcript_id", "left")
    return Prepared(segments, documents, status, record)


#: What cleaning does to a text (fixed names).
APPLIED = ("unicode_nfkc", "whitespace_collapse", "space_before_punctuation", "bracket_spacing", "space_after_clause_punctuation", "ellipsis_normalisation")


def _utc_now():
    """The time of the query in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def prepared_document(documents: DataFrame, glossary: Glossary | None = None) -> DataFrame:
    """(transcript_id, document): the prepared transcript as one struct, schema version 2."""
    seconds = lambda c: F.round(c, 3)
    optional = lambda n: (F.col(n) if n in documents.columns else F.lit(None).cast("string")).alias(n)
    new = F.coalesce("unexpected_new_words", F.array().cast("array<string>")).alias("unexpected_new_words")
    cleaning = F.struct(F.array(*map(F.lit, APPLIED)).alias("applied"), *(F.lit(False).alias(c) for c in ("rewrote_words", "grammar_corrected", "translated", "removed_content")), "raw_word_count", "cleaned_word_count", new)
    qa = F.struct("total_findings", F.struct(*SEVERITIES).alias("by_severity"), "by_type", "max_severity", "needs_review", "duplicate_group_count", "has_timestamps", seconds(F.col("reference_s")).alias("duration_reference_seconds"), F.col("notes").alias("review_notes"))
    terms = F.lit(None).cast("string")
    if glossary is not None:
        g = glossary.summary()
        terms = F.struct(*(F.lit(g[k]).alias(k) for k in ("term_count", "translated_terms", "kept_in_english")), F.array(*map(F.lit, g["categories"])).alias("categories"), "term_ids_detected", "known_confusions_detected")
    return documents.select("transcript_id", F.struct(
        F.lit(2).alias("schema_version"), F.lit("prepared_transcript").alias("artifact_type"), _utc_now().alias("generated_at"), F.col("transcript_id").alias("source_artifact"),
        optional("source_file"), optional("source_path"), (F.col("model") if "model" in documents.columns else F.lit(None).cast("string")).alias("transcription_model"), optional("language"), optional("processing_timestamp"), optional("processing_status"), seconds(F.col("reference_s")).alias("processed_duration_seconds"),
        cleaning.alias("cleaning"), "verification", qa.alias("qa_summary"), terms.alias("terminology_summary"), "cleaned_transcript", "raw_transcript", "segments",
    ).alias("document"))


def qa_document(r: Report, record: DataFrame) -> DataFrame:
    """(transcript_id, document): the quality report as one struct, schema version 1. ``record``: the verification of :class:`Prepared`."""
    f = worded(r.ordered()).withColumn("time_range", F.when(F.col("range_start").isNotNull(), F.struct(F.round("range_start", 3).alias("start"), F.round("range_end", 3).alias("end"))))
    listed = f.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("place", "type", "severity", "summary", "explanation", "suggested_action", "segment_ids", "time_range", "evidence")), lambda a, b: a["place"] - b["place"]).alias("findings"))
    g = r.groups.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("first_idx", "segment_ids", "exact", F.substring("normalized_text", 1, 200).alias("normalized_text")))).alias("duplicate_groups"))
    flags = r.flags().groupBy("transcript_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "flags")))).alias("segment_flags"))
    d = r.summary().join(listed, "transcript_id", "left").join(g, "transcript_id", "left").join(flags, "transcript_id", "left").join(report.type_counts(r.findings), "transcript_id", "left").join(record, "transcript_id", "left").join(verify.review_text(r.groups), "transcript_id", "left")
    return d.select("transcript_id", F.struct(
        F.lit(1).alias("schema_version"), F.lit("transcript_quality_report").alias("artifact_type"), _utc_now().alias("generated_at"),
        F.struct("total_findings", F.struct(*SEVERITIES).alias("by_severity"), "by_type", "duplicate_group_count", "max_severity", "needs_review", "has_timestamps", F.round("reference_s", 3).alias("duration_reference_seconds")).alias("summary"),
        F.array(*map(F.lit, SEVERITIES)).alias("severity_scale"), "findings", "duplicate_groups", "verification", "alternative_segments", F.when(~F.col("verification.supports_correction"), F.col("review")).alias("review_summary"), "segment_flags",
    ).alias("document"))


def second_transcriptions(r: Report, media: DataFrame, transcriber, workspace: Workspace, attempts: int = 1) -> tuple[tuple[DataFrame, DataFrame], DataFrame]:
    """Second transcriptions of the transcripts with repeated segments, as ``alternative`` and ``failures`` of :func:`prepare_transcripts`.

    ``media`` has (transcript_id, path). Answers are written once, because a
    call that is made again costs money and may answer otherwise. A transcript
    without media is a failure of no attempts.
    """
    wanted = r.groups.select("transcript_id").distinct()
    paths = wanted.join(media.select(F.col("transcript_id").cast("string").alias("transcript_id"), "path"), "transcript_id", "left")
    answers = workspace.save(transcribe_all(paths.filter("path IS NOT NULL"), transcriber, attempts), "answers")
    lost = paths.filter("path IS NULL").select("transcript_id", F.lit("no media of this transcript").alias("error"), F.lit(0).alias("attempts"), F.lit(False).alias("retryable"))
    failures = answers.filter("error IS NOT NULL").select("transcript_id", "error", "attempts", "retryable").unionByName(lost)
    n = normalize_response(answers.filter("error IS NULL").select("transcript_id", "model", "response"))
    s = n.select("transcript_id", F.posexplode("segments").alias("idx", "s")).select("transcript_id", "idx", F.col("s.id").alias("key"), "s.start", "s.end", "s.text")
    return (n.select("transcript_id", F.coalesce("text", F.lit("")).alias("text"), "model"), s), failures


assert len(FINDING_TYPES) == 19
