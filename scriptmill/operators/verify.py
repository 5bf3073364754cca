"""Comparing transcripts with an independent second transcription."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.functions.text import clean_text, comparison_key, count_occurrences, join_texts

#: Verdicts that speak against a repetition (fixed values).
AGAINST = ("absent_from_alternative", "less_frequent_in_alternative")


def verdict(original: Column, alternative: Column) -> Column:
    """What counts of a phrase in both transcriptions say."""
    return F.when((alternative == 0) & (original > 0), AGAINST[0]).when(alternative < original, AGAINST[1]).otherwise("present_in_alternative")


def adjacent_duplicates(segments: DataFrame, compatibility: bool = True) -> DataFrame:
    """(transcript_id, has_adjacent): whether neighbours say the same, blanks left out."""
    s = segments.select("transcript_id", "idx", comparison_key("text", compatibility).alias("_k")).filter("_k <> ''")
    same = F.col("_k") == F.lag("_k").over(Window.partitionBy("transcript_id").orderBy("idx"))
    return s.select("transcript_id", same.alias("_same")).groupBy("transcript_id").agg(F.coalesce(F.bool_or("_same"), F.lit(False)).alias("has_adjacent"))


def group_verdicts(transcripts: DataFrame, groups: DataFrame, alternative: DataFrame, compatibility: bool = True) -> DataFrame:
    """Rows (transcript_id, first_idx, segment_ids, phrase, counts, verdict) of duplicate groups that have a second transcription.

    ``alternative`` has (transcript_id, text). Keys are made once a transcript,
    before groups are joined to them.
    """
    a = alternative.select("transcript_id", comparison_key("text", compatibility).alias("_alt"))
    texts = transcripts.select("transcript_id", comparison_key("text", compatibility).alias("_own")).join(a, "transcript_id")
    g = groups.select("transcript_id", "first_idx", "segment_ids", F.col("normalized_text").alias("_phrase")).join(texts, "transcript_id")
    g = g.select("transcript_id", "first_idx", "segment_ids", F.substring("_phrase", 1, 200).alias("phrase"), count_occurrences("_own", "_phrase").alias("in_original"), count_occurrences("_alt", "_phrase").alias("in_alternative"), (F.col("_alt") == "").alias("alternative_empty"))
    return g.withColumn("verdict", verdict(F.col("in_original"), F.col("in_alternative")))


def outcomes(verdicts: DataFrame) -> DataFrame:
    """(transcript_id, status, confirmed, contradicted): one verdict a transcript; mixed or empty evidence decides nothing."""
    against = F.col("verdict").isin(*AGAINST)
    g = verdicts.groupBy("transcript_id").agg(F.count_if(~against).alias("confirmed"), F.count_if(against).alias("contradicted"), F.bool_or("alternative_empty").alias("_empty"))
    status = F.when(F.col("_empty") | ((F.col("confirmed") > 0) & (F.col("contradicted") > 0)), "inconclusive").when(F.col("contradicted") > 0, "duplicate_contradicted").otherwise("duplicate_confirmed")
    return g.select("transcript_id", status.alias("status"), "confirmed", "contradicted")


def statuses(transcripts: DataFrame, groups: DataFrame, verified: DataFrame | None, requested: bool, available: DataFrame | None = None) -> DataFrame:
    """The verification status of every transcript: not requested or nothing to verify, no second transcription, or the outcome."""
    t = transcripts.select("transcript_id")
    if not requested or verified is None:
        return t.withColumn("status", F.lit("not_performed"))
    has = groups.select("transcript_id").distinct().withColumn("_has", F.lit(True))
    out = t.join(has, "transcript_id", "left").join(verified.select("transcript_id", "status"), "transcript_id", "left")
    status = F.when(F.col("_has").isNull(), "not_performed").otherwise(F.coalesce("status", F.lit("inconclusive")))
    if available is not None:  # attempts that ended in an error
        out = out.join(available.select("transcript_id", F.col("error").alias("_error")), "transcript_id", "left")
        status = F.when(F.col("_has").isNotNull() & F.col("_error").isNotNull(), "failed").otherwise(status)
    return out.select("transcript_id", status.alias("status"))


#: What each status means for a reader.
DETAILS = {
    "not_performed": "No second transcription was compared.",
    "duplicate_confirmed": "The second transcription holds every repeated phrase as often.",
    "duplicate_contradicted": "The second transcription lacks repetitions of the first.",
    "inconclusive": "The second transcription is missing, blank, or speaks for some repetitions and against others.",
    "failed": "No second transcription could be made; the first one stays as it is.",
}


def verification(status: DataFrame, groups: DataFrame, requested: bool, verdicts: DataFrame | None = None, outcome: DataFrame | None = None, alternative: DataFrame | None = None, alternative_segments: DataFrame | None = None, failures: DataFrame | None = None) -> DataFrame:
    """(transcript_id, verification, alternative_segments, alternative_text): the whole record of what was compared.

    ``alternative`` may have a column ``model``, ``failures`` columns
    ``attempts`` and ``retryable``.
    """
    t = status.join(groups.select("transcript_id").distinct().withColumn("_has", F.lit(True)), "transcript_id", "left")
    optional = {"model": "string", "confirmed": "bigint", "contradicted": "bigint", "_groups": "array<struct<phrase:string,in_original:bigint,in_alternative:bigint,verdict:string>>", "last_error": "string", "retryable": "boolean", "_failed": "int", "alternative_segments": "array<struct<id:string,start:double,end:double,text:string>>", "alternative_text": "string", "has_adjacent": "boolean"}
    if alternative is not None and "model" in alternative.columns:
        t = t.join(alternative.select("transcript_id", "model"), "transcript_id", "left")
    if outcome is not None:
        t = t.join(outcome.select("transcript_id", "confirmed", "contradicted"), "transcript_id", "left")
    if verdicts is not None:
        said = F.struct("first_idx", F.col("phrase"), F.col("in_original").cast("bigint").alias("in_original"), F.col("in_alternative").cast("bigint").alias("in_alternative"), "verdict")
        listed = verdicts.groupBy("transcript_id").agg(F.array_sort(F.collect_list(said)).alias("_g"))
        t = t.join(listed.select("transcript_id", F.transform("_g", lambda g: F.struct(*[g[k].alias(k) for k in ("phrase", "in_original", "in_alternative", "verdict")])).alias("_groups")), "transcript_id", "left")
    if failures is not None:
        more = [F.col(c).alias(n) for c, n in (("retryable", "retryable"), ("attempts", "_failed")) if c in failures.columns]
        t = t.join(failures.select("transcript_id", F.col("error").alias("last_error"), *more), "transcript_id", "left")
    if alternative_segments is not None and {"idx", "key", "start", "end"} <= set(alternative_segments.columns):
        t = t.join(alternative_table(alternative_segments), "transcript_id", "left").join(adjacent_duplicates(alternative_segments), "transcript_id", "left")
    t = t.withColumns({c: F.lit(None).cast(kind) for c, kind in optional.items() if c not in t.columns})
    performed, failed = F.col("status") != "not_performed", F.col("status") == "failed"
    detail = F.when(~performed, F.lit("Verification was not requested.") if not requested else F.when(F.col("_has").isNull(), "Nothing is repeated, so nothing had to be verified.").otherwise(DETAILS["not_performed"]))
    for s in [k for k in DETAILS if k != "not_performed"]:
        detail = detail.when(F.col("status") == s, DETAILS[s])
    return t.select(
        "transcript_id",
        F.struct(
            performed.alias("performed"), F.col("status"), F.when(performed, "second_transcription").otherwise("none").alias("method"), detail.alias("detail"),
            F.when(~performed, 0).when(failed, F.coalesce("_failed", F.lit(1))).when(F.col("confirmed").isNull(), 0).otherwise(1).alias("attempts"), F.col("model"), (F.col("status") == "duplicate_contradicted").alias("supports_correction"),
            F.struct(F.col("confirmed").alias("confirmed_groups"), F.col("contradicted").alias("contradicted_groups"), F.col("_groups").alias("groups"), F.col("has_adjacent").alias("alternative_repeats_neighbours"), F.when(failed, F.col("last_error")).alias("last_error"), F.when(failed, F.col("retryable")).alias("retryable")).alias("evidence"),
        ).alias("verification"),
        "alternative_segments", "alternative_text",
    )


def alternative_table(segments: DataFrame) -> DataFrame:
    """(transcript_id, alternative_segments, alternative_text): the second transcription's segments with their times, and their joined text."""
    s = segments.select("transcript_id", "idx", "key", "start", "end", "text", clean_text("text").alias("cleaned"))
    s = s.groupBy("transcript_id").agg(F.array_sort(F.collect_list(F.struct("idx", "key", "start", "end", "text", "cleaned"))).alias("_s"))
    shown = F.transform("_s", lambda x: F.struct(x["key"].alias("id"), F.round(x["start"], 3).alias("start"), F.round(x["end"], 3).alias("end"), x["text"].alias("text")))
    return s.select("transcript_id", shown.alias("alternative_segments"), join_texts(F.col("_s.cleaned")).alias("alternative_text"))


def review_text(groups: DataFrame) -> DataFrame:
    """(transcript_id, review): what a reviewer has to decide, one line a group."""
    line = F.concat(F.lit("  - segments "), F.array_join("segment_ids", ", "), F.lit(": "), F.substring("normalized_text", 1, 120))
    g = groups.groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first_idx", line.alias("line")))), lambda x: x["line"]).alias("_l"))
    return g.select("transcript_id", F.concat(F.lit("Repeated text that could not be decided:\n"), F.array_join("_l", "\n"), F.lit("\nListen to these places and decide whether each was spoken.")).alias("review"))
