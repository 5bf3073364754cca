"""The quality checks. Each returns rows of the findings schema; all work on many transcripts at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.functions.similarity import key_similarity
from scriptmill.functions.text import clean_text, comparison_key, join_texts, tokens_of_key
from scriptmill.operators import phrases, terms
from scriptmill.schema import FINDING_COLUMNS, Thresholds, rank_of
from scriptmill.sources.glossary import Glossary

#: Order in which the checks report, for stable sorting.
STRUCTURE, EMPTY, TIMES, ORDER, PAIRS, BOUNDS, COVERAGE, LENGTHS, CONSISTENCY, DUPLICATES, PHRASES, TERMS, CONFUSABLES = range(1, 14)


def _evidence(**values: Column) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*[v.cast("string") for v in values.values()])) if values else F.lit(None).cast("map<string,string>")


def finding(seq: int, emit: Column, type_: Column | str, severity: Column | str, ids: Column, start: Column | None = None, end: Column | None = None, **evidence: Column) -> Column:
    """One finding as a struct; a range needs both ends."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    none = F.lit(None).cast("double")
    both = start.isNotNull() & end.isNotNull() if start is not None and end is not None else F.lit(False)
    return F.struct(
        F.lit(seq).alias("check_seq"), emit.cast("long").alias("emit_seq"), lit(type_).alias("type"), lit(severity).alias("severity"), rank_of(lit(severity)).alias("rank"), ids.alias("segment_ids"),
        F.when(both, start).otherwise(none).alias("range_start") if start is not None else none.alias("range_start"), F.when(both, end).otherwise(none).alias("range_end") if end is not None else none.alias("range_end"), _evidence(**evidence).alias("evidence"),
    )


def _rows(df: DataFrame, *found: Column) -> DataFrame:
    """Rows of the findings that are not null."""
    return df.select(F.col("transcript_id").cast("string").alias("transcript_id"), F.explode(F.array_compact(F.array(*found))).alias("_f")).select("transcript_id", "_f.*").select(*FINDING_COLUMNS)


def empty_findings(spark) -> DataFrame:
    from scriptmill.schema import FINDING_DDL

    return spark.createDataFrame([], FINDING_DDL)


def bare(seq, emit, type_, severity, ids, start=None, end=None, **evidence) -> Column:
    """A finding without its evidence, for reports that only count."""
    return finding(seq, emit, type_, severity, ids, start, end)


def segment_checks(bound: DataFrame, th: Thresholds = Thresholds(), kinds: set[str] | None = None, evidence: bool = True) -> DataFrame:
    """The checks that look at a segment and its neighbours, from one scan and one sort per transcript. Needs a column reference_s (null: unknown).

    With ``kinds``, only these types are looked for, so that neither their
    columns nor their windows are made for others.
    """
    make = finding if evidence else bare
    order = Window.partitionBy("transcript_id").orderBy("idx")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("transcript_id")
    timed = F.col("duration").isNotNull()
    s = bound.withColumns({
        "_prev_start": F.lag("start").over(order), "_prev_key": F.lag("key").over(order),
        "_prev_end": F.last(F.when(timed, F.col("end")), True).over(before), "_prev_timed": F.last(F.when(timed, F.col("key")), True).over(before),
        "_next_timed": F.max(F.when(timed, F.col("idx"))).over(whole), "_first_timed": F.min(F.when(timed, F.col("idx"))).over(whole), "_median": F.median("duration").over(whole),
    })
    key, idx, start, end, ref = F.array("key"), F.col("idx"), F.col("start"), F.col("end"), F.col("reference_s")
    pair = F.array("_prev_timed", "key")
    delta, limit = start - F.col("_prev_end"), F.greatest(F.lit(th.long_floor), F.col("_median") * th.long_factor)
    bad = F.array_compact(F.array(F.when(~F.col("start_valid"), "start"), F.when(~F.col("end_valid"), "end")))
    usable = F.col("start_valid") & F.col("end_valid")
    late = (start > ref + th.bounds) | (end > ref + th.bounds)
    found = {
        "empty_segment": lambda: F.when(F.trim("cleaned") == "", make(EMPTY, idx, "empty_segment", "medium", key, start, end, raw_text=F.col("text"))),
        "invalid_timestamp": lambda: F.when(~usable, make(TIMES, idx, "invalid_timestamp", "high", key, None, None, fields=F.array_join(bad, ","), start_raw=F.col("start_raw"), end_raw=F.col("end_raw"))),
        "segment_end_before_start": lambda: F.when(usable & (end <= start), make(TIMES, idx, "segment_end_before_start", "critical", key, start, end)),
        "segment_out_of_order": lambda: F.when(start < F.col("_prev_start"), make(ORDER, idx, "segment_out_of_order", "high", F.array("_prev_key", "key"), None, None, previous_start=F.col("_prev_start"), current_start=start)),
        "segment_gap": lambda: F.when(timed & (delta > th.gap), make(PAIRS, idx, "segment_gap", "low", pair, F.col("_prev_end"), start, gap_seconds=F.round(delta, 3))),
        "segment_overlap": lambda: F.when(timed & (delta < -th.overlap), make(PAIRS, idx, "segment_overlap", "medium", pair, start, F.col("_prev_end"), overlap_seconds=F.round(-delta, 3))),
        "segment_timestamp_out_of_bounds": lambda: F.when(timed & late, make(BOUNDS, idx, "segment_timestamp_out_of_bounds", "high", key, start, end, reference_duration_seconds=F.round(ref, 3))),
        "incomplete_speech_at_start": lambda: F.when((idx == F.col("_first_timed")) & ref.isNotNull() & (start > th.start_silence), make(COVERAGE, F.lit(0), "incomplete_speech_at_start", "medium", key, F.lit(0.0), start, uncovered_seconds=F.round(start, 3))),
        "incomplete_speech_at_end": lambda: F.when((idx == F.col("_next_timed")) & (ref - end > th.end_silence), make(COVERAGE, F.lit(1), "incomplete_speech_at_end", "medium", key, end, ref, uncovered_seconds=F.round(ref - end, 3))),
        "segment_suspiciously_short": lambda: F.when(F.col("duration") < th.shortest, make(LENGTHS, idx, "segment_suspiciously_short", "low", key, start, end, duration_seconds=F.round("duration", 3))),
        "segment_suspiciously_long": lambda: F.when(F.col("duration") > limit, make(LENGTHS, idx, "segment_suspiciously_long", "medium", key, start, end, duration_seconds=F.round("duration", 3), median_duration_seconds=F.round("_median", 3), long_segment_threshold_seconds=F.round(limit, 3))),
    }
    return _rows(s, *(f() for kind, f in found.items() if kinds is None or kind in kinds))


def structure_check(transcripts: DataFrame, segments: DataFrame) -> DataFrame:
    """Transcripts without segments: critical without text either, high with text."""
    bare = transcripts.join(segments.select("transcript_id").distinct(), "transcript_id", "left_anti")
    blank = F.coalesce(F.trim(clean_text("text", False)), F.lit("")) == ""
    return _rows(bare, finding(STRUCTURE, F.lit(0), "no_segments", F.when(blank, "critical").otherwise("high"), F.array().cast("array<string>")))


def joined_segments(bound: DataFrame) -> DataFrame:
    """(transcript_id, joined, keys): segment texts as one text, in order."""
    ordered = F.array_sort(F.collect_list(F.struct("idx", "cleaned", "key")))
    return bound.groupBy("transcript_id").agg(ordered.alias("_s")).select("transcript_id", join_texts(F.col("_s.cleaned")).alias("joined"), F.col("_s.key").alias("keys"))


def consistency(transcripts: DataFrame, bound: DataFrame, compatibility: bool = True) -> DataFrame:
    """(transcript_id, raw_text, joined, keys, ratio): how far text and segments agree; ratio is null where the text is blank."""
    both = transcripts.select("transcript_id", clean_text("text", compatibility).alias("raw_text")).join(joined_segments(bound), "transcript_id")
    key = lambda c: F.when(F.col("raw_text") != "", comparison_key(c, compatibility))
    # keys as columns first: inside the similarity's branches they would be made again and again
    both = both.select("*", key("raw_text").alias("_a"), key("joined").alias("_b"))
    return both.select("*", key_similarity(F.col("_a"), F.col("_b")).alias("ratio")).drop("_a", "_b")


def consistency_check(transcripts: DataFrame, bound: DataFrame, th: Thresholds = Thresholds(), compatibility: bool = True) -> DataFrame:
    c, ratio = consistency(transcripts, bound, compatibility), F.col("ratio")
    return _rows(
        c,
        F.when(F.col("raw_text") == "", finding(CONSISTENCY, F.lit(0), "transcript_segment_mismatch", "high", F.col("keys"))),
        F.when(ratio < th.text_match, finding(CONSISTENCY, F.lit(0), "transcript_segment_mismatch", F.when(ratio < 0.5, "high").otherwise("medium"), F.col("keys"), similarity=F.round(ratio, 4), transcript_characters=F.length("raw_text"), segment_characters=F.length("joined"))),
    )


def duplicate_groups(bound: DataFrame) -> DataFrame:
    """Segments of a transcript with one comparison key, two or more of them.

    Keys of segments need not be unique. As with a look-up table keyed by
    segment id, the last row of an id stands for all its rows, and a group is
    exact only if none of its ids is used by another text. One hash
    partitioning by transcript serves both windows and the grouping.
    """
    by_id = Window.partitionBy("transcript_id", "key")
    stand_in = F.max(F.struct("idx", "norm", "start", "end", "duration", "text")).over(by_id)
    s = bound.select("transcript_id", "idx", "key", "norm", stand_in.alias("_last"), ((F.min("norm").over(by_id) == F.col("norm")) & (F.max("norm").over(by_id) == F.col("norm"))).alias("_own"))
    members = F.array_sort(F.collect_list(F.struct("idx", "key", "_last")))
    g = s.filter("norm <> ''").groupBy("transcript_id", "norm").agg(members.alias("_m"), F.bool_and("_own").alias("exact"), F.min("idx").alias("first_idx")).filter(F.size("_m") > 1)
    last = F.col("_m._last")
    places = last["idx"]
    timed = F.filter(last, lambda x: x["duration"].isNotNull())
    spans = timed["duration"]
    return g.select(
        "transcript_id", F.col("norm").alias("normalized_text"), "first_idx", F.col("_m.key").alias("segment_ids"), F.size("_m").alias("size"), "exact",
        (F.col("exact") & (F.size(F.array_distinct(last["norm"])) == 1)).alias("same_text"),
        ((F.size(F.array_distinct(places)) == F.size(places)) & (F.array_max(places) - F.array_min(places) == F.size(places) - 1)).alias("adjacent"),
        F.array_min(timed["start"]).alias("range_start"), F.array_max(timed["end"]).alias("range_end"),
        F.size(spans).alias("n_durations"), F.array_min(spans).alias("shortest"), F.array_max(spans).alias("longest"),
        last[0]["text"].alias("first_text"), F.element_at(last, -1)["text"].alias("last_text"),
    )


def duplicate_checks(groups: DataFrame, th: Thresholds = Thresholds(), compatibility: bool = True, evidence: bool = True) -> DataFrame:
    """Findings of duplicate groups, and of copies that last very differently."""
    make = finding if evidence else bare
    unlike = ~F.col("same_text")
    key = lambda c: F.when(unlike, comparison_key(c, compatibility))
    g = groups.withColumns({"_a": key("first_text"), "_b": key("last_text")})
    g = g.withColumn("_ratio", F.coalesce(key_similarity(F.col("_a"), F.col("_b")), F.lit(1.0)))
    emit, exact = F.col("first_idx") * 2, F.col("same_text")
    return _rows(
        g,
        make(DUPLICATES, emit, F.when(exact, "exact_duplicate_segment").otherwise("near_duplicate_segment"), F.when(exact & F.col("adjacent"), "high").otherwise("medium"), F.col("segment_ids"), F.col("range_start"), F.col("range_end"),
                exact_match=exact, adjacent=F.col("adjacent"), similarity=F.round("_ratio", 4), normalized_text=F.substring("normalized_text", 1, 200), segment_count=F.col("size")),
        F.when(exact & (F.col("n_durations") >= 2) & (F.col("shortest") > 0) & (F.col("longest") / F.nullif(F.col("shortest"), F.lit(0.0)) >= th.duration_ratio),
               make(DUPLICATES, emit + 1, "duplicate_segment_duration_mismatch", "high", F.col("segment_ids"), F.col("range_start"), F.col("range_end"), shortest_seconds=F.round("shortest", 3), longest_seconds=F.round("longest", 3))),
    )


def word_ranges(bound: DataFrame) -> DataFrame:
    """(transcript_id, idx, key, first_word, past_word): the words of the joined text that each segment covers."""
    n = F.size(tokens_of_key("norm"))
    before = Window.partitionBy("transcript_id").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    s = bound.select("transcript_id", "idx", "key", n.alias("_n"))
    return s.withColumn("first_word", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("transcript_id", "idx", "key", "first_word", (F.col("first_word") + F.col("_n")).alias("past_word"))


def segments_at(positions: DataFrame, bound: DataFrame) -> DataFrame:
    """Rows (transcript_id, pos, ...) with the segment that covers the word position: positions and first words of a transcript in one order, where the last segment before a position is the one. Linear in both, not their product."""
    words = word_ranges(bound).filter("past_word > first_word")
    place = positions.schema["pos"].dataType
    starts = words.select("transcript_id", F.col("first_word").cast(place).alias("pos"), F.struct("past_word", "key").alias("_seg"), F.lit(0).alias("_asked"))
    both = positions.withColumns({"_seg": F.lit(None).cast(starts.schema["_seg"].dataType), "_asked": F.lit(1)}).unionByName(starts, allowMissingColumns=True)
    so_far = Window.partitionBy("transcript_id").orderBy("pos", "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = both.withColumn("_seg", F.last("_seg", True).over(so_far)).filter("_asked = 1 AND pos >= 0 AND pos < _seg.past_word")
    return at.select(*positions.columns, F.col("_seg.key").alias("key"))


def phrase_checks(transcripts: DataFrame, bound: DataFrame, th: Thresholds = Thresholds(), compatibility: bool = True) -> DataFrame:
    p = phrases.find_phrases(transcripts, th.phrase_words, compatibility)
    at = segments_at(p.select("transcript_id", "phrase_seq", F.posexplode("positions").alias("_order", "pos")), bound)
    first = at.groupBy("transcript_id", "phrase_seq", "key").agg(F.min("_order").alias("_order"))
    ids = first.groupBy("transcript_id", "phrase_seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("_order", "key"))), lambda x: x["key"]).alias("_ids"))
    rows = p.join(ids, ["transcript_id", "phrase_seq"], "left")
    return _rows(rows, finding(PHRASES, F.col("phrase_seq"), "repeated_phrase", "low", F.coalesce("_ids", F.array().cast("array<string>")), phrase=F.col("phrase"), word_count=F.col("word_count"), occurrences=F.col("occurrences")))


def term_checks(transcripts: DataFrame, bound: DataFrame, glossary: Glossary) -> DataFrame:
    found = transcripts.select("transcript_id", terms.term_ids("text", glossary).alias("_ids")).filter(F.size("_ids") > 0)
    hits = bound.filter(F.size(terms.matches("text", glossary)) > 0).groupBy("transcript_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "key"))), lambda x: x["key"]).alias("_keys"))
    return _rows(found.join(hits, "transcript_id", "left"), finding(TERMS, F.lit(0), "terminology_detected", "info", F.coalesce("_keys", F.array().cast("array<string>")), term_ids=F.array_join("_ids", ",")))


def confusable_checks(transcripts: DataFrame, bound: DataFrame, glossary: Glossary, compatibility: bool = True) -> DataFrame:
    c = terms.find_confusables(transcripts, glossary, compatibility)
    g = c.groupBy("transcript_id", "word").agg(F.count("*").alias("pairs"), F.min(F.struct("suspected_word", "distance")).alias("_s"), F.slice(F.array_sort(F.collect_set("context")), 1, 10).alias("contexts"))
    words = g.groupBy("transcript_id").agg(F.collect_set("word").alias("_words"))
    hits = bound.select("transcript_id", "idx", "key", "norm").join(words, "transcript_id").select("transcript_id", "idx", "key", F.explode(F.array_intersect(F.split("norm", " "), F.col("_words"))).alias("word"))
    first = hits.groupBy("transcript_id", "word", "key").agg(F.min("idx").alias("idx"))
    ids = first.groupBy("transcript_id", "word").agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "key"))), lambda x: x["key"]).alias("_ids"))
    g = g.join(ids, ["transcript_id", "word"], "left").withColumn("_seq", F.row_number().over(Window.partitionBy("transcript_id").orderBy("word")))
    return _rows(g, finding(CONFUSABLES, F.col("_seq"), "confusable_term", "medium", F.coalesce("_ids", F.array().cast("array<string>")), suspected_word=F.col("_s.suspected_word"), word=F.col("word"), occurrences=F.col("pairs"), edit_distance=F.col("_s.distance"), contexts=F.array_join("contexts", " | ")))
