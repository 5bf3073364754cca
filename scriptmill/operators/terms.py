"""Glossary annotation and probable mis-heard terms."""

from __future__ import annotations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.functions.text import SPACE, col, one_edit, word_tokens
from scriptmill.sources.glossary import MIN_WORD, Glossary, key_of


def _java(pattern: str) -> str:
    """The glossary's pattern with white space as Unicode text takes it."""
    return pattern.replace(r"\s+", f"[{SPACE}]+")


def matches(text: Column | str, glossary: Glossary) -> Column:
    """Matched surfaces in order: leftmost, longest, without overlap."""
    found = F.regexp_extract_all(col(text), F.lit(_java(glossary.pattern)), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def _surface_key(m: Column) -> Column:
    return F.regexp_replace(F.replace(F.lower(m), F.lit("."), F.lit("")), f"[{SPACE}]+", " ")


def match_ids(text: Column | str, glossary: Glossary) -> Column:
    """Term ids of all matches, in order of appearance."""
    ids = F.create_map(*[F.lit(x) for k, t in glossary.term_by_surface.items() for x in (k, t.id)])
    return F.transform(matches(text, glossary), lambda m: F.element_at(ids, _surface_key(m)))


def term_ids(text: Column | str, glossary: Glossary) -> Column:
    """Distinct term ids in order of first appearance."""
    return F.array_distinct(match_ids(text, glossary))


def term_offsets(text: Column | str, glossary: Glossary) -> Column:
    """Matches with character offsets (array of structs); offsets are the only part that needs Python."""
    pattern, by_surface = regex.compile(_java(glossary.pattern)), {k: (t.id, t.canonical, t.category, t.ambiguous) for k, t in glossary.term_by_surface.items()}

    @F.pandas_udf("array<struct<term_id:string,canonical:string,category:string,matched_text:string,start_char:int,end_char:int,ambiguous:boolean>>")
    def found(s: pd.Series) -> pd.Series:
        def one(x):
            out = []
            for m in pattern.finditer(x or ""):
                i, canonical, category, ambiguous = by_surface[" ".join(m[0].lower().replace(".", "").split())]
                out.append({"term_id": i, "canonical": canonical, "category": category, "matched_text": m[0], "start_char": m.start(), "end_char": m.end(), "ambiguous": ambiguous})
            return out

        return s.map(one)

    return found(col(text))


def annotations(text: Column | str, glossary: Glossary) -> Column:
    """Matches as structs without offsets, in the JVM."""
    info = F.create_map(*[x for k, t in glossary.term_by_surface.items() for x in (F.lit(k), F.struct(F.lit(t.id).alias("term_id"), F.lit(t.canonical).alias("canonical"), F.lit(t.category).alias("category"), F.lit(t.ambiguous).alias("ambiguous")))])

    def one(m):
        t = F.element_at(info, _surface_key(m))
        return F.struct(t["term_id"].alias("term_id"), t["canonical"].alias("canonical"), t["category"].alias("category"), m.alias("matched_text"), t["ambiguous"].alias("ambiguous"))

    return F.transform(matches(text, glossary), one)


def token_positions(transcripts: DataFrame, compatibility: bool = True, wanted=None) -> DataFrame:
    """(transcript_id, pos, token, following, context): one row a token, with its neighbours from the same array; no shuffle. ``wanted`` selects tokens while they are still in the array."""
    t = transcripts.select("transcript_id", word_tokens("text", compatibility).alias("_t"))
    around = lambda i: F.array_join(F.slice("_t", F.greatest(i - 1, F.lit(1)), F.lit(5) - F.greatest(F.lit(2) - i, F.lit(0))), " ")  # noqa: E731  two words to either side
    rows = F.transform("_t", lambda w, i: F.struct(i.alias("pos"), w.alias("token"), F.get("_t", i + 1).alias("following")))
    rows = rows if wanted is None else F.filter(rows, wanted)
    rows = F.transform(rows, lambda x: F.struct(x["pos"].alias("pos"), x["token"].alias("token"), x["following"].alias("following"), around(x["pos"]).alias("context")))
    return t.select("transcript_id", F.explode(rows).alias("_x")).select("transcript_id", "_x.*")


def find_confusables(transcripts: DataFrame, glossary: Glossary, compatibility: bool = True) -> DataFrame:
    """(transcript_id, word, suspected_word, distance, position, context, source): one row for each word and suspect of a transcript.

    Confirmed confusions are equal words; anchored ones stand one edit from an
    anchor's first word right before its second. Both are joins with glossary
    dimensions; only hits are shuffled, to keep the first of each pair.
    """
    spark = transcripts.sparkSession
    wrong, second = sorted({key_of(w) for w, _, _ in glossary.confusions}), sorted({s for _, s in glossary.anchors})
    tokens = token_positions(transcripts, compatibility, lambda x: F.coalesce(x["token"].isin(*wrong) | x["following"].isin(*second), F.lit(False)))
    known = tokens.join(glossary.confusions_df(spark), F.col("token") == F.col("wrong")).select(
        "transcript_id", "pos", F.lit(0).alias("kind"), F.col("confusion_seq").alias("seq"), F.col("token").alias("word"), F.col("right").alias("suspected_word"), "context", F.lit("known_confusion").alias("source"))
    near = tokens.join(glossary.anchors_df(spark), F.col("following") == F.col("second")).filter((F.length("token") >= MIN_WORD) & one_edit("token", "first") & ~F.col("token").isin(*glossary.vocabulary, *glossary.stop_words)).select(
        "transcript_id", "pos", F.lit(1).alias("kind"), F.col("anchor_seq").alias("seq"), F.col("token").alias("word"), F.col("first").alias("suspected_word"), F.concat_ws(" ", "token", "following").alias("context"), F.lit("anchored_edit").alias("source"))
    first = Window.partitionBy("transcript_id", "word", "suspected_word").orderBy("kind", F.when(F.col("kind") == 0, F.col("seq")).otherwise(0), "pos", "seq")
    rows = known.unionByName(near).withColumn("_n", F.row_number().over(first)).filter("_n = 1")
    return rows.select("transcript_id", "word", "suspected_word", F.lit(1).alias("distance"), F.col("pos").alias("position"), "context", "source")


def confusion_summary(transcripts: DataFrame, glossary: Glossary, compatibility: bool = True) -> DataFrame:
    """Confusables with how often the word occurs in the text at all."""
    found = find_confusables(transcripts, glossary, compatibility)
    tokens = transcripts.select("transcript_id", F.explode(word_tokens("text", compatibility)).alias("word"))
    counts = tokens.groupBy("transcript_id", "word").agg(F.count("*").alias("occurrences"))
    return found.join(counts, ["transcript_id", "word"]).select("transcript_id", "word", "suspected_word", "occurrences", "source", F.col("context").alias("example_context"))


def contains_any_word(norm: Column | str, words: Column) -> Column:
    """Whether a text (by its comparison key) holds one of the words."""
    return F.arrays_overlap(F.split(col(norm), " "), words)
