"""Whole transcripts through the engine, from JSON files to findings and documents."""

import json

import pytest
from pyspark.sql import functions as F

from scriptmill.plans import engine
from scriptmill.runtime import Workspace
from scriptmill.sources.transcriber import TableTranscriber
from scriptmill.schema import GlossaryError, TranscriptFormatError
from scriptmill.sources import sinks
from scriptmill.sources.glossary import parse_glossary
from scriptmill.sources.transcripts import read_transcripts

GLOSSARY = {
    "schema_version": 1,
    "terms": [
        {"id": "bull_flag", "canonical": "rising bull flag", "category": "pattern", "aliases": ["rising flag"]},
        {"id": "gap", "canonical": "gap", "category": "structure", "aliases": ["gaps"], "speak_original": True},
        {"id": "ratio", "canonical": "golden ratio", "category": "core"},
        {"id": "ie", "canonical": "i.e."},
    ],
    "known_confusions": [{"wrong": "bare", "right": "bear"}],
    "confusable_extra_anchors": ["bear body"],
}


def seg(i, start, end, text="words that differ %d"):
    return {"id": i, "start": start, "end": end, "text": text % i if "%d" in text else text}


def doc(segments, text=None, seconds=30, **more):
    return {"schema_version": 1, "transcript": " ".join(s["text"] for s in segments) if text is None else text, "segments": segments, "processed_duration_seconds": seconds} | more


def run(spark, tmp_path, docs, glossary=None, **kw):
    for name, d in docs.items():
        (tmp_path / f"{name}.en.json").write_text(d if isinstance(d, str) else json.dumps(d))
    t, s = read_transcripts(spark, str(tmp_path), **kw)
    return engine.analyze(t, s, parse_glossary(glossary) if glossary else None)


def found(r, name="a"):
    rows = r.ordered().filter(F.col("transcript_id").contains(f"/{name}.en.json")).orderBy("place").collect()
    return [(x.type, x.severity, list(x.segment_ids)) for x in rows]


REPEATED = "the market opened with a strong move and then it paused for a while"


def test_known_duplicate(spark, tmp_path):
    r = run(spark, tmp_path, {"a": doc([seg(0, 0, 7, REPEATED), seg(1, 7, 23, REPEATED), seg(2, 23, 30, "Here is a rising bull flag and a gap.")])}, GLOSSARY)
    assert found(r) == [
        ("duplicate_segment_duration_mismatch", "high", ["0", "1"]), ("exact_duplicate_segment", "high", ["0", "1"]),
        ("segment_suspiciously_long", "medium", ["1"]), ("terminology_detected", "info", ["2"]),
    ]
    p = engine.prepare_transcripts(r, parse_glossary(GLOSSARY))
    rows = p.segments.orderBy("place").collect()
    assert [(x.correction_status, x.timestamp_confidence) for x in rows] == [("uncertain", "reliable")] * 2 + [("unchanged", "reliable")]
    assert [t.term_id for t in rows[2].terminology] == ["bull_flag", "gap"]
    d = p.documents.first()
    assert d.run_status == "needs_review" and d.raw_word_count == d.cleaned_word_count and d.unexpected_new_words == []
    assert d.cleaned_transcript.count("strong move") == 2 and d.verification_status == "not_performed"
    out = json.loads(engine.prepared_document(p.documents, parse_glossary(GLOSSARY)).select(F.to_json("document")).first()[0])
    assert out["schema_version"] == 2 and len(out["segments"]) == 3 and out["qa_summary"]["duplicate_group_count"] == 1
    status = r.transcripts.select("transcript_id", F.lit("not_performed").alias("status"))
    qa = json.loads(engine.qa_document(r, p.verification).select(F.to_json("document")).first()[0])
    assert [f["type"] for f in qa["findings"]][0] == "duplicate_segment_duration_mismatch" and qa["summary"]["by_severity"]["high"] == 2


@pytest.mark.parametrize(
    ("segments", "kinds"),
    [
        ([seg(0, None, 5)], ["invalid_timestamp"]), ([seg(0, "abc", 5)], ["invalid_timestamp"]), ([seg(0, True, 5)], ["invalid_timestamp"]), ([seg(0, [1, 2], 5)], ["invalid_timestamp"]),
        ([seg(0, float("nan"), 5)], ["invalid_timestamp"]), ([seg(0, "0.0", "7.0")], []), ([seg(0, 10, 5)], ["segment_end_before_start"]), ([seg(0, 5, 5)], ["segment_end_before_start", "segment_suspiciously_short"]),
        ([seg(0, 10, 15), seg(1, 0, 5)], ["segment_out_of_order", "segment_overlap"]), ([seg(0, 0, 5), seg(1, 20, 25)], ["segment_gap"]), ([seg(0, 0, 5), seg(1, 5.4, 10)], []),
        ([seg(0, 0, 8), seg(1, 6, 12)], ["segment_overlap"]), ([seg(0, 0, 8), seg(1, 7.98, 12)], []), ([seg(0, 0, 8), seg(1, 8, 8.05), seg(2, 8.1, 16), seg(3, 16, 24)], ["segment_suspiciously_short"]),
        ([seg(i, 8 * i, 8 * i + 8) for i in range(4)], []), ([seg(0, 0, 5, "  ​ ")], ["empty_segment", "transcript_segment_mismatch"]),
    ],
)
def test_timing(spark, tmp_path, segments, kinds):
    r = run(spark, tmp_path, {"a": doc(segments, seconds=0)})
    got = [k for k, _, _ in found(r)]
    assert sorted(k for k in got if k != "transcript_segment_mismatch" or "transcript_segment_mismatch" in kinds) == sorted(kinds)


def test_bounds_and_coverage(spark, tmp_path):
    r = run(spark, tmp_path, {"a": doc([seg(0, 5, 10)]), "b": doc([seg(0, 0, 45)]), "c": doc([seg(0, 0, 5), seg(1, 5, 10)]), "d": doc([seg(0, 0, 500)], seconds=None)})
    assert [k for k, _, _ in found(r, "a")] == ["incomplete_speech_at_start", "incomplete_speech_at_end"]
    assert "segment_timestamp_out_of_bounds" in [k for k, _, _ in found(r, "b")]
    assert [k for k, _, _ in found(r, "c")] == ["incomplete_speech_at_end"] and "segment_timestamp_out_of_bounds" not in [k for k, _, _ in found(r, "d")]


def test_duplicates_and_id_collisions(spark, tmp_path):
    a = [seg(0, 0, 8, "One two three."), seg(1, 8, 16, "four five"), seg(2, 16, 24, "one, two three")]
    same_id = [seg(0, 0, 8, "one two"), seg(0, 8, 16, "one two")]
    near = [*same_id, seg(0, 16, 24, "other words")]
    r = run(spark, tmp_path, {"a": doc(a, seconds=0), "b": doc(same_id, seconds=0), "c": doc(near, seconds=0)})
    assert found(r, "a") == [("exact_duplicate_segment", "medium", ["0", "2"])]
    assert found(r, "b") == [("exact_duplicate_segment", "medium", ["0", "0"])]
    assert found(r, "c") == [("near_duplicate_segment", "medium", ["0", "0"])]


def test_structure_and_format(spark, tmp_path):
    r = run(spark, tmp_path, {"a": doc([], "some text"), "b": doc([], "  "), "c": doc([seg(0, 0, 8, "alpha beta gamma")], "wholly different content here", 0)})
    assert found(r, "a") == [("no_segments", "high", [])] and found(r, "b") == [("no_segments", "critical", [])]
    assert [k for k, _, _ in found(r, "c")] == ["transcript_segment_mismatch"]
    p = engine.prepare_transcripts(r).segments.filter("array_contains(quality_flags, 'no_segments')").collect()
    assert [(x.segment_id, x.correction_status, x.timestamp_confidence) for x in p] == [("0", "uncertain", "missing")]
    bad = tmp_path / "bad"
    bad.mkdir()
    for content in ('{"transcript": "x", "segments": [1]}', '{"segments": []}', '{"schema_version": 2, "transcript": "x"}', '{"transcript": "x", "segments": {}}', "no json"):
        (bad / "x.json").write_text(content)
        with pytest.raises(TranscriptFormatError):
            read_transcripts(spark, str(bad))


def test_repeated_phrase_once(spark, tmp_path):
    phrase = "we always look for the second entry near the end of every single trend"
    filler = "nothing else matters here because other words stand between both of them now"
    r = run(spark, tmp_path, {"a": doc([seg(0, 0, 8, f"{phrase} {filler}"), seg(1, 8, 16, phrase)], seconds=0)})
    got = r.by_type("repeated_phrase").collect()
    assert len(got) == 1 and got[0].evidence["phrase"] == phrase and got[0].evidence["occurrences"] == "2" and got[0].segment_ids == ["0", "1"]


def test_terms_and_confusables(spark, tmp_path):
    text = "The bare body closed a golen ratio, that is ie. a GAP or rising  flag; clear body, bear body and i.e. gaps"
    r = run(spark, tmp_path, {"a": doc([seg(0, 0, 8, text)], seconds=0)}, GLOSSARY)
    rows = {x.type: x for x in r.findings.collect() if x.type != "confusable_term"}
    assert rows["terminology_detected"].evidence["term_ids"] == "ie,gap,bull_flag"
    words = {(x.evidence["word"], x.evidence["suspected_word"]) for x in r.by_type("confusable_term").collect()}
    assert words == {("bare", "bear"), ("golen", "golden")}


def test_verification_and_merge(spark, tmp_path):
    d = doc([seg(0, 0, 7, REPEATED), seg(1, 7, 23, REPEATED), seg(2, 23, 30, "and more")])
    r = run(spark, tmp_path, {"a": d, "b": d, "c": d})
    texts = {"a": f"{REPEATED} and more", "b": f"{REPEATED} {REPEATED} and more", "c": ""}
    alt = r.transcripts.select("transcript_id", F.regexp_extract("transcript_id", r"(\w)\.en\.json$", 1).alias("n"))
    alt = alt.select("transcript_id", F.element_at(F.create_map(*[F.lit(x) for kv in texts.items() for x in kv]), F.col("n")).alias("text"))
    p = engine.prepare_transcripts(r, alternative=(alt, alt.select("transcript_id", "text")))
    got = {x.transcript_id[-9]: x for x in p.documents.collect()}
    assert [got[k].verification_status for k in "abc"] == ["duplicate_contradicted", "duplicate_confirmed", "inconclusive"]
    assert [s.segment_id for s in got["a"].segments] == ["0-1", "2"] and len(got["b"].segments) == 3
    assert "merged_verbatim" in got["a"].segments[0].quality_flags and got["a"].cleaned_transcript.count("strong move") == 2


def test_many_equal_single(spark, tmp_path):
    docs = {"a": doc([seg(0, 0, 8), seg(1, 20, 25)]), "b": doc([seg(0, 5, 4), seg(1, 2, 9)]), "c": doc([seg(0, 0, 30, REPEATED)])}
    together = run(spark, tmp_path, docs)
    for name, d in docs.items():
        alone = tmp_path / f"only_{name}"
        alone.mkdir()
        assert found(run(spark, alone, {name: d}), name) == found(together, name)


def test_glossary_validation():
    for change in ({"schema_version": 2}, {"terms": []}, {"terms": [1]}, {"terms": [{"id": "a"}]}, {"terms": [{"id": "a", "canonical": "x"}] * 2}, {"terms": [{"id": "a", "canonical": "x", "aliases": "y"}]}, {"confusable_extra_anchors": ["one"]}, {"known_confusions": [{"wrong": "a", "right": "A"}]}):
        with pytest.raises(GlossaryError):
            parse_glossary(GLOSSARY | change)
    g = parse_glossary(GLOSSARY)
    assert g.anchors == [("rising", "bull"), ("bull", "flag"), ("golden", "ratio"), ("bear", "body")] and g.get("gap").ambiguous


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "x.json")
    sinks.write_json_file(path, {"a": "é"})
    sinks.validate_outputs([path])
    with pytest.raises(Exception, match="exists"):
        sinks.write_json_file(path, {})
    assert sinks.prepared_names("t.en.json") == {"text": "t.en.clean.txt", "document": "t.en.clean.json", "report": "t.en.qa.json"}
    d = spark.createDataFrame([("a", "x \n y")], "transcript_id string, cleaned_transcript string")
    sinks.write_texts(d, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_streaming(spark, tmp_path):
    from scriptmill.streaming.watch import watch

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(doc([seg(0, 0, 5), seg(1, 20, 25)], seconds=0)))
    got = []
    watch(spark, str(folder), lambda f, n: got.extend(r.type for r in f.collect()), str(tmp_path / "cp"), once=True).awaitTermination()
    assert got == ["segment_gap"]


def test_second_transcriptions(spark, tmp_path):
    """Only transcripts with repetitions are transcribed again; failures and missing media are recorded."""
    d = doc([seg(0, 0, 7, REPEATED), seg(1, 7, 23, REPEATED), seg(2, 23, 30, "and more")])
    r = run(spark, tmp_path, {"a": d, "b": d, "c": d, "d": doc([seg(0, 0, 8, "once only")], seconds=0)})
    media = r.transcripts.select("transcript_id", F.regexp_extract("transcript_id", r"(\w)\.en\.json$", 1).alias("path")).filter("path <> 'c'")
    answers = {"a": {"text": f"{REPEATED} and more", "segments": [{"start": 0, "end": 23, "text": f"{REPEATED} and more"}]}}
    alternative, failures = engine.second_transcriptions(r, media, TableTranscriber(answers), Workspace(spark, "second"))
    p = engine.prepare_transcripts(r, None, alternative, failures)
    got = {x.transcript_id[-9]: x for x in p.documents.collect()}
    assert [got[k].verification_status for k in "abcd"] == ["duplicate_contradicted", "failed", "failed", "not_performed"]
    assert got["b"].verification.evidence.last_error and got["a"].alternative_text == f"{REPEATED} and more" and not got["d"].verification.performed
