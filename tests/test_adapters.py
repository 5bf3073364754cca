"""Media and transcription adapters with fakes."""

import json
import subprocess

import pytest

from scriptmill.schema import InputError, MediaError, RetryableTranscriptionError, TranscriptionError
from scriptmill.sources import media, transcriber
from scriptmill.sources.transcripts import list_candidates, normalize_response


def test_probe(spark):
    probe = {"streams": [{"codec_type": "video", "codec_name": "png", "disposition": {"attached_pic": 1}}, {"codec_type": "video", "codec_name": "h264", "width": "640", "avg_frame_rate": "30/1", "duration": "9.5"}, {"codec_type": "audio", "codec_name": "aac", "channels": "2"}], "format": {"duration": "N/A", "size": "2048"}}
    r = media.parse_probe(spark.createDataFrame([("x", json.dumps(probe)), ("y", "{}")], "id string, probe string")).orderBy("id").collect()
    d = media.metadata_document(media.parse_probe(spark.createDataFrame([("x", json.dumps(probe))], "id string, probe string")), "id").first().document
    assert d.video.codec == "h264" and d.audio.channels == 2 and d.schema_version == 1
    assert (r[0].duration, r[0].video_codec, r[0].fps, r[0].channels, r[0].no_audio) == (9.5, "h264", 30.0, 2, False) and r[1].no_audio


def test_selection(tmp_path):
    big = lambda _: 5000
    assert media.select_one(["/a/x.mp4"], size=big) == "/a/x.mp4" and media.select_one(["/a/x.mp4", "/a/y.mp4"], "y.mp4", size=big) == "/a/y.mp4"
    for args in ([], ["/a", "/b"]):
        with pytest.raises(InputError):
            media.select_one(args, size=big)
    there = {"/d/t.flac", "/e/v.mp4"}
    assert media.audio_for("/d/t.en.json", exists=there.__contains__) == "/d/t.flac"
    assert media.audio_for("/q/z.en.json", recorded="/old/v.mp4", folders=["/e"], exists=there.__contains__) == "/e/v.mp4"
    with pytest.raises(MediaError, match="boom"):
        media.run_tool(["tool"], runner=lambda *a, **k: subprocess.CompletedProcess(a, 1, "", "x\n\nboom\n"))


def test_candidates(spark, tmp_path):
    for n in ("b.MP4", "a.mkv", "note.txt"):
        (tmp_path / n).write_bytes(b"x" * 10)
    assert [r.name for r in list_candidates(spark, str(tmp_path)).collect()] == ["a.mkv", "b.MP4"]


def test_retries():
    class Fault(Exception):
        status_code = 429

    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise Fault
        return {"text": "ok"}

    assert transcriber.with_retries(flaky, sleep=waits.append) == {"text": "ok"} and waits == [2.0, 4.0]
    Fault.status_code = 404
    calls.clear()
    with pytest.raises(TranscriptionError):
        transcriber.with_retries(flaky, sleep=waits.append)
    assert len(calls) == 1
    Fault.status_code = None
    with pytest.raises(RetryableTranscriptionError):
        transcriber.with_retries(lambda: (_ for _ in ()).throw(Fault()), 2, sleep=waits.append)


def test_responses(spark):
    rows = [(1, json.dumps({"text": " hi ", "language": "en", "segments": [{"start": 0, "end": 1.5, "text": " a "}, {"start": "x", "end": 2}]})), (2, '"plain"'), (3, "not json"), (4, "{}")]
    got = {r.id: r for r in normalize_response(spark.createDataFrame(rows, "id int, response string")).collect()}
    assert got[1].text == "hi" and [tuple(s) for s in got[1].segments] == [("0", 0.0, 1.5, "a")] and got[2].text == "plain" and got[3].text == "not json" and got[4].text is None


def test_transcribe_all(spark):
    paths = spark.createDataFrame([("t", "p"), ("u", "q")], "transcript_id string, path string")
    got = {r.transcript_id: r for r in transcriber.transcribe_all(paths, transcriber.TableTranscriber({"p": {"text": "hi"}})).collect()}
    assert json.loads(got["t"].response) == {"text": "hi"} and got["u"].error
