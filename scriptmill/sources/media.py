"""Media adapter: probe results as columns, source selection, and the external tool behind one function."""

from __future__ import annotations

import os
import shutil
import subprocess
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.functions.timing import SAFE_AUDIO, SAFE_VIDEO, probe_number
from scriptmill.schema import InputError, MediaError, OutputExistsError

AUDIO = (".flac", ".wav", ".mp3", ".m4a", ".ogg")
VIDEO = (".mp4", ".mkv", ".mov", ".webm", ".avi")
MIN_BYTES = 1024

_PROBE = "streams array<struct<codec_type string, codec_name string, width string, height string, avg_frame_rate string, r_frame_rate string, bit_rate string, channels string, sample_rate string, duration string, disposition struct<attached_pic int>>>, format struct<duration string, size string, format_name string, bit_rate string>"


def parse_probe(df: DataFrame, probe: str = "probe") -> DataFrame:
    """Rows with a probe's JSON text, plus duration, size and the first video and audio stream; cover art is no video."""
    p = F.from_json(probe, _PROBE)
    of = lambda kind: F.get(F.filter(p["streams"], lambda s: (s["codec_type"] == kind) & (F.coalesce(s["disposition"]["attached_pic"], F.lit(0)) != 1)), F.lit(0))
    video, audio = of("video"), of("audio")
    return df.select(
        *[c for c in df.columns if c != probe],
        F.coalesce(probe_number(p["format"]["duration"]), probe_number(video["duration"]), probe_number(audio["duration"])).alias("duration"),
        probe_number(p["format"]["size"]).cast("long").alias("size"), p["format"]["format_name"].alias("format"),
        video["codec_name"].alias("video_codec"), probe_number(video["width"]).cast("int").alias("width"), probe_number(video["height"]).cast("int").alias("height"), F.coalesce(probe_number(video["avg_frame_rate"]), probe_number(video["r_frame_rate"])).alias("fps"),
        audio["codec_name"].alias("audio_codec"), probe_number(audio["channels"]).cast("int").alias("channels"), probe_number(audio["sample_rate"]).cast("int").alias("sample_rate"), audio.isNull().alias("no_audio"),
    )


def metadata_document(probed: DataFrame, key: str) -> DataFrame:
    """(key, document): what :func:`parse_probe` found, as one struct, schema version 1."""
    rounded = lambda c: F.round(c, 3).alias(c)
    video = F.struct(F.col("video_codec").alias("codec"), "width", "height", rounded("fps"))
    audio = F.struct(F.col("audio_codec").alias("codec"), "channels", "sample_rate")
    return probed.select(key, F.struct(F.lit(1).alias("schema_version"), F.lit("media_metadata").alias("artifact_type"), rounded("duration"), "size", "format", F.when(F.col("video_codec").isNotNull(), video).alias("video"), F.when(~F.col("no_audio"), audio).alias("audio")).alias("document"))


def select_one(candidates: Sequence[str], name: str | None = None, size: Callable[[str], int] = os.path.getsize) -> str:
    """The one input: by name, or the only candidate; it must have a plausible size."""
    if name is not None:
        found = [c for c in candidates if os.path.basename(c) == os.path.basename(name)]
        if not found:
            raise InputError(f"{name} is not among the inputs")
        pick = found[0]
    elif not candidates:
        raise InputError("no input file")
    elif len(candidates) > 1:
        raise InputError("several input files; name one: " + ", ".join(map(os.path.basename, candidates)))
    else:
        pick = candidates[0]
    if size(pick) < MIN_BYTES:
        raise InputError(f"{pick} is too small to be media")
    return pick


def audio_for(artifact: str, explicit: str | None = None, recorded: str | None = None, folders: Sequence[str] = (), exists: Callable[[str], bool] = os.path.isfile) -> str | None:
    """The media of an artifact: named, beside it as audio, beside it as video, where it was recorded, or by file name in some folders. A ".en" in the artifact's name may or may not be part of the media's."""
    if explicit:
        return explicit if exists(explicit) else None
    stem = artifact.removesuffix(".json")
    stems = [stem, stem.removesuffix(".en")]
    places = [s + ext for kinds in (AUDIO, VIDEO) for s in stems for ext in kinds]
    if recorded:
        places += [recorded, *(os.path.join(f, os.path.basename(recorded)) for f in folders)]
    return next((p for p in places if exists(p)), None)


_QUIET = ["-nostdin", "-hide_banner", "-loglevel", "error"]


def cut_command(source: str, target: str, seconds: float, plan: str, start: float = 0.0, audio: bool = True, overwrite: bool = False) -> list[str]:
    """Arguments of the external tool for a cut under a plan of :func:`scriptmill.functions.timing.codec_plan`: the first video and, if any, audio stream from ``start`` on, times from zero, the index in front."""
    h264, aac = ["-c:v", "libx264", "-preset", "medium", "-crf", "20", "-pix_fmt", "yuv420p"], ["-c:a", "aac", "-b:a", "128k", "-ac", "2"]
    codec = {"copy": ["-c", "copy"], "copy-video/reencode-audio": ["-c:v", "copy", *aac], "reencode-video/copy-audio": [*h264, "-c:a", "copy"], "reencode": [*h264, *aac]}[plan]
    maps = ["-map", "0:v:0", *(["-map", "0:a:0?"] if audio else [])]
    return ["ffmpeg", *_QUIET, "-y" if overwrite else "-n", "-ss", f"{start:g}", "-i", source, "-t", f"{seconds:g}", *maps, "-avoid_negative_ts", "make_zero", *codec, "-movflags", "+faststart", target]


def audio_command(source: str, target: str, seconds: float | None = None, start: float = 0.0) -> list[str]:
    """Arguments for mono 16 kHz FLAC."""
    return ["ffmpeg", *_QUIET, "-y", "-ss", f"{start:g}", "-i", source, *(["-t", f"{seconds:g}"] if seconds else []), "-vn", "-ac", "1", "-ar", "16000", "-c:a", "flac", target]


def probe_command(path: str) -> list[str]:
    return ["ffprobe", "-v", "error", "-print_format", "json", "-show_format", "-show_streams", path]


def probe_all(paths: DataFrame, runner: Callable[..., subprocess.CompletedProcess] = subprocess.run) -> DataFrame:
    """Rows (path) with the probe's JSON text or an error; the tool runs on the executors."""
    from scriptmill.runtime import ship

    ship(paths.sparkSession)

    def run(frames):
        for f in frames:
            probes, errors = [], []
            for path in f["path"]:
                try:
                    probe, error = run_tool(probe_command(path), runner), None
                except MediaError as e:
                    probe, error = None, str(e)
                probes.append(probe)
                errors.append(error)
            yield type(f)({"path": f["path"], "probe": probes, "error": errors})

    return paths.select("path").mapInPandas(run, "path string, probe string, error string")


def cut_plan(video: str | None, audio: str | None) -> str:
    """The plan for one file, as :func:`scriptmill.functions.timing.codec_plan` gives it for columns."""
    keep_video, keep_audio = video in SAFE_VIDEO, audio is None or audio in SAFE_AUDIO
    return {(True, True): "copy", (True, False): "copy-video/reencode-audio", (False, True): "reencode-video/copy-audio", (False, False): "reencode"}[keep_video, keep_audio]


def acquire(source: str, probed: dict, target: str, audio_target: str, seconds: float, start: float = 0.0, overwrite: bool = False, runner: Callable[..., subprocess.CompletedProcess] = subprocess.run, measure: Callable[[str], float | None] | None = None, size: Callable[[str], int] = os.path.getsize) -> dict:
    """One recording: cut it, extract its audio, check both, and say what was made.

    ``probed`` is a row of :func:`parse_probe` as a dictionary; ``measure``
    gives the length of a file. The wanted length is cut at the recording's
    end; a result that is empty or off by more than a second and a tenth of the
    length is an error.
    """
    if os.path.exists(target) and not overwrite:
        raise OutputExistsError(f"{target} exists; pass overwrite to replace it")
    if probed.get("video_codec") is None or probed.get("duration") is None:
        raise MediaError(f"{source} has no video or no known length")
    wanted = min(seconds, probed["duration"] - start)
    if wanted <= 0:
        raise InputError(f"{source} ends before {start:g} s")
    plan = cut_plan(probed["video_codec"], probed.get("audio_codec"))
    run_tool(cut_command(source, target, wanted, plan, start, not probed.get("no_audio"), overwrite), runner)
    made = {"source_path": source, "source_file": os.path.basename(source), "requested_duration_seconds": seconds, "start_seconds": start, "plan": plan, "video": target, "audio": None}
    outputs = [target]
    if not probed.get("no_audio"):
        run_tool(audio_command(source, audio_target, wanted, start), runner)
        made["audio"] = audio_target
        outputs.append(audio_target)
    lengths = []
    for path in outputs:
        if not size(path):
            raise MediaError(f"{path} is empty")
        length = measure(path) if measure else wanted
        if length is None or length < 0.05 or abs(length - wanted) > max(1.0, 0.1 * wanted):
            raise MediaError(f"{path} lasts {length} s instead of {wanted:g} s")
        lengths.append(length)
    return made | {"processed_duration_seconds": round(max(0.0, min(lengths[-1], wanted)), 3)}


def run_tool(command: list[str], runner: Callable[..., subprocess.CompletedProcess] = subprocess.run) -> str:
    """Run the external tool; its last lines go into the error."""
    if runner is subprocess.run and shutil.which(command[0]) is None:
        raise MediaError(f"{command[0]} is not installed")
    done = runner(command, capture_output=True, text=True)
    if done.returncode:
        tail = [x for x in (done.stderr or "").splitlines() if x.strip()][-25:]
        raise MediaError(f"{command[0]} failed:\n" + "\n".join(tail))
    return done.stdout
