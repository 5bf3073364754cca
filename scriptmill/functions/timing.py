"""Numbers and times: tolerant parsing, durations, clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptmill.functions.text import SPACE, col

_FLOAT = r"(?i)^[+-]?(inf(inity)?|nan|(\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?)$"


def _stripped(raw: Column) -> Column:
    return F.regexp_replace(raw, f"^[{SPACE}]+|[{SPACE}]+$", "")


def text_to_double(raw: Column | str) -> Column:
    """A decimal number, infinity or NaN written as text; null for anything else (underscores in numbers are not accepted)."""
    s = _stripped(col(raw))
    return F.when(s.rlike(_FLOAT), s.try_cast("double"))


def parse_timestamp(raw: Column | str, kind: Column | str) -> Column:
    """struct(value, valid) of a raw time. ``raw`` is its JSON text and ``kind`` is number, string or other.

    Numbers must be finite, texts may be infinite but not NaN, all else is
    invalid without a value. A negative time keeps its value but is invalid.
    """
    raw, kind = col(raw), col(kind)
    v = text_to_double(raw)
    usable = v.isNotNull() & ~F.isnan(v) & ((kind == "string") | ((kind == "number") & (F.abs(v) < float("inf"))))
    value = F.when(usable, v)
    return F.struct(value.alias("value"), F.coalesce(value >= 0, F.lit(False)).alias("valid"))


def metadata_double(raw: Column | str, kind: Column | str) -> Column:
    """A metadata number: like a time, but texts may hold anything that reads as a number, and infinity passes."""
    v = text_to_double(raw)
    return F.when((col(kind) == "string") | ((col(kind) == "number") & ~F.isnan(v)), v)


def reference_duration(processed: Column | str, reported: Column | str) -> Column:
    """The processed duration, or the reported one where it is missing or zero."""
    p = col(processed)
    return F.coalesce(F.when(p != 0, p), col(reported))


def duration(start: Column | str, end: Column | str) -> Column:
    """End minus start, if both are known and in order; zero counts."""
    return F.when(col(end) >= col(start), col(end) - col(start))


def prepared_duration(start: Column | str, end: Column | str) -> Column:
    s, e = col(start), col(end)
    return F.when(s.isNotNull() & e.isNotNull(), F.greatest(F.lit(0.0), e - s))


def effective_duration(requested: Column | str, actual: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(col(requested), col(actual)))


def extraction_ok(actual: Column | str, requested: Column | str) -> Column:
    """A cut is accepted if it is not empty and within a second or a tenth of what was asked."""
    a, r = col(actual), col(requested)
    return (a >= 0.05) & (F.abs(a - r) <= F.greatest(F.lit(1.0), r * 0.1))


def probe_number(raw: Column | str) -> Column:
    """A number of a media probe; N/A, blanks and anything unreadable are null; "num/den" is a quotient."""
    s = F.nullif(F.nullif(_stripped(col(raw)), F.lit("N/A")), F.lit(""))
    parts = F.split(s, "/")
    return F.when(F.size(parts) == 2, F.try_divide(parts[0].try_cast("double"), parts[1].try_cast("double"))).otherwise(s.try_cast("double"))


def backoff(attempt: Column | str, base: float = 2.0, most: float = 30.0) -> Column:
    """Seconds before the next attempt: doubling, bounded."""
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), col(attempt) - 1))


def error_class(status: Column | str) -> Column:
    """auth, permanent or retryable, by HTTP status; without a status an error is worth a retry."""
    s = col(status)
    return F.when(s.isNull() | s.isin(408, 409, 425, 429, 500, 502, 503, 504), "retryable").when(s.isin(401, 403), "auth").otherwise("permanent")


def upload_ok(size: Column | str, limit: int = 25 * 1024 * 1024) -> Column:
    return (col(size) > 0) & (col(size) <= limit)


#: Codecs that an MP4 container takes without re-encoding (fixed values).
SAFE_VIDEO = ("h264", "hevc", "h265", "av1", "vp9", "mpeg4", "mjpeg")
SAFE_AUDIO = ("aac", "mp3", "mp4a", "opus", "alac")


def codec_plan(video: Column | str, audio: Column | str) -> Column:
    """How a cut is made: which of the streams can be copied. No audio needs no encoding."""
    v = F.coalesce(col(video).isin(*SAFE_VIDEO), F.lit(False))
    a = col(audio).isNull() | col(audio).isin(*SAFE_AUDIO)
    return F.when(v & a, "copy").when(v, "copy-video/reencode-audio").when(a, "reencode-video/copy-audio").otherwise("reencode")


def safe_stem(stem: Column | str) -> Column:
    """A file stem of letters, digits, dash, underscore and dot, or "video"."""
    s = F.regexp_replace(col(stem), r"[^\p{L}\p{N}\-_.]", "_")
    return F.coalesce(F.nullif(F.regexp_replace(s, r"^[._]+|[._]+$", ""), F.lit("")), F.lit("video"))


def seconds_text(seconds: Column | str) -> Column:
    """30.0 as 30, 12.5 as 12.5."""
    s = col(seconds).cast("double")
    return F.when(s == F.floor(s), s.cast("long").cast("string")).otherwise(F.regexp_replace(F.format_string("%.6f", s), "0+$", ""))


def output_base(stem: Column | str, seconds: Column | str) -> Column:
    """Base name of a run's output files."""
    return F.concat(safe_stem(stem), F.lit("_test_"), seconds_text(seconds), F.lit("s"))
