"""Names, enumerations, thresholds and errors of the transcript engine."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Severities in rank order; finding types in the order in which checks run.
SEVERITIES = ("critical", "high", "medium", "low", "info")
FINDING_TYPES = (
    "no_segments", "empty_segment", "invalid_timestamp", "segment_end_before_start", "segment_out_of_order", "segment_gap", "segment_overlap",
    "segment_timestamp_out_of_bounds", "incomplete_speech_at_start", "incomplete_speech_at_end", "segment_suspiciously_short", "segment_suspiciously_long",
    "transcript_segment_mismatch", "exact_duplicate_segment", "near_duplicate_segment", "duplicate_segment_duration_mismatch", "repeated_phrase",
    "terminology_detected", "confusable_term",
)
DUPLICATE_TYPES = ("exact_duplicate_segment", "near_duplicate_segment", "duplicate_segment_duration_mismatch")
VERIFICATION_STATUSES = ("not_performed", "duplicate_confirmed", "duplicate_contradicted", "inconclusive", "failed")

FINDING_DDL = "transcript_id string, check_seq int, emit_seq long, type string, severity string, rank int, segment_ids array<string>, range_start double, range_end double, evidence map<string,string>"
FINDING_COLUMNS = ["transcript_id", "check_seq", "emit_seq", "type", "severity", "rank", "segment_ids", "range_start", "range_end", "evidence"]


@dataclass(frozen=True)
class Thresholds:
    """Tunables of the checks, in seconds unless named otherwise (fixed values)."""

    phrase_words: int = 6
    gap: float = 1.5
    overlap: float = 0.15
    bounds: float = 0.5
    shortest: float = 0.2
    long_factor: float = 2.0
    long_floor: float = 10.0
    text_match: float = 0.80
    start_silence: float = 1.0
    end_silence: float = 2.0
    duration_ratio: float = 2.0


def rank_of(severity: Column) -> Column:
    """Severity as a number, 0 the worst."""
    return F.array_position(F.array(*map(F.lit, SEVERITIES)), severity).cast("int") - 1


#: What a key looks like (fixed pattern).
SECRET = re.compile(r"\b(?:gsk_|sk_)[A-Za-z0-9_\-]{16,}")


class EngineError(Exception):
    """Base of the engine's errors; ``exit_code`` is what the command line returns."""

    exit_code = 1


class ConfigError(EngineError):
    exit_code = 2


class InputError(EngineError):
    exit_code = 3


class TranscriptFormatError(InputError):
    """An artifact is not a version-1 transcript."""


class GlossaryError(ConfigError):
    """A glossary file breaks its format."""


class MediaError(EngineError):
    exit_code = 4


class TranscriptionError(EngineError):
    exit_code = 5
    retryable = False


class RetryableTranscriptionError(TranscriptionError):
    retryable = True


class OutputExistsError(EngineError):
    exit_code = 6


class OutputValidationError(EngineError):
    exit_code = 7
