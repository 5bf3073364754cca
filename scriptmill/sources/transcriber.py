"""Speech-to-text behind a protocol, so that engines and tests plug in their own."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import Protocol

from scriptmill.schema import SECRET, RetryableTranscriptionError, TranscriptionError

MAX_UPLOAD = 25 * 1024 * 1024


class Transcriber(Protocol):
    def transcribe(self, path: str) -> dict: ...


def classify(error: Exception) -> str:
    """auth, permanent or retryable. An error of this package keeps its own class; others go by their HTTP status."""
    if isinstance(error, TranscriptionError):
        return "retryable" if error.retryable else "permanent"
    status = getattr(error, "status_code", None) or getattr(getattr(error, "response", None), "status_code", None)
    if status in (401, 403):
        return "auth"
    return "retryable" if status is None or status in (408, 409, 425, 429, 500, 502, 503, 504) else "permanent"


def check_size(size: int) -> None:
    if size > MAX_UPLOAD:
        raise TranscriptionError(f"{size} bytes exceed the upload limit of {MAX_UPLOAD}")


def with_retries(call: Callable[[], dict], attempts: int = 3, base: float = 2.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> dict:
    """Call with bounded exponential backoff; only retryable errors are tried again."""
    for n in range(1, max(1, attempts) + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001  classified right here
            kind = classify(e)
            if kind != "retryable":
                raise e if isinstance(e, TranscriptionError) else TranscriptionError(f"{kind}: {e}") from e
            if n >= attempts:
                raise e if isinstance(e, RetryableTranscriptionError) else RetryableTranscriptionError(str(e)) from e
            sleep(min(most, base * 2 ** (n - 1)))
    raise AssertionError


class TableTranscriber:
    """Answers from a dictionary of paths; for offline work and tests."""

    def __init__(self, answers: dict[str, dict]):
        self.answers = answers

    def transcribe(self, path: str) -> dict:
        if path not in self.answers:
            raise TranscriptionError(f"no transcription of {path}")
        return self.answers[path]


def short_detail(error: Exception, most: int = 400) -> str:
    """What an error says, without anything like a key, in at most ``most`` characters; its kind if it says nothing."""
    said = str(error).strip()
    return SECRET.sub("***REDACTED***", said)[:most] if said else type(error).__name__


def transcribe_all(paths, transcriber: Transcriber, attempts: int = 3):
    """(transcript_id, response JSON, error, attempts, retryable, model) for rows (transcript_id, path): calls run on the executors, one row at a time."""
    import json

    from scriptmill.runtime import ship

    ship(paths.sparkSession)
    model = getattr(transcriber, "model", None)
    names = ("transcript_id", "response", "error", "attempts", "retryable", "model")

    def run(frames):
        for f in frames:
            out = {k: [] for k in names}
            for i, path in zip(f["transcript_id"], f["path"], strict=True):
                made = []

                def call(path=path, made=made):
                    made.append(path)
                    return transcriber.transcribe(path)

                try:
                    answer, error, again = json.dumps(with_retries(call, attempts)), None, None
                except TranscriptionError as e:
                    answer, error, again = None, short_detail(e), e.retryable
                for k, v in zip(names, (i, answer, error, len(made), again, model), strict=True):
                    out[k].append(v)
            yield type(f)(out)

    return paths.select("transcript_id", "path").mapInPandas(run, "transcript_id string, response string, error string, attempts int, retryable boolean, model string")
