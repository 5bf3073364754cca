"""Outputs: one JSON document or text a transcript, as datasets on any store or as single files."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptmill.functions.text import transcript_text
from scriptmill.schema import OutputExistsError, OutputValidationError


def write_documents(documents: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rows (transcript_id, document) as JSON lines; existing output is only replaced on request."""
    documents.select("transcript_id", F.to_json("document", {"ignoreNullFields": "false"}).alias("value")).select("value").write.mode("overwrite" if overwrite else "errorifexists").text(path)


def write_texts(documents: DataFrame, path: str, overwrite: bool = False) -> None:
    """Cleaned transcripts as text, in a folder for each transcript."""
    documents.select(F.regexp_replace("transcript_id", r"[^\p{L}\p{N}\-_.]", "_").alias("transcript"), F.regexp_replace(transcript_text("cleaned_transcript"), "\n$", "").alias("value")).write.mode("overwrite" if overwrite else "errorifexists").partitionBy("transcript").text(path)


def write_file(path: str, text: str, overwrite: bool = False) -> None:
    """One file on the driver, complete or not at all: written beside and moved into place."""
    if os.path.exists(path) and not overwrite:
        raise OutputExistsError(f"{path} exists; pass overwrite to replace it")
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, draft = tempfile.mkstemp(dir=folder, prefix=".draft-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
        os.replace(draft, path)
    except BaseException:
        os.unlink(draft)
        raise


def write_json_file(path: str, document: object, overwrite: bool = False) -> None:
    write_file(path, json.dumps(document, ensure_ascii=False, indent=2) + "\n", overwrite)


def prepared_names(raw: str) -> dict[str, str]:
    """Names of the three outputs beside a raw artifact: x.en.json gives x.en.clean.txt, x.en.clean.json, x.en.qa.json."""
    stem = raw.removesuffix(".json")
    return {"text": f"{stem}.clean.txt", "document": f"{stem}.clean.json", "report": f"{stem}.qa.json"}


def validate_outputs(paths: list[str], min_chars: int = 1) -> None:
    """Files exist, are not empty, JSON parses, and a text has enough characters."""
    for p in paths:
        if not os.path.isfile(p) or not os.path.getsize(p):
            raise OutputValidationError(f"{p} is missing or empty")
        with open(p, encoding="utf-8") as f:
            content = f.read()
        if p.endswith(".json"):
            try:
                json.loads(content)
            except ValueError as e:
                raise OutputValidationError(f"{p} is not JSON: {e}") from e
        elif p.endswith(".txt") and len(content.strip()) < min_chars:
            raise OutputValidationError(f"{p} has fewer than {min_chars} characters")
