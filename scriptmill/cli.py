"""Command line: prepare transcripts, list inputs, show the glossary."""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from dataclasses import dataclass

from scriptmill.schema import SECRET, ConfigError, EngineError



class Redact(logging.Filter):
    """Registered secrets and API-key shapes never reach a log."""

    def __init__(self, literals: tuple[str, ...] = ()):
        super().__init__()
        self.literals = literals

    def filter(self, record: logging.LogRecord) -> bool:
        text = record.getMessage()
        for s in self.literals:
            text = text.replace(s, "***REDACTED***")
        record.msg, record.args = SECRET.sub("***REDACTED***", text), ()
        return True


@dataclass(frozen=True)
class Config:
    data_dir: str = "."
    output_dir: str = "out"
    log_dir: str = ""
    seconds: float = 30.0
    model: str = ""
    language: str = "en"
    attempts: int = 3


def read_config(args: dict, env: dict[str, str] | None = None) -> Config:
    """Arguments over environment over defaults; all problems are reported together."""
    env = os.environ if env is None else env
    out, problems = {}, []
    for name, default in Config.__dataclass_fields__.items():
        value = args.get(name)
        if value is None:
            value = env.get(f"SCRIPTMILL_{name.upper()}", default.default)
        try:
            out[name] = type(default.default)(value)
        except ValueError:
            problems.append(f"{name}: {value!r} is not a number")
    if isinstance(out.get("seconds"), float) and not 0 < out["seconds"] < float("inf"):
        problems.append("seconds must be positive")
    if isinstance(out.get("attempts"), int) and out["attempts"] < 1:
        problems.append("attempts must be at least 1")
    if problems:
        raise ConfigError("; ".join(problems))
    return Config(**out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="scriptmill", description="Quality checks and preparation of speech transcripts on Spark.")
    sub = p.add_subparsers(dest="command", required=True)
    a = sub.add_parser("prepare", help="check transcripts and write prepared documents and reports")
    a.add_argument("artifacts", help="a folder or pattern of version-1 transcript files")
    a.add_argument("--output-dir")
    a.add_argument("--glossary", help="glossary file")
    a.add_argument("--alternative", help="a folder of second transcriptions with the same file names")
    a.add_argument("--overwrite", action="store_true")
    a.add_argument("--log-dir")
    a.add_argument("--report", type=int, default=0, metavar="N", help="print the closing block of the first N transcripts")
    e = sub.add_parser("check-env", help="say which tools are there")
    e.add_argument("--strict", action="store_true", help="fail if one is missing")
    b = sub.add_parser("list", help="list media files of a folder")
    b.add_argument("data_dir")
    c = sub.add_parser("glossary", help="validate a glossary and summarise it")
    c.add_argument("path")
    return p


def _prepare(args: argparse.Namespace, config: Config) -> int:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    from scriptmill.plans import engine
    from scriptmill.runtime import Workspace
    from scriptmill.sources import sinks
    from scriptmill.sources.glossary import load_glossary
    from scriptmill.sources.transcripts import read_transcripts

    spark = SparkSession.builder.appName("scriptmill").getOrCreate()
    glossary = load_glossary(args.glossary) if args.glossary else None
    report = engine.analyze(*read_transcripts(spark, args.artifacts), glossary, workspace=Workspace(spark, "cli"))
    alternative = None
    if args.alternative:
        t, s = read_transcripts(spark, args.alternative)
        base = lambda c: F.element_at(F.split(c, "/"), -1)
        ids = report.transcripts.select(F.col("transcript_id").alias("_id"), base("transcript_id").alias("_name"))
        named = lambda x: x.withColumn("_name", base("transcript_id")).join(ids, "_name").drop("transcript_id", "_name").withColumnRenamed("_id", "transcript_id")
        alternative = named(t), named(s)
    prepared = engine.prepare_transcripts(report, glossary, alternative)
    sinks.write_documents(engine.prepared_document(prepared.documents, glossary), f"{config.output_dir}/documents", args.overwrite)
    sinks.write_documents(engine.qa_document(report, prepared.verification), f"{config.output_dir}/reports", args.overwrite)
    sinks.write_texts(prepared.documents, f"{config.output_dir}/texts", args.overwrite)
    n = prepared.documents.groupBy("run_status").count().orderBy("run_status").collect()
    print("\n".join(f"{r[0]}: {r[1]}" for r in n))
    if args.report:
        for r in console_reports(prepared.documents).orderBy("transcript_id").limit(args.report).collect():
            print(f"\n{r.report}")
    return 0


def console_reports(documents):
    """(transcript_id, report): the closing block of each transcript, as text."""
    from pyspark.sql import functions as F

    from scriptmill.schema import SEVERITIES

    line = lambda name, value: F.concat(F.lit(f"  {name:<20}: "), F.coalesce(value.cast("string"), F.lit("unknown")))
    counts = F.array_join(F.array_compact(F.array(*[F.when(F.col(s) > 0, F.concat(F.lit(f"{s}="), F.col(s).cast("string"))) for s in SEVERITIES])), ", ")
    worst = F.concat(F.col("total_findings").cast("string"), F.lit(" (worst: "), F.coalesce("max_severity", F.lit("none")), F.lit(")"))
    notes = F.transform(F.coalesce("notes", F.array().cast("array<string>")), lambda n: F.concat(F.lit("  Review: "), n))
    parts = [F.concat(F.lit("Prepared - "), F.upper("run_status")), line("Transcript", F.col("transcript_id")), line("Source model", F.col("model") if "model" in documents.columns else F.lit(None)), line("Segments prepared", F.size(F.coalesce("segments", F.array()))), line("Findings", worst), line("Verification", F.col("verification_status")), F.when(counts != "", line("Findings by severity", counts))]
    return documents.select("transcript_id", F.array_join(F.concat(F.array_compact(F.array(*parts)), notes), "\n").alias("report"))


def check_environment() -> dict[str, bool]:
    """What a run needs and whether it is there."""
    import shutil

    return {"java": bool(shutil.which("java") or os.environ.get("JAVA_HOME")), "ffmpeg": bool(shutil.which("ffmpeg")), "ffprobe": bool(shutil.which("ffprobe"))}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        config = read_config(vars(args))
        handlers: list[logging.Handler] = [logging.StreamHandler()]
        if config.log_dir:
            os.makedirs(config.log_dir, exist_ok=True)
            handlers.append(logging.FileHandler(os.path.join(config.log_dir, "scriptmill.log"), encoding="utf-8"))
        for h in handlers:
            h.addFilter(Redact())
        logging.basicConfig(level=logging.INFO, handlers=handlers, force=True)
        if args.command == "prepare":
            return _prepare(args, config)
        if args.command == "check-env":
            found = check_environment()
            print("\n".join(f"{k}: {'ok' if v else 'missing'}" for k, v in found.items()))
            return ConfigError.exit_code if args.strict and not all(found.values()) else 0
        if args.command == "list":
            from pyspark.sql import SparkSession

            from scriptmill.sources.transcripts import list_candidates

            for r in list_candidates(SparkSession.builder.getOrCreate(), args.data_dir).collect():
                print(f"{r.name}\t{r.length}")
            return 0
        from scriptmill.sources.glossary import load_glossary

        print(json.dumps(load_glossary(args.path).summary(), ensure_ascii=False))
        return 0
    except EngineError as e:
        print(f"error: {SECRET.sub('***REDACTED***', str(e))}", file=sys.stderr)
        return e.exit_code
    except KeyboardInterrupt:
        return 130


if __name__ == "__main__":
    sys.exit(main())
