from pyspark.sql import functions as F

from scriptmill.functions import timing
from scriptmill.plans import catalogue


def test_parse_timestamps(spark):
    got = {(r.raw, r.kind): (r.value, r.valid) for r in catalogue.QUERIES["parse_timestamps"](spark, "").collect()}
    assert got["7", "number"] == (7.0, True) and got[" 7.5 ", "string"] == (7.5, True) and got["-2", "number"] == (-2.0, False)
    assert got["inf", "string"] == (float("inf"), True) and got["Infinity", "number"] == (None, False)
    assert all(got[k] == (None, False) for k in [("nope", "string"), ("", "string"), ("true", "other"), (None, "other"), ("nan", "string"), ("7.0d", "string")])


def test_control_functions(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    lit = F.lit
    assert get(timing.seconds_text(lit(30.0))) == "30" and get(timing.seconds_text(lit(12.5))) == "12.5"
    assert get(timing.safe_stem(lit("__a b.c__"))) == "a_b.c" and get(timing.safe_stem(lit("..."))) == "video"
    assert get(timing.output_base(lit("lecture"), lit(30))) == "lecture_test_30s"
    assert get(timing.backoff(lit(1))) == 2.0 and get(timing.backoff(lit(9))) == 30.0
    assert [get(timing.error_class(lit(s))) for s in (401, 429, 413)] == ["auth", "retryable", "permanent"]
    assert get(timing.error_class(lit(None).cast("int"))) == "retryable"
    assert get(timing.codec_plan(lit("h264"), lit(None).cast("string"))) == "copy" and get(timing.codec_plan(lit("x"), lit("y"))) == "reencode"
    assert get(timing.probe_number(lit("30000/1001"))) == 30000 / 1001 and get(timing.probe_number(lit("N/A"))) is None
    assert get(timing.prepared_duration(lit(5.0), lit(3.0))) == 0.0 and get(timing.prepared_duration(lit(None).cast("double"), lit(3.0))) is None
    assert get(timing.extraction_ok(lit(29.5), lit(30.0))) and not get(timing.extraction_ok(lit(0.0), lit(0.5)))
    assert not get(timing.upload_ok(lit(26 * 1024 * 1024)))
    assert get(timing.reference_duration(lit(0.0), lit(4.0))) == 4.0
