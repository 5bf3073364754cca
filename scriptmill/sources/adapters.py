"""Transcripts and segments out of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scriptmill.runtime import spread, table
from scriptmill.sources.transcripts import segment_table


def seg_lineitem(spark: SparkSession, sf_dir: str, key: str = "l_linenumber") -> DataFrame:
    """An order is a transcript, a line a segment: days since 1992-01-01 as start, quantity as duration, the part's name as text. Line numbers repeat within orders; ``key="idx"`` gives unique ids."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    rows = li.withColumn("idx", F.row_number().over(order) - 1).join(part, F.col("l_partkey") == F.col("p_partkey"))
    start = F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1992-01-01").cast("date")).cast("double")
    rows = rows.select(F.col("l_orderkey").cast("string").alias("transcript_id"), "idx", F.col(key).cast("string").alias("key"), F.col("p_name").alias("text"), start.alias("_s"), (start + F.col("l_quantity").cast("double")).alias("_e"))
    return segment_table(rows, F.col("_s"), F.col("_e"))


def seg_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is a transcript, an event a segment of value times 100 seconds."""
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    start = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    rows = ev.select(F.col("user_id").cast("string").alias("transcript_id"), (F.row_number().over(order) - 1).alias("idx"), F.col("event_id").cast("string").alias("key"), F.col("event_type").alias("text"), start.alias("_s"), (start + F.col("value") * 100).alias("_e"))
    return segment_table(rows, F.col("_s"), F.col("_e"))


def seg_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as segments without times."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "text").select(F.col("conv_id").cast("string").alias("transcript_id"), F.col("turn").cast("int").alias("idx"), F.col("turn").cast("string").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    none = F.lit(None).cast("double")
    return segment_table(rows, none, none)


def tx_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as transcripts without segments."""
    return spread(table(spark, sf_dir, "documents", "doc_id", "text")).select(F.col("doc_id").cast("string").alias("transcript_id"), F.coalesce("text", F.lit("")).alias("text"), F.lit(None).cast("double").alias("reference_s"))


def tx_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts: their turns as one text."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), " ")
    return turns.groupBy(F.col("conv_id").cast("string").alias("transcript_id")).agg(text.alias("text")).withColumn("reference_s", F.lit(None).cast("double"))


def tx_lineitem(segments: DataFrame, seconds: float = 2400.0) -> DataFrame:
    """Transcripts of :func:`seg_lineitem`: part names in order, a common reference duration."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "text"))), lambda x: x["text"]), " ")
    return segments.groupBy("transcript_id").agg(text.alias("text")).withColumn("reference_s", F.lit(seconds))
