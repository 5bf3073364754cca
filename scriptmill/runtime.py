"""Session helpers shared by all subpackages: table access, shared work folders, shipping the package to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A table of ``sf_dir``; with ``cols``, only these columns are read."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def spread(df: DataFrame) -> DataFrame:
    """A table on all cores: one that is read in fewer partitions than there are cores is dealt out, any other stays as it is. A file with a single row group would be read by one task, however many cores wait."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, whatever folder they start in; once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    here = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(here):
        return  # already imported from a shipped archive
    out = os.path.join(tempfile.mkdtemp(prefix="scriptmill-"), "scriptmill_src.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(out)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session. Only a local session may leave it unset and gets a temporary one; on a cluster that would be a different folder on every machine, so it is an error."""
    sc = spark.sparkContext
    set_ = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if set_:
        return set_.rstrip("/")
    own = sc._jsc.sc().getCheckpointDir()
    if not own.isDefined():
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="scriptmill-shared-"))
        own = sc._jsc.sc().getCheckpointDir()
    return own.get().rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of the file system that Spark takes it to, so that other readers of the same path reach the same store."""
    p, fs = _hadoop(spark, path)
    out = fs.makeQualified(p).toString()
    return "file://" + out.removeprefix("file:") if out.startswith("file:/") and not out.startswith("file://") else out


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder through Spark's file system, so that any store works."""
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


class Workspace:
    """Tables in the shared folder that cut lineage: a lost executor costs a reread, not a recomputation.

    Tables live until :meth:`drop` or the end of the process, because lazily
    returned results still read them. Spark's file system removes them with
    the JVM, also where the session was stopped before.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/scriptmill-{label}-{uuid.uuid4().hex[:12]}"
        p, fs = _hadoop(spark, self.base)
        fs.mkdirs(p)
        fs.deleteOnExit(p)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove some tables, or all of them."""
        for n in names:
            delete(self.spark, self.path(n))
        if not names:
            delete(self.spark, self.base)

    def sweep(self) -> None:
        """Let Spark remove the shuffle files of frames that are no longer referenced."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
