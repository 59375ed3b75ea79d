"""Helpers that every training-data operator shares: table access and shared scratch space."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shipping import ship as send

#: A word: a run of anything but space, tab, newline, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` below ``sf_dir``, read through Spark only."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where a session on one machine (tests, a laptop) names none, a temporary folder is
    made and set; on a cluster that would be wrong, and is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a folder that the driver and all executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="vellumgrid-")
        spark.conf.set("spark.checkpoint.dir", found)
        spark.sparkContext.setCheckpointDir(found)
        atexit.register(_forget, found[len("file://") :])
    return found.rstrip("/")


def _forget(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


class Scratch:
    """Tables in the shared folder that cut lineage and outlive lost executors.

    ``keep`` writes a DataFrame as Parquet and reads it back; ``drop`` deletes tables
    that nothing reads any more. What a returned DataFrame still reads must stay.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
        self.made: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; its shuffle files go once it is written."""
        path = self.path(name)
        conf, key = self.spark.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = conf.get(key, "false")
        conf.set(key, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(key, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.made.add(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            self.delete(df._scratch_path)
            self.made.discard(df._scratch_path)

    def clear(self, *stay: DataFrame) -> None:
        """Delete all tables kept so far but ``stay``, which nothing returned may read."""
        for path in self.made - {df._scratch_path for df in stay}:
            self.delete(path)
        self.made = {df._scratch_path for df in stay}

    def delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


#: Of what goes to a Python worker at once; rows of whole texts are large.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Give executors this package, for sessions whose workers can't import it themselves, and keep Arrow batches small."""
    for key, most, usual in (("maxBytesPerBatch", BATCH_BYTES, 64 << 20), ("maxRecordsPerBatch", BATCH_ROWS, 10000)):
        if str(spark.conf.get(f"spark.sql.execution.arrow.{key}", str(usual))).rstrip("b") in (str(usual), "-1"):
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))
    send(spark)


def crc_of_id(col: str = "doc_id"):
    """crc32 of an id written as text, as a long."""
    return F.crc32(F.col(col).cast("string").cast("binary"))
