"""Markers, deletions and scratch tables on whatever file system Spark itself uses."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SUCCESS_MARKER = "_SUCCESS"  # Fixed value: what the file committers write, and every stage looks for.


def _resolve(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _resolve(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _resolve(spark, path)
    fs.mkdirs(target)


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file, replacing one that is there."""
    fs, target = _resolve(spark, path)
    fs.create(target, True).close()


def has_marker(spark: SparkSession, path: str, marker: str = SUCCESS_MARKER) -> bool:
    return exists(spark, f"{path}/{marker}")


class Scratch:
    """Tables written to shared storage so that later steps do not redo the work behind them.

    They survive the loss of executors, unlike cached blocks, and being Parquet they let a later step
    read only the columns it needs. The folder is the one the session names in `spark.checkpoint.dir`.
    """

    def __init__(self, spark: SparkSession, base: str | None = None):
        self.spark = spark
        self.root = f"{base or _scratch_base(spark)}/palimpsest-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Lets go of tables that nothing reads any more."""
        for name in names:
            delete(self.spark, self.path(name))

    def close(self) -> None:
        delete(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()


_session_roots: dict[str, str] = {}


def session_scratch(spark: SparkSession) -> Scratch:
    """A scratch for results that are read after the call that made them: it goes when the driver's program ends."""
    application = spark.sparkContext.applicationId
    if application not in _session_roots:
        root = _session_roots[application] = f"{_scratch_base(spark)}/palimpsest-{application}-{uuid.uuid4().hex}"
        fs, target = _resolve(spark, root)

        def remove() -> None:
            with contextlib.suppress(Exception):  # The JVM may have gone first.
                fs.delete(target, True)

        atexit.register(remove)
    return Scratch(spark, _session_roots[application])


_local_bases: dict[str, str] = {}


def _scratch_base(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        application = spark.sparkContext.applicationId
        if application not in _local_bases:
            _local_bases[application] = tempfile.mkdtemp(prefix="palimpsest-")
        return _local_bases[application]
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
