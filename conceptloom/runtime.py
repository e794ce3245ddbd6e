"""Session, scratch tables and small plan helpers shared by all operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open: list["Scratch"] = []


def local_session(name: str = "conceptloom", cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local folder only if the master is local."""
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    if (already := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        return already.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="conceptloom-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


class Scratch:
    """Written tables under the shared folder that cut the lineage of loops.

    A lost executor costs nothing: the files outlive it. Each write frees the shuffle files it needed; a table
    that is no longer read is dropped, the rest when the session's Python process ends.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/conceptloom-{label}-{uuid.uuid4().hex}"
        _open.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        before = self.spark.conf.get(_SHUFFLE_CLEANUP, "false")
        try:
            self.spark.conf.set(_SHUFFLE_CLEANUP, "true")
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_SHUFFLE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _clean() -> None:
    for scratch in _open:
        try:
            scratch.drop()
        except Exception:  # the session is gone: the cluster's own cleaning of the folder holds
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prefer_rows(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key: repeat rows carry the same values but for their time of arrival."""
    return df.dropDuplicates(list(keys))


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum of all columns, for tests of convergence."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
    return int(row["n"]), int(row["h"])
