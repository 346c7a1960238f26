"""Session settings for cluster runs, the checkpoint folder and staged tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split skewed join partitions even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows here unfold to twenty times their compressed size and more: a task takes 16 MB of a shuffle, not 64
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # and 16 MB of a file: what a task combines or sorts stays the same size as tables grow
    "spark.sql.files.maxPartitionBytes": "16m",
    # lists of up to 3000 characters can need 1521 names: cut them before the shuffle too
    "spark.sql.optimizer.windowGroupLimitThreshold": "4000",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # plans here have thousands of column calls; do not record the call site of each
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

#: pieces that a shuffle is dealt into where a session keeps Spark's 200: adaptive execution joins small ones, but takes
#: none apart, and a task that meets one of 200 parts of a large table sorts more than its memory holds
PIECES = 800

_staged: list[str] = []


def build_session(master: str | None = None, app: str = "cataloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _deal_finely(spark)
    return spark


def tune(spark: SparkSession) -> None:
    """Give a session that was built elsewhere the settings that can still be changed."""
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    _deal_finely(spark)


def _deal_finely(spark: SparkSession) -> None:
    """Start shuffles with ``PIECES`` unless the session names a number of its own."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get("spark.sql.shuffle.partitions") == "200" and spark.conf.get(first, None) is None:
        spark.conf.set(first, str(PIECES))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local master may do without: it gets a new folder. Any other master must name
    one, because its executors do not see the driver's folders.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    return tempfile.mkdtemp(prefix="cataloom-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def staging_path(spark: SparkSession) -> str:
    """A new place in the shared folder; it goes with ``drop_staged`` or when the driver ends."""
    path = f"{shared_folder(spark)}/cataloom-stage-{uuid.uuid4().hex}"
    if not _staged:
        atexit.register(_drop_at_exit)
    _staged.append(path)
    return path


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write rows once to the shared folder as Parquet and read them from there.

    For rows several consumers need: the source is parsed once, and each consumer
    reads only its own columns, nested ones included. The folder goes with
    ``drop_staged`` or when the driver ends.
    """
    spark = df.sparkSession
    path = staging_path(spark)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Remove all folders that ``stage`` has written in this driver."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        drop_staged(spark)
