"""Session helpers: the shared scratch folder, written tables, lookup joins."""

import atexit
import gc
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
SALTS = 32
REPEATED = SALTS * BROADCAST_ROWS    # rows of a salted table

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()
_scratch_of: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    It is the folder named by ``spark.checkpoint.dir``.  A local session that
    names none gets a temporary one; a cluster session must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        root = tempfile.mkdtemp(prefix="lotwise-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[app] = root
    return _local_roots[app]


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="lotwise-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/lotwise", "zip", root, "lotwise"))
    _shipped.add(context.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's own part of the scratch folder, which goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _scratch_of:
        _scratch_of.add(app)
        atexit.register(discard_scratch, spark)
    return f"{scratch_root(spark)}/lotwise/{app}/{name}-{uuid.uuid4().hex}"


def discard_scratch(spark: SparkSession) -> None:
    """Delete the application's written tables; frames that read them cannot be used any more."""
    context = spark.sparkContext
    if context._jsc is None:                # the session has ended
        return
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/lotwise/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, name: str = "table", wide: bool = False) -> DataFrame:
    """Write ``df`` once and read it back: later steps start from the files.

    ``wide`` is for texts and vectors that repeat: their files hold a small part of
    the bytes they unfold to, so a plan by file size would send them through the
    driver.  Joins with them go by shuffle unless the other side is broadcast.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    if wide:
        written = written.hint("merge")
    written._scratch_path = path
    return written


def delete_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def forget(spark: SparkSession, *written: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and have Spark drop the shuffle files of frames out of use."""
    for table in written:
        delete_path(spark, table._scratch_path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()     # the cleaner learns of dead frames by garbage collection only


def materialize_counted(df: DataFrame, name: str = "table", wide: bool = False) -> tuple[DataFrame, int]:
    """Same, with the row count observed while writing (no second job)."""
    seen = Observation()
    written = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name, wide)
    return written, seen.get["rows"]


def spread(df: DataFrame) -> DataFrame:
    """Give row work that is heavy on the processor at least one task per core."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def join_lookup(df: DataFrame, table: DataFrame, keys: list[str], rows: int | None = None,
                how: str = "left", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a table that is unique on ``keys``.

    A table whose counted rows and bytes stay under the limits is broadcast and
    ``df`` is not shuffled at all.  A larger one is joined by shuffle with
    salted keys, so that one key holding much of ``df`` is spread over up to
    ``SALTS`` tasks; the table is repeated to ``REPEATED`` rows at most, and
    beyond that adaptive execution splits what is skewed.  The salt is a row's
    place, not its content, so equal rows of a hot key are spread as well.
    """
    if rows is None or rows <= broadcast_rows:
        size = table.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)).alias("b")).first()
        if size["n"] <= broadcast_rows and size["b"] <= BROADCAST_BYTES:
            return df.join(F.broadcast(table), keys, how)
        rows = size["n"]
    salts = max(1, min(SALTS, REPEATED // max(rows, 1)))
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(f"`{k}`").isNull()
    # rows without a key meet nothing and go anywhere
    salt = F.pmod(F.monotonically_increasing_id(), F.when(empty, SALTS).otherwise(salts))
    each = F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(salts)]))
    return (df.withColumn("_salt", salt)
            .join(table.withColumn("_salt", each).hint("merge"), keys + ["_salt"], how)
            .drop("_salt"))
