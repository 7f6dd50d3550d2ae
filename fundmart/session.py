"""Session helpers: the shared folder, written intermediate tables, size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Well under Spark's own limit for a broadcast, and small beside an executor's memory.
BROADCAST_BYTES = 64 << 20


def new_session(app: str = "fundmart", **conf: str) -> SparkSession:
    """Session with the settings the jobs rely on; a cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A task writes a handful of record types or deliveries at once: keep their
        # files open instead of sorting the rows first.
        "spark.sql.maxConcurrentOutputFileWriters": "16",
        # Wide record types make long generated methods, which the JVM would leave
        # interpreted. The "default" options are put before a cluster's own ones.
        "spark.driver.defaultJavaOptions": "-XX:-DontCompileHugeMethods",
        "spark.executor.defaultJavaOptions": "-XX:-DontCompileHugeMethods",
        # Building wide selects is much slower with call-site capture.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches, for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share a disk, may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="fundmart-"))
    return context.getCheckpointDir()


class Stage:
    """Written intermediate tables of one job.

    A written table cuts the lineage: readers see one fixed set of rows, also
    when executors are lost later on. ``close`` removes only this job's folder.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/fundmart-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.folder}/{name}"
        # One file per task and partition: readers may count on it.
        writer = df.write.mode("error").option("maxRecordsPerFile", 0)
        writer.partitionBy(*by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        remove_folder(self.spark, self.folder)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def _scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/fundmart-{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an operator's intermediate table and read it back.

    Results are lazy and read it later on, so it stays until the application calls
    ``clear_written``; a job with a scope of its own has a ``Stage``.
    """
    path = f"{_scratch(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_written(spark: SparkSession) -> None:
    """Remove what ``written`` has written, once the application's results are saved."""
    remove_folder(spark, _scratch(spark))


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _filesystem(spark, path)
    return bool(filesystem.exists(target))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty when the folder does not exist."""
    filesystem, target = _filesystem(spark, path)
    if not filesystem.exists(target):
        return []
    return sorted(status.getPath().getName() for status in filesystem.listStatus(target))


def remove_folder(spark: SparkSession, path: str) -> None:
    filesystem, target = _filesystem(spark, path)
    if filesystem.exists(target):
        filesystem.delete(target, True)


class TextFile:
    """One UTF-8 document, written piece by piece through the cluster's file system."""

    PIECE = 1 << 16

    def __init__(self, spark: SparkSession, path: str) -> None:
        filesystem, target = _filesystem(spark, path)
        self.stream = filesystem.create(target, True)
        self.waiting: list[str] = []
        self.size = 0

    def write(self, text: str) -> None:
        self.waiting.append(text)
        self.size += len(text)
        if self.size >= self.PIECE:
            self._send()

    def _send(self) -> None:
        self.stream.write(bytearray("".join(self.waiting).encode("utf-8")))
        self.waiting, self.size = [], 0

    def __enter__(self) -> TextFile:
        return self

    def __exit__(self, *_: object) -> None:
        self._send()
        self.stream.close()


def together(*actions: Callable[[], object], at_once: int = 4) -> None:
    """Run independent Spark jobs side by side, so one job's tail does not idle the rest."""
    with ThreadPoolExecutor(at_once) as pool:
        for done in [pool.submit(action) for action in actions]:
            done.result()


def small_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a join side only after its size is checked, in bytes.

    Strings count by their length, other columns by the size of their type. Beyond the
    limit the frame is returned as it is: the join then shuffles, and adaptive execution
    splits skewed keys. The check reads no more rows than would fit.
    """
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    fixed = 8 * (len(df.columns) + len(texts))
    rows = df.limit(max_bytes // fixed + 1)
    size = F.lit(fixed)
    for name in texts:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
    used = rows.agg(F.sum(size.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if used <= max_bytes else df
