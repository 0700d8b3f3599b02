"""Session defaults and the shared folder for staged tables."""

import atexit
import shutil
import tempfile
import uuid
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

_local_folder: dict[str, str] = {}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, **more: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own settings.

    More settings go in with underscores for dots, e.g. spark_sql_ansi_enabled="true".
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("tenura")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for name, value in more.items():
        builder = builder.config(name.replace("_", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches: the cluster's spark.checkpoint.dir.

    Only a local[...] session, where driver and executors are one process, may fall back to a
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="tenura-")
        atexit.register(shutil.rmtree, _local_folder[app], ignore_errors=True)
    return _local_folder[app]


def clear_work(spark: SparkSession) -> None:
    """Delete the intermediate tables this application has written so far. Frames that still read them
    fail afterwards, so call it between queries, once their results are taken."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tenura/{spark.sparkContext.applicationId}")
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path):
        for entry in store.listStatus(path):
            if entry.getPath().getName().startswith("work-"):
                store.delete(entry.getPath(), True)


def written_table(spark: SparkSession, df, *partition_by: str):
    """Write an intermediate table to the shared folder and read it back.

    Cuts the lineage and lets Catalyst see real sizes. Each call takes a new folder.
    """
    path = work_folder(spark)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return spark.read.parquet(path)


def work_folder(spark: SparkSession, name: str = "work") -> str:
    """A new folder path for one output, below the shared folder."""
    return f"{shared_folder(spark)}/tenura/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def spread(df, key: str, parts: int | None = None):
    """The rows dealt to all tasks by key, in an order that does not depend on how they came. For tables that are
    scanned many times: a small one comes as one file, and every scan of it would run in one task."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, key).sortWithinPartitions(key)


def in_parallel(tasks: list, threads: int = 8) -> list:
    """Run driver calls that each submit Spark jobs (model fits) side by side, results in order."""
    with ThreadPool(min(threads, max(len(tasks), 1))) as pool:
        return pool.map(inheritable_thread_target(lambda task: task()), tasks)
