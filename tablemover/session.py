"""Session helpers: recommended settings and the shared work folder.

Jobs that write scratch tables (copies under test, CSV checkpoints, lineage cuts) put them under
the folder the cluster names in ``spark.checkpoint.dir``. On a cluster that folder is shared
storage, so a lost executor or a restarted driver finds the same files. Only when the setting is
missing (a laptop, a unit test) do we make a local folder and register it.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings for large copies and reconciliations. AQE re-plans joins and coalesces shuffle output at
# run time, splits skewed join partitions, and the writer keeps a few files open per task instead of
# sorting a whole task's rows by partition value before a partitioned write.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def build_session(master: str = "local[*]", app: str = "tablemover", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster pass your own builder settings."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.session.timeZone", "UTC"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    v = spark.conf.get(key, None)
    if v:
        return v
    return spark.sparkContext.getConf().get(key, None)


def work_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` when set, else a new local one."""
    root = _conf(spark, "spark.checkpoint.dir")
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            # A folder on the driver's disk is invisible to executors and lost with the driver.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                               "before running tablemover on a cluster")
        root = tempfile.mkdtemp(prefix="tablemover-")
        spark.sparkContext.setCheckpointDir(root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, uniquely named folder under the shared scratch folder."""
    root = work_root(spark)
    path = f"{root}/tablemover/{purpose}-{uuid.uuid4().hex[:12]}"
    _note("folder", path)
    return path


def pinned(df, purpose: str):
    """``df`` written as Parquet to the shared scratch folder and read back, and its folder: retried tasks see
    the very same rows, and nothing is computed twice. ``drop_folder`` removes it when nobody reads it any more."""
    path = new_work_dir(df.sparkSession, purpose)
    df.write.parquet(path + "/t")
    return df.sparkSession.read.schema(df.schema).parquet(path + "/t"), path


def drop_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def new_database(spark: SparkSession, purpose: str) -> str:
    """Create a uniquely named database whose managed tables live in the shared scratch folder."""
    name = f"tm_{purpose}_{uuid.uuid4().hex[:10]}"
    loc = new_work_dir(spark, f"db-{purpose}")
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{loc}'")
    _note("database", name)
    return name


_noted: ContextVar[list | None] = ContextVar("scratch", default=None)


def _note(kind: str, name: str) -> None:
    if (made := _noted.get()) is not None:
        made.append((kind, name))


@contextmanager
def scratch(spark: SparkSession):
    """Drops the databases and deletes the folders that ``new_database`` and ``new_work_dir`` gave out
    inside the block. Only for work whose results don't read them any more."""
    token = _noted.set([])
    try:
        yield
    finally:
        made = _noted.get()
        _noted.reset(token)
        for kind, name in made:
            if kind == "database":
                spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for kind, name in made:
            if kind == "folder":
                path = jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(conf).delete(path, True)


def scale_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job that shuffles about ``shuffle_bytes`` on ``total_cores`` cores.

    Aggregates (``exceptAll``, keyed diffs) cannot have a partition split after the fact -- AQE
    only coalesces small ones and splits skewed *joins* -- so the initial shuffle partition count
    must already give each reducer about ``target_partition_bytes``; AQE then merges the small
    ones. Example: a full ``exceptAll`` of two 50 TB tables shuffles ~100 TB -> ~400k initial
    partitions, coalesced at run time.
    """
    n = max(2 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
