"""Session settings and the shared working area used by table-writing operators."""

from __future__ import annotations

import contextlib
import copy
import posixpath
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession

# Settings the engine relies on. Timestamps in the data model are UTC, dynamic
# partition overwrite is what makes day-slice rewrites safe, and AQE re-plans
# joins (size-checked broadcast) and skewed shuffles at runtime. A job runs many
# actions: the shuffle files of each go when it ends, not when the driver next
# collects garbage (the same DataFrame run again writes them again). A scan holds
# a batch of rows per task, and their texts in one array that doubles as it grows:
# landed pages of 100 KB would take 400 MB and more in batches of Spark's 4096 rows.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}

#: Shuffles start with at least so many partitions, so that what one task sorts stays small as
#: tables grow; AQE joins those that are smaller than its advisory size.
INITIAL_PARTITIONS = 200


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "ledgerline", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster, pass the cluster's settings."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for key, value in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings above to a session someone else built."""
    for key, value in ENGINE_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(initial, None) is None:
        spark.conf.set(initial, str(max(INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session. Only on a local master with nothing configured
    (tests) is a folder created and registered; on a cluster an unset
    setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    found = (spark.conf.get("spark.checkpoint.dir", None)
             or sc.getConf().get("spark.checkpoint.dir", None)
             or sc.getCheckpointDir())
    if found:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(found)
        return found
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                           "(stage tables, checkpoints and stream state live there)")
    local = tempfile.mkdtemp(prefix="ledgerline-shared-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for what one call writes and reads back."""
    return posixpath.join(shared_dir(spark), "ledgerline", "_scratch", f"{name}-{uuid.uuid4().hex}")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system with what is in it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def counted(seen: Observation) -> dict:
    """What was observed while rows were written; nothing if there were none (AQE then drops the
    plan together with its counts)."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        return {}


class Workspace:
    """A catalog database whose table files live under the shared folder.

    Every table-writing operator takes a workspace, so a run can be pointed at
    production tables or at an isolated area (tests, the correctness check).
    """

    def __init__(self, spark: SparkSession, name: str | None = None, root: str | None = None):
        self.spark = spark
        self.name = name or f"ll_{uuid.uuid4().hex[:12]}"
        self.root = root or posixpath.join(shared_dir(spark), "ledgerline", self.name)
        self.stages = self.path("_stage", uuid.uuid4().hex)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.name}` LOCATION '{self.root}'")

    def table(self, name: str) -> str:
        return f"{self.name}.{name}"

    def path(self, *parts: str) -> str:
        """A folder for landing files, stream checkpoints and the like."""
        return posixpath.join(self.root, "_files", *parts)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(name, self.name)

    def stage(self) -> str:
        """A fresh path for what one run of a job writes and reads back."""
        return posixpath.join(self.stages, uuid.uuid4().hex)

    @contextlib.contextmanager
    def run(self):
        """This workspace with stages of its own, which are deleted at the end."""
        own = copy.copy(self)
        own.stages = self.path("_stage", uuid.uuid4().hex)
        try:
            yield own
        finally:
            delete_folder(self.spark, own.stages)

    def drop(self) -> None:
        """Drop the database with its tables, and everything under the workspace's folder."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.name}` CASCADE")
        delete_folder(self.spark, self.root)
