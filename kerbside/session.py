"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings the results or the plans rely on; sizes (memory, shuffle partitions) belong to
# the cluster that submits the job.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

_local_root: str | None = None


def build_session(app_name: str = "kerbside", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_object_store(spark: SparkSession, endpoint: str | None) -> None:
    """Point the S3A filesystem at another endpoint; reads and writes keep their paths."""
    if endpoint:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        hadoop.set("fs.s3a.endpoint", endpoint)
        hadoop.set("fs.s3a.path.style.access", "true")


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach: `spark.checkpoint.dir`, or a temp folder in local mode."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="kerbside-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; the writer creates it."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage with checkpoints, so the context needs a folder for them."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/checkpoints")


class Scratch:
    """Tables in the shared folder that an operator needs on its way and deletes at the end:

    with Scratch(spark) as scratch:
        steps = scratch.cut(frame)
        result = cut(steps...)

    A table of it costs lost executors no more than a read, and hands on nothing of the plan behind it, where a
    checkpoint keeps the constraints of its plan, which grow with every step of an iteration.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def cut(self, frame: DataFrame, *by: str) -> DataFrame:
        """The rows, in a folder for each value of the columns `by`."""
        path = new_folder(self.spark, "scratch")
        self.paths.append(path)
        frame.write.partitionBy(*by).option("compression", "none").parquet(path)  # read once or twice: codecs would hold memory for little
        return self.spark.read.schema(frame.schema).parquet(path)

    def __exit__(self, *_) -> None:
        path_of, conf = self.spark._jvm.org.apache.hadoop.fs.Path, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(path_of, self.paths):
            path.getFileSystem(conf).delete(path, True)
        self.paths.clear()
