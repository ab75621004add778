"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. Join skew (one user or item holding a
# large share of the rows) is split at run time by AQE; the force flag lets it do
# so where the split costs one more shuffle further up.
SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
RECOMMENDED_CONF = {
    **SKEW_CONF,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "tastegraph") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and derived files.

    The session names it in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder of its own: on a cluster the folder must be
    one that every executor reaches.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    jvm_folder = spark.sparkContext._jsc.sc().getCheckpointDir()
    if folder is None and jvm_folder.isDefined():
        return jvm_folder.get()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="tastegraph-")
    if not jvm_folder.isDefined():
        spark.sparkContext.setCheckpointDir(folder)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return folder


def drop_at_exit(spark: SparkSession, path: str) -> None:
    """Have the driver remove a derived table when it ends; frames read from it until then."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def prepare(spark: SparkSession) -> SparkSession:
    """Set the run-time settings that the operators' joins rely on, on a session from elsewhere."""
    for key, value in SKEW_CONF.items():
        spark.conf.set(key, value)
    return spark


# Has Spark remove an execution's shuffle files when it ends, not when the driver collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read on from there.

    For a frame that a plan reads several times: it is computed once, survives lost
    executors, and readers still get column pruning and its true size. The shuffle files of
    the write go with it; the table goes by ``discard`` or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    drop_at_exit(spark, path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def one_by_one(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all frames (one at least). Each is written before the next is asked for, so the shuffle files of
    only one of them exist at a time; a single frame is returned as it is.
    """
    frames = iter(frames)
    found, following = next(frames), next(frames, None)
    if following is None:
        return found
    found = written(found)
    while following is not None:
        found, following = found.unionByName(written(following)), next(frames, None)
    return found


def discard(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing reads any more; other frames are left as they are."""
    for table in tables:
        path = getattr(table, "written_path", None) if "written_path" in vars(table) else None
        if path is not None:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
