"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every session of this library should carry.  Adaptive execution
# re-plans joins at runtime (a side is broadcast only once its measured size is
# under the threshold), coalesces small shuffle partitions and splits skewed
# join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "civica", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    On a cluster the setting is required and points to shared storage.  Only
    a local master, whose tasks all see the driver's disk, gets a folder of
    its own when it is unset (tests).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is not set: {master} needs a folder that all executors share")
        d = tempfile.mkdtemp(prefix="civica-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder for intermediate tables."""
    base = shared_dir(spark)
    if "://" not in base and not base.startswith(("/", "file:")):
        raise ValueError(f"spark.checkpoint.dir must be an absolute path or a URI, not {base!r}")
    path = f"{base}/civica/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


# Scratch paths handed out, and databases created in them, per application.
_scratch: dict[str, list[str]] = {}
_databases: dict[str, list[str]] = {}


def scratch_database(spark: SparkSession, name: str) -> str:
    """A database below the shared folder, which ``clean_scratch`` drops.  One
    that is there already stays as it is, and is not dropped."""
    if not spark.catalog.databaseExists(name):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{scratch_path(spark, f'warehouse-{name}')}'")
        _databases.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def clean_scratch(spark: SparkSession) -> int:
    """Deletes the intermediate tables, and the databases in the shared
    folder, that this application has written so far.  For when no DataFrame
    that reads them is needed any more."""
    for name in _databases.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's sources to the executors, once per context, so
    that Python tasks can import it wherever the driver was started.  Nothing
    to do where it was submitted as an archive (``--py-files``)."""
    sc = spark.sparkContext
    package = os.path.dirname(os.path.abspath(__file__))
    if getattr(sc, "_civica_shipped", False) or not os.path.isdir(package):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="civica-ship-"), "civica_package.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    sc._civica_shipped = True


def cut_lineage(df, spark: SparkSession | None = None, name: str = "cut"):
    """Materialise ``df`` as Parquet below the shared folder and read it
    back.  One pass (a plain ``checkpoint()`` of an unpersisted frame runs
    the plan twice), columnar and pruned on re-read, and it survives the
    loss of any executor; never a machine-local checkpoint."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stored_bytes(df) -> int:
    """Bytes of the files that a table read from files consists of (file
    metadata only)."""
    return sum(_path_bytes(df.sparkSession, f) for f in df.inputFiles())


def _path_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).getLen()


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 ** 2,
               executor_cores_total: int | None = None, shuffle_partition_bytes: int = 2 * 1024 ** 3) -> dict[str, str]:
    """Settings sized to the input: scan splits of ``target_partition_bytes``
    and shuffle partitions of about ``shuffle_partition_bytes``, at least two
    per core.  Shuffle blocks number map tasks × partitions, so partitions of
    a shuffle are larger than splits: 100 TB gives about 50k of them, which
    sort and aggregate with spilling; AQE splits skewed ones."""
    parts = max(1, -(-input_bytes // shuffle_partition_bytes))
    if executor_cores_total:
        parts = max(parts, 2 * executor_cores_total)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 ** 2),
    }
