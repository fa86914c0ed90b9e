"""Session with the settings the jobs rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",  # tables dealt by some of a join's keys meet in place
    "spark.sql.session.timeZone": "UTC",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


_local_folders: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_kept: set[str] = set()


def shuffle_settings(input_bytes: int, per_partition: int = 128 << 20) -> dict[str, str]:
    """Shuffle partitions for a job over ``input_bytes``: small enough to fit an executor's
    share of memory. Adaptive execution merges the ones that turn out smaller. There is no
    ceiling: where the driver cannot keep so many, state larger partitions."""
    partitions = max(-(-input_bytes // per_partition), 200)
    return {"spark.sql.shuffle.partitions": str(partitions)}


def get_session(app: str, master: str | None = None, attempts: int = 1,
                wait_seconds: float = 3.0, input_bytes: int | None = None,
                **conf: str) -> SparkSession:
    """Start or join a session, retrying while the cluster is not up yet.

    ``input_bytes`` sizes the shuffles. Keyword settings use ``__`` for dots:
    ``spark__executor__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = shuffle_settings(input_bytes) if input_bytes else {}
    settings = {**DEFAULTS, **sized, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    for attempt in range(1, attempts + 1):
        try:
            return builder.getOrCreate()
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(wait_seconds)
    raise ValueError("attempts must be at least 1")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own; a cluster
    without it is an error, since a machine-local folder would be lost with its host.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="salesflow-")
    return _local_folders[app]


def stage_folder(spark: SparkSession) -> str:
    """Where this application's staged tables lie; the folder can go when it has ended."""
    return f"{shared_folder(spark)}/salesflow/{spark.sparkContext.applicationId}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A path for a staged table, which ``drop_staged`` will remove."""
    path = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys``, for rows that are about to unfold. Adaptive execution merges the partitions of other exchanges
    by what lies in them before, so the number is stated: one more than the session's shuffle partitions, or Spark would
    take an exchange by the same keys that is there already for this one."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1, *keys)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a durable table (lost executors only cost their own tasks),
    and gives Catalyst the real file size, so that later joins choose between
    broadcast and shuffle on a measured number instead of an estimate.

    ``keep`` for a table that outlives the job which made it (a model's): it only goes when it is named.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    if keep:
        _kept.add(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_all(*tables: tuple[DataFrame, str]) -> list[DataFrame]:
    """``stage`` for (table, name) pairs that do not need each other, at once: their small tasks share the cluster."""
    with ThreadPoolExecutor(len(tables)) as pool:
        return list(pool.map(lambda table: stage(*table), tables))


def staged(spark: SparkSession) -> list[str]:
    """Folders that ``stage`` has written in this application and that still lie there."""
    return list(_staged.get(spark.sparkContext.applicationId, ()))


def drop_staged(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Remove staged tables (all but kept ones by default), for a job whose result has been written.

    Only folders written by ``stage`` in this application are touched.
    """
    own = _staged.get(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in own if p not in _kept] if paths is None else [p for p in paths if p in own]:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
        own.remove(path)
        _kept.discard(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder lies at ``path``, in whatever store Spark reads it from."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def files_stamp(spark: SparkSession, folder: str) -> int:
    """A number that changes when a file or table of a folder is added, removed or written anew."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return hash(tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)))


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame, None where it cannot be asked (remote clients).

    For scans, filters and projections it is the size of the files read; aggregates and
    joins are estimated upwards, so a small number can be trusted.
    """
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def preview(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Print the schema and the first rows (an action; for pipeline logs only)."""
    df.printSchema()
    df.show(n, truncate=truncate)
