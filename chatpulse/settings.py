"""Sessions and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from chatpulse.sources.folders import remove

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Only what the results depend on, or what holds at any size: memory, cores and
# shuffle width are the cluster's business.
JOB_CONF = {
    # A count beyond a declared type is an error and no other number.
    "spark.sql.ansi.enabled": "true",
    # Archive timestamps are naive ISO strings: read and window them in one zone.
    "spark.sql.session.timeZone": "UTC",
    # Hot join keys are split and small reduce partitions merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast by measured size only. The static estimate comes from file sizes,
    # and a small file of repeated texts can unpack to any size.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    # Per-user counts never leave the state, so it must not live on the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def job_session(app_name: str) -> SparkSession:
    """Session of a job; master, memory and shuffle width come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configured(spark: SparkSession) -> SparkSession:
    """A session of its own with the job's settings, beside one that someone else built.

    It has the other's settings besides, which stay as they are there.
    """
    own = spark.newSession()
    for key, value in (*spark.conf.getAll.items(), *JOB_CONF.items()):
        if key in JOB_CONF or (key.startswith("spark.sql.") and spark.conf.isModifiable(key)):
            own.conf.set(key, JOB_CONF.get(key, value))
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root and not own.conf.get("spark.checkpoint.dir", None):
        own.conf.set("spark.checkpoint.dir", root)
    return own


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset on a local master (tests, benchmarks) the application gets
    a temporary folder. On a cluster a machine-local folder would lose
    data with its machine, so there the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    # local-cluster has executors of its own, like any cluster.
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[application] = tempfile.mkdtemp(prefix="chatpulse-")
    return _LOCAL_ROOTS[application]


_LOCAL_ROOTS: dict[str, str] = {}
_WORK_FOLDERS: dict[str, list[str]] = {}


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A folder of the shared root that no other run uses."""
    folder = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    _WORK_FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def remove_work_folders(spark: SparkSession) -> int:
    """Deletes every work folder of this application, once no result is read from one any more.

    Results of queries read from their folders, so only the caller knows when.
    Returns how many there were.
    """
    folders = _WORK_FOLDERS.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        remove(spark, folder)
    return len(folders)
