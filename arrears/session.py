"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_WORK: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def build_session(app: str = "arrears", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``master`` unset and give sizes through spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.files.maxPartitionBytes": "100m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # large single-member archives are read in bounded Arrow batches
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def object_store_conf(
    key: str | None = None,
    secret: str | None = None,
    endpoint: str | None = None,
    region: str = "us-east-1",
) -> dict[str, str]:
    """Settings to read ``s3a://`` paths with explicit credentials."""
    pairs = {
        "spark.hadoop.fs.s3a.access.key": key,
        "spark.hadoop.fs.s3a.secret.key": secret,
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.endpoint.region": region,
        "spark.hadoop.fs.s3a.path.style.access": "true" if endpoint else None,
    }
    return {k: v for k, v in pairs.items() if v is not None}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder on this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK:
        _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="arrears-")
    return _LOCAL_WORK[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder; ``clear_work`` removes it."""
    base = shared_folder(spark)
    leaf = f"{name}-{uuid.uuid4().hex}"
    path = f"{base}/arrears/{leaf}" if "://" in base else os.path.join(base, "arrears", leaf)
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_work(spark: SparkSession) -> int:
    """Delete the intermediate tables this application has made, and return their number.

    Frames that read them cannot be used any more, so call it when all results are written.
    """
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path in made:
        place = hadoop.Path(path)
        place.getFileSystem(conf).delete(place, True)
    return len(made)
