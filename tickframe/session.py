"""Session settings the package relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SCRATCH = "spark.checkpoint.dir"
_made: list[str] = []
_own: dict[str, str] = {}  # by application


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options every operator assumes.

    All time arithmetic runs on UTC microseconds, so the session zone must be UTC.
    Dynamic overwrite makes partition writes replace only the partitions they hold.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Python workers of a session that was started elsewhere must find this package, too.
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
    app = spark.sparkContext.applicationId
    if not spark.conf.get(SCRATCH, None) and spark.sparkContext.master.startswith("local["):
        # One machine, no cluster: the session gets a folder of its own, gone when it ends.
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="spark-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder that ``spark.checkpoint.dir`` names."""
    root = spark.conf.get(SCRATCH, None) or _own.get(spark.sparkContext.applicationId)
    if not root:
        raise RuntimeError(f"set {SCRATCH} to a folder all executors can reach")
    _made.append(f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def clear_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder handed out so far; results that read them must be finished."""
    from tickframe.sinks.files import remove

    done = 0
    while _made:
        done += bool(remove(spark, _made.pop()))
    return done
