"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession


def build_session(app: str = "reviewlens", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings every job here assumes.

    AQE picks post-shuffle partition sizes and splits skewed join partitions at run time, so
    ``spark.sql.shuffle.partitions`` is only the upper bound from which it coalesces.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Folders of local sessions that name none, by application.
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local-mode session may lack the setting; it then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="reviewlens-")
    return _local_dirs[app]


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses; what is there goes when the process ends."""
    if not _scratch:
        atexit.register(remove_scratch)
    path = f"{shared_dir(spark)}/reviewlens/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def remove_scratch() -> None:
    """Delete all scratch folders of this process; nothing happens if the JVM is gone already."""
    jvm = SparkContext._jvm
    try:
        conf = jvm.org.apache.hadoop.conf.Configuration()
        for path in _scratch:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
    except Exception:  # noqa: BLE001  the JVM may be ending: then the folder's owner cleans up
        return
    finally:
        _scratch.clear()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder unless the cluster already did."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
