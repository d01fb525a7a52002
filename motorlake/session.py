"""Session defaults and the shared folder jobs write intermediate tables to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: str = "*", app: str = "motorlake", **conf: str) -> SparkSession:
    """A session for tests and benchmarks on one machine; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder, removed when Python ends: there
    driver and tasks share one machine. A cluster without ``spark.checkpoint.dir`` is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="motorlake-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
        context.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared root that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
