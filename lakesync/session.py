"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "lakesync", **conf: str) -> SparkSession:
    """A single-machine session for tests and trials; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # The JVM compiles no method above 8000 bytes; wide projections are better split than interpreted.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's ``spark.checkpoint.dir``, for tables written to cut lineage.

    Every executor must see the folder, so a machine-local one is made only for a local master
    with that setting unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        app = context.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="lakesync-")
        root = _local_dirs[app]
    return f"{root.rstrip('/')}/lakesync/{label}-{uuid.uuid4().hex}"
