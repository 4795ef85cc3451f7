"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Number of tasks that the queries deal small tables out to; unset on clusters, whose tables have many splits.
SPREAD_PARTITIONS = "spark.docsieve.spreadPartitions"

_local_scratch: dict[str, str] = {}


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and for the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docsieve")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docsieve-"))
        .config(SPREAD_PARTITIONS, str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Executors on other machines must be able to read what is written there, so a
    machine-local folder is only ever chosen for a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.conf.get("spark.app.id")
        base = _local_scratch.get(app) or tempfile.mkdtemp(prefix="docsieve-")
        _local_scratch[app] = base
    return f"{base.rstrip('/')}/docsieve/{label}-{uuid.uuid4().hex}"
