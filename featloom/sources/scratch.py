"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINTS, WAREHOUSE = "spark.checkpoint.dir", "spark.sql.warehouse.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the session names for checkpoints. A
    local session that names none has its warehouse, by default a folder of the
    driver's, which on a cluster the executors would not share."""
    base = spark.conf.get(CHECKPOINTS, None)
    master = spark.conf.get("spark.master", None) or "local"
    if base is None and master.startswith("local") and not master.startswith("local-cluster"):
        base = spark.conf.get(WAREHOUSE, None)
    if base is None:
        raise ValueError(f"set {CHECKPOINTS} to a folder all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
