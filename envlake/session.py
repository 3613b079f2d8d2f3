"""Session settings the plans rely on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings; all of them can be set on an existing session.
RUNTIME_CONF = {
    # Every instant is handled and rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as common JSON readers do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Runtime re-planning: coalescing, broadcast by measured size, skew splits.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more shuffle later.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new folder name for one run's tables.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only where
    that is unset, as in local tests, a temporary folder takes its place.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        shared = tempfile.mkdtemp(prefix="envlake-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
