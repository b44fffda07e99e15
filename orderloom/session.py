"""Session settings for the command line, the benchmark and the tests.

Library functions never change the session they are given. On a cluster the
submit configuration rules; these are only defaults.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # Runtime re-planning: coalesce small shuffle partitions, split hot ones,
    # switch a sort-merge join to broadcast only on the *measured* size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A look-up side whose every shuffled partition measures under this size is
    # hashed instead of sorted; a larger one stays a sort-merge join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "orderloom", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
