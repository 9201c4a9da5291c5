"""Session construction and the shared scratch folder."""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Object-store timeouts and retry interval, in milliseconds.
OBJECT_STORE_CONF = {
    "spark.hadoop.fs.s3a.connection.timeout": "60000",
    "spark.hadoop.fs.s3a.connection.establish.timeout": "60000",
    "spark.hadoop.fs.s3a.retry.interval": "5000",
}

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Window state lives on local disk and in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(
    app_name: str,
    extra_conf: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Return a session with this package's defaults.

    Values given to ``spark-submit`` win over the defaults, and ``extra_conf``
    wins over both. Shuffle parallelism and memory are left to the deployment.
    """
    submitted = SparkConf()
    conf = {
        key: value
        for key, value in {**ENGINE_CONF, **OBJECT_STORE_CONF}.items()
        if not submitted.contains(key)
    }
    conf.update(extra_conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder for intermediate tables and checkpoints.

    It lies under ``spark.checkpoint.dir``, or where that is not set under the
    warehouse, as every executor must reach it. What is written there is left to
    whoever cleans that folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"
