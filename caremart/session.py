"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "caremart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tested with.

    ``spark.sql.codegen.maxFields`` stays at its default on purpose: typed
    claim lines are 175 columns wide, and fusing such a row into one generated
    method makes it too large for the JIT compiler (5x slower when measured).
    Methods that come out larger than HotSpot compiles all the same are left to
    Spark's operators, each of which is compiled by itself.
    """
    settings = {
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for staged tables and stream state.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session may do without it and gets a temporary folder of its own, once.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="caremart-")
    spark.conf.set(CHECKPOINT_DIR, own)
    return own


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
