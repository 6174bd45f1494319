"""Session settings, shared scratch space and scoped configuration."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Static plan settings a cluster job would put in spark-defaults; all are public Spark options.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}

_local_base: str | None = None
_shipped: set[str] = set()


def build_session(name: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need not find it themselves."""
    if spark.sparkContext.applicationId in _shipped:
        return
    source = Path(__file__).resolve().parent
    if source.is_dir():  # not when the package already runs out of an archive
        folder = Path(tempfile.mkdtemp(prefix="tidewater-package-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "tidewater"), "zip", source.parent, source.name))
    _shipped.add(spark.sparkContext.applicationId)


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone; every text date in the warehouse is rendered in it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_base(spark: SparkSession) -> str:
    """Folder that every executor can reach: ``spark.checkpoint.dir``, or a temp dir in local mode only."""
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="tidewater-")
        atexit.register(shutil.rmtree, _local_base, ignore_errors=True)
    return _local_base


def new_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Set SQL options for one block; a double underscore in a name stands for a dot."""
    wanted = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
