"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPES: list[list[str]] = []       # tables written by ``cut`` inside the open scopes, innermost last


def build_session(app_name: str = "wayfleet", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on (UTC, AQE, skew join)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are compared as UTC everywhere; set it if the caller did not."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Add the package as a Python file of the application, once (Spark serves it to every executor)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="wayfleet-code-"), "wayfleet_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for path in sorted((root / "wayfleet").rglob("*.py")):
            out.write(path, path.relative_to(root).as_posix())
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of
    its own; a cluster must name a folder that outlives its executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="wayfleet-")
    return _LOCAL_SCRATCH[sc.applicationId]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the written table.

    The copy survives the loss of executors, ends the lineage, and gives later
    joins an exact size to choose a strategy from.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/wayfleet/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._scratch_path = path
    if _SCOPES:
        _SCOPES[-1].append(path)
    return written


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete the tables that ``cut`` writes inside, at the end.

    The function it gives keeps a written table: it then belongs to the scope
    around this one, if any. What leaves the scope must rest on kept tables only.
    """
    own: list[str] = []
    _SCOPES.append(own)

    def keep(table: DataFrame) -> DataFrame:
        own.remove(table._scratch_path)
        if len(_SCOPES) > 1:
            _SCOPES[-2].append(table._scratch_path)
        return table

    try:
        yield keep
    finally:
        _SCOPES.pop()
        delete(spark, own)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths of the tables that ``cut`` writes inside, for a caller that deletes them later."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield own
    finally:
        _SCOPES.pop()


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Remove folders through the file system that holds them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)


def task_count(spark: SparkSession) -> int:
    """How many tasks a CPU-heavy step should be dealt out to."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain file scan out to all cores when it has fewer partitions.

    Inputs of any real size already have more and are left as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
