"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")
_shipped: set[str] = set()
_stages: dict[str, list[str]] = {}
_once: dict[str, dict] = {}
#: Spark's setting that deletes the shuffle files of a query at its end; else they stay until the driver collects its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "shelfwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` entries win.

    Shuffle width is left to the caller: on a cluster set
    ``spark.sql.shuffle.partitions`` high and let AQE merge small partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # The JVM never compiles a method beyond 8000 bytes of bytecode; the wide
        # cleaning projections run faster split into small ones than fused.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; without it a folder in the session's warehouse, which is shared as well."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/shelfwatch-stages"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no earlier run has used; ``drop_stages`` deletes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _stages.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    For results that several later branches read. A written table keeps column
    pruning and filter pushdown for those branches and survives executor loss.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, label: str = "stage", slices: int = 1, by: str | None = None) -> DataFrame:
    """:func:`materialise` for whole snapshot tables: packed tighter, no shuffle file outlives its write.

    With ``slices`` the rows are written in turns, by the hash of column ``by``, so that no
    more than one slice of a shuffle is on disk at once; ``df`` is computed once for each.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with passing_shuffles(spark):
        for part in sliced(df, slices, by):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sliced(df: DataFrame, slices: int, by: str | None, buckets: int | None = None) -> list[DataFrame]:
    """The rows in ``slices`` frames by the hash of ``by``; with ``buckets`` no bucket of a table is in two of them."""
    if slices <= 1:
        return [df]
    place = F.pmod(F.pmod(F.hash(by), F.lit(buckets)) if buckets else F.xxhash64(by), F.lit(slices))
    return [df.where(place == i) for i in range(slices)]


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside delete their shuffle files when they end."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


@contextmanager
def passing_stages(spark: SparkSession, keep: str | None = None) -> Iterator[None]:
    """What is staged inside, except below the label ``keep``, is deleted at the end, when the results lie in tables of their own."""
    made = _stages.setdefault(spark.sparkContext.applicationId, [])
    before = len(made)
    try:
        yield
    finally:
        kept = [p for p in made[before:] if keep and p.rsplit("/", 1)[1].rpartition("-")[0] == keep]
        _delete(spark, [p for p in made[before:] if p not in kept])
        made[before:] = kept


def _file_system(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def stage_once(spark: SparkSession, key: tuple, build: Callable[[], T]) -> T:
    """What ``build`` returns, built once per application and ``key``; for tables that several queries read.

    Built again where a path that it wrote has been deleted since.
    """
    app = spark.sparkContext.applicationId
    known = _once.setdefault(app, {})
    if key in known:
        made, paths = known[key]
        if all(system.exists(path) for system, path in (_file_system(spark, p) for p in paths)):
            return made
    before = len(_stages.setdefault(app, []))
    made = build()
    known[key] = made, _stages[app][before:]
    return made


def discard(df: DataFrame) -> None:
    """Delete the stages that ``df`` reads, once nothing else does."""
    made, files = _stages.get(df.sparkSession.sparkContext.applicationId, []), df.inputFiles()
    for path in [p for p in made if any(p.rsplit("/", 1)[1] in f for f in files)]:
        _delete(df.sparkSession, [path])
        made.remove(path)


def drop_stages(spark: SparkSession) -> int:
    """Delete what was written below paths of ``fresh_path`` for this application; returns how many paths.

    Call it when the results that were read from them are stored.
    """
    _once.pop(spark.sparkContext.applicationId, None)
    paths = _stages.pop(spark.sparkContext.applicationId, [])
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        system, path = _file_system(spark, name)
        system.delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed by jobs whose Python runs inside tasks (pages, some corpus operators); not needed
    when the job was submitted with the package in ``--py-files``.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="shelfwatch-zip-")) / "shelfwatch.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
