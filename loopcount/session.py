"""Session helpers: the shared folder for written intermediate tables, and what lies at a path."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``, else the session's
    checkpoint folder. Only where neither is set, a temporary folder is made the checkpoint
    folder (local trials; a cluster has to name a shared one)."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="loopcount-"))
        configured = sc.getCheckpointDir()
    return configured.rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([shared_dir(spark), "loopcount", *parts])


#: Folders of intermediate tables that this process wrote and did not remove yet, by application.
_MADE: dict[str, list[str]] = {}


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in a new shared folder and read back: its lineage is cut, and
    nothing stays persisted in the session. ``remove_stored`` removes the folder."""
    spark = df.sparkSession
    path = shared_path(spark, "stored", f"{label}-{uuid.uuid4().hex}")
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_stored(spark: SparkSession, since: int = 0) -> int:
    """Remove the intermediate tables that ``stored`` wrote in this application (all, or those
    after the first ``since``); to be called when no DataFrame on them is needed any more.
    Returns how many."""
    made = _MADE.get(spark.sparkContext.applicationId, [])
    gone, made[since:] = made[since:], []
    for path in gone:
        delete_folder(spark, path)
    return len(gone)


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables made inside are removed at the end, also after an error."""
    since = len(_MADE.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        remove_stored(spark, since)


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path`` (the default one where it names no scheme) and the path."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time) of the data files at or below ``path``, sorted; markers
    and hidden files are left out."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    out, it = [], fs.listFiles(hpath, True)
    while it.hasNext():
        status = it.next()
        if not status.getPath().getName().startswith(("_", ".")):
            out.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out)


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when there is a data file at or below ``path``."""
    fs, hpath = _hadoop(spark, path)
    if not fs.exists(hpath):
        return False
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        if not it.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def path_complete(spark: SparkSession, path: str) -> bool:
    """True when a committed output (with its marker file) lies at ``path``."""
    fs, hpath = _hadoop(spark, path + "/_SUCCESS")
    return bool(fs.exists(hpath))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package made in the shared folder; no other path."""
    if not path.startswith(shared_path(spark) + "/"):
        raise ValueError(f"not a folder of this package: {path}")
    fs, hpath = _hadoop(spark, path)
    fs.delete(hpath, True)
