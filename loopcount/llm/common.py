"""Small helpers that several operators share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of an operator looks at together; a longer text is a step of its own.
SLICE_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Arrow batches for Python tasks where the session sets none: texts are long, and a task holds
#: a batch several times over (rows, Arrow in the JVM, Arrow in Python, results).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def prepare(spark: SparkSession) -> None:
    """Give the Python workers this package, once a SparkContext, wherever it is installed, and
    the session small Arrow batches."""
    for name, value in BATCH.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)
    sc = spark.sparkContext
    if getattr(sc, "_loopcount_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="loopcount-zip-"), "loopcount_workers.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in sorted(os.walk(top)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join(os.path.basename(top), os.path.relpath(path, top)))
    sc.addPyFile(target)
    sc._loopcount_shipped = True


def text_rows(df: DataFrame) -> DataFrame:
    """(doc_id, text); every other column of the input is ignored, whatever its name."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the decimal id leaves remainder 0 by 5; False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


#: Folders that this process named and did not remove yet, by application.
_NAMED: dict[str, list[str]] = {}


def remove_stored(spark: SparkSession) -> int:
    """Remove the intermediate tables that the operators wrote in this application; to be called
    when a query's result is written and no DataFrame on them is needed. Returns how many."""
    gone = _NAMED.pop(spark.sparkContext.applicationId, [])
    for path in gone:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return len(gone)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder; ``remove_stored`` removes the folder.

    The folder comes from ``spark.checkpoint.dir`` or the session's checkpoint folder; only
    where neither is set (tests, local trials) a temporary one is set.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="loopcount-shared-")
        sc.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    _NAMED.setdefault(sc.applicationId, []).append(path)
    return path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, row_bytes: int, limit: int = 16 << 20) -> bool:
    """Whether ``df`` (a stored table) is proven to stay under ``limit`` bytes when broadcast."""
    return df.count() * row_bytes <= limit


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows, from 0) of a string column; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def sliced(batches: Iterable[pa.RecordBatch], text_column: int = 1, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(text_column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + size, side="right")) - 1)
            yield batch.slice(begin, end - begin)
            begin = end


# --- hashes of words --------------------------------------------------------------------

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 2**63, size=256, dtype=np.uint64)
_RATIO = int(_SEED.integers(1, 2**62)) * 2 + 1
_RATIO_INVERSE = pow(_RATIO, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, ratio: int, n: int) -> np.ndarray:
    """1, ratio, ratio**2, ... modulo 2**64."""
    got = _powers.get(name)
    if got is None or len(got) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        got = np.full(size, np.uint64(ratio), dtype=np.uint64)
        got[0] = 1
        got = np.multiply.accumulate(got)
        if size <= SLICE_BYTES * 4:
            _powers[name] = got
    return got


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of True that lies within one text of the offsets ``at``."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = at[1:-1]
    cut = cut[cut < n]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[1:-1] - 1
    cut = cut[cut >= 0]
    last[cut] = inside[cut]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial by prefix sums, then mixed."""
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _power_table("up", _RATIO, len(raw))[:len(raw)], out=sums[1:])
    back = _power_table("down", _RATIO_INVERSE, len(raw))
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
