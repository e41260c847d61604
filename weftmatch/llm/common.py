"""Shared folder, stored tables and vectorised word hashing for the operators of this subpackage."""

from __future__ import annotations

import atexit
import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows of one Arrow batch between the JVM and Python. Texts are long, so that the default of 10,000 rows is too much memory.
BATCH_ROWS = 128
#: Bytes of text that the vectorised functions work on at a time; a longer text is a slice of its own.
SLICE_BYTES = 400_000

_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Without that setting only a local master, as in tests, goes on."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        root = "file:///tmp/checkpoints"
    app = spark.sparkContext.applicationId
    if app not in _folders:
        _folders[app] = f"{root.rstrip('/')}/weftmatch-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _folders[app])
    return _folders[app]


def _remove(spark: SparkSession, folder: str) -> None:
    """Deletes what this application has stored, when the driver's Python ends before its JVM."""
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM is gone; nothing is left to ask
        return


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:8]}"


#: Spark's own setting that lets the shuffle files of an execution go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there, so that a lost executor costs a file read.

    Nothing reads the shuffles of the write after it, so that their files may go at once.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds the memory of Arrow batches of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """fn, after which a Python worker gives back the memory that it no longer uses: workers live on while other stages run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has one
            if trim:
                trim(0)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unlike(columns: list[str], name: str) -> str:
    """A column name that is none of the given ones, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most SLICE_BYTES of text, one row at least."""
    ends = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + SLICE_BYTES, "right")) - 1)
        yield lo, min(hi, len(texts))
        lo = min(hi, len(texts))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column without nulls (null: empty)."""
    values = batch.column(batch.schema.get_field_index(name))
    return values.fill_null("") if values.null_count else values


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), ends - ends[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]], ends - ends[0]


# ---- words and their 64-bit hashes ----

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**64, 256, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(max(n, SLICE_BYTES), base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def words_of(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of texts: where each begins and ends, and for each text how many words come before it (one number more than texts)."""
    inside = ~IS_SPACE[data]
    flips = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begins = np.zeros(len(data) + 1, bool)
    stops = np.zeros(len(data) + 1, bool)
    if len(data):
        into = inside[flips]
        begins[flips[into]] = True
        stops[flips[~into]] = True
        begins[0] = inside[0]
        stops[len(data)] = inside[-1]
        inner = ends[(ends > 0) & (ends < len(data))]
        cut = inner[inside[inner] & inside[inner - 1]]
        begins[cut] = True
        stops[cut] = True
    starts, stop_at = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, stop_at, np.searchsorted(starts, ends, "left")


def hash_spans(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes, others differ but for a chance of about 2**-64 a pair."""
    up, down = _power(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:-1], out=total[1:])
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))


_PLACE = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def hash_windows(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of width words inside a text, and the number of windows before each text (one number more than texts).

    A text with fewer words, but not none, has one window: all of them.
    """
    counts = np.diff(bounds)
    n = len(words)
    total = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        total += words[k : k + len(total)] * _PLACE[k]
    total = mix(total)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    before = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(before[-1], np.uint64)
    at = np.arange(before[-1]) - np.repeat(before[:-1], made) + np.repeat(bounds[:-1], made)
    short = np.repeat((counts < width) & (counts > 0), made)
    out[~short] = total[at[~short]]
    for i in np.flatnonzero((counts < width) & (counts > 0)):
        own = words[bounds[i] : bounds[i + 1]]
        out[before[i]] = mix(np.array([(own * _PLACE[: len(own)]).sum(dtype=np.uint64) ^ np.uint64(len(own))], np.uint64))[0]
    return out, before
