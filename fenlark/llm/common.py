"""What the training-data operators share: scratch tables, Arrow chunks, 64-bit hashing."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a local one only where that setting is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        root = _LOCAL.setdefault(app, tempfile.mkdtemp(prefix="fenlark-"))
    return f"{root.rstrip('/')}/fenlark-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: it cuts the lineage and outlives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def smallest(rows: DataFrame, n: int, *key: str) -> DataFrame:
    """The n rows whose key has the smallest hash, ties by the key itself. Rows are counted, and a cut by
    the hash alone leaves a few times n for the sort, so that tasks don't send n rows each."""
    total, h = rows.count(), F.xxhash64(*key)
    if total > 2 * n:
        rows = rows.where(h < int(-(1 << 63) + (1 << 64) * min(0.75, 1.5 * (n + 50) / total)))
    return rows.orderBy(h, *key).limit(n)


def dropped(spark: SparkSession, *frames: DataFrame) -> None:
    """Deletes scratch tables made by written() that nothing will read again."""
    jvm = spark.sparkContext._jvm
    for df in frames:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/fenlark-" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def chunks(batches, column: str, limit: int = 2 << 20):
    """Slices of Arrow batches with at most `limit` bytes of text each, or one row."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < n:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            base, start = int(ends[stop - 1]), stop


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, on a copy."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for key, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, U)
            steps[0] = 1
            _POWERS[key] = np.cumprod(steps, dtype=U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with s[i] the polynomial hash of data[:i]; span_hash reads spans off it.

    It is linear in the bytes, so that spans of equal hash are easily built: it may choose places and
    gather candidates, but never decide what is equal.
    """
    out = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(len(data))[0], out=out[1:], dtype=U)
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    down = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


MARKS = np.array([not (48 <= i <= 57 or 97 <= i <= 122 or i >= 128) for i in range(256)])
_LONG = 32  # bytes up to which words are hashed side by side, eight bytes a step
_TAIL = np.array([(1 << 8 * i) - 1 for i in range(9)], U)
_SALT = 0x9E3779B97F4A7C15


def hashed_spans(buffer: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes start:end. Every step is mixed, so that no arithmetic of the bytes
    survives in a hash: spans of up to eight bytes and equal length never collide. Longer ones do by chance,
    or where somebody solves for it. Those over _LONG bytes go through xxh3."""
    size = end - start
    eight = np.ndarray((len(buffer) + 1,), "<u8", buffer + bytes(8), 0, (1,))
    out = mix(size.astype(U) * U(0xD6E8FEB86659FD93) + U(_SALT))
    rows = np.flatnonzero(size <= _LONG) if len(size) and size.max() > _LONG else np.arange(len(size))
    for at in range(0, _LONG, 8):
        rows = rows[size[rows] > at]
        if not len(rows):
            break
        x = eight[start[rows] + at] & _TAIL[np.minimum(size[rows] - at, 8)]
        out[rows] = mix(out[rows] ^ x)
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(buffer[start[i] : end[i]], _SALT)
    return out


def words(texts: list[bytes], breaks: np.ndarray = _SPACE, heads: int = 0) -> tuple[np.ndarray, ...]:
    """Hashes of all words, and where each text's words begin (one more entry at the end).
    With heads, hashes of the words' first so many bytes as well.

    A-Z is lower-cased; words are runs of bytes outside `breaks`: by default, space and \\x09-\\x0D.
    """
    joined = b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(joined, np.uint8)
    space = breaks[data]
    start = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    end = np.flatnonzero(space & np.concatenate(([False], ~space[:-1])))
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    found, bounds = hashed_spans(joined, start, end), np.searchsorted(start, offsets)
    if heads:
        return found, bounds, hashed_spans(joined, start, np.minimum(start + heads, end))
    return found, bounds
