"""What the operators share: tables cut from their lineage, and words and shingles of byte batches.

Words are runs of bytes outside ``\\x20\\x09-\\x0D``; a null text counts as empty. Batches are
handled as one flat byte array with offsets, so no Python code runs per row or per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.tables import shared_dir

#: Spark's switch to drop a query's shuffle files when it has ended, rather than when the driver collects its garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 18

U = np.uint64
with np.errstate(over="ignore"):
    _BASE = U(0x9E3779B97F4A7C15) | U(1)
    _INV = U(pow(int(_BASE), -1, 1 << 64))


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, and a lost
    executor costs nothing that was written."""
    spark = df.sparkSession
    path = shared_dir(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame, size: str = "8m") -> DataFrame:
    """Arrow batches of few bytes for the session, so that long texts don't add up in a task."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return df


def sheltered(df: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """All columns under names that clash with nothing, and copies of the needed ones under their own."""
    names = [f"_kept{i}" for i in range(len(df.columns))]
    return df.toDF(*names).select(*names, *(F.col(names[df.columns.index(c)]).alias(c) for c in needed)), names


def text_hash(col="text"):
    """Tells apart rows that share an id: used beside the id as a row's key."""
    return F.xxhash64(F.col(col))


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser; changes ``h`` in place."""
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_BYTE = mix64(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_VISIBLE = np.ones(256, bool)
_VISIBLE[[9, 10, 11, 12, 13, 32]] = False
_POWERS = [np.ones(1, U), np.ones(1, U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers 0..n-1 and their inverses modulo 2**64."""
    if len(_POWERS[0]) < n:
        m = 1 << int(n - 1).bit_length()
        for i, b in enumerate((_BASE, _INV)):
            p = np.full(m, b, U)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row begins and ends in them."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None and len(texts) else np.empty(0, np.uint8)
    return data, off - off[0] if len(texts) else np.zeros(1, np.int64)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows a..b of a batch with their bytes, ``limit`` bytes at a time (more only for one long row)."""
    data, off = flat(texts)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word; the first word of each row, and the count of words at the end."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    seen = _VISIBLE[data]
    edge = off[(off > 0) & (off < len(data))]
    begin = seen.copy()
    begin[1:] &= ~seen[:-1]
    begin[edge] |= seen[edge]
    end = seen.copy()
    end[:-1] &= ~seen[1:]
    end[edge - 1] |= seen[edge - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def prefix(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span of bytes."""
    p = np.zeros(len(data) + 1, U)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers(len(data) or 1)[0][: len(data)], out=p[1:])
    return p


def span_hash(p: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
    inv = powers(len(p))[1]
    return mix64((p[ends] - p[starts]) * inv[starts] + (ends - starts).astype(U) * U(0xA0761D6478BD642F))


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, and the first word of each row (the count of words at the end)."""
    s, e, first = words(data, off)
    return span_hash(prefix(data, lower), s, e), first


def shingles(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles in order, and the first shingle of each row. A row of fewer
    words has its whole sequence as its one shingle; a row without words has none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    if not begin[-1]:
        return np.empty(0, U), begin
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    room = np.repeat(first[1:], count) - at
    g = np.zeros(len(at), U)
    for j in range(k):
        g *= U(0xC2B2AE3D27D4EB4F)
        if room.min() > j:
            g += h[at + j] + U(j + 1)
        else:
            inside = room > j
            g[inside] += h[at[inside] + j] + U(j + 1)
            g[~inside] += U(0x165667B19E3779F9)
    return mix64(g), begin


def fresh(seen: set, keys: np.ndarray, limit: int = 1 << 20) -> np.ndarray:
    """Which keys this task hasn't met; it forgets now and then, and what it repeats does no harm."""
    out = np.zeros(len(keys), bool)
    for i, x in enumerate(keys.tolist()):
        if x not in seen:
            seen.add(x)
            out[i] = True
    if len(seen) > limit:
        seen.clear()
    return out


def sum_slices(parts: DataFrame, dtype: str, fan: int = 64) -> DataFrame:
    """Add up rows (slice int, part int, payload binary) of equal-length vectors by slice, in two
    steps so that no task sees more than a share of the parts."""

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in batch.column("payload"):
                v = np.frombuffer(x.as_buffer(), dtype)
                total = v.copy() if total is None else np.add(total, v, out=total)
        yield pa.RecordBatch.from_pydict({"slice": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([0], pa.int32()), "payload": pa.array([total.tobytes()], pa.binary())})

    schema = "slice int, part int, payload binary"
    once = parts.withColumn("part", F.pmod("part", F.lit(fan))).groupBy("slice", "part").applyInArrow(add, schema)
    return once.groupBy("slice").applyInArrow(add, schema)
