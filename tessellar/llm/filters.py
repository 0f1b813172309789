"""A Bloom filter of fixed size over 64-bit ids, to leave rows out before a shuffle. It never loses an
id; however many ids there are, it takes ``BITS / 8`` bytes, and where it fills up it merely lets more rows pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.common import U, mix64

BITS = 1 << 25
SLICES = 8


def places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(ids.astype(np.int64).view(U) * U(0x9E3779B97F4A7C15) + U(7))
    return (h & U(BITS - 1)).astype(np.int64), (h >> U(39)).astype(np.int64)


def id_filter(df: DataFrame, *cols: str, key=None, fan: int = 64):
    """A broadcast of the bits for the ids in a column, or for what ``key`` makes of several."""

    def fill(batches):
        bits = np.zeros(BITS >> 3, np.uint8)
        for b in batches:
            for p in places(b.column(0).to_numpy() if key is None else key(*(c.to_numpy() for c in b.columns))):
                np.bitwise_or.at(bits, p >> 3, np.uint8(1) << (p & 7).astype(np.uint8))
        if bits.any():
            n = len(bits) // SLICES
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(np.random.default_rng().integers(0, fan, SLICES), pa.int32()), pa.array([bits[i * n : (i + 1) * n].tobytes() for i in range(SLICES)], pa.binary())], ["slice", "part", "payload"])

    def join(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            for x in b.column("payload"):
                v = np.frombuffer(x.as_buffer(), np.uint8)
                total = v.copy() if total is None else np.bitwise_or(total, v, out=total)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "part", "payload"])

    schema = "slice int, part int, payload binary"
    parts = df.select(*[F.col(c).cast("long") for c in cols]).mapInArrow(fill, schema)
    both = parts.groupBy("slice", "part").applyInArrow(join, schema).groupBy("slice").applyInArrow(join, schema)
    got = {r["slice"]: bytes(r["payload"]) for r in both.collect()}
    empty = bytes((BITS >> 3) // SLICES)
    return df.sparkSession.sparkContext.broadcast(b"".join(got.get(i, empty) for i in range(SLICES)))


def maybe(bits: bytes, ids: np.ndarray) -> np.ndarray:
    """Whether each id may be among those of the filter."""
    b = np.frombuffer(bits, np.uint8)
    out = np.ones(len(ids), bool)
    for p in places(ids):
        out &= (b[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return out
