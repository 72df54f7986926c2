"""Helpers shared by the operators: staged tables in the shared folder, salted
joins for hot keys, and vectorised words, hashes and shingles over Arrow text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.session import shared_dir

#: Bytes of text that one vectorised step works on.
STEP_BYTES = 512 << 10


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that every executor and the driver can read and write."""
    return shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    freezes what it holds, and outlives lost executors. Spark deletes the shuffle
    files of finished steps once the driver's JVM has collected their plans; an idle
    driver seldom does, so it is asked to."""
    path = scratch(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(counts: DataFrame, key: str, n: str, total: int, share: int = 1000) -> DataFrame:
    """Keys with at least one in ``share`` of all ``total`` rows: by that
    definition at most ``share`` of them, so they may be broadcast."""
    return counts.filter(F.col(n) * share >= F.lit(max(total, 1))).select(key)


def look_up(rows: DataFrame, table: DataFrame, keys: list[str], n: str, total: int, how: str = "inner", share: int = 1000) -> DataFrame:
    """``rows`` joined with ``table`` (one row a key, ``n`` rows of ``rows`` have
    it, ``total`` rows in all; ``how``: inner or left_semi). Keys with at least one
    in ``share`` of the rows are at most ``share``: these are broadcast, so that no
    task gets all rows of a hot key; the others are joined by shuffling."""
    hot = F.col(n) * share >= F.lit(max(total, 1))
    heavy, light = F.broadcast(table.filter(hot).drop(n)), table.filter(~hot).drop(n)
    rest = rows.join(F.broadcast(table.filter(hot).select(*keys)), keys, "left_anti")
    return rows.join(heavy, keys, how).unionByName(rest.join(light, keys, how))


# ------------------------------------------------------------------ text batches

def text_slices(batch: pa.RecordBatch, column: str | int = "text", step: int = STEP_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """Cut a batch at row ends into slices of about ``step`` bytes of text;
    yields (first row, end row, texts with null as empty). A longer text makes
    a slice of its own."""
    texts = pc.fill_null(batch.column(column), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo, n = 0, len(texts)
    while lo < n:
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + step, side="right")))
        yield lo, hi, texts.slice(lo, hi - lo)
        lo = hi


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the row offsets into them."""
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    kind = np.int64 if wide else np.int32
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0]:offsets[-1]], offsets - offsets[0]


_RNG = np.random.Generator(np.random.PCG64(20240611))
#: A random 64-bit value for each byte, capital letters as small ones.
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CASED = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(_RNG.integers(1, 2**62)) * 8 + 5
_BASE_INV = pow(_BASE, -1, 2**64)
_POSITION = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, STEP_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain constants): every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(texts: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words ``[^\\x20\\x09-\\x0D]+`` with A-Z as a-z (unless
    not ``fold``), and for each text the offset of its first word (one more offset at the end)."""
    body, offsets = raw_bytes(texts)
    n = len(body)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACE[body]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(~space & (np.concatenate(([True], space[:-1])) | edge[:-1]))
    ends = np.flatnonzero(~space & (np.concatenate((space[1:], [True])) | edge[1:])) + 1
    up, down = _powers(n + 1)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum((_BYTE if fold else _CASED)[body] * up[:n], dtype=np.uint64, out=total[1:])
    words = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _POSITION[63]
    return mix(words), np.searchsorted(starts, offsets).astype(np.int64)


def shingle_hashes(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles of each text (repeats included), and
    their offsets. A text of fewer words has one shingle, its whole sequence;
    a text without words has none."""
    n = np.diff(offsets)
    counts = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    out = np.zeros(len(n) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    if len(words) == 0:
        return np.zeros(0, np.uint64), out
    padded = np.concatenate((words, np.zeros(k, np.uint64)))
    rolled = np.zeros(len(words), np.uint64)
    for i in range(k):
        rolled += padded[i:i + len(words)] * _POSITION[i]
    first = np.repeat(offsets[:-1] - out[:-1], counts) + np.arange(out[-1])
    got = rolled[first]
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        value = np.full(len(short), 1, np.uint64) * _POSITION[40 + k % 8]
        for i in range(k - 1):
            inside = n[short] > i
            value[inside] += words[offsets[short[inside]] + i] * _POSITION[20 + i]
        got[out[short]] = value + n[short].astype(np.uint64) * _POSITION[62]
    return mix(got), out


def lower_words(text: str | None) -> list[bytes]:
    """Words of one text as lower-cased (A-Z only) UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int) -> set:
    """The distinct ``k``-word shingles themselves; fewer words make one."""
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(k))))


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)],
                                      schema=schema)
