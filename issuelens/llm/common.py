"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from issuelens.session import ensure_checkpoint_dir

#: Rows and bytes that one Arrow batch may hold on its way to a Python task.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``sf_dir``, read whole, with small Arrow batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds; long texts make 10,000-row batches too large."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; extra columns, whatever their names, never reach an operator."""
    return df.select(*[df[n] for n in names])


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` parts at exactly these six bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash a word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_pairs(words: list[bytes]) -> np.ndarray:
    """128 bits a word, as pairs of uint64: words that are alike in one half differ in the other."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), ">u8").reshape(-1, 2).astype(np.uint64)


_POWERS: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
ODD = 0x9E3779B97F4A7C15
ODD2 = 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**0..n and its inverse's powers, modulo 2**64 (base is odd)."""
    size = 1 << max(10, (n + 1).bit_length())
    if (base, size) not in _POWERS:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[base, size] = out[0], out[1]
    up, down = _POWERS[base, size]
    return up[: n + 1], down[: n + 1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits (murmur's finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rolling(hashes: np.ndarray, n: int, base: int = ODD) -> np.ndarray:
    """Rolling hash of every n consecutive values: prefix sums of h[i] * base**i, shifted back by base**-i."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    up, down = _powers(base, len(hashes))
    s = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=s[1:])
    return mix((s[n:] - s[:-n]) * down[: len(s) - n])


def covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Boolean per position: inside a run of n positions that begins at one of ``starts``."""
    d = np.zeros(size + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + n, -1)
    return np.cumsum(d[:-1]) > 0


def rows_by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of a stream of batches that is sorted by ``key``; one group is in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = b.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            if held and last != k[i]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = k[i]
    if held:
        yield pa.Table.from_batches(held)


#: Folders that the innermost :func:`scratch` has to delete; None outside of one.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that :func:`staged` writes inside the block, once it ends; for use when its results are written."""
    folders: list[str] = []
    held = _FOLDERS.set(folders)
    try:
        yield
    finally:
        _FOLDERS.reset(held)
        for folder in folders:
            p = spark._jvm.org.apache.hadoop.fs.Path(folder)
            p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def staged(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder (zstd), in folders by the columns ``by``, and read back.

    Later steps, and tasks run again after a lost executor, read the files.
    Shuffle files of the write are let go when it ends.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/staged/{uuid.uuid4().hex}"
    folders = _FOLDERS.get()
    if folders is not None:
        folders.append(path)
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pack_ints(values: np.ndarray) -> bytes:
    """int64 values as a base and offsets of as few bytes (1, 2, 4 or 8) as they need."""
    base = int(values.min()) if len(values) else 0
    span = int(values.max()) - base if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if span < 1 << 8 * w)
    offsets = values.astype(np.uint64) - np.uint64(base % (1 << 64))
    return struct.pack("<Bq", width, base) + offsets.astype(f"<u{width}").tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    width, base = struct.unpack_from("<Bq", data)
    offsets = np.frombuffer(data, f"<u{width}", offset=9).astype(np.uint64)
    return (offsets + np.uint64(base % (1 << 64))).astype(np.int64)
