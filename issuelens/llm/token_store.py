"""Token-id output (5): blocks of concatenated ids with Elias-Fano encoded document ends.

A store is a Parquet table with one row a block: ``part`` and ``block`` order
the blocks, ``n_docs`` and ``n_ids`` are its sizes and ``payload`` is the block
in the format below (little-endian).  Spark's writer commits it, so a lost
executor leaves no half-written block.

payload: ``TKEF``, u8 version, u8 bytes an id, u16 zero, u64 n_docs, u64 n_ids,
u64 n_null; then the documents' ends and their doc_ids less the first one, each as
Elias-Fano sequences; i64 first doc_id; then the ids.  The first n_null documents have no doc_id.
Elias-Fano sequence: u64 n, u64 universe, u8 low bits, u64 bytes of low bits,
u64 bytes of high bits, u32 samples; low bits packed, high bits in unary, and
the place of every 64th one bit as u32.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession, Window

from issuelens.llm.common import pick, small_batches
from issuelens.llm.tokens import WordEncoder, default_path, opened
from issuelens.session import cut_lineage

SAMPLE = 64
#: Documents whose ends are selected at a time when a block is read whole.
SLICE = 4096
#: Number of one bits of a byte, and the place of its k-th one bit.
_ONES = np.array([x.bit_count() for x in range(256)], np.int64)
_NTH = np.array([([k for k in range(8) if x >> k & 1] + [0] * 8)[:8] for x in range(256)], np.int64)
_HEAD = struct.Struct("<QQBQQI")
_BLOCK = struct.Struct("<4sBBHQQQ")


class EliasFano:
    """A non-decreasing sequence in about 2 + log2(universe / n) bits a value."""

    def __init__(self, n: int, universe: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low_bits, self.low, self.high, self.samples = n, universe, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        universe = min(int(values[-1]) + 1, (1 << 64) - 1) if n else 0
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        low = (values[:, None] >> np.arange(low_bits, dtype=np.uint64) & np.uint64(1)).astype(np.uint8).ravel()
        return cls(n, universe, low_bits, np.packbits(low, bitorder="little"), np.packbits(high, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        bit = i * self.low_bits
        raw = int.from_bytes(self.low[bit >> 3 : (bit + self.low_bits + 7) >> 3].tobytes(), "little")
        return raw >> (bit & 7) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: jump to the sampled one bit before it, then count bits byte by byte."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return place - i << self.low_bits | self._low(i)

    def select_many(self, at: np.ndarray) -> np.ndarray:
        """The values at several places (int64): all jump to their sampled bits and go on byte by byte together."""
        at = np.asarray(at, np.int64)
        if not len(at):
            return np.empty(0, np.int64)
        if at.min() < 0 or at.max() >= self.n:
            raise IndexError(int(at.max()))
        place, left = self.samples[at // SAMPLE].astype(np.int64), at % SAMPLE
        byte = place >> 3
        word = self.high[byte] & (0xFF << (place & 7)).astype(np.uint8)
        going = np.arange(len(at))
        while len(going):
            ones = _ONES[word[going]]
            more = ones <= left[going]
            going = going[more]
            left[going] -= ones[more]
            byte[going] += 1
            word[going] = self.high[byte[going]]
        return (byte * 8 + _NTH[word, left] - at) << self.low_bits | self._lows(at)

    def _lows(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), np.int64)
        low, bit = np.concatenate([self.low, np.zeros(9, np.uint8)]), at * self.low_bits
        first, shift = bit >> 3, (bit & 7).astype(np.uint64)
        raw = np.zeros(len(at), np.uint64)
        for k in range(8):
            raw |= low[first + k].astype(np.uint64) << np.uint64(8 * k)
        raw >>= shift
        if self.low_bits > 57:  # bits of a ninth byte
            over = low[first + 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1)))
            raw |= np.where(shift > 0, over, np.uint64(0))
        return (raw & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def all(self) -> np.ndarray:
        """Every value (int64), for callers that want a table."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)) << self.low_bits
        if self.low_bits:
            low = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            out |= low.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))
        return out

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.universe, self.low_bits, len(self.low), len(self.high), len(self.samples))
        return head + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def read(cls, data: bytes, at: int) -> tuple[EliasFano, int]:
        n, universe, low_bits, a, b, c = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        low, high = np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a)
        samples = np.frombuffer(data, "<u4", c, at + a + b)
        return cls(n, universe, low_bits, low, high, samples), at + a + b + 4 * c


def encode_block(doc_ids: list[int | None], sizes: list[int], ids: bytes, width: int) -> bytes:
    """A payload; doc_ids ascend with nulls first."""
    n_null = sum(x is None for x in doc_ids)
    known = np.array(doc_ids[n_null:], np.int64)
    first = int(known[0]) if len(known) else 0
    ends = np.cumsum(np.array(sizes, np.int64))
    gaps = (known.astype(object) - first).astype(np.uint64) if len(known) and int(known[-1]) - first >= 1 << 63 else (known - first).astype(np.uint64)
    head = _BLOCK.pack(b"TKEF", 1, width, 0, len(sizes), int(ends[-1]) if len(ends) else 0, n_null)
    return head + EliasFano.of(ends).to_bytes() + EliasFano.of(gaps).to_bytes() + struct.pack("<q", first) + ids


class Block:
    """A payload read back."""

    def __init__(self, data: bytes):
        magic, version, width, _, self.n_docs, self.n_ids, self.n_null = _BLOCK.unpack_from(data)
        if (magic, version) != (b"TKEF", 1):
            raise ValueError("not a block of token ids")
        self.ends, at = EliasFano.read(data, _BLOCK.size)
        self._gaps, at = EliasFano.read(data, at)
        self.first = struct.unpack_from("<q", data, at)[0]
        self.ids = np.frombuffer(data, f"<u{width}", self.n_ids, at + 8)

    def doc_ids(self, at: range) -> list[int | None]:
        """Ids of the documents at consecutive places."""
        known = self._gaps.select_many(np.arange(max(at.start, self.n_null), at.stop) - self.n_null)
        return [None] * (len(at) - len(known)) + [self.first + x % (1 << 64) for x in known.tolist()]

    def ranges(self, at: range) -> tuple[np.ndarray, np.ndarray]:
        """First id and end of the documents at consecutive places, by selects."""
        ends = self.ends.select_many(np.arange(max(at.start - 1, 0), at.stop))
        return (ends[:-1], ends[1:]) if at.start else (np.concatenate([[0], ends[:-1]]).astype(np.int64), ends)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the block, by two selects."""
        return self.ids[self.ends.select(i - 1) if i else 0 : self.ends.select(i)]


def write_store(docs: DataFrame, path: str | None = None, end_id: int = 1, block_ids: int = 1 << 20) -> DataFrame:
    """Write every document's ids, ascending by doc_id (nulls first), and return the store's rows.

    Texts are dealt by ranges of doc_id; the row's number is a second key, so a
    doc_id that repeats without end still spreads over many tasks.  A block is
    closed once it holds ``block_ids`` ids.  A null text is empty: its document
    is the end id alone.  Extra columns are ignored.
    """
    path = path or default_path("word_bpe_49k.json")
    schema = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        part, block, docs_, sizes, held, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def row():
            data = encode_block(docs_, sizes, b"".join(held), coder.dtype.itemsize)
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (part, block, len(docs_), total)] + [pa.array([data], pa.binary())], schema=schema)

        for b in batches:
            coder = opened(WordEncoder, path)
            end = np.array([end_id], coder.dtype).tobytes()
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                ids = coder.ids(text) + end
                docs_.append(doc)
                held.append(ids)
                sizes.append(len(ids) // coder.dtype.itemsize)
                total += sizes[-1]
                if total >= block_ids:
                    yield row()
                    block, docs_, sizes, held, total = block + 1, [], [], [], 0
        if docs_:
            yield row()

    small_batches(docs.sparkSession)
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    keys = (F.col("doc_id").asc_nulls_first(), F.col("row").asc())
    d = d.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    return cut_lineage(d.mapInArrow(run, "part long, block long, n_docs long, n_ids long, payload binary"))


def read_store(store: DataFrame) -> DataFrame:
    """Per document of a store: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A block's first id follows from the sizes of the blocks before it: summed
    within a part, then over the parts (one row a part).
    """
    sizes = store.select("part", "block", "n_ids")
    within = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    first = sizes.select("part", "block", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inner")).join(parts, "part")
    schema = pa.schema([(c, pa.int64()) for c in ("part", "block", "doc_id", "at", "n_tokens", "ids_crc32")])

    def run(batches):
        for b in batches:
            for part, no, data in zip(*(b.column(c).to_pylist() for c in ("part", "block", "payload")), strict=True):
                block = Block(data)
                for i in range(0, block.n_docs, SLICE):
                    at = range(i, min(i + SLICE, block.n_docs))
                    starts, ends = block.ranges(at)
                    crcs = [zlib.crc32(block.ids[x:y].astype("<u4")) for x, y in zip(starts.tolist(), ends.tolist(), strict=True)]
                    n = len(at)
                    cols = [[part] * n, [no] * n, block.doc_ids(at), starts, ends - starts, crcs]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], schema=schema)

    rows = store.select("part", "block", "payload").mapInArrow(run, "part long, block long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(first, ["part", "block"]).select("doc_id", (F.col("before") + F.col("inner") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a store kept at ``path`` (any file system that Spark reads)."""
    return spark.read.parquet(path)
