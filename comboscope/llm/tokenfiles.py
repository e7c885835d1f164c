"""Token files: one array of ids after the other, document boundaries in Elias-Fano code with select.

A file is a segment of consecutive documents: their ids as little-endian numbers of two bytes (four for
vocabularies above 65,536), the boundaries, the document ids, a JSON footer, the footer's length in four
bytes, and ``MAGIC``. Files lie in one folder; (part, segment) in the footer is their order.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W
from comboscope.llm.packing import _encoder

MAGIC = b"EFTOK1\n"
#: Ids after which a task closes a segment; documents stay whole.
SEGMENT = 4 << 20
#: Set bits between two remembered places.
SAMPLE = 64
_CHUNK = 2 << 20


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words, lowest first, and one word more for reads that cross a border."""
    raw = np.packbits(bits, bitorder="little").tobytes()
    return np.frombuffer(raw + b"\0" * (-len(raw) % 8 + 8), "<u8")


class EliasFano:
    """Ascending numbers in some 2 + log2(range / count) bits each.

    The low bits stand side by side. The high bits are a unary bit string whose i-th set bit is at
    ``high(i) + i``; the place of every 64th one is kept in 32 bits, so ``select`` reads a few words.
    """

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(((int(values[-1]) + 1) // n).bit_length() - 1, 0) if n else 0
        low = np.empty((n, low_bits), np.uint8)
        for k in range(low_bits):
            low[:, k] = (values >> np.uint64(k)) & np.uint64(1)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        high[places] = 1
        return cls(n, low_bits, _words(low.ravel()), _words(high), places[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high), len(self.samples)], "<u8")
        return b"".join(x.tobytes() for x in (head, self.low, self.high, self.samples))

    @classmethod
    def from_bytes(cls, raw: memoryview) -> EliasFano:
        n, low_bits, low, high, samples = (int(x) for x in np.frombuffer(raw[:40], "<u8"))
        at = np.cumsum([40, 8 * low, 8 * high, 4 * samples])
        return cls(n, low_bits, *(np.frombuffer(raw[a:b], t) for a, b, t in zip(at[:-1], at[1:], ("<u8", "<u8", "<u4"), strict=True)))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low_bits
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        above = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return ((self.low[word] >> shift) | above) & np.uint64((1 << self.low_bits) - 1)

    def select(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers, for an array of i from 0."""
        i = np.asarray(i, np.int64)
        place = self.samples[i // SAMPLE].astype(np.int64)
        word = place >> 6
        before = self.high[word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
        left = i % SAMPLE + np.bitwise_count(before)  # set bits to pass, from the word's beginning
        active = np.arange(len(i))
        while len(active):
            ones = np.bitwise_count(self.high[word[active]]).astype(np.int64)
            further = left[active] >= ones
            active, ones = active[further], ones[further]
            left[active] -= ones
            word[active] += 1
        bits, at = self.high[word], np.zeros(len(i), np.int64)
        for half in (32, 16, 8, 4, 2, 1):  # the wanted bit is in the lower or the upper half
            lower = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
            up = left >= lower
            left -= np.where(up, lower, 0)
            at += np.where(up, half, 0)
            bits = np.where(up, bits >> np.uint64(half), bits)
        return ((64 * word + at - i).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i)


def _coded_ids(ids: pa.Array) -> tuple[str, int, bytes]:
    """Ascending whole numbers, nulls first, as differences to the first in Elias-Fano code; other types as an Arrow stream."""
    if pa.types.is_integer(ids.type):
        values = ids.drop_null().cast(pa.int64()).to_numpy()
        base = int(values[0]) if len(values) else 0
        return "numbers", base, EliasFano.of(values.astype(np.uint64) - np.uint64(base % (1 << 64))).to_bytes()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, pa.schema([("doc_id", ids.type)])) as out:
        out.write_batch(pa.RecordBatch.from_arrays([ids], ["doc_id"]))
    return "stream", 0, sink.getvalue().to_pybytes()


class Segment:
    """One file: ``starts``, ``ids`` and ``doc_ids`` of its documents."""

    def __init__(self, raw: bytes):
        view = memoryview(raw)
        end = len(raw) - len(MAGIC) - 4
        if raw[end + 4 :] != MAGIC:
            raise ValueError("not a token file, or cut off")
        size = int.from_bytes(raw[end : end + 4], "little")
        self.footer = json.loads(raw[end - size : end])
        at = np.cumsum([0, *self.footer["sizes"]])
        self.ids = np.frombuffer(view[at[0] : at[1]], f"<u{self.footer['width']}")
        self.ends = EliasFano.from_bytes(view[at[1] : at[2]])
        self._doc_ids = view[at[2] : at[3]]

    def bounds(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the i-th documents begin and end in ``ids``."""
        i = np.asarray(i, np.int64)
        start = np.zeros(len(i), np.int64)
        start[i > 0] = self.ends.select(i[i > 0] - 1).astype(np.int64)
        return start, self.ends.select(i).astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        start, end = self.bounds(np.array([i]))
        return self.ids[start[0] : end[0]]

    def doc_ids(self) -> pa.Array:
        if self.footer["doc_ids"] == "stream":
            return pa.ipc.open_stream(pa.py_buffer(self._doc_ids)).read_all()["doc_id"].combine_chunks()
        coded = EliasFano.from_bytes(self._doc_ids)
        values = (coded.select(np.arange(coded.n)) + np.uint64(self.footer["base"] % (1 << 64))).astype(np.int64)
        return pa.concat_arrays([pa.nulls(self.footer["n_docs"] - coded.n, pa.int64()), pa.array(values)])


def _file(ids: list[np.ndarray], doc_ids: pa.Array, width: int, part: int, segment: int) -> bytes:
    """A segment without the last byte of ``MAGIC``, which the writer adds as the end of the line."""
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    kind, base, coded = _coded_ids(doc_ids)
    parts = [np.concatenate(ids).astype(f"<u{width}").tobytes(), EliasFano.of(np.cumsum(lengths)).to_bytes(), coded]
    footer = json.dumps({"part": part, "segment": segment, "n_docs": len(ids), "n_ids": int(lengths.sum()), "width": width,
                         "doc_ids": kind, "base": base, "sizes": [len(p) for p in parts]}).encode()
    return b"".join([*parts, footer, len(footer).to_bytes(4, "little"), MAGIC[:-1]])


def _segments(vocabulary: str, pattern: str, limit: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, segment = _encoder(vocabulary, pattern), TaskContext.get().partitionId(), 0
        width = 2 if len(encoder.size) <= 1 << 16 else 4
        ids, names, held = [], [], 0

        def closed():
            return pa.RecordBatch.from_arrays([pa.array([_file(ids, pa.concat_arrays(names), width, part, segment)], pa.binary())], ["file"])

        for rows in W.chunks(batches, "text", min(_CHUNK, limit)):
            new = [np.append(x, 0).astype(f"<u{width}") for x in encoder.batch(rows["text"])]
            ids.extend(new), names.append(rows["doc_id"])
            held += sum(map(len, new))
            if held >= limit:
                yield closed()
                ids, names, held, segment = [], [], 0, segment + 1
        if ids:
            yield closed()
    return scan


def write(docs: DataFrame, path: str, vocabulary: str, pattern: str, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> None:
    """Token files of all documents in ascending order of their ids, each document closed by id 0.

    A range sort deals the rows out, so that part and segment give the order of the files. Rows of one
    id follow each other by a hash of their texts, and equal rows may be dealt to several tasks. Null
    ids come first, null text is empty, other columns are ignored, an empty table gives no file. Spark's
    own text writer puts each segment into a file of its own, so lost tasks are repeated and the folder may be in any
    store that Spark writes to. A document is never cut: one above 2 GiB of ids can't be written.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text"), F.rand(11)]
    keyed = rows.select("*", *(c.alias(f"key_{i}") for i, c in enumerate(order[1:])))
    dealt = keyed.repartitionByRange("doc_id", "key_0", "key_1").sortWithinPartitions("doc_id", "key_0", "key_1").select("doc_id", "text")
    files = dealt.mapInArrow(_segments(vocabulary, pattern, segment), "file binary")
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def _documents(with_ids: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for raw in rows["content"]:
                if not raw.as_buffer().size:
                    continue  # a task without rows
                file = Segment(raw.as_py())
                n = file.footer["n_docs"]
                start, end = file.bounds(np.arange(n))
                crc = np.fromiter((zlib.crc32(file.ids[a:b].astype("<u4")) for a, b in zip(start, end, strict=True)), np.int64, n)
                same = lambda k: pa.array(np.full(n, file.footer[k], np.int32))  # noqa: E731, B023
                columns = [file.doc_ids(), same("part"), same("segment"), pa.array(start), pa.array(end - start), pa.array(crc)]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(start, end[-1:]).astype(np.int32)), pa.array(file.ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "segment", "first", "n_tokens", "ids_crc32", "ids"][: len(columns)])
    return scan


def read(spark: SparkSession, path: str, doc_id: str = "bigint", with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32, and with ``with_ids`` its ids.

    ``start`` counts the ids of all documents before it: those in earlier files, from the totals of the files (a
    window a part, then one row a part), and those before it in its file, by select. ``doc_id`` names
    the type of the ids that were written.
    """
    whole = doc_id in ("bigint", "int", "smallint", "tinyint")
    schema = f"doc_id {'bigint' if whole else doc_id}, part int, segment int, first long, n_tokens long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    docs = written(files.mapInArrow(_documents(with_ids), schema), "token-documents")
    sizes = docs.groupBy("part", "segment").agg(F.sum("n_tokens").alias("n"))
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    before = lambda n, w: F.coalesce(F.sum(n).over(earlier(w)), F.lit(0))
    in_part = sizes.select("part", "segment", before("n", Window.partitionBy("part").orderBy("segment")).alias("inner"))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", before("n", Window.orderBy("part")).alias("outer"))
    bases = in_part.join(parts, "part").select("part", "segment", (F.col("inner") + F.col("outer")).alias("base"))
    found = docs.join(bases, ["part", "segment"])
    return found.select(F.col("doc_id").cast(doc_id).alias("doc_id"), (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids_crc32",
                        *(["ids"] if with_ids else []))
