"""Words of whole texts as flat arrays, so that tasks work on batches instead of single rows.

A word is a run of bytes other than space and \\x09-\\x0D. Null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that a task turns into arrays at a time; a longer single text is a chunk of its own.
CHUNK = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batches cut by the size of their texts; rows stay whole and in order.

    Parts are copied, as some Arrow kernels misread arrays that begin inside another one's buffers.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.take(pa.array(np.arange(at, end)))
            at = end


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts in order, and where each text's words begin (one more entry than texts)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    real = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return flat.filter(real), kept[ends]


def hashes(words: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word."""
    coded = words.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Each 64-bit value spread over all bits."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any runs of consecutive words in O(1) each."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        powers = np.ones(n + 1, np.uint64)
        powers[1:] = _BASE
        self.inverse = np.ones(n + 1, np.uint64)
        self.inverse[1:] = _INVERSE
        np.multiply.accumulate(powers, out=powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * powers[:n], out=self.sums[1:])

    def runs(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """Hash of words[start:end] for each pair; equal runs at other places hash alike."""
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start], salt)


def gram_starts(offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every run of k words inside one text, and the number of runs of each text."""
    counts = np.maximum(np.diff(offsets) - k + 1, 0)
    return ragged(offsets[:-1], counts), counts


def ragged(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (counts[0] of them), first[1], ..."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(first, np.int64) - (ends - counts), counts)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)
