"""Packing of tokenised documents into sequences: length patterns fitted to the histogram by non-negative least squares."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W

#: Documents in a fitted pattern, at most. The rest is packed by best fit, with no limit.
PATTERN_SIZE = 3
#: Share of a sequence that a fitted pattern must fill.
FILLED = 0.998
#: Lengths tried as the least one of three; all pairs are tried.
LEAST_LENGTHS = 24
#: Steps of the least-squares fit.
STEPS = 150
#: Documents that must be encoded as they are: runs of white space, or strings that may be special tokens.
_DIRECT = r"[\s\x0b][\s\x0b]|^[\s\x0b]|[\s\x0b]$|<\|"
_CHUNK = 2 << 20


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of a byte-level BPE vocabulary file; special strings in texts become their ids."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte = _byte_symbols()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.library = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.size = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def one(self, text: str) -> np.ndarray:
        return self.library.encode_to_numpy(text, allowed_special="all")

    def _apart(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of texts whose parts between single spaces can be encoded apart: each distinct part once."""
        lists = pc.split_pattern(texts, " ")
        parts, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        later = np.ones(len(parts), bool)
        later[offsets[:-1]] = False
        space = pa.scalar(" ", pa.large_string())
        units = pc.binary_join_element_wise(space, parts.filter(pa.array(later)), pa.scalar("", pa.large_string())).dictionary_encode()
        cuts = np.zeros(len(units.dictionary) + 1, np.int64)
        ids = np.zeros(0, np.uint32)
        if len(units.dictionary):
            ends = np.cumsum(pc.binary_length(units.dictionary).to_numpy(zero_copy_only=False).astype(np.int64))
            ids = self.library.encode_to_numpy(units.dictionary.buffers()[2].to_pybytes()[: ends[-1]].decode(), disallowed_special=())
            cuts[1:] = np.searchsorted(np.cumsum(self.size[ids]), ends) + 1
        unit = units.indices.to_numpy()
        n = np.diff(cuts)[unit]
        flat, at = ids[W.ragged(cuts[unit], n)], np.concatenate([[0], np.cumsum(n)])[offsets - np.arange(len(offsets))]
        first = parts.take(pa.array(offsets[:-1])).to_pylist()
        return [np.concatenate([self.one(lead), flat[a:b]]) for lead, a, b in zip(first, at[:-1], at[1:], strict=True)]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; null is empty."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        direct = pc.or_(pc.match_substring_regex(texts, _DIRECT), pc.equal(texts, ""))
        apart = np.nonzero(~direct.to_numpy(zero_copy_only=False))[0]
        out = [self.one(t) if d else None for t, d in zip(texts.to_pylist(), direct.to_pylist(), strict=True)]
        for i, ids in zip(apart, self._apart(texts.take(pa.array(apart))) if len(apart) else [], strict=True):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def _pieces(path: str, pattern: str, limit: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(path, pattern), TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        for rows in W.chunks(batches, "text", _CHUNK):
            row, piece, start, length, crc, place = [], [], [], [], [], []
            for i, ids in enumerate(encoder.batch(rows["text"])):
                raw, total = np.append(ids, 0).astype("<u4").tobytes(), len(ids) + 1
                cuts = [0, *range(total % limit or limit, total, limit), total]
                for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    row.append(i), piece.append(k), start.append(a), length.append(b - a)
                    crc.append(zlib.crc32(raw[4 * a : 4 * b]))
                    place.append(seen[b - a])
                    seen[b - a] += 1
            n = len(row)
            yield pa.RecordBatch.from_arrays([
                rows["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()), pa.array(np.full(n, part, np.int32)), pa.array(place, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"])
    return scan


def _patterns(limit: int, hist: np.ndarray) -> np.ndarray:
    """Rows of up to three lengths, ascending, 0 for none, that fill a sequence exactly or as well as one more document can."""
    lengths = np.nonzero(hist)[0]
    below = np.zeros(limit + 1, np.int64)  # the longest length present, up to each size
    below[lengths] = lengths
    below = np.maximum.accumulate(below)
    pairs = np.stack([lengths, below[limit - lengths]], 1)
    pairs = np.stack([np.zeros(len(pairs), np.int64), pairs.min(1), pairs.max(1)], 1)
    small = lengths[lengths <= limit // 3]
    small = small[np.argsort(-hist[small], kind="stable")[:LEAST_LENGTHS]]
    a, b = np.meshgrid(small, lengths[lengths <= limit // 2], indexing="ij")
    a, b = a.ravel(), b.ravel()
    c = below[limit - a - b]
    keep = (a <= b) & (c >= b)
    return np.concatenate([np.unique(pairs, axis=0), np.stack([a, b, c], 1)[keep]])


def _fitted(hist: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and whole repeat counts that stay within the histogram: projected gradient steps on ||Ax - h||^2, rounded down."""
    rows = _patterns(limit, hist)
    used = rows > 0
    full = rows.sum(1) / limit
    tight = full >= FILLED
    rows, used, full = rows[tight], used[tight], full[tight]
    if not len(rows):
        return []
    h = hist.astype(float)
    weight = 1 / np.maximum(h, 1) ** 0.5  # errors count against the length's own number
    degree = np.zeros(limit + 1)
    for k in range(PATTERN_SIZE):
        np.add.at(degree, rows[:, k][used[:, k]], 1)
    x, step = np.zeros(len(rows)), 1 / (PATTERN_SIZE * max(degree.max(), 1) * (weight[hist > 0] ** 2).max())
    momentum, t = x.copy(), 1.0
    for _ in range(STEPS):
        made = np.zeros(limit + 1)
        for k in range(PATTERN_SIZE):
            made += np.bincount(rows[:, k], momentum * used[:, k], limit + 1)
        error = (made - h) * weight**2
        error[0] = 0
        gradient = sum(error[rows[:, k]] * used[:, k] for k in range(PATTERN_SIZE))
        x, before = np.maximum(momentum - step * gradient, 0), x
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        momentum = x + (last - 1) / t * (x - before)
    left, out = hist.copy(), []
    for i in np.argsort(-x * full, kind="stable"):
        if x[i] < 0.5:
            continue
        lengths = [int(v) for v in rows[i] if v]
        need = {v: lengths.count(v) for v in lengths}
        n = min(int(np.ceil(x[i])), *(int(left[v]) // c for v, c in need.items()))
        if n > 0:
            out.append((tuple(lengths), n))
            for v, c in need.items():
                left[v] -= n * c
    return out


def _best_fit(hist: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, for all equal documents at once: groups of equal sequences by their free space."""
    free: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    spaces = np.zeros(limit + 1, bool)
    for length in range(limit, 0, -1):
        todo = int(hist[length])
        while todo:
            fits = np.nonzero(spaces[length:])[0]
            if len(fits):
                space = length + int(fits[0])
                pattern, n = free[space].pop()
                spaces[space] = bool(free[space])
            else:
                space, pattern, n = limit, (), todo
            # the sequence just filled fits best until it is full, so documents of one length stand side by side
            each = min(space // length, todo)
            used = min(n, todo // each)
            if used < n and pattern:
                free.setdefault(space, []).append((pattern, n - used))
                spaces[space] = True
            todo -= used * each
            rest = space - each * length
            free.setdefault(rest, []).append((pattern + (length,) * each, used))
            spaces[rest] = True
    return [x for groups in free.values() for x in groups]


def pattern_plan(hist: np.ndarray, limit: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that use each length exactly as often as ``hist`` has it.

    Work and result depend on ``limit`` alone, not on the number of documents.
    """
    left, plan = hist.astype(np.int64).copy(), []
    full = int(left[limit])
    if full:
        plan.append(((limit,), full))
        left[limit] = 0
    fitted = _fitted(left, limit) if left.any() else []
    for lengths, n in fitted:
        for v in lengths:
            left[v] -= n
    return plan + fitted + _best_fit(left, limit)


def _slots(plan: list[tuple[tuple[int, ...], int]]) -> tuple[np.ndarray, ...]:
    """Sorted by length and first rank: ranks of a length from there on go to consecutive sequences, at one offset."""
    cursor: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for v in lengths:
            rows.append(((v << 48) + cursor.get(v, 0), sequence, offset))
            cursor[v] = cursor.get(v, 0) + n
            offset += v
        sequence += n
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(3))


def _placed(slots: tuple[np.ndarray, ...], columns: list[str]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, sequence, offset = slots
        for rows in batches:
            key = (rows["length"].to_numpy().astype(np.int64) << 48) + rows["rank"].to_numpy()
            at = np.searchsorted(first, key, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(rows[c] for c in columns), pa.array(sequence[at] + key - first[at]), pa.array(offset[at])], [*columns, "sequence_id", "offset"])
    return scan


def pack(docs: DataFrame, vocabulary: str, pattern: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and a closing id 0 (null text: only that); documents over ``limit`` ids are cut
    into pieces of ``limit``, the first one shorter. Tasks number the pieces of each length they make;
    with the written counts of earlier tasks that gives every piece its rank among equal lengths. The
    histogram of at most ``limit`` lengths is all the driver sees: patterns of few documents are fitted
    to it, what they leave is packed by best fit, and ranks map to places by a table whose size
    depends on ``limit`` alone. Null and repeated ids are documents like any other; other columns are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    pieces = written(rows.mapInArrow(_pieces(vocabulary, pattern, limit), schema + ", part int, place long"), "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    hist = np.zeros(limit + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():
        hist[length] = n
    slots = _slots(pattern_plan(hist, limit))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["part", "length"]).select(*columns, (F.col("base") + F.col("place")).alias("rank"))
    return ranked.mapInArrow(_placed(slots, columns), schema + ", sequence_id long, offset long")
