"""Removal of passages that an earlier document already has: seed and extend on winnowed anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from comboscope.llm import words as W

#: Words of an anchor. Any ``length`` words hold ``length - ANCHOR + 1`` anchors, of which one is chosen.
ANCHOR = 10


def _chosen(h: np.ndarray, width: int) -> np.ndarray:
    """For each place, the leftmost least entry among the ``width`` from there on."""
    n = len(h) - width + 1
    at, span = np.arange(len(h), dtype=np.int64), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(h[left] <= h[right], left, right)
        span += step
    return at[:n]


def _seeds(h: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor: text, anchor hash, first window (from the text's start), windows, hash of all they span."""
    rolling, k = W.Rolling(h), min(ANCHOR, length)
    grams = rolling.runs(np.arange(len(h) - k + 1), np.arange(k, len(h) + 1)) if len(h) >= k else np.zeros(0, np.uint64)
    starts, counts = W.gram_starts(offsets, length)
    if not len(starts):
        return None
    anchor = _chosen(grams, length - k + 1)[starts]
    text = np.repeat(np.arange(len(counts)), counts)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.nonzero(fresh)[0]
    n = np.diff(np.append(first, len(starts)))
    begin, anchor, text = starts[first], anchor[first], text[first]
    place = W.mixed(((anchor - begin) * 4096 + n).astype(np.uint64), 1)
    return (text, grams[anchor], begin - offsets[text], n, rolling.runs(begin, begin + n + length - 1, 2) ^ place)


KEY = ["rank", "row"]


def _anchors(length: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            flat, offsets = W.split(part["text"])
            seeds = _seeds(W.hashes(flat), offsets, length)
            if seeds is not None:
                text, anchor, first, n, span = seeds
                yield pa.RecordBatch.from_arrays([
                    *(part[c].take(pa.array(text)) for c in KEY), pa.array(W.signed(anchor)), pa.array(W.signed(span)),
                    pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))], [*KEY, "anchor", "span", "first", "n"])
    return scan


def _extended(length: int):
    """Hashes of every window of the given runs; anchor and window hash together name a window."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            flat, offsets = W.split(part["text"])
            rolling = W.Rolling(W.hashes(flat))
            runs, per_text = part["runs"].flatten(), np.diff(part["runs"].offsets.to_numpy())
            first, n = runs.field("first").to_numpy(), runs.field("n").to_numpy().astype(np.int64)
            begin = W.ragged(np.repeat(offsets[:-1], per_text) + first, n)
            row = np.repeat(np.arange(len(n)), n)
            text = np.repeat(np.arange(len(per_text)), per_text)[row]
            yield pa.RecordBatch.from_arrays([
                *(part[c].take(pa.array(text)) for c in KEY), runs.field("anchor").take(pa.array(row)),
                pa.array(W.signed(rolling.runs(begin, begin + length, 3))), pa.array((begin - offsets[text]).astype(np.int32))],
                [*KEY, "anchor", "window", "first"])
    return scan


def _cleaned(length: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in W.chunks(batches, "text"):
            flat, offsets = W.split(part["text"])
            runs, per_text = part["runs"].flatten(), np.diff(part["runs"].offsets.to_numpy())
            begin = np.repeat(offsets[:-1], per_text) + runs.field("first").to_numpy()
            delta = np.zeros(len(flat) + 1, np.int64)
            np.add.at(delta, begin, 1)
            np.add.at(delta, begin + runs.field("n").to_numpy() + length - 1, -1)
            keep = np.cumsum(delta)[:-1] == 0
            kept, at = flat.filter(pa.array(keep)).to_pylist(), np.concatenate([[0], np.cumsum(keep)])[offsets]
            texts = [" ".join(kept[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            total = np.diff(offsets)
            yield pa.RecordBatch.from_arrays([
                part["doc_id"], pa.array(total), pa.array(total - np.diff(at)), pa.array(texts, pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"])
    return scan


def _kinds(rows: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)


def repeated_runs(rows: DataFrame, length: int = 50) -> DataFrame:
    """(rank, row, first, n): runs of ``n`` windows of ``length`` words, from word ``first``, that a smaller rank also has.

    ``rows`` has ``rank`` (the order of documents), ``row`` (tells rows of one rank apart), ``doc_id`` and ``text``.
    Winnowing picks one anchor for each window from the window's words alone, so equal windows have
    equal anchors at equal places. Anchors of one rank only are dropped after a partial aggregate.
    Runs that agree in everything they span need no further look: all but those of the least rank
    repeat. One run of each distinct span is then extended window by window against the other spans
    of its anchor. No pairs of documents are made.
    """
    seeds = rows.select(*KEY, "text").mapInArrow(_anchors(length), _kinds(rows, KEY) + ", anchor long, span long, first int, n int")
    shared = (seeds.groupBy("anchor").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"), (F.min("span") != F.max("span")).alias("varied"))
              .where("lo < hi").select("anchor", "varied"))
    runs = seeds.join(shared, "anchor")
    runs = runs.join(runs.groupBy("anchor", "span").agg(F.min("rank").alias("least")), ["anchor", "span"])
    plain = runs.where(F.col("rank") > F.col("least")).select(*KEY, "first", "n")
    undecided = (runs.where(F.col("varied") & (F.col("rank") == F.col("least")))
                 .groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "first", "n")).alias("runs")))
    windows = (rows.join(undecided, KEY).select(*KEY, "doc_id", "text", "runs")
               .mapInArrow(_extended(length), _kinds(rows, KEY) + ", anchor long, window long, first int"))
    earliest = windows.groupBy("anchor", "window").agg(F.min("rank").alias("least"), F.max("rank").alias("last")).where("least < last")
    single = (windows.join(earliest, ["anchor", "window"]).where(F.col("rank") > F.col("least"))
              .select(*KEY, "first", F.lit(1).alias("n")))
    return plain.unionByName(single)


def remove_repeats(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_text, kept_sha256, without words that an earlier document's windows cover.

    A window is ``length`` consecutive words; its words go when they also start in a document with a smaller
    id. Windows are judged on the input. Null and empty texts have no words; rows with null ids count as
    later than all others; rows of one id don't remove each other's words, and every row returns.
    Other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    whole = dict(rows.dtypes)["doc_id"] in ("bigint", "int")
    rank = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)) if whole else F.struct(F.col("doc_id").isNull(), "doc_id")
    rows = rows.select(rank.alias("rank"), F.xxhash64("text").alias("row"), "doc_id", "text")
    found = repeated_runs(rows, length).groupBy(*KEY).agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    none = F.array().cast("array<struct<first:int,n:int>>")
    texts = rows.join(found, KEY, "left").select("doc_id", "text", F.coalesce("runs", none).alias("runs"))
    return texts.mapInArrow(_cleaned(length), _kinds(rows, ["doc_id"]) + ", n_words long, n_removed long, kept_text string, kept_sha256 string")
