"""Benchmark passages in training text: rare n-gram seeds, then local alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from comboscope.llm import words as W

#: Words of a seed, and of a seed of items below FEW words, where edits of 30 % can hit every longer one; an item of fewer words is one seed.
SEED, SHORT, FEW = 3, 2, 21
#: A sequence is common above so many places in the documents, and above one in so many words.
COMMON, RATE = 100, 100_000
#: Share of an item's sequences, its rarest, that are seeds at any count.
ALWAYS = 0.25
#: Test items, and bytes of them, looked for at once; more of either take further passes over the documents.
ITEMS, ITEM_BYTES = 20_000, 4 << 20
#: Costs of an edited and of a missing or added word against one for an equal word.
MISMATCH, GAP = 0.5, 0.5


def _plain(texts: pa.Array) -> pa.Array:
    """Lower case, with all but letters, marks and digits taken as white space."""
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "").cast(pa.large_string())), r"[^\pL\pM\pN]+", " ")


class Lookup:
    """Known n-gram hashes, found in many texts at once through a table of hash bits."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        self.keys, self.lengths = np.unique(hashes), sorted({int(n) for n in lengths})
        self.bits = np.uint64(64 - max(12, int(np.ceil(np.log2(64 * max(len(self.keys), 1))))))
        self.table = np.zeros(1 << (64 - int(self.bits)), bool)
        self.table[(self.keys >> self.bits).astype(np.int64)] = True

    def find(self, h: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length: (key, start) of the n-grams of the texts that are known."""
        rolling = W.Rolling(h)
        for n in self.lengths:
            starts, _ = W.gram_starts(offsets, n)
            grams = rolling.runs(starts, starts + n, n)
            maybe = np.nonzero(self.table[(grams >> self.bits).astype(np.int64)])[0]
            at = np.minimum(np.searchsorted(self.keys, grams[maybe]), len(self.keys) - 1)
            real = self.keys[at] == grams[maybe]
            yield at[real], starts[maybe[real]]


class Grams:
    """The word sequences of some items that may seed: their hash, item, place and length."""

    def __init__(self, items: list[tuple[str, str]]):
        flat, offsets = W.split(_plain(pa.array([t for _, t in items], pa.large_string())))
        h = W.hashes(flat)
        self.words = [h[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        self.rolling, self.offsets = W.Rolling(h), offsets
        size = np.diff(offsets)
        each, parts = np.minimum(size, np.where(size < FEW, SHORT, SEED)), []
        for n in range(1, SEED + 1):
            starts, counts = W.gram_starts(offsets, n)
            who = np.repeat(np.arange(len(size)), counts)
            use = each[who] == n
            parts.append((self.rolling.runs(starts[use], starts[use] + n, n), who[use], starts[use], np.full(int(use.sum()), n)))
        self.hash, self.owner, self.start, self.length = (np.concatenate(x) for x in zip(*parts, strict=True))

    def lookup(self) -> Lookup:
        return Lookup(self.hash, self.length)


class Seeds(Lookup):
    """Rare sequences of items. A common one counts only together with the equally long one after it, or where its item has few rarer ones."""

    def __init__(self, grams: Grams, counts: np.ndarray, limit: int):
        """``counts``: places of each sequence in the documents, right for those above ``limit``."""
        self.words = grams.words
        self.known = [np.unique(w, return_counts=True) for w in self.words]
        often = np.maximum(counts - limit, 0)
        order = np.lexsort((grams.start, often, grams.owner))
        first = np.searchsorted(grams.owner[order], np.arange(len(self.words)))
        total = np.bincount(grams.owner, minlength=len(self.words))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - np.repeat(first, total)
        alone = (often == 0) | (rank < np.ceil(ALWAYS * total)[grams.owner])
        # two common sequences in a row are one seed of twice the length
        twice = ~alone & (grams.start + 2 * grams.length <= grams.offsets[grams.owner + 1])
        long = 2 * grams.length[twice]
        pairs = np.zeros(len(long), np.uint64)
        for n in np.unique(long):
            at = grams.start[twice][long == n]
            pairs[long == n] = grams.rolling.runs(at, at + n, int(n))
        h = np.concatenate([grams.hash[alone], pairs])
        owner, start = (np.concatenate([x[alone], x[twice]]) for x in (grams.owner, grams.start))
        super().__init__(h, np.concatenate([grams.length[alone], long]))
        order = np.argsort(h, kind="stable")
        self.owner, self.place = owner[order], (start - grams.offsets[owner])[order]
        self.first = np.append(np.searchsorted(h[order], self.keys), len(h))

    def hits(self, h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, item, begin) of every seed that a text has, once each; an unedited copy of the item would begin there."""
        out = [np.zeros((0, 3), np.int64)]
        for key, begin in self.find(h, offsets):
            per = self.first[key + 1] - self.first[key]
            at, start = W.ragged(self.first[key], per), np.repeat(begin, per)
            text = np.searchsorted(offsets, start, side="right") - 1
            out.append(np.stack([text, self.owner[at], start - offsets[text] - self.place[at]], 1))
        return tuple(np.unique(np.concatenate(out).astype(np.int64), axis=0).T)


def windows(begins: np.ndarray, size: int, slack: int) -> Iterator[tuple[int, int]]:
    """The stretches of text that alignments of ``size`` words through seeds at ``begins`` can reach; those that meet are one."""
    cuts = np.nonzero(np.diff(begins) > size + 2 * slack)[0] + 1
    for part in np.split(begins, cuts):
        yield max(0, int(part[0]) - slack), int(part[-1]) + size + slack


def reachable(item: np.ndarray, known: tuple[np.ndarray, np.ndarray], text: np.ndarray, wanted: float, slack: int) -> bool:
    """Whether an alignment can reach the score: by the item's words (``known``, with their counts) in a stretch that one can span, then by the score alone."""
    names, counts = known
    at = np.minimum(np.searchsorted(names, text), len(names) - 1)
    places, need = np.nonzero(names[at] == text)[0], max(1, int(np.ceil(wanted)))
    if len(places) < need or np.minimum(np.bincount(at[places], minlength=len(names)), counts).sum() < need:
        return False
    if not (places[need - 1 :] - places[: len(places) - need + 1] < len(item) + slack).any():
        return False
    above, slope, rest = np.zeros(len(text) + 1), GAP * np.arange(len(text) + 1), len(item)
    for same in np.where(item[:, None] == text, 1.0, -MISMATCH):
        score = np.maximum(above - GAP, 0)
        np.maximum(score[1:], above[:-1] + same, out=score[1:])
        above = np.maximum.accumulate(score + slope) - slope
        top, rest = above.max(), rest - 1
        if top >= wanted:
            return True
        if top + rest < wanted:
            return False
    return False


def align(item: np.ndarray, text: np.ndarray) -> tuple[float, int, int]:
    """Smith-Waterman: the best local score, and where in ``text`` its alignment begins and ends."""
    n = len(text)
    above, start_above = np.zeros(n + 1), np.arange(n + 1)
    slope, best = GAP * np.arange(n + 1), (0.0, 0, 0)
    for word in item:
        same = np.where(text == word, 1.0, -MISMATCH)
        score, start = np.zeros(n + 1), np.arange(n + 1)
        score[1:], start[1:] = above[:-1] + same, start_above[:-1]
        down = above - GAP
        start = np.where(down > score, start_above, start)
        score = np.maximum(score, down)
        start = np.where(score <= 0, np.arange(n + 1), start)
        score = np.maximum(score, 0)
        along = np.maximum.accumulate(score + slope)
        from_where = np.maximum.accumulate(np.where(score + slope >= along, np.arange(n + 1), 0))
        score, start = along - slope, start[from_where]
        top = int(np.argmax(score))
        if score[top] > best[0]:
            best = (float(score[top]), int(start[top]), top)
        above, start_above = score, start
    return best


def _counted(lookup):
    """Places of each known sequence in a task's texts, and under -1 the words."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = lookup.value, 0
        n = np.zeros(len(known.keys), np.int64)
        for rows in W.chunks(batches, "text"):
            flat, offsets = W.split(_plain(rows["text"]))
            total += len(flat)
            for key, _ in known.find(W.hashes(flat), offsets):
                np.add.at(n, key, 1)
        some = np.nonzero(n)[0]
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(n[some], total))], ["key", "n"])
    return scan


def _aligned(seeds, ids: list, least: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = seeds.value
        for rows in W.chunks(batches, "text"):
            flat, offsets = W.split(_plain(rows["text"]))
            h, out = W.hashes(flat), []
            text, who, begins = found.hits(h, offsets)
            cuts = np.nonzero(np.diff(text) | np.diff(who))[0] + 1
            for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
                if a == b:
                    continue
                r, item = int(text[a]), found.words[who[a]]
                words, wanted = h[offsets[r] : offsets[r + 1]], least * len(item)
                slack = int((1 - least) * len(item) / GAP) + 1  # more added words cost more than the item can score
                best = (0.0, 0, 0)
                for low, high in windows(begins[a:b], len(item), slack):
                    if reachable(item, found.known[who[a]], words[low:high], wanted, slack):
                        score, first, end = align(item, words[low:high])
                        if score > best[0]:
                            best = (score, low + first, low + end)
                if best[0] >= wanted and best[0] > 0:
                    out.append((r, ids[who[a]], best[0] / len(item), best[1], best[2]))
            if out:
                row, item, score, a, b = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([rows["doc_id"].take(pa.array(row)), rows["row"].take(pa.array(row)), pa.array(item), pa.array(score, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                                                 ["doc_id", "text_hash", "item_id", "score", "first_word", "end_word"])
    return scan


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5,
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document and test item found in it: doc_id, text_hash (xxhash64 of the text), item_id, score, first_word, end_word.

    Words are compared without case and punctuation. Three-word sequences of an item (two words for items of fewer
    than ``FEW``) seed candidates. One pass counts them in the documents: those above ``COMMON`` places and one in
    ``RATE`` words are common and count only with another one right after them, but the rarest ``ALWAYS`` of an
    item's always count. The text that alignments through an item's seeds can reach is aligned with
    the whole item unless it has too few of the item's words, and the best score over the item's length must reach
    ``least``. Copies that keep no seed are not found. Items come in blocks of ``ITEMS`` and ``ITEM_BYTES``, each of which
    takes two passes over the documents; only counts of common sequences, bounded by the block, are shuffled.

    Texts of any length are searched whole; among equally good alignments of an item in a text the first is reported.
    Null and empty texts or items match nothing, nor do items with null ids; null document ids are reported as
    such; equal rows are reported each. Other columns are ignored; empty tables give an empty result.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.xxhash64(F.col(text)).alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null and text is not null")
    item_kind = items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, item_id {item_kind}, score double, first_word long, end_word long"
    n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // ITEMS), -(-size // ITEM_BYTES))
    out = spark.createDataFrame([], schema)
    for b in range(blocks):
        block = [tuple(r) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()]
        if not block:
            continue
        grams = Grams(block)
        if not len(grams.hash):
            continue
        lookup = grams.lookup()
        known = spark.sparkContext.broadcast(lookup)
        often = rows.select("text").mapInArrow(_counted(known), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        often = dict(often.where(F.expr(f"key < 0 or n > {COMMON}")).collect())
        counts = np.zeros(len(lookup.keys), np.int64)
        limit = max(COMMON, often.pop(-1, 0) // RATE)
        for key, times in often.items():
            counts[key] = times
        found = Seeds(grams, counts[np.searchsorted(lookup.keys, grams.hash)], limit)
        seeds = spark.sparkContext.broadcast(found)
        aligned = rows.mapInArrow(_aligned(seeds, [i for i, _ in block], least), schema)
        out = out.unionByName(aligned)
    return out
