"""Near-duplicate documents by the Jaccard similarity of word shingles, joined with signature trees."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W
from comboscope.operators.clusters import components

#: Texts that meet in one task; larger groups are cut into blocks that meet in pairs.
BLOCK = 4096
#: Bytes of text in a meeting that are turned into sets at a time.
MEETING_CHUNK = 1 << 20
#: Bits of a signature, and children of a tree node.
BITS, FANOUT = 4096, 8
#: Bits of a set's sketch, and sets of a part that are compared with every other at once.
SKETCH, FEW = 1024, 32
#: Set sizes up to this factor apart share their number of parts.
CLASS = 1.5
#: Chance at most that large sets just similar enough are not brought together.
MISS = 1e-9


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in order, and where each text's begin."""
    flat, offsets = W.split(pc.ascii_lower(pc.fill_null(texts, "").cast(pa.large_string())))
    rolling, size = W.Rolling(W.hashes(flat)), np.diff(offsets)
    starts, counts = W.gram_starts(offsets, k)
    short = (size > 0) & (size < k)
    # a short text is one shingle: the whole of it
    starts = np.concatenate([starts, offsets[:-1][short]])
    lengths = np.concatenate([np.full(int(counts.sum()), k), size[short]])
    owner = np.concatenate([np.repeat(np.arange(len(size)), counts), np.nonzero(short)[0]])
    h = W.mixed(rolling.runs(starts, starts + lengths) ^ lengths.astype(np.uint64), 5)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[fresh], owner[fresh]
    return h, np.searchsorted(owner, np.arange(len(size) + 1))


def _summed(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _names(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    return W.mixed(_summed(W.mixed(h, 11), at), 1), W.mixed(_summed(W.mixed(h, 12), at), 2)


def _sketches(h: np.ndarray, at: np.ndarray) -> pa.Array:
    """Parities of the numbers of shingles by hash: two sets differ in at least as many shingles as their sketches do in bits."""
    owner, bit = np.repeat(np.arange(len(at) - 1), np.diff(at)), W.mixed(h, 31) % np.uint64(SKETCH)
    words = np.zeros((len(at) - 1) * (SKETCH // 64), np.uint64)
    np.bitwise_xor.at(words, owner * (SKETCH // 64) + (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    ends = np.arange(len(at), dtype=np.int32) * (SKETCH // 8)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(ends), pa.py_buffer(words)])


def _sets(k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in W.chunks(batches, "text"):
            h, at = shingle_sets(rows["text"], k)
            one, two = _names(h, at)
            yield pa.RecordBatch.from_arrays([rows["doc_id"], pa.array(np.diff(at)), pa.array(W.signed(one)), pa.array(W.signed(two)), _sketches(h, at)],
                                             ["doc_id", "n_shingles", "one", "two", "sketch"])
    return scan


def _class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(np.maximum(n, 1)) / np.log(CLASS) + 1e-9).astype(np.int64)


def _enough(differ: float) -> float:
    """Parts of which sets that differ in so many shingles agree in one, but for a chance below ``MISS``."""
    for k in range(2, int(differ) + 1):
        if k * np.log1p(-((1 - 1 / k) ** differ)) <= np.log(MISS):
            return k
    return np.inf


def _shape(c: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Parts of size class ``c``, and how many of them may be empty.

    Sets that link differ in at most (1 - t) / (1 + t) * (|a| + |b|) shingles. With one part more, and as many
    as may be empty, they agree in a part that is not. Shingles fall into parts by hash, so where they are
    many, fewer and larger parts do as well.
    """
    kinds, at = np.unique(c, return_inverse=True)
    differ = np.floor(2 * np.ceil(CLASS ** (kinds + 1.0)) * (100 - percent) / (100 + percent) + 1e-9)
    empty = 1 + np.ceil(2 * differ * np.exp(-(CLASS ** kinds.astype(float)) / (differ + 1)))
    fewer = np.array([_enough(d) for d in differ])
    sure = fewer >= differ + 1 + empty
    count = np.where(sure, differ + 1 + empty, fewer)
    return count.astype(np.int64)[at], np.where(sure, empty, count).astype(np.int64)[at]


def _parts(k: int, percent: int):
    """Hashes of the parts that sets are cut into; a linked pair has one in common.

    The larger set's size class says how both are cut, so a set that can link into the next class is cut that
    way, too. A set with more empty parts than foreseen also gives the least of its shingles, of which
    two linked sets share one.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in W.chunks(batches, "text"):
            h, at = shingle_sets(rows["text"], k)
            n = np.diff(at)
            name, _ = _names(h, at)
            owner = np.repeat(np.arange(len(n)), n)
            own, keys, names, sparse = _class(n), [], [], np.zeros(len(n), bool)
            for c, use in ((own, n > 0), (own + 1, (n > 0) & (_class(n * 100 / percent) > own))):
                count, empty = _shape(c, percent)
                count = np.where(use, count, 0)
                first = np.concatenate([[0], np.cumsum(count)])
                mine = use[owner]
                slot = first[owner[mine]] + (W.mixed(h[mine], 21) % count[owner[mine]].astype(np.uint64)).astype(np.int64)
                sums = np.zeros(first[-1], np.uint64)
                np.add.at(sums, slot, W.mixed(h[mine], 22))
                full = np.bincount(slot, minlength=first[-1]) > 0
                who = np.repeat(np.arange(len(n)), count)
                label = W.mixed(((c[who] << 40) + np.arange(len(who)) - first[who]).astype(np.uint64), 23)
                keys.append(W.mixed(sums ^ label, 24)[full])
                names.append(name[who[full]])
                sparse |= use & (np.bincount(who[~full], minlength=len(n)) > empty)
            prefix = np.where(sparse, n - -(-n * percent // 100) + 1, 0)
            keys.append(W.mixed(h[W.ragged(at[:-1], prefix)], 26))
            names.append(np.repeat(name, prefix))
            yield pa.RecordBatch.from_arrays([pa.array(W.signed(np.concatenate(keys))), pa.array(W.signed(np.concatenate(names)))], ["part", "one"])
    return scan


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct rows (part, one), which come sorted, of the parts that several sets have."""
    part, one, joined = np.zeros(0, np.int64), np.zeros(0, np.int64), False
    for rows in itertools.chain(batches, [None]):
        if rows is not None:
            part, one = np.concatenate([part, rows["part"].to_numpy()]), np.concatenate([one, rows["one"].to_numpy()])
            fresh = np.ones(len(part), bool)
            fresh[1:] = (part[1:] != part[:-1]) | (one[1:] != one[:-1])
            part, one = part[fresh], one[fresh]
        if len(part):
            after = np.concatenate([[joined], part[1:] == part[:-1]])  # the row before has the same part
            keep, end = after.copy(), len(part) - (rows is not None)
            keep[:-1] |= after[1:]
            yield pa.RecordBatch.from_arrays([pa.array(part[:end][keep[:end]]), pa.array(one[:end][keep[:end]])], ["part", "one"])
            part, one, joined = part[-1:], one[-1:], bool(after[-1])


def _alike(percent: int, n: np.ndarray, sketch: np.ndarray, others: np.ndarray, sketches: np.ndarray) -> np.ndarray:
    """Whether sizes and sketches allow the similarity."""
    differ = np.bitwise_count(sketch ^ sketches).sum(-1, dtype=np.int64)
    return (100 * np.minimum(n, others) >= percent * np.maximum(n, others)) & ((100 + percent) * differ <= (100 - percent) * (n + others))


def _meetings(percent: int):
    """Edges (a, b) that connect, within each part, all sets whose sketches allow the similarity."""
    def edges(part: np.ndarray, one: np.ndarray, n: np.ndarray, sketch: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        _, first, size = np.unique(part, return_index=True, return_counts=True)
        i, off = np.nonzero((part[1:] == part[:-1]) & (np.repeat(size, size)[1:] <= FEW))[0], 1
        while len(i):  # each set and the one ``off`` places on
            fine = i[_alike(percent, n[i], sketch[i], n[i + off], sketch[i + off])]
            yield one[fine], one[fine + off]
            off += 1
            i = i[i + off < len(part)]
            i = i[part[i] == part[i + off]]
        for start, many in zip(first[size > FEW], size[size > FEW], strict=True):
            todo = np.arange(start, start + many)
            sizes, sketches = n[todo], sketch[todo]
            stack: list[int] = []
            while len(todo):
                if not stack:
                    stack, todo, sizes, sketches = [int(todo[0])], todo[1:], sizes[1:], sketches[1:]
                x = stack.pop()
                fine = _alike(percent, n[x], sketch[x], sizes, sketches)
                if fine.any():
                    yield np.full(int(fine.sum()), one[x]), one[todo[fine]]
                    stack += todo[fine].tolist()
                    todo, sizes, sketches = todo[~fine], sizes[~fine], sketches[~fine]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3 + [np.zeros((0, SKETCH // 64), np.uint64)]
        for rows in itertools.chain(batches, [None]):
            if rows is not None:
                sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(-1, SKETCH // 64)
                rest = [np.concatenate(x) for x in zip(rest, [*(rows[c].to_numpy() for c in ("part", "one", "n_shingles")), sketch], strict=True)]
            end = 0 if not len(rest[0]) else len(rest[0]) if rows is None else int(np.searchsorted(rest[0], rest[0][-1]))
            if end:
                found = list(edges(*(x[:end] for x in rest)))
                rest = [x[end:] for x in rest]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found, strict=True)], ["a", "b"])
    return scan


class SignatureTree:
    """Sets in leaves; nodes hold OR-combined and AND-combined bitmaps of their sets and the range of sizes."""

    def __init__(self, h: np.ndarray, at: np.ndarray, chosen: np.ndarray):
        n = np.diff(at)
        bits = np.zeros((len(chosen), BITS // 64), np.uint64)
        for row, i in enumerate(chosen):
            bit = h[at[i] : at[i + 1]] % np.uint64(BITS)
            np.bitwise_or.at(bits[row], (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
        # alike sets stand side by side: in order of size class, then of their least shingle
        least = np.array([h[at[i]] for i in chosen], np.uint64)
        order = np.lexsort((n[chosen], least))
        self.sets = chosen[order]
        size = n[self.sets]
        self.levels = [(bits[order], bits[order], size, size)]
        while len(self.levels[-1][2]) > 1:
            joined, common, low, high = self.levels[-1]
            cut = np.arange(0, len(low), FANOUT)
            self.levels.append((np.bitwise_or.reduceat(joined, cut), np.bitwise_and.reduceat(common, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))


def _possible(a: SignatureTree, b: SignatureTree, level: tuple[int, int], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets under node pairs can reach the similarity: each bit that all sets of a node have and no set of the other has costs one shingle."""
    or_a, and_a, low_a, high_a = (x[i] for x in a.levels[level[0]])
    or_b, and_b, low_b, high_b = (x[j] for x in b.levels[level[1]])
    only_a = np.bitwise_count(and_a & ~or_b).sum(1).astype(np.int64)
    only_b = np.bitwise_count(and_b & ~or_a).sum(1).astype(np.int64)
    most = np.minimum(np.minimum(high_a - only_a, high_b - only_b), np.minimum(high_a, high_b))
    least_union = np.maximum(np.maximum(low_a + only_b, low_b + only_a), np.maximum(low_a, low_b))
    return 100 * most >= percent * least_union


def _pairs(a: SignatureTree, b: SignatureTree, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of sets that a traversal of both trees at once leaves; within one tree, each pair once."""
    same = a is b
    stack = [(len(a.levels) - 1, len(b.levels) - 1, np.array([0]), np.array([0]))]
    while stack:
        la, lb, i, j = stack.pop()
        fine = _possible(a, b, (la, lb), i, j, percent)
        i, j = i[fine], j[fine]
        if not len(i):
            continue
        if la == lb == 0:
            keep = i < j if same else slice(None)
            yield from zip(a.sets[i[keep]].tolist(), b.sets[j[keep]].tolist(), strict=True)
            continue
        if la:
            below = len(a.levels[la - 1][2])
            i, j = (np.repeat(i * FANOUT, FANOUT) + np.tile(np.arange(FANOUT), len(i))), np.repeat(j, FANOUT)
            i, j = i[i < below], j[i < below]
        if lb:
            below = len(b.levels[lb - 1][2])
            i, j = np.repeat(i, FANOUT), (np.repeat(j * FANOUT, FANOUT) + np.tile(np.arange(FANOUT), len(j)))
            i, j = i[j < below], j[j < below]
        la, lb = max(la - 1, 0), max(lb - 1, 0)
        if same and la == lb:
            i, j = i[i <= j], j[i <= j]
        for k in range(0, len(i), 8192):
            stack.append((la, lb, i[k : k + 8192], j[k : k + 8192]))


def _sets_of(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets``, some texts at a time: of a meeting only the sets are held whole."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    part = (size - 1) // MEETING_CHUNK
    cuts = [0, *(np.nonzero(np.diff(part))[0] + 1).tolist(), len(texts)]
    found = [shingle_sets(texts.slice(a, b - a).take(pa.array(np.arange(b - a))) if len(cuts) > 2 else texts, k) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    before = np.cumsum([0, *(len(h) for h, _ in found)])
    return np.concatenate([h for h, _ in found]), np.concatenate([*(at[:-1] + n for (_, at), n in zip(found, before, strict=False)), before[-1:]])


def _linked(k: int, percent: int):
    def links(rows: pa.RecordBatch, own: int, other: int) -> list[tuple[int, int]]:
        h, at = _sets_of(rows["text"], k)
        n = np.diff(at)
        block = rows["block"].to_numpy()
        a = SignatureTree(h, at, np.nonzero((block == own) & (n > 0))[0])
        b = a if own == other else SignatureTree(h, at, np.nonzero((block == other) & (n > 0))[0])
        ids = rows["doc_id"].to_numpy()
        root, edges = list(range(len(n))), []
        if not len(a.sets) or not len(b.sets):
            return []
        for i, j in _pairs(a, b, percent):
            x, y = i, j
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            while root[y] != y:
                root[y] = root[root[y]]
                y = root[y]
            if x == y:  # connected already
                continue
            both = len(np.intersect1d(h[at[i] : at[i + 1]], h[at[j] : at[j + 1]], assume_unique=True))
            if 100 * both >= percent * (n[i] + n[j] - both):
                root[max(x, y)] = min(x, y)
                edges.append((int(ids[i]), int(ids[j])))
        return edges

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        # 64-bit offsets, or else texts of more than 2 GiB stay in several batches
        at = rows.schema.get_field_index("text")
        rows = rows.set_column(at, "text", rows["text"].cast(pa.large_string()))
        edges = links(rows.combine_chunks().to_batches()[0], key[-2].as_py(), key[-1].as_py())
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return meet


def near_documents(docs: DataFrame, k: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id. Rows link when 100 * common >= percent * all distinct shingles of both.

    Equal sets are one set, named by its smallest id. Sets are cut into so many parts by hash that a linked pair
    must agree in one. Of the sets of a part, those whose sketches allow the similarity are connected, and what is
    connected forms a candidate group; sets that share no more than a common line stay apart.
    Within a group, the sets' signature trees are traversed against each other, node pairs that cannot
    reach the similarity are dropped, and what is left is verified on the sets themselves unless
    it is connected already. Groups of many sets are cut by size and then into blocks that meet in pairs; no
    pairs leave a task, only edges that connect what it found.

    Texts of fewer than ``k`` words are one shingle; null and empty texts have none and link with nothing. Rows
    with null ids return with their size, unlinked; rows of one id are linked through it. Other columns are
    ignored; an empty table gives an empty result.
    """
    if not 100 <= percent * CLASS < 100 * CLASS:
        raise ValueError(f"percent must be from {100 / CLASS:.0f} to 99")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = written(rows.mapInArrow(_sets(k), "doc_id long, n_shingles long, one long, two long, sketch binary"), "sets")
    usable = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    named = usable.groupBy("one", "two", "n_shingles").agg(F.min("doc_id").alias("rep"))
    parts = rows.mapInArrow(_parts(k, percent), "part long, one long")
    shared = written(parts.repartition("part").sortWithinPartitions("part", "one").mapInArrow(_shared, "part long, one long"), "shared-parts")
    sketches = sets.where("n_shingles > 0").dropDuplicates(["one"]).select("one", "n_shingles", "sketch")
    # both sides grow with the table, so neither is to be broadcast because it happens to be small
    meeting = shared.join(sketches.hint("merge"), "one").repartition("part").sortWithinPartitions("part", "one")
    met = meeting.select("part", "one", "n_shingles", "sketch").mapInArrow(_meetings(percent), "a long, b long").distinct()
    met = written(met, "met-sets")
    nodes = met.select(F.col("a").alias("id")).union(met.select(F.col("b").alias("id"))).distinct()
    groups = components(nodes, met).select(F.col("id").alias("one"), F.col("component").alias("group"))
    members = named.join(groups, "one").select("rep", "group", "n_shingles")
    sizes = members.groupBy("group").agg(F.count("*").alias("n")).where("n > 1")
    # groups of more than a block are cut by size first: linked sets are of one or of neighbouring classes
    own = F.floor(F.log("n_shingles") / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    members = members.join(sizes, "group").withColumn("class", F.explode(F.when(F.col("n") > BLOCK, F.array(own, own + 1)).otherwise(F.array(F.lit(0)))))
    members = written(members.select("rep", "group", "class"), "members")
    blocks = members.groupBy("group", "class").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = members.join(blocks, ["group", "class"]).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    parted = (rows.join(members.hint("merge"), rows.doc_id == members.rep).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("group", "class", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "doc_id", "text"))
    edges = parted.groupBy("group", "class", "lo", "hi").applyInArrow(_linked(k, percent), "a long, b long").distinct()
    same = usable.join(named, ["one", "two", "n_shingles"]).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    found = components(sets.where("doc_id is not null").select(F.col("doc_id").alias("id")).distinct(), written(edges.union(same), "near-edges"))
    return sets.join(found, sets.doc_id == found.id, "left").select(sets.doc_id, "n_shingles", F.col("component").alias("component_id"))
