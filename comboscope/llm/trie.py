"""Prefix trie of conversations by van Emde Boas recursion: cut at half depth, name the cut prefixes, graft totals upward."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W

#: Turns whose prefixes one row names; longer conversations are cut into such parts first.
PART = 512
#: Characters of joined ids in one row on their way to the digest of a node.
PIECE = 1 << 16

_LANES = (1, 2)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Name of a run from the names of its halves, in both lanes."""
    return np.stack([W.mixed(W.mixed(left[k], 2 * k) * np.uint64(3) + right[k], 2 * k + 1) for k in (0, 1)])


def prefix_names(symbols: np.ndarray, offsets: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Names of all prefixes of many sequences, each below its own root: two lanes of 64 bits.

    The sequences are cut at half depth again and again, all at once: going down, runs of 1, 2, 4 ... symbols are named
    from their halves; coming back, a prefix that ends at a cut is named from the root of its subtrie
    and the run up to the cut. What begins there is the root of a lower subtrie at the next level.
    """
    n = np.diff(offsets)
    runs, counts = [symbols], [n]
    while counts[-1].max(initial=0) > 1:
        half, count = runs[-1], counts[-1]
        first = W.ragged((np.cumsum(count) - count), count // 2 * 2)[::2]
        runs.append(_joined(half[:, first], half[:, first + 1]))
        counts.append(count // 2)
    above, above_counts = np.zeros((2, 0), np.uint64), np.zeros(len(n), np.int64)
    for run, count in zip(reversed(runs), reversed(counts), strict=True):
        owner = np.repeat(np.arange(len(n)), count)
        place = W.ragged(np.zeros(len(n), np.int64), count)  # this prefix ends after run number place
        names = np.empty_like(run)
        even = place % 2 == 1  # ends where a run of twice the length ends, so it has its name already
        base = np.cumsum(above_counts) - above_counts
        names[:, even] = above[:, (base[owner] + place // 2)[even]]
        odd = ~even
        top = roots[:, owner[odd]]
        inner = place[odd] > 0
        top[:, inner] = above[:, (base[owner] + place // 2 - 1)[odd][inner]]
        names[:, odd] = _joined(top, run[:, odd])
        above, above_counts = names, count
    return above


def _lists(column: pa.Array, fields: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    flat, offsets = column.flatten(), column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], {f: flat.field(f).to_numpy(zero_copy_only=False) for f in fields}


def _lanes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.stack([np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)])


def _run_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The name of each whole part: that of its longest prefix under the zero root."""
    for rows in batches:
        if rows.num_rows:
            offsets, x = _lists(rows["turns"], ["s1", "s2"])
            names = prefix_names(_lanes(x["s1"], x["s2"]), offsets, np.zeros((2, rows.num_rows), np.uint64))[:, offsets[1:] - 1]
            yield pa.RecordBatch.from_arrays([rows["seq"], rows["part"], *(pa.array(W.signed(v)) for v in names)], ["seq", "pos", "s1", "s2"])


def _path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per prefix: its depth, name, the name one turn shorter and the size of its last turn."""
    for rows in batches:
        if not rows.num_rows:
            continue
        offsets, x = _lists(rows["turns"], ["s1", "s2", "size"])
        n = np.diff(offsets)
        roots = _lanes(rows["r1"].to_numpy(), rows["r2"].to_numpy())
        names = prefix_names(_lanes(x["s1"], x["s2"]), offsets, roots)
        whole = n == PART
        names[:, offsets[1:][whole] - 1] = _lanes(rows["e1"].to_numpy(), rows["e2"].to_numpy())[:, whole]
        parents = np.concatenate([roots[:, :1], names[:, :-1]], 1)
        parents[:, offsets[:-1]] = roots
        depth = np.repeat(rows["part"].to_numpy() * PART, n) + W.ragged(np.zeros(len(n), np.int64), n) + 1
        yield pa.RecordBatch.from_arrays(
            [rows["seq"].take(pa.array(np.repeat(np.arange(len(n)), n))), pa.array(depth), *(pa.array(W.signed(v)) for v in (*names, *parents)), pa.array(x["size"])],
            ["seq", "depth", "n1", "n2", "p1", "p2", "size"])


def named_prefixes(turns: DataFrame) -> DataFrame:
    """seq, depth, n1, n2, p1, p2, size for every prefix of the sequences (seq, pos from 0, s1, s2, size).

    Parts of ``PART`` turns are rows. Names of whole parts are the symbols of a shorter sequence, whose
    prefixes, found by the same step, name the cuts: the ends of these parts and the roots of the next.
    """
    kind = turns.schema["seq"].dataType.simpleString()
    entry = F.struct((F.col("pos") % PART).alias("at"), "s1", "s2", "size")
    parts = turns.groupBy("seq", F.floor(F.col("pos") / PART).cast("long").alias("part")).agg(F.sort_array(F.collect_list(entry)).alias("turns"))
    parts = written(parts, "turn-parts")
    full, names = parts.where(F.size("turns") == PART), ["r1", "r2", "e1", "e2"]
    if full.isEmpty():
        parts = parts.select("*", *(F.lit(0).cast("long").alias(c) for c in names))
    else:
        runs = full.mapInArrow(_run_names, f"seq {kind}, pos long, s1 long, s2 long")
        upper = written(named_prefixes(runs.withColumn("size", F.lit(0).cast("long"))), "upper-prefixes")
        for shift, (one, two) in ((0, names[:2]), (1, names[2:])):
            parts = parts.join(upper.select("seq", (F.col("depth") - shift).alias("part"), F.col("n1").alias(one), F.col("n2").alias(two)), ["seq", "part"], "left")
        parts = parts.fillna(0, names)
    return parts.mapInArrow(_path, f"seq {kind}, depth long, n1 long, n2 long, p1 long, p2 long, size long")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and id: the ids of a node joined by commas, in pieces."""
    part, no, key, held, size = TaskContext.get().partitionId(), 0, None, [], 0
    out: list[tuple] = []

    def flush():
        nonlocal no, held, size
        if held:
            out.append((*key, part, no, ",".join(held)))
            no, held, size = no + 1, [], 0

    def batch():
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()),
                                           pa.array(columns[4], pa.string())], ["n1", "n2", "part", "no", "ids"])

    for rows in batches:
        for n1, n2, seq in zip(rows["n1"].to_pylist(), rows["n2"].to_pylist(), rows["seq"].to_pylist(), strict=True):
            if (n1, n2) != key or size > PIECE:
                flush()
                key = (n1, n2)
            name = str(seq)
            held.append(name)
            size += len(name) + 1
        if len(out) > 4096 or sum(len(r[-1]) for r in out) > 16 * PIECE:
            yield batch()
    flush()
    if out:
        yield batch()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node, part and number: SHA-256 of a node's pieces joined by commas; only its state is held."""
    key, state, out = None, None, []

    def batch():
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2])], ["n1", "n2", "ends_sha256"])

    for rows in batches:
        for n1, n2, ids in zip(rows["n1"].to_pylist(), rows["n2"].to_pylist(), rows["ids"].to_pylist(), strict=True):
            if (n1, n2) == key:
                state.update(b"," + ids.encode())
                continue
            if state is not None:
                out.append((*key, state.hexdigest()))
            key, state = (n1, n2), hashlib.sha256(ids.encode())
        if len(out) > 8192:
            yield batch()
    if state is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield batch()


def _grafted(path: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """n1, n2, n_leaves, saved_tokens summed over subtrees.

    At level k every subtrie of height 2^k has its totals. The roots of the lower ones stand at odd multiples
    of 2^k; each adds its totals to the 2^k nodes of the upper subtrie above it, found on the path of
    its smallest member. All subtries of a level go in one join, and log2(depth) levels complete the trie.
    """
    own = nodes.select("n1", "n2", "depth", F.col("leaf").alias("leaves"), F.col("own").alias("saved"))
    done = [own]
    summed = lambda df, *keys: df.groupBy(*keys).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    for k in range(int(deepest).bit_length()):
        block = F.shiftright("depth", k)
        at_cut = (F.col("depth") > 0) & (F.col("depth") % (2 << k) == 1 << k)
        roots = done[0].where(at_cut)
        for more in done[1:]:
            roots = roots.unionByName(more.where(at_cut))
        roots = summed(roots, "n1", "n2", "depth") if len(done) > 1 else roots
        owners = nodes.where(at_cut).select("n1", "n2", F.col("conv_id").alias("seq"))
        lower = roots.join(owners, ["n1", "n2"]).select("seq", (block - 1).alias("block"), "leaves", "saved")
        upper = path.where(block % 2 == 0).select("seq", block.alias("block"), "n1", "n2", "depth")
        done.append(written(summed(upper.join(lower, ["seq", "block"]), "n1", "n2", "depth"), f"grafts-{k}"))
    everything = done[0]
    for more in done[1:]:
        everything = everything.unionByName(more)
    return summed(everything, "n1", "n2").withColumnsRenamed({"leaves": "n_leaves", "saved": "saved_tokens"})


def prefix_trie(turns: DataFrame, sequences: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has seq, pos (from 0, gapless), s1, s2 (two hashes of the turn) and size (of its text);
    ``sequences`` has every seq once, also those without turns, which end at the root. Equal sequences meet in one
    node; no sequences give no node. Nodes are named by 128-bit hashes.
    """
    named = named_prefixes(turns)
    zero = lambda name: F.lit(0).cast("long").alias(name)
    start = sequences.select("seq", zero("depth"), zero("n1"), zero("n2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"), zero("size"))
    path = written(start.unionByName(named), "trie-paths")
    nodes = path.groupBy("n1", "n2", "depth", "p1", "p2").agg(F.min("seq").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"))
    nodes = written(nodes, "trie-nodes")
    children = nodes.groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["n1", "n2"], "left").fillna(0, ["n_children"])
    nodes = nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("own", (F.col("n_convs") - 1) * F.col("size"))
    nodes = written(nodes, "trie-nodes")

    last = F.max_by(F.struct("n1", "n2"), "depth").alias("last")
    ends = written(path.groupBy("seq").agg(last).select("last.n1", "last.n2", "seq"), "trie-ends")
    pieces = ends.repartitionByRange("n1", "n2", "seq").sortWithinPartitions("n1", "n2", "seq").mapInArrow(_pieces, "n1 long, n2 long, part int, no long, ids string")
    digests = pieces.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "part", "no").mapInArrow(_digests, "n1 long, n2 long, ends_sha256 string")

    totals = _grafted(path, nodes, nodes.agg(F.max("depth")).first()[0] or 0)
    parents = nodes.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, ["n1", "n2"]).join(digests, ["n1", "n2"], "left").join(parents, ["p1", "p2"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """seq, pos, s1, s2, size: the turns of each conversation, numbered from 0 in order of ``turn``.

    Null turns come first; turns of one number follow each other by role, then by a hash of their text.
    Null role or text is empty; rows without conversation id belong to none and are left out; other columns are ignored. The rows are
    range-sorted, so that one conversation may lie in many tasks; counts per task give the numbers.
    """
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("seq"), F.col(turn).alias("turn"), role.alias("role"), *(F.xxhash64(F.lit(k), role, text).alias(f"s{k}") for k in _LANES),
        F.length(text).cast("long").alias("size"), F.rand(12).alias("any"))
    order = ["seq", "turn", "role", "s1", "s2", "any"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("seq", "s1", "s2", "size", F.monotonically_increasing_id().alias("at"))
    rows = written(rows.withColumn("task", F.shiftright("at", 33)), "turns")
    here = rows.groupBy("seq", "task").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("seq").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = here.select("seq", "task", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base"))
    return rows.join(bases, ["seq", "task"]).select("seq", (F.col("at") + F.col("base")).alias("pos"), "s1", "s2", "size")


def forked(turns: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt as forks, with all their ids: the first h turns are those of the first of the ``group``.

    h is crc32(id as text) modulo ``most``; ids must be whole numbers. Fewer turns where the first has fewer,
    none where it doesn't exist; then a conversation's own turns after its first h.
    """
    turns = written(turns, "ordered-turns")
    h = F.crc32(F.col("seq").cast("string").cast("binary")) % most
    head = F.col("seq") - F.col("seq") % group
    sequences = turns.select("seq").distinct()
    heads = turns.where((F.col("seq") % group == 0) & (F.col("pos") < most - 1)).withColumnRenamed("seq", "head")
    lengths = heads.groupBy("head").agg(F.count("*").alias("has"))
    first = sequences.withColumn("head", head).join(heads, "head").where(F.col("pos") < h).select("seq", "pos", "s1", "s2", "size")
    own = turns.where(F.col("pos") >= h).withColumn("head", head).join(lengths, "head", "left")
    shift = h - F.least(h, F.coalesce("has", F.lit(0)))
    return first.unionByName(own.select("seq", (F.col("pos") - shift).alias("pos"), "s1", "s2", "size")), sequences
