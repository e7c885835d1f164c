"""Near-duplicate vectors by collision counting on one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from comboscope.functions.storage import written
from comboscope.llm import words as W
from comboscope.operators.clusters import components

#: Vectors that meet in one step; groups with more are cut into blocks that meet in pairs.
BLOCK = 512


def calibrated(recall: float, threshold: float, tables: int, width: int, window: float) -> tuple[float, int]:
    """(cell, least count) for pairs just at the threshold: cell is the size of a table's cells, in standard deviations of the data.

    A Gaussian projection of two unit vectors at distance d differs by N(0, d). ``window`` is half a query-centred
    window in units of d. The count is the largest that a pair reaches with the recall in doubt left over;
    the cell size lets a pair share a cell in some table with that recall.
    """
    d = sqrt(2 - 2 * threshold)
    p = erf(window / sqrt(2))
    m = tables * width
    miss, least = 0.0, m
    tail = [comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(m + 1)]
    for k in range(m + 1):
        miss += tail[k]
        if miss > (1 - recall) / 2:
            least = k
            break
    share = 1 - ((1 - recall) / 2) ** (1 / tables)  # a pair shares one table's cell this often
    cell = d * sqrt(2 / np.pi) / (1 - share ** (1 / width))
    return cell, least


def _directions(size: int, tables: int, width: int) -> np.ndarray:
    return np.random.default_rng(20011).standard_normal((size, tables * width))


def _unit(batch: pa.RecordBatch, column: str = "vector") -> np.ndarray:
    flat = batch[column].flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(batch.num_rows, -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _cells(x: np.ndarray, tables: int, width: int, cell: float) -> np.ndarray:
    """Hash of the cell of each vector in each table; grids are shifted by fixed amounts."""
    shift = np.random.default_rng(7).random(tables * width) * cell
    grid = np.floor((x @ _directions(x.shape[1], tables, width) + shift) / cell).astype(np.int64).view(np.uint64)
    out = np.zeros((len(x), tables), np.uint64)
    for k in range(width):
        out = W.mixed(out * np.uint64(0x9E3779B97F4A7C15) + grid[:, k::width], k)
    return W.mixed(out + np.arange(tables, dtype=np.uint64), 99)


def _routed(size: int, tables: int, width: int, cell: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                keys = _cells(_unit(part), tables, width, cell)
                row = np.repeat(np.arange(part.num_rows), tables)
                yield pa.RecordBatch.from_arrays(
                    [part["label"].take(pa.array(row)), pa.array(W.signed(keys.ravel())), pa.array(np.tile(np.arange(tables, dtype=np.int32), part.num_rows)),
                     part["rep"].take(pa.array(row)), part["copies"].take(pa.array(row)), part["vector"].take(pa.array(row))],
                    ["label", "cell", "grid", "rep", "copies", "vector"])
    return scan


def _linked(threshold: float, tables: int, width: int, cell: float, window: float, least: int):
    """Counts of direct links and a spanning forest of them, for rows of one meeting after the other."""
    d = sqrt(2 - 2 * threshold) * window

    def links(rows: pa.RecordBatch, own: int, other: int):
        x = _unit(rows)
        reps, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy()
        block, grid = rows["block"].to_numpy(), rows["grid"][0].as_py()
        left = np.nonzero(block == own)[0]
        right = left if own == other else np.nonzero(block == other)[0]
        if not len(left) or not len(right):
            return None
        on = x @ _directions(x.shape[1], tables, width)
        keys = _cells(x, tables, width, cell)
        near = np.zeros((len(left), len(right)), np.uint8)
        for j in range(on.shape[1]):
            near += np.abs(on[left, j][:, None] - on[right, j][None, :]) <= d
        found = near >= least
        for t in range(grid):  # an earlier table has counted the pair already
            found &= keys[left, t][:, None] != keys[right, t][None, :]
        i, j = np.nonzero(found)
        if own == other:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("ij,ij->i", x[left[i]], x[right[j]]) >= threshold
        i, j = left[i[exact]], right[j[exact]]
        if not len(i):
            return None
        total = np.bincount(i, copies[j], len(x)) + np.bincount(j, copies[i], len(x))
        root = np.arange(len(x))
        edges = []
        for a, b in zip(i, j, strict=True):
            while root[a] != a:
                root[a] = root[root[a]]
                a = root[a]
            while root[b] != b:
                root[b] = root[root[b]]
                b = root[b]
            if a != b:
                root[max(a, b)] = min(a, b)
                edges.append((reps[a], reps[b]))
        some = np.nonzero(total)[0]
        a = np.concatenate([reps[some], [e[0] for e in edges]]).astype(np.int64)
        b = np.concatenate([reps[some], [e[1] for e in edges]]).astype(np.int64)
        n = np.concatenate([total[some], np.zeros(len(edges))]).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    def meet(key: tuple, rows: pa.Table) -> pa.Table:
        out = links(rows.combine_chunks().to_batches()[0], key[-2].as_py(), key[-1].as_py())
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "n": pa.array([], pa.int64())}) if out is None else pa.Table.from_batches([out])

    return meet


def near_vectors(rows: DataFrame, threshold: float = 0.98, recall: float = 0.9999, tables: int = 12, width: int = 5, window: float = 2.2,
                 vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. Rows of one label link at a cosine of ``threshold`` or more.

    Each vector is projected on ``tables * width`` fixed directions. Vectors that share a cell of the sorted
    projections in some table count the projections in which one lies in the window around the other,
    and pairs with the calibrated count are verified in double precision. Cells and count leave out a pair
    at the threshold with probability ``1 - recall``, closer pairs less. A pair that shares several
    cells is counted in the first, so counts of links need no list of pairs. Equal vectors are one
    vector with a number of copies. A cell with many vectors is cut into blocks that meet in pairs.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without label, link
    with nothing; vectors of another length form a set of their own. Rows with null ids return unlinked;
    rows of one id count as copies of that id. Other columns are ignored; an empty table gives an empty result.
    """
    every = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.col(label).cast("string").alias("label"))
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    some = F.exists("vector", lambda v: v != 0)
    links = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & some, F.lit(False))
    usable = every.where(links)
    usable = usable.withColumn("label", F.concat_ws(":", F.size("vector").cast("string"), "label"))
    groups = usable.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    groups = written(groups, "vectors")
    cell, least = calibrated(recall, threshold, tables, width, window)
    placed = groups.mapInArrow(_routed(0, tables, width, cell), "label string, cell long, grid int, rep long, copies long, vector array<double>")
    key = ["label", "cell", "grid"]
    met = placed.groupBy(*key).agg(F.count("*").alias("met")).where("met > 1")
    met = met.withColumn("blocks", F.ceil(F.col("met") / BLOCK).cast("int"))
    parted = placed.join(met, key).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    parted = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parted = parted.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    found = parted.select(*key, "lo", "hi", "block", "rep", "copies", "vector").groupBy(*key, "lo", "hi").applyInArrow(
        _linked(threshold, tables, width, cell, window, least), "a long, b long, n long")
    found = written(found.groupBy("a", "b").agg(F.sum("n").alias("n")), "vector-links")
    counts = found.where("a = b").select(F.col("a").alias("rep"), F.col("n").alias("outside"))
    group_of = components(groups.select(F.col("rep").alias("id")).distinct(), found.where("a <> b").select("a", "b")).select(F.col("id").alias("rep"), "component")
    looked = groups.select("label", "vector", "rep", "copies").join(counts, "rep", "left").join(group_of, "rep", "left")
    own = usable.select("vec_id", "label", "vector").join(looked, ["label", "vector"]).select(
        "vec_id", (F.coalesce("outside", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("component").alias("component_id"))
    alone = every.where(~links).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return own.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
