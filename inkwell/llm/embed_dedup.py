"""Near-duplicate embeddings by a forest of random-projection trees with spill.

Trees split a label's vectors again and again at a random direction; vectors close to a
cut go to both sides.  Vectors that share a leaf of any tree are compared, and pairs that
reach the threshold are links.  The first cuts are quantiles of a bounded sample
(``sample_rows``); every vector is indexed.  Leaves that come out too large are cut further
by quantiles of bounded samples of their own vectors, in passes over those leaves alone, so
leaves stay as small however many vectors there are.  Cuts that would leave most vectors on
both sides are not made: what no cut divides, as a group of near copies, stays one leaf.
A leaf larger than BLOCK is compared in blocks, each block with each, so no group grows
beyond two blocks in a task and none of its pairs is left out.

A pair may share leaves of several trees.  It counts in the first leaf that it shares,
which both vectors' lists of leaves tell without a look at other leaves, so links are
counted where they are found and no pair is written.  For components each leaf reports a
spanning forest of its links.

Defined results: a vector that is null, empty, zero or holds null or non-finite numbers,
or whose label is null, links with nothing; vectors of different length do not link; equal
vectors of a label are one node with a number of copies, each linked to all others;
repeated rows are copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import store
from .components import components

THRESHOLD = 0.93
TREES, LEAF, BLOCK, SPILL, SEED = 8, 512, 1024, 0.5, 7
SAMPLE_ROWS, SAMPLE_NUMBERS, LEAST_SAMPLE = 20_000, 2_000_000, 256
#: a leaf of more than OVERFULL times the rows that leaves aim at is cut further, by a sample of its own of about LOCAL_ROWS
OVERFULL, LOCAL_ROWS, DEEPEST = 4, 4096, 38
#: the margin shrinks with depths beyond this, so that copies of a vector in a tree are bounded
FULL_MARGIN_DEPTH = 12
#: a cut with more of the rows than this on one side is not made
LARGEST_SIDE = 0.85
KEYS = ["label", "dim", "leaf"]


def direction(tree: int, place: int, dim: int) -> np.ndarray:
    v = np.random.default_rng([SEED, tree, place]).standard_normal(dim)
    return v / np.linalg.norm(v)


@dataclass(frozen=True)
class Forest:
    """cuts[tree][place] is the threshold of the split at that place of the tree (root 1, children 2p and 2p + 1)."""

    dim: int
    margin: float
    cuts: tuple[dict[int, float], ...]

    def leaves(self, x: np.ndarray) -> list[np.ndarray]:
        """Per row of unit vectors x the sorted leaves (tree << 40 | place) that hold it."""
        found: list[list[int]] = [[] for _ in range(len(x))]
        for tree, cuts in enumerate(self.cuts):
            for place, rows in fallen(x, tree, 1, cuts, self.margin):
                for r in rows.tolist():
                    found[r].append(tree << 40 | place)
        return [np.array(sorted(f), np.int64) for f in found]


def fallen(x: np.ndarray, tree: int, root: int, cuts: dict[int, float], margin: float) -> Iterator[tuple[int, np.ndarray]]:
    """(place, rows) of the leaves below ``root`` that hold rows of x."""
    todo = [(root, np.arange(len(x)))]
    while todo:
        place, rows = todo.pop()
        if place not in cuts:
            yield place, rows
            continue
        p = x[rows] @ direction(tree, place, x.shape[1]) - cuts[place]
        todo += [(2 * place, rows[p <= margin]), (2 * place + 1, rows[p >= -margin])]


def margin_of(dim: int, threshold: float, depth: int) -> float:
    """Two unit vectors of the threshold's cosine differ by this much along a random direction, SPILL times one standard deviation."""
    return SPILL * float(np.sqrt(2 - 2 * threshold)) / np.sqrt(dim) * min(1.0, FULL_MARGIN_DEPTH / max(depth, 1))


def grown(sample: np.ndarray, tree: int, root: int, depth: int, margin: float) -> dict[int, float]:
    """Cuts of one tree below ``root``, ``depth`` levels at most and none where a sample has too few rows or a cut divides too little."""
    rng = np.random.default_rng([SEED, tree, root])
    cuts: dict[int, float] = {}
    todo = [(root, 0, np.arange(len(sample)))] if len(sample) else []
    while todo:
        place, level, rows = todo.pop()
        if level >= depth or len(rows) < 16 or place.bit_length() > DEEPEST:
            continue
        p = sample[rows] @ direction(tree, place, sample.shape[1])
        # near the middle, or beside what lies densely there
        for share in (rng.uniform(0.4, 0.6), 0.25, 0.75, 0.12, 0.88):
            at = float(np.quantile(p, share))
            low, high = rows[p - at <= margin], rows[p - at >= -margin]
            if max(len(low), len(high)) <= LARGEST_SIDE * len(rows):
                break
        else:
            continue
        cuts[place] = at
        todo += [(2 * place, level + 1, low), (2 * place + 1, level + 1, high)]
    return cuts


def grow(sample: np.ndarray, depth: int, threshold: float, trees: int = TREES) -> Forest:
    """A forest whose trees are ``depth`` deep, or less where the sample cannot tell how to cut."""
    dim = sample.shape[1]
    margin = margin_of(dim, threshold, depth)
    return Forest(dim, margin, tuple(grown(sample, tree, 1, depth, margin) for tree in range(trees)))


def _dim(raw: bytes) -> int:
    return (len(raw) - 1) // raw[0]


def _unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.empty((len(raw), dim))
    for k, v in enumerate(raw):
        x[k] = np.frombuffer(v, "<f4" if v[0] == 4 else "<f8", offset=1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(x: np.ndarray) -> bytes:
    """The numbers as bytes behind their width, four where that loses nothing."""
    narrow = x.astype("<f4")
    return b"\x04" + narrow.tobytes() if (narrow == x).all() else b"\x08" + x.astype("<f8").tobytes()


def _as_bytes(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vec): the vector as bytes, scaled by a power of two; null where it links with nothing."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            for v in batch.column(2):
                x = None if v.values is None else v.values.to_numpy(zero_copy_only=False).astype(float)
                usable = x is not None and len(x) and v.values.null_count == 0 and np.isfinite(x).all() and x.any()
                # a power of two changes no cosine and keeps squares within range
                out.append(_packed(np.ldexp(x, -int(np.frexp(np.abs(x).max())[1])) + 0.0) if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["vec_id", "label", "vec"])

    return vectors.mapInArrow(run, "vec_id long, label string, vec binary")


def _dealt(nodes: DataFrame, forests: dict) -> DataFrame:
    """(label, dim, leaf, node): a row per node and leaf of the first forests."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        root = np.array([1], np.int64)
        for batch in batches:
            groups: dict[tuple, list[dict]] = {}
            for r in batch.to_pylist():
                groups.setdefault((r["label"], _dim(r["vec"])), []).append(r)
            for (label, dim), members in groups.items():
                forest = forests.get((label, dim)) or forests.get((None, dim))
                leaves = forest.leaves(_unit([m["vec"] for m in members], dim)) if forest else [root] * len(members)
                node = np.repeat(np.array([m["node"] for m in members], np.int64), [len(own) for own in leaves])
                yield pa.RecordBatch.from_arrays([pa.array([label] * len(node), pa.string()), pa.array(np.full(len(node), dim, np.int32)), pa.array(np.concatenate(leaves)), pa.array(node)], names=[*KEYS, "node"])

    return nodes.select("label", "vec", "node").mapInArrow(run, "label string, dim int, leaf long, node long")


def _local_cuts(picked: DataFrame, leaf_rows: int, threshold: float) -> DataFrame:
    """(label, dim, leaf, depth, places, cuts) of overfull leaves, each grown from its own sample; no places where nothing divides it."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        label, dim, leaf = (k.as_py() for k in key)
        tree, root = leaf >> 40, leaf & ((1 << 40) - 1)
        depth = max(1, int(np.ceil(np.log2(table["n"][0].as_py() / leaf_rows))))
        raw = [v for _, v in sorted(zip(table["node"].to_pylist(), table["vec"].to_pylist(), strict=True))]
        whole = root.bit_length() - 1 + depth
        cuts = grown(_unit(raw, dim), tree, root, depth, margin_of(dim, threshold, whole))
        return pa.table({"label": pa.array([label], pa.string()), "dim": pa.array([dim], pa.int32()), "leaf": pa.array([leaf]), "depth": pa.array([whole], pa.int32()), "places": pa.array([list(cuts)], pa.list_(pa.int64())), "cuts": pa.array([list(cuts.values())], pa.list_(pa.float64()))})

    return picked.groupBy(*KEYS).applyInArrow(run, "label string, dim int, leaf long, depth int, places array<long>, cuts array<double>")


def _cut_further(rows: DataFrame, threshold: float) -> DataFrame:
    """(label, dim, leaf, node, done) of rows (label, dim, leaf, node, vec, depth, places, cuts) in the leaves below theirs."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, list[dict]] = {}
            for r in batch.to_pylist():
                groups.setdefault((r["label"], r["dim"], r["leaf"]), []).append(r)
            for (label, dim, leaf), members in groups.items():
                tree, root = leaf >> 40, leaf & ((1 << 40) - 1)
                cuts = dict(zip(members[0]["places"], members[0]["cuts"], strict=True))
                node = np.array([m["node"] for m in members], np.int64)
                for place, at in fallen(_unit([m["vec"] for m in members], dim), tree, root, cuts, margin_of(dim, threshold, members[0]["depth"])):
                    n = len(at)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * n, pa.string()), pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, tree << 40 | place, np.int64)), pa.array(node[at]), pa.array([not cuts] * n, pa.bool_())], names=[*KEYS, "node", "done"])

    return rows.select(*KEYS, "node", "vec", "depth", "places", "cuts").mapInArrow(run, "label string, dim int, leaf long, node long, done boolean")


def indexed(nodes: DataFrame, forests: dict, leaf_rows: int, threshold: float) -> DataFrame:
    """(label, dim, leaf, node): every node in its leaves, overfull ones cut by their own vectors until none is or none divides.

    A pass handles overfull leaves only, multiplies their number by some hundred, and sends
    nothing to the driver.
    """
    placed = store.cut(_dealt(nodes, forests).withColumn("done", F.lit(False)))
    while True:
        over = store.written(placed.where("NOT done").groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > OVERFULL * leaf_rows), "overfull-leaves")
        if over.isEmpty():
            return placed.drop("done")
        rows = store.cut(placed.where("NOT done").join(over, KEYS).join(nodes.select("node", "vec"), "node"))
        # a share of each leaf's rows, by a hash of the node
        share = F.pmod(F.xxhash64("node", "leaf"), F.lit(1 << 30)) < F.lit(float(1 << 30)) * LOCAL_ROWS / F.col("n")
        cuts = store.written(_local_cuts(rows.where(share), leaf_rows, threshold), "leaf-cuts")
        cut = _cut_further(rows.join(cuts, KEYS), threshold)
        placed = store.cut(placed.join(over.drop("n"), KEYS, "left_anti").union(cut.select(placed.columns)))


def _compared(rows: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root) of each leaf block: other vectors first met here, and the smallest node that its links here lead to."""

    def run(table: pa.Table) -> pa.Table:
        leaf = table["leaf"][0].as_py()
        node, copies, half = (table[c].to_numpy() for c in ("node", "copies", "half"))
        order = np.argsort(node, kind="stable")
        node, copies, half = node[order], copies[order], half[order]
        raw, lists = table["vec"].to_pylist(), table["leaves"].combine_chunks()
        x = _unit([raw[i] for i in order], table["dim"][0].as_py())
        # leaves before this one, by a column each, to tell pairs that have met before
        own = [lists[int(i)].values.to_numpy() for i in order]
        own = [f[f < leaf] for f in own]
        known = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        met = np.zeros((len(node), len(known)), np.float32)
        for i, f in enumerate(own):
            met[i, np.searchsorted(known, f)] = 1
        two = bool(half.any())
        left, right = (np.flatnonzero(half == 0), np.flatnonzero(half == 1)) if two else (np.arange(len(node)),) * 2
        links, root = np.zeros(len(node), np.int64), np.arange(len(node))
        ends: list[tuple[np.ndarray, np.ndarray]] = []
        for lo in range(0, len(left), 256):
            rows_ = left[lo : lo + 256]
            near = x[rows_] @ x[right].T >= threshold
            near &= node[rows_][:, None] != node[right][None, :]
            i, j = np.nonzero(near)
            ends.append((rows_[i], right[j]))
            first = near & ~(met[rows_] @ met[right].T > 0) if len(known) else near
            links[rows_] += first @ copies[right]
            if two:
                links[right] += first.T @ copies[rows_]
        a, b = (np.concatenate(e) for e in zip(*ends, strict=True)) if ends else (np.zeros(0, np.int64),) * 2
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        some = np.flatnonzero((links > 0) | (root != np.arange(len(node))))
        return pa.table({"node": pa.array(node[some]), "links": pa.array(links[some]), "root": pa.array(node[root[some]])})

    return rows.groupBy("label", "dim", "leaf", "block").applyInArrow(run, "node long, links long, root long")


def linked(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = THRESHOLD, trees: int = TREES, leaf_rows: int = LEAF, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = store.cut(_as_bytes(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), embedding)).withColumn("vec", F.when(F.col("label").isNotNull(), F.col("vec"))))
    grouped = rows.where("vec IS NOT NULL").groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = store.cut(grouped.withColumn("node", F.monotonically_increasing_id()))

    # a bounded sample, whatever the table's size: as many rows, and as many numbers, at most
    longest = nodes.agg(F.max(F.octet_length("vec"))).first()[0] or 4
    bound = min(sample_rows, max(LEAST_SAMPLE, SAMPLE_NUMBERS * 4 // longest))
    sampled = nodes.orderBy(F.xxhash64("vec", "label"), "node").limit(bound).select("label", "vec").collect()
    total = nodes.count()
    by_key: dict[tuple, list[bytes]] = {}
    for r in sampled:
        dim = _dim(bytes(r.vec))
        by_key.setdefault((r.label, dim), []).append(bytes(r.vec))
        by_key.setdefault((None, dim), []).append(bytes(r.vec))
    forests = {}
    for (name, dim), raw in by_key.items():
        there = total * len(raw) / max(1, len(sampled))  # of this label and length in the whole table, as the sample tells
        if (name is None or len(raw) >= LEAST_SAMPLE) and there > leaf_rows:
            forests[name, dim] = grow(_unit(raw, dim), int(np.ceil(np.log2(there / leaf_rows))), threshold, trees)

    placed = indexed(nodes, forests, leaf_rows, threshold)
    large = store.written(placed.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK), "large-leaves")
    blocks = F.expr(f"(coalesce(n, 1) + {BLOCK - 1}) div {BLOCK}")
    lists = placed.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    wide = nodes.select("node", "copies", "vec").join(lists, "node")
    each = placed.join(large, KEYS, "left").join(wide, "node").withColumn("blocks", blocks)
    each = each.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("with", F.explode(F.expr("sequence(0L, blocks - 1)")))
    low, high = F.least("mine", "with"), F.greatest("mine", "with")
    dealt = each.select("label", "dim", "leaf", "node", "copies", "vec", "leaves", (low * F.col("blocks") + high).alias("block"), F.when(F.col("mine") > F.col("with"), 1).otherwise(0).alias("half"))
    found = store.cut(_compared(dealt, threshold))

    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(found.select(F.col("root").alias("a"), F.col("node").alias("b")))
    named = _named_nodes(nodes, labels, counts)
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_vec = named.join(heads, "root").select("label", "vec", "n_links", "component_id")
    out = rows.join(by_vec, ["label", "vec"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _named_nodes(nodes: DataFrame, labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(label, vec, least, n_links, root) of every node."""
    joined = nodes.join(labels.withColumnRenamed("label", "root"), "node", "left").join(counts, "node", "left")
    return joined.select("label", "vec", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
