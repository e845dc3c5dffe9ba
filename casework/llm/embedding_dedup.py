"""Near-duplicate vectors by NN-descent.

1. Equal vectors of one label are one node.
2. First graph: ``TABLES`` orders of the nodes (by label, the sign code of
   random hyperplanes, and a projection); each node meets its neighbours in
   every order. An order is a range-partitioned sort read as a stream, so no
   group of nodes is ever held together.
3. Rounds: a node samples ``SAMPLE`` of its neighbours, in both directions,
   and meets the neighbours of those. Its list keeps the ``LIST`` nearest; a
   list that is full of links (saturated) grows fourfold, until the links fit.
   Edges below ``FLOOR`` lead to no link within two steps and are not kept.
   Rounds end when no list is saturated and a round brings at most one new
   link per thousand that are known; the size of the table plays no part.
4. Dense nodes: a list with ``DENSE`` links grows no further. Hubs are taken
   from the dense nodes, ``HUBS`` broadcast at a time, until each links with a
   hub; what links with it lies within twice the angle of that hub, so its
   links are counted, every one, in blocks of about ``BLOCK`` vectors a side
   over all nodes in that reach. A block returns a count per node and an edge
   to the hub per linked node, so no pair becomes a row. A round of hubs reads
   the nodes once; more than ``HUBS`` dense groups mean more rounds.
5. Audit: ``AUDIT`` nodes and as many nodes that have links, chosen by hash,
   are compared with all nodes in blocks; if either recall is below ``RECALL``
   (or lists were still growing) the rounds go on with further orders. After
   ``REPAIRS`` of them all nodes that are not dense are compared, ``EXACT`` at
   a time: right at any size, but a pass over the nodes for each.
6. Edges of at least the threshold are the links; components follow.

All cosines are double precision, in NumPy within tasks.
"""

from __future__ import annotations

import logging
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from casework.llm.common import record_batch, stage, star_rounds, table

THRESHOLD = 0.98
TABLES = 8
WINDOW = 4
LIST = 16
SAMPLE = 6
ROUNDS = 16
AUDIT = 512
RECALL = 0.97
REPAIRS = 3
EXACT = 8192               # nodes broadcast at a time where every pair is compared
DENSE = 64
HUBS = 2048
BLOCK = 1024

_LOG = logging.getLogger(__name__)

_EDGE = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("cos", pa.float64())])
_EDGE_SQL = "x long, y long, cos double"
_COUNT = pa.schema([("x", pa.int64()), ("n", pa.int64())])
_BALL = pa.schema([("hub", pa.int64()), ("x", pa.int64()), ("members", pa.int64()), ("mine", pa.bool_()), ("v", pa.list_(pa.float64()))])
_BALL_SQL = "hub long, x long, members long, mine boolean, v array<double>"
_BLOCK = pa.schema([("x", pa.int64()), ("hub", pa.int64()), ("n", pa.int64()), ("others", pa.int64())])
_BLOCK_SQL = "x long, hub long, n long, others long"


def floor_of(threshold: float) -> float:
    """Cosine of twice the threshold's angle: a neighbour's neighbour is no
    nearer than that, and one of a link's two ends no farther."""
    return max(-1.0, 2 * threshold * threshold - 1 - 1e-9)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat double values, offsets) of a list column."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat, np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))


def _cosines(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Cosine of each pair of rows; both have the same lengths."""
    x, off = _vectors(a)
    y, _ = _vectors(b)
    at = off[:-1]
    dot, xx, yy = (np.add.reduceat(v, at) for v in (x * y, x * x, y * y))
    return dot / (np.sqrt(xx) * np.sqrt(yy))


def label_code(vectors: DataFrame) -> Column:
    """The label as a long: itself if it is a whole number, else its hash."""
    label = F.col("label")
    if isinstance(vectors.schema["label"].dataType, IntegralType):
        return label.cast("long")
    return F.when(label.isNotNull(), F.xxhash64(label.cast("string")))


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(x, label, dim, v, members): distinct vectors that may link; x is the
    smallest vec_id, label its code, members the number of distinct ids."""
    v = F.col("embedding")
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
            & F.coalesce(F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))), F.lit(False))
            & F.coalesce(F.exists(v, lambda e: e != 0), F.lit(False)))
    return (vectors.where(fine).select("vec_id", label_code(vectors).alias("label"), v.cast("array<double>").alias("v")).distinct()
            .groupBy("label", "v").agg(F.min("vec_id").alias("x"), F.count("*").alias("members"))
            .select("x", "label", F.size("v").alias("dim"), "v", "members"))


def first_graph(nodes: DataFrame, bits: int, seed: int, floor: float, tables: int = TABLES, width: int = WINDOW) -> DataFrame:
    """Step 2: (x, y, cos) of at least ``floor`` between neighbours of an order."""
    keyed_schema = pa.schema([("t", pa.int32()), ("label", pa.int64()), ("dim", pa.int32()), ("code", pa.int64()), ("place", pa.float64()),
                              ("x", pa.int64()), ("v", pa.list_(pa.float64()))])

    def keys(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            flat, off = _vectors(b.column(3))
            dims = np.diff(off)
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), tables * (bits + 1)))
                p = flat[off[rows][:, None] + np.arange(d)] @ planes[d]
                p = p.reshape(len(rows), tables, bits + 1)
                code = (p[:, :, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
                part = b.take(pa.array(rows))
                for t in range(tables):
                    yield record_batch(keyed_schema, np.full(len(rows), t, np.int32), part.column(1), part.column(2), code[:, t], p[:, t, bits],
                                       part.column(0), part.column(3).cast(pa.list_(pa.float64())))

    def meet(batches):
        last = None
        for b in batches:
            b = pa.Table.from_batches([last, b]).combine_chunks().to_batches()[0] if last is not None else b
            group = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2)])
            x = b.column(5).to_numpy()
            for d in range(1, min(width, b.num_rows - 1) + 1):
                same = np.flatnonzero((group[:, d:] == group[:, :-d]).all(axis=0))
                if len(same):
                    cos = _cosines(b.column(6).take(pa.array(same)), b.column(6).take(pa.array(same + d)))
                    near = cos >= floor
                    i, j, c = x[same][near], x[same + d][near], cos[near]
                    yield record_batch(_EDGE, np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([c, c]))
            # the last rows meet the next batch; pairs among them come twice, which a later distinct undoes
            last = b.slice(max(0, b.num_rows - width))

    keyed = (nodes.select("x", F.col("label").cast("long").alias("label"), "dim", "v")
             .mapInArrow(keys, "t int, label long, dim int, code long, place double, x long, v array<double>"))
    order = ["t", "label", "dim", "code", "place", "x"]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(meet, _EDGE_SQL)


def measured(pairs: DataFrame, nodes: DataFrame, floor: float) -> DataFrame:
    """(x, y, cos) of the pairs of at least ``floor``."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                cos = _cosines(b.column(2), b.column(3))
                near = pa.array(cos >= floor)
                yield record_batch(_EDGE, b.column(0).filter(near), b.column(1).filter(near), pa.array(cos).filter(near))

    far = nodes.select(F.col("x").alias("y"), F.col("v").alias("w"))
    return pairs.join(far, "y").join(nodes.select("x", "v"), "x").select("x", "y", "v", "w").mapInArrow(run, _EDGE_SQL)


def nearest(edges: DataFrame, threshold: float, size: int = LIST, most: int | None = None) -> DataFrame:
    """The lists: of each node's edges (x, y, cos, old) the nearest ones, and
    the list's ``room``: ``size``, or as many times four as its old links fill
    (``most`` at most; None: without end)."""
    all_ = edges.groupBy("x", "y").agg(F.max("cos").alias("cos"), F.max("old").alias("old"))
    links = F.sum(F.when(F.col("old") & (F.col("cos") >= threshold), 1).otherwise(0)).over(Window.partitionBy("x"))
    room = F.when(links < size, F.lit(size)).otherwise((size * F.pow(F.lit(4.0), F.floor(F.log2(links / F.lit(size)) / 2) + 1)).cast("int"))
    room = room if most is None else F.least(room, F.lit(most))
    rank = F.row_number().over(Window.partitionBy("x").orderBy(F.desc("cos"), "y"))
    return all_.select("x", "y", "cos", "old", room.alias("room"), rank.alias("rank")).where("rank <= room").select("x", "y", "cos", "old", "room")


def dense_nodes(links: DataFrame, dense: int) -> DataFrame:
    """(x) of the nodes with at least ``dense`` links."""
    return links.groupBy("x").agg(F.count("*").alias("links")).where(F.col("links") >= dense).select("x")


def refine(graph: DataFrame, nodes: DataFrame, threshold: float, name: str, rounds: int = ROUNDS, dense: int | None = None) -> tuple[DataFrame, bool]:
    """Step 3: (graph, whether it has settled within ``rounds``). Nodes with
    ``dense`` links (None: none is) look no further, others look through them."""
    floor, settled = floor_of(threshold), False
    for r in range(rounds):
        both = graph.select("x", "y").union(graph.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
        if dense:
            both = both.join(dense_nodes(graph.where(F.col("cos") >= threshold), dense), "x", "left_anti")
        rank = F.row_number().over(Window.partitionBy("x").orderBy(F.xxhash64("x", "y", F.lit(r)), "y"))
        picked = both.withColumn("rank", rank).where(F.col("rank") <= SAMPLE).select("x", F.col("y").alias("k"))
        hop = graph.select(F.col("x").alias("k"), F.col("y").alias("z"))
        pairs = picked.join(hop, "k").where("x <> z").select("x", F.col("z").alias("y")).distinct()
        pairs = stage(pairs.join(graph.select("x", "y"), ["x", "y"], "left_anti"), f"{name}-pairs{r}")
        new = measured(pairs, nodes, floor).withColumn("old", F.lit(False))
        # what one end has found, the other knows too
        new = new.union(new.select(F.col("y").alias("x"), F.col("x").alias("y"), "cos", "old"))
        graph = stage(nearest(graph.withColumn("old", F.lit(True)).union(new), threshold, most=dense), f"{name}-graph{r}")
        known = graph.where(F.col("cos") >= threshold).groupBy("x").agg(F.count("*").alias("links"), F.count_if(~F.col("old")).alias("new"), F.max("room").alias("room"))
        if dense:
            known = known.where(F.col("links") < dense)
        found, links, full = known.agg(F.sum("new"), F.sum("links"), F.count_if(F.col("links") >= F.col("room"))).first()
        graph = graph.drop("old", "room")
        settled = not full and 1000 * (found or 0) <= (links or 0)
        if settled:
            break
    return graph, settled


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1)[:, None]


def _blocks(sample: DataFrame) -> dict[tuple, tuple[np.ndarray, np.ndarray]]:
    """(ids, unit vectors) of the nodes by label and length, in their order."""
    sample = sample.select("x", F.col("label").cast("long").alias("label"), "dim", "v").toArrow()
    by: dict[tuple, list] = {}
    for x, label, dim, v in zip(*(sample.column(i).to_pylist() for i in range(4))):
        by.setdefault((label, dim), []).append((x, v))
    return {k: (np.array([x for x, _ in q]), _unit(np.array([v for _, v in q]))) for k, q in by.items()}


def compared(sample: DataFrame, nodes: DataFrame, threshold: float, count: bool = False) -> DataFrame:
    """(x, y) of all links of the nodes of ``sample``, which is broadcast; with
    ``count`` (x, n), their number."""
    blocks = _blocks(sample)
    shared = nodes.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        for b in batches:
            flat, off = _vectors(b.column(3))
            x, label, dim = (b.column(i).to_numpy() for i in range(3))
            for (lab, d), (q, qv) in shared.value.items():
                rows = np.flatnonzero((label == lab) & (dim == d))
                if len(rows):
                    cos = _unit(flat[off[rows][:, None] + np.arange(d)]) @ qv.T
                    near = (cos >= threshold) & (x[rows][:, None] != q)
                    if count:
                        yield record_batch(_COUNT, q, near.sum(axis=0))
                    else:
                        i, j = np.nonzero(near)
                        yield record_batch(_EDGE, q[j], x[rows][i], cos[i, j])

    own = nodes.select("x", F.col("label").cast("long"), "dim", "v")
    if count:
        return own.mapInArrow(run, "x long, n long").groupBy("x").agg(F.sum("n").alias("n"))
    return own.mapInArrow(run, _EDGE_SQL).select("x", "y")


def audit(links: DataFrame, nodes: DataFrame, threshold: float, queries: int = AUDIT) -> tuple[int, int]:
    """(links of the audited nodes, those that were found); the nodes are
    chosen from all of ``nodes`` by hash."""
    return _share(_degree(links), nodes, nodes, threshold, queries)


def audit_linked(links: DataFrame, nodes: DataFrame, threshold: float, queries: int = AUDIT) -> tuple[int, int]:
    """The same of nodes that have links, however few they are in the table."""
    return _share(_degree(links), nodes.join(links.select("x").distinct(), "x", "left_semi"), nodes, threshold, queries)


def _degree(links: DataFrame) -> DataFrame:
    return links.groupBy("x").agg(F.count("*").alias("n"))


def _share(degree: DataFrame, among: DataFrame, nodes: DataFrame, threshold: float, queries: int) -> tuple[int, int]:
    """Every link that was found is one, so the numbers tell what is missing."""
    true = compared(among.orderBy(F.xxhash64("x"), "x").limit(queries), nodes, threshold, count=True)
    both = true.join(degree.select("x", F.col("n").alias("found")), "x", "left")
    row = both.agg(F.sum("n"), F.sum(F.least("n", F.coalesce("found", F.lit(0))))).first()
    return row[0] or 0, row[1] or 0


def independent(unit: np.ndarray, threshold: float) -> np.ndarray:
    """Places of unit vectors none of which links with an earlier one of them,
    while every other vector links with one."""
    near, free, out = unit @ unit.T >= threshold, np.ones(len(unit), bool), []
    for i in range(len(unit)):
        if free[i]:
            out.append(i)
            free &= ~near[i]
    return np.array(out, np.int64)


def _reach(nodes: DataFrame, hubs: dict[tuple, tuple[np.ndarray, np.ndarray]], threshold: float) -> DataFrame:
    """(hub, x, members, mine, v) of all nodes within twice the threshold's
    angle of a hub; ``mine`` at the first hub that an ``open`` node links with."""
    shared, floor = nodes.sparkSession.sparkContext.broadcast(hubs), floor_of(threshold)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                b = whole.slice(at, 512)
                flat, off = _vectors(b.column(3))
                x, label, dim, members, open_ = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2, 4, 5))
                for (lab, d), (h, hv) in shared.value.items():
                    rows = np.flatnonzero((label == lab) & (dim == d))
                    if len(rows):
                        cos = _unit(flat[off[rows][:, None] + np.arange(d)]) @ hv.T
                        # a hub is its own, however its cosine is rounded
                        cos[x[rows][:, None] == h] = 2.0
                        first = np.argmax(cos >= threshold, axis=1)
                        i, j = np.nonzero(cos >= floor)
                        mine = open_[rows][i] & (first[i] == j) & (cos[i, j] >= threshold)
                        part = b.column(3).take(pa.array(rows[i])).cast(pa.list_(pa.float64()))
                        yield record_batch(_BALL, h[j], x[rows][i], members[rows][i], mine, part)

    return nodes.select("x", F.col("label").cast("long"), "dim", "v", F.col("members").cast("long"), "open").mapInArrow(run, _BALL_SQL)


def _in_blocks(ball: DataFrame, threshold: float, block: int) -> DataFrame:
    """(x, hub, n, others): parts of the number of nodes, and of their members,
    that the ``mine`` nodes link with; a row of n 0 for what they link with."""
    parts = lambda n: F.greatest(F.ceil(n / block), F.lit(1))
    size = ball.groupBy("hub").agg(parts(F.count_if("mine")).alias("rows"), parts(F.count("*")).alias("cols"))
    # a row per hub of a round, so HUBS at most; a shuffle by hub would keep a hub's blocks in one task
    ball = ball.join(F.broadcast(size), "hub")
    i, j = F.pmod(F.xxhash64("x"), F.col("rows")), F.pmod(F.xxhash64("x"), F.col("cols"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    sides = (ball.where("mine").select("hub", i.alias("i"), every("cols").alias("j"), F.lit(True).alias("query"), "x", "members", "v")
             .union(ball.select("hub", every("rows").alias("i"), j.alias("j"), F.lit(False), "x", "members", "v")))

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        hub, query, x, members = (group.column(c).to_numpy() for c in ("hub", "query", "x", "members"))
        v = group.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        a, c = np.flatnonzero(query), np.flatnonzero(~query)
        unit = _unit(v)
        cos = unit[a] @ unit[c].T
        # borderline pairs as everywhere else
        p, q = np.nonzero(np.abs(cos - threshold) < 1e-9)
        if len(p):
            e, f = v[a[p]], v[c[q]]
            cos[p, q] = (e * f).sum(axis=1) / (np.sqrt((e * e).sum(axis=1)) * np.sqrt((f * f).sum(axis=1)))
        near = (cos >= threshold) & (x[a][:, None] != x[c])
        n, others, seen = near.sum(axis=1), near @ members[c], c[near.any(axis=0)]
        zero = np.zeros(len(seen), np.int64)
        return pa.table([pa.array(np.concatenate(k), pa.int64()) for k in ((x[a], x[seen]), (hub[a], hub[seen]), (n, zero), (others, zero))], schema=_BLOCK)

    return sides.groupBy("hub", "i", "j").applyInArrow(run, _BLOCK_SQL)


def dense_links(nodes: DataFrame, dense: DataFrame, threshold: float, name: str, hubs: int = HUBS, block: int = BLOCK) -> DataFrame | None:
    """Step 4: (x, hub, n, others) as ``_in_blocks`` returns them, for all nodes
    of ``dense`` (x). None if there is none."""
    flagged = stage(nodes.join(dense.select("x", F.lit(True).alias("open")), "x", "left").withColumn("open", F.coalesce("open", F.lit(False))), f"{name}-open")
    left, out, r = flagged.where("open"), None, 0
    while True:
        front = _blocks(left.orderBy(F.xxhash64("x"), "x").limit(hubs))
        if not front:
            return out
        own = {k: (x[at], v[at]) for k, (x, v) in front.items() for at in [independent(v, threshold)]}
        # nodes that an earlier hub has are no query of a later one
        now = flagged if out is None else flagged.drop("open").join(left.select("x", "open"), "x", "left").withColumn("open", F.coalesce("open", F.lit(False)))
        ball = stage(_reach(now, own, threshold), f"{name}-ball{r}")
        part = stage(_in_blocks(ball, threshold, block), f"{name}-blocks{r}")
        out = part if out is None else out.union(part)
        left = stage(left.join(ball.where("mine").select("x"), "x", "left_anti"), f"{name}-left{r}")
        r += 1


def all_links(nodes: DataFrame, threshold: float, count: int, name: str, size: int = EXACT, queries: DataFrame | None = None) -> DataFrame:
    """(x, y) of every link of ``queries`` (None: of ``nodes``): each of them
    is compared with every node, about ``size`` against the table at a time."""
    parts = max(1, -(-count // size))
    queries = nodes if queries is None else queries
    out = None
    for k in range(parts):
        part = stage(compared(queries.where(F.pmod(F.xxhash64("x"), F.lit(parts)) == k), nodes, threshold), f"{name}{k}")
        out = part if out is None else out.union(part)
    return out


class Found(NamedTuple):
    links: DataFrame       # (x, y) in both directions; of a dense node some only
    degrees: DataFrame     # (x, n, others): linked nodes of every node, and their members
    edges: DataFrame       # (a, b): connect what links connect
    recall: float


def _degrees(links: DataFrame, nodes: DataFrame, threshold: float, dense: int | None, name: str) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(degrees, edges, dense nodes) of the links that a search has found."""
    many = stage(dense_nodes(links, dense), f"{name}-dense") if dense else None
    own = links if many is None else links.join(many, "x", "left_anti")
    counts = own.join(nodes.select(F.col("x").alias("y"), "members"), "y").groupBy("x").agg(F.count("*").alias("n"), F.sum("members").alias("others"))
    edges = own.select(F.col("x").alias("a"), F.col("y").alias("b"))
    blocks = dense_links(nodes, many, threshold, name) if many is not None and many.take(1) else None
    if blocks is not None:
        more = blocks.groupBy("x").agg(F.sum("n").alias("n"), F.sum("others").alias("others")).where("n > 0")
        counts = counts.union(more).groupBy("x").agg(F.max("n").alias("n"), F.max("others").alias("others"))
        edges = edges.union(blocks.select(F.col("x").alias("a"), F.col("hub").alias("b")))
    return stage(counts, f"{name}-degrees"), edges, many


def search(nodes: DataFrame, threshold: float = THRESHOLD, seed: int = 7, repairs: int = REPAIRS, dense: int | None = DENSE) -> Found:
    """Steps 2 to 5."""
    count = nodes.count()
    bits = max(1, min(40, math.ceil(math.log2(max(2, count))) - 2))
    floor, graph, many = floor_of(threshold), None, None
    for go in range(repairs):
        start = first_graph(nodes, bits, seed + go, floor).withColumn("old", F.lit(False))
        if graph is not None:
            start = start.union(graph.withColumn("old", F.lit(True)))
        graph = stage(nearest(start, threshold, most=dense).drop("old", "room"), f"nnd-first{go}")
        graph, settled = refine(graph, nodes, threshold, f"nnd{go}", dense=dense)
        one = graph.where(F.col("cos") >= threshold).select("x", "y")
        links = stage(one.union(one.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), f"nnd-links{go}")
        if settled:
            degrees, edges, many = _degrees(links, nodes, threshold, dense, f"nnd{go}")
            audits = [_share(degrees, nodes, nodes, threshold, AUDIT),
                      _share(degrees, nodes.join(degrees.select("x"), "x", "left_semi"), nodes, threshold, AUDIT)]
            share = min(found / true if true else 1.0 for true, found in audits)
            _LOG.info("audited recall %.4f in search %d", share, go)
            if share >= RECALL:
                return Found(links, degrees, edges, share)
    if dense and many is None and graph is not None:
        many = stage(dense_nodes(links, dense), "nnd-exact-dense")
    queries = nodes if many is None else nodes.join(many, "x", "left_anti")
    links = all_links(nodes, threshold, count, "nnd-exact", queries=queries)
    if many is not None:
        known = one.join(many, "x", "left_semi")
        links = links.union(links.select(F.col("y").alias("x"), F.col("x").alias("y"))).union(known).distinct()
    degrees, edges, _ = _degrees(stage(links, "nnd-all"), nodes, threshold, dense, "nnd-exact")
    return Found(links, degrees, edges, 1.0)


def links_of(nodes: DataFrame, threshold: float = THRESHOLD, seed: int = 7, repairs: int = REPAIRS) -> tuple[DataFrame, float]:
    """((x, y) of all found links in both directions, audited recall): lists
    grow without end, dense groups give all their pairs."""
    found = search(nodes, threshold, seed, repairs, dense=None)
    return found.links, found.recall


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, dense: int = DENSE) -> DataFrame:
    """Components of vectors with an equal label and a cosine of at least
    ``threshold``.

    One row per input row: vec_id, n_links (other ids linked directly, copies
    among them), component_id (smallest vec_id that links lead to), kept
    (vec_id = component_id). A vector that is null, empty, zero or holds a
    null or non-finite component, or whose label is null, links with nothing;
    vectors of different lengths do not link. A row without an id has no link
    and a null component_id, and is not kept. Repeated rows stay rows and are
    no links of each other. Labels of any type; other columns are ignored.
    Nodes with ``dense`` links are compared by blocks.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", label_code(vectors).alias("label"), v.alias("v"))
    nodes = stage(nodes_of(vectors), "nnd-nodes")
    found = search(nodes, threshold, dense=dense)
    linked = found.degrees.select("x", "others")
    comp = star_rounds(found.edges, "nnd-comp").select(F.col("node").alias("x"), "component_id")
    known = (nodes.join(linked, "x", "left").join(comp, "x", "left")
             .select("label", "v", (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n"), F.coalesce("component_id", "x").alias("c")))
    known = stage(known, "nnd-known")
    out = rows.join(known, ["label", "v"], "left")
    c = F.coalesce("c", "vec_id")
    return out.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      F.when(F.col("vec_id").isNotNull(), c).alias("component_id"), F.coalesce(F.col("vec_id") == c, F.lit(False)).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all vectors."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
f AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM f x JOIN f y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
      WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""
