"""Near-duplicate vectors: all pairs of a label at a cosine of 0.98 or more, by dual traversal of cover trees.

A tree has nested levels whose radii halve; a pair of nodes is left if even their nearest descendants, by the nodes' covering
radii, are too far apart. A label with many vectors is dealt into blocks, and each pair of blocks is one task with two trees.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, hot_limit, looked_up, table

COSINE = 0.98
#: Vectors of a block, and of a leaf, whose vectors are compared one by one.
BLOCK, LEAF = 2048, 24
#: What rounding may change in a distance of unit vectors.
ROUNDING = 1e-6


class Node:
    """center: a row; members: rows it covers; radius: of the farthest of them; children: nodes of half the radius, or None."""

    __slots__ = ("center", "members", "radius", "children")

    def __init__(self, center, members, radius, children):
        self.center, self.members, self.radius, self.children = center, members, radius, children


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ y.T), 0))


def build(x: np.ndarray, members: np.ndarray | None = None, center: int | None = None, reach: float = 2.0) -> Node:
    """The cover tree of the unit vectors x: children of a node are the centers of a greedy net of half its reach, its own first."""
    members = np.arange(len(x)) if members is None else members
    center = int(members[0]) if center is None else center
    near = _distance(x[members], x[center : center + 1])[:, 0]
    radius = float(near.max())
    if len(members) <= LEAF or radius <= ROUNDING:
        return Node(center, members, radius, None)
    while reach / 2 > radius:
        reach /= 2
    children, left, own, d = [], members, center, near
    while True:
        inside = d <= reach / 2
        inside[left == own] = True
        children.append((own, left[inside]))
        left = left[~inside]
        if not len(left):
            break
        own = int(left[0])
        d = _distance(x[left], x[own : own + 1])[:, 0]
    return Node(center, members, radius, [build(x, m, c, reach / 2) for c, m in children])


def pairs(x: np.ndarray, y: np.ndarray, a: Node, b: Node, cosine: float = COSINE):
    """Blocks (rows of x, rows of y, which of them are linked): every linked pair is in exactly one; a is b for a join with itself,
    where pairs come both ways and with themselves."""
    most = float(np.sqrt(2 - 2 * cosine)) + ROUNDING
    stack = [(a, b)]
    while stack:
        a, b = stack.pop()
        if a.children is None and b.children is None:
            linked = x[a.members] @ y[b.members].T >= cosine
            if linked.any():
                yield a.members, b.members, linked
            continue
        # the node of the larger radius opens; leaves stay as they are
        left = a.children if a.children is not None and (b.children is None or a.radius >= b.radius / 2) else [a]
        right = b.children if b.children is not None and (a.children is None or b.radius >= a.radius / 2) else [b]
        ra, rb = (np.array([n.radius for n in side]) for side in (left, right))
        cb = y[[n.center for n in right]]
        for first in range(0, len(left), 1024):
            ca = x[[n.center for n in left[first : first + 1024]]]
            close = _distance(ca, cb) <= most + ra[first : first + 1024, None] + rb[None, :]
            singles = [], []
            for i, j in zip(*(v.tolist() for v in np.nonzero(close))):
                p, q = left[first + i], right[j]
                if len(p.members) == 1 and len(q.members) == 1:
                    singles[0].append(p.members[0]), singles[1].append(q.members[0])
                else:
                    stack.append((p, q))
            if singles[0]:
                i, j = np.array(singles[0]), np.array(singles[1])
                good = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
                for p, q in zip(i[good].tolist(), j[good].tolist()):
                    yield np.array([p]), np.array([q]), np.ones((1, 1), bool)


def _compared(cosine: float):
    """Of a unit (one block, or two): for each vector its links there, weighted by copies, and one it reaches there."""

    def f(rows: pa.Table) -> pa.Table:
        rep, copies, side = (rows.column(c).to_numpy() for c in ("rep", "copies", "side"))
        width = len(rows.column("v")[0])
        flat = rows.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
        x = flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(two)
        two = one if same else two
        links, up = np.zeros(len(rep), np.int64), np.arange(len(rep))

        def find(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return int(i)

        a = build(x[one])
        b = a if same else build(x[two])
        for i, j, linked in pairs(x[one], x[two], a, b, cosine):
            i, j = one[i], two[j]
            links[i] += linked @ copies[j]
            if not same:
                links[j] += linked.T @ copies[i]
            p, q = np.nonzero(linked)
            for s, t in {(find(s), find(t)) for s, t in set(zip(up[i[p]].tolist(), up[j[q]].tolist()))}:
                s, t = find(s), find(t)
                up[max(s, t)] = min(s, t)
        if same:
            links -= copies  # a class found itself
        return pa.table({"label": rows.column("label"), "key": rows.column("key"), "rep": rep, "links": links, "to": rep[[find(i) for i in range(len(rep))]]})

    return f


def _keyed(batches):
    """(vec_id, label, v) to the same with a key of the vector's values, null where it takes no part."""
    for batch in batches:
        keys = []
        for label, v in zip(batch.column(1).to_pylist(), batch.column(2)):
            own = None
            if label is not None and v.is_valid and v.values.null_count == 0 and len(v.values):
                x = v.values.to_numpy(zero_copy_only=False)
                if np.isfinite(x).all() and x.any():
                    own = xxhash.xxh3_128_digest((x + 0.0).tobytes())
            keys.append(own)
        yield pa.record_batch([*batch.columns, pa.array(keys, pa.binary())], ["vec_id", "label", "v", "key"])


def near_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of vectors.

    Vectors are compared within a label (and a length). Null labels, null, empty or zero vectors and such with null or non-finite
    components link with nothing. Equal vectors are compared once and count as links of each other. Rows that share a vec_id are
    vectors of one node: each has its own links, one component. A null vec_id is never a link's end: no links, component_id null,
    kept. An empty table gives no rows; other columns are not read.
    """
    source = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    keyed = table(source.mapInArrow(_keyed, "vec_id long, label string, v array<double>, key binary"))
    some = keyed.where("key is not null and vec_id is not null")
    classes = some.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = table(classes.withColumn("size", F.size("v")))
    blocks = classes.groupBy("label", "size").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("key", F.lit(3)), F.col("blocks")).cast("int")
    # rows of one label come from all over, so its pairs of blocks are dealt to many tasks
    spread = looked_up(classes, blocks, ["label", "size"], "n", hot_limit(vectors.sparkSession, classes.count())).select("label", "size", "key", "rep", "copies", "v", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("label", "size", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("side"), "key", "rep", "copies", "v")
    found = table(spread.groupBy("label", "size", "lo", "hi").applyInArrow(_compared(cosine), "label string, key binary, rep long, links long, to long"))
    links = found.groupBy("label", "key").agg(F.sum("links").alias("links"))
    classes = classes.select("label", "key", "rep", "copies").join(links, ["label", "key"])
    some, limit = some.select("vec_id", "label", "key"), hot_limit(vectors.sparkSession, keyed.count())
    # classes of several labels can have one vec_id only if ids repeat: they are one node
    own = looked_up(some, classes.select("label", "key", "rep", "copies"), ["label", "key"], "copies", limit).select("vec_id", "rep").distinct()
    repeated = own.groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a != b").select("vec_id", "a")
    twice = own.join(repeated, "vec_id").select("a", F.col("rep").alias("b"))
    roots = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")).unionByName(twice).where("a != b"))
    classes = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").select("label", "key", "copies", F.coalesce("root", "rep").alias("root"), (F.col("links") + F.col("copies") - 1).alias("n_links"))
    linked = looked_up(some, classes, ["label", "key"], "copies", limit)
    # of a repeated id each vector has its own links, but one component
    shared = linked.groupBy("vec_id").agg(F.min("root").alias("root"))
    alone = keyed.where("key is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    out = linked.select("vec_id", "n_links").unionByName(alone).join(shared, "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    """op8: all embeddings."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = r"""
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
u AS (SELECT *, sqrt(list_dot_product(x, x)) AS n FROM v),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.x, b.x) / (a.n * b.n) >= 0.98),
r AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.vec_id),
c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id)
SELECT c.vec_id, (SELECT count(*) FROM e WHERE e.a = c.vec_id)::BIGINT AS n_links, c.root AS component_id, c.root = c.vec_id AS kept FROM c
"""
