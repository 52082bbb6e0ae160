"""Connected components of an edge table.

1. Every task contracts its own edges by union-find, batch by batch, so that
   repeated and redundant links leave before the first shuffle.
2. A forest of at most ``FINISH`` edges, counted while it is written, is
   finished by one task (bounded by that number).
3. A larger one goes through alternating large-star and small-star rounds
   (Kiveris et al., 2014): every step is one aggregate and one join, the edge
   count never grows, and the number of rounds is logarithmic. A node with more
   than 1/1,000 of the edges, so at most 2,000 of them, learns its least
   neighbour by a broadcast and its edges are not shuffled by their node.

Each step's edges are written to the shared checkpoint folder; the number of
edges and a hash sum are observed during that write. No link and no component
reaches the driver.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import out_batch, store

#: Edges that one task finishes alone.
FINISH = 250_000
#: Edges a task contracts at once.
BATCH = 50_000


def _forest(parent: dict, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _union(parent: dict, us: list, vs: list) -> None:
    for u, v in zip(us, vs):
        if u not in parent:
            parent[u] = u
        if v not in parent:
            parent[v] = v
        a, b = _forest(parent, u), _forest(parent, v)
        if a != b:
            parent[max(a, b)] = min(a, b)


def _contracted(edges: DataFrame, whole: bool) -> DataFrame:
    """``u, v`` with v the least node that u is linked with inside its batch
    (``whole``: inside its partition). A node without a link is ``u = v``;
    with ``whole`` every least node is."""
    def run(batches):
        parent: dict = {}
        kind = None

        def emit():
            rows = [(x, _forest(parent, x)) for x in list(parent)]
            heads = {v for u, v in rows if u != v}
            rows = [(u, v) for u, v in rows if whole or u != v or u not in heads]
            for at in range(0, len(rows), BATCH):
                yield out_batch([("u", kind), ("v", kind)], list(zip(*rows[at:at + BATCH])))

        held = 0
        for b in batches:
            kind = b.schema.field(0).type
            _union(parent, b.column(0).to_pylist(), b.column(1).to_pylist())
            held += b.num_rows
            if held >= BATCH and not whole:
                yield from emit()
                parent, held = {}, 0
        if parent:
            yield from emit()

    return edges.mapInArrow(run, edges.schema)


def _stored(e: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """The written table, its number of rows and their hash sum."""
    seen = Observation()
    e = store(e.observe(seen, F.count(F.lit(1)).alias("n"),
                        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")), name)
    got = seen.get
    return e, (got["n"] or 0, got["h"])


def _with_least(e: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """``e`` with the column m of ``least`` (u, m, c); the few nodes with a
    large count c by a broadcast of at most 2,000 rows."""
    many = F.col("c") * 1000 > F.lit(n)
    hot = F.broadcast(least.where(many).select("u", F.col("m").alias("hot")))
    e = e.join(hot, "u", "left")
    cold = e.where("hot IS NULL").drop("hot").join(least.where(~many).select("u", "m"), "u")
    return cold.unionByName(e.where("hot IS NOT NULL").withColumnRenamed("hot", "m"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", finish: int = FINISH,
                         spanning: bool = False, native: bool = False) -> DataFrame:
    """``node, component`` for every node of ``edges`` (undirected).

    ``spanning``: the tasks that make the edges emit spanning links already, so
    they are not contracted in a second Python step of the same stage.
    ``native``: star rounds only, without any Python step.

    ``component`` is the least node of the component. Edges with a NULL end
    are ignored, a self-edge names a node, repeated edges count once; an empty
    table gives an empty one."""
    a, b = F.col(src), F.col(dst)
    e = edges.where(a.isNotNull() & b.isNotNull())
    if spanning or native:
        e = e.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    else:
        e = _contracted(e.select(a.alias("u"), b.alias("v")), False)
    e, now = _stored(e.distinct(), "cc-edges")
    out = [F.col("u").alias("node"), F.col("v").alias("component")]
    if now[0] <= finish and not native:
        return store(_contracted(e.coalesce(1), True).select(*out), "cc-components")
    loops = e.where("u = v")
    e = e.where("u <> v")
    seen = None
    while now != seen:
        seen, n = now, now[0]
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c")).select(
            "u", F.least("u", "m").alias("m"), "c")
        large = _with_least(both, least, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store((large if native else _contracted(large, False).where("u <> v")).distinct(), "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("c"))
        small = _with_least(large, least, n).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e, now = _stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    rest = loops.select(*out)
    return e.select(*out).unionByName(roots.unionByName(rest).distinct()).groupBy("node").agg(
        F.min("component").alias("component"))
