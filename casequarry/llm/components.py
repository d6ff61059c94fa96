"""Connected components of an edge table.

Blocks of at most BLOCK edges are united by one task each, which leaves a spanning star
for every component of the block.  Edges that fit one block are done then; more of them
go through a round of alternating star operations (two joins and a distinct, nothing is
gathered per component) and are dealt out anew, until nothing changes.  Each step is
written to the shared folder, so the next survives a lost executor.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.llm import common as C

#: Edges that one task unites: some 200 MB in its worker.
BLOCK = 1 << 20


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) to the least node v of their component within the batches of one task."""
    above: dict = {}

    def root(node):
        top = node
        while (over := above.setdefault(top, top)) != top:
            top = over
        while node != top:
            above[node], node = top, above[node]
        return top

    kind = None
    for batch in batches:
        kind = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                above[max(a, b)] = min(a, b)
    if kind is not None:
        rows = [(n, r) for n in above if (r := root(n)) != n]
        for at in range(0, len(rows), 1 << 16):
            u, v = zip(*rows[at : at + (1 << 16)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, kind.field(0).type), pa.array(v, kind.field(1).type)], names=["u", "v"])


def _round(now: DataFrame) -> DataFrame:
    """A large-star and a small-star operation.

    Least neighbours are written before they are joined: both sides of the join are then dealt out for it
    alone, and the edges of a hub can be split.
    """
    both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = C.written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    large = C.written(large)
    low = C.written(large.groupBy("u").agg(F.min("v").alias("m")))
    small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, block: int = BLOCK) -> DataFrame:
    """(node, component) for every node of the columns u and v; component is the least node reached."""
    now = C.written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    form = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in now.schema)
    mark = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        blocks = -(-state[0] // block)
        if state == mark or not blocks:
            break
        mark = state
        dealt = now.coalesce(1) if blocks == 1 else now.repartition(blocks)
        stars = C.written(dealt.mapInArrow(united, form))
        C.remove(now)
        now = stars
        if blocks == 1:
            break
        now = C.written(_round(stars))
        C.remove(stars)
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
