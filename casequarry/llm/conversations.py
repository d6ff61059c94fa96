"""Prefix trie of conversations, read off the sorted conversations' common prefixes.

Every conversation becomes one binary key, 24 bytes a turn (MD5 of role and text, text
bytes), and equal conversations become one row.  The rows are sorted by ranges into
blocks.  LCP[i] is the number of turns that row i shares with the row before it; the trie's
branching nodes are the merged intervals of the Cartesian tree over it: a maximal run of
rows between the nearest smaller values on both sides.  Each block finds these by a stack.  What
stays open in a block asks the minima of all blocks for the nearest block with a smaller value,
and that block's chain of prefix or suffix minima for the place.  Pieces of one node that
several blocks report are merged, sums come from prefix sums at an interval's two ends, and
the depths between a node and its parent, where nothing branches, are added at the end.

Memory and skew: a conversation's digests are one record, as a document's text is: 24 bytes a
turn, its texts stay behind.  Copies are counted before they are moved.  A block is a range of the sort; rows that
share their first 64 turns are not split.  One row for each block reaches the driver, and there are at
most ``blocks``.  A node of very many children is split by block until its pieces, one row a
block, are merged.  The list of a node's ends is hashed as a stream of pieces of at most 65,536 ids.

Defined results: rows without a conv_id belong to no conversation and are left out.  Null roles and
texts are empty.  Tied turns are ordered by role, the text's first 32 characters and its digest;
repeated rows are repeated turns.  Without conversations there is no node, not even a root.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.llm import common as C

RECORD = 24
#: Turns of a key that the ranges of the sort look at.
RANGE_TURNS = 64
#: Most blocks, and ids in one piece of a list of ends.
BLOCKS, PIECE = 1 << 14, 1 << 16

_NODE = (
    "v bigint, p bigint, low bigint, n bigint, c2 bigint, c3 bigint, t bigint, kids bigint, leaves bigint, ends binary, "
    "base bigint, bytes array<bigint>, parent bigint, parent_low bigint"
)
_BLOCK = (
    f"kind string, part bigint, pos bigint, {_NODE}, least bigint, l bigint, r bigint, lv bigint, rv bigint, l_gid bigint, r_gid bigint, "
    "l_low bigint, r_low bigint, s1l bigint, s2l bigint, s3l bigint, s4l bigint, s1r bigint, s2r bigint, s3r bigint, s4r bigint, l_len bigint"
)
_FIELDS = [x.split() for x in _BLOCK.split(", ")]
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
_OUT = pa.schema([(name, _KINDS[kind]) for name, kind in _FIELDS])
_FAR = 32  # bits of a row's place within its block


def _said(turns: DataFrame) -> DataFrame:
    """Turns as what orders them and 48 hexadecimal digits each; the texts stay behind."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    size = F.lpad(F.hex(F.octet_length(text)), 16, "0")
    return turns.where("conv_id is not null").select("conv_id", "turn", role.alias("role"), F.substring(text, 1, 32).alias("head"), F.concat(digest, size).alias("said"))


def _in_order() -> Column:
    parts = F.struct(F.col("turn").isNotNull().alias("timed"), F.coalesce("turn", F.lit(0)).alias("turn"), "role", "head", "said")
    return F.transform(F.array_sort(F.collect_list(parts)), lambda x: x["said"])


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): a conversation's turns in order, each as 48 hexadecimal digits."""
    return _said(turns).groupBy("conv_id").agg(_in_order().alias("turns"))


def branched(turns: DataFrame, every: int = 5, modulus: int = 9) -> DataFrame:
    """(conv_id, turns) of conversations rebuilt as branches of conversation ``c - c % every``.

    The first h turns come from there and the rest from the conversation's own after its first h; h depends on the id's checksum.
    """
    said = _said(turns).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    # Dealt out once by the shared conversation, which serves the grouping and the join.
    own = said.repartition("base").groupBy("base", "conv_id").agg(_in_order().alias("turns"))
    heads = own.where(F.col("conv_id") == F.col("base")).select("base", F.slice("turns", 1, modulus - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % modulus).cast("int")
    rest = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast("array<string>"))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, rest).alias("turns"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (sid, conv_id) as comma-joined texts of at most PIECE ids of one sid."""
    for batch in batches:
        sid, ids = batch.column(0), batch.column(1)
        n = len(sid)
        if not n:
            continue
        new = np.concatenate(([True], pc.not_equal(sid[1:], sid[: n - 1]).to_numpy(zero_copy_only=False)))
        cuts = np.flatnonzero(new)
        cuts = np.unique(np.concatenate([np.arange(a, b, PIECE) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]))
        said = pc.cast(ids, pa.string()).to_pylist()
        lists = [",".join(said[a:b]) for a, b in zip(cuts, [*cuts[1:], n], strict=True)]
        yield pa.RecordBatch.from_arrays([sid.take(pa.array(cuts)), ids.take(pa.array(cuts)), pa.array(lists)], names=["sid", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each sid, which come in order."""
    current, state = None, None
    for batch in batches:
        done: list[tuple[bytes, bytes]] = []
        for sid, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if sid != current:
                if state is not None:
                    done.append((current, state.digest()))
                current, state = sid, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.binary()) for i in (0, 1)], names=["sid", "ends"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([current], pa.binary()), pa.array([state.digest()], pa.binary())], names=["sid", "ends"])


def _distinct(convs: DataFrame) -> DataFrame:
    """(key, copies, least, ends): each distinct sequence with its conversations counted and their id list hashed."""
    keyed = C.written(convs.select("conv_id", F.unhex(F.array_join("turns", "")).alias("key")).withColumn("sid", F.unhex(F.md5("key"))))
    groups = C.written(keyed.groupBy("sid").agg(F.count("*").alias("copies"), F.min("conv_id").alias("least"), F.max("conv_id").alias("most"), F.min("key").alias("key")))
    few = F.when(F.col("copies") == 1, F.col("least").cast("string")).otherwise(F.concat_ws(",", "least", "most"))
    short = groups.where("copies <= 2").select("key", "copies", "least", F.unhex(F.sha2(few, 256)).alias("ends"))
    many = groups.where("copies > 2")
    ids = keyed.select("sid", "conv_id").join(many.select("sid"), "sid", "left_semi")
    pieces = ids.repartitionByRange("sid", "conv_id").sortWithinPartitions("sid", "conv_id").mapInArrow(_pieces, "sid binary, first bigint, ids string")
    ends = pieces.repartition("sid").sortWithinPartitions("sid", "first").mapInArrow(_digests, "sid binary, ends binary")
    return short.unionByName(many.join(ends, "sid").select("key", "copies", "least", "ends"))


def _digested(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of turns of each key, its start among all turns, the turns' digests and their text bytes."""
    turns = np.array([len(k) // RECORD for k in keys], np.int64)
    flat = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, RECORD)
    digest = np.ascontiguousarray(flat[:, :16]).view(np.uint64).reshape(-1, 2)
    size = np.ascontiguousarray(flat[:, 16:]).view(">i8").reshape(-1).astype(np.int64)
    return turns, np.cumsum(turns) - turns, digest, size


def _shared(turns: np.ndarray, first: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Number of leading turns that each key shares with the one before it; entry 0 is -1."""
    out = np.full(len(turns), -1, np.int64)
    if len(turns) > 1:
        least = np.minimum(turns[1:], turns[:-1])
        out[1:] = least
        owner = np.repeat(np.arange(len(least)), least)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(least) - least, least)
        apart = np.flatnonzero((digest[first[1:][owner] + at] != digest[first[:-1][owner] + at]).any(1))
        np.minimum.at(out[1:], owner[apart], at[apart])
    return out


class _Group:
    """A run of equal LCP values: value, first and last place, number, place of the smaller value before it, least id since then."""

    __slots__ = ("v", "first", "last", "count", "before", "low")

    def __init__(self, v: int, first: int, before: int, low: int | None):
        self.v, self.first, self.last, self.count, self.before, self.low = v, first, first, 1, before, low


def _block(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Nodes that end within a block, pieces of those that do not, and the block's chains of minima."""
    part = key[0].as_py()
    side = table["side"].to_numpy()
    heads = table.filter(pc.equal(table["side"], 0)).to_pylist()
    real = table.filter(pa.array(side == 1))
    real = real.take(pc.sort_indices(real, [("key", "ascending")]))
    keys = real["key"].to_pylist()
    edge = heads[0] if heads else {}
    before, after, next_part = edge.get("before"), edge.get("after"), edge.get("next_part")
    n = len(keys)
    turns, first, digest, size = _digested(([before] if before is not None else []) + keys + ([after] if after is not None else []))
    lcp = _shared(turns, first, digest)
    skip = int(before is not None)
    a = np.concatenate((lcp[skip:], [-1] if after is None else []))[: n + 1].astype(np.int64)  # a[i]: with the row before, a[n]: of the next block's first
    if not skip:
        a[0] = -1
    turns, first = turns[skip : skip + n], first[skip : skip + n]
    sums = np.concatenate(([0], np.cumsum(size)))
    upto = lambda i, d: sums[first[i] + d] - sums[first[i]]  # noqa: E731  bytes of the first d turns of row i
    rows = np.arange(n)
    total = upto(rows, turns)
    copies, least = (real[c].to_numpy().astype(np.int64) for c in ("copies", "least"))
    ends = real["ends"].to_pylist()
    fresh = total - upto(rows, np.maximum(a[:n], 0))
    leaf = (turns > a[1:]).astype(np.int64)
    s1, s2, s3, s4 = (np.concatenate(([0], np.cumsum(x))) for x in (copies, copies * total, fresh, leaf))
    pos = lambda i: (part << _FAR) | int(i)
    out: list[dict] = []

    def left(i: int) -> dict:
        return {"l": pos(i), "lv": int(a[i]), "s1l": int(s1[i]), "s2l": int(s2[i]), "s3l": int(s3[i + 1]), "s4l": int(s4[i]), "t": int(total[i]), "ends": ends[i], "l_len": int(turns[i])}

    def right(i: int) -> dict:
        return {"r": pos(i), "rv": int(a[i]), "s1r": int(s1[i]), "s2r": int(s2[i]), "s3r": int(s3[i]), "s4r": int(s4[i])}

    group_of = np.full(n + 1, -1, np.int64)  # first place of the run that a place belongs to
    node_low: dict[int, int] = {}
    closed: list[tuple[_Group, int]] = []
    opened: list[tuple[_Group, int | None]] = []
    stack: list[_Group] = []
    prefix: list[int] = []
    for i in range(n + 1):
        v, carry = int(a[i]), int(least[i - 1]) if i else None
        while stack and stack[-1].v > v:
            g = stack.pop()
            g.low = carry = min(g.low, carry) if g.low is not None else carry
            (closed if g.before >= 0 else opened).append((g, i))
        if i == n:
            break
        if stack and stack[-1].v == v:
            g = stack[-1]
            g.last, g.count, g.low = i, g.count + 1, min(g.low, carry) if g.low is not None else carry
        else:
            if not stack:
                prefix.append(i)
            stack.append(_Group(v, i, stack[-1].last if stack else -1, carry))
        group_of[i] = stack[-1].first
    if next_part is None:
        prefix.append(n)  # nothing follows: the end is smaller than any value
    # What is still open covers the block's end.
    carry = int(least[n - 1])
    suffix = [g.last for g in stack]
    for g in reversed(stack):
        g.low = carry = min(g.low, carry) if g.low is not None else carry
        if g.v >= 0:
            opened.append((g, None))
    gid = lambda i: pos(group_of[i]) if i < n else (next_part << _FAR if next_part is not None else None)

    def node(i: int, l: int, r: int, v: int, low: int, kids: int, p: int, parent: int) -> dict:  # noqa: E741
        return {
            "kind": "node", "part": part, "v": v, "p": p, "low": low, "n": int(s1[r] - s1[l]), "c2": int(s2[r] - s2[l]), "c3": int(s3[r] - s3[l + 1]),
            "t": int(total[l]), "kids": kids, "leaves": int(s4[r] - s4[l]), "ends": ends[l] if turns[l] == v else None,
            "base": max(p, 0), "bytes": [int(x) for x in upto(l, np.arange(max(p, 0), v))], "parent": parent, "pos": i,
        }

    for g, r in closed:
        l = g.before  # noqa: E741
        p, at = (int(a[l]), l) if a[l] >= a[r] else (int(a[r]), r)
        node_low[pos(g.first)] = g.low
        out.append(node(pos(g.first), l, r, g.v, g.low, g.count + 1 - int(turns[l] == g.v), p, gid(at) if p >= 0 else None))
    for i in np.flatnonzero(turns > np.maximum(a[:n], a[1:])).tolist():
        p, at = (int(a[i]), i) if a[i] >= a[i + 1] else (int(a[i + 1]), i + 1)
        out.append(node(-1, i, i + 1, int(turns[i]), int(least[i]), 0, p, gid(at) if p >= 0 else None))
    for row in out:
        row["parent_low"] = node_low.get(row["parent"])
    for g, r in opened:
        if g.v < 0:
            continue
        known = int(a[r]) if r is not None else int(a[g.before]) if g.before >= 0 else 0
        share = g.before if g.before >= 0 else 0  # a row that has the node's turns
        row = {"kind": "open", "part": part, "pos": pos(g.first), "v": g.v, "kids": g.count, "low": g.low, "base": max(known, 0)}
        row["bytes"] = [int(x) for x in upto(share, np.arange(max(known, 0), g.v))]
        if g.before >= 0:
            row |= left(g.before) | {"l_gid": gid(g.before)}
        if r is not None:
            row |= right(r) | {"r_gid": gid(r)}
            if r == n and next_part is not None:
                row["r"] = next_part << _FAR
        out.append(row)
    low = np.minimum.accumulate(least)
    high = np.minimum.accumulate(least[::-1])[::-1]
    out += [{"kind": "suffix", "part": part, "pos": pos(i), "l_gid": gid(i), "l_low": int(high[i])} | left(i) for i in suffix]
    out += [{"kind": "prefix", "part": part, "pos": pos(i), "r_gid": gid(i), "r_low": int(low[i - 1]) if i else None} | right(i) for i in prefix]
    out.append({"kind": "block", "part": part, "v": int(a[: n + (next_part is None)].min()), "least": int(least.min()), "s1r": int(s1[n]), "s2r": int(s2[n]), "s3r": int(s3[n]), "s4r": int(s4[n])})
    return pa.Table.from_pylist(out, _OUT)


class Minima:
    """Minima over runs of blocks, by runs of doubling length."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while len(self.levels[-1]) > (step := 1 << (len(self.levels) - 1)):
            last = self.levels[-1]
            self.levels.append(np.minimum(last[:-step], last[step:]))

    def smaller_before(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The nearest place before ``at`` with a value below ``v``; -1 if none."""
        at = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            start = at - (1 << k)
            jump = (start >= 0) & (self.levels[k][np.clip(start, 0, len(self.levels[k]) - 1)] >= v)
            at = np.where(jump, start, at)
        return at - 1

    def smaller_after(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        """The nearest place after ``at`` with a value below ``v``; the number of values if none."""
        at, n = at + 1, len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            jump = (at + (1 << k) <= n) & (self.levels[k][np.clip(at, 0, len(self.levels[k]) - 1)] >= v)
            at = np.where(jump, at + (1 << k), at)
        return at

    def least(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value of start <= i < end; the greatest number where that is empty."""
        out = np.full(len(start), np.iinfo(np.int64).max)
        for k, level in enumerate(self.levels):
            fits = (end - start >= 1 << k) & (end - start < 2 << k)
            if fits.any():
                out[fits] = np.minimum(level[start[fits]], level[end[fits] - (1 << k)])
        return out


def _targets(shared):
    """Blocks in which the two ends of an open node lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, low = shared.value
        low = Minima(low)
        for batch in batches:
            at = np.searchsorted(parts, batch["part"].to_numpy())
            v = batch["v"].to_numpy()
            given = [batch[c].is_valid().to_numpy(zero_copy_only=False) for c in ("l", "r")]
            lb = np.where(given[0], at, low.smaller_before(at, v))
            rb = np.where(given[1], at, np.minimum(low.smaller_after(at, v), len(parts) - 1))
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts[lb]), pa.array(parts[rb])], names=[*names, "lb", "rb"])

    return run


def _sums(shared):
    """Sums of blocks before a block and the least id of the blocks between two blocks."""

    @F.arrow_udf("d1 bigint, d2 bigint, d3 bigint, d4 bigint, low bigint")
    def between(lb: pa.Array, rb: pa.Array) -> pa.Array:
        parts, least, totals = shared.value
        l, r = (np.searchsorted(parts, x.to_numpy()) for x in (lb, rb))  # noqa: E741
        d = [pa.array(t[r] - t[l]) for t in totals]
        low = Minima(least).least(np.minimum(l + 1, r), r)
        return pa.StructArray.from_arrays([*d, pa.array(low)], names=["d1", "d2", "d3", "d4", "low"])

    return between


def prefix_trie(convs: DataFrame, blocks: int | None = None) -> DataFrame:
    """One row for each distinct prefix of (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends."""
    spark = convs.sparkSession
    C.tune(spark)
    blocks = min(BLOCKS, blocks or int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _distinct(convs).withColumn("head", F.substring("key", 1, RECORD * RANGE_TURNS))
    ranged = C.written(rows.repartitionByRange(blocks, "head").drop("head").withColumn("part", F.spark_partition_id().cast("bigint")))
    # One row for each block from here: at most ``blocks``.
    order = W.orderBy("part")
    edges = ranged.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    edges = edges.select("part", F.lag("last").over(order).alias("before"), F.lead("first").over(order).alias("after"), F.lead("part").over(order).alias("next_part"))
    none = {"key": "binary", "copies": "bigint", "least": "bigint", "ends": "binary"}
    edges = edges.select("part", F.lit(0).alias("side"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()), "before", "after", "next_part")
    more = [F.lit(None).cast("binary").alias(c) for c in ("before", "after")]
    dealt = ranged.select("part", F.lit(1).alias("side"), *none, *more, F.lit(None).cast("bigint").alias("next_part")).unionByName(edges)
    found = C.written(dealt.groupBy("part").applyInArrow(_block, _BLOCK))

    info = found.where("kind = 'block'").select("part", "v", "least", "s1r", "s2r", "s3r", "s4r").orderBy("part").toArrow()
    parts, low, least, *totals = (info[c].to_numpy().astype(np.int64) for c in info.column_names)
    before = [np.cumsum(t) - t for t in totals]
    send = spark.sparkContext.broadcast
    opened = found.where("kind = 'open'").drop("kind", "least", "parent", "parent_low", "p", "n", "c2", "c3", "leaves", "l_low", "r_low")
    aimed = opened.mapInArrow(_targets(send((parts, low))), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in opened.schema) + ", lb bigint, rb bigint")
    lefts = ("l", "lv", "l_gid", "s1l", "s2l", "s3l", "s4l", "t", "ends", "l_len", "l_low")
    rights = ("r", "rv", "r_gid", "s1r", "s2r", "s3r", "s4r", "r_low")
    chain = lambda kind, names, name: (
        found.where(F.col("kind") == kind).groupBy("part").agg(F.array_sort(F.collect_list(F.struct("pos", *names))).alias(name))
    )
    joined = aimed.join(chain("suffix", lefts, "ls").withColumnRenamed("part", "lb"), "lb", "left").join(chain("prefix", rights, "rs").withColumnRenamed("part", "rb"), "rb", "left")
    joined = joined.withColumn("lc", F.get(F.reverse(F.filter("ls", lambda x: x["lv"] < F.col("v"))), F.lit(0)))
    joined = joined.withColumn("rc", F.get(F.filter("rs", lambda x: x["rv"] < F.col("v")), F.lit(0)))
    here_l, here_r = F.col("l").isNotNull(), F.col("r").isNotNull()
    pick = lambda here, names, c: [F.when(here, F.col(x) if x in opened.columns else F.lit(None)).otherwise(F.col(f"{c}.{x}")).alias(x) for x in names]
    solved = joined.select(
        "v", "kids", "low", "base", "bytes", "lb", "rb", "pos", *pick(here_l, lefts, "lc"), *pick(here_r, rights, "rc"),
        _sums(send((parts, least, before)))("lb", "rb").alias("d"),
    )
    solved = solved.select(
        "pos", "l", "v", "kids", "base", "bytes", "t", "ends", "l_len",
        F.greatest("lv", "rv").alias("p"),
        F.when(F.col("lv") >= F.col("rv"), F.col("l_gid")).otherwise(F.col("r_gid")).alias("parent"),
        F.least("low", "l_low", "r_low", "d.low").alias("low"),
        *((F.col(f"s{i}r") - F.col(f"s{i}l") + F.col(f"d.d{i}")).alias(f"x{i}") for i in (1, 2, 3, 4)),
    )
    solved = C.written(solved)
    # The pieces of a node agree in all but the number of equal values that each block saw.
    first = [F.first(c).alias(c) for c in ("t", "l_len", "p", "low", "x1", "x2", "x3", "x4")]
    merged = solved.groupBy("l", "v").agg(F.sum("kids").alias("kids"), *first, F.min_by(F.struct("base", "bytes", "ends"), F.struct("base", "pos")).alias("b"), F.min_by("parent", "pos").alias("parent"))
    whole = merged.select(
        "v", "p", "low", F.col("x1").alias("n"), F.col("x2").alias("c2"), F.col("x3").alias("c3"), "t",
        (F.col("kids") + 1 - (F.col("l_len") == F.col("v")).cast("int")).alias("kids"), F.col("x4").alias("leaves"),
        F.when(F.col("l_len") == F.col("v"), F.col("b.ends")).alias("ends"), "b.base", "b.bytes", "parent", F.lit(None).cast("bigint").alias("parent_low"),
    )
    nodes = found.where("kind = 'node'").select(*whole.columns)
    named = solved.select(F.col("pos").alias("parent"), F.col("low").alias("named"))
    asking = nodes.where("parent_low is null and parent is not null").unionByName(whole.where("parent is not null"))
    asked = asking.join(named, "parent", "left").withColumn("parent_low", F.col("named")).select(*whole.columns)
    settled = nodes.where("parent_low is not null or parent is null").unionByName(whole.where("parent is null")).unionByName(asked)
    deep = settled.withColumn("depth", F.explode(F.sequence(F.col("p") + 1, F.col("v"))))
    earlier = F.when(F.col("depth") > 0, F.get("bytes", (F.col("depth") - 1 - F.col("base")).cast("int"))).otherwise(0)
    deepest = F.col("depth") == F.col("v")
    return deep.withColumn("e", earlier).select(
        F.col("low").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("p") + 1, F.col("parent_low")).otherwise(F.col("low")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(deepest, F.col("kids")).otherwise(1).cast("bigint").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("c2") - F.col("n") * F.col("e") - F.col("t") + F.col("e") - F.col("c3")).alias("saved_tokens"),
        F.when(deepest, F.col("ends")).alias("ends"),
    )
