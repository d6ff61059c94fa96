"""Ranked lexical search by windowed bucket scoring.

Documents are numbered where they are read and dealt into shards.  A shard's postings are walked in
windows of WINDOW documents: for each query, its terms' postings within the window are added into one
array that fits a core's cache, the terms' bit sets are united into the window's occupancy, the occupied places are
harvested into the query's heap and the array is cleared for the next query.  The best of
all shards are ranked together.

Queries come in numbered blocks; a pair of a shard and a block is one group, so any number of queries has the
same plan.  Only words that a query may use leave a document: a fixed-size bit set
passes them, and a join on the words themselves decides.  Weights and scores are 64-bit integers.

Memory and skew: a group holds at most SHARD documents' postings of at most ITEMS queries' words, so a frequent
word is split over all shards; a group passes on at most k rows a query, and the final ranking
drops all but k in each task before it shuffles.  N, L and the number of queries reach the driver.

Defined results: a null text has no terms; documents without terms count nowhere.  Repeated document rows are ranked apart, a null
doc_id after others of the same score.  Repeated query rows count once; two texts under one id are two rankings.  A query without
terms, or whose terms no document has, has no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casequarry.llm import common as C

WINDOW, SHARD, ITEMS = 1 << 13, 1 << 15, 1 << 10
_LAST = np.iinfo(np.int64).max


def _picked(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The given stretches of UTF-8 bytes as strings."""
    size = ends - starts
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(low[at]))).cast(pa.string())


def _counted(texts: C.Texts, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Words of each text, and owner, word, hash and count of its distinct words that the bit set passes."""
    low = C.lower_bytes(texts.data)
    starts, ends, counts = C.words(texts, C.ALNUM, low)
    owner = np.repeat(np.arange(len(counts)), counts)
    hashes = C.span_hash(C.byte_sums(low), starts, ends)
    if bits is not None:
        kept = np.flatnonzero(C.in_filter(bits, hashes))
        owner, hashes, starts, ends = owner[kept], hashes[kept], starts[kept], ends[kept]
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(o)), bool), (o[1:] != o[:-1]) | (h[1:] != h[:-1]))))
    one = order[new]
    return counts, o[new], _picked(low, starts[one], ends[one]), h[new], np.diff(np.append(new, len(o)))


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for texts in C.passes(batch.column(1)):
            _, owner, word, h, n = _counted(texts, None)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner + at)), word, pa.array(h.view(np.int64)), pa.array(n)], names=["no", "term", "h", "n"])
            at += len(texts)


def _terms(shared):
    @F.arrow_udf("n bigint, terms array<struct<term:string,tf:bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = shared.value
        for column in batches:
            totals, lists = [np.zeros(0, np.int64)], []
            for texts in C.passes(column):
                counts, owner, word, _, n = _counted(texts, bits)
                offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                totals.append(counts)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([word, pa.array(n)], names=["term", "tf"])))
            kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int64())]))
            terms = pa.concat_arrays([x.cast(kind) for x in lists]) if lists else pa.array([], kind)
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(totals), pa.int64()), terms], names=["n", "terms"])

    return run


class _Best:
    """A heap of the k highest (score, document), equal scores by the smaller document."""

    def __init__(self, k: int):
        self.k, self.heap = k, []

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        full = len(self.heap) == self.k
        keep = scores >= (self.heap[0][0] if full else 1)
        scores, docs = scores[keep], docs[keep]
        if len(scores) > self.k:  # ties of the k-th stay
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, docs = scores[keep], docs[keep]
        for entry in zip(scores.tolist(), (-docs).tolist(), strict=True):
            if len(self.heap) < self.k:
                heapq.heappush(self.heap, entry)
            else:
                heapq.heappushpop(self.heap, entry)


def _scorer(k: int, window: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: slot, doc_id, tid, c of a shard's postings; right: one row of the block's queries, terms and weights."""
        (row,) = right.select(["nos", "tids", "ws"]).to_pylist() or [{"nos": [], "tids": [], "ws": []}]
        nos, tids, ws = (np.array(row[c], np.int64) for c in ("nos", "tids", "ws"))
        slot, tid, c = (left[n].to_numpy().astype(np.int64) for n in ("slot", "tid", "c"))
        docs = np.zeros(SHARD, np.int64)
        docs[slot] = left["doc_id"].fill_null(_LAST).to_numpy()
        known, term = np.unique(tid, return_inverse=True)
        order = np.lexsort((slot, term, slot // window))
        slot, term, c = slot[order], term[order], c[order]
        # Queries by number, with those of their terms that the shard has.
        at = np.searchsorted(known, tids)
        here = (known[np.minimum(at, len(known) - 1)] == tids) if len(known) else np.zeros(len(tids), bool)
        nos, at, ws = nos[here], at[here], ws[here]
        order = np.argsort(nos, kind="stable")
        nos, at, ws = nos[order], at[order], ws[order]
        cuts = np.flatnonzero(np.concatenate((np.ones(min(1, len(nos)), bool), nos[1:] != nos[:-1])))
        queries = [(int(nos[a]), at[a:b], ws[a:b]) for a, b in zip(cuts, [*cuts[1:], len(nos)], strict=True)]
        best = {no: _Best(k) for no, _, _ in queries}
        sums = np.zeros(window, np.int64)
        edges = np.searchsorted(slot // window, np.arange(-(-SHARD // window) + 1))
        for w, (lo, hi) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if lo == hi:
                continue
            place, own = slot[lo:hi] - w * window, c[lo:hi]
            starts = np.searchsorted(term[lo:hi], np.arange(len(known) + 1))
            size = np.diff(starts)
            there = np.flatnonzero(size)
            bits = np.zeros((len(there), window), bool)
            bits[np.repeat(np.arange(len(there)), size[there]), place] = True
            bits = np.packbits(bits, axis=1)
            nth = np.full(len(known), -1)
            nth[there] = np.arange(len(there))
            for no, terms, weights in queries:
                mine = nth[terms] >= 0
                if not mine.any():
                    continue
                occupied = np.bitwise_or.reduce(bits[nth[terms[mine]]], axis=0)
                for t, weight in zip(terms[mine].tolist(), weights[mine].tolist(), strict=True):
                    a, b = starts[t], starts[t + 1]
                    sums[place[a:b]] += weight * own[a:b]  # a word stands once for a document
                full = np.flatnonzero(np.unpackbits(occupied))
                best[no].add(sums[full], docs[w * window + full])
                sums[full] = 0
        out = [(no, None if -doc == _LAST else -doc, score) for no, b in best.items() for score, doc in b.heap]
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(("no", "doc_id", "score"))})

    return run


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", block_items: int = ITEMS, window: int = WINDOW) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest documents of each query (item_id, text); ``id_col`` is a bigint."""
    spark = docs.sparkSession
    C.tune(spark)
    listed = C.written(queries.select("item_id", F.col("text").alias("q")).distinct().withColumn("no", F.monotonically_increasing_id()))
    blocks = max(1, -(-listed.count() // block_items))
    block = F.pmod(F.xxhash64("no"), F.lit(blocks)).alias("block")
    asked = C.written(listed.select("no", "q").mapInArrow(_query_terms, "no bigint, term string, h bigint, n bigint").select("no", block, "term", "h", "n"))
    bits = spark.sparkContext.broadcast(C.membership_filter(asked, "h"))

    row = F.monotonically_increasing_id()
    read = C.written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"))
        .select("doc_id", _terms(bits)("t").alias("f"))
        .select(row.alias("row"), "doc_id", "f.n", "f.terms")
    )
    total = read.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("words")).first()
    m = F.expr(f"75 + (25 * n * {total.docs}L) div {max(1, total.words)}L")
    words = C.written(asked.select("block", "term").distinct().withColumn("tid", F.monotonically_increasing_id()))
    spread = read.where(F.size("terms") > 0).select(
        F.floor(F.col("row") / SHARD).alias("shard"), (F.col("row") % SHARD).cast("int").alias("slot"), "doc_id", m.alias("m"), F.explode("terms").alias("p")
    )
    posted = C.written(
        spread.select("shard", "slot", "doc_id", F.col("p.term").alias("term"), F.expr("(1000000000L * p.tf) div (1000L * p.tf + 12L * m)").alias("c"))
        .join(words, "term")
        .select("shard", "block", "slot", "doc_id", "tid", "c")
    )
    rarity = F.floor(1000 * F.log(F.lit(2.0 * total.docs + 2) / (2 * F.col("df") + 1)))
    weighed = posted.groupBy("tid").agg(F.count("*").alias("df")).select("tid", rarity.alias("w"))
    entries = asked.join(words, ["block", "term"]).join(weighed, "tid").select("block", "no", "tid", (F.col("n") * F.col("w")).alias("w"))
    packed = entries.groupBy("block").agg(F.collect_list(F.struct("no", "tid", "w")).alias("e")).select("block", F.col("e.no").alias("nos"), F.col("e.tid").alias("tids"), F.col("e.w").alias("ws"))
    pairs = posted.select(F.col("shard").alias("s"), F.col("block").alias("b")).distinct().join(C.written(packed), F.col("b") == F.col("block"))
    found = posted.groupBy("shard", "block").cogroup(pairs.groupBy("s", "b")).applyInArrow(_scorer(k, window), "no bigint, doc_id bigint, score bigint")
    order = W.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(listed.select("no", "item_id"), "no").select("item_id", "rank", "doc_id", "score")
