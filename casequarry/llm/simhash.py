"""SimHash near-duplicates by an inverted index over positional bytes with count filtering.

A fingerprint is eight positional bytes.  Two fingerprints within ``max_bits`` (at most
2) differing bits differ in at most two bytes, so they share at least six of the eight.
Posting lists of single bytes would hold 1/256 of the corpus each and grow with its
square once pairs are tallied; the index therefore posts each distinct fingerprint
under its 56 choices of five positional bytes.  Pairs that meet are tallied: with s shared
bytes they meet in C(s, 5) postings, once for five, six times for six and 21 times for seven.
Pairs whose tally reaches that of the guaranteed minimum of six are retained, those that share only five
drop out, and what is retained is verified by its differing bits.  A posting list holds at most 2^24 distinct
fingerprints, whatever the corpus; a long one's pairs are made by as many tasks as a skewed join is split into.

Copies with one fingerprint are one class, so a large group of copies is one entry.

Defined results: words are runs of anything but the six ASCII spaces, after lower-casing
A-Z; shorter texts than a shingle are one shingle; a null, empty or blank text has
fingerprint zero and links like any other.  component_id is the least id that links
reach, also through rows with null ids and from row to row of one id; rows with null ids get a fingerprint and the least id of their component, null
where it has none.  Repeated rows each get their own row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from casequarry.llm import common as C
from casequarry.llm.components import components

SHINGLE, SEED, MAX_BITS = 3, 42, 2
#: Positional bytes of a posting: one fewer than any pair to be found shares, so that the tally decides.
POSTED = 5
_STEP = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    count = max(1, len(parts) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    ends = ends[shingle - 1 :] if len(parts) >= shingle else ends[-1:]
    set_bits = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, _STEP):
        to = min(count, at + _STEP)
        hashes = np.fromiter(
            [digest(joined[a:b], SEED) for a, b in zip(starts[at:to].tolist(), ends[at:to].tolist(), strict=True)], np.uint64, to - at
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * set_bits > count, bitorder="little").view(np.int64)[0])


@F.arrow_udf(LongType())
def fingerprints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        yield pa.array([fingerprint(t.text(i)) for t in C.passes(column) for i in range(len(t))], pa.int64())


def tallied(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that share POSTED bytes or more, with their number of ``shared_bytes``."""
    masks = []
    for gone in combinations(range(8), 8 - POSTED):
        mask = ~sum(255 << 8 * g for g in gone) & (2**64 - 1)
        masks.append(mask - 2**64 if mask >= 2**63 else mask)
    posted = distinct.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("place", "part"))
    other = posted.select(F.col("fp").alias("fp2"), F.col("place").alias("place2"), F.col("part").alias("part2"))
    # Size estimates leave out that each row is posted 56 times; a broadcast of the postings would fill the driver.
    met = posted.join(other.hint("merge"), (F.col("place") == F.col("place2")) & (F.col("part") == F.col("part2")) & (F.col("fp") < F.col("fp2")))
    tally = met.groupBy(F.col("fp").alias("a"), F.col("fp2").alias("b")).agg(F.count("*").alias("meetings"))
    shared = F.coalesce(*(F.when(F.col("meetings") >= comb(s, POSTED), s) for s in range(7, POSTED - 1, -1)))
    return tally.select("a", "b", shared.alias("shared_bytes"))


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within ``max_bits`` bits, with their shared bytes."""
    if max_bits > 2:
        raise ValueError("two differing bytes cover at most 2 differing bits")
    retained = tallied(distinct).where(F.col("shared_bytes") >= 8 - max_bits)
    return retained.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def grouped(docs: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text", by_id: bool = False) -> DataFrame:
    """Every row's doc_id with its fingerprint fp, its component (a fingerprint) and component_id.

    With ``by_id`` rows of one id are linked whatever their texts.
    """
    C.tune(docs.sparkSession)
    marked = C.written(docs.select(F.col(id_col).alias("doc_id"), fingerprints(F.col(text_col)).alias("fp")))
    classes = C.written(marked.groupBy("fp").agg(F.min("doc_id").alias("node")))
    pairs = links(classes.select("fp"), max_bits).select(F.col("a").alias("u"), F.col("b").alias("v"))
    if by_id:
        ids = marked.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("u"), F.max("fp").alias("w")).where("u <> w").select("doc_id", "u")
        pairs = pairs.unionByName(marked.join(ids, "doc_id").select("u", F.col("fp").alias("v")))
    found = components(pairs).select(F.col("node").alias("fp"), "component")
    named = C.written(classes.join(found, "fp", "left").select("fp", "node", F.coalesce("component", "fp").alias("component")))
    # Written first, so that the join deals both sides alike and a large component's rows can be split.
    least = C.written(named.groupBy("component").agg(F.min("node").alias("component_id")))
    known = C.written(named.select("fp", "component").join(least, "component"))
    C.remove(classes, named, least)
    return marked.join(known.hint("merge"), "fp").select("doc_id", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's doc_id with its fingerprint and component_id."""
    rows = grouped(docs, max_bits, id_col, text_col, by_id=True)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
