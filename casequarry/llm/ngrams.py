"""Language-model scores from Elias-Fano tries of n-gram counts.

Model: unigrams with half a count added to each word, bigrams and trigrams by absolute discounting,
each order interpolated with the one below, so that every context's probabilities sum to one.  A middle word of more than
CLASS uses is split into classes of its trigrams by the first word; counts of such a bigram context are those of its class.

1. Texts are cut into words in runs of some 2 million; a run keeps its distinct words and each word's place among them.
2. The runs' words meet by hash: counts are added up, words are numbered so that frequent ones get small numbers, and each run
   learns its words' numbers and counts.
3. Every token goes once, with its two predecessors, to the shard of its middle word (and class), packed by run.  A
   shard counts what the training rows hold, builds its trie and looks all tokens up in it.
4. A run's documents add up what the shards return.

A trie's levels are contexts, their successors, their first words, and these pairs' successors.  Pointers are
monotone, identifiers are made monotone by adding each list's predecessor's last value, and a pair's successor is
stored as its rank among the context's successors; all are Elias-Fano coded.  Probabilities and backoff weights are 16-bit codes
of their logarithm.  The levels are a memory-mapped scratch file of the task, which has no name and goes with it; a lost task builds it again.

Memory and skew: a shard holds some TOKENS tokens whatever the corpus, a frequent word's contexts lie in many shards; a single
very frequent pair of words lies in one.  Three numbers reach the driver.  All rows count, none is sampled.

Defined results: a null or empty text is one end token; rows with a null id learn and score like others.  Repeated rows count each time.  Without
training rows every probability is 0.5 / 0.5 = 1.  Other columns are ignored.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.llm import common as C

#: Tokens of a run of texts, of a shard, words of a vocabulary shard, uses of a middle word in one class.
RUN, TOKENS, WORDS, CLASS = 1 << 21, 1 << 20, 1 << 20, 1 << 20
DISCOUNT = 0.75
#: A code is -log10 of a probability times SCALE, so 16 bits reach 1e-15 in steps of 0.00024.
SCALE, TOP = 4096, (1 << 16) - 1
#: Word numbers: start of a text, any word that training lacks; others follow.
START, UNKNOWN, FIRST = 0, 1, 2
_END = np.uint64(0x5851F42D4C957F2D)
_CLASS_BITS = 20


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 as compressed byte planes, those of high zeros left out."""
    planes = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8)
    width = next((i for i in range(8, 0, -1) if planes[:, i - 1].any()), 0)
    raw = np.ascontiguousarray(planes[:, :width].T).tobytes()
    return len(values).to_bytes(8, "little") + bytes([width]) + (pa.compress(raw, "zstd", asbytes=True) if raw else b"")


def unpack(data: bytes) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), data[8]
    out = np.zeros((n, 8), np.uint8)
    if n and width:
        raw = pa.decompress(data[9:], n * width, "zstd", asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.view("<i8").ravel()


def code(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-SCALE * np.log10(np.maximum(p, 1e-300))), TOP).astype(np.uint16)


def value(codes: np.ndarray) -> np.ndarray:
    return np.power(10.0, codes.astype(float) / -SCALE)


class EliasFano:
    """A monotone list: low bits as they are, high parts in unary; places of each BLOCK-th value allow reading by blocks."""

    BLOCK = 1 << 13

    def __init__(self, arrays: tuple[np.ndarray, ...]):
        self.head, self.low, self.high, self.places, self.firsts = arrays
        self.n, self.bits = (int(x) for x in self.head)

    @classmethod
    def arrays(cls, values: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(values)
        bits = max(0, int(int(values[-1]) // n).bit_length() - 1) if n else 0
        places = (values >> bits) + np.arange(n)
        high = np.zeros(int(places[-1]) + 1 if n else 0, bool)
        high[places] = True
        low = ((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8) if bits else np.zeros((n, 0), np.uint8)
        return np.array([n, bits]), np.packbits(low.ravel()), np.packbits(high), places[:: cls.BLOCK], values[:: cls.BLOCK].astype(np.int64)

    def block(self, i: int) -> np.ndarray:
        """Values i * BLOCK up to (i + 1) * BLOCK."""
        lo, hi = i * self.BLOCK, min(self.n, (i + 1) * self.BLOCK)
        start = int(self.places[i])
        stop = int(self.places[i + 1]) if i + 1 < len(self.places) else 8 * len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[start >> 3 : (stop + 7) >> 3])[start & 7 :])[: hi - lo] + start
        out = (ones - np.arange(lo, hi)) << self.bits
        if self.bits:
            a, b = lo * self.bits, hi * self.bits
            raw = np.unpackbits(self.low[a >> 3 : (b + 7) >> 3])[a & 7 :][: b - a].reshape(-1, self.bits)
            for k in range(self.bits):
                out |= raw[:, k].astype(np.int64) << k
        return out

    def at(self, places: np.ndarray) -> np.ndarray:
        """Values at rising places."""
        out = np.zeros(len(places), np.int64)
        cuts = np.searchsorted(places, np.arange(0, self.n + self.BLOCK, self.BLOCK))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            out[cuts[i] : cuts[i + 1]] = self.block(i)[places[cuts[i] : cuts[i + 1]] - i * self.BLOCK]
        return out

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the first element at or above each of the rising values; place n where there is none."""
        place, found = np.full(len(values), self.n), np.full(len(values), -1, np.int64)
        cuts = np.append(np.searchsorted(values, self.firsts, side="right"), len(values))
        if len(self.firsts):
            head = slice(0, cuts[0])  # at or below the first element
            place[head], found[head] = 0, self.firsts[0]
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[i], cuts[i + 1])
            # Values equal to a block's first element fall before the cut of side="right", hence to the block before.
            elements = self.block(i)
            if i + 1 < len(self.firsts):
                elements = np.append(elements, self.firsts[i + 1])
            k = np.searchsorted(elements, values[own])
            inside = k < len(elements)
            place[own] = np.where(inside, i * self.BLOCK + k, self.n)
            found[own] = np.where(inside, elements[np.minimum(k, len(elements) - 1)], -1)
        return place, found


def chained(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rising lists as one rising list: each value from 1 plus the last of the list before."""
    if not len(ids):
        return ids
    last = ids[starts[1:] - 1] + 1
    base = np.concatenate(([0], np.cumsum(last)[:-1]))
    return ids + 1 + np.repeat(base, np.diff(starts))


class Level:
    """Lists of identifiers under their parents: a monotone pointer for each parent, chained identifiers."""

    def __init__(self, pointers: EliasFano, ids: EliasFano):
        self.pointers, self.ids = pointers, ids

    @staticmethod
    def lists(ids: np.ndarray, parents: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.searchsorted(parents, np.arange(n + 1))
        return starts, chained(ids, starts)

    def find(self, parents: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the level of each (parent, id), -1 where it is not, and rank within the list; pairs are rising, parents from 0."""
        place = np.full(len(parents), -1)
        rank = np.zeros(len(parents), np.int64)
        if not len(parents) or not self.ids.n:
            return place, rank
        own, back = np.unique(parents, return_inverse=True)
        start, stop = self.pointers.at(own), self.pointers.at(own + 1)
        before = np.where(start > 0, self.ids.at(np.maximum(start - 1, 0)), 0)[back]
        last = self.ids.at(np.maximum(stop - 1, 0))[back]
        start, stop = start[back], stop[back]
        wanted = ids + 1 + before
        at, found = self.ids.successor(np.minimum(wanted, last))
        hit = (at < stop) & (at >= start) & (found == wanted)
        place[hit], rank[hit] = at[hit], (at - start)[hit]
        return place, rank


class Trie:
    """A shard's counted n-grams; ``build`` writes its levels to a scratch file and maps them."""

    LISTS = ("contexts", "next_at", "next", "pair_at", "pair", "far_at", "far")
    CODES = ("context_backoff", "next_p", "pair_backoff", "far_p")

    def __init__(self, arrays: dict[str, np.ndarray]):
        lists = {n: EliasFano(tuple(arrays[f"{n}.{i}"] for i in range(5))) for n in self.LISTS}
        self.contexts = lists["contexts"]
        self.next, self.pair, self.far = (Level(lists[f"{n}_at"], lists[n]) for n in ("next", "pair", "far"))
        self.codes = {n: arrays[n] for n in self.CODES}

    @classmethod
    def build(cls, lists: dict[str, np.ndarray], codes: dict[str, np.ndarray]) -> Trie:
        parts = {f"{n}.{i}": a for n in cls.LISTS for i, a in enumerate(EliasFano.arrays(lists[n]))} | codes
        file = tempfile.TemporaryFile()
        shape = []
        for name, a in parts.items():
            file.write(b"\0" * (-file.tell() % 8))
            shape.append((name, a.dtype, len(a), file.tell()))
            file.write(np.ascontiguousarray(a).data)
        file.flush()
        return cls({n: np.memmap(file, dtype, "r", at, (size,)) if size else np.zeros(0, dtype) for n, dtype, size, at in shape})

    def context(self, values: np.ndarray) -> np.ndarray:
        place, found = self.contexts.successor(values)
        return np.where(found == values, place, -1)


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and each value's place among them in 32 bits: a shard's tokens are far fewer."""
    distinct, place = np.unique(values, return_inverse=True)
    return distinct, place.astype(np.int32)


def _tallied(ctx: np.ndarray, w1: np.ndarray, w3: np.ndarray, one: np.ndarray, learn: np.ndarray) -> np.ndarray:
    """Codes of -log10 P of each token (w3 after w1 and the context) as a trie of the tokens to learn from gives them."""
    contexts, c = _numbered(ctx)
    wide = int(max(w1.max(), w3.max())) + 1
    nexts, b = _numbered(c * np.int64(wide) + w3)
    pairs, p = _numbered(c * np.int64(wide) + w1)
    fars, t = _numbered(p * np.int64(len(nexts)) + b)
    b_ctx, b_id = np.divmod(nexts, wide)
    p_ctx, p_id = np.divmod(pairs, wide)
    t_pair, t_next = np.divmod(fars, len(nexts))
    p1 = np.zeros(len(nexts), np.uint16)
    p1[b] = one
    p1 = value(p1)
    n_c, n_b, n_p, n_t = (np.bincount(x[learn], minlength=size) for x, size in ((c, len(contexts)), (b, len(nexts)), (p, len(pairs)), (t, len(fars))))
    has_c, has_b, has_p, has_t = (np.flatnonzero(n) for n in (n_c, n_b, n_p, n_t))
    back_c = DISCOUNT * np.bincount(b_ctx[has_b], minlength=len(contexts)) / np.maximum(n_c, 1)
    back_p = DISCOUNT * np.bincount(t_pair[has_t], minlength=len(pairs)) / np.maximum(n_p, 1)
    p2 = np.maximum(n_b - DISCOUNT, 0) / np.maximum(n_c, 1)[b_ctx] + back_c[b_ctx] * p1
    p3 = np.maximum(n_t - DISCOUNT, 0) / np.maximum(n_p, 1)[t_pair] + back_p[t_pair] * p2[t_next]

    place = np.full(len(contexts), -1)
    place[has_c] = np.arange(len(has_c))
    first_next = np.searchsorted(b_ctx[has_b], np.arange(len(contexts)))
    rank = np.zeros(len(nexts), np.int64)
    rank[has_b] = np.arange(len(has_b)) - first_next[b_ctx[has_b]]
    pair_place = np.full(len(pairs), -1)
    pair_place[has_p] = np.arange(len(has_p))
    next_at, next_ids = Level.lists(b_id[has_b], place[b_ctx[has_b]], len(has_c))
    pair_at, pair_ids = Level.lists(p_id[has_p], place[p_ctx[has_p]], len(has_c))
    far_at, far_ids = Level.lists(rank[t_next[has_t]], pair_place[t_pair[has_t]], len(has_p))
    trie = Trie.build(
        {"contexts": contexts[has_c], "next_at": next_at, "next": next_ids, "pair_at": pair_at, "pair": pair_ids, "far_at": far_at, "far": far_ids},
        {"context_backoff": code(back_c[has_c]), "next_p": code(p2[has_b]), "pair_backoff": code(back_p[has_p]), "far_p": code(p3[has_t])},
    )

    # All distinct n-grams, learned or not, are looked up in the order of the levels.
    known = trie.context(contexts)
    asks = known[b_ctx] >= 0
    at_b, rank_b = np.full(len(nexts), -1), np.zeros(len(nexts), np.int64)
    at_b[asks], rank_b[asks] = trie.next.find(known[b_ctx[asks]], b_id[asks])
    weight = np.where(known >= 0, trie.codes["context_backoff"][np.maximum(known, 0)] if trie.contexts.n else 0, 0)
    lower = weight[b_ctx] - SCALE * np.log10(p1)
    if trie.next.ids.n:
        lower = np.where(at_b >= 0, trie.codes["next_p"][np.maximum(at_b, 0)], lower)
    asks = known[p_ctx] >= 0
    at_p = np.full(len(pairs), -1)
    at_p[asks], _ = trie.pair.find(known[p_ctx[asks]], p_id[asks])
    at_t = np.full(len(fars), -1)
    asks = (at_p[t_pair] >= 0) & (at_b[t_next] >= 0)
    at_t[asks], _ = trie.far.find(at_p[t_pair[asks]], rank_b[t_next[asks]])
    out = lower[t_next]
    if trie.pair.ids.n:
        out = out + np.where(at_p >= 0, trie.codes["pair_backoff"][np.maximum(at_p, 0)], 0)[t_pair]
        out = np.where(at_t >= 0, trie.codes["far_p"][np.maximum(at_t, 0)], out)
    return out[t]


def _runs(id_kind: pa.DataType):
    """Documents as runs: distinct words with their training counts, and the tokens as places among these."""

    def cut(ids, held, counts, hashes) -> pa.RecordBatch:
        number = (TaskContext.get().partitionId() << 32) + cut.done
        cut.done += 1
        n = np.concatenate(counts)
        flags = pa.concat_arrays(held).to_numpy(zero_copy_only=False)
        tokens = np.insert(np.concatenate(hashes), np.cumsum(n), _END)
        n = n + 1
        words, local = np.unique(tokens, return_inverse=True)
        learned = np.bincount(local, np.repeat(~flags, n).astype(float), len(words)).astype(np.int64)
        # Frequent words get small places, which pack well.
        order = np.argsort(-np.bincount(local, minlength=len(words)), kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        one = lambda a, kind: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a.cast(kind))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number]), one(pa.concat_arrays(ids), id_kind), one(pa.array(flags), pa.bool_()), one(pa.array(n), pa.int64()),
                pa.array([words[order].tobytes()], pa.binary()), pa.array([pack(learned[order])], pa.binary()), pa.array([pack(place[local])], pa.binary()),
                pa.array([int(n.sum())]), pa.array([int((~flags).sum())]), pa.array([len(words)]),
            ],
            names=["run", "ids", "held", "n", "words", "learned", "tokens", "n_tokens", "n_learn", "n_words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut.done = 0
        parts: tuple[list, ...] = ([], [], [], [])
        size = 0
        for batch in batches:
            at = 0
            for texts in C.passes(batch.column(2)):
                low = C.lower_bytes(texts.data)
                starts, ends, counts = C.words(texts, C.NONSPACE, low)
                hashes = C.span_hash(C.byte_sums(low), starts, ends)
                for part, x in zip(parts, (batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), counts, hashes), strict=True):
                    part.append(x)
                at += len(texts)
                size += len(hashes) + len(texts)
                if size >= RUN:
                    yield cut(*parts)
                    parts, size = ([], [], [], []), 0
        if parts[0]:
            yield cut(*parts)

    return run


def _word_shards(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, words, learned in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words, learned = np.frombuffer(words, np.uint64), unpack(learned)
                shard = (C.mix64(words) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                cuts = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    own = order[cuts[s] : cuts[s + 1]]
                    row = [[s], [number], [words[own].tobytes()], [pack(learned[own])]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)], names=["shard", "run", "words", "learned"])

    return run


def _vocabulary(shards: int):
    def number(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Numbers and training counts of each run's words of one shard, and the shard's totals as run -1."""
        shard = key[0].as_py()
        rows = [(r["run"], np.frombuffer(r["words"], np.uint64), unpack(r["learned"])) for r in table.to_pylist()]
        words, at = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
        n = np.bincount(at, np.concatenate([r[2] for r in rows]), len(words)).astype(np.int64)
        place = np.empty(len(words), np.int64)
        place[np.argsort(-n, kind="stable")] = np.arange(len(words))
        ids = np.where(n > 0, FIRST + place * shards + shard, UNKNOWN)
        out, lo = [(-1, int(n.sum()), int((n > 0).sum()), b"", b"")], 0
        for number_, own, _ in rows:
            mine = at[lo : lo + len(own)]
            lo += len(own)
            out.append((number_, None, None, pack(ids[mine]), pack(n[mine])))
        kinds = {"run": pa.int64(), "total": pa.int64(), "distinct": pa.int64(), "ids": pa.binary(), "counts": pa.binary()}
        return pa.table({"shard": pa.array([shard] * len(out), pa.int64())} | {name: pa.array([r[i] for r in out], kind) for i, (name, kind) in enumerate(kinds.items())})

    return number


def _dealt(id_kind: pa.DataType, word_shards: int, shards: int, total: int, distinct: int, n_learn: int):
    """Each run's tokens by shard, and one row with what is known of its documents already."""
    schema = pa.schema(
        [("shard", pa.int64()), ("run", pa.int64()), *((n, pa.binary()) for n in ("ctx", "w1", "w3", "one", "sizes", "learn")), ("ids", pa.list_(id_kind)), ("held", pa.list_(pa.bool_())), ("n", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(i)[r] for i, n in enumerate(batch.schema.names)}
                words = np.frombuffer(row["words"].as_py(), np.uint64)
                shard = C.mix64(words) % np.uint64(word_shards)
                ids, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
                for part in row["answers"].as_py():
                    own = np.flatnonzero(shard == part["shard"])
                    ids[own], counts[own] = unpack(part["ids"]), unpack(part["counts"])
                n = row["n"].values.to_numpy()
                held = row["held"].values.to_numpy(zero_copy_only=False)
                local = unpack(row["tokens"].as_py())
                doc = np.repeat(np.arange(len(n), dtype=np.int32), n)
                starts = np.cumsum(n) - n
                log1 = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
                token, seen = ids[local], counts[local]

                def before(values: np.ndarray, steps: int, start: int) -> np.ndarray:
                    out = np.full(len(values), start, np.int64)
                    out[steps:] = values[: len(values) - steps]
                    for k in range(steps):
                        out[starts[n > k] + k] = start  # noqa: B023
                    return out

                w1 = before(token, 2, START)
                ctx = C.mix64(w1.astype(np.uint64) + np.uint64(977)) % (1 + before(seen, 1, n_learn) // CLASS).astype(np.uint64)
                ctx = (before(token, 1, START) << _CLASS_BITS) | ctx.astype(np.int64)
                to = (C.mix64(ctx.astype(np.uint64)) % np.uint64(shards)).astype(np.int32)
                order = np.argsort(to, kind="stable")
                cuts = np.searchsorted(to[order], np.arange(shards + 1))
                del to
                one = code(np.power(10.0, log1))
                known = {"ids": row["ids"].as_py(), "held": held.tolist(), "n": n.tolist()}
                known |= {"n_known": np.bincount(doc, seen > 0, len(n)).astype(int).tolist(), "base": np.bincount(doc, log1[local], len(n)).tolist()}
                number = row["run"].as_py()
                yield pa.RecordBatch.from_pylist([{"shard": number % shards, "run": number} | known], schema)
                for s in np.flatnonzero(np.diff(cuts)).tolist():
                    own = order[cuts[s] : cuts[s + 1]]
                    sizes = np.bincount(doc[own], minlength=len(n))
                    # A word's own code goes once, in the order of the words.
                    _, some = np.unique(token[own], return_index=True)
                    packed = {"ctx": ctx[own], "w1": w1[own], "w3": token[own], "one": one[local[own[some]]], "sizes": sizes, "learn": (~held).astype(np.int64)}
                    yield pa.RecordBatch.from_pylist([{"shard": s, "run": number} | {k: pack(v) for k, v in packed.items()}], schema)

    return run, schema


def _sums(out_schema: pa.Schema):
    def score(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """For each run the sums of its documents' tokens of this shard; rows about documents pass through."""
        packed = table.filter(table["ctx"].is_valid()).sort_by("run")
        rows = packed.select(["run", "ctx", "w1", "w3", "one", "sizes", "learn"]).to_pylist()
        passed = table.filter(table["ctx"].is_null()).select(["shard", "run", "ids", "held", "n", "n_known", "base"])
        sums: list[tuple[int, np.ndarray]] = []
        if rows:
            ctx, w1, w3 = (np.concatenate([unpack(r.pop(n)) for r in rows]) for n in ("ctx", "w1", "w3"))
            ends = np.cumsum([unpack(r["sizes"]).sum() for r in rows])
            own = [w3[e - unpack(r["sizes"]).sum() : e] for r, e in zip(rows, ends, strict=True)]
            one = np.concatenate([unpack(r["one"])[np.searchsorted(words, w)].astype(np.uint16) for r, w in zip(rows, own, strict=True) for words in [np.unique(w)]])
            sizes = [unpack(r["sizes"]) for r in rows]
            learn = np.concatenate([np.repeat(unpack(r["learn"]) == 1, s) for r, s in zip(rows, sizes, strict=True)])
            logs = _tallied(ctx, w1, w3, one, learn) / -SCALE
            lo = 0
            for r, s in zip(rows, sizes, strict=True):
                n = int(s.sum())
                sums.append((r["run"], np.bincount(np.repeat(np.arange(len(s)), s), logs[lo : lo + n], len(s))))
                lo += n
        shard = key[0].as_py()
        mine = pa.Table.from_pylist([{"shard": shard, "run": r, "sums": s} for r, s in sums], out_schema)
        return pa.concat_tables([mine, passed.append_column("sums", pa.nulls(len(passed), pa.list_(pa.float64()))).select(out_schema.names).cast(out_schema)])

    return score


def _totals(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A run's documents with the sums of all shards, added in the order of the shards."""
    table = table.sort_by("shard")
    about = table.filter(table["ids"].is_valid())
    total = np.zeros(len(about["n"][0].values))
    for s in table.filter(table["sums"].is_valid())["sums"]:
        total += s.values.to_numpy()
    return pa.table({"doc_id": about["ids"][0].values, "held_out": about["held"][0].values, "n_tokens": about["n"][0].values, "n_known": about["n_known"][0].values, "base_score": about["base"][0].values, "score": pa.array(total)})


def scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row; rows not held out train the model."""
    spark = docs.sparkSession
    C.tune(spark)
    kind = docs.schema[id_col].dataType
    arrow = pa.int64() if kind.simpleString() == "bigint" else pa.string()
    name = "bigint" if arrow == pa.int64() else "string"
    read = docs.select(F.col(id_col).cast(name).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text_col).alias("t"))
    runs = C.written(
        read.mapInArrow(
            _runs(arrow),
            f"run bigint, ids array<{name}>, held array<boolean>, n array<bigint>, words binary, learned binary, tokens binary, n_tokens bigint, n_learn bigint, n_words bigint",
        )
    )
    size = runs.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_tokens", "n_learn", "n_words"))).first()
    word_shards, shards = max(1, -(-size.n_words // WORDS)), max(1, -(-size.n_tokens // TOKENS))
    met = runs.select("run", "words", "learned").mapInArrow(_word_shards(word_shards), "shard bigint, run bigint, words binary, learned binary")
    answers = C.written(met.groupBy("shard").applyInArrow(_vocabulary(word_shards), "shard bigint, run bigint, total bigint, distinct bigint, ids binary, counts binary"))
    whole = answers.where("run < 0").agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("total", "distinct"))).first()
    told = answers.where("run >= 0").groupBy("run").agg(F.collect_list(F.struct("shard", "ids", "counts")).alias("answers"))
    deal, _ = _dealt(arrow, word_shards, shards, whole.total, whole.distinct, size.n_learn)
    about = f"ids array<{name}>, held array<boolean>, n array<bigint>, n_known array<bigint>, base array<double>"
    dealt = (
        runs.select("run", "ids", "held", "n", "words", "tokens")
        .join(told, "run")
        .mapInArrow(deal, f"shard bigint, run bigint, ctx binary, w1 binary, w3 binary, one binary, sizes binary, learn binary, {about}")
    )
    out = pa.schema([("shard", pa.int64()), ("run", pa.int64()), ("ids", pa.list_(arrow)), ("held", pa.list_(pa.bool_())), ("n", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base", pa.list_(pa.float64())), ("sums", pa.list_(pa.float64()))])
    summed = dealt.groupBy("shard").applyInArrow(_sums(out), f"shard bigint, run bigint, {about}, sums array<double>")
    done = summed.groupBy("run").applyInArrow(_totals, f"doc_id {name}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return done.select(F.col("doc_id").cast(kind).alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(whole.total).cast("bigint").alias("train_tokens"), "base_score", "score")
