"""Quality classification by a byte-level convolutional network in numpy.

Each byte, with a flag for bytes that echo a nearby stretch of the text, has a learned
embedding.  Learned filters run over every second byte; their responses are max-pooled
over overlapping chunks that cover the whole text, and the chunks' maxima and means are
combined into one probability.

For scoring, each filter tap is a table over byte values, so a response is a sum of
table rows.  Fitting uses a bounded sample of labelled rows (``rows``), all chunks of each;
scoring reads every byte.  With ``echoes`` off the filters see plain bytes alone.

Defined results: a null or empty text is scored as one chunk of padding.  Without
labels, or with labels of one kind only, every score is the labels' mean (0.5 if there
are none).  Repeated rows are scored apart.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from casequarry.llm import common as C
from casequarry.llm.training import Adam, labelled_sample, sigmoid, within_bytes

SAMPLE_ROWS = 3000
#: Bytes of their texts together; a text of over a sixteenth of that is scored, not learned from.
SAMPLE_BYTES = 64 << 20
FILTERS, WIDTH, STEP, DIMS = 16, 7, 2, 8
#: Positions of a block; a chunk is two neighbouring blocks, so chunks overlap by half.
BLOCK = 256
CHUNK_BYTES = 2 * BLOCK * STEP
#: An echo is a run of ECHO_RUN bytes that also stands 2 to ECHO_REACH bytes before.
ECHO_RUN, ECHO_REACH = 4, 20
#: Positions whose responses are in memory at a time, and chunks of them when fitting.
_PIECE, _FIT_PIECE = 1 << 16, 256


def symbols(texts: C.Texts, echoes: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Byte values, 256 added for echoes, each text followed by WIDTH zeros; and the texts' starts."""
    data, n = texts.data, len(texts.data)
    echo = np.zeros(n, bool)
    if echoes and n > ECHO_RUN:
        runs = data[:-3].astype(np.uint32)
        for k in (1, 2, 3):
            runs |= data[k : n - 3 + k].astype(np.uint32) << np.uint32(8 * k)
        found = np.zeros(len(runs), bool)
        for back in range(2, min(ECHO_REACH, len(runs) - 1) + 1):
            found[back:] |= runs[back:] == runs[:-back]
        echo[: len(runs)] = found
        for at in range(ECHO_REACH):  # an echo of the text before is none
            near = texts.starts[:-1] + at
            echo[near[near < texts.starts[1:]]] = False
    sizes = np.diff(texts.starts)
    out = np.zeros(n + WIDTH * len(texts), np.uint16)
    to = np.arange(n) + np.repeat(np.arange(len(texts)) * WIDTH, sizes)
    out[to] = data
    out[to[echo]] += 256
    return out, texts.starts[:-1] + np.arange(len(texts)) * WIDTH


@dataclass(frozen=True)
class Model:
    """``taps``: for each place in a filter, the response of each symbol; ``head`` for maxima, then means."""

    taps: np.ndarray
    bias: np.ndarray
    head: np.ndarray
    rest: float
    echoes: bool = True

    def features(self, column: pa.Array) -> np.ndarray:
        out = []
        for texts in C.passes(column, 1 << 18):
            data, starts = symbols(texts, self.echoes)
            spots = np.maximum(1, -(-np.diff(texts.starts) // STEP))
            blocks = -(-spots // BLOCK)
            first = np.cumsum(blocks) - blocks
            owner = np.repeat(np.arange(len(texts)), blocks)
            nth = np.arange(len(owner)) - first[owner]
            begin = starts[owner] + nth * BLOCK * STEP
            length = np.minimum(BLOCK, spots[owner] - nth * BLOCK)
            peaks = np.empty((len(owner), len(self.bias)), np.float32)
            group = max(1, _PIECE // BLOCK)
            for at in range(0, len(owner), group):
                sizes = length[at : at + group]
                before = np.cumsum(sizes) - sizes
                spot = np.repeat(begin[at : at + group] - STEP * before, sizes) + STEP * np.arange(sizes.sum())
                total = self.taps[0].take(data[spot], axis=0)
                for k in range(1, WIDTH):
                    total += self.taps[k].take(data[spot + k], axis=0)
                peaks[at : at + group] = np.maximum.reduceat(total, before, axis=0)
            peaks = np.maximum(peaks + self.bias, 0)
            chunks = peaks.copy()
            last = np.concatenate((owner[1:] != owner[:-1], [True]))
            chunks[:-1][~last[:-1]] = np.maximum(peaks[:-1], peaks[1:])[~last[:-1]]
            # A text of several blocks has one chunk fewer than blocks.
            count = np.maximum(blocks - 1, 1)
            chunks[last & (blocks[owner] > 1)] = 0
            out.append(np.concatenate((np.maximum.reduceat(chunks, first, axis=0), np.add.reduceat(chunks, first, axis=0) / count[:, None]), axis=1))
        return np.concatenate(out) if out else np.zeros((0, len(self.head)), np.float32)

    def scores(self, column: pa.Array) -> np.ndarray:
        return sigmoid(self.features(column) @ self.head + self.rest)


def _constant(mean: float) -> Model:
    odds = float(np.log(max(mean, 1e-9) / max(1 - mean, 1e-9)))
    return Model(np.zeros((WIDTH, 512, 1), np.float32), np.zeros(1, np.float32), np.zeros(2, np.float32), odds)


def _chunks(text: str, echoes: bool) -> tuple[np.ndarray, int]:
    """Symbols of all chunks of a text, each with its padding, and the positions of the last one."""
    (texts,) = C.passes(pa.array([text], pa.string()))
    data, size = symbols(texts, echoes)[0], len(texts.data)
    half = CHUNK_BYTES // 2
    many = max(1, -(-size // half) - 1)
    room = np.zeros((many + 1) * half + WIDTH, np.uint16)
    room[: min(len(data), len(room))] = data[: len(room)]
    rows = np.lib.stride_tricks.sliding_window_view(room, CHUNK_BYTES + WIDTH)[::half][:many]
    return rows, max(1, -(-(size - (many - 1) * half) // STEP))


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, steps: int = 320, seed: int = 3, echoes: bool = True
) -> Model:
    """Fit on at most ``rows`` labelled documents of at most SAMPLE_BYTES together; their whole texts reach the driver."""
    C.tune(docs.sparkSession)
    got = within_bytes(labelled_sample(docs, labels, label, rows), SAMPLE_BYTES).toArrow().sort_by("doc_id")
    y = (got["label"].to_numpy() > 0).astype(np.float32) if len(got) else np.zeros(0, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5)
    texts = got["text"]
    positions = CHUNK_BYTES // STEP
    rng = np.random.default_rng(seed)
    draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
    parts = {
        "embed": draw(512, DIMS, by=0.5),
        "filters": draw(WIDTH, DIMS, FILTERS, by=0.2),
        "bias": np.zeros(FILTERS, np.float32),
        "head": draw(2 * FILTERS, by=0.2),
        "rest": np.zeros(1, np.float32),
    }
    adam = Adam(parts, 0.01)
    batch = 64
    epochs = -(-steps // -(-len(y) // batch))  # whole passes over the sample, as many as give ``steps``
    for epoch in range(epochs):
        adam.rate = 0.01 if epoch < 0.6 * epochs else 0.003
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            docs_ = order[at : at + batch]
            cut = [_chunks(texts[int(i)].as_py(), echoes) for i in docs_]
            x = np.concatenate([c for c, _ in cut])
            many = np.array([len(c) for c, _ in cut])
            first = np.cumsum(many) - many
            owner = np.repeat(np.arange(len(docs_)), many)
            valid = np.full(len(x), positions)
            valid[first + many - 1] = [n for _, n in cut]
            taps = [parts["embed"] @ parts["filters"][k] for k in range(WIDTH)]
            where, peak = np.zeros((len(x), FILTERS), np.int64), np.zeros((len(x), FILTERS), np.float32)
            for lo in range(0, len(x), _FIT_PIECE):
                piece = x[lo : lo + _FIT_PIECE]
                total = np.zeros((len(piece), positions, FILTERS), np.float32)
                for k in range(WIDTH):
                    total += taps[k].take(piece[:, k : k + CHUNK_BYTES : STEP], axis=0)
                total[np.arange(positions)[None] >= valid[lo : lo + _FIT_PIECE, None]] = -np.inf
                best = total.argmax(axis=1)
                where[lo : lo + _FIT_PIECE] = best
                peak[lo : lo + _FIT_PIECE] = np.take_along_axis(total, best[:, None], axis=1)[:, 0] + parts["bias"]
            act = np.maximum(peak, 0)
            top = np.maximum.reduceat(act, first, axis=0)
            feats = np.concatenate((top, np.add.reduceat(act, first, axis=0) / many[:, None]), axis=1)
            miss = ((sigmoid(feats @ parts["head"] + parts["rest"]) - y[docs_]) / len(docs_)).astype(np.float32)
            back = miss[:, None] * parts["head"]
            pull = back[owner, FILTERS:] / many[owner][:, None]
            pull += back[owner, :FILTERS] * (act == top[owner])
            pull *= peak > 0
            grads = {k: np.zeros_like(v) for k, v in parts.items()}
            grads["head"] = feats.T @ miss + np.float32(1e-4) * parts["head"]
            grads["rest"][0] = miss.sum()
            grads["bias"] = pull.sum(axis=0)
            c, f = np.nonzero(pull)
            g = pull[c, f]
            for k in range(WIDTH):
                seen = x[c, where[c, f] * STEP + k]
                np.add.at(grads["filters"][k].T, f, parts["embed"][seen] * g[:, None])
                np.add.at(grads["embed"], seen, parts["filters"][k][:, f].T * g[:, None])
            adam.update(grads)
    taps = np.stack([parts["embed"] @ parts["filters"][k] for k in range(WIDTH)]).astype(np.float32)
    return Model(taps, parts["bias"], parts["head"], float(parts["rest"][0]), echoes)


def scorer(model: Model):
    @F.arrow_udf(DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(model.scores(column).astype(float), pa.float64())

    return score
