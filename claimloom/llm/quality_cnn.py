"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters slide over every position, their answers are max-pooled inside overlapping
chunks that cover the whole document, and the mean and the maximum over the chunks make one probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import give_back, others, small_batches, text_of

EMBED, WIDTH, FILTERS = 8, 6, 24
BLOCK = 256  # a chunk is two neighbouring blocks, so chunks overlap by half
TILE = 64  # blocks convolved at once


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED
    filters: np.ndarray  # WIDTH * EMBED x FILTERS
    bias: np.ndarray  # FILTERS
    head: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.head, self.offset]


def new_network(seed: int = 5) -> Network:
    r = np.random.default_rng(seed)
    f = np.float32
    return Network(
        r.normal(0, 0.5, (256, EMBED)).astype(f), r.normal(0, 1 / np.sqrt(WIDTH * EMBED), (WIDTH * EMBED, FILTERS)).astype(f),
        np.zeros(FILTERS, f), r.normal(0, 0.3, 2 * FILTERS).astype(f), np.zeros(1, f)
    )


def layout(sizes: list[int]) -> tuple[np.ndarray, int]:
    """Where each document's blocks begin: documents are padded with zero bytes to whole blocks that hold a filter's
    width after the last byte; a document has one block at least."""
    blocks = [max(1, -(-(n + WIDTH - 1) // BLOCK)) for n in sizes]
    return np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64), int(sum(blocks))


def padded(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    first, total = layout([len(d) for d in docs])
    data = np.zeros(total * BLOCK + WIDTH, np.uint8)
    for d, at in zip(docs, first * BLOCK, strict=False):
        data[at : at + len(d)] = np.frombuffer(d, np.uint8)
    return data, first


def answers(net: Network, data: np.ndarray) -> np.ndarray:
    """Each filter at each place of ``data`` but the last WIDTH: one matrix product for each remainder of the place
    by the width, over windows that lie side by side."""
    places = len(data) - WIDTH
    emb = net.embed[data]
    out = np.empty((places, FILTERS), np.float32)
    for p in range(WIDTH):
        n = len(range(p, places, WIDTH))
        out[p::WIDTH] = emb[p : p + n * WIDTH].reshape(n, WIDTH * EMBED) @ net.filters
    return out


def _inside(sizes: list[int], first: np.ndarray) -> np.ndarray:
    """Per block, how many of its places start in the document (one at least in its first block)."""
    n = np.maximum(np.asarray(sizes, np.int64), 1)
    doc = np.repeat(np.arange(len(sizes)), np.diff(first))
    k = np.arange(first[-1]) - first[doc]
    return np.clip(n[doc] - k * BLOCK, 0, BLOCK)


def block_maxima(net: Network, data: np.ndarray, inside: np.ndarray, places: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The largest answer of each filter in each block (and its place), without places past the document's end."""
    blocks = len(inside)
    best = np.full((blocks, FILTERS), -np.inf, np.float32)
    where = np.zeros((blocks, FILTERS), np.int64) if places else None
    for at in range(0, blocks, TILE):
        n = min(TILE, blocks - at)
        got = answers(net, data[at * BLOCK : (at + n) * BLOCK + WIDTH]).reshape(n, BLOCK, FILTERS)
        for i in np.flatnonzero(inside[at : at + n] < BLOCK):
            got[i, inside[at + i] :] = -np.inf
        if places:
            where[at : at + n] = got.argmax(axis=1)
        best[at : at + n] = got.max(axis=1)
    return best, where


def _chunks(best: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which block of each chunk's two holds a filter's maximum: index of the block, per chunk and filter. A chunk
    begins at every block; a document's last block is its own second."""
    mate = np.arange(len(best)) + 1
    mate[first[1:] - 1] -= 1
    return np.where(best[mate] > best, mate[:, None], np.arange(len(best))[:, None])


def forward(net: Network, best: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, tuple]:
    source = _chunks(best, first)
    cols = np.arange(FILTERS)
    raw = best[source, cols] + net.bias
    h = np.maximum(raw, 0)
    count = np.diff(first)[:, None].astype(np.float32)
    mean = np.add.reduceat(h, first[:-1], axis=0) / count
    top = np.maximum.reduceat(h, first[:-1], axis=0)
    z = np.concatenate([mean, top], axis=1) @ net.head + net.offset[0]
    return z, (source, raw, h, count, mean, top)


def fit(texts: list[bytes], labels: list[int], rounds: int = 24, batch: int = 24, rate: float = 0.01, seed: int = 5) -> Network:
    """Adam on the log loss; both classes weigh the same. The pooling passes gradients only to the winning places."""
    net, r = new_network(seed), np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    m, v, t = [np.zeros_like(p) for p in net.parts()], [np.zeros_like(p) for p in net.parts()], 0
    for epoch in range(rounds):
        order = r.permutation(len(texts))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            docs = [texts[i] for i in pick]
            data, first = padded(docs)
            best, where = block_maxima(net, data, _inside([len(d) for d in docs], first), places=True)
            z, (source, raw, h, count, mean, top) = forward(net, best, first)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            dz = ((p - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            feats = np.concatenate([mean, top], axis=1)
            doc = np.repeat(np.arange(len(docs)), np.diff(first))
            dmean, dtop = np.outer(dz, net.head[:FILTERS]) / count, np.outer(dz, net.head[FILTERS:])
            is_top = h == top[doc]
            tied = np.add.reduceat(is_top.astype(np.float32), first[:-1], axis=0)
            dh = (dmean[doc] + is_top * (dtop / np.maximum(tied, 1))[doc]) * (raw > 0)
            c, f = np.nonzero(dh)
            g, block = dh[c, f], source[c, f]
            place = block * BLOCK + where[block, f]
            window = data[place[:, None] + np.arange(WIDTH)]
            x = net.embed[window].reshape(len(place), WIDTH * EMBED)
            dw = np.zeros_like(net.filters)
            for k in range(FILTERS):
                own = f == k
                if own.any():
                    dw[:, k] = g[own] @ x[own]
            dx = (g[:, None] * net.filters[:, f].T).reshape(-1, EMBED)
            de = np.zeros_like(net.embed)
            np.add.at(de, window.reshape(-1), dx)
            grads = [de, dw, dh.sum(axis=0), feats.T @ dz, np.array([dz.sum()], np.float32)]
            t += 1
            step = rate * (0.5 if epoch >= rounds * 2 // 3 else 1)
            for q, grad, a, b in zip(net.parts(), grads, m, v, strict=True):
                grad = grad + 1e-5 * q
                a += 0.1 * (grad - a)
                b += 0.001 * (grad * grad - b)
                q -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-8)
    return net


def score_texts(net: Network, texts: list[bytes]) -> np.ndarray:
    """The probability of label 1 of each whole text."""
    out = np.zeros(len(texts))
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < 1 << 20):
            size += len(texts[end])
            end += 1
        docs = texts[at:end]
        data, first = padded(docs)
        best, _ = block_maxima(net, data, _inside([len(d) for d in docs], first))
        z, _ = forward(net, best, first)
        out[at:end] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
        at = end
    return out


def learn_quality(
    docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    per_class: int = 700, max_doc_bytes: int = 1 << 17
) -> Network | None:
    """The network from labelled rows that satisfy ``learn`` (an expression over the id).

    Bounds: about ``per_class`` whole documents of each class, drawn by a hash of the id, of at most
    ``max_doc_bytes`` bytes each. Null labels are left out. None without rows.
    """
    known = labels.where(learn & F.col(label_col).isin(0, 1)).select(F.col(id_col), F.col(label_col).alias("_y")).distinct()
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().collect()}
    if not counts:
        return None
    ticket = F.pmod(F.xxhash64(F.lit("quality"), id_col), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("_y") == 1, per_class / max(1, counts.get(1, 0))).otherwise(per_class / max(1, counts.get(0, 0)))
    drawn = known.where(ticket < share)
    texts = docs.select(F.col(id_col), text_of(text_col).cast("binary").alias("_text")).where(F.octet_length("_text") <= max_doc_bytes)
    sample = texts.join(F.broadcast(drawn), id_col).select(F.col(id_col).cast("string").alias("id"), "_text", "_y")
    small_batches(docs.sparkSession)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)), key=lambda r: (r[0], r[1], r[2]))
        if rows:
            net = fit([r[1] for r in rows], [r[2] for r in rows])
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.astype(np.float32).tobytes() for p in net.parts()], pa.binary()), pa.array(range(5), pa.int32())],
                ["part", "at"]
            )

    # The bounded sample trains in one task; the network, some ten thousand numbers, is what comes back.
    got = {r["at"]: np.frombuffer(r["part"], np.float32) for r in sample.repartition(1).mapInArrow(train, "part binary, at int").collect()}
    return Network(*[got[i].reshape(p.shape).copy() for i, p in enumerate(new_network().parts())]) if got else None


def score_quality(docs: DataFrame, net: Network | None, text_col: str = "text", made: str = "score") -> DataFrame:
    """All input columns and ``made``, the probability that the whole text is of label 1.

    Null and empty texts are scored as one block of zero bytes. Without a network (no labelled rows) the score is
    0.5. An input column named as ``made`` is replaced. Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in parts:
            yield pa.array(score_texts(shared.value, [x.as_py() for x in texts]) if shared.value is not None else np.full(len(texts), 0.5))
        give_back()

    return docs.select(*[docs[c] for c in others(docs, [made])], scored(text_of(text_col).cast("binary")).alias(made))
