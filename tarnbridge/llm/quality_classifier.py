"""Quality classifier: a convolutional network over bytes, in numpy.

A text's bytes are cut into chunks that overlap by one filter width less one, so
every window of the whole document lies in exactly one chunk. Learned filters run
over each chunk and are max-pooled in it; the chunks' features are averaged and a
small layer combines them into one probability. So a document of any length is
judged by all of its bytes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import arrow, batch, slices
from .common import plain
from .samples import byte_windows, sample

CHUNK, WIDTH, FILTERS, HIDDEN = 256, 5, 16, 8
#: The bound on the rows that are fitted: labelled documents of each class, and chunks of each.
FIT_ROWS, FIT_CHUNKS = 700, 6
#: Chunks that a task convolves at a time.
GROUP = 512


def chunks(data: bytes) -> np.ndarray:
    """The chunks of a text's bytes, (n, CHUNK + WIDTH - 1), with zeros after the end; one chunk for no bytes."""
    n = max(1, -(-len(data) // CHUNK))
    flat = np.zeros(n * CHUNK + WIDTH - 1, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK + WIDTH - 1)[::CHUNK]


def convolve(x: np.ndarray, filters: np.ndarray) -> np.ndarray:
    """The filters' values at each position of each chunk, (n, CHUNK, FILTERS)."""
    out = filters[0][x[:, :CHUNK]]
    for j in range(1, WIDTH):
        out += filters[j][x[:, j : j + CHUNK]]
    return out


def initial(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    return {"filters": draw(WIDTH, 256, FILTERS, s=0.15), "bias": np.zeros(FILTERS, np.float32), "w": draw(FILTERS, HIDDEN, s=0.4), "c": np.zeros(HIDDEN, np.float32), "v": np.zeros(HIDDEN, np.float32), "d": np.zeros(1, np.float32)}


def features(m: dict, x: np.ndarray) -> np.ndarray:
    """The pooled filters of each chunk."""
    return np.concatenate([np.tanh(convolve(x[i : i + GROUP], m["filters"]).max(1) + m["bias"]) for i in range(0, len(x), GROUP)])


def combine(m: dict, mean: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(np.tanh(mean @ m["w"] + m["c"]) @ m["v"] + m["d"]).astype(np.float64)))


def means(x: np.ndarray, sizes) -> np.ndarray:
    """The mean of each group of consecutive rows."""
    starts = np.cumsum([0, *sizes[:-1]])
    return np.add.reduceat(x, starts, axis=0) / np.asarray(sizes, np.float32)[:, None]


def score(m: dict, texts: list[str]) -> np.ndarray:
    each = [chunks(t.encode("utf-8", "surrogatepass")) for t in texts]
    return combine(m, means(features(m, np.concatenate(each)), [len(c) for c in each]))


def fit(rows: list[tuple[list[bytes], int]], epochs: int = 10, size: int = 48, rate: float = 0.01, seed: int = 7) -> dict:
    """Fits the network to (chunks of bytes, label) by Adam on the cross entropy."""
    m, rng = initial(seed), np.random.default_rng(seed)
    if not rows:
        return m
    epochs = max(epochs, 250 * size // len(rows))  # few rows need more passes
    xs = [np.concatenate([chunks(b[:CHUNK])[:1] for b in (bs or [b""])]) for bs, _ in rows]
    ys = np.array([y for _, y in rows], np.float32)
    first, second, step = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), size):
            pick = order[at : at + size]
            x, sizes, y = np.concatenate([xs[i] for i in pick]), [len(xs[i]) for i in pick], ys[pick]
            z = convolve(x, m["filters"])
            top = z.argmax(1)
            a = np.tanh(np.take_along_axis(z, top[:, None], 1)[:, 0] + m["bias"])
            mean = means(a, sizes)
            h = np.tanh(mean @ m["w"] + m["c"])
            p = 1 / (1 + np.exp(-(h @ m["v"] + m["d"])))
            g_out = (p - y) / len(y)
            g_h = g_out[:, None] * m["v"] * (1 - h * h)
            g_a = np.repeat((g_h @ m["w"].T) / np.asarray(sizes, np.float32)[:, None], sizes, axis=0) * (1 - a * a)
            g = {"v": h.T @ g_out, "d": g_out.sum(keepdims=True), "w": mean.T @ g_h, "c": g_h.sum(0), "bias": g_a.sum(0), "filters": np.zeros_like(m["filters"])}
            which = np.broadcast_to(np.arange(FILTERS), g_a.shape)
            for j in range(WIDTH):
                np.add.at(g["filters"][j], (np.take_along_axis(x, top + j, 1), which), g_a)
            step += 1
            for k in m:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
                m[k] = (m[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return m


def fit_quality(docs: DataFrame, labels: DataFrame, learn_from=None, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS) -> dict:
    """Fits the network to at most ``rows`` labelled documents of each class, FIT_CHUNKS chunks of each.

    ``learn_from`` is a condition on ``doc_id`` for the labels to use. Different labelled
    identifiers are drawn by a hash before the texts are joined to them, so the broadcast holds
    2 * rows rows at most. Rows that repeat an identifier count as one document, with the least
    of their chunks in order, so no more rows than that come to the driver.
    Without labels the network gives 0.5 for every text.
    """
    known = labels.select(labels[doc_id].alias("doc_id"), labels[label].cast("int").alias("y")).filter("y in (0, 1)")
    if learn_from is not None:
        known = known.filter(learn_from)
    known = known.distinct()
    drawn = sample(known.filter("y = 0"), rows).union(sample(known.filter("y = 1"), rows))
    texts = plain(docs, doc_id, text).join(F.broadcast(drawn), "doc_id")
    found = texts.groupBy("doc_id", "y").agg(F.min(byte_windows(F.col("text"), FIT_CHUNKS, CHUNK)).alias("x")).collect()
    return fit([([bytes(b) for b in r.x], r.y) for r in sorted(found, key=lambda r: (r.doc_id, r.y))])


def quality_scores(docs: DataFrame, model: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1, higher: better).

    A null text counts as empty and gets the network's value for no bytes, and one of any length is read whole. Repeated rows get
    equal scores; an empty table gives no rows. Other columns are ignored. No shuffle.
    """
    schema, kind = arrow("doc_id {id}, score double", docs.schema[doc_id].dataType)

    def run(batches):
        for ids, texts in slices(batches):
            yield batch(kind, doc_id=ids, score=score(model, texts))

    return plain(docs, doc_id, text).mapInArrow(run, schema)
