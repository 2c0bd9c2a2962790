"""Language identification: a bidirectional gated recurrent network over bytes, in numpy.

The network reads the bytes of a text's lower-case letters, with one space between words,
in windows, forwards and backwards, and gives every position a probability for each language; a document's probabilities are
the mean over its letters. It is trained by backpropagation through time. A task
steps through thousands of windows at once, so the loop is over the positions of a
window only.

The last class is for what no language learned is: it is fitted to windows made from
the others, with their letters under another alphabet order, their letters shuffled, or
signs of other scripts. So a text in a language that was not learned gets a low
probability for each one, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import slices
from .samples import byte_windows

WINDOW, FIT_WINDOW, UNITS = 192, 64, 12
#: The bounds on what is fitted: documents of each language, windows of each, languages (the most frequent), and windows of no language.
FIT_ROWS, FIT_WINDOWS, FIT_LANGUAGES, FIT_STRANGE = 375, 4, 200, 400
#: Windows that a task steps through at a time: their states fit a core's cache.
GROUP = 1536
UNKNOWN = "und"

#: Bytes that are letters or parts of letters, after lower-casing.
_LETTER = np.zeros(256, np.float32)
_LETTER[ord("a") : ord("z") + 1] = 1
_LETTER[0x80:] = 1


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    n = max(1, -(-len(data) // size))
    flat = np.zeros(n * size, np.uint8)
    flat[: len(data)] = np.frombuffer(data, np.uint8)
    return flat.reshape(n, size)


def lettered(data: bytes) -> bytes:
    """The bytes of letters, with one space for whatever stands between two words: signs tell nothing of a language."""
    flat = np.frombuffer(data, np.uint8)
    letter = _LETTER[flat] > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    return np.where(letter, flat, np.uint8(ord(" ")))[keep].tobytes()


def initial(classes: int, seed: int = 3) -> dict[str, np.ndarray]:
    """``a``: what a byte adds to the gates; ``u``: what the state adds; ``v``, ``c``: from states to classes. Two directions."""
    rng = np.random.default_rng(seed)
    draw = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
    return {"a": draw(2, 256, 3 * UNITS, s=0.3), "u": draw(2, UNITS, 3 * UNITS, s=0.3), "v": draw(2, UNITS, classes, s=0.3), "c": np.zeros(classes, np.float32)}


def _sigmoid(x):
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def _states(m: dict, x: np.ndarray, keep: bool = False):
    """Yields for each step both directions' states (2, n, UNITS) and, with ``keep``, what the backward pass needs."""
    h, n = np.zeros((2, len(x), UNITS), np.float32), UNITS
    both = np.stack([x.T, x.T[::-1]], 1)  # step, direction, window
    for t in range(x.shape[1]):
        gates = np.stack([m["a"][0].take(both[t, 0], 0), m["a"][1].take(both[t, 1], 0)])
        rec = h @ m["u"]
        zr = _sigmoid(gates[..., : 2 * n] + rec[..., : 2 * n])
        z, r = zr[..., :n], zr[..., n:]
        new = np.tanh(gates[..., 2 * n :] + r * rec[..., 2 * n :])
        before = h
        h = new + z * (before - new)
        yield (h, before, z, r, new, rec[..., 2 * n :], both[t]) if keep else h


def _running(m: dict, x: np.ndarray) -> Iterator[np.ndarray]:
    """The states of ``_states``, step by step, in arrays that the next step overwrites."""
    n, half = UNITS, np.float32(0.5)
    # A sigmoid is (1 + tanh of the half) / 2: the halves go into the weights.
    cut = [(slice(0, n), half), (slice(n, 2 * n), half), (slice(2 * n, 3 * n), np.float32(1))]
    adds = [np.ascontiguousarray(m["a"][..., c] * f).reshape(512, n) for c, f in cut]
    turns = [np.ascontiguousarray(m["u"][..., c] * half) for c, _ in cut]
    both = np.stack([x.T, x.T[::-1]], 1) + np.array([0, 256], np.intp)[:, None]
    h, z, r, new, rec, gate = (np.zeros((2, len(x), n), np.float32) for _ in range(6))
    for at in both:
        for out, add, turn in ((z, adds[0], turns[0]), (r, adds[1], turns[1])):
            np.matmul(h, turn, out=out)
            np.take(add, at, axis=0, out=gate, mode="clip")
            out += gate
            np.tanh(out, out=out)
        np.matmul(h, turns[2], out=rec)
        np.take(adds[2], at, axis=0, out=new, mode="clip")
        new += rec
        r *= rec
        new += r
        np.tanh(new, out=new)
        # new + (1 + z) / 2 * (h - new)
        h -= new
        h *= half
        new += h
        h *= z
        h += new
        yield h


def probabilities(m: dict, x: np.ndarray) -> np.ndarray:
    """The class probabilities at every position: (step, class, window)."""
    size = x.shape[1]
    out = np.empty((size, len(m["c"]), len(x)), np.float32)
    out[:] = m["c"][:, None]
    forward, backward = m["v"].transpose(0, 2, 1)
    for t, h in enumerate(_running(m, x)):
        out[t] += forward @ h[0].T
        out[size - 1 - t] += backward @ h[1].T
    out -= out.max(1, keepdims=True)
    np.exp(out, out=out)
    out /= out.sum(1, keepdims=True)
    return out


def gradients(m: dict, x: np.ndarray, y: np.ndarray) -> tuple[dict, float]:
    """Backpropagation through time of the mean cross entropy over all letters' positions."""
    steps, (size, n) = list(_states(m, x, keep=True)), (x.shape[1], UNITS)
    forward, backward = np.stack([s[0][0] for s in steps]), np.stack([s[0][1] for s in steps])[::-1]
    logits = forward @ m["v"][0] + backward @ m["v"][1] + m["c"]
    p = np.exp(logits - logits.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    weight = _LETTER[x.T]
    weight /= max(1.0, float(weight.sum()))
    at = np.broadcast_to(y, x.T.shape)
    loss = float(-(weight * np.log(np.take_along_axis(p, at[..., None], -1)[..., 0] + 1e-9)).sum())
    g_out = p * weight[..., None]
    np.put_along_axis(g_out, at[..., None], np.take_along_axis(g_out, at[..., None], -1) - weight[..., None], -1)
    flat = g_out.reshape(-1, g_out.shape[-1])
    g = {k: np.zeros_like(v) for k, v in m.items()}
    g["c"] = flat.sum(0)
    g["v"] = np.stack([forward.reshape(-1, n).T @ flat, np.ascontiguousarray(backward).reshape(-1, n).T @ flat])
    g_state = np.stack([g_out @ m["v"][0].T, (g_out @ m["v"][1].T)[::-1]], 1)  # by step of each direction
    carry = np.zeros_like(steps[0][0])
    for t in range(size - 1, -1, -1):
        _, before, z, r, new, rec, byte = steps[t]
        d = carry + g_state[t]
        d_new = d * (1 - z) * (1 - new * new)
        d_z = d * (before - new) * z * (1 - z)
        d_r = d_new * rec * r * (1 - r)
        d_rec = np.concatenate([d_z, d_r, d_new * r], -1)
        g["u"] += before.transpose(0, 2, 1) @ d_rec
        d_gate = np.concatenate([d_z, d_r, d_new], -1)
        for i in range(2):
            np.add.at(g["a"][i], byte[i], d_gate[i])
        carry = d * z + d_rec @ m["u"].transpose(0, 2, 1)
    return g, loss


def fit(rows: list[tuple[list[bytes], int]], classes: int, steps: int = 90, size: int = 160, rate: float = 0.03, seed: int = 3) -> dict:
    """Fits the network to (windows, class) by Adam; each step draws the classes equally often."""
    m, rng = initial(classes, seed), np.random.default_rng(seed)
    x = [windows(b[:FIT_WINDOW], FIT_WINDOW)[0] for bs, _ in rows for b in bs]
    y = np.array([c for bs, c in rows for _ in bs])
    groups = [g for g in (np.flatnonzero(y == c) for c in range(classes)) if len(g)]
    first, second = {k: np.zeros_like(v) for k, v in m.items()}, {k: np.zeros_like(v) for k, v in m.items()}
    for step in range(1, steps + 1) if groups else ():
        pick = np.concatenate([rng.choice(g, -(-size // len(groups))) for g in groups])
        g, _ = gradients(m, np.stack([x[i] for i in pick]), y[pick])
        # The last steps are small, so that rounding, which differs between machines, settles no text.
        now = rate * (1 - (step - 1) / steps)
        for k in m:
            first[k] = 0.9 * first[k] + 0.1 * g[k]
            second[k] = 0.99 * second[k] + 0.01 * g[k] ** 2
            m[k] = (m[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return m


def strange(windows_: list[bytes], n: int = FIT_STRANGE, seed: int = 1) -> list[bytes]:
    """Windows of no language, made from those of languages: half with permuted alphabets, a quarter with shuffled letters, a quarter in other scripts."""
    rng, letters, out = np.random.default_rng(seed), np.arange(ord("a"), ord("z") + 1, dtype=np.uint8), []
    for k in range(n if windows_ else 0):
        data = np.frombuffer(windows_[rng.integers(len(windows_))], np.uint8).copy()
        at = np.flatnonzero((data >= ord("a")) & (data <= ord("z")))
        if k % 4 < 2:
            data[at] = rng.permutation(letters)[data[at] - ord("a")]
        elif k % 4 == 2:
            data[at] = rng.permutation(data[at])
        else:
            # A block of letters somewhere between Greek and Hangul, with spaces.
            block = int(rng.integers(0x370, 0xD000 - 256)) & ~0x7F
            signs = "".join(chr(block + int(x)) if x < 100 else " " for x in rng.integers(0, 115, FIT_WINDOW))
            data = np.frombuffer(signs.encode()[:FIT_WINDOW], np.uint8)
        out.append(data.tobytes())
    return out


def fit_languages(docs: DataFrame, learn_from=None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> tuple[dict, list[str]]:
    """Fits the network to at most ``rows`` documents of each language, FIT_WINDOWS windows of each, and to FIT_STRANGE
    windows of no language, its last class; returns it and the languages.

    ``learn_from`` is a condition on ``doc_id``. The languages are counted over all such documents, so
    a rare one has its own rows; beyond FIT_LANGUAGES the least frequent are not learned. Rows that
    repeat an identifier count as one document. Without such documents there is no language.
    """
    known = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[lang].alias("lang")).filter("lang is not null and text is not null")
    if learn_from is not None:
        known = known.filter(learn_from)
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(FIT_LANGUAGES)
    # Rows are drawn before any text is read: by a hash about three times as many as wanted, then the first of these.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    few = known.select("doc_id", "lang").join(F.broadcast(counts), "lang").filter(place < 3 * rows / F.col("count")).select("doc_id", "lang").distinct()
    drawn = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))).filter(F.col("rank") <= rows).drop("rank")
    texts = known.join(F.broadcast(drawn), ["doc_id", "lang"])
    found = texts.groupBy("doc_id", "lang").agg(F.min(byte_windows(F.lower("text"), FIT_WINDOWS, FIT_WINDOW)).alias("x")).collect()
    langs = sorted({r.lang for r in found})
    rows_ = [([lettered(bytes(b)) for b in r.x], langs.index(r.lang)) for r in sorted(found, key=lambda r: (r.doc_id, r.lang))]
    none = [([w], len(langs)) for w in strange([w for ws, _ in rows_ for w in ws])]
    return fit(rows_ + none, len(langs) + 1), langs


def _means(m: dict, data: list[bytes]) -> np.ndarray:
    each = [windows(d) for d in data]
    x, owner = np.concatenate(each), np.repeat(np.arange(len(each)), [len(w) for w in each])
    sums, letters = np.zeros((len(each), len(m["c"]))), np.zeros(len(each))
    for i in range(0, len(x), GROUP):
        part = x[i : i + GROUP]
        weight = _LETTER[part.T]
        np.add.at(sums, owner[i : i + GROUP], np.einsum("tcn,tn->nc", probabilities(m, part), weight))
        np.add.at(letters, owner[i : i + GROUP], weight.sum(0))
    return sums / np.maximum(letters, 1)[:, None]


def _lower(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def predict(m: dict, texts: list[str]) -> np.ndarray:
    """Each text's class probabilities, the mean over its letters' positions; the last is for no language learned."""
    return _means(m, [_lower(t) for t in texts])


def _predictor(model: dict, langs: list[str]):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = {"lang_pred": [], "score": []}
            for (part,) in slices([pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])], text_at=0, size=4 * GROUP * WINDOW):
                p = _means(model, [lettered(_lower(t)) for t in part])[:, : max(1, len(langs))]
                known = [bool(langs) and any(map(str.isalpha, t)) for t in part]
                out["lang_pred"] += [langs[b] if k else UNKNOWN for b, k in zip(p.argmax(1).tolist(), known, strict=True)]
                out["score"] += np.where(known, np.clip(p.max(1), 0, 1), 0.0).tolist()
            yield pd.DataFrame(out)

    return F.pandas_udf(run, "lang_pred string, score double")


def languages(docs: DataFrame, model: dict, langs: list[str], text: str = "text", column: str = "predicted") -> DataFrame:
    """The rows of ``docs`` with a column ``predicted`` (or ``column``) of (lang_pred, score): the likeliest language and
    its probability. A low score tells a text in none of the languages learned.

    ``lang_pred`` is ``und`` with score 0 where the text is null or empty or has no letter, or
    no language was learned. Ties go to the language first in order. Repeated rows get equal
    results; texts of any length are read whole; an empty table gives no rows. A column of
    that name is replaced. No shuffle, and only the text goes to Python.
    """
    return docs.withColumn(column, _predictor(model, langs)(F.coalesce(docs[text], F.lit(""))))
