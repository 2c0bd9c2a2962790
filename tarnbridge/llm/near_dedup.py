"""Near duplicates by improved consistent weighted sampling of TF-IDF shingles.

A text is the weighted set of its runs of five words: a run's weight is the times it
occurs, times the mean inverse document frequency of its words. Two texts agree in
one consistent weighted sample with a probability equal to their weighted Jaccard
similarity (sum of minima over sum of maxima). 64 samples in 16 bands of four make
the candidates; the similarity of candidates is then computed from the texts.

Document frequencies are counted over all documents, in a table of a fixed number of
hashed buckets, so what tasks receive has a fixed size. Texts with the same words
are one node. A band's bucket may hold any number of nodes, so its nodes are not
paired with each other: all are compared with one pivot, which buckets choose in one
of ORDERS orders, so that a node meets a few pivots, and then with the node that has
the largest share of shingles which many nodes have. What is not joined to its
pivot's component is compared with a sample of the bucket's nodes in other
components, which grows by GROWTH each round until it is the whole bucket. So every
bucket's pairs are decided, without a cap, while nodes of a large class are joined
after a few comparisons. Nodes that share a rare shingle, one that at most RARE nodes
of the open buckets have, are compared directly; for all other pairs rare shingles
count as not shared, which bounds their similarity. Pairs that cannot be similar are
never compared: the smaller sum of weights over the larger bounds the similarity, too;
one minus the similarity is a metric, so distances to the same pivot must not differ
by more than the threshold allows; and at least AGREE of the 64 samples must agree in four bits. A pair of similarity 0.8
fails the last in about one case of 9,000 (``agree=0`` turns it off), and shares no band
in two of 10,000; the other bounds are exact.

The texts of nodes in shared buckets are found by one shuffle of the documents, at every
size; only the documents' keys, not their texts, are held to build the join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import arrow, batch, slices
from .common import SPACE, Workspace, matching_rows
from .components import components
from .hashing import U, mix, odd, shingles, word_hashes

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 16, 4
#: Buckets of the table of document frequencies: its size is fixed.
BUCKETS = 1 << 18
#: Random variates that the samples draw from, by bits of a shingle's hash.
DRAWS = 1 << 16
#: Orders that pivots are chosen by, and the nodes of a bucket that a node meets in the first round of samples, and the growth by round.
ORDERS, FIRST, GROWTH = 4, 64, 64
#: Nodes that may have a rare shingle: whoever shares one is compared directly.
RARE = 3
#: Samples of 64 that must agree in their lowest BITS bits before two texts are compared.
AGREE, BITS = 41, 4


def content(text: Column) -> Column:
    """The lower-case words of a text with one space between; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SPACE, " "))


def content_key(norm: Column) -> Column:
    return F.unhex(F.md5(norm))


def document_frequencies(base: DataFrame) -> np.ndarray:
    """Documents that have a word in each bucket, and at the end the documents with any word."""
    schema, kind = arrow("bucket int, n long")

    def count(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for (texts,) in slices(batches, text_at=0):
            words, sizes = word_hashes(texts)
            owner = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
            pairs = np.unique(owner * BUCKETS + (words % U(BUCKETS)).astype(np.int64))
            total[:BUCKETS] += np.bincount(pairs % BUCKETS, minlength=BUCKETS)
            total[BUCKETS] += np.count_nonzero(sizes)
        at = np.flatnonzero(total)
        yield batch(kind, bucket=at.astype(np.int32), n=total[at])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in base.select("norm").mapInArrow(count, schema).groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r.bucket] = r.n
    return out


def inverse_frequencies(counts: np.ndarray) -> np.ndarray:
    """Between 1 (a word of every document) and 2 (of none), at every size of the corpus."""
    n = float(counts[BUCKETS])
    return (1 + np.log((n + 1) / (counts[:BUCKETS] + 1)) / max(math.log(n + 1), 1e-9)).astype(np.float32)


def vector(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted shingles of a text's word hashes, and their weights."""
    n = min(SHINGLE, len(words))
    each = idf[(words % U(BUCKETS)).astype(np.int64)]
    mean = each[: len(words) - n + 1].copy()
    for j in range(1, n):
        mean += each[j : len(words) - n + 1 + j]
    found, first, times = np.unique(shingles(words, SHINGLE), return_index=True, return_counts=True)
    return found, times.astype(np.float32) * mean[first] / np.float32(n)


def similarity(a, b) -> float:
    """The weighted Jaccard similarity of two vectors."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64))
    return low / (float(a[1].sum(dtype=np.float64)) + float(b[1].sum(dtype=np.float64)) - low)


class Sampler:
    """Improved consistent weighted sampling: for each sample r, c ~ Gamma(2, 1) and beta ~ U(0, 1) for a shingle;
    t = floor(ln w / r + beta), ln a = ln c - r (t - beta + 1), and the shingle of least a is drawn with its t."""

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 5):
        rng = np.random.default_rng(seed)
        r, c = rng.gamma(2, 1, DRAWS), rng.gamma(2, 1, DRAWS)
        self.r, self.by_r, self.ln_c, self.beta = (x.astype(np.float32) for x in (r, 1 / r, np.log(c), rng.random(DRAWS)))
        self.odd = odd(samples, seed)

    def sample(self, found: np.ndarray, weights: np.ndarray, group: int = 2048) -> np.ndarray:
        best, drawn = np.full(len(self.odd), np.inf, np.float32), np.zeros(len(self.odd), U)
        column = np.arange(len(self.odd))
        ln_w = np.log(weights)
        for i in range(0, len(found), group):
            h = found[i : i + group]
            at = ((h[:, None] * self.odd) >> U(48)).astype(np.int32)
            beta, r = self.beta.take(at), self.r.take(at)
            t = np.floor(ln_w[i : i + group, None] * self.by_r.take(at) + beta)
            a = self.ln_c.take(at)
            a -= r * (t - beta + np.float32(1))
            k = a.argmin(0)
            low = a[k, column]
            better = low < best
            best = np.where(better, low, best)
            drawn = np.where(better, mix(h[k] ^ mix(t[k, column].astype(np.int64).view(U))), drawn)
        return drawn

    def bands(self, found: np.ndarray, weights: np.ndarray) -> tuple[list[int], list[int]]:
        """The keys of the bands, and the lowest BITS bits of all samples, as one integer for each bit."""
        samples = self.sample(found, weights)
        s = samples.reshape(BANDS, ROWS)
        key = np.arange(BANDS, dtype=U)
        for j in range(ROWS):
            key = mix(key ^ s[:, j])
        place = np.arange(len(samples), dtype=U)
        bits = [(((samples >> U(b)) & U(1)) << place).sum(dtype=U) for b in range(BITS)]
        return key.view(np.int64).tolist(), np.array(bits, U).view(np.int64).tolist()


def _vectors(texts: list[str], idf: np.ndarray):
    words, sizes = word_hashes(texts)
    at = 0
    for n in sizes.tolist():
        yield vector(words[at : at + n], idf) if n else None
        at += n


def signatures(base: DataFrame, idf: np.ndarray) -> DataFrame:
    """doc_id, h, the sum of weights, the samples' lowest bits and the band keys of each text; no keys for a text without words."""
    schema, kind = arrow("doc_id {id}, h binary, weight double, bits array<long>, bands array<long>", base.schema["doc_id"].dataType)

    def run(batches):
        sampler = Sampler()
        for ids, hs, texts in slices(batches, text_at=2):
            vectors = list(_vectors(texts, idf))
            weights = [float(v[1].sum(dtype=np.float64)) if v else 0.0 for v in vectors]
            drawn = [sampler.bands(*v) if v else ([], []) for v in vectors]
            yield batch(kind, doc_id=ids, h=hs, weight=weights, bits=[x[1] for x in drawn], bands=[x[0] for x in drawn])

    return base.select("doc_id", "h", "norm").mapInArrow(run, schema)


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(a, b, sim) of the pairs of nodes (a, b)."""
    schema, kind = arrow("a long, b long, sim double")

    def run(batches):
        kept: dict = {}

        def of(node: int, text: str):
            if node not in kept:
                if len(kept) >= 16:
                    kept.clear()
                kept[node] = next(_vectors([text], idf))
            return kept[node]

        for a, b, ta, tb in slices(batches, text_at=2):
            yield batch(kind, a=a, b=b, sim=[similarity(next(_vectors([x], idf)), of(j, y)) for j, x, y in zip(b, ta, tb, strict=True)])

    one, two = texts.select(F.col("nid").alias("a"), F.col("norm").alias("ta")), texts.select(F.col("nid").alias("b"), F.col("norm").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, schema)


def rare_shingles(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """(nodes, weight): each set of at most RARE nodes that alone have some shingles, and these shingles' least weights in sum."""
    schema, kind = arrow("nid long, items array<struct<s:long,w:double>>")

    def run(batches):
        for nids, norms in slices(batches):
            vectors = list(_vectors(norms, idf))
            ends = np.cumsum([0, *[len(v[0]) for v in vectors]]).astype(np.int32)
            each = kind.field("items").type.value_type
            items = pa.StructArray.from_arrays([pa.array(np.concatenate([v[0] for v in vectors]).view(np.int64)), pa.array(np.concatenate([v[1] for v in vectors]).astype(np.float64))], fields=list(each))
            yield batch(kind, nid=nids, items=pa.ListArray.from_arrays(pa.array(ends), items).cast(kind.field("items").type))

    each = texts.select("nid", "norm").mapInArrow(run, schema).select("nid", F.inline("items"))
    # Three nodes follow from the smallest, the largest and the exclusive or of all, so that no group is collected.
    by_s = each.groupBy("s").agg(F.count("*").alias("n"), F.min("nid").alias("lo"), F.max("nid").alias("hi"), F.bit_xor("nid").alias("x"), F.min("w").alias("w")).filter(F.col("n") <= RARE)
    third = F.when(F.col("n") == 3, F.col("x").bitwiseXOR(F.col("lo")).bitwiseXOR(F.col("hi")))
    return by_s.groupBy("lo", third.alias("mid"), "hi").agg(F.sum("w").alias("weight")).select(F.array_compact(F.array_distinct(F.array("lo", "mid", "hi"))).alias("nodes"), "weight")


def _nodes(docs: DataFrame, doc_id: str, text: str, threshold: float, agree: int, work: Workspace):
    """The documents' signatures, the nodes, and the components of the nodes with links."""
    base = docs.select(docs[doc_id].alias("doc_id"), content(docs[text]).alias("norm")).withColumn("h", content_key(F.col("norm")))
    idf = inverse_frequencies(document_frequencies(base))
    signed = work.stored(signatures(base, idf), "signatures", keep=True)
    nodes = signed.filter(F.size("bands") > 0).groupBy("h").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.first(F.struct("weight", *[F.col("bits")[b].alias(f"b{b}") for b in range(BITS)])).alias("sketch"), F.first("bands").alias("bands"))
    nodes = work.stored(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")

    entries = nodes.select("nid", "sketch", F.explode("bands").alias("key"))
    order = F.xxhash64("nid", F.pmod("key", F.lit(ORDERS)))
    shared = work.stored(entries.groupBy("key").agg(F.min_by(F.struct("nid", "sketch"), order).alias("p"), F.count("*").alias("n")).filter("n > 1").select("key", F.col("p.nid").alias("pivot"), F.col("p.sketch").alias("p_sketch"), "n"), "buckets")
    entries = work.stored(entries.join(shared, "key").select("key", "nid", "sketch", "pivot", "p_sketch", "n"), "entries")
    # One document of each needed node: the words' key and a hash of the identifier (of two that share both, either has the words).
    who = F.xxhash64(F.col("doc_id"))
    needed = nodes.join(entries.select("nid").distinct(), "nid", "left_semi").select("nid", "h", F.xxhash64("first_id").alias("who"))
    texts = base.select("norm", "h", who.alias("who")).join(needed.hint("shuffle_hash"), ["h", "who"])
    texts = work.stored(texts.dropDuplicates(["h", "who"]).select("nid", "norm"), "texts")

    def alike(one: str, two: str) -> Column:
        differ = F.lit(0).cast("long")
        for b in range(BITS):
            differ = differ.bitwiseOR(F.col(f"{one}.b{b}").bitwiseXOR(F.col(f"{two}.b{b}")))
        heavy = F.greatest(f"{one}.weight", f"{two}.weight")
        return (F.least(f"{one}.weight", f"{two}.weight") >= (threshold - 1e-6) * heavy) & (F.bit_count(differ) <= BANDS * ROWS - agree)

    pairs = entries.filter("nid <> pivot").filter(alike("sketch", "p_sketch")).select(F.col("nid").alias("a"), F.col("pivot").alias("b")).distinct()
    known = work.stored(verify(pairs, texts, idf), "similarities")
    to_pivot = known.select(F.col("a").alias("nid"), F.col("b").alias("pivot"), "sim")
    placed = work.stored(entries.join(to_pivot, ["nid", "pivot"], "left").select("key", "nid", "sketch", "pivot", "n", F.when(F.col("nid") == F.col("pivot"), 1.0).otherwise(F.col("sim")).alias("sim")), "placed")
    joined = components(work, known.filter(F.col("sim") >= threshold).select("a", "b"))
    bands = nodes.select("nid", "bands")
    most, rare = 0, None
    while True:
        own = joined.select(F.col("node").alias("nid"), F.col("root").alias("own"))
        main = joined.select(F.col("node").alias("pivot"), F.col("root").alias("main"))
        # Buckets that the last round compared whole are decided.
        open_ = placed.filter(F.col("n") > most) if most else placed
        now = open_.join(own, "nid", "left").join(main, "pivot", "left").select("key", "nid", "sketch", "sim", "n", F.coalesce("own", "nid").alias("own"), F.coalesce("main", "pivot").alias("main"))
        first = rare is None
        if first:
            partners = now.join(now.filter("own <> main").select("key").distinct(), "key", "left_semi").select("nid").distinct()
            rare = work.stored(rare_shingles(texts.join(partners, "nid", "left_semi"), idf), "rare")
            lone = work.stored(rare.select(F.explode("nodes").alias("nid"), "weight").groupBy("nid").agg(F.sum("weight").alias("lone")), "lone")
        # The weight that a node can share with any other but those that it shares rare shingles with, with room for rounding.
        now = now.join(lone, "nid", "left").withColumn("common", F.col("sketch.weight") * (1 + 1e-6) - F.coalesce("lone", F.lit(0.0))).drop("lone")
        now = now.filter(F.col("common") >= threshold * F.col("sketch.weight"))
        apart = work.stored(now.filter("own <> main").select("key", F.col("nid").alias("q"), F.col("sketch").alias("q_sketch"), F.col("sim").alias("q_sim"), F.col("own").alias("q_own"), F.col("common").alias("q_common")), "apart")
        if not first and not apart.limit(1).count():
            return signed, nodes, joined
        if first:
            # The node with the largest share of common shingles is nearest to what a bucket's nodes have in common.
            central = F.struct(F.col("common") / F.col("sketch.weight"), F.xxhash64("nid"))
            met = now.groupBy("key").agg(F.max_by(F.struct("nid", "sketch", "sim", "own", "common"), central).alias("hub")).select("key", "hub.*")
        else:
            most = most * GROWTH or FIRST
            met = now.filter(F.pmod(F.xxhash64("nid"), F.col("n")) < most)
        near = (F.col("own") != F.col("q_own")) & alike("sketch", "q_sketch") & F.coalesce(F.abs(F.col("sim") - F.col("q_sim")) <= 1 - threshold + 1e-6, F.lit(True))
        low = F.least("common", "q_common")
        near = near & (low >= threshold * (F.col("sketch.weight") + F.col("q_sketch.weight") - low))
        if not first:
            # A pair is made at its smallest shared key only; that bucket, too, is compared whole in the end.
            met = met.join(apart.select("key").distinct(), "key", "left_semi").join(bands, "nid")
            near = near & (F.col("key") == F.array_min(F.array_intersect("bands", "q_bands")))
        ways = met.join(apart if first else apart.join(bands.toDF("q", "q_bands"), "q"), "key").filter(near).select(F.greatest("nid", "q").alias("a"), F.least("nid", "q").alias("b"))
        if first:
            two = rare.filter(F.size("nodes") > 1).select(F.explode(F.filter(F.array(*[F.struct(F.get("nodes", i).alias("b"), F.get("nodes", j).alias("a")) for i, j in ((0, 1), (0, 2), (1, 2))]), lambda x: x["a"].isNotNull())).alias("e")).select("e.a", "e.b").distinct()
            at = nodes.join(own, "nid", "left").select("nid", "sketch", F.coalesce("own", "nid").alias("own"))
            two = two.join(at.select(F.col("nid").alias("a"), "sketch", "own"), "a").join(at.select(F.col("nid").alias("b"), F.col("sketch").alias("q_sketch"), F.col("own").alias("q_own")), "b")
            ways = ways.union(two.filter((F.col("own") != F.col("q_own")) & alike("sketch", "q_sketch")).select("a", "b"))
        decided = known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        more = work.stored(verify(ways.distinct().join(decided, ["a", "b"], "left_anti"), texts, idf), "similarities")
        known = known.unionByName(more)
        links = more.filter(F.col("sim") >= threshold).select("a", "b")
        if links.limit(1).count():
            joined = components(work, joined.select(F.col("node").alias("a"), F.col("root").alias("b")).union(links))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", agree: int = AGREE) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, group_size, kept, h.

    A class is a connected component of documents whose weighted similarity is ``threshold`` or
    more; ``class_id`` is its smallest identifier and ``kept`` marks that document. ``h`` is the
    key of the document's words. Documents with the same words (null counts as empty; case and
    white space do not count) are in one class; a text without words is in a class of its own. A
    text of fewer than five words has one shingle of all of them. Repeated rows share their
    result. Texts of any length are taken whole. An empty table gives no rows. Other columns are
    ignored. Of the 64 samples of two texts ``agree`` must agree before they are compared; 0
    compares all that share a band and that no exact bound rules out.
    """
    with Workspace(docs.sparkSession) as work:
        signed, nodes, joined = _nodes(docs, doc_id, text, threshold, agree, work)
        classed = work.stored(nodes.join(joined.withColumnRenamed("node", "nid"), "nid", "left").select("h", "first_id", "n", F.coalesce("root", "nid").alias("root")), "classed")
        # The null identifier is the smallest only where a class has no other.
        totals = classed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("group_size"))
        by_h = work.stored(classed.join(totals, "root").select("h", "class_id", "group_size"), "by-content", keep=True)
    worded = F.size("bands") > 0
    alone = signed.filter(~worded).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "h")
    grouped = signed.filter(worded).select("doc_id", "h").join(by_h, "h").select("doc_id", "class_id", "group_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"), "h")
    return grouped.union(alone)


def drop_near(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", agree: int = AGREE) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all columns, whatever their names.

    Of rows with one identifier and the same words the first stays, in the order of the text and
    then of the other columns as JSON. An empty table gives no rows.
    """
    kept = near_duplicates(docs, threshold, doc_id, text, agree).filter("kept").select("h", F.xxhash64("doc_id").alias("who"))
    return matching_rows(docs, doc_id, text, {"h": content_key(content(docs[text])), "who": F.xxhash64(docs[doc_id])}, kept)
