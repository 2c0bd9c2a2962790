"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarnbridge.llm import batches, chat_format, components, exact_dedup, hashing, language_id, near_dedup, packing, piece_dropout, quality_classifier, quality_rules, queries, token_counts, token_records
from tarnbridge.llm.chunk_cache import ByteLevelIds, WordCounts
from tarnbridge.llm.common import Workspace, held_out, scratch

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(3000))
ROWS = [(1, "a b  c d e f", "x"), (2, "a b c d e f", "y"), (2, "a b c d e f", "y"), (3, None, None), (4, "", ""), (5, LONG, "z"), (6, LONG.replace("w77 ", "v77 "), "z"), (None, "a b\tc d e f", "n"), (7, "▁ mark \n\n<|endoftext|> é", "q"), (8, "12 !! ..", None)]
SCHEMA = "doc_id long, text string, kept string"


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and an extra column named like a result."""
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact(odd, empty):
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(odd).collect()}
    assert got == {(1, 1, 4), (2, 1, 4), (None, 1, 4), (3, 3, 2), (4, 3, 2), (5, 5, 1), (6, 6, 1), (7, 7, 1), (8, 8, 1)}
    kept = exact_dedup.exact_dedup(odd).filter("kept").collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 5, 6, 7, 8]
    assert next(r.text_sha256 for r in kept if r.doc_id == 1) == hashlib.sha256(b"a b c d e f").hexdigest()
    assert exact_dedup.drop_exact(odd).columns == odd.columns and exact_dedup.drop_exact(odd).count() == 6
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_exact_run_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.col("id").cast("string")).alias("text"))
        rows = exact_dedup.exact_dedup(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.kept for r in rows) == 1001 and {r.group_size for r in rows} == {1, 2000} and all(r.keep_id == (1 if r.doc_id % 3 else r.doc_id) for r in rows)


def test_ranges_follow_the_input(spark, odd, monkeypatch):
    from tarnbridge.llm import common

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert common.by_range(docs, "doc_id").rdd.getNumPartitions() <= 8
    monkeypatch.setattr(common, "RANGE_BYTES", 5_000)
    assert common.by_range(docs, "doc_id").rdd.getNumPartitions() > 8
    rows = exact_dedup.exact_dedup(docs)
    assert rows.count() == docs.count() and rows.filter("kept").count() == docs.select(exact_dedup.normalised(F.col("text"))).distinct().count()
    assert exact_dedup.drop_exact(odd).count() == 6


def test_quality(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit_quality(docs, labels, ~held_out())
    scored = quality_classifier.quality_scores(docs, model).join(labels, "doc_id").filter(held_out())
    rows = scored.collect()
    assert sum((r.score >= 0.3) == bool(r.quality) for r in rows) >= 0.85 * len(rows)
    assert all(0 <= r.score <= 1 for r in quality_classifier.quality_scores(odd, model).collect())
    assert quality_classifier.quality_scores(empty, model).count() == 0
    blank = quality_classifier.fit_quality(empty, labels)
    assert quality_classifier.score(blank, ["x"])[0] == 0.5
    data = bytes(range(256)) * 3 + b"tail"
    cut = quality_classifier.chunks(data)
    assert b"".join(c[: quality_classifier.CHUNK].tobytes() for c in cut)[: len(data)] == data


def test_quality_sample_counts_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(7, "text 7")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(j, j % 2) for i in range(50) for j in range(20)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier, "fit", seen.append)
    quality_classifier.fit_quality(docs, labels, rows=10)
    quality_classifier.fit_quality(docs, labels, rows=100)
    for (rows, n) in zip(seen, (10, 20), strict=True):
        assert [sum(y == c for _, y in rows) for c in (0, 1)] == [n, n] and len({bytes(x[0]) for x, _ in rows}) == 2 * n


def test_quality_against_plain_convolution():
    """Each filter at each byte of the whole document by loops, against the chunks."""
    q = quality_classifier
    m = {k: v + np.random.default_rng(4).standard_normal(v.shape).astype(np.float32) * 0.3 for k, v in q.initial().items()}
    texts = ["", "a", "x" * q.CHUNK, "déjà vu " * 80, "".join(chr(97 + i * i % 26) for i in range(3 * q.CHUNK + 7))]
    for t, got in zip(texts, q.score(m, texts), strict=True):
        data = t.encode()
        at = lambda i, d=data: d[i] if i < len(d) else 0
        pooled = []
        for begin in range(0, max(1, len(data)), q.CHUNK):
            best = [max(sum(float(m["filters"][j, at(p + j), k]) for j in range(q.WIDTH)) for p in range(begin, begin + q.CHUNK)) for k in range(q.FILTERS)]
            pooled.append([math.tanh(b + float(m["bias"][k])) for k, b in enumerate(best)])
        mean = [sum(c) / len(pooled) for c in zip(*pooled, strict=True)]
        hidden = [math.tanh(sum(mean[k] * float(m["w"][k, h]) for k in range(q.FILTERS)) + float(m["c"][h])) for h in range(q.HIDDEN)]
        want = 1 / (1 + math.exp(-(sum(h * float(v) for h, v in zip(hidden, m["v"], strict=True)) + float(m["d"][0]))))
        assert abs(got - want) < 1e-4


def test_bpe_caches_match_library():
    ids, counts = ByteLevelIds(queries.BYTE_BPE), WordCounts(queries.WORD_BPE)
    random.seed(4)
    parts = list("ab'sE \t\n\x1c\x85　.!1é") + ["<|endoftext|>", "don't", "İ", "​"]
    for _ in range(300):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        assert np.frombuffer(ids.encode([t])[0], "<u2").tolist() == ids.tok.encode(t, add_special_tokens=False).ids
        p = token_counts.Prefixes(t, counts)
        assert [p.at(i) for i in range(len(t) + 1)] == [counts.whole(t[:i]) for i in range(len(t) + 1)]
        n = p.longest(3)
        assert counts.whole(t[:n]) <= 3 and all(counts.whole(t[:i]) > 3 for i in range(n + 1, len(t) + 1))


def test_words_are_encoded_once_across_line_breaks():
    """Cuts at spaces and line breaks give the library's ids, and words at line ends are kept as such, not with the next line's first."""
    ids = ByteLevelIds(queries.BYTE_BPE)
    rng = random.Random(5)
    texts = ["".join(rng.choice(["ab", "x,", "don't", "'s", "1é", "\u200b"]) + rng.choice(" \n \t") for _ in range(rng.randint(1, 400))).strip() for _ in range(200)]
    want = [ids._whole(t) for t in texts]
    assert ids.encode(texts) == want and ids.encode(texts[::-1]) == want[::-1]
    ids = ByteLevelIds(queries.BYTE_BPE)
    ids.encode([f"a{chr(10)}b c{chr(10)}d", f"a{chr(10)}d c{chr(10)}b"])
    assert set(ids.words) == {"\na", "\nb", "c", "\nd"}
    with pytest.raises(ValueError):
        ByteLevelIds(queries.WORD_BPE)


def test_records(spark, odd, empty):
    folder = scratch(spark, "test-records")
    index = token_records.with_start(token_records.write_token_records(odd, folder, queries.BYTE_BPE))
    rows = sorted(token_records.read_token_records(index, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 2, 3, 4, 5, 6, 7, 8] and rows[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(rows, rows[1:]))
    tok = ByteLevelIds(queries.BYTE_BPE).tok
    assert np.frombuffer(rows[-2].ids, "<u4").tolist() == [*tok.encode(ROWS[8][1], add_special_tokens=False).ids, 0]
    record = token_records.frame(b"\x01\x02")
    assert token_records.unframe(record) == b"\x01\x02"
    with pytest.raises(ValueError):
        token_records.unframe(record[:13] + b"\xff" + record[14:])
    some = index.filter("doc_id in (1, 5, 8)").orderBy(F.desc("doc_id"))
    again = token_records.read_token_records(some, folder).collect()
    assert [(r.doc_id, r.start, r.ids) for r in again] == [(r.doc_id, r.start, r.ids) for r in reversed(rows) if r.doc_id in (1, 5, 8)]
    folder = scratch(spark, "test-records")
    assert token_records.read_token_records(token_records.with_start(token_records.write_token_records(empty, folder, queries.BYTE_BPE)), folder).count() == 0


def test_prefix_counts_try_only_pieces_that_can_end_there():
    counts = WordCounts(queries.WORD_BPE)
    assert counts.prefixes(["internationalisation", "Straßenbahn", "a"])[0][-1] == counts.whole("internationalisation")
    tail = counts.pieces.reach
    assert tail and all(len(v) < 4 or len(v) <= tail[v[-4:]] for v in counts.pieces.both)


def test_packing(odd, empty):
    assert [packing.piece_lengths(n) for n in (1, 5, 2048, 4103)] == [[1], [4, 1], [2048], [2048, 2048, 4, 2, 1]]
    rows = packing.pack(odd, queries.BYTE_BPE).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.offset == 0 and len(r.ids) == 4 * r.length for r in rows)
    long = sorted((r for r in rows if r.doc_id == 5), key=lambda r: r.start)
    ids = np.frombuffer(b"".join(r.ids for r in long), "<u4")
    assert ids[:-1].tolist() == ByteLevelIds(queries.BYTE_BPE).tok.encode(LONG, add_special_tokens=False).ids and ids[-1] == 1
    assert packing.pack(empty, queries.BYTE_BPE).count() == 0
    folder = scratch(odd.sparkSession, "test-buckets")
    packing.write_buckets(packing.pack(odd, queries.BYTE_BPE), folder)
    read = odd.sparkSession.read.parquet(folder)
    assert read.count() == len(rows) and read.filter("length = 2048").count() == sum(r.length == 2048 for r in rows)


def test_counts(odd, empty):
    rows = token_counts.token_counts(odd, queries.WORD_BPE, budget=10).collect()
    tok = WordCounts(queries.WORD_BPE)
    for r, (_, t, _) in zip(rows, ROWS, strict=True):
        t = t or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), tok.whole(t)) and tok.whole(t[: r.cut_chars]) <= 10
        assert list(r.word_tokens)[-1:] == ([r.n_tokens] if t.split() else []) and len(r.word_ends) == len(r.word_tokens)
    assert token_counts.token_counts(empty, queries.WORD_BPE).count() == 0


def test_counts_at_every_prefix(spark, odd):
    rng = random.Random(6)
    blob = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH") for _ in range(60_000))
    texts = ["extraordinarily", "they're we'll 'rest", "x<|endoftext|>y <|endoftext|", "e\u0301a\u030a\u1100\u1161\u11a8İΣ", "  ", "", blob]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = token_counts.token_counts(df, queries.WORD_BPE, budget=2).cache()
    tok = WordCounts(queries.WORD_BPE)
    for r in counted.collect():
        t, got = texts[r.doc_id], np.frombuffer(r.prefix_tokens, ">u4").tolist()
        assert len(got) == len(t) + 1 and got[-1] == r.n_tokens == tok.whole(t)
        at = range(len(t) + 1) if len(t) < 100 else [0, 1, 29, 777, 59_999, 60_000]
        assert [got[i] for i in at] == [tok.whole(t[:i]) for i in at]
        assert r.cut_chars == max(i for i, n in enumerate(got) if n <= 2)
    asked = counted.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(30))).alias("n"), "prefix_tokens").select("doc_id", "n", token_counts.tokens_at(F.col("n")).alias("tokens"))
    assert all(r.tokens == tok.whole(texts[r.doc_id][: r.n]) for r in asked.collect())
    few = token_counts.token_counts(odd, queries.WORD_BPE, budget=10, prefixes=False).collect()
    assert [tuple(r) for r in few] == [tuple(r)[:4] for r in token_counts.token_counts(odd, queries.WORD_BPE, budget=10).collect()]
    folder = scratch(spark, "test-counts")
    df.write.parquet(f"{folder}/documents.parquet")
    digests = {r.doc_id: r.prefix_tokens_crc32 for r in queries.op5_token_counts(spark, folder).collect()}
    assert digests[0] == zlib.crc32(np.array([tok.whole(texts[0][:i]) for i in range(len(texts[0]) + 1)], ">u4").tobytes())


def test_language(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model, langs = language_id.fit_languages(docs, ~held_out())
    rows = language_id.languages(docs, model, langs).filter(held_out()).select("lang", "predicted.*").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.85 * len(rows)
    got = {r.doc_id: r.predicted for r in language_id.languages(odd, model, langs).collect()}
    assert [got[i].lang_pred for i in (3, 4, 8)] == ["und"] * 3 and got[5].lang_pred in langs
    assert language_id.languages(empty, model, langs).count() == 0
    foreign = ["Dzisiaj jest bardzo ładna pogoda i idziemy na plażę ", "bugün hava çok güzel ve arkadaşlarımızla plaja gidiyoruz ", "Сегодня очень хорошая погода и мы идем на пляж ", "今日はとても天気がいいので、友達と海に泳ぎに行きます。"]
    clean = [r for r in docs.filter("n_chars > 600").collect()]
    mixed = spark.createDataFrame([(-1 - i, t * 9, None) for i, t in enumerate(foreign)] + [(r.doc_id, r.text, r.lang) for r in clean], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, mixed.withColumn("predicted", F.lit(1)), SF).collect()}
    assert kept.keys() == {r.doc_id for r in clean} and set(kept.values()) == set(langs)
    rare = mixed.filter("lang = 'en'").union(spark.createDataFrame([(10**6 + i, t * (i + 3), "pl") for i in range(9) for t in foreign[:1]], "doc_id long, text string, lang string"))
    assert language_id.fit_languages(rare, rows=20)[1] == ["en", "pl"]
    none, no_langs = language_id.fit_languages(empty.withColumn("lang", F.lit(None).cast("string")))
    assert language_id.languages(odd, none, no_langs).first().predicted.lang_pred == "und"


def test_rounding_settles_no_language(spark, monkeypatch):
    """Fits whose first weights differ as those of two machines do keep every text of a learned language, with signs or without."""
    g, first = language_id, language_id.initial
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars > 600").cache()
    texts = [r.text for r in docs.select("text").collect()]
    for seed in range(1, 4):
        rng = np.random.default_rng(seed)
        monkeypatch.setattr(g, "initial", lambda *a, rng=rng: {k: (v * (1 + 1e-6 * rng.standard_normal(v.shape))).astype(np.float32) for k, v in first(*a).items()})
        model, langs = g.fit_languages(docs, ~held_out())
        scores = spark.createDataFrame([(t,) for t in texts], "text string").transform(g.languages, model, langs).select("predicted.score").collect()
        assert min(r.score for r in scores) >= corpus_pipeline.MIN_LANGUAGE_SCORE


def test_signs_tell_no_language():
    lettered = language_id.lettered
    assert lettered(b"12 | ab | c3.\n\nd ...") == b"ab c d " and lettered("é¿x".encode()) == "é¿x".encode() and lettered(b"") == lettered(b" .") == b""


def test_language_against_a_loop_over_bytes():
    """The gates byte by byte, in both directions, and the mean over the letters."""
    g = language_id
    m = g.initial(3, seed=8)
    sig = lambda x: 1 / (1 + np.exp(-x))
    texts = ["Straße und Öl", "a" * (g.WINDOW + 5), "1 b", ""]
    for t, got in zip(texts, g.predict(m, texts), strict=True):
        data, total, letters = t.lower().encode(), np.zeros(3), 0
        for begin in range(0, max(1, len(data)), g.WINDOW):
            window = [data[i] if i < len(data) else 0 for i in range(begin, begin + g.WINDOW)]
            states = np.zeros((2, g.WINDOW, g.UNITS))
            for d, order in enumerate((range(g.WINDOW), range(g.WINDOW - 1, -1, -1))):
                h = np.zeros(g.UNITS)
                for i in order:
                    x, u = m["a"][d][window[i]].astype(float), h @ m["u"][d]
                    z, r = sig(x[: g.UNITS] + u[: g.UNITS]), sig(x[g.UNITS : 2 * g.UNITS] + u[g.UNITS : 2 * g.UNITS])
                    h = z * h + (1 - z) * np.tanh(x[2 * g.UNITS :] + r * u[2 * g.UNITS :])
                    states[d, i] = h
            for i, b in enumerate(window):
                if 97 <= b <= 122 or b >= 128:
                    e = np.exp(states[0, i] @ m["v"][0] + states[1, i] @ m["v"][1] + m["c"])
                    total, letters = total + e / e.sum(), letters + 1
        assert np.abs(got - total / max(1, letters)).max() < 1e-4


def test_backpropagation_through_time():
    rng = np.random.default_rng(0)
    m = {k: v.astype(np.float64) for k, v in language_id.initial(3).items()}
    x, y = rng.integers(97, 120, (4, 9)).astype(np.uint8), np.array([0, 1, 2, 1])
    g, _ = language_id.gradients(m, x, y)
    for k, at in (("u", (0, 2, 5)), ("u", (1, 3, 30)), ("v", (1, 0, 2)), ("a", (0, x[0, 3], 7)), ("c", (1,))):
        low, high = ({n: v.copy() for n, v in m.items()} for _ in range(2))
        low[k][at] -= 1e-3
        high[k][at] += 1e-3
        slope = (language_id.gradients(high, x, y)[1] - language_id.gradients(low, x, y)[1]) / 2e-3
        assert abs(slope - g[k][at]) < 2e-3 * max(1, abs(slope))


def test_near(spark, odd, empty):
    got = {r.doc_id: r for r in near_dedup.near_duplicates(odd).collect()}
    assert {i: got[i].class_id for i in (1, 2, None, 3, 4, 5, 6, 7)} == {1: 1, 2: 1, None: 1, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7} and got[1].group_size == 4
    assert sorted(r.doc_id for r in near_dedup.drop_near(odd).collect()) == [1, 3, 4, 5, 7, 8]
    assert near_dedup.near_duplicates(empty).count() == 0
    rng = random.Random(2)
    base = [f"t{rng.randrange(500)}" for _ in range(200)]
    copies = [(i, " ".join(w if k != i % 200 else f"new{i}" for k, w in enumerate(base)), None) for i in range(400)]
    other = [(i, " ".join(f"t{rng.randrange(500)}" for _ in range(200)), None) for i in range(400, 460)]
    rows = near_dedup.near_duplicates(spark.createDataFrame(copies + other, SCHEMA)).collect()
    assert {r.class_id for r in rows if r.doc_id < 400} == {0} and all(r.kept for r in rows if r.doc_id >= 400)


def test_near_against_all_pairs(spark):
    """Classes of similarities from 0.6 to 1, a passage that all texts share, and buckets of more than 64 nodes."""
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for family in range(4):
        base = [f"f{family}w{rng.randrange(3000)}" for _ in range(280)]
        for i in range(90):
            own = list(base)
            for at in rng.sample(range(280), i // 9):
                own[at] = f"e{family}x{i}x{at}"
            texts.append(" ".join(passage + own))
    texts += [" ".join(passage + [f"o{i}x{rng.randrange(9000)}" for _ in range(20)]) for i in range(90)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA)
    nodes = sorted(set(texts), key=texts.index)
    norm = spark.createDataFrame([(t,) for t in texts], "norm string")
    idf = near_dedup.inverse_frequencies(near_dedup.document_frequencies(norm))
    words, sizes = hashing.word_hashes(nodes)
    vectors = [near_dedup.vector(w, idf) for w in np.split(words, np.cumsum(sizes)[:-1])]
    root, seen = {t: i for i, t in enumerate(nodes)}, []
    for i in range(len(nodes)):
        for j in range(i):
            seen.append(s := near_dedup.similarity(vectors[i], vectors[j]))
            if s >= near_dedup.THRESHOLD and root[nodes[i]] != root[nodes[j]]:
                a, b = sorted((root[nodes[i]], root[nodes[j]]))
                root = {t: a if r == b else r for t, r in root.items()}
    assert all(sum(low <= s < low + 0.1 for s in seen) > 100 for low in (0.6, 0.7, 0.8, 0.9))
    want: dict = {}
    for i, t in enumerate(texts):
        want.setdefault(root[t], set()).add(i)
    got: dict = {}
    for r in near_dedup.near_duplicates(df).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and len(want) > 5


def test_near_recall_on_the_sample_table(spark):
    """All pairs of sf0.01 by plain sets of shingles, against the classes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, " ".join(re.split(r"[\x20\x09-\x0D]+", (r.text or "").lower())).strip(" ")) for r in docs.collect()]
    classes = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    idf = near_dedup.inverse_frequencies(near_dedup.document_frequencies(spark.createDataFrame([(t,) for _, t in rows], "norm string")))
    words, sizes = hashing.word_hashes([t for _, t in rows])
    vectors = [near_dedup.vector(w, idf) if len(w) else None for w in np.split(words, np.cumsum(sizes)[:-1])]
    # Pairs without a common shingle have similarity 0.
    holders: dict = {}
    for i, v in enumerate(vectors):
        for h in v[0].tolist() if v else ():
            holders.setdefault(h, []).append(i)
    together = {(i, j) for found in holders.values() for i in found for j in found if j < i}
    similar = [(i, j) for i, j in together if near_dedup.similarity(vectors[i], vectors[j]) >= near_dedup.THRESHOLD]
    pairs, exact = len(similar), sum(rows[i][1] == rows[j][1] for i, j in similar)
    links = sum(classes[rows[i][0]] == classes[rows[j][0]] for i, j in similar)
    assert pairs > 50 and pairs > exact and links >= 0.9 * pairs
    every = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs, agree=0).collect()}
    assert every == classes


CLASH = "doc_id long, text string, lang string, row string, rank int, others string, h string, who long, part int, run long, edge string, norm string, lead string, predicted string, kept string, settled int, `a.b``c` int, at map<string,int>"


def test_clashing_columns_and_ties(spark):
    """Columns named like the operators' own come through; of repeated rows the first in order stays."""
    base = [(1, "some words here to keep", "x"), (1, "some words  here to keep", "b"), (1, "some words here to keep", "a"), (2, "some words here to keep", "c"), (3, None, "n"), (4, "Some words here to keep", "d"), (None, None, None)]
    rows = [(i, t, "en", "r", 1, "o", "h", 5, 2, 3, "e", "n", "l", "p", k, 7, 8, {"a": 1}) for i, t, k in base]
    df = spark.createDataFrame(rows, CLASH)
    got = exact_dedup.drop_exact(df).collect()
    assert sorted((r.doc_id, r.kept) for r in got) == [(1, "b"), (3, "n"), (4, "d")] and got[0].asDict().keys() == set(df.columns)
    got = near_dedup.drop_near(df).collect()
    assert sorted(((r.doc_id, r.kept) for r in got), key=str) == [(1, "b"), (3, "n"), (None, None)] and got[0].at == {"a": 1}


def test_sampling_agrees_like_weighted_jaccard():
    rng = np.random.default_rng(1)
    found = np.sort(hashing.mix(np.arange(400, dtype=np.uint64)))
    w = rng.random(400).astype(np.float32) + np.float32(0.5)
    a, b = (found[:320], w[:320]), (found[80:], w[80:] * np.float32(1.2))
    s = near_dedup.Sampler(samples=2048)
    assert abs((s.sample(*a) == s.sample(*b)).mean() - near_dedup.similarity(a, b)) < 0.05


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = ["", "a bb a", "x" * 700 + " é " + "y" * 300, "bb", " ".join(f"w{i}" for i in range(500))]
    whole, counts = hashing.word_hashes(texts)
    monkeypatch.setattr(hashing, "BLOCK", 64)
    cut, again = hashing.word_hashes(texts)
    assert (whole == cut).all() and counts.tolist() == again.tolist() == [0, 3, 3, 1, 500]
    words = [w for t in texts if t for w in t.split(" ")]
    by_word: dict = {}
    for w, h in zip(words, whole.tolist(), strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_slices_are_bounded_by_bytes():
    texts = ["é" * n for n in (1, 300, 10_000, 2, 0, 700, 700, 700, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    parts = list(batches.slices([batch, batch.slice(0, 0)], size=2000))
    assert [x for ids, _ in parts for x in ids] == list(range(len(texts))) and [t for _, ts in parts for t in ts] == texts
    assert all(len(ts) == 1 or sum(len(t.encode()) for t in ts) <= 2000 for _, ts in parts) and len(parts) < len(texts)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20)] + [(100, 101), (7, 3), (101, 101)]
    work = Workspace(spark)
    got = dict(map(tuple, components.components(work, spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(21), 0), 100: 100, 101: 100}
    assert components.components(work, spark.createDataFrame([], "a long, b long")).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "a\\b<|im_end|>\n"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "assistant", ""), (1, 3, "assistant", None), (2, 5, None, "x"), (2, 1, "ro\nle", "<|im_more|>"), (None, 0, "assistant", "é\n"), (3, None, "user", "\\")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    chats = chat_format.format_chat(df)
    got = {r.conv_id: r for r in chats.select("conv_id", "formatted", chat_format.parse_chat(F.col("formatted")).alias("t"), chat_format.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1].t] == [(r, t or "") for _, _, r, t in rows[:4]] and got[1].loss == ["</s>[INST] ok [/INST]", "", ""]
    assert [tuple(t) for t in got[2].t] == [("ro\nle", "<|im_more|>"), ("", "x")] and got[None].loss == ["é\n"] and got[3].t[0].text == "\\"
    assert got[1].formatted.count("<|im_start|>") == 2 and "[INST]" not in got[1].formatted
    assert chat_format.format_chat(df.limit(0)).count() == 0


def _chats(spark, rows):
    chats = chat_format.format_chat(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    read = chats.select("formatted", "loss_spans", chat_format.parse_chat(F.col("formatted")).alias("t"), chat_format.loss_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return read.first()


def test_chat_of_any_length(spark):
    role = "r\n\\<|" * 25_000
    assert tuple(_chats(spark, [(1, 0, role, "\\n\n")]).t[0]) == (role, "\\n\n")
    text = "é<|im_end|>\\\n" * 400_000
    assert _chats(spark, [(1, 0, "assistant", text)]).loss == [text]
    took = []
    for n in (10_000, 20_000):
        rows = [(1, i, "assistant", f"turn é {i} <s>") for i in range(n)]
        began = time.time()
        got = _chats(spark, rows)
        took.append(time.time() - began)
        assert got.loss == [r[3] for r in rows] and [t.text for t in got.t] == got.loss
        assert [chat_format_plain(got.formatted[s.start : s.stop]) for s in got.loss_spans] == got.loss
    assert took[1] < 3 * took[0] + 3


def chat_format_plain(x: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", x)


def test_rules(odd, empty):
    got = {r.doc_id: r for r in quality_rules.quality_rules(odd).collect()}
    assert (got[3].n_words, got[3].base_failed, got[3].kept) == (0, True, False) and got[5].n_words == 3000 and got[5].n_repeat_words == 0
    assert quality_rules.quality_rules(empty).count() == 0
    spark = odd.sparkSession
    text = "a b c x a b c y\n\ndup\ndup\n$ #|"
    r = quality_rules.quality_rules(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_repeat_words, r.n_dup_lines, r.n_symbols, r.word_chars) == (6, 1, 3, 17)


def test_distance_against_the_formula(spark):
    """The square root of the Jensen-Shannon divergence in bits, by the sum of its terms."""
    for counts in ((1.0, 0, 3), (0, 0, 0), (5.0, 5, 5), (0, 7.0, 0)):
        for ref in ((0.2, 0.3, 0.5), (0.0, 1.0, 0.0)):
            got = spark.range(1).select(quality_rules.distance(F.array(*[F.lit(float(c)) for c in counts]), ref)).first()[0]
            want = 1.0
            if sum(counts):
                p = [c / sum(counts) for c in counts]
                want = math.sqrt(sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(p, ref, strict=True)) / 2)
            assert abs(got - want) < 1e-9


def test_rules_reject_long_texts_without_common_words(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    junk = [(-1, " ".join(f"ung{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)), None, None, None)]
    both = docs.select("doc_id", "text", "lang", "source", "n_chars").union(spark.createDataFrame(junk, "doc_id long, text string, lang string, source string, n_chars int"))
    rules = {r.doc_id: r for r in quality_rules.quality_rules(both).select("doc_id", "lang", "base_failed", "word_distance", "kept").collect()}
    assert not rules[-1].base_failed and rules[-1].word_distance == 1 and not rules[-1].kept
    assert corpus_pipeline.quality(spark, both, SF).filter("doc_id = -1").count() == 0
    good = [rules[r.doc_id] for r in labels.filter("quality = 1").collect() if not rules[r.doc_id].base_failed]
    assert {r.lang for r in good} == {"en", "fr", "de", "es"} and all(r.kept for r in good)


def test_rules_catch_symbols_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rules.quality_rules(docs).join(labels, "doc_id").filter(held_out() & ~F.col("base_failed")).select("quality", "symbol_distance", "kept").collect()
    junk, good = ([r for r in rows if r.quality == y] for y in (0, 1))
    assert junk and good and not any(r.kept for r in junk) and all(r.kept for r in good)
    assert all(r.symbol_distance > quality_rules.MAX_SYMBOL_DISTANCE for r in junk)
    words = spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en' and n_chars > 2000").first().text.split()[:300]
    mixed = " ".join(w + (" |" if i % 2 else "") for i, w in enumerate(words))
    r = quality_rules.quality_rules(spark.createDataFrame([(1, mixed)], "doc_id long, text string")).first()
    assert r.class_distance < quality_rules.MAX_CLASS_DISTANCE and not r.base_failed and not r.kept


def test_pieces(odd, empty):
    import sentencepiece

    model, library = piece_dropout.pieces(queries.PIECES), sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    texts = ["", " ", "Hello  world", "a\tb\n", "日本 \U0001f600", "x" * 60, LONG[:500], "        code"]
    keys = np.arange(len(texts))
    assert [x.tolist() for x in piece_dropout.segment(model, texts, keys, 0.0, 0)] == [library.encode(t) for t in texts]
    whole = piece_dropout.segment(model, [texts[-1]], keys[-1:], 1.0, 0)[0]
    assert len(whole) == len(texts[-1]) + 1
    encoded = piece_dropout.encode_pieces(odd, queries.PIECES, 0.3, seed=5)
    back = piece_dropout.decode_pieces(encoded, queries.PIECES).collect()
    assert [r.text for r in back] == [t or "" for _, t, _ in ROWS]
    other = piece_dropout.encode_pieces(odd, queries.PIECES, 0.3, seed=6).collect()
    assert [r.ids for r in encoded.collect()] == [r.ids for r in back] and back[5].ids != other[5].ids
    assert piece_dropout.encode_pieces(empty, queries.PIECES).count() == 0
    with pytest.raises(ValueError):
        piece_dropout.encode_pieces(odd, queries.PIECES, 2)


def _plain_agenda(model, text: str, key: int, limit: int) -> list[int]:
    """One word: in each round all candidates are looked at; the best rank is taken, then the leftmost."""
    left = [(int(model.symbols[ord(c)]), i, i + 1) for i, c in enumerate(text)]
    while True:
        best = None
        for k, (a, b) in enumerate(zip(left, left[1:])):
            found = model.pairs().get(a[0] * model.size + b[0]) if max(a[0], b[0]) < model.size else None
            if found and not (limit and piece_dropout.skipped(key, a[1], b[1], b[2], limit)) and (best is None or found[0] < best[0]):
                best = found[0], k, found[1]
        if best is None:
            return [x[0] for x in left]
        _, k, merged = best
        left[k : k + 2] = [(merged, left[k][1], left[k + 1][2])]


def test_dropout_against_a_plain_agenda():
    """Both ways, rounds over all words and a heap for a long one, at the same keyed hash."""
    model, rng = piece_dropout.pieces(queries.PIECES), random.Random(1)
    words = ["".join(rng.choice("abcdeinorst") for _ in range(n)) for n in (5, 30, 200, piece_dropout.LONG_WORD + 300)] + ["a" * 400]
    keys = np.arange(len(words)) + 77
    mixed = hashing.mix(keys.view(np.uint64) ^ hashing.mix(np.array([9], np.uint64)))
    seen = set()
    for dropout in (0.0, 0.1, 0.5):
        got = [x.tolist() for x in piece_dropout.segment(model, words, keys, dropout, 9)]
        limit = min(int(dropout * 2.0**64), 2**64 - 1)
        assert got == [_plain_agenda(model, piece_dropout.MARK + w, int(k), limit) for w, k in zip(words, mixed, strict=True)]
        assert [piece_dropout.decode(model, x) for x in got] == words
        seen.add(str(got))
    assert len(seen) == 3
    began = time.time()
    piece_dropout.segment(model, ["".join(rng.choice("abcdeinorst") for _ in range(100_000))], keys[:1], 0.1, 0)
    assert time.time() - began < 20


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF)
        sizes.append(docs.count())
    assert docs.columns == spark.read.parquet(f"{SF}/documents.parquet").columns and sizes == sorted(sizes, reverse=True)
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).filter("n <> m").count() == 0


def test_pipeline_stages_against_plain_python(spark, odd, empty):
    """The kept identifiers of every stage from rules by loops and sets, on a small table; nulls, no rows and clashing columns."""
    words = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en' and n_chars > 900").orderBy("doc_id").limit(4).collect()]
    rows = [(0, words[0]), (1, words[0].replace(" ", "  ", 5)), (2, words[0] + " more"), (3, words[1]), (4, words[1].replace("the", "The")), (5, None), (6, "short"), (7, "word " * 200), (8, words[2]), (9, words[2].replace(" ", " | ")), (10, words[3]), (3, words[1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", "y") for i, t in rows], "doc_id long, text string, lang string, source string, n_words long, predicted string, `kept.x` string")
    out = corpus_pipeline.quality(spark, docs, SF)
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 3, 3, 4, 8, 10] and out.columns == docs.columns and {r.n_words for r in out.collect()} == {1}
    out = corpus_pipeline.exact(spark, out, SF)
    assert sorted(r.doc_id for r in out.collect()) == [0, 2, 3, 4, 8, 10] and out.columns == docs.columns
    out = corpus_pipeline.near(spark, out, SF)
    assert sorted(r.doc_id for r in out.collect()) == [0, 3, 8, 10] and out.columns == docs.columns
    pieces = corpus_pipeline.pack(spark, out, SF)
    tok = ByteLevelIds(queries.BYTE_BPE).tok
    assert {r.doc_id: r.doc_tokens for r in pieces.collect()} == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in rows if i in (0, 3, 8, 10)}
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, empty.withColumn("lang", F.lit(None).cast("string")), SF)
        assert none.count() == 0, name
        stage(spark, odd.withColumn("lang", F.lit("en")), SF).collect()


def test_pipeline_bounds_what_python_holds(spark, odd):
    """Its tasks get batches of bounded bytes and keep a bounded number of words; what they return does not hang on either."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, f"w{i} " * 10_000) for i in range(500)], "doc_id long, text string").coalesce(1)

    def measure(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes]})

    try:
        for stage in (corpus_pipeline.language, corpus_pipeline.near, corpus_pipeline.pack):
            spark.conf.unset(bound)
            stage(spark, odd.withColumn("lang", F.lit("en")), SF)
            assert docs.mapInArrow(measure, "size long").agg(F.max("size")).head()[0] <= 1.1 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(bound, "1m")
        corpus_pipeline.pack(spark, odd, SF)
        assert spark.conf.get(bound) == "1m"
    finally:
        spark.conf.unset(bound)
    few, all_ = ByteLevelIds(queries.BYTE_BPE, 50), ByteLevelIds(queries.BYTE_BPE)
    for i in range(100):
        texts = [" ".join(f"v{j}" for j in range(i, i + 40))]
        assert few.encode(texts) == all_.encode(texts)
        assert len(few.words) + len(few.before) <= 2 * (50 + 40)
    assert len(all_.words) > 130
    columns = ("doc_id", "start", "length", "doc_tokens", "ids")
    assert sorted(map(str, packing.pack(odd, queries.BYTE_BPE, keep_words=3).select(*columns).collect())) == sorted(map(str, packing.pack(odd, queries.BYTE_BPE).select(*columns).collect()))


def test_checksums():
    assert zlib.crc32(b"123456789") == 0xCBF43926
