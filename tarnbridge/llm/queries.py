"""The operators applied to the tables of a data folder, and SQL for the same results where SQL can give them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, exact_dedup, language_id, near_dedup, packing, piece_dropout, quality_classifier, quality_rules, token_counts, token_records
from .common import held_out, scratch, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out())
    scored = quality_classifier.quality_scores(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-records")
    index = token_records.write_token_records(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=0)
    read = token_records.read_token_records(token_records.with_start(index), folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, longest=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), WORD_BPE, budget=2048)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "cut_chars", F.crc32("prefix_tokens").alias("prefix_tokens_crc32"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, langs = language_id.fit_languages(docs, ~held_out())
    return language_id.languages(docs, model, langs).select("doc_id", held_out().alias("held_out"), "predicted.*")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "group_size", "kept")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{text}'), (-1L, 1L, 'assistant', '{text}') AS t(conv_id, turn, role, text)")
    chats = chat_format.format_chat(turns.union(extra))
    read = chats.select("conv_id", "formatted", chat_format.parse_chat(F.col("formatted")).alias("turns"), F.array_join(chat_format.loss_texts(F.col("formatted"), F.col("loss_spans")), "").alias("loss"))
    spelled = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = piece_dropout.encode_pieces(table(spark, sf_dir, "documents"), PIECES, dropout=0.1, seed=0)
    read = piece_dropout.decode_pieces(encoded, PIECES)
    return read.select("doc_id", "n_pieces", F.crc32("ids").alias("ids_crc32"), (F.sha2("text", 256) == F.col("text_sha256")).alias("lossless"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_exact_dedup, op2_quality_classifier, op3_token_records, op4_packing, op5_token_counts, op6_language_id, op7_near_dedup, op8_chat_format, op9_quality_rules, op10_piece_dropout)
    return {f.__name__: f for f in (*ops, pipeline)}


_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

_EXACT = f"""
WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)
"""


def _sql_escape(x: str) -> str:
    x = f"replace({x}, '\\', '\\\\')"
    for c in chat_format.CONTROL:
        x = f"replace({x}, '{c}', '{c[0]}\\{c[1:]}')"
    return x


_CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))),
w AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS prev, length({_sql_escape('text')}) AS n,
        length(replace({_sql_escape('role')}, chr(10), '\\' || chr(10))) AS r FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + CASE WHEN prev IS NOT DISTINCT FROM role THEN {len(chat_format.MORE)} ELSE {len(chat_format.START) + 1 + len(chat_format.END)} + r END)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id
"""


def _sql_text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _sql_distance(counts: list[str], total: str, reference: tuple[float, ...]) -> str:
    terms = []
    for c, r in zip(counts, reference, strict=True):
        p, q = f"({c} / {total})", r / sum(reference)
        m = f"(({p} + {q!r}) / 2)"
        terms.append(f"(CASE WHEN {p} > 0 THEN {p} * log2({p} / {m}) ELSE 0 END" + (f" + {q!r} * log2({q!r} / {m})" if q else "") + ")")
    return f"CASE WHEN {total} > 0 THEN sqrt(greatest(({' + '.join(terms)}) / 2, 0)) ELSE 1 END"


def _rules() -> str:
    """The rules in SQL: windows are grouped, histograms counted from the words."""
    q = quality_rules
    classes = [f"k[{i + 1}]" for i in range(len(q.CLASSES))]
    words = [f"c[{i + 1}]" for i in range(16)]
    chars = ", ".join(f"(length(text) - length(regexp_replace(text, {_sql_text(p)}, '', 'g')))::DOUBLE" for p in q.CLASSES.values())
    by_class = ", ".join(_sql_distance(classes, "kt", r) for r in q.CLASS_REFERENCES.values())
    by_word = " ".join(f"WHEN {i} THEN {_sql_distance(words, 'ct', r)}" for i, r in enumerate(q.COMMON_SHARES.values(), 1))
    symbols = _sql_distance(["n_symbols", "(word_chars - n_symbols)"], "word_chars", (q.SYMBOL_SHARE, 1 - q.SYMBOL_SHARE))
    langs = ", ".join("[" + ", ".join(_sql_text(w) for w in ws) + "]" for ws in q.COMMON_WORDS.values())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
e AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
t AS (SELECT doc_id, i, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS tri FROM e WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM t WHERE tri IS NOT NULL),
p AS (SELECT doc_id, count(DISTINCT i + j)::BIGINT AS n_repeat_words FROM r, (VALUES (0), (1), (2)) AS v(j) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
h AS (SELECT doc_id, [{chars}] AS k FROM d),
f AS (SELECT doc_id, lower(word) AS word, count(*) AS n FROM e GROUP BY ALL),
g AS (SELECT doc_id, lang, list(n::DOUBLE ORDER BY pos) AS c FROM
        (SELECT x.doc_id, x.lang, x.pos, coalesce(f.n, 0) AS n FROM
          (SELECT doc_id, lang, unnest(list) AS word, generate_subscripts(list, 1) AS pos FROM d, (SELECT unnest([{langs}]) AS list, generate_subscripts([{langs}], 1) AS lang)) x
          LEFT JOIN f ON f.doc_id = x.doc_id AND f.word = x.word) GROUP BY doc_id, lang),
gd AS (SELECT doc_id, min(CASE lang {by_word} END) AS word_distance FROM (SELECT *, list_sum(c) AS ct FROM g) GROUP BY doc_id),
hd AS (SELECT doc_id, k, least({by_class}) AS class_distance FROM (SELECT *, list_sum(k) AS kt FROM h)),
a AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars, k[4]::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, class_distance, word_distance
      FROM w JOIN l USING (doc_id) JOIN hd USING (doc_id) JOIN gd USING (doc_id) LEFT JOIN p USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {symbols} AS symbol_distance FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (word_chars >= {q.MIN_CHARS} AND (class_distance > {q.MAX_CLASS_DISTANCE} OR symbol_distance > {q.MAX_SYMBOL_DISTANCE})) AND NOT (n_words >= {q.MIN_WORDS} AND word_distance > {q.MAX_WORD_DISTANCE}) AS kept
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": _EXACT, "op8_chat_format": _CHAT, "op9_quality_rules": _rules()}
