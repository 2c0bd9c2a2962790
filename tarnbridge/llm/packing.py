"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many
of the longest as fit, then one for each set bit of the rest, longest first. Each
piece is a sequence of its own, and pieces of equal length form a bucket to draw
batches from. So no sequence holds two documents, and nothing is padded.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .batches import arrow, batch, slices
from .chunk_cache import CACHE_WORDS, ByteLevelIds, shared
from .common import plain

_PIECES = "doc_id {id}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def piece_lengths(n: int, longest: int = 2048) -> list[int]:
    """The piece lengths of n tokens, in order; ``longest`` is a power of two."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", keep_words: int = CACHE_WORDS) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit little-endian).

    A document's tokens are the text's ids and ``end_id``; a null text counts as empty and
    gives one piece of one token. ``sequence_id`` has the bucket (binary logarithm of the
    length) in its highest bits, then the partition and a count in it, so it is unique without
    a shuffle; repeated rows get sequences of their own. ``offset`` is 0: a piece fills its
    sequence. Texts of any length are encoded whole. An empty table gives no rows. Other columns are ignored. No shuffle.
    ``keep_words`` bounds the different words in each of the two generations that a worker keeps
    with their ids: fewer take less memory and more time, and change no row.
    """
    schema, kind = arrow(_PIECES, docs.schema[doc_id].dataType)
    piece_lengths(0, longest)

    def cut(batches):
        encoder, part, number = shared(ByteLevelIds, tokenizer, keep_words), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u2").tobytes()
        for ids, texts in slices(batches):
            rows: dict[str, list] = {n: [] for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "ids")}
            for i, payload in zip(ids, encoder.encode(texts), strict=True):
                tokens = np.frombuffer(payload + end, "<u2").astype("<u4")
                start = 0
                for n in piece_lengths(len(tokens), longest):
                    for name, v in zip(rows, (i, start, n, len(tokens), (n.bit_length() - 1) << 58 | part << 34 | number, tokens[start : start + n].tobytes()), strict=True):
                        rows[name].append(v)
                    start += n
                    number += 1
            yield batch(kind, offset=[0] * len(rows["doc_id"]), **rows)

    return plain(docs, doc_id, text).mapInArrow(cut, schema)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Writes the pieces as Parquet with a folder for each length."""
    pieces.write.partitionBy("length").parquet(folder)
