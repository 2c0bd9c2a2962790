"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

The agenda of a word holds the pairs of neighbouring symbols that form a piece; the
best score is taken first, then the leftmost. A candidate is the pair at its place in
the text, and a keyed hash of the seed, the document and that place decides whether
it is skipped: so a document's segmentation depends on nothing else, and each seed
gives another. Without dropout the pieces are the library's.

Symbols of all words of many texts stand in one array. A round takes one agenda entry
of every word at once; words without candidates leave the array. A word of more than
LONG_WORD characters has a heap of its own, so that its work grows with its length and
the logarithm of that, not with the square.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import arrow, batch, slices
from .common import plain
from .hashing import U, mix

MARK = "▁"
#: Characters that a task segments at a time.
GROUP_CHARS = 200_000

#: Longer words get a heap.
LONG_WORD = 256

_STAND_IN = chr(0x10FFFF)
_TABLE_BITS = 21
_loaded: dict = {}


class Pieces:
    """The pieces of a model file: symbols of characters, merges of symbol pairs, and bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        text = [model.id_to_piece(i) for i in range(self.size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(self.size)]
        self.byte_ids = np.zeros(256, np.int64)
        ids: dict[str, int] = {}
        self.bytes: list[bytes] = []
        for i, p in enumerate(text):
            if model.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
            elif special[i]:
                self.bytes.append(b"")
            else:
                ids[p] = i
                self.bytes.append(p.replace(MARK, " ").encode())
        self.symbols = np.arange(self.size, self.size + 0x110000, dtype=np.int64)  # unknown characters come after the pieces
        for p, i in ids.items():
            if len(p) == 1:
                self.symbols[ord(p)] = i
        order = {s: r for r, s in enumerate(sorted({model.get_score(i) for i in ids.values()}, reverse=True))}
        merges = {(ids[p[:k]], ids[p[k:]]): (order[model.get_score(i)], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        keys = np.array([a * self.size + b for a, b in merges], np.int64)
        sort = np.argsort(keys)
        values = np.array(list(merges.values()), np.int64).reshape(-1, 2)[sort]
        self.keys, self.rank, self.merged = keys[sort], values[:, 0], values[:, 1]
        # The place of each key by its hash: -1 for none, -2 for several.
        slots = self._slots(self.keys)
        self.table = np.full(1 << _TABLE_BITS, -1, np.int32)
        self.table[slots] = np.arange(len(slots))
        self.table[np.flatnonzero(np.bincount(slots, minlength=1 << _TABLE_BITS) > 1)] = -2
        self.by_pair: dict[int, tuple[int, int]] = {}

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys.view(U) * U(0x9E3779B97F4A7C15)) >> U(64 - _TABLE_BITS)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The merge of each pair of symbols, or -1."""
        key = np.where((a < self.size) & (b < self.size), a * self.size + b, -1)
        at = self.table[self._slots(key)].astype(np.int64)
        several = np.flatnonzero(at == -2)
        at[several] = np.minimum(np.searchsorted(self.keys, key[several]), len(self.keys) - 1)
        return np.where((at >= 0) & (self.keys[at] == key), at, -1)


    def pairs(self) -> dict[int, tuple[int, int]]:
        """The rank and the piece of each pair's merge, by the pair's key."""
        if not self.by_pair:
            self.by_pair = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist(), strict=True), strict=True))
        return self.by_pair


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _mixed(x: int) -> int:
    """``mix`` of one integer."""
    x = (x + 0x9E3779B97F4A7C15) & _ALL
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & _ALL
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & _ALL
    return x ^ x >> 31


_ALL = (1 << 64) - 1


def skipped(key: int, start: int, middle: int, stop: int, limit: int) -> bool:
    """Whether the candidate of text[start:middle] and text[middle:stop] is skipped in the document of this key."""
    return _mixed(_mixed(_mixed(start ^ key) ^ middle) ^ stop) < limit


def _by_heap(model: Pieces, symbols: list[int], place: int, key: int, limit: int) -> tuple[list[int], list[int]]:
    """The starts in the word, and the symbols, that are left of one word at ``place`` in its document."""
    pairs, size, n = model.pairs(), model.size, len(symbols)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    #: For each symbol the merge with the next one; an entry of the agenda holds while this has its rank.
    now: list = [None] * n

    def candidate(a: int):
        b = end[a]
        found = None
        if b < n and symbols[a] < size and symbols[b] < size:
            found = pairs.get(symbols[a] * size + symbols[b])
            if found and limit and skipped(key, place + a, place + b, place + end[b], limit):
                found = None
        now[a] = found
        return found

    agenda = [found[0] << 32 | a for a in range(n) if (found := candidate(a))]
    heapify(agenda)
    while agenda:
        entry = heappop(agenda)
        a = entry & 0xFFFFFFFF
        if now[a] is None or now[a][0] != entry >> 32:
            continue
        b = end[a]
        symbols[a], end[a], now[b], symbols[b] = now[a][1], end[b], None, -1
        if end[a] < n:
            before[end[a]] = a
        for left in (before[a], a):
            if left >= 0 and (found := candidate(left)):
                heappush(agenda, found[0] << 32 | left)
    starts = [a for a in range(n) if symbols[a] >= 0]
    return starts, [symbols[a] for a in starts]


def segment(model: Pieces, texts: list[str], keys: np.ndarray, dropout: float, seed: int) -> list[np.ndarray]:
    """The piece ids of each text. keys: 64 bits for each document, for the hash."""
    # A mark that the text itself holds must not become a space: the last code point stands for it, and it is spelled in bytes.
    marked = [MARK + t.replace(MARK, _STAND_IN).replace(" ", MARK) if t else "" for t in texts]
    sizes = np.array([len(m) for m in marked], np.int64)
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    own = np.zeros(0, np.int64)
    if any(_STAND_IN in m for m in marked):
        given = np.frombuffer("".join(MARK + t for t in texts if t).encode("utf-32-le", "surrogatepass"), "<u4")
        own = np.flatnonzero((given == ord(MARK)) & (chars == ord(_STAND_IN)))
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full(len(chars), -1, np.int64)
    begins = chars == ord(MARK)
    begins[1:] &= chars[:-1] != ord(MARK)
    begins[first[sizes > 0]] = True
    start = np.arange(len(chars))
    stop, symbol, word = start + 1, model.symbols[chars], np.cumsum(begins)
    limit = U(min(int(dropout * 2.0**64), 2**64 - 1))
    key = mix(keys.astype(np.int64).view(U) ^ mix(np.array([seed], np.int64).view(U)))
    none = np.int64(1) << 62
    heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    lengths = np.diff(np.concatenate([heads, [len(word)]]))
    for h, n in zip(heads[lengths > LONG_WORD].tolist(), lengths[lengths > LONG_WORD].tolist(), strict=True):
        d = int(doc[h])
        starts, left = _by_heap(model, symbol[h : h + n].tolist(), h - int(first[d]), int(key[d]), int(limit))
        out[h + np.array(starts)] = left
    if (lengths > LONG_WORD).any():
        short = np.repeat(lengths <= LONG_WORD, lengths)
        symbol, start, stop, word = symbol[short], start[short], stop[short], word[short]
    while len(symbol):
        merge = np.full(len(symbol), -1, np.int64)
        inside = np.flatnonzero(word[:-1] == word[1:])
        merge[inside] = model.find(symbol[inside], symbol[inside + 1])
        if dropout > 0:
            at = np.flatnonzero(merge >= 0)
            d = doc[start[at]]
            place = mix((start[at] - first[d]).view(U) ^ key[d])
            place = mix(mix(place ^ (start[at + 1] - first[d]).view(U)) ^ (stop[at + 1] - first[d]).view(U))
            merge[at[place < limit]] = -1
        entry = np.where(merge >= 0, (model.rank[merge] << 40) | np.arange(len(merge)), none)
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.minimum.reduceat(entry, heads)
        lengths = np.diff(np.concatenate([heads, [len(word)]]))
        over = np.repeat(best == none, lengths)
        out[start[over]] = symbol[over]
        at = (best[best != none] & ((1 << 40) - 1)).astype(np.int64)
        symbol[at], stop[at] = model.merged[merge[at]], stop[at + 1]
        left = ~over
        left[at + 1] = False
        symbol, start, stop, word = symbol[left], start[left], stop[left], word[left]
    used = out >= 0
    ids, owner = out[used], doc[used]
    unknown = np.flatnonzero(ids >= model.size)
    if len(unknown):
        points = ids[unknown] - model.size
        if len(own):
            points = np.where(np.isin(np.flatnonzero(used)[unknown], own), ord(MARK), points)
        spelled = "".join(map(chr, points.tolist())).encode("utf-8", "surrogatepass")
        width = np.ones(len(ids), np.int64)
        width[unknown] = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        is_byte = np.zeros(len(ids), bool)
        is_byte[unknown] = True
        ids, owner, is_byte = np.repeat(ids, width), np.repeat(owner, width), np.repeat(is_byte, width)
        ids[is_byte] = model.byte_ids[np.frombuffer(spelled, np.uint8)]
    return np.split(ids, np.cumsum(np.bincount(owner, minlength=len(sizes)))[:-1]) if len(sizes) else []


def decode(model: Pieces, ids) -> str:
    """The text of piece ids: the pieces' bytes, without the space put before the text."""
    return b"".join([model.bytes[i] for i in ids])[1:].decode("utf-8", "surrogatepass")


def encode_pieces(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pieces, ids (unsigned 32-bit little-endian), text_sha256.

    Each candidate merge is skipped with probability ``dropout``; the same seed, identifier and
    text give the same ids. A null text counts as empty and has no pieces. A mark in a text is
    spelled in bytes, so that it comes back. Texts and words may be of any length. Repeated rows
    get equal ids; an empty table gives no rows. Other columns are ignored. No shuffle.
    """
    if not 0 <= dropout <= 1:
        raise ValueError("dropout must be between 0 and 1")
    schema, kind = arrow("doc_id {id}, n_pieces long, ids binary, text_sha256 string", docs.schema[doc_id].dataType)
    rows = plain(docs, doc_id, text).select("doc_id", "text", F.xxhash64("doc_id").alias("key"), F.sha2("text", 256).alias("sha"))

    def run(batches):
        loaded = pieces(model)
        for ids, texts, keys, shas in slices(batches):
            at = 0
            while at < len(texts):
                end, chars = at + 1, len(texts[at])
                while end < len(texts) and chars + len(texts[end]) <= GROUP_CHARS:
                    chars += len(texts[end])
                    end += 1
                found = segment(loaded, texts[at:end], np.array(keys[at:end], np.int64), dropout, seed)
                yield batch(kind, doc_id=ids[at:end], n_pieces=[len(x) for x in found], ids=[x.astype("<u4").tobytes() for x in found], text_sha256=shas[at:end])
                at = end

    return rows.mapInArrow(run, schema)


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode_pieces`` with ``text``, decoded from the ids; null ids give a null text."""
    schema, kind = arrow("doc_id {id}, n_pieces long, ids binary, text_sha256 string, text string", encoded.schema["doc_id"].dataType)

    def run(batches):
        loaded = pieces(model)
        for doc_id, n_pieces, ids, sha in slices(batches, text_at=2):
            texts = [None if x is None else decode(loaded, np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield batch(kind, doc_id=doc_id, n_pieces=n_pieces, ids=ids, text_sha256=sha, text=texts)

    return encoded.select("doc_id", "n_pieces", "ids", "text_sha256").mapInArrow(run, schema)
