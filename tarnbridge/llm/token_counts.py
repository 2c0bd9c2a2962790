"""Token counts at every prefix of a text, by dynamic programming over the vocabulary's pieces.

The vocabulary drops white space and cuts a text there before any merge, so the
count of a prefix is a running sum over the words that it holds whole, plus that of
the rest of a word. Inside a word the counts come from the tables of
``prefix_counts``, one step for each character. So a truncation to a budget, and
any question about a prefix, reads the stored counts and never encodes the text again.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import arrow, batch, slices
from .chunk_cache import WordCounts, shared
from .common import plain

#: The code points of Unicode's White_Space property.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[^{WHITE_SPACE}]+")

_COUNTS = "doc_id {id}, n_bytes long, n_tokens long, cut_chars long"
_PREFIXES = ", word_ends array<int>, word_tokens array<long>, prefix_tokens binary"


def _spans(text: str, special: list[str]):
    """(start, end) of each special string and of each word around them."""
    at = 0
    for m in re.finditer("|".join(map(re.escape, special)) or r"(?!)", text):
        yield from (w.span() for w in _WORD.finditer(text, at, m.start()))
        yield m.span()
        at = m.end()
    yield from (w.span() for w in _WORD.finditer(text, at))


_IS_SPACE = np.array([not _WORD.match(chr(i)) for i in range(0x3002)])


def _bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The starts and the ends of the words of a text without special strings."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = ~_IS_SPACE[np.minimum(points, 0x3001)]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _words(text: str, encoder: WordCounts) -> list[str]:
    return text.split() if encoder.splits(text) else [text[a:b] for a, b in _spans(text, encoder.special)]


class Prefixes:
    """The token count of every prefix of one text."""

    def __init__(self, text: str, encoder: WordCounts):
        special, joins = set(encoder.special), []
        if encoder.splits(text):
            words, (starts, self.ends) = text.split(), _bounds(text)
        else:
            spans = list(_spans(text, encoder.special))
            words = [text[a:b] for a, b in spans]
            starts, self.ends = np.array(spans, np.int64).reshape(-1, 2).T
            joins = [i for i, w in enumerate(words) if w in special]
        found = encoder.prefixes(words if not joins else [w for w in words if w not in special])
        for i in joins:
            # A part of a special string is ordinary text, which joins the word that it follows; its count less that word's may be negative.
            joined = i > 0 and self.ends[i - 1] == starts[i] and words[i - 1] not in special
            begun = words[i - 1] if joined else ""
            counts = encoder.prefixes([begun + words[i][:-1]])[0]
            before = counts[len(begun) - 1] if joined else 0
            found.insert(i, [*(c - before for c in counts[len(begun) :]), 1])
        self.length, n = len(text), len(words)
        self.sums = np.cumsum(np.array([0, *[f[-1] for f in found]], np.int64))
        try:
            inside = np.frombuffer(b"".join(found), np.uint8)
        except TypeError:  # some are lists
            inside = np.concatenate([np.frombuffer(f, np.uint8) if isinstance(f, bytes) else np.array(f, np.int64) for f in found])
        # In turn the positions up to a word's start, from the end of the one before, and those inside it.
        lengths, values = np.zeros(2 * n + 1, np.int64), np.zeros(2 * n + 1, np.int64)
        lengths[0::2] = np.append(starts, len(text)) - np.append(0, self.ends)
        lengths[0] += 1
        lengths[1::2] = self.ends - starts
        values[0::2], values[1::2] = self.sums, self.sums[:-1]
        self.counts = np.repeat(values, lengths)
        self.counts[np.repeat(np.arange(2 * n + 1) % 2 == 1, lengths)] += inside

    def at(self, end: int) -> int:
        """The tokens of text[:end]."""
        return int(self.counts[min(end, self.length)])

    def longest(self, budget: int) -> int:
        """The length of the longest prefix of at most ``budget`` tokens."""
        return int(np.flatnonzero(self.counts <= budget)[-1])

    def stored(self) -> bytes:
        """The counts at 0, 1, ... code points as big-endian 32-bit integers."""
        return self.counts.astype(">u4").tobytes()


def token_counts(docs: DataFrame, tokenizer: str, budget: int = 2048, prefixes: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, cut_chars and, with ``prefixes``, word_ends, word_tokens and prefix_tokens.

    ``word_ends`` has the code point at which each word ends and ``word_tokens`` the tokens up
    to there; ``prefix_tokens`` has the tokens of the prefixes of 0, 1, ... code points, as
    big-endian 32-bit integers, for ``tokens_at``; ``cut_chars`` is the length of the longest prefix of at most ``budget`` tokens.
    A null text counts as empty: no bytes, no tokens. Special strings inside texts are one
    token each, as the library's default is. Texts and words may be of any length: the work grows
    in proportion. Repeated rows are counted each; an empty table
    gives no rows. Other columns are ignored. No shuffle.
    """
    schema, kind = arrow(_COUNTS + _PREFIXES * prefixes, docs.schema[doc_id].dataType)

    def count(batches):
        encoder = shared(WordCounts, tokenizer)
        for ids, texts in slices(batches):
            rows: dict[str, list] = {n: [] for n in kind.names[1:]}
            rows["n_bytes"] = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            if prefixes:
                for t in texts:
                    p = Prefixes(t, encoder)
                    rows["n_tokens"].append(p.at(len(t)))
                    rows["cut_chars"].append(p.longest(budget))
                    rows["word_ends"].append(p.ends)
                    rows["word_tokens"].append(p.sums[1:])
                    rows["prefix_tokens"].append(p.stored())
            else:
                words = [_words(t, encoder) for t in texts]
                known = encoder.learn(w for ws in words for w in ws)
                for t, ws in zip(texts, words, strict=True):
                    n = sum([known[w] for w in ws])
                    rows["n_tokens"].append(n)
                    rows["cut_chars"].append(len(t) if n <= budget else Prefixes(t, encoder).longest(budget))
            yield batch(kind, doc_id=ids, **rows)

    return plain(docs, doc_id, text).mapInArrow(count, schema)


def tokens_at(chars, prefix_tokens="prefix_tokens"):
    """The tokens of the prefix of ``chars`` code points, a column or number, from the stored column alone; of the whole text beyond its end."""
    stored, chars = F.col(prefix_tokens), F.lit(chars) if isinstance(chars, int) else chars
    at = F.least(F.greatest(chars, F.lit(0)) * 4, F.octet_length(stored) - 4).cast("int") + 1
    return F.conv(F.hex(F.substring(stored, at, F.lit(4))), 16, 10).cast("long")
