"""Token ids and counts of whole texts by the tokenizers library, with each different word encoded once.

Both vocabularies here cut a text at white space before any merge, so a text's
tokens are those of its words in order. A worker process encodes a word when it
first meets it and keeps the result in a dictionary of bounded size; what a text
gives does not depend on what the dictionary holds.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

#: Different words in each of the two generations that a worker keeps: beyond that the older one goes, but for the words used since.
CACHE_WORDS = 500_000

#: Words that the library encodes as one text.
GROUP_WORDS = 100

#: Longer words are not kept with the counts of their prefixes.
LONG_WORD = 64

_TWO_SPACES = re.compile(r"\s\s")
#: Python counts these as white space; the libraries' patterns do not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_kept: dict = {}


def tokenizer(path: str):
    """The tokenizer of a file, loaded once in a process."""
    if path not in _kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _kept[path] = Tokenizer.from_file(path)
    return _kept[path]


def specials(path: str) -> list[str]:
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


class ByteLevelIds:
    """Token ids of a byte-level vocabulary of at most 65,536 entries, as little-endian 16-bit integers.

    A space between two characters that are not white space begins the token after it, and
    a line break there is a token by itself, so a text may be cut at both: each word is encoded
    with the space or the line break before it.
    """

    def __init__(self, path: str, keep: int = CACHE_WORDS):
        self.tok, self.words, self.before, self.keep = tokenizer(path), {}, {}, keep
        self.special = specials(path)
        if self.tok.get_vocab_size() > 65_536:
            raise ValueError("ids must fit 16 bits")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec["pre_tokenizer"]
        if spec["normalizer"] or split["type"] != "ByteLevel" or not split["use_regex"] or split["add_prefix_space"] or any(map(str.isspace, "".join(self.special))):
            raise ValueError("texts of this kind of vocabulary may not be cut at spaces and line breaks")
        #: Whether an id's bytes begin with a space or a line break: no other id of a word does.
        self.begins = np.zeros(65_536, bool)
        self.begins[[i for v, i in self.tok.get_vocab().items() if v[0] in "\u0120\u010a"]] = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u2").tobytes()

    def _learn(self, new: list[str]) -> None:
        """Encodes words in groups: those that do not begin with a line break have a space before them."""
        joined = ["".join([w if w[0] == "\n" else " " + w for w in new[i : i + GROUP_WORDS]]) for i in range(0, len(new), GROUP_WORDS)]
        ids = np.array([i for e in self.tok.encode_batch_fast(joined, add_special_tokens=False) for i in e.ids], "<u2")
        starts, payload = (2 * np.flatnonzero(self.begins[ids])).tolist(), ids.tobytes()
        self.words.update((w, payload[a:b]) for w, a, b in zip(new, starts, [*starts[1:], len(payload)], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.keep:
            self.before, self.words = self.words, {}
        words, before, cut, new = self.words, self.before, [], set()
        for text in texts:
            if not text or _TWO_SPACES.search(text) or text[0].isspace() or text[-1].isspace() or any(s in text for s in self.special):
                cut.append(None)
                continue
            # The text's own first word is encoded after a line break, whose token is dropped below.
            parts = ("\n" + text).replace("\n", " \n").split(" ")[1:]
            cut.append(parts)
            new.update(parts)
        new = [w for w in new if w not in words]
        if before:
            words.update([(w, before[w]) for w in new if w in before])
            new = [w for w in new if w not in before]
        if new:
            self._learn(new)
        found = words.__getitem__
        return [self._whole(t) if p is None else b"".join(map(found, p))[2:] for t, p in zip(texts, cut, strict=True)]


class WordCounts:
    """Token counts of a vocabulary that drops white space, for each word of a text."""

    def __init__(self, path: str):
        self.tok, self.counts, self.before = tokenizer(path), {}, {}
        self.path, self.special, self.pieces = path, specials(path), None
        self.inside, self.inside_before = {}, {}

    def prefixes(self, words: list[str]) -> list:
        """For each word the tokens of its prefixes of 1, 2, ... characters: as bytes, or as a list where they exceed 255."""
        if self.pieces is None:
            from .prefix_counts import PrefixCounts

            self.pieces = PrefixCounts(self.path, self.tok)
        if len(self.inside) > CACHE_WORDS:
            self.inside_before, self.inside = self.inside, {}
        inside, before, out = self.inside, self.inside_before, list(map(self.inside.get, words))
        for i in [i for i, f in enumerate(out) if f is None]:
            w = words[i]
            found = inside.get(w) or before.get(w)
            if found is None:
                found = self.pieces.counts(w)
                found = bytes(found) if max(found) < 256 else found
            if len(w) <= LONG_WORD:
                inside[w] = found
            out[i] = found
        return out

    def whole(self, text: str) -> int:
        return len(self.tok.encode(text, add_special_tokens=False).ids)

    def splits(self, text: str) -> bool:
        """Whether the text's tokens are those of its words."""
        return not (_SEPARATORS.search(text) or any(s in text for s in self.special))

    def learn(self, words) -> dict[str, int]:
        words = set(words)
        if len(self.counts) > CACHE_WORDS:
            self.before, self.counts = self.counts, {}
        self.counts.update((w, self.before[w]) for w in words if w not in self.counts and w in self.before)
        if new := [w for w in words if w not in self.counts]:
            found = self.tok.encode(new, is_pretokenized=True, add_special_tokens=False)
            n = np.bincount(np.array(found.word_ids, np.int64), minlength=len(new))
            self.counts.update(zip(new, n.tolist(), strict=True))
        return self.counts


def shared(kind, path: str, *bounds: int):
    """One encoder of a kind, file and bounds for all tasks of a worker process."""
    if (kind, path, *bounds) not in _kept:
        _kept[kind, path, *bounds] = kind(path, *bounds)
    return _kept[kind, path, *bounds]
