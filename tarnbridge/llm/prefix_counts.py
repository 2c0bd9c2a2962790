"""The token count of every prefix of a word, by dynamic programming over a vocabulary's pieces.

The tokens of a byte-pair vocabulary's encoding are those of which each neighbouring
pair encodes to itself, and for every prefix there is one such sequence. So the last
piece of a prefix is the one piece at its end that agrees with the last piece of what
is before it, and its count is one more than there. Here the piece at a word's end
differs from the same characters inside it: the table of the inner pieces is carried
on from byte to byte, and each prefix closes it with a piece that ends a word. Each
step tries the pieces' lengths only, so the work is in proportion to the word's length.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata

from tokenizers import Tokenizer

#: The beginnings of words whose tables are kept: their length, and how many.
BEGINNING, BEGINNINGS = 6, 300_000
#: The last bytes of a piece by which its length is bounded.
TAIL = 4
#: The runs of letters (or marks) that are kept, their length, and the pairs of pieces.
RUNS, LONGEST_RUN, AGREEMENTS = 300_000, 32, 500_000
#: Letters of ASCII and Latin-1, all with one lower-case letter and without a part in a composition that follows, and marks.
_SIMPLE = re.compile(r"([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]*)")

_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NONE, _LETTER, _NUMBER, _OTHER, _CLOSED = range(5)
_CLOSING = {"'s", "'t", "'m", "'d"}
_CLOSING_TWO = {"re", "ve", "ll"}


def _byte_chars() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(other)) for b in range(256)]


class PrefixCounts:
    """Counts at prefixes for a vocabulary with end-of-word pieces, NFC, lower case and the pattern above."""

    def __init__(self, path: str, tok: Tokenizer):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["end_of_word_suffix"] != "</w>" or kinds != ["NFC", "Replace", "Lowercase"] or split["pattern"]["Regex"] != _PATTERN:
            raise ValueError("prefix counts are made for another kind of vocabulary")
        self.tok, self.bytes = tok, _byte_chars()
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = {a + b for a, b in merges}
        names = [v for v in model["vocab"] if v not in made] + [a + b for a, b in merges]
        ids = {v: i for i, v in enumerate(names)}
        self.pairs = {ids[a] << 16 | ids[b]: ids[a + b] for a, b in merges}
        self.left, self.right = list(range(len(names))), list(range(len(names)))
        for a, b in merges:
            self.left[ids[a + b]], self.right[ids[a + b]] = ids[a], ids[b]
        self.inner = {v: i for v, i in ids.items() if not v.endswith("</w>")}
        self.final = {v[:-4]: i for v, i in ids.items() if v.endswith("</w>")}
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.chars: dict[str, tuple[str, list]] = {}
        self.closing: dict[str, int] = {}
        self.joins: set[str] | None = None
        either = self.inner.keys() | self.final.keys()
        self.both = {v: (self.inner.get(v, -1), self.final.get(v, -1)) for v in either}
        #: For the last bytes of pieces, TAIL of them, the longest piece with these.
        self.reach: dict[str, int] = {}
        for v in either:
            if len(v) >= TAIL:
                self.reach[v[-TAIL:]] = max(self.reach.get(v[-TAIL:], 0), len(v))
        self.agree: dict[int, bool] = {}
        self.runs: dict[str, list[int]] = {}
        self.marks: dict[str, list[int]] = {}
        self.begun: dict[str, tuple[int, int, int]] = {}

    def fits(self, a: int, b: int) -> bool:
        """Whether the pieces a and b, side by side, are encoded as a and b: no merge across comes before theirs."""
        pairs, left, right, limit = self.pairs, self.left, self.right, 1 << 30
        while True:
            if pairs.get(a << 16 | b, limit) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def _spelled(self, c: str) -> tuple[str, list]:
        """A character of a word in normal form: its lower case, and (character, class, bytes) of each character of that."""
        if c not in self.chars:
            lower, cut = self.tok.normalizer.normalize_str(c), self.tok.pre_tokenizer.pre_tokenize_str
            parts = []
            for x in lower:
                kind = _NONE if not cut(x) else _LETTER if len(cut("a" + x)) == 1 else _NUMBER if len(cut(x + x)) == 2 else _OTHER
                parts.append((x, kind, "".join(self.bytes[b] for b in x.encode("utf-8", "surrogatepass"))))
            self.chars[c] = lower, parts
        return self.chars[c]

    def _closing(self, text: str) -> int:
        if text not in self.closing:
            self.closing[text] = len(self.tok.encode(text, add_special_tokens=False).ids)
        return self.closing[text]

    def _segments(self, word: str):
        """Cuts of a word such that no character composes with one across a cut."""
        if self.joins is None:
            pairs = (unicodedata.decomposition(chr(i)).split() for i in range(sys.maxunicode + 1))
            self.joins = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")} | {chr(i) for i in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
        begin = 0
        for i, c in enumerate(word):
            if i and not unicodedata.combining(c) and c not in self.joins:
                yield word[begin:i]
                begin = i
        yield word[begin:]

    def _agree(self, key: int) -> bool:
        found = self.agree.get(key)
        if found is None:
            if len(self.agree) >= AGREEMENTS:
                self.agree.clear()
            found = self.agree[key] = self.fits(key >> 16, key & 0xFFFF)
        return found

    def _letters(self, data: str, ends: set[int] | range) -> list[int]:
        """The counts at ``ends`` of one run of letters, spelled in bytes. The tables of short beginnings, which words share, are kept."""
        both, agree, known, begun, reach = self.both.get, self._agree, self.agree.get, self.begun, self.reach.get
        last, count, out = [0], [0], []
        for i in range(1, len(data) + 1):
            if i <= BEGINNING and (kept := begun.get(data[:i])) is not None:
                t, n, total = kept
            else:
                t = total = -1
                # No longer piece than this ends here.
                size = reach(data[i - TAIL : i], TAIL - 1) if i >= TAIL else i
                for j in range(i - size if i > size else 0, i):
                    p = both(data[j:i])
                    if p is None:
                        continue
                    a, b = p
                    if j:
                        before = last[j] << 16
                        if t < 0 <= a and ((ok := known(before | a)) or ok is None and agree(before | a)):
                            t, n = a, count[j] + 1
                        if total < 0 <= b and ((ok := known(before | b)) or ok is None and agree(before | b)):
                            total = count[j] + 1
                    else:
                        if a >= 0:
                            t, n = a, 1
                        if b >= 0:
                            total = 1
                    if t >= 0 and total >= 0:
                        break
                if i <= BEGINNING and len(begun) < BEGINNINGS:
                    begun[data[:i]] = t, n, total
            last.append(t)
            count.append(n)
            if i in ends:
                out.append(total)
        return out

    def _begins(self, word: str) -> list[int]:
        """The counts of a word of letters only, each of which has one lower-case letter; kept for words that go on in other ways."""
        found = self.runs.get(word)
        if found is None:
            if word.isascii():
                found = self._letters(word.lower(), range(len(word) + 1))
            else:
                spelled, at, ends = [self._spelled(c)[1][0][2] for c in word], 0, set()
                for b in spelled:
                    at += len(b)
                    ends.add(at)
                found = self._letters("".join(spelled), ends)
            if len(word) <= LONGEST_RUN:
                if len(self.runs) >= RUNS:
                    self.runs.clear()
                self.runs[word] = found
        return found

    def counts(self, word: str) -> list[int]:
        """The tokens of word[:1], word[:2], ... for a word without white space and special strings."""
        # Latin letters, then marks that begin no contraction: two runs.
        if cut := _SIMPLE.fullmatch(word):
            letters, marks = cut.groups()
            out = self._begins(letters)
            if marks:
                if marks not in self.marks:
                    (line := _Line(self)).feed([p for c in marks for p in self._spelled(c)[1]])
                    if len(marks) > LONGEST_RUN:
                        return [*out, *(out[-1] + x[3] for x in line.states[1:])]
                    if len(self.marks) >= RUNS:
                        self.marks.clear()
                    self.marks[marks] = [x[3] for x in line.states[1:]]
                out = [*out, *(out[-1] + x for x in self.marks[marks])]
            return out
        line = _Line(self)
        if unicodedata.is_normalized("NFC", word):
            spelled = [self._spelled(c) for c in word]
            line.feed([p for _, ps in spelled for p in ps])
            out, at = [], 0
            for _, ps in spelled:
                at += len(ps)
                out.append(line.states[at][3])
            return out
        out = []
        for segment in self._segments(word):
            mark = len(line.states), len(line.last), line.data
            for j in range(1, len(segment) + 1):
                line.back(*mark)
                line.feed([p for c in unicodedata.normalize("NFC", segment[:j]) for p in self._spelled(c)[1]])
                out.append(line.states[-1][3])
        return out


class _Line:
    """The tables of one word, which grow by characters and may be taken back."""

    def __init__(self, pieces: PrefixCounts):
        self.pieces, self.data = pieces, ""
        #: For each byte: the last inner piece of the open run up to there, and the inner pieces of it.
        self.last, self.count = [0], [0]
        #: For each character: its class, where its run begins, the tokens before that, the tokens so far, and the apostrophe before a run that may become a contraction.
        self.states: list[tuple] = [(_NONE, 0, 0, 0, None)]

    def back(self, states: int, size: int, data: str):
        del self.states[states:], self.last[size:], self.count[size:]
        self.data = data

    def feed(self, parts: list):
        at, p, last, count = len(self.data), self.pieces, self.last, self.count
        inner, final, fits, longest = p.inner.get, p.final.get, p.fits, p.longest
        self.data = data = self.data + "".join([b for _, _, b in parts])
        kind, start, base, total, pending = self.states[-1]
        for c, k, b in parts:
            end = at + len(b)
            quote = kind == _OTHER and start == at - 1 and data[start] == "'"
            if quote and "'" + c in _CLOSING:
                kind, total, pending = _CLOSED, base + p._closing("'" + c), None
            elif pending and data[at - 1] + c in _CLOSING_TWO and start == at - 1:
                kind, total, pending = _CLOSED, pending[0] + p._closing("'" + data[at - 1] + c), None
            elif k == _NONE:
                kind, pending = _NONE, None
            else:
                if k != kind or k == _NUMBER:
                    pending = (base,) if quote and c in "rvl" else None
                    kind, start, base = k, at, total
                for i in range(at + 1, end + 1):
                    for n in range(min(i - start, longest), 0, -1):
                        t = inner(data[i - n : i])
                        if t is not None and (n == i - start or fits(last[i - n], t)):
                            last.append(t)
                            count.append(1 if n == i - start else count[i - n] + 1)
                            break
                for n in range(min(end - start, longest), 0, -1):
                    t = final(data[end - n : end])
                    if t is not None and (n == end - start or fits(last[end - n], t)):
                        total = base + (1 if n == end - start else count[end - n] + 1)
                        break
            for _ in range(end + 1 - len(last)):
                last.append(0)
                count.append(0)
            self.states.append((kind, start, base, total, pending))
            at = end
