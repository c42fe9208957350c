"""Pre-tokens of whole texts as byte spans, as the tokenizers library cuts them.

Texts of Latin-1 characters are cut by vectorised character classes; a text with any other
character, or that may hold a special string, goes through the library's own normaliser and
pre-tokenizer. Both give the same spans (tests compare them).
"""

from __future__ import annotations

import functools
import json
import unicodedata

import numpy as np
from tokenizers import Tokenizer

from .kernels import LOWER, span_hashes

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


def _class(c: str) -> int:
    if c in "\t\n\x0b\x0c\r \x85\xa0":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(c)[0], OTHER)


ASCII = np.array([_class(chr(i)) if i < 128 else OTHER for i in range(256)], np.uint8)
LATIN = np.array([_class(chr(i)) for i in range(0x80, 0x100)], np.uint8)


def byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


TO_LETTERS = str.maketrans({chr(k): v for k, v in byte_letters().items()})
FROM_LETTERS = {v: k for k, v in byte_letters().items()}


class Pieces:
    """One tokenizer file: its pre-tokens, and the ids of a pre-token."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.lower = spec["normalizer"] is not None
        self.specials = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)

    def ids(self, token: bytes) -> list[int]:
        if token in self.specials:
            return [self.specials[token]]
        return [x.id for x in self.tokenizer.model.tokenize(token.decode("latin-1").translate(TO_LETTERS))]

    def slow(self, text: str) -> list[bytes]:
        """A text's pre-tokens by the library, special strings cut out first as it does."""
        parts, at = [], 0
        names = [s.decode() for s in self.specials]
        while at < len(text):
            found = min(((i, -len(s), s) for s in names if (i := text.find(s, at)) >= 0), default=None)
            stop = found[0] if found else len(text)
            if stop > at:
                part = text[at:stop]
                if self.lower:
                    part = self.tokenizer.normalizer.normalize_str(part)
                parts += [bytes(FROM_LETTERS[c] for c in s) for s, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
            if found:
                parts.append(found[2].encode())
                stop += len(found[2])
            at = stop
        return parts

    def spans(self, buf: np.ndarray, offsets: np.ndarray):
        """Buffer, starts and ends of pre-tokens in order, and each document's first pre-token."""
        n = len(offsets) - 1
        high = np.flatnonzero(buf >= 0xC4)
        mark = np.flatnonzero((buf[:-1] == 60) & (buf[1:] == 124)) if len(buf) > 1 else high[:0]
        slow = np.unique(np.searchsorted(offsets, np.concatenate([high, mark]), "right") - 1)
        if self.lower:
            buf = LOWER[buf]
            at = np.flatnonzero(buf[:-1] == 0xC3) + 1
            at = at[(buf[at] >= 0x80) & (buf[at] <= 0x9E) & (buf[at] != 0x97)]
            buf[at] += 0x20
        starts, ends = self._fast(buf, offsets)
        if not len(slow):
            return buf, starts, ends, np.searchsorted(starts, offsets)
        doc = np.searchsorted(offsets, starts, "right") - 1
        keep = ~np.isin(doc, slow)
        extra, docs, sizes, raw = [], [], [], buf
        return self._with_slow(raw, offsets, starts[keep], ends[keep], doc[keep], slow, n)

    def _with_slow(self, buf, offsets, starts, ends, doc, slow, n):
        extra, docs, sizes = [], [], []
        for d in slow.tolist():
            tokens = self.slow(self._texts(d))
            extra += tokens
            docs.append(np.full(len(tokens), d))
            sizes += map(len, tokens)
        sizes = np.array(sizes, np.int64)
        ends2 = len(buf) + np.cumsum(sizes)
        buf = np.concatenate([buf, np.frombuffer(b"".join(extra), np.uint8)])
        starts, ends = np.concatenate([starts, ends2 - sizes]), np.concatenate([ends, ends2])
        doc = np.concatenate([doc, *docs])
        order = np.argsort(doc, kind="stable")
        return buf, starts[order], ends[order], np.searchsorted(doc[order], np.arange(n + 1))

    def cut(self, buf: np.ndarray, offsets: np.ndarray):
        """spans() of documents whose bytes are buf."""
        self._texts = lambda d: buf[offsets[d] : offsets[d + 1]].tobytes().decode("utf-8", "replace")
        return self.spans(buf, offsets)

    def _fast(self, buf, offsets):
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = len(buf)
        tail = (buf & 0xC0) == 0x80
        kind = ASCII[buf]
        lead = np.flatnonzero((buf == 0xC2) | (buf == 0xC3))
        lead = lead[lead + 1 < size]
        kind[lead] = kind[lead + 1] = LATIN[np.minimum((buf[lead].astype(np.int64) - 0xC2) * 64 + (buf[lead + 1] & 0x3F), 127)]
        full = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        changed = np.empty(size, bool)
        changed[1:] = kind[1:] != kind[:-1]
        changed[first] = True
        space = kind == SPACE
        after_blank = np.zeros(size, bool)
        after_blank[1:] = buf[:-1] == 32
        after_blank[first] = False
        if self.lower:
            start = ~space & ~tail & (changed | (kind == NUMBER))
        else:
            start = changed & ~tail & (space | ~after_blank)
            # the last of several white spaces before something else stands alone
            run_end = space.copy()
            run_end[:-1] &= ~space[1:]
            run_end[last] = False
            at = np.flatnonzero(run_end)
            start[at - tail[at]] = True
        quote = np.flatnonzero((buf == 39) & start)
        if len(quote):
            end = last[np.searchsorted(last, quote)] + 1
            padded = np.concatenate([buf, np.zeros(3, np.uint8)])
            a, b = padded[quote + 1], padded[quote + 2]
            one = (quote + 1 < end) & np.isin(a, list(b"stmd"))
            two = (quote + 2 < end) & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108))
            step = np.where(one, 2, 3)[one | two]
            quote, end = quote[one | two], end[one | two]
            start[quote + 1] = False
            stop = quote + step
            stop = stop[stop < end]
            start[stop] = ~space[stop] if self.lower else True
        mark = start | (space & changed & ~tail) if self.lower else start
        at = np.flatnonzero(mark)
        following = np.append(at[1:], size)
        chosen = start[at]
        return at[chosen], following[chosen]


@functools.lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def hashes(buf, starts, ends):
    return span_hashes(buf, starts, ends)
