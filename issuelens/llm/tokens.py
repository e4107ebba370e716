"""Token ids of whole texts as the ``tokenizers`` library gives them, with caches over safe units.

A tokenizer file's place is a parameter; the file is opened in each Python
worker (the package that holds it is installed on all machines).
"""

from __future__ import annotations

import codecs
import os
import re
import string
from array import array

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks already use all cores

#: Entries that a worker's cache holds before it starts anew (memory, not results, depend on it), and a half of a cache of two.
CACHE, HALF = 500_000, 150_000
#: Longer units are encoded each time.
LONGEST_KEY = 48
#: Stands between words that are normalised together: a private character, which normal forms leave alone.
BETWEEN = "\ue000"
_OPEN: dict[tuple, object] = {}


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids for tokenizers that drop white space and never look across it.

    Its normaliser (NFC, white space, lower case) and its pattern see nothing
    beyond a white-space-separated word, so a text's ids are those of its
    words in order.  A word's ids come from the library's own normaliser,
    pre-tokenizer and model and are kept.  Texts that could hold a special
    token's string are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.norm, self.pre = self.whole.model, self.whole.normalizer, self.whole.pre_tokenizer
        small = self.whole.get_vocab_size() <= 1 << 16
        self.dtype, self.code = (np.dtype("<u2"), "H") if small else (np.dtype("<u4"), "I")
        # a special string begins with its own first two characters
        self.marks = sorted({t.content[:2] for t in self.whole.get_added_tokens_decoder().values()})
        self.words = Generations()
        self.parts = Generations()
        ids = self.whole.encode("a b", add_special_tokens=False).ids
        if ids != [*self.whole.encode("a", add_special_tokens=False).ids, *self.whole.encode("b", add_special_tokens=False).ids]:
            raise ValueError(f"{path} doesn't encode words one by one")
        #: Whether the normaliser does nothing to printable ASCII but lower its letters.
        self.lowers = self.norm is not None and all(self.norm.normalize_str(x) == x.lower() for x in (string.printable[:94], *string.printable[:94]))
        self.byte_char = "".join(map(_byte_chars().get, range(256), map(chr, range(256))))

    def _pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _letters(self, word: str) -> bytes:
        """Ids of a normalised word of letters alone: one piece for the model."""
        got = self.parts.get(word)
        if got is None:
            piece = word if word.isascii() else codecs.charmap_decode(word.encode(), "strict", self.byte_char)[0]
            got = array(self.code, [t.id for t in self.model.tokenize(piece)]).tobytes()
            self.parts.put(word, got)
        return got

    def _normal(self, word: str) -> bytes:
        if word.isalpha():
            return self._letters(word)
        got = self.parts.get(word)
        if got is None:
            letters = word.rstrip(string.punctuation)
            if letters.isalpha():  # letters are a piece, whatever marks stand behind them
                return self._letters(letters) + self._normal(word[len(letters) :])
            got = b"".join(self._pack([t.id for t in self.model.tokenize(piece)]) for piece, _ in self.pre.pre_tokenize_str(word))
            self.parts.put(word, got)
        return got

    def _learn(self, missing: list[bytes]) -> dict[bytes, bytes]:
        out, odd, lowers, code, tokenize = {}, [], self.lowers, self.code, self.model.tokenize
        for w in missing:
            if not (lowers and w.isascii()):
                odd.append(w)
                continue
            n = w.lower().decode()
            if n.isalpha():  # most words: no calls that can be spared
                got = self.parts.get(n)
                if got is None:
                    got = array(code, [t.id for t in tokenize(n)]).tobytes()
                    self.parts.put(n, got)
                out[w] = got
            elif n.isprintable():
                out[w] = self._normal(n)
            else:
                odd.append(w)
        texts = [w.decode() for w in odd]
        # the separator is no white space, so a word that vanishes or falls apart shifts no other
        normal = self.norm.normalize_str(BETWEEN.join(texts)).split(BETWEEN) if self.norm and texts else texts
        if len(normal) != len(texts):  # a word holds the separator
            normal = [self.norm.normalize_str(t) for t in texts]
        for w, t, n in zip(odd, texts, normal, strict=True):
            # other white space than the six bytes makes no word, or several
            out[w] = self._normal(n) if n.split() == [n] else self._pack(self.whole.encode(t, add_special_tokens=False).ids)
        return out

    def ids(self, text: str | None) -> bytes:
        """The text's ids, packed little-endian in ``dtype``."""
        if not text:
            return b""
        if any(m in text for m in self.marks):
            return self._pack(self.whole.encode(text, add_special_tokens=False).ids)
        words = text.encode().split()
        found = list(map(self.words.young.get, words))
        if None in found:
            new, missing = {}, []
            for w in {w for w, f in zip(words, found, strict=True) if f is None}:
                got = self.words.old.get(w)
                if got is None:
                    missing.append(w)
                else:
                    new[w] = got
            new.update(self._learn(missing))
            found = [new[w] if f is None else f for w, f in zip(words, found, strict=True)]
            self.words.update(new)
        return b"".join(found)


class Generations:
    """A cache of two halves: when the young one is full, it becomes the old one, and what is met again is young again."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(key) <= LONGEST_KEY:
            if len(self.young) >= HALF:
                self.young, self.old = {}, self.young
            self.young[key] = value

    def update(self, new: dict) -> None:
        if len(self.young) + len(new) > HALF:
            self.young, self.old = {}, self.young
        self.young.update(new if max(map(len, new)) <= LONGEST_KEY else {k: v for k, v in new.items() if len(k) <= LONGEST_KEY})


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet by its rule: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, n = {}, 0
    for b in range(256):
        if b not in plain:
            out[b] = chr(256 + n)
            n += 1
    return out


#: A unit starts at a space or line end that stands alone between two non-blank characters, or is a
#: whole run of white space; GPT-2's pattern never joins characters across these places.
UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: White space for Python but not for the tokenizer's pattern, or the reverse in some Unicode version.
ODD_SPACE = re.compile("[\x1c-\x1f\x85᠎​﻿]")


class ByteCounter:
    """Token counts for byte-level BPE whose pattern keeps one leading space with a word.

    Texts are split at safe boundaries into units; a batch's unknown units are
    encoded by the library in one call that keeps no offsets, and only their
    lengths stay.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.marks = sorted({t.content[:2] for t in self.whole.get_added_tokens_decoder().values()})
        self.known: dict[str, int] = {}

    def _plain(self, text: str) -> bool:
        return not any(m in text for m in self.marks) and not ODD_SPACE.search(text)

    def counts(self, texts: list[str | None]) -> list[int]:
        known = self.known
        units = [UNIT.findall(t) if t and self._plain(t) else None for t in texts]
        missing = list({u for us in units if us for u in us if u not in known})
        long = {}
        if missing:
            if len(known) + len(missing) > CACHE * 3 // 2:
                known.clear()
                missing = list({u for us in units if us for u in us})
            for u, e in zip(missing, self.whole.encode_batch_fast(missing, add_special_tokens=False), strict=True):
                (known if len(u) <= LONGEST_KEY else long)[u] = len(e)
        odd = [i for i, (t, us) in enumerate(zip(texts, units, strict=True)) if t and us is None]
        out = [0] * len(texts)
        for i, us in enumerate(units):
            if us:
                out[i] = sum([known[u] if u in known else long[u] for u in us]) if long else sum(map(known.__getitem__, us))
        if odd:
            for i, e in zip(odd, self.whole.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
                out[i] = len(e)
        return out


def opened(kind: type, path: str):
    """The worker's only ``kind`` over ``path``; its caches live as long as the worker."""
    if (kind, path) not in _OPEN:
        _OPEN[kind, path] = kind(path)
    return _OPEN[kind, path]
