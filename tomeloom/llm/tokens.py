"""Token ids of whole texts with the public tokenizers, with caches of words inside each worker.

Both vocabularies split a text before each space or line feed that follows another character, so a text is the ids of its pieces in
order, each with the space or line feed before it. A piece that ends in ASCII punctuation after a letter or digit (one that
composing leaves a letter: some scripts have letters that it takes apart into a letter and a mark) is split there too. Texts in which that isn't certain (white space other than single spaces and one or two line
feeds, and a capital that lower case makes two of) are encoded whole. The caches hold a bounded number of pieces and words; what finds no room is encoded again.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from array import array

PIECES, WORDS, LONGEST = 300_000, 600_000, 48
ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u0130\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
RUNS = ("  ", " \n", "\n ", "\n\n\n")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_made: dict = {}


def ends_word(c: str) -> bool:
    """Marks after this character start anew: a letter or digit, as it stands and composed."""
    return c.isalnum() and (c < "\u0300" or unicodedata.normalize("NFC", c)[-1].isalnum())


class Encoder:
    """encode_all(texts) gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tok.no_padding()
        self.tok.no_truncation()
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.folds = self.raw(["A"]) == self.raw(["a"])  # this vocabulary ignores case and white space

    def raw(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def resolve(self, missing: set[str]) -> dict[str, bytes]:
        """Ids of pieces, each as it stands after a space or with its own line feed."""
        words, folds, found, late, fresh = self.words, self.folds, {}, [], {}
        for x in missing:
            word = x.rstrip(MARKS)
            tail = x[len(word) :]
            if tail and not ends_word(word[-1:]):
                word, tail = x, ""
            if folds:
                word = word.lstrip("\n").lower() if word.isascii() else word.lstrip("\n")
            ids, end = words.get(word), words.get("\r" + tail) if tail else b""
            if ids is None or end is None:
                late.append((x, word, tail))
                fresh[word] = None
                if tail:
                    fresh["\r" + tail] = None  # a key of its own: marks right after a word, not after a space
            else:
                found[x] = ids + end
        need = [w for w in fresh]
        after = "" if folds else " "
        for w, ids in zip(need, self.raw([w[1:] if w[:1] == "\r" else w if w[:1] == "\n" else after + w for w in need]), strict=True):
            fresh[w] = ids
        for x, word, tail in late:
            found[x] = fresh[word] + (fresh["\r" + tail] if tail else b"")
        if len(words) < WORDS:
            words.update([(w, v) for w, v in fresh.items() if len(w) <= LONGEST])
        if len(self.pieces) < PIECES:
            self.pieces.update([(x, v) for x, v in found.items() if len(x) <= LONGEST])
        return found

    def encode_all(self, texts: list[str]) -> list[bytes]:
        gc.disable()  # the caches hold a million strings and no cycles: a collection would only walk them
        try:
            return self._encode_all(texts)
        finally:
            gc.enable()

    def _encode_all(self, texts: list[str]) -> list[bytes]:
        get, missing, made, whole = self.pieces.get, set(), [], []
        for t in texts:
            if any(x in t for x in RUNS) or t.endswith("\n\n") or ODD.search(t):
                whole.append(t)
                made.append(None)
                continue
            first, *rest = t.replace("\n", " \n").split(" ")
            whole.append(first)
            ids = list(map(get, rest))
            gaps = [i for i, v in enumerate(ids) if v is None] if None in ids else []
            missing.update([rest[i] for i in gaps])
            made.append((ids, gaps, rest))
        found, heads, out = self.resolve(missing), self.raw(whole), []
        for head, one in zip(heads, made, strict=True):
            if one is None:
                out.append(head)
                continue
            ids, gaps, rest = one
            for i in gaps:
                ids[i] = found[rest[i]]
            out.append(head + b"".join(ids))
        return out


def encoder(path: str) -> Encoder:
    if path not in _made:
        _made[path] = Encoder(path)
    return _made[path]


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file, as installed on each machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
