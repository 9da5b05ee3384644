"""Byte-level BPE, encoding and decoding of whole texts.

A text is cut at the strings of special tokens, each segment into words (runs of letters, digits, marks or white space, each with the
one space before it). The bytes of a word are symbols of a doubly linked list; a priority queue holds the ranks of the merges of
neighbours, equal ranks from the left. Each merge puts the new symbol's pairs with its neighbours into the queue; an entry whose pair no longer stands at its
place is stale and skipped. Decoding joins the vocabulary's strings. Only the merges of words that a worker hasn't met are worked
out: its caches hold a bounded number of words and of pieces between white space, and what finds no room is merged again.

Defined cases: a null text is an empty text, which has no ids; a special token's string in a text is that token's id (with
specials=False it is ordinary text); rows that repeat are encoded each; an empty table gives no rows. In decoding, null ids give a null text, ids that are null or not in the
vocabulary give nothing, and bytes that are no UTF-8 give the replacement character. Other columns stay; `ids` and `decoded` of the input are
replaced. Files that are no byte-level BPE are a ValueError.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship
from .tokens import MARKS, RUNS

#: Fixed value: what byte-level BPE takes as a word.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_WORDS, MOST_PIECES, LONGEST, LONG = 200_000, 1_000_000, 48, 4096
_made: dict = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on, in order."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


class BytePairs:
    """One vocabulary file with its caches; one for each worker and file."""

    def __init__(self, path: str, specials: bool = True):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, cut = file["model"], file.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or file.get("normalizer") or model.get("end_of_word_suffix") or model.get("ignore_merges"):
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocab, letters = model["vocab"], byte_letters()
        self.symbol = [vocab[c] for c in letters]
        self.ranks: list[dict[int, int]] = [{} for _ in range(max(vocab.values()) + 2)]  # by the left symbol; the last is that of one that has gone
        self.made = []
        for pair in model["merges"]:
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left]].setdefault(vocab[right], len(self.made))
            self.made.append(vocab[left + right])
        of = {c: b for b, c in enumerate(letters)}
        added = {x["content"]: x["id"] for x in file.get("added_tokens", [])}
        self.strings = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in [*vocab.items(), *added.items()]:
            self.strings[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.special = {c: array("I", [i]).tobytes() for c, i in added.items()} if specials else {}
        self.at_special = re.compile("|".join(re.escape(c) for c in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.find = regex.compile(WORDS).findall
        self.cutter = Tokenizer.from_file(path).pre_tokenizer  # for characters that are younger than this Python: the libraries disagree on what they are
        young = [c for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Cn"]
        ends = [i for i in range(len(young)) if i + 1 == len(young) or young[i + 1] != young[i] + 1]
        self.young = re.compile("[" + "".join(f"\\U{young[a]:08x}-\\U{young[b]:08x}" for a, b in zip([0, *[i + 1 for i in ends[:-1]]], ends, strict=True)) + "]")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, symbols):
        """The symbols that are left when no neighbours have a merge."""
        n, ranks, made = len(symbols), self.ranks, self.made
        shift = 12 if n <= LONG else 40  # an entry is a rank and a place in one number: a small one, where it can be
        after, before = range(1, n + 1), range(-1, n - 1)
        after, before = (list(after), list(before)) if n <= LONG else (array("q", after), array("q", before))
        queue = [r << shift | i for i, (x, y) in enumerate(zip(symbols, symbols[1:], strict=False)) if (r := ranks[x].get(y)) is not None]
        heapify(queue)
        mask = (1 << shift) - 1
        while queue:
            top = heappop(queue)
            i = top & mask
            j = after[i]
            if j == n or ranks[symbols[i]].get(symbols[j]) != (r := top >> shift):
                continue  # stale: one of the two has gone, or is another symbol now
            new = symbols[i] = made[r]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks[new].get(symbols[k])) is not None:
                    heappush(queue, r << shift | i)
            h = before[i]
            if h >= 0 and (r := ranks[symbols[h]].get(new)) is not None:
                heappush(queue, r << shift | h)
        return [s for s in symbols if s >= 0]

    def merged(self, w: str) -> bytes:
        symbols = [self.symbol[b] for b in w.encode()]
        return array("I", self.merge(array("q", symbols) if len(symbols) > LONG else symbols)).tobytes()

    def word(self, w: str) -> bytes:
        ids = self.words.get(w)
        if ids is None:
            ids = self.merged(w)
            if len(w) <= LONGEST and len(self.words) < MOST_WORDS:
                self.words[w] = ids
        return ids

    def cut(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii() and self.young.search(text):
            return [text[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(text)]
        return self.find(text)

    def piece(self, p: str) -> bytes | None:
        """Of what stands after a space, or with its line feed; None if other white space is in it."""
        w = p.rstrip(MARKS)
        if w != p and w[-1:].isalpha():  # marks after a letter are a word
            ids = self.pieces.get(w) or self.piece(w)
            if ids is None:
                return None
            ids += self.word(p[len(w) :])
        else:
            body = p[1:] if p[:1] == "\n" else p
            if body and body.split() != [body]:
                return None
            parts = self.cut(p if p[:1] == "\n" else " " + p)
            ids = self.merged(parts[0]) if len(parts) == 1 else b"".join(map(self.word, parts))
        if len(p) <= LONGEST and len(self.pieces) < MOST_PIECES:
            self.pieces[p] = ids
        return ids

    def segment(self, text: str) -> bytes:
        """Words end before each white space that follows another character, so a text whose white space is single spaces and one or two line feeds is the ids of its pieces."""
        if not text.endswith("\n\n") and not any(x in text for x in RUNS):
            first, *rest = text.replace("\n", " \n").split(" ")
            ids = list(map(self.pieces.get, rest))
            if None in ids:
                piece = self.piece
                ids = [piece(p) if x is None else x for x, p in zip(ids, rest, strict=True)]
            if None not in ids and (not first or first.split() == [first]):
                return b"".join([*map(self.word, self.cut(first)), *ids])
        return b"".join(map(self.word, self.cut(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.at_special is None or not self.at_special.search(text):
            return self.segment(text)
        out, at = [], 0
        for m in self.at_special.finditer(text):
            out += [self.segment(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return b"".join([*out, self.segment(text[at:])])

    def decode(self, ids: list[int]) -> str:
        try:
            found = b"".join(map(self.strings.__getitem__, ids))
        except (IndexError, TypeError):
            found = b"".join(self.strings[i] for i in ids if i is not None and i < len(self.strings))
        return found.decode("utf-8", "replace")


def pairs(path: str, specials: bool = True) -> BytePairs:
    if (path, specials) not in _made:
        _made[path, specials] = BytePairs(path, specials)
    return _made[path, specials]


def _mapped(rows: DataFrame, takes: list[str], gives: dict[str, T.DataType], make) -> DataFrame:
    """rows with the columns `gives`, which make(*columns of a slice) returns as Arrow arrays; slices hold some MB."""
    ship(rows.sparkSession)
    keep = [c for c in rows.columns if c not in gives]
    schema = T.StructType([*[rows.schema[c] for c in keep], *[T.StructField(c, t) for c, t in gives.items()]])
    inner = {c: f"_{i}" for i, c in enumerate(rows.columns)}  # names may clash in all but case
    plain = rows.toDF(*inner.values())

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            size = max(1, batch.nbytes // (2 << 20))
            step = max(1, batch.num_rows // size)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                new = make(*[part.column(inner[c]) for c in takes])
                yield pa.RecordBatch.from_arrays([*[part.column(inner[c]) for c in keep], *new], [*[inner[c] for c in keep], *[f"new{i}" for i in range(len(new))]])

    names = [*[inner[c] for c in keep], *[f"new{i}" for i in range(len(gives))]]
    return plain.mapInArrow(run, T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names, schema, strict=True)])).toDF(*schema.names)


def _lists(coded: list[bytes]):
    import numpy as np
    import pyarrow as pa

    ends = np.cumsum([0, *[len(x) // 4 for x in coded]])
    values = np.frombuffer(b"".join(coded), "<i4")
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode(docs: DataFrame, path: str, text: str = "text", specials: bool = True) -> DataFrame:
    """docs with ids array<int>: those of the whole text."""

    def make(texts):
        enc = pairs(path, specials)
        return [_lists([enc.encode(t or "") for t in texts.to_pylist()])]

    return _mapped(docs, [text], {"ids": T.ArrayType(T.IntegerType())}, make)


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """rows with decoded: the text of an array of ids, special tokens' strings too."""

    def make(lists):
        import pyarrow as pa

        dec = pairs(path)
        return [pa.array([None if x is None else dec.decode(x) for x in lists.to_pylist()], pa.string())]

    return _mapped(rows, [ids], {"decoded": T.StringType()}, make)


def round_trip(docs: DataFrame, path: str, text: str = "text", specials: bool = True) -> DataFrame:
    """encode() and decode() of its ids in one pass of the workers: docs with ids and decoded."""

    def make(texts):
        import numpy as np
        import pyarrow as pa

        enc = pairs(path, specials)
        coded = [enc.encode(t or "") for t in texts.to_pylist()]
        return [_lists(coded), pa.array([enc.decode(np.frombuffer(x, "<u4").tolist()) for x in coded], pa.string())]

    return _mapped(docs, [text], {"ids": T.ArrayType(T.IntegerType()), "decoded": T.StringType()}, make)


def digests(found: DataFrame) -> DataFrame:
    """found (ids, decoded) with n_tokens and the hashes of the decimal ids and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.withColumns({"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(joined.cast("binary"), 256), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)})
