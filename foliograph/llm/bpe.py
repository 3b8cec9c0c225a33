"""Operator 9, BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree are the ranks of a word's adjacent symbol pairs; its root is the lowest rank, leftmost among
equals, so a merge costs a few logarithmic point updates. Words are encoded once for each worker and kept up to a
bound; a text is then its words' packed ids in order. The vocabulary file is read on the driver (at most
LARGEST_FILE bytes) and broadcast.

Normalisation and splitting follow the file: NFC, white space to a blank, lower case character by character, then
contractions, letter runs, single digits and runs of other marks, white space dropped; a word's bytes are written in
the byte alphabet, the last with the word-end suffix. Special tokens standing in a text are their ids. Decoding joins
the tokens of the ids with blanks, as the file names no decoder.

Defined results. Null or empty text: no ids, decoded text empty. Repeated rows are encoded row by row. Empty tables
give empty results. Columns other than doc_id and text are not read by encode().
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from array import array
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import release

LARGEST_FILE, KNOWN = 64 << 20, 300_000
NONE = 1 << 60
LETTERS = "".join(chr(c) for c in range(256) if unicodedata.category(chr(c))[0] == "L")
DIGITS = "".join(chr(c) for c in range(256) if unicodedata.category(chr(c))[0] == "N")
BLANKS = "\\t-\\r \\x85\\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
#: For texts of the first 256 characters; the alternatives differ in their first character but for the apostrophe.
SIMPLE = re.compile(f"[{LETTERS}]+|{CONTRACTIONS}|[{DIGITS}]|[^{BLANKS}{LETTERS}{DIGITS}]+")
FULL = regex.compile(rf"{CONTRACTIONS}|[\p{{L}}]+|[\p{{N}}]|[^\s\p{{L}}\p{{N}}]+")


def byte_alphabet() -> list[str]:
    """Printable characters stand for themselves; the other bytes get the characters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in shown else chr(256 + extra))
        extra += b not in shown
    return out


def merge_symbols(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """All merges, lowest rank first and leftmost among equals."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = n - 1
    find = ranks.get
    # a leaf is rank * n + place, so the smallest is the leftmost of the lowest rank
    tree = [NONE] * (2 * size)
    for i in range(size):
        r = find((symbols[i], symbols[i + 1]))
        if r is not None:
            tree[size + i] = r * n + i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(i: int, value: int) -> None:
        i += size
        tree[i] = value
        i >>= 1
        while i:
            a, b = tree[2 * i], tree[2 * i + 1]
            least = a if a < b else b
            if tree[i] == least:
                return
            tree[i] = least
            i >>= 1

    while tree[1] < NONE:
        i = tree[1] % n
        j = after[i]
        symbols[i] += symbols[j]
        symbols[j] = ""
        k = after[i] = after[j]
        if j < size:
            put(j, NONE)
        if k < n:
            before[k] = i
            r = find((symbols[i], symbols[k]))
            put(i, NONE if r is None else r * n + i)
        else:
            put(i, NONE)
        h = before[i]
        if h >= 0:
            r = find((symbols[h], symbols[i]))
            put(h, NONE if r is None else r * n + h)
    return [s for s in symbols if s]


class Words(dict):
    """Packed ids by word; emptied when full."""

    def __init__(self, bpe: "Bpe"):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN:
            self.clear()
        ids = self[word] = self.bpe.word(word)
        return ids


class Bpe:
    def __init__(self, source: str):
        model = json.loads(source)
        self.vocabulary = model["model"]["vocab"]
        self.ranks = {tuple(p): r for r, p in enumerate(model["model"]["merges"])}
        self.suffix = model["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.tokens = {i: t for t, i in (self.vocabulary | self.special).items()}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.alphabet, self.known = byte_alphabet(), Words(self)

    def word(self, word: str) -> bytes:
        symbols = [self.alphabet[b] for b in word.encode()]
        symbols[-1] += self.suffix
        return array("I", [self.vocabulary[s] for s in merge_symbols(symbols, self.ranks) if s in self.vocabulary]).tobytes()

    def _plain(self, text: str) -> bytes:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
        text = text.replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
            words = SIMPLE.findall(text)
        except UnicodeEncodeError:
            words = FULL.findall(text)
        return b"".join(map(self.known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not self.special_at or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.special_at.split(text)
        return b"".join(array("I", [self.special[p]]).tobytes() if k % 2 else self._plain(p) for k, p in enumerate(parts))

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, array("I", ids)))


assert sys.byteorder == "little" and array("I").itemsize == 4
_loaded: dict[str, Bpe] = {}


def _bpe(source) -> Bpe:
    """One for each worker and file, kept from task to task."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(source)
    return _loaded[key]


def encode(docs: DataFrame, path: str, keep_columns: tuple[str, ...] = ("doc_id",), texts: bool = True) -> DataFrame:
    """keep_columns, n_tokens, ids_sha256, decoded_sha256 and, with texts, ids (array<int>) and decoded."""
    size = Path(path).stat().st_size
    if size > LARGEST_FILE:
        raise ValueError(f"{path} has {size} bytes; at most {LARGEST_FILE} are broadcast")
    source = docs.sparkSession.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))

    def run(batches):
        bpe = _bpe(source.value)
        for batch in batches:
            n, ids_sha, text_sha, all_ids, decoded = [], [], [], [], []
            for x in batch["__text"]:
                ids = bpe.encode(x.as_py() or "")
                back = bpe.decode(ids)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(back.encode()).hexdigest())
                if texts:
                    all_ids.append(np.frombuffer(ids, dtype=np.int32))
                    decoded.append(back)
            made = {c: batch[c] for c in keep_columns} | {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string())}
            if texts:
                made |= {"ids": pa.array(all_ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            yield pa.RecordBatch.from_pydict(made)
        release()

    fields = [docs.schema[c] for c in keep_columns]
    fields += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if texts:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.select(*keep_columns, F.col("text").alias("__text")).mapInArrow(run, T.StructType(fields))
