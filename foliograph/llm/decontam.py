"""Operator 2, benchmark decontamination by an FM-index for each shard of training documents.

The words of a shard's documents form one sequence over the benchmark's own vocabulary: every maximal run of words
that no test item holds, and every end of a document, is one separator symbol, which no phrase contains, so the
reduction loses no occurrence. Its suffix array gives the Burrows-Wheeler transform, held in a wavelet tree. Each
distinct phrase is found by backward search, each occurrence is placed by walking to a sampled suffix, and the
covered words of a document are merged into removal spans. A shard is whole documents of about SHARD symbols, so a
task holds one shard and never the corpus; items reach the tasks in broadcast blocks of at most BLOCK_BYTES of text,
and a shard is searched for one block after another.

Defined results. Null or word-less text: no words, no hit. Null or word-less item: no phrase. An item of fewer than
`width` words is one phrase. Equal phrases of several items count for each. Repeated item ids are one item; repeated
documents are judged row by row. Null item ids are ignored. Empty tables give empty or hit-free results. Other
columns of either table are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import WORD_BYTES, fresh, id_and_text, merged

WIDTH, SHARD, BLOCK_BYTES, SAMPLE = 8, 1_000_000, 16 << 20, 8
SPAN = T.StructType([T.StructField("start", T.LongType(), False), T.StructField("end", T.LongType(), False)])


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Prefix doubling that sorts again only what is still tied; s ends with a unique smallest symbol."""
    n = len(s)
    bits = max(1, int(s.max()).bit_length())
    h = max(1, 62 // bits)
    key = np.zeros(n, dtype=np.int64)
    for j in range(min(h, n)):
        key[: n - j] |= s[j:].astype(np.int64) << (bits * (h - 1 - j))
    sa = np.argsort(key, kind="stable")
    key = key[sa]
    new = np.ones(n, dtype=bool)
    new[1:] = key[1:] != key[:-1]
    rank, todo = np.empty(n, dtype=np.int64), np.arange(n)
    while True:
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(todo)))
        rank[sa[todo]] = np.repeat(todo[first], sizes)
        todo = todo[np.repeat(sizes > 1, sizes)]
        if not len(todo):
            return sa
        at = sa[todo]
        after = at + h
        key = rank[at] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sa[todo], key = at[order], key[order]
        new = np.ones(len(todo), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        h *= 2


class WaveletTree:
    """Ranks of symbols, level by level from the highest bit: each level holds one bit of every symbol, with the
    symbols of the level below dealt to the zeros' half and the ones' half in their order."""

    def __init__(self, s: np.ndarray):
        self.levels = max(1, int(s.max()).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        for level in reversed(range(self.levels)):
            bit = (s >> level) & 1 == 1
            padded = np.zeros(-(-(len(s) + 1) // 64) * 64, dtype=bool)
            padded[: len(s)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            counts = np.zeros(len(words) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(words), out=counts[1:])
            self.words.append(words)
            self.counts.append(counts)
            self.zeros.append(len(s) - int(counts[-1]))
            s = np.concatenate([s[~bit], s[bit]])

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        low = self.words[k][w] & ((np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1))
        return self.counts[k][w] + np.bitwise_count(low)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How many of the first i symbols are c, for arrays of both."""
        left, i = np.zeros_like(i), i.copy()
        for k in range(self.levels):
            one = (c >> (self.levels - 1 - k)) & 1 == 1
            a, b = self._ones(k, left), self._ones(k, i)
            left = np.where(one, self.zeros[k] + a, left - a)
            i = np.where(one, self.zeros[k] + b, i - b)
        return i - left


class FMIndex:
    """Backward search and location over one sequence that ends with symbol 0, found nowhere else."""

    def __init__(self, s: np.ndarray, sample: int = SAMPLE):
        sa = suffix_array(s)
        self.n, self.bwt = len(s), s[sa - 1]
        self.tree = WaveletTree(self.bwt)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=int(s.max()) + 1))]).astype(np.int64)
        marked = sa % sample == 0
        self.marked, self.before, self.samples = marked, np.cumsum(marked) - marked, sa[marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of each phrase; phrases is right-aligned, one in a row."""
        lo, hi = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n, dtype=np.int64)
        width, top = phrases.shape[1], len(self.less) - 1
        for j in reversed(range(width)):
            live = np.flatnonzero((lengths >= width - j) & (lo < hi))
            c = phrases[live, j].astype(np.int64)
            known = c < top
            hi[live[~known]] = lo[live[~known]] = 0
            live, c = live[known], c[known]
            lo[live], hi[live] = self.less[c] + self.tree.rank(c, lo[live]), self.less[c] + self.tree.rank(c, hi[live])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each row: back to the nearest sampled suffix, plus the steps taken."""
        out, steps, live = np.empty(len(rows), dtype=np.int64), 0, np.arange(len(rows))
        while len(live):
            at = self.marked[rows]
            out[live[at]] = self.samples[self.before[rows[at]]] + steps
            live, rows = live[~at], rows[~at]
            c = self.bwt[rows].astype(np.int64)
            rows, steps = self.less[c] + self.tree.rank(c, rows), steps + 1
        return out


class Phrases:
    """The distinct phrases of some items, right-aligned over their own vocabulary (from symbol 2), and who has them."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, body in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 2) for w in body.translate(WORD_BYTES).split()]
            for i in range(max(1, len(ids) - width + 1)) if ids else ():
                owners.setdefault(tuple(ids[i : i + width]), set()).add(item)
        self.items = sorted({x for xs in owners.values() for x in xs})
        place = {x: k for k, x in enumerate(self.items)}
        self.owners = [np.array(sorted(place[x] for x in xs), dtype=np.int64) for xs in owners.values()]
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.table = np.array([(0,) * (width - len(p)) + p for p in owners], dtype=np.int32).reshape(len(owners), width)

    def among(self, words: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """table and lengths in the symbols of other words; a phrase with a word that is not among them gets symbol 1."""
        symbols = np.ones(len(self.vocabulary) + 2, dtype=np.int32)
        symbols[0] = 0
        for w, i in self.vocabulary.items():
            symbols[i] = words.get(w, 1)
        table = symbols[self.table]
        # what holds a separator is nowhere: its last symbol says so at once
        table[(table == 1).any(axis=1), -1] = len(words) + 2
        return table, self.lengths


def _search_shard(shard: list[list[bytes]], blocks) -> list[tuple[list, list]]:
    """Merged hit spans and owning items of each document of the shard, given as word lists."""
    sizes = np.array([len(words) for words in shard], dtype=np.int64)
    total, n = int(sizes.sum()), len(shard)
    ends = np.cumsum(sizes)
    # words count through the shard with a gap after each document, so that spans of two documents never touch
    first = ends - sizes + np.arange(n)
    number = np.arange(total) + np.repeat(np.arange(n), sizes)
    starts_at, ends_at, owners = [], [], [set() for _ in shard]

    def indexed(vocabulary: dict[bytes, int]):
        """The shard's index over a vocabulary, or None; and the word number of each of its symbols."""
        find = vocabulary.get
        symbols = np.fromiter((find(w, 1) for words in shard for w in words), dtype=np.int32, count=total)
        # a separator at the end of each document; then one for each run of separators
        symbols, place = np.insert(symbols, ends, 1), np.insert(number, ends, -1)
        stays = np.ones(len(symbols), dtype=bool)
        stays[1:] = (symbols[1:] != 1) | (symbols[:-1] != 1)
        symbols, place = np.append(symbols[stays], np.int32(0)), place[stays]
        return FMIndex(symbols) if len(symbols) > 2 else None, place

    own: dict[bytes, int] = {}
    if len(blocks) > 1 and total:  # the shard's own words, so that it is indexed once for all blocks
        for words in shard:
            for w in words:
                own.setdefault(w, len(own) + 2)
        index, place = indexed(own)
    for block in blocks:
        phrases: Phrases = block()
        if not len(phrases.lengths) or not total:
            continue
        if len(blocks) == 1:
            index, place = indexed(phrases.vocabulary)
        if index is None:
            continue
        lo, hi = index.search(*phrases.among(own)) if len(blocks) > 1 else index.search(phrases.table, phrases.lengths)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        times = (hi - lo)[found]
        which = np.repeat(found, times)
        rows = np.repeat(lo[found] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))
        start = place[index.locate(rows)]
        s, e = merged(start, start + phrases.lengths[which])
        starts_at.append(s)
        ends_at.append(e)
        doc = np.searchsorted(first, start, side="right") - 1
        for pair in np.unique(doc * len(phrases.lengths) + which).tolist():
            d, p = divmod(pair, len(phrases.lengths))
            owners[d].update(phrases.items[k] for k in phrases.owners[p].tolist())
    spans = [[] for _ in shard]
    if starts_at:
        s, e = merged(np.concatenate(starts_at), np.concatenate(ends_at))
        doc = np.searchsorted(first, s, side="right") - 1
        for d, x, y in zip(doc.tolist(), (s - first[doc]).tolist(), (e - first[doc]).tolist()):
            spans[d].append((x, y))
    return [(mine, sorted(items)) for mine, items in zip(spans, owners)]


def _blocks(items: DataFrame, width: int) -> list:
    """Getters of the items' phrases, broadcast in blocks of bounded text; a lone block stays loaded in a worker."""
    spark: SparkSession = items.sparkSession
    blocks, block, room = [], [], BLOCK_BYTES
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("b")
    for row in items.select(F.col("item_id").cast("string").alias("i"), body).where("i is not null").toLocalIterator():
        if block and room < len(row.b):
            blocks.append(spark.sparkContext.broadcast(Phrases(block, width)))
            block, room = [], BLOCK_BYTES
        block.append((row.i, bytes(row.b)))
        room -= len(row.b)
    if block:
        blocks.append(spark.sparkContext.broadcast(Phrases(block, width)))
    if len(blocks) == 1:
        return [lambda b=blocks[0]: b.value]
    return [lambda b=b: b.load_from_path(b._path) for b in blocks]


def _shards(batches, size: int, column: str):
    """Slices of the batches that hold about `size` words each, with the words of every row."""
    for batch in batches:
        words, total, at = [], 0, 0
        for body in batch[column]:
            words.append((body.as_py() or b"").translate(WORD_BYTES).split())
            total += len(words[-1]) + 1
            if total >= size:
                yield batch.slice(at, len(words)), words
                words, total, at = [], 0, at + len(words)
        if words:
            yield batch.slice(at, len(words)), words


def find_items(docs: DataFrame, items: DataFrame, width: int = WIDTH, shard: int = SHARD) -> DataFrame:
    """doc_id, n_words, spans (of words, maximal, half-open), item_ids (as strings, sorted)."""
    blocks = _blocks(items, width)
    arrow_span = pa.struct([pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)])

    def run(batches):
        for part, words in _shards(batches, shard, "body"):
            found = _search_shard(words, blocks)
            columns = [
                part["doc_id"],
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([[{"start": a, "end": b} for a, b in s] for s, _ in found], pa.list_(arrow_span)),
                pa.array([i for _, i in found], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "spans", "item_ids"])

    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("spans", T.ArrayType(SPAN, False)),
            T.StructField("item_ids", T.ArrayType(T.StringType())),
        ]
    )
    return id_and_text(docs).mapInArrow(run, schema)


def contamination(docs: DataFrame, items: DataFrame, width: int = WIDTH, least_items: int = 2) -> DataFrame:
    """The digest of find_items(), one row for each document."""
    n_items = F.size("item_ids").cast("long")
    return find_items(docs, items, width).select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"),
        n_items.alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (n_items >= least_items).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WIDTH, least_items: int = 2) -> DataFrame:
    """docs without the documents that hold phrases of least_items items; hit words of the others are cut out.

    Search and cut happen in one pass, so texts are not shuffled. All columns of docs are kept.
    """
    blocks = _blocks(items, width)
    word = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    name = fresh(docs, "body")

    def clean(text: str, spans: list[tuple[int, int]]) -> str:
        """Cut until nothing is hit: what a cut brings together may be a phrase again."""
        while spans:
            text = _cut(word, text, spans)
            spans = _search_shard([text.encode().translate(WORD_BYTES).split()], blocks)[0][0]
        return text

    def run(batches):
        for part, words in _shards((_with_bytes(b, name) for b in batches), SHARD, name):
            found = _search_shard(words, blocks)
            part = part.drop_columns([name])
            if any(i for _, i in found):
                at = part.schema.get_field_index("text")
                texts = [clean(t, s) if s and len(i) < least_items else t for t, (s, i) in zip(part["text"].to_pylist(), found)]
                part = part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type))
                part = part.filter(pa.array([len(i) < least_items for _, i in found]))
            if part.num_rows:
                yield part

    return docs.mapInArrow(run, docs.schema)


def _with_bytes(batch: pa.RecordBatch, name: str) -> pa.RecordBatch:
    text = batch["text"]
    return batch.append_column(name, text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary()))


def _cut(word: re.Pattern, text: str, spans: list[tuple[int, int]]) -> str:
    places = [m.span() for m in word.finditer(text)]
    out, at = [], 0
    for start, end in spans:
        out.append(text[at : places[start][0]])
        at = places[end - 1][1]
    return "".join([*out, text[at:]])
