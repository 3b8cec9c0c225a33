"""Operator 3, SimHash near-duplicates by a self-join of binary tries over fingerprints.

A document's fingerprint has the bits that are set in over half of its shingles' XXH64 values. Equal fingerprints
are one node. Two fingerprints of 64 bits that differ in at most `budget` bits agree in one of budget+1 bands, so each
goes to the trie of every value of a band; a trie is joined with itself by walking pairs of nodes from the root,
adding up differing bits and leaving a pair as soon as they pass the budget. A band value with over `hot`
fingerprints is dealt again by bands of the bits not yet fixed, so no trie grows with the corpus. A trie hands on
only a spanning forest of the links it finds (links inside one of its components add nothing), and star contraction
joins those forests into components in about logarithmically many rounds, each a written table.

Defined results. Null or word-less text: fingerprint 0, linked like any other. Fewer words than `width`: one shingle of
all of them. A null doc_id takes part; component_id is the smallest non-null doc_id (null if there is none).
Repeated rows stay as rows. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from foliograph.llm.common import discard, fresh, id_and_text, keep, mix, release

WIDTH, BUDGET, SEED, BITS = 4, 4, 42, 64
HOT, BATCH, PAIRS = 512, 400_000, 1_000_000
ONE = np.uint64(1)


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(width, len(words))
    starts = np.concatenate([[0], ends[: len(words) - k] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 4096):
        part = h[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(x.as_py(), width) for x in batch["body"]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fps)], names=["doc_id", "fp"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())])
    return id_and_text(docs).mapInArrow(run, schema)


def bands_of(free: list[int], budget: int) -> list[list[int]]:
    """The free bits (numbers from the highest) in budget+1 runs of nearly equal length."""
    return [list(map(int, x)) for x in np.array_split(np.array(free, dtype=np.int64), budget + 1)]


class Forest:
    """Union-find over 0..n-1 with whole-array hooking."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if np.array_equal(up, self.root):
                    break
                self.root = up


def cross(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, room: int = 500_000):
    """Index pairs x of [a, b) and y of [c, d) for each of the interval pairs, in pieces of at most about room pairs."""
    left, right = b - a, d - c
    start = 0
    while start < len(a):
        sizes = np.cumsum(left[start:] * right[start:])
        many = max(1, int(np.searchsorted(sizes, room, side="right")))
        cut = slice(start, start + many)
        start += many
        if many == 1 and sizes[0] > room:  # one pair of long runs: row by row
            i = cut.start
            step = max(1, room // int(right[i]))
            for at in range(int(a[i]), int(b[i]), step):
                x = np.arange(at, min(at + step, int(b[i])))
                yield np.repeat(x, int(right[i])), np.tile(np.arange(int(c[i]), int(d[i])), len(x))
            continue
        n = left[cut] * right[cut]
        which = np.repeat(np.arange(many), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        yield a[cut][which] + k // right[cut][which], c[cut][which] + k % right[cut][which]


def trie_join(keys: np.ndarray, fps: np.ndarray, budget: int, judge=None) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (indices) of the fingerprints within budget bits in each run of equal keys.

    keys and fps are sorted together. A trie node at depth d is an interval of the sorted fingerprints that agree in d
    bits; its children are the intervals of those with bit d clear and set. Fingerprints may repeat in a key; then the
    trie ends in runs of equal ones, and all pairs of two runs are judged. judge(x, y, forest), if given, tells which
    pairs are links; it may keep others for itself.
    """
    n = len(fps)
    forest = Forest(n)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lo, hi = first, np.append(first[1:], n)
    judge = judge or (lambda x, y, _: np.bitwise_count(fps[x] ^ fps[y]) <= budget)

    def settle(x: np.ndarray, y: np.ndarray) -> None:
        near = judge(x, y, forest)
        forest.link(x[near], y[near])

    def leaves(a, b, c, d) -> None:
        for x, y in cross(a, b, c, d):
            apart = (x != y) & (forest.root[x] != forest.root[y])
            settle(x[apart], y[apart])

    twin = np.flatnonzero((fps[1:] == fps[:-1]) & (keys[1:] == keys[:-1]))
    settle(twin, twin + 1)
    big = hi - lo > 1
    stack = [(0, lo[big], hi[big], lo[big], hi[big], np.zeros(int(big.sum()), dtype=np.int8))]
    zeros: dict[int, np.ndarray] = {}
    while stack:
        depth, a, b, c, d, bits = stack.pop()
        same = a == c
        # pairs whose leaves are in one component already add nothing
        if depth % 8 == 0 and len(a):
            run = np.concatenate([[0], np.cumsum(forest.root[1:] != forest.root[:-1])])
            one = (run[a] == run[b - 1]) & (run[c] == run[d - 1]) & (forest.root[a] == forest.root[c])
            a, b, c, d, bits, same = a[~one], b[~one], c[~one], d[~one], bits[~one], same[~one]
        leaf = (b - a == 1) & (d - c == 1)
        settle(a[leaf & ~same], c[leaf & ~same])
        a, b, c, d, bits, same = a[~leaf], b[~leaf], c[~leaf], d[~leaf], bits[~leaf], same[~leaf]
        if not len(a):
            continue
        if depth == BITS:  # runs of equal fingerprints
            leaves(a, b, c, d)
            continue
        if len(a) > PAIRS:
            for at in range(0, len(a), PAIRS):
                cut = slice(at, at + PAIRS)
                stack.append((depth, a[cut], b[cut], c[cut], d[cut], bits[cut]))
            continue
        if depth not in zeros:
            clear = (fps >> np.uint64(BITS - 1 - depth)) & ONE == 0
            zeros[depth] = np.concatenate([[0], np.cumsum(clear)])
        z = zeros[depth]
        m, k = a + z[b] - z[a], c + z[d] - z[c]
        more = (bits < budget) & ~same
        over = bits < budget
        pairs = [(a, m, c, k, bits), (m, b, k, d, bits)]
        pairs.append(tuple(v[over] for v in (a, m, k, d, bits + np.int8(1))))
        pairs.append(tuple(v[more] for v in (m, b, c, k, bits + np.int8(1))))
        a, b, c, d, bits = (np.concatenate(v) for v in zip(*pairs))
        full = (b > a) & (d > c) & ~((a == c) & (b - a == 1))
        if full.any():
            stack.append((depth + 1, a[full], b[full], c[full], d[full], bits[full]))
    moved = np.flatnonzero(forest.root != np.arange(n))
    return moved, forest.root[moved]


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _join_tries(rows: DataFrame, budget: int) -> DataFrame:
    """Spanning links of the fingerprints that share a key.

    Keys are hashes; two that collide only put more fingerprints into one trie, which judges all 64 bits anyway.
    """

    def emit(keys, fps):
        order = np.lexsort((fps, keys))
        keys, fps = keys[order], fps[order]
        x, y = trie_join(keys, fps, budget)
        return pa.RecordBatch.from_arrays([pa.array(fps[v].view(np.int64)) for v in (x, y)], names=["a", "b"])

    def run(batches):
        keys, fps = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
        for batch in batches:
            keys = np.concatenate([keys, batch["key"].to_numpy()])
            fps = np.concatenate([fps, batch["fp"].to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) >= BATCH else 0
            if cut:
                yield emit(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield emit(keys, fps)

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, LINKS)


def _value(bits: list[int]) -> Column:
    """The values of a band's bits, one long for each run of neighbouring bits."""
    parts, start = [], 0
    while start < len(bits):
        end = start
        while end + 1 < len(bits) and bits[end + 1] == bits[end] + 1:
            end += 1
        mask = F.lit((1 << (end - start + 1)) - 1).cast("long")
        parts.append(F.shiftrightunsigned("fp", BITS - 1 - bits[end]).bitwiseAND(mask))
        start = end + 1
    return F.array(*parts)


def _dealt(rows: DataFrame, bands: list[list[int]]) -> DataFrame:
    """Each fingerprint once for each band: path gets the band's number, key also its value."""
    keys = F.array(*[F.xxhash64("key", F.lit(i), _value(b)) for i, b in enumerate(bands)])
    return rows.select("fp", "path", F.posexplode(keys).alias("band", "key")).select(
        "fp", F.concat("path", F.col("band").cast("string")).alias("path"), "key"
    )


def links(fps: DataFrame, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp) that make the same components as all within budget bits."""
    bands = bands_of(list(range(BITS)), budget)
    level = _dealt(fps.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("key")), bands)
    # path: the bands chosen so far; free: the bits that such a choice leaves open
    free = {str(i): [x for b in bands if b is not mine for x in b] for i, mine in enumerate(bands)}
    found = []
    while True:
        level = keep(level, "bands")
        sizes = keep(level.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "band-sizes")
        if (sizes.agg(F.max("n")).first()[0] or 0) <= hot:
            found.append(_join_tries(level.join(sizes, "key", "left_semi").select("key", "fp"), budget))
            break
        found.append(_join_tries(level.join(sizes.where(F.col("n") <= hot), "key", "left_semi").select("key", "fp"), budget))
        heavy = level.join(sizes.where(F.col("n") > hot), "key", "left_semi")
        deeper, further = [], {}
        for path, bits in free.items():
            mine = heavy.where(F.col("path") == path)
            if len(bits) <= budget:  # a key has at most 2**budget fingerprints now
                found.append(_join_tries(mine.select("key", "fp"), budget))
                continue
            bands = bands_of(bits, budget)
            deeper.append(_dealt(mine, bands))
            further |= {f"{path}{i}": [x for b in bands if b is not band for x in b] for i, band in enumerate(bands)}
        if not deeper:
            break
        level, free = reduce(DataFrame.unionByName, deeper), further
    return reduce(DataFrame.unionByName, found)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node of the links (a, b): root is the smallest node that links reach.

    Alternating large and small stars; every round is one written table, and a round that changes nothing ends it.
    """
    # column b is the smaller end
    e = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    both = lambda d: d.select("a", "b").unionByName(d.select(F.col("b").alias("a"), F.col("a").alias("b")))
    stamp = lambda d: d.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = stamp(e)
    for _ in range(rounds):
        # large star: a node's larger neighbours go to the smallest of its neighbours and itself
        low = both(e).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        big = both(e).join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of those
        least = big.groupBy("a").agg(F.min("b").alias("m"))
        # the smallest itself stands for the node's own link, so that the join is read once
        new = big.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        after = keep(new, "links")
        now = stamp(after)
        done, before = now == before, now
        discard(e)
        e = after
        if done:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"links did not settle in {rounds} rounds")


def near_duplicates(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET, hot: int = HOT) -> DataFrame:
    """doc_id, fp (long), component_id (smallest doc_id reachable)."""
    fps = keep(fingerprints(docs, width), "fingerprints")
    nodes = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    parts = components(links(nodes.select("fp"), budget, hot))
    placed = nodes.join(parts, nodes["fp"] == parts["node"], "left").select(nodes["fp"], "least", F.coalesce("root", nodes["fp"]).alias("root"))
    placed = keep(placed, "placed")
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    label = placed.join(smallest, "root").select("fp", "component_id")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def _unrepeated(docs: DataFrame) -> DataFrame:
    """One of the rows that are equal in doc_id and text."""
    key = fresh(docs, "text_key")
    return docs.withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)


def keep_one(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (of rows equal in it and in text, any one)."""
    labels = near_duplicates(docs, width, budget)
    survivors = labels.select(F.col("component_id").alias("__id")).distinct()
    return _unrepeated(docs.join(survivors, docs["doc_id"].eqNullSafe(survivors["__id"]), "left_semi"))


#: Words, similarity and words of 64 bits of the wider sketches; the chance that a pair just as similar meets in no table.
WORDS, SIMILARITY, SKETCH, MISS = 5, 0.8, 4, 0.02
#: Standard errors below the mean distance at the threshold up to which sketches propose a link.
SURE = 2.0
#: One in so many shingles must be shared among a set's lowest ones; sets of one block when pairs are judged, and when all
#: pairs of a cluster are; nodes of a shingle from which on they are a cluster; times that such nodes are dealt first.
SPARE, BLOCK, SIDE, COMMON, TURNS = 8, 2000, 400, 256, 2


def shingles(text: bytes, width: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of width words (fewer words: of all of them), in order, repeats included."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    k = min(width, len(words))
    starts = np.concatenate([[0], ends[: len(words) - k] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())], dtype=np.uint64)


def sketch(text: bytes, width: int = WORDS) -> np.ndarray:
    """SKETCH independent fingerprints of 64 bits of the set of shingles: one XXH64 for each, scrambled in as many ways."""
    return sketch_of(np.unique(shingles(text, width)))


def sketch_of(h: np.ndarray) -> np.ndarray:
    if not len(h):
        return np.zeros(SKETCH, dtype=np.uint64)
    out = []
    for way in range(1, SKETCH + 1):
        mixed, counts = mix(h + np.uint64(way * 0x9E3779B97F4A7C15 % 2**64)), np.zeros(BITS, dtype=np.int64)
        for at in range(0, len(h), 4096):
            counts += np.unpackbits(mixed[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        out.append(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])
    return np.array(out, dtype=np.uint64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays without repeats; 1 for two empty ones."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both) if len(a) or len(b) else 1.0


def bit_budget(bits: int, similarity: float = SIMILARITY, errors: float = 0.0) -> float:
    """Bits that the sketches of two texts of that Jaccard similarity differ in: the mean and so many standard errors."""
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return bits * share + errors * math.sqrt(bits * share * (1 - share))


def least_common(n, similarity: float = SIMILARITY):
    """Shingles that a set of n has in common with any set so similar (and that such a set has at least)."""
    return np.ceil(similarity * np.asarray(n) - 1e-6).astype(np.int64)


def least_low(n):
    """Lowest shingles that sets of at least n, cut by lowest(), have in common if they are similar enough."""
    return np.maximum(1, np.asarray(n) // SPARE)


def lowest(n, similarity: float = SIMILARITY):
    """How many of a set's n shingles are kept as its lowest ones.

    Two sets with o shingles in common share k of them among their first n - o + k in any order that both follow.
    """
    return np.minimum(n, n - least_common(n, similarity) + least_low(n))


def similar_links(docs: DataFrame, width: int = WORDS, similarity: float = SIMILARITY, crowd: int = 4096, common: int = COMMON) -> DataFrame:
    """a, b: links between doc_ids that make the same components as all pairs of at least that Jaccard similarity of
    their sets of shingles of width words. Every group is tied by the sets themselves (XXH64 of the shingles).

    Sketches tie large groups cheaply: pairs at the threshold differ in too many of 64 bits for bands, so each sketch
    goes to several tables, keyed by some of its 256 bits. In a table's tries the first 64 bits prune and all 256 judge;
    pairs SURE standard errors nearer than the mean of pairs at the threshold are proposed. A key with over crowd
    sketches is joined block by block; that work grows with the square of such a key's sketches over crowd.

    Whatever sketches miss is found by shared shingles: two sets that are similar enough share one of the rarest of
    their lowest shingles (see _postings), so all pairs that share one and are in different groups so far are judged.
    Sets that meet in shingles of over `common` sets are crowds: they meet by the rarest of all their shingles instead,
    and where these are of over `common` sets too, they are dealt to blocks first, TURNS times, each judged whole. That
    ties dense crowds in work that grows with their size. What is in different groups after that is judged by all pairs,
    block by block; only that work grows with the square of the sets of a crowd that stay apart.
    """
    names = [f"s{k}" for k in range(SKETCH)]

    def run(batches):
        for batch in batches:
            sets = [np.unique(shingles(b.as_py(), width)) for b in batch["body"]]
            x = np.array([sketch_of(h) for h in sets], dtype=np.uint64).reshape(-1, SKETCH).view(np.int64)
            own = [pa.array([_node(h) for h in sets], pa.int64()), pa.array([len(h) for h in sets], pa.int64())]
            low = pa.array([h[: lowest(len(h), similarity)].tobytes() for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), *own, low, *(pa.array(c) for c in x.T)], names=["doc_id", "node", "n", "low", *names])
        release()

    rows = id_and_text(docs).where("doc_id is not null").mapInArrow(run, "doc_id long, node long, n long, low binary, " + ", ".join(f"{n} long" for n in names))
    rows = keep(rows, "sketches")
    # equal sets are one node
    firsts = keep(rows.groupBy("node", *names).agg(F.min("doc_id").alias("first")), "distinct-sets")
    same = rows.select("doc_id", "node").join(firsts.select("node", "first"), "node").where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    n = max(2, firsts.count())
    agree = 1 - bit_budget(1, similarity)
    chosen = max(10, math.ceil(math.log2(n / 32)))
    rng = np.random.default_rng(SEED)

    def tables(d: DataFrame, bits: int, many: int) -> DataFrame:
        keys = []
        for t in range(many):
            picked = sorted(int(b) for b in rng.choice(SKETCH * BITS, bits, replace=False))
            keys.append(F.xxhash64("key", F.lit(t), F.array(*[F.shiftrightunsigned(names[b // BITS], b % BITS).bitwiseAND(F.lit(1).cast("long")) for b in picked])))
        return d.select("doc_id", *names, F.explode(F.array(*keys)).alias("key"))

    postings = keep(_postings(rows, similarity), "postings")
    sets = keep(_sets(docs, firsts.join(postings.select("node").distinct(), "node").select("node", "first"), width), "shingle-sets")
    # only these sets can be similar to another
    open_sets = firsts.join(sets.select("node"), "node", "left_semi").select(F.col("node").alias("doc_id"), *names, F.lit(0).cast("long").alias("key"))
    level = keep(tables(open_sets, chosen, math.ceil(math.log(MISS) / math.log(1 - agree**chosen))), "tables")
    sizes = keep(level.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "table-sizes")
    few = level.join(sizes.where(F.col("n") <= crowd), "key", "left_semi")
    many = _in_blocks(level.join(sizes.where(F.col("n") > crowd), "key"), crowd)
    proposed = keep(_similar(few, names, similarity).unionByName(_similar(many, names, similarity)).distinct(), "proposed")
    discard(level)
    tied = keep(_judged(proposed, sets, similarity), "sure-links")
    groups = keep(components(tied), "tied")
    apart = _apart(postings, groups)
    pairs = _pairs_apart(apart.where(F.col("met") <= common), similarity)
    crowd = sets.join(keep(apart.where(F.col("met") > common).select("node").distinct(), "crowd"), "node")
    crowd = crowd.select("node", (F.octet_length("shingles") / 8).cast("long").alias("n"), F.col("shingles").alias("low"))
    finer = keep(_postings(crowd, similarity, whole=True), "crowd-postings")
    apart = _apart(finer, groups)
    for turn in range(TURNS):
        new = keep(_dealt_once(apart.where(F.col("met") > common), sets, similarity, turn), "crowd-links")
        if new.isEmpty():
            break
        groups = keep(_regrouped(groups, new), "tied")
        apart = _apart(finer, groups)
    pairs = pairs.unionByName(_pairs_apart(apart.where(F.col("met") <= common), similarity))
    rest = _judged(keep(pairs.distinct(), "open-pairs"), sets, similarity)
    rest = rest.unionByName(_counted(apart.where(F.col("met") > common), sets, similarity))
    end = lambda e: firsts.select(F.col("node").alias(e), F.col("first").alias(f"{e}_doc"))
    links = groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest).join(end("a"), "a").join(end("b"), "b").select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"))
    return same.unionByName(links)


def _node(h: np.ndarray) -> int:
    """XXH3 of a sorted set of shingles, as a signed long; equal ones count as equal sets."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).astype(np.int64))


TOKENS = T.StructType([T.StructField(n, T.LongType()) for n in ("token", "node", "n")])
SHARED = T.StructType([*TOKENS.fields, T.StructField("times", T.LongType()), T.StructField("need", T.LongType())])


def _runs_of(batches, key: str, columns: tuple[str, ...], emit, shorten=None):
    """emit(arrays) for pieces of batches sorted by key, each with all rows of its keys; shorten may drop rows of a long run."""
    held, size, room = [], 0, BATCH
    for batch in batches:
        held.append([batch[c].to_numpy() for c in columns])
        size += batch.num_rows
        if size < room:
            continue
        arrays = [np.concatenate(c) for c in zip(*held)]
        keys = arrays[columns.index(key)]
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut:
            yield from emit([c[:cut] for c in arrays])
        rest = [c[cut:].copy() for c in arrays]
        rest = shorten(rest) if shorten else rest
        held, size = [rest], len(rest[0])
        room = max(BATCH, 2 * size)
    if size:
        yield from emit([np.concatenate(c) for c in zip(*held)])
    release()


def _postings(rows: DataFrame, similarity: float, whole: bool = False) -> DataFrame:
    """token, node, n: the shingles by which a set of n shingles (a node) meets all those that are similar enough.

    Of two such sets, the lowest() of each have least_low() in common, those of the smaller that a set of n can meet.
    Taken from rare to frequent, all but need - 1 of these must hold a common one; shingles of one set only come first,
    so a set with many of its own has no postings and is similar to none. If whole, low has all shingles of a set, which
    have least_common() in common.
    """

    def spread(batches):
        names = TOKENS.names
        for batch in batches:
            at, n = 0, batch["n"].to_numpy()
            low = n if whole else np.minimum(n, lowest(n, similarity))
            ends = np.cumsum(low)
            while at < len(n):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH, side="right")))
                tokens = np.frombuffer(b"".join(batch["low"].slice(at, to - at).to_pylist()), dtype=np.int64)
                of = np.repeat(np.arange(at, to), low[at:to])
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(batch["node"].to_numpy()[of]), pa.array(n[of])], names=names)
                at = to
        release()

    def once(arrays):
        token, node, n = arrays
        order = np.lexsort((node, token))
        token, node, n = token[order], node[order], n[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        return [token[new], node[new], n[new]]

    def emit(arrays):
        token, node, n = once(arrays)
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        times = np.diff(np.append(first, len(token)))
        times = np.repeat(times, times)
        several = times > 1
        token, node, n, times = token[several], node[several], n[several], times[several]
        need = least_common(n, similarity)
        columns = [token, node, n, times, need if whole else least_low(need)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=SHARED.names)

    tokens = rows.select("node", "n", "low").mapInArrow(spread, TOKENS).repartition("token").sortWithinPartitions("token")
    shared = tokens.mapInArrow(lambda batches: _runs_of(batches, "token", ("token", "node", "n"), emit, once), SHARED)
    mine = Window.partitionBy("node")
    placed = shared.withColumns({"place": F.row_number().over(mine.orderBy("times", "token")), "have": F.count(F.lit(1)).over(mine)})
    return placed.where("place <= have - need + 1").select("token", "node", "n")


def _sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node, shingles (sorted, as bytes) of the wanted (node, first: a doc_id that has it); rows may repeat."""

    def run(batches):
        for batch in batches:
            sets = [np.unique(shingles(b.as_py(), width)) for b in batch["body"]]
            mine = pa.array([_node(h) == node for h, node in zip(sets, batch["node"].to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array([h.tobytes() for h in sets], pa.binary())], names=["node", "shingles"]).filter(mine)
        release()

    bodies = id_and_text(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return bodies.join(wanted, F.col("doc_id") == F.col("first")).select("node", "body").mapInArrow(run, "node long, shingles binary")


def _pairs_apart(postings: DataFrame, similarity: float) -> DataFrame:
    """a, b: nodes of different roots and of like enough sizes that share a token; pairs may repeat."""

    def emit(arrays):
        token, node, n, root = arrays
        order = np.lexsort((n, token))
        token, node, n, root = token[order], node[order], n[order], root[order]
        run = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]]))
        step = int(n.max()) + 1
        most = np.minimum(step - 1, np.floor(n / similarity + 1e-6).astype(np.int64))
        to = np.searchsorted(run * step + n, run * step + most, side="right")
        at = np.arange(len(n))
        names, number = np.unique(node, return_inverse=True)
        some = to > at + 1
        pool, size = [], 0
        for x, y in cross(at[some], at[some] + 1, at[some] + 1, to[some]):
            x, y = x[root[x] != root[y]], y[root[x] != root[y]]
            pool.append(np.unique(np.maximum(number[x], number[y]) * len(names) + np.minimum(number[x], number[y])))
            size += len(pool[-1])
            if size > PAIRS:
                pairs = np.unique(np.concatenate(pool))
                pool, size = [pairs], len(pairs)
                if size > PAIRS // 2:
                    yield links_of(names, pairs)
                    pool, size = [], 0
        if pool:
            yield links_of(names, np.unique(np.concatenate(pool)))

    def links_of(names, pairs):
        return pa.RecordBatch.from_arrays([pa.array(names[pairs // len(names)]), pa.array(names[pairs % len(names)])], names=["a", "b"])

    rows = postings.repartition("token").sortWithinPartitions("token")
    return rows.mapInArrow(lambda batches: _runs_of(batches, "token", ("token", "node", "n", "root"), emit), LINKS)


def overlaps(sets: list[np.ndarray], few: int = 30) -> np.ndarray:
    """How many values each two of the sets (sorted arrays without repeats) have in common; values of over few sets by
    products of 0/1 matrices, the rest pair by pair."""
    m = len(sets)
    value, of = np.concatenate(sets), np.repeat(np.arange(m), [len(x) for x in sets])
    order = np.argsort(value, kind="stable")
    value, of = value[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.empty(0, dtype=np.int64)
    last = np.append(first[1:], len(value))
    out = np.zeros(m * m, dtype=np.int64)
    rare = (last - first > 1) & (last - first <= few)
    for x, y in cross(first[rare], last[rare], first[rare], last[rare]):
        out += np.bincount(of[x] * m + of[y], minlength=m * m)
    out = out.reshape(m, m)
    first, last = first[last - first > few], last[last - first > few]
    for at in range(0, len(first), 2048):
        a, n = first[at : at + 2048], (last - first)[at : at + 2048]
        has = np.zeros((len(a), m), dtype=np.float32)
        row = np.repeat(np.arange(len(a)), n)
        has[row, of[np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)]] = 1
        out += (has.T @ has).astype(np.int64)
    return out


def _apart(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """token, node, n, root, met (nodes of the token): the postings of tokens that lead to several groups (node, root)."""
    placed = postings.join(groups, "node", "left").select("token", "node", "n", F.coalesce("root", "node").alias("root"))
    placed = keep(placed, "postings-apart")
    met = placed.groupBy("token").agg(F.count(F.lit(1)).alias("met"), F.min("root").alias("x"), F.max("root").alias("y"))
    met = keep(met.where("x <> y").select("token", "met"), "tokens-apart")
    apart = keep(placed.join(met, "token"), "met-apart")
    discard(placed)
    discard(met)
    return apart


def _regrouped(groups: DataFrame, new: DataFrame) -> DataFrame:
    """node, root: the groups after links (a, b) between their roots; a group's root itself has no row."""
    parts = keep(components(new), "roots-tied")
    old = groups.join(parts.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    return old.select("node", F.coalesce("to", "root").alias("root")).unionByName(parts)


def _dealt_once(postings: DataFrame, sets: DataFrame, similarity: float, turn: int) -> DataFrame:
    """Links (a, b) between roots, from each node (token, node, root, met) meeting one block of its most frequent token."""
    homes = postings.groupBy("node", "root").agg(F.max(F.struct("met", "token")).getField("token").alias("home"))
    homes = keep(homes, "homes")
    sizes = keep(homes.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / (2 * SIDE)).alias("blocks")), "home-sizes")
    mine = F.pmod(F.xxhash64("node", F.lit(turn)), F.col("blocks"))
    return _blockwise(homes.join(sizes, "home").select("node", "root", F.xxhash64("home", mine).alias("cell")), sets, similarity)


def _cells(postings: DataFrame) -> DataFrame:
    """node, root, cell: nodes that tokens (token, node, root) lead to from each other meet in a cell, unless of one root.

    A cluster's nodes are dealt to blocks, and two blocks make a cell. A root of over SIDE nodes has blocks of its own,
    which do not meet each other.
    """
    members = keep(postings.select("node", "root").distinct(), "members")
    clusters = keep(components(postings.select(F.col("token").alias("a"), F.col("root").alias("b")).distinct()), "clusters")
    clusters = clusters.select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    # the smallest end of a cluster has no row of its own
    roots = members.groupBy("root").agg(F.count(F.lit(1)).alias("many")).join(clusters, "root", "left")
    own = F.col("many") > SIDE
    roots = roots.select("root", F.coalesce("cluster", "root").alias("cluster"), "many", own.alias("own"), F.when(own, F.col("root")).otherwise(0).alias("lane"))
    roots = keep(roots, "cluster-roots")
    lanes = keep(roots.groupBy("cluster", "own", "lane").agg(F.ceil(F.sum("many") / SIDE).alias("blocks")), "lanes")
    block = F.xxhash64("cluster", "own", "lane", "number")
    blocks = lanes.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    blocks = keep(blocks.select("cluster", "own", "lane", block.alias("block")), "blocks")
    other = blocks.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("own", "lane", "block")])
    met = blocks.join(other, "cluster").where("not own or not own2 or lane <> lane2")
    met = met.select("block", F.xxhash64(F.least("block", "block2"), F.greatest("block", "block2")).alias("cell"))
    places = members.join(roots.join(lanes, ["cluster", "own", "lane"]).drop("many"), "root")
    places = places.withColumn("number", F.pmod(F.xxhash64("node"), F.col("blocks"))).select("node", "root", block.alias("block"))
    return keep(places, "places").join(keep(met, "block-pairs"), "block").select("node", "root", "cell")


def _counted(postings: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between roots that tie as all similar pairs of a cluster do: nodes that tokens (token, node, root) lead to."""
    return _blockwise(_cells(postings), sets, similarity)


def _blockwise(cells: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between roots that tie as all similar pairs of a cell's nodes (node, root, cell) do."""

    def judge(nodes: list[int], roots: list[int], held: list[np.ndarray]):
        names, of = np.unique(np.array(roots, dtype=np.int64), return_inverse=True)
        forest = Forest(len(names))
        if len(names) > 1:
            at = np.unique(np.array(nodes, dtype=np.int64), return_index=True)[1]
            of, held = of[at], [held[i] for i in at]
            n, both = np.array([len(h) for h in held]), overlaps(held)
            x, y = np.nonzero(np.triu(both / np.maximum(1, n[:, None] + n[None, :] - both) >= similarity, 1))
            forest.link(of[x], of[y])
        moved = np.flatnonzero(forest.root != np.arange(len(names)))
        return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[forest.root[moved]])], names=["a", "b"])

    def run(batches):
        now, nodes, roots, held = None, [], [], []
        for batch in batches:
            for cell, node, root, h in zip(*(batch[k].to_pylist() for k in ("cell", "node", "root")), batch["shingles"]):
                if cell != now:
                    if nodes:
                        yield judge(nodes, roots, held)
                    now, nodes, roots, held = cell, [], [], []
                nodes.append(node)
                roots.append(root)
                held.append(np.frombuffer(h.as_buffer(), dtype=np.uint64))
        if nodes:
            yield judge(nodes, roots, held)
        release()

    rows = cells.join(sets, "node").select("cell", "node", "root", "shingles").repartition("cell").sortWithinPartitions("cell")
    return rows.mapInArrow(run, LINKS)


def _judged(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Of the pairs (a, b) those whose sets are similar enough, but for such as other pairs of their cell tie already.

    Nodes are dealt to blocks, and a pair goes to the cell of its two blocks, where each set is needed once.
    A node without a set is similar to none.
    """
    blocks = max(16, sets.count() // BLOCK)
    cell = F.pmod(F.xxhash64("a"), F.lit(blocks)) * blocks + F.pmod(F.xxhash64("b"), F.lit(blocks))
    pairs = keep(pairs.select(cell.alias("cell"), "a", "b"), "cells")
    ends = pairs.select("cell", F.col("a").alias("node")).union(pairs.select("cell", "b")).distinct()
    needed = ends.join(sets, "node").select("cell", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "shingles")
    both = needed.unionByName(pairs.withColumn("shingles", F.lit(None).cast("binary")))

    def run(batches):
        now, held, root = None, {}, {}

        def top(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        for batch in batches:
            found = []
            for c, a, b, h in zip(*(batch[k].to_pylist() for k in ("cell", "a", "b", "shingles"))):
                if c != now:
                    now, held, root = c, {}, {}
                if b is None:
                    held[a] = np.frombuffer(h, dtype=np.uint64)
                elif a in held and b in held:
                    x, y, s, t = top(a), top(b), len(held[a]), len(held[b])
                    if x != y and min(s, t) >= similarity * max(s, t) - 1e-6 and jaccard(held[a], held[b]) >= similarity:
                        root[max(x, y)] = min(x, y)
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])
        release()

    dealt = both.repartition("cell").sortWithinPartitions("cell", F.col("b").asc_nulls_first())
    return dealt.select("cell", "a", "b", "shingles").mapInArrow(run, LINKS)


def _in_blocks(rows: DataFrame, crowd: int) -> DataFrame:
    """Rows of keys with n > crowd sketches, dealt so that any two of a key meet and a new key has about crowd rows.

    A key's rows go to blocks of about crowd/2, and each two blocks make a new key.
    """
    blocks = F.ceil(2 * F.col("n") / crowd)
    mine = F.pmod(F.xxhash64("doc_id", "key"), blocks)
    rows = rows.withColumns({"mine": mine, "other": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))}).where("mine <> other")
    return rows.withColumn("key", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"))).drop("n", "mine", "other")


def _similar(rows: DataFrame, names: list[str], similarity: float) -> DataFrame:
    """Pairs (a, b) of near sketches that share a key; near pairs that others of the key tie already may be left out."""
    sure = int(bit_budget(SKETCH * BITS, similarity, -SURE))
    first = int(bit_budget(BITS, similarity, 3))

    def emit(keys, ids, s):
        order = np.lexsort((ids, *s.T[::-1], keys))
        keys, ids, s = keys[order], ids[order], s[order]
        found = []

        def judge(x, y, forest):
            near = np.bitwise_count(s[x] ^ s[y]).sum(axis=1, dtype=np.int32) <= sure
            # of the pairs between two groups so far, one
            at = np.flatnonzero(near & (forest.root[x] != forest.root[y]))
            r, t = forest.root[x[at]], forest.root[y[at]]
            at = at[np.unique(np.minimum(r, t) * len(keys) + np.maximum(r, t), return_index=True)[1]]
            found.append((x[at], y[at]))
            return near

        trie_join(keys, np.ascontiguousarray(s[:, 0]), first, judge)
        a, b = (ids[np.concatenate(e)] for e in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            s = np.stack([batch[n].to_numpy().view(np.uint64) for n in names], axis=1)
            held.append((batch["key"].to_numpy(), batch["doc_id"].to_numpy(), s))
            size += batch.num_rows
            if size >= BATCH // 2:
                keys, ids, s = (np.concatenate(c) for c in zip(*held))
                cut = int(np.searchsorted(keys, keys[-1]))
                if cut:
                    yield emit(keys[:cut], ids[:cut], s[:cut])
                held, size = [(keys[cut:].copy(), ids[cut:].copy(), s[cut:].copy())], len(keys) - cut
        if size:
            yield emit(*(np.concatenate(c) for c in zip(*held)))
        release()

    return rows.select("key", "doc_id", *names).repartition("key").sortWithinPartitions("key").mapInArrow(run, LINKS)


def keep_one_similar(docs: DataFrame) -> DataFrame:
    """docs with one row of each group that near_duplicates() or similar_links() ties together: the smallest doc_id's.

    Rows without doc_id all stay but for repeats of a text among them.
    """
    tight = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").cast("long").alias("a"), F.col("component_id").cast("long").alias("b"))
    parts = components(tight.unionByName(similar_links(docs)))
    gone = keep(parts.where("node <> root").select("node"), "near-copies")
    return _unrepeated(docs.join(gone, docs["doc_id"].cast("long") == gone["node"], "left_anti"))
