"""Operator 4, suffix-array dedup by the common-prefix interval tree of an enhanced suffix array.

Every byte that a repeated string of `width` bytes covers goes. The suffixes that matter stand at anchors: of each
window of `width` bytes, its run of ANCHOR bytes with the smallest hash (see common.segments), so equal windows, in
whatever documents, hold equal anchors at the same distance. Anchors found once are done with. The occurrences of an
anchor make one bucket: their texts from the anchor on, sorted, are the bucket's suffix array, the common prefixes of
neighbours complete it, and a stack scan yields the tree of common-prefix intervals, each with all its occurrences.
In an interval, the occurrences are told apart by what stands left of the anchor: the longest left extension that an
occurrence shares with another, together with the interval's depth, gives the windows of that occurrence that repeat.
Occurrences whose whole texts (all windows of the run) are equal, by XXH3 beside the anchor's hash, are one suffix with a
count, summed before any text moves: an interval of equal suffixes. A bucket that is nothing but such an interval needs
no text, as its tree has no other node. A bucket of over `hot` different texts is split by the bytes next to its anchor,
as often as needed, and each part has a tree of its own.

Defined results. Null text: empty. Texts shorter than `width`: nothing removed. Repeated rows repeat each other's
strings, so all their bytes go where long enough. Null doc_ids take part. Empty tables give empty results. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import keep, merged, numbered, record_batch, release, same_row, segments

WIDTH, ANCHOR, HOT = 400, 200, 512


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(suffixes: list[bytes]):
    """Stack scan over sorted suffixes: yields (depth, [(first, last), ...]) for each common-prefix interval, children
    before parents, with the child intervals or single suffixes that it unites."""
    stack: list[tuple[int, list[tuple[int, int]]]] = []
    part = (0, 0)
    for i in range(1, len(suffixes) + 1):
        lcp = common(suffixes[i - 1], suffixes[i]) if i < len(suffixes) else -1
        while stack and stack[-1][0] > lcp:
            depth, parts = stack.pop()
            parts.append(part)
            yield depth, parts
            part = (parts[0][0], part[1])
        if lcp < 0:
            break
        if stack and stack[-1][0] == lcp:
            stack[-1][1].append(part)
        else:
            stack.append((lcp, [part]))
        part = (i, i)


def repeated_windows(lefts: list[bytes], rights: list[bytes], width: int) -> list[list[tuple[int, int]]]:
    """For each occurrence of an anchor, ranges (inclusive) of left lengths a such that its window of `width` bytes with
    a bytes left of the anchor is also at another occurrence. rights are sorted; lefts are reversed (nearest byte first).
    """
    n = len(lefts)
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    by_left = sorted(range(n), key=lefts.__getitem__)
    place = [0] * n
    for k, i in enumerate(by_left):
        place[i] = k
    best = [-1] * n
    groups: dict[int, list[int]] = {i: [place[i]] for i in range(n)}  # by first suffix: left places, sorted

    def extend(x: int, y: int, depth: int) -> None:
        shared = common(lefts[x], lefts[y])
        for o in (x, y):
            if shared > best[o]:
                best[o] = shared
                if shared + depth >= width:
                    out[o].append((max(0, width - depth), shared))

    for depth, parts in intervals(rights):
        lists = [groups.pop(first) for first, _ in parts]
        largest = max(range(len(lists)), key=lambda k: len(lists[k]))
        whole = lists.pop(largest)
        for small in lists:
            for p in small:
                at = bisect_left(whole, p)
                if at:
                    extend(by_left[whole[at - 1]], by_left[p], depth)
                if at < len(whole):
                    extend(by_left[p], by_left[whole[at]], depth)
                whole.insert(at, p)
        groups[parts[0][0]] = whole
    return out


def _schema(docs: DataFrame, *names: str) -> T.StructType:
    own = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("body_key", T.LongType())]
    return T.StructType(own + [T.StructField(n, T.LongType()) for n in names])


RUN = ("anchor", "content", "start", "n", "left")


def _runs(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, cols = [], {n: [] for n in RUN}
            for k, body in enumerate(batch["body"]):
                raw = np.frombuffer(body.as_py(), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
                a, s, n, left, content = segments(raw, width, anchor, body.as_py())
                ids.append(np.full(len(s), k))
                for name, x in zip(RUN, (a, content, s, n, left)):
                    cols[name].append(x)
            yield record_batch(batch, ids, cols)

    return numbered(docs).mapInArrow(run, _schema(docs, *RUN))


TEXTS = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "content", "n", "left", "times")] + [T.StructField("body", T.BinaryType())])
RANGES = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "content", "from", "to")])


def _texts(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """One text for each different run of wanted (anchor, content, times, and where one of them stands)."""

    def run(batches):
        for batch in batches:
            rows, bodies = [], []
            for body, runs in zip(batch["body"], batch["runs"].to_pylist()):
                text = body.as_py()
                for r in runs:
                    rows.append([r[c] for c in ("anchor", "content", "n", "left", "times")])
                    bodies.append(text[r["start"] : r["start"] + r["n"] - 1 + width])
            cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(bodies, pa.binary())], names=TEXTS.names)

    runs = wanted.groupBy("doc_id", "body_key").agg(F.collect_list(F.struct("anchor", "content", "start", "n", "left", "times")).alias("runs"))
    all_docs = numbered(docs)
    return all_docs.join(runs, same_row(all_docs, runs)).select("body", "runs").mapInArrow(run, TEXTS)


def _bucket(rows: list[tuple], width: int):
    """Windows (anchor, content, from, to) that the interval tree of one bucket's different runs finds repeated.

    rows: anchor, content, n, left, times, low, high, body; only windows with low to high bytes left of the anchor count.
    """
    seen = {r[1]: r for r in rows}
    rows = sorted(seen.values(), key=lambda r: (r[7][r[3] :], r[1]))
    found = repeated_windows([r[7][: r[3]][::-1] for r in rows], [r[7][r[3] :] for r in rows], width)
    for (anchor, content, n, left, times, low, high, _), ranges in zip(rows, found):
        # a run that stands several times is an interval of equal suffixes, as deep as it is long
        for lo, hi in [(0, left)] if times > 1 else ranges:
            a, b = max(0, left - min(hi, high)), min(n - 1, left - max(lo, low))
            if a <= b:
                yield anchor, content, a, b


def _by_tree(texts: DataFrame, width: int) -> DataFrame:
    """Windows (numbers from, to inclusive within a run) that the interval trees of the buckets (equal `key`) find repeated."""

    def emit(rows):
        cols = np.array(rows, dtype=np.int64).reshape(-1, 4).T
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=RANGES.names)

    def run(batches):
        held, now, out = [], None, []
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("key", "anchor", "content", "n", "left", "times", "low", "high", "body"))):
                if r[0] != now and held:
                    out += _bucket(held, width)
                    held = []
                    if len(out) > 50_000:
                        yield emit(out)
                        out = []
                now = r[0]
                held.append(r[1:])
        if held:
            out += _bucket(held, width)
        if out:
            yield emit(out)
        release()

    return texts.repartition("key").sortWithinPartitions("key").mapInArrow(run, RANGES)


def _ranges(texts: DataFrame, width: int, anchor: int, hot: int) -> DataFrame:
    """Repeated windows of the runs in texts, by the interval tree of each bucket.

    A bucket is that of an anchor at first. One of over hot runs is split in two by the bytes next to what its windows
    share: windows with at most m bytes left of the anchor share width - m bytes from it on, the others more than m bytes
    before it; a run goes to both halves, each keyed by those bytes, and only its windows of that half count there. This
    goes on until buckets are small or hold one window each; then a bucket of several runs is that window's occurrences.
    """
    whole = texts.withColumns({"low": F.lit(0).cast("long"), "high": F.lit(width - anchor).cast("long"), "key": F.col("anchor")})
    found, level = [], whole
    while True:
        sizes = keep(level.groupBy("key", "low", "high").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > hot), "hot-buckets")
        if sizes.isEmpty():
            found.append(_by_tree(level, width))
            break
        by = ["key", "low", "high"]
        found.append(_by_tree(level.join(sizes, by, "left_anti"), width))
        heavy = keep(level.join(sizes.drop("m"), by), "hot-runs")
        alone = heavy.where("low = high")
        found.append(alone.select("anchor", "content", (F.col("left") - F.col("low")).alias("from"), (F.col("left") - F.col("low")).alias("to")))
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        halves = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high")))
        parts = heavy.where("low < high").withColumn("half", F.explode(halves)).withColumns({"low": F.col("half.low"), "high": F.col("half.high")}).drop("half")
        # only runs with windows in the half
        parts = parts.where((F.col("low") <= F.col("left")) & (F.col("left") - F.col("high") <= F.col("n") - 1))
        shared = F.substring("body", (F.col("left") - F.col("low") + 1).cast("int"), (width + F.col("low") - F.col("high")).cast("int"))
        level = keep(parts.withColumn("key", F.xxhash64("anchor", "low", "high", F.sha2(shared, 256))), "split-runs")
    return reduce(DataFrame.unionByName, found)


def repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """doc_id, body_key, spans: the bytes (half-open, unmerged) of each document that repeated strings cover."""
    anchor = min(anchor, width)
    runs = keep(_runs(docs, width, anchor), "runs")
    counts = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("all"), (F.min("content") != F.max("content")).alias("mixed"))
    # both sides of a join are tables, so that Spark sees a hot key's size and splits it
    counts = keep(counts.where("all > 1").drop("all"), "anchors")
    found = keep(runs.join(counts, "anchor"), "anchored")
    # of each different run: how often, and one place
    each = found.where("mixed").groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct(F.col("doc_id"), F.col("body_key"), F.col("start"), F.col("n"), F.col("left"))).alias("x")
    )
    each = keep(each.select("anchor", "content", "times", "x.*"), "different-runs")
    texts = keep(_texts(docs, each, width), "run-texts")
    ranges = _ranges(texts, width, anchor, hot)
    ranges = keep(ranges.groupBy("anchor", "content").agg(F.collect_set(F.struct("from", "to")).alias("r")), "ranges")
    part = found.where("mixed").join(ranges, ["anchor", "content"]).select("doc_id", "body_key", "start", F.explode("r").alias("r"))
    part = part.select("doc_id", "body_key", (F.col("start") + F.col("r.from")).alias("start"), (F.col("start") + F.col("r.to") + width).alias("end"))
    # the bucket of a single run that stands several times is one interval
    whole = found.where("not mixed").select("doc_id", "body_key", "start", (F.col("start") + F.col("n") - 1 + width).alias("end"))
    return whole.unionByName(part).groupBy("doc_id", "body_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def kept_bytes(body: bytes, spans: list[dict] | None) -> tuple[bytes, int]:
    """What is left of a text, and how many maximal runs went."""
    if not spans:
        return body, 0
    s, e = merged(np.array([x["start"] for x in spans]), np.array([x["end"] for x in spans]))
    out, at = [], 0
    for a, b in zip(s.tolist(), e.tolist()):
        out.append(body[at:a])
        at = b
    return b"".join([*out, body[at:]]), len(s)


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the remaining bytes (kept, binary) of each document."""

    def run(batches):
        for batch in batches:
            made = [(b.as_py(), kept_bytes(b.as_py(), s)) for b, s in zip(batch["body"], batch["spans"].to_pylist())]
            columns = [
                batch["doc_id"],
                pa.array([len(b) for b, _ in made], pa.int64()),
                pa.array([len(b) - len(k) for b, (k, _) in made], pa.int64()),
                pa.array([n for _, (_, n) in made], pa.int64()),
                pa.array([k for _, (k, _) in made], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    numbers = [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([docs.schema["doc_id"], *numbers, T.StructField("kept", T.BinaryType())])
    rows, spans = numbered(docs), repeats(docs, width)
    return rows.join(spans, same_row(rows, spans), "left").select(rows["doc_id"], "body", "spans").mapInArrow(run, schema)


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    return dedup(docs, width).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
