"""Operator 10, substring dedup by Rabin-Karp hashes of fixed-length token windows, counted in Spark.

A window is `width` consecutive words of one document; the words that a window repeated from an earlier document
covers go. Hashes are differences of prefix sums over word hashes, so a window costs one subtraction. To shuffle fewer
rows than the corpus has words, the windows of a document are first cut into runs that share an anchor (see
common.segments): equal windows have equal anchors at the same distance. Spark counts the runs by anchor. An anchor of
one document is done with; where all runs of an anchor hold the same words, they are equal window for window, which is
an exact shortcut; only the windows of the remaining runs are counted one by one, by two independent 64-bit hashes of
their 50 word hashes. Whole runs, which may be long, are compared by XXH3, so no sum of many terms stands for equality. All counts are map-side
minima and maxima, so what stands in a third of all rows is one row of each task. Repeated windows of a document merge
into maximal removal intervals.

Defined results. Null text: no words. Fewer words than `width`: nothing removed. Documents of equal doc_id are not
earlier than each other, so repeated rows remove nothing of each other. A null doc_id counts as later than any other.
Empty tables give empty results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import ROLLS, Sums, fresh, hash_words, keep, merged, numbered, record_batch, same_row, segments

WIDTH, ANCHOR = 50, 20


def _schema(docs: DataFrame, *names: str) -> T.StructType:
    own = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("body_key", T.LongType())]
    return T.StructType(own + [T.StructField(n, T.LongType()) for n in names])


def _runs(docs: DataFrame, width: int, anchor: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids, cols = [], {n: [] for n in ("anchor", "content", "start", "n")}
            for k, body in enumerate(batch["body"]):
                h = hash_words(body.as_py())[0]
                a, s, n, _, content = segments(h, width, anchor, h)
                ids.append(np.full(len(s), k))
                for name, x in zip(cols, (a, content, s, n)):
                    cols[name].append(x)
            yield record_batch(batch, ids, cols)

    return numbered(docs).mapInArrow(run, _schema(docs, "anchor", "content", "start", "n"))


def _windows(texts: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Both hashes of every window in the runs of a document."""

    def run(batches):
        for batch in batches:
            ids, cols = [], {n: [] for n in ("h1", "h2", "start")}
            for k, (body, runs) in enumerate(zip(batch["body"], batch["runs"].to_pylist())):
                h = hash_words(body.as_py())[0]
                at = np.unique(np.concatenate([np.arange(r["start"], r["start"] + r["n"]) for r in runs]))
                ids.append(np.full(len(at), k))
                for name, x in zip(cols, (*(Sums(r, h).windows(width)[at] for r in ROLLS), at)):
                    cols[name].append(x)
            yield record_batch(batch, ids, cols)

    return texts.mapInArrow(run, _schema(docs, "h1", "h2", "start"))


def _elsewhere(rows: DataFrame, by: list[str], *more) -> DataFrame:
    """Keys that documents of different ids have, with the smallest id."""
    got = rows.groupBy(*by).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("final"), F.max(F.col("doc_id").isNull()).alias("nameless"), *more)
    return got.where("first < final or (nameless and first is not null)").drop("final", "nameless")


def repeats(docs: DataFrame, width: int = WIDTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, body_key, spans: the words (half-open, unmerged) of each document that earlier documents' windows cover."""
    later = (F.col("doc_id") > F.col("first")) | F.col("doc_id").isNull()
    runs = keep(_runs(docs, width, min(anchor, width)), "runs")
    # both sides of a join are tables, so that Spark sees a hot key's size and splits it
    anchors = keep(_elsewhere(runs, ["anchor"], (F.min("content") != F.max("content")).alias("mixed")), "anchors")
    found = keep(runs.join(anchors, "anchor").where(F.col("mixed") | later).select("doc_id", "body_key", "start", "n", "mixed"), "anchored")
    whole = found.where("not mixed").select("doc_id", "body_key", "start", (F.col("start") + F.col("n") - 1 + width).alias("end"))
    wanted = found.where("mixed").groupBy("doc_id", "body_key").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    all_docs = numbered(docs)
    texts = all_docs.join(wanted, same_row(all_docs, wanted)).select(all_docs["doc_id"], all_docs["body_key"], "body", "runs")
    windows = keep(_windows(texts, docs, width), "windows")
    again = keep(_elsewhere(windows, ["h1", "h2"]), "repeated-windows")
    single = windows.join(again, ["h1", "h2"]).where(later)
    single = single.select("doc_id", "body_key", "start", (F.col("start") + width).alias("end"))
    return whole.unionByName(single).groupBy("doc_id", "body_key").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _joined(docs: DataFrame, width: int) -> tuple[DataFrame, str]:
    """docs, as they are, with the spans to be removed in one more column, and its name."""
    name = fresh(docs, "spans")
    spans = repeats(docs, width)
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    joined = docs.join(spans, docs["doc_id"].eqNullSafe(spans["doc_id"]) & (key == spans["body_key"]), "left")
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], spans["spans"].alias(name)), name


def _kept_words(body: bytes, spans: list[dict]) -> tuple[list[bytes], int]:
    words = body.split()
    if not spans:
        return words, len(words)
    s, e = merged(np.array([x["start"] for x in spans]), np.array([x["end"] for x in spans]))
    out, at = [], 0
    for a, b in zip(s.tolist(), e.tolist()):
        out += words[at:a]
        at = b
    return out + words[at:], len(words)


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""

    def run(batches):
        for batch in batches:
            out = []
            for body, spans in zip(batch["body"], batch["spans"].to_pylist()):
                kept, n = _kept_words(body.as_py(), spans)
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, sha = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = T.StructType([docs.schema["doc_id"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])
    rows, _ = _joined(docs.select("doc_id", "text"), width)
    return rows.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"), "spans").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """docs with the repeated words cut out of text, kept words one blank apart; untouched texts stay as they are."""
    joined, name = _joined(docs, width)

    def run(batches):
        for batch in batches:
            spans = batch[name].to_pylist()
            batch = batch.drop_columns([name])
            if any(spans):
                at = batch.schema.get_field_index("text")
                texts = [t if not s else b" ".join(_kept_words(t.encode(), s)[0]).decode() for t, s in zip(batch["text"].to_pylist(), spans)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
            yield batch

    return joined.mapInArrow(run, docs.schema)
