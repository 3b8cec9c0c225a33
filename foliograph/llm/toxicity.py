"""Operator 6, toxicity by Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is a trie of terms and stems: a short list of common insults, and the word beginnings that set the
labelled toxic documents apart. A word matches a term exactly, as an inflection of a stem, or misspelled: the word's
Levenshtein automaton (one row of edit distances for each trie node, pruned when every entry passes the allowance)
walks the trie. A word enters the walk only if it and a term become equal by leaving out one letter or none, which an
allowance of one error implies. Every match looks at its context window: quotation marks around it, or a word of
reporting before it, make it a quotation. The counts of each kind, by themselves and for the document's length, are
the features of a logistic regression.

The classifier is fitted on at most `sample` labelled rows (the smallest hashes of doc_id among those that are not
held out), of which near copies count once (rows that share the smallest of their three-word shingles' hashes, for three
hash functions in turn); the lexicon on word beginnings that Spark counts over the same rows. At most `terms` of those
reach the driver. Scoring reads every whole text. Labels, lang, source and doc_id are no inputs of a score.

Defined results. Null or empty text: no match, the score of such documents. No labels or only one class: the built-in
list alone, with fixed weights. Null labels are ignored, conflicting ones count each; a null doc_id is scored and not
held out. Repeated rows are scored row by row. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliograph.llm.common import fresh, id_and_text, keep, release

THRESHOLD, SAMPLE, TERMS, KNOWN = 0.3, 20_000, 2000, 300_000
SHORTEST, LONGEST, WINDOW = 4, 14, 6
INSULTS = """
    idiot moron clown loser scum trash pathetic worthless disgusting stupid imbecile cretin dumbass bastard
    asshole bitch fucker scumbag dimwit halfwit degenerate vermin parasite filth garbage subhuman
""".split()
REPORTING = frozenset("said says say quote quoted quotes wrote writes called term word phrase reported cited example".split())
QUOTES = "\"'`«»“”„‘’"
TOKEN = re.compile(r"[^\W_]+")


class Node:
    __slots__ = ("next", "term", "stem")

    def __init__(self):
        self.next, self.term, self.stem = {}, None, False


def less_one(word: str) -> set[str]:
    """The word, and the word without each of its letters."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class Lexicon:
    """A trie of terms; a stem also matches what goes on after it."""

    def __init__(self, terms: dict[str, bool]):
        self.root, self.terms = Node(), terms
        self.deletes: set[str] = set()
        self.stem_deletes: dict[int, set[str]] = {}
        self.heads: dict[int, set[str]] = {2: set(), 3: set()}
        self.middles: dict[int, set[str]] = {2: set(), 3: set()}
        for term, stem in terms.items():
            node = self.root
            for c in term:
                node = node.next.setdefault(c, Node())
            node.term, node.stem = term, stem or node.stem
            if len(term) > SHORTEST:
                self.deletes |= less_one(term)
                n = 2 if len(term) == SHORTEST + 1 else 3
                self.heads[n].add(term[:n])
                self.middles[n].add(term[n : n + 3])
                if stem:
                    self.stem_deletes.setdefault(len(term), set()).update(less_one(term))
        self.known: dict[str, int] = {}

    def exact(self, word: str) -> bool:
        node = self.root
        for c in word:
            node = node.next.get(c)
            if node is None:
                return False
            if node.stem:
                return True
        return node.term is not None

    def _near(self, word: str) -> bool:
        """Whether one error can lie between a term and the word, or its beginning for a stem.

        An error behind a term's first letters leaves those as they are; one among them leaves the next three where they
        were or a place off. Then, both must become equal by leaving out one letter or none.
        """
        for n in (2, 3):
            middles = self.middles[n]
            if word[:n] in self.heads[n] or word[n - 1 : n + 2] in middles or word[n : n + 3] in middles or word[n + 1 : n + 4] in middles:
                break
        else:
            return False
        if not self.deletes.isdisjoint(less_one(word)):
            return True
        return any(not found.isdisjoint(less_one(word[:n])) for size, found in self.stem_deletes.items() for n in (size - 1, size, size + 1))

    def misspelled(self, word: str) -> bool:
        """Levenshtein automaton of the word over the trie, with one error for terms of more than SHORTEST letters."""
        n = len(word)
        stack = [(self.root, tuple(range(n + 1)))]
        while stack:
            node, row = stack.pop()
            for c, child in node.next.items():
                new, best = [row[0] + 1], row[0] + 1
                for i in range(1, n + 1):
                    d = min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (word[i - 1] != c))
                    new.append(d)
                    best = d if d < best else best
                if best > 1:
                    continue
                if child.term and len(child.term) > SHORTEST and (new[n] <= 1 or child.stem and best <= 1 and min(new[max(0, len(child.term) - 1) :] or [2]) <= 1):
                    return True
                stack.append((child, tuple(new)))
        return False

    def kind(self, word: str) -> int:
        """2 exact or inflected, 1 misspelled, 0 neither."""
        k = self.known.get(word)
        if k is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            k = 2 if self.exact(word) else 1 if len(word) >= SHORTEST and self._near(word) and self.misspelled(word) else 0
            self.known[word] = k
        return k

    def features(self, text: str) -> list[float]:
        """Abusive and quoted matches, exact and misspelled, absolute and for the length."""
        text = text.lower()
        words = TOKEN.findall(text)
        known = self.known.get
        hits: list[tuple[str, int]] = []
        for w in set(words):
            k = known(w)
            if k is None:
                k = self.kind(w)
            if k:
                hits.append((w, k))
        counts = [0, 0, 0, 0]
        if hits:
            kinds = dict(hits)
            places = list(TOKEN.finditer(text)) if kinds else []
            for i, w in enumerate(words):
                k = kinds.get(w)
                if k:
                    counts[2 * (k == 1) + self._quoted(text, words, places, i)] += 1
        abuse, quoted, near, near_quoted = counts
        size = np.log1p(len(words))
        return [1.0, float(abuse > 0), np.log1p(abuse), np.log1p(quoted), np.log1p(near), np.log1p(near_quoted), (np.log1p(abuse) + np.log1p(near)) * 4 / (4 + size), size / 10]

    @staticmethod
    def _quoted(text: str, words, places, i: int) -> bool:
        if REPORTING.intersection(words[max(0, i - WINDOW) : i]):
            return True
        a = places[max(0, i - WINDOW)].start()
        b = places[min(len(places) - 1, i + WINDOW)].end()
        left, right = text[a : places[i].start()], text[places[i].end() : b]
        opened = any(left.count(q) % 2 if q in "\"`" else q in left for q in "\"`«“„")
        return opened and any(q in right for q in "\"`»”“")


WIDTH = 8
BUILT_IN = np.array([-3.0, 3.0, 1.0, 0.2, 0.3, 0.0, 0.5, 0.0])


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    few = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    few = few.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    # at most `sample` rows of two numbers
    rows = id_and_text(docs).join(F.broadcast(few), "doc_id").select("body", "toxic")

    def sign(batches):
        for batch in batches:
            marks = np.array([_marks(b.as_py()) for b in batch["body"]], dtype=np.uint64).reshape(-1, 3).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["body"], batch["toxic"], *(pa.array(m) for m in marks.T)], names=["body", "toxic", "m0", "m1", "m2"])

    rows = rows.mapInArrow(sign, "body binary, toxic int, m0 long, m1 long, m2 long")
    rows = rows.withColumn("key", F.xxhash64("body"))
    for mark in ("m0", "m1", "m2"):
        # of rows that share a mark, the one with the smallest hash stays
        rows = rows.groupBy("toxic", mark).agg(F.min(F.struct("key", "body", *({"m0", "m1", "m2"} - {mark}))).alias("x")).select("toxic", mark, "x.*")
    return rows.select("body", "toxic")


def _marks(body: bytes) -> tuple[int, int, int]:
    """The smallest hash of the text's three-word shingles under three functions."""
    words = body.lower().split()
    shingles = {b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    return tuple(min(xxhash.xxh3_64_intdigest(s, seed) for s in shingles) for seed in (1, 2, 3))


def _beginnings(rows: DataFrame) -> DataFrame:
    """start, toxic, clean: how many documents of either label have a word that begins so (whole words end in $)."""

    def run(batches):
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for body, y in zip(batch["body"], batch["toxic"].to_pylist()):
                seen = set()
                for w in set(TOKEN.findall(body.as_py().decode(errors="replace").lower())):
                    if len(w) >= SHORTEST and not w.isdigit():
                        seen.update(w[:n] for n in range(SHORTEST, min(len(w), LONGEST) + 1))
                        if len(w) <= LONGEST:
                            seen.add(w + "$")
                for s in seen:
                    counts.setdefault(s, [0, 0])[y == 0] += 1
            if len(counts) > 500_000:
                yield _counted(counts)
                counts = {}
        if counts:
            yield _counted(counts)

    schema = "start string, toxic long, clean long"
    return rows.mapInArrow(run, schema).groupBy("start").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _counted(counts: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())], names=["start", "toxic", "clean"])


def learn_terms(rows: DataFrame, terms: int = TERMS) -> dict[str, bool]:
    """Word beginnings that documents labelled toxic have and others hardly ever; the shortest of each chain."""
    total = rows.groupBy().agg(F.sum(F.when(F.col("toxic") != 0, 1).otherwise(0)), F.sum(F.when(F.col("toxic") == 0, 1).otherwise(0))).first()
    bad, good = total[0] or 0, total[1] or 0
    if bad < 20 or good < 20:
        return {}
    least = max(8, round(0.01 * bad))
    lift = (F.col("toxic") / bad) / ((F.col("clean") + 0.5) / good)
    found = _beginnings(rows).where((F.col("toxic") >= least) & (lift >= 25))
    out: dict[str, bool] = {}
    rows_ = found.withColumn("lift", lift).orderBy(F.desc("toxic"), F.length("start"), "start").limit(terms).collect()
    stats = {r.start: (r.toxic, r.clean) for r in rows_}
    for start in sorted(stats, key=lambda s: (len(s), s)):
        word = start.rstrip("$")
        if start.endswith("$"):
            # the whole word accounts for its beginning: a term, not a stem
            if stats.get(word, (0, 0))[0] <= 1.1 * stats[start][0]:
                if not any(word[:n] in out and out[word[:n]] for n in range(SHORTEST, len(word))):
                    out[word] = False
        elif any(word[:n] in out for n in range(SHORTEST, len(word))):
            continue
        elif word + "$" in stats and stats[word][0] <= 1.1 * stats[word + "$"][0]:
            continue
        elif any(s.startswith(word) and len(s) == len(word) + 1 and s[-1] != "$" and stats[s][0] >= 0.95 * stats[word][0] for s in stats):
            continue  # a longer beginning says as much
        else:
            out[word] = True
    return out


#: Features that speak for toxicity; they never count against it.
FOR = (1, 2, 4, 6)


def fit(features: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; a feature of FOR that comes out negative is left out and the rest fitted anew."""
    use = list(range(features.shape[1]))
    while True:
        x, w = features[:, use], np.zeros(len(use))
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            s = p * (1 - p) + 1e-6
            step = np.linalg.solve(x.T @ (x * s[:, None]) + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        bad = [k for k, v in zip(use, w) if k in FOR and v < 0]
        if not bad:
            out = np.zeros(features.shape[1])
            out[use] = w
            return out
        use = [k for k in use if k not in bad]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[dict[str, bool], np.ndarray]:
    """The lexicon and the weights of the features."""
    rows = keep(_sample(docs, labels, sample), "labelled")
    terms = {t: False for t in INSULTS} | learn_terms(rows)
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        lexicon = Lexicon(shared.value)
        for batch in batches:
            x = np.array([lexicon.features(b.as_py().decode(errors="replace")) for b in batch["body"]], dtype=float).reshape(-1, WIDTH)
            yield pa.RecordBatch.from_arrays([batch["toxic"], *(pa.array(c) for c in x.T)], names=["toxic", *(f"f{i}" for i in range(WIDTH))])

    schema = "toxic int, " + ", ".join(f"f{i} double" for i in range(WIDTH))
    # equal rows are one with a count: what reaches the driver has at most `sample` rows of numbers
    got = np.array([tuple(r) for r in rows.select("body", "toxic").mapInArrow(run, schema).collect()], dtype=float).reshape(-1, WIDTH + 1)
    y = (got[:, 0] != 0).astype(float)
    if not len(y) or y.min() == y.max():
        return terms, BUILT_IN
    return terms, fit(got[:, 1:], y)


def score(docs: DataFrame, terms: dict[str, bool], weights: np.ndarray, threshold: float = THRESHOLD, keep_columns: list[str] | None = None) -> DataFrame:
    """doc_id (or keep_columns), then the score and the prediction."""
    shared = docs.sparkSession.sparkContext.broadcast((terms, weights))
    names = keep_columns or ["doc_id"]
    added = [fresh(docs, "__score"), fresh(docs, "__predicted")]

    def run(batches):
        terms, w = shared.value
        lexicon = Lexicon(terms)
        for batch in batches:
            x = np.array([lexicon.features(t.as_py() or "") for t in batch["text"]], dtype=float).reshape(-1, WIDTH)
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*names, *added])
        release()

    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(added[0], T.DoubleType()), T.StructField(added[1], T.IntegerType())])
    rows = docs.select(*names) if "text" in names else docs.select(*names, "text")
    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    terms, weights = train(docs, labels)
    rows = score(docs, terms, weights)
    p, predicted = rows.columns[-2:]
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(p).alias("score"), F.col(predicted).alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those predicted toxic."""
    terms, weights = train(docs, labels)
    rows = score(docs, terms, weights, keep_columns=docs.columns)
    return rows.where(F.col(rows.columns[-1]) == 0).drop(*rows.columns[-2:])


def crc_held_out(doc_id: int) -> bool:
    """held_out() for tests."""
    return zlib.crc32(str(doc_id).encode()) % 4 == 2
