"""Each operator against brute force, on documents with nulls, empty and long texts, ties, repeated rows and odd columns."""

import collections
import hashlib
import random

import numpy as np
import pytest

from foliograph.llm import bpe, chat, decontam, hnsw, licenses, simhash, substring, suffix, tokencount, toxicity
from foliograph.llm.common import merged, minima

public_tokenizers = pytest.importorskip("public_tokenizers")
DOC = "doc_id long, text string, __key string, body string, __spans string"
EMPTY = "doc_id long, text string"


def texts() -> list[tuple]:
    rng = random.Random(7)
    word = lambda: rng.choice(["alpha", "Beta", "gamma,", "délta", "the", "of", "x1", "ß"])
    long = " ".join(word() for _ in range(900))
    rows = [(i, " ".join(word() for _ in range(rng.randint(1, 120)))) for i in range(30)]
    shared = " ".join(word() for _ in range(80))
    rows += [(30, long), (31, long), (32, "start " + long[:2500] + " end"), (33, shared), (34, f"before {shared} after"), (35, f"x {shared}\ny"), (36, None), (37, ""), (38, " \t\n"), (39, "one"), (33, shared), (None, shared), (40, "a" * 5000), (41, "ab " * 400)]
    return [(i, t, "k", "b", "s") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), DOC).repartition(3)


def rows(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=str)


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def plain_words(t: str) -> list[str]:
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))


def test_helpers():
    rng = np.random.default_rng(1)
    for _ in range(50):
        h, w = rng.integers(0, 6, rng.integers(0, 30)).astype(np.uint64), int(rng.integers(1, 9))
        assert minima(h, w).tolist() == [i + int(np.argmin(h[i : i + w])) for i in range(len(h) - w + 1)]
    s, e = merged(np.array([5, 0, 2, 9]), np.array([7, 2, 3, 12]))
    assert list(zip(s.tolist(), e.tolist())) == [(0, 3), (5, 7), (9, 12)]


# ---- 1

CHAT = "conv_id long, turn long, role string, text string, msg_id string"


def test_chats_read_back(spark):
    said = [(1, 0, "user", "Hi: # <b>\\n"), (1, 1, "assistant", "### assistant: </turn>\n\\b\\l"), (2, 0, None, None), (2, 1, "assistant", "é</turn>"), (2, 1, "assistant", "é</turn>"), (None, 0, "user", "lost"), (3, 0, "system", ""), (4, None, "assistant", "first"), (4, 1, "assistant", "second")]
    got = {r.conv_id: r for r in chat.read_chats(chat.format_chats(chat.linear(spark.createDataFrame(said, CHAT.replace(", msg_id string", ""))))).collect()}
    assert set(got) == {1, 2, 3, 4}
    assert [(t.role, t.text) for t in got[1].turns] == [("user", "Hi: # <b>\\n"), ("assistant", "### assistant: </turn>\n\\b\\l")]
    assert got[1].loss_text == "### assistant: </turn>\n\\b\\l" and got[2].loss_text == "é</turn>é</turn>" and got[4].loss_text == "firstsecond"
    assert [(t.role, t.text) for t in got[2].turns] == [("", ""), ("assistant", "é</turn>"), ("assistant", "é</turn>")]
    assert chat.digest(spark.createDataFrame([], CHAT.replace(", msg_id string", ""))).count() == 0


def test_reply_trees(spark):
    tree = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 1.0), (1, 3, 1, "assistant", "good", 5.0), (1, 4, 3, "user", "more", 0.0), (1, 5, 4, "assistant", "end", 0.0), (2, 1, 9, "user", "orphan is a root", 0.0), (3, 1, 2, "user", "circle", 0.0), (3, 2, 1, "user", "circle", 0.0), (3, 3, 2, "user", "tail of a circle", 0.0)]
    tree += [(4, i, i - 1 if i else None, "user", f"t{i}", 0.0) for i in range(70)]
    d = spark.createDataFrame(tree, "conv_id long, msg_id long, parent_id long, role string, text string, score double")
    best = {r.conv_id: [t.text for t in r.turns] for r in chat.read_chats(chat.format_chats(d)).collect()}
    assert best == {1: ["q", "good", "more", "end"], 2: ["orphan is a root"], 4: [f"t{i}" for i in range(70)]}
    every = rows(chat.format_chats(d, best=None), "conv_id", "leaf", "rank")
    assert every == [(1, 2, 2), (1, 5, 1), (2, 1, 1), (4, 69, 1)]


# ---- 2

def test_suffix_array_and_search():
    rng = np.random.default_rng(3)
    for n, k in ((1, 2), (40, 3), (300, 2), (500, 50)):
        s = np.append(rng.integers(1, k + 1, n), 0).astype(np.int32)
        order = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert decontam.suffix_array(s).tolist() == order
        index = decontam.FMIndex(s, sample=4)
        assert sorted(index.locate(np.arange(len(s))).tolist()) == list(range(len(s)))
        phrases = rng.integers(1, k + 1, (30, 4)).astype(np.int32)
        lo, hi = index.search(phrases, np.full(30, 3))
        for p, a, b in zip(phrases, lo, hi):
            found = sorted(index.locate(np.arange(a, b)).tolist())
            assert found == [i for i in range(n - 2) if s[i : i + 3].tolist() == p[1:].tolist()]


def test_decontamination(spark, docs, monkeypatch):
    own = texts()
    items = [(1, own[3][1]), (2, "Alpha beta"), (3, None), (4, ""), (5, own[33][1]), (None, "alpha"), (7, own[33][1]), (8, "nowhere to be found at all in any text"), (2, "Alpha beta")]
    bench = spark.createDataFrame([(i, t, "n") for i, t in items], "item_id long, text string, n_hit string")
    want = []
    for i, t, *_ in own:
        w = plain_words(t or "")
        hit, who = set(), set()
        for item, x in items:
            q = plain_words(x or "")
            for a in range(max(1, len(q) - 7)) if q and item is not None else ():
                win = q[a : a + 8]
                for b in range(len(w) - len(win) + 1):
                    if w[b : b + len(win)] == win:
                        hit.update(range(b, b + len(win)))
                        who.add(str(item))
        want.append((i, len(w), len(hit), len(who), sha(",".join(sorted(who)).encode()), len(who) >= 2))
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(decontam.contamination(docs, bench), *cols) == sorted(want, key=str)
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 50)
    monkeypatch.setattr(decontam, "SHARD", 100)
    assert rows(decontam.contamination(docs, bench), *cols) == sorted(want, key=str)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    left = decontam.contamination(kept, bench).agg({"n_hit": "max"}).first()[0]
    assert left == 0 and kept.where("doc_id = 39").count() == 1
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(spark.createDataFrame([], EMPTY), bench).count() == 0


# ---- 3

def test_trie_join_finds_all_links():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) for _ in range(20)]))
    keys = np.zeros(len(fps), dtype=np.int64)
    forest = simhash.Forest(len(fps))
    forest.link(*simhash.trie_join(keys, fps, 4))
    brute = simhash.Forest(len(fps))
    a, b = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4)
    brute.link(a, b)
    assert forest.root.tolist() == brute.root.tolist()


@pytest.mark.parametrize("hot", [512, 2])
def test_near_duplicates(spark, docs, hot):
    import xxhash

    own, fps = texts(), []
    for _, t, *_ in own:
        w = ascii_lower(t or "").split()
        sh = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)))
    group = list(range(len(own)))
    for i in range(len(own)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = collections.defaultdict(lambda: None)
    for g, (i, *_) in zip(group, own):
        if i is not None and (least[g] is None or i < least[g]):
            least[g] = i
    want = sorted([(i, f if f < 2**63 else f - 2**64, least[g]) for g, f, (i, *_) in zip(group, fps, own)], key=str)
    assert rows(simhash.near_duplicates(docs, hot=hot), "doc_id", "fp", "component_id") == want
    if hot == 512:
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {x for x in least.values() if x is not None}
        assert simhash.near_duplicates(spark.createDataFrame([], EMPTY)).count() == 0


# ---- 4

def repeated_bytes(all_texts: list[bytes], width: int):
    seen = collections.Counter(x[k : k + width] for x in all_texts for k in range(len(x) - width + 1))
    out = []
    for x in all_texts:
        gone = np.zeros(len(x), dtype=bool)
        for k in range(len(x) - width + 1):
            if seen[x[k : k + width]] > 1:
                gone[k : k + width] = True
        out.append((bytes(np.frombuffer(x, dtype=np.uint8)[~gone]), int(gone.sum()), int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(x) else 0))
    return out


@pytest.mark.parametrize("hot", [512, 3, 1])
def test_suffix_dedup(spark, docs, hot, monkeypatch):
    own = texts()
    want = [(i, len((t or "").encode()), n, m, sha(k)) for (i, t, *_), (k, n, m) in zip(own, repeated_bytes([(t or "").encode() for _, t, *_ in own], 60))]
    monkeypatch.setattr(suffix.repeats, "__defaults__", (400, 30, hot))
    assert rows(suffix.digest(docs, 60), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)
    assert suffix.digest(spark.createDataFrame([], EMPTY)).count() == 0


def test_interval_tree():
    rng = random.Random(2)
    for _ in range(60):
        n = rng.randint(2, 12)
        pairs = sorted((("".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))).encode(), ("".join(rng.choice("ab") for _ in range(rng.randint(0, 6)))).encode()) for _ in range(n))
        rights, lefts = [r for r, _ in pairs], [x for _, x in pairs]
        got = suffix.repeated_windows(lefts, rights, 5)
        for i in range(n):
            mine = {a for lo, hi in got[i] for a in range(lo, hi + 1)}
            want = {a for a in range(0, 6) for j in range(n) if j != i and a <= len(lefts[i]) and 5 - a <= len(rights[i]) and lefts[i][:a] == lefts[j][:a] and len(lefts[j]) >= a and rights[i][: 5 - a] == rights[j][: 5 - a] and len(rights[j]) >= 5 - a}
            assert mine == want


# ---- 5

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))


def brute_pieces(word: str, scores: dict, byte: float, longest: int) -> tuple[int, float]:
    t = "▁" + word
    best = [(0.0, 0)]
    for i in range(1, len(t) + 1):
        size = len(t[i - 1].encode())
        options = [(best[i - 1][0] + byte * size, best[i - 1][1] + size)]
        options += [(best[j][0] + scores[t[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if t[j:i] in scores]
        top = max(s for s, _ in options)
        best.append((top, min(n for s, n in options if s == top)))
    return best[-1][1], best[-1][0]


def test_token_counts(spark, docs):
    scores = tokencount.piece_scores(PIECES)
    byte, longest = min(scores.values()) - 1, max(map(len, scores))
    want = []
    for i, t, *_ in texts():
        got = [brute_pieces(w, scores, byte, longest) for w in (t or "").split()]
        want.append((i, len(got), sum(n for n, _ in got), round(sum(s for _, s in got), 6)))
    have = [(i, a, b, round(c, 6)) for i, a, b, c in rows(tokencount.count_tokens(docs, PIECES), "doc_id", "n_pretokens", "n_tokens", "score")]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert tokencount.count_tokens(spark.createDataFrame([], EMPTY), PIECES).count() == 0


def test_prefixes_are_shared_and_memory_is_bounded(monkeypatch):
    scores = tokencount.piece_scores(PIECES)
    trie = tokencount.Trie(scores)
    trie.count("international")
    before = trie.nodes
    trie.count("internationally")
    assert trie.nodes == before + 2
    # a long word gets no nodes, and the same numbers
    rng = random.Random(8)
    for n in (65, 70, 200, 900):
        word = "".join(rng.choice("abcdeé日x") for _ in range(n))
        before = trie.nodes
        assert trie.count(word) == pytest.approx(brute_pieces(word, scores, trie.pieces.byte, trie.pieces.longest)) and trie.nodes == before
    monkeypatch.setattr(tokencount, "NODES", 50)
    assert [trie.count(w) for w in ("alpha", "beta", "gamma") * 40][-3:] == [tokencount.Trie(scores).count(w) for w in ("alpha", "beta", "gamma")]


# ---- 6

def test_lexicon():
    x = toxicity.Lexicon({"idiot": False, "lowei": True, "scum": False})
    assert [x.kind(w) for w in ("idiot", "idiots", "idot", "idoit", "loweischaft", "lowwischaft", "scum", "scun", "moron", "")] == [2, 1, 1, 0, 2, 1, 2, 0, 0, 0]
    assert x.features("You IDIOT!")[1] == 1.0 and x.features('He said "idiot" to us')[1] == 0.0 and x.features("")[1] == 0.0


def test_toxicity_learns_held_out(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeioulmnr") for _ in range(rng.randint(3, 8))) for _ in range(400)]
    said, labels = [], []
    for i in range(1200):
        w = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            w.insert(rng.randrange(len(w)), "zorb" + rng.choice(["en", "ig", "st", "heit"]) if i % 10 else "moron")
        said.append((i, " ".join(w), "x"))
        labels.append((i, int(bad), "t"))
    said += [(5000, None, "x"), (5001, "", "x"), (None, "you moron", "x")]
    labels += [(0, None, "t"), (None, 1, "t")]
    d, y = spark.createDataFrame(said, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = toxicity.digest(d, y).collect()
    assert len(got) == len(said) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert all(r.held_out == toxicity.crc_held_out(r.doc_id) for r in got if r.doc_id is not None)
    truth = {i: t for i, t, _ in labels if i and t is not None}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    kept = toxicity.drop_toxic(d, y)
    assert kept.columns == d.columns and kept.where("doc_id = 5000").count() == 1
    bare = toxicity.digest(d, y.limit(0)).collect()
    assert {r.predicted for r in bare if r.doc_id is None} == {1}


def test_gate_and_automaton_agree():
    """What the gate lets through or not, the automaton alone would decide alike."""
    rng = random.Random(12)
    letters = "abcde"
    made = lambda lo, hi: "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi)))
    terms = {made(4, 8): rng.random() < 0.4 for _ in range(25)}
    lexicon = toxicity.Lexicon(terms)
    near = 0
    for _ in range(6000):
        w = made(4, 11)
        if rng.random() < 0.5:
            w = rng.choice(list(terms))
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]]) + made(0, 3) * rng.randint(0, 1)
        if len(w) < toxicity.SHORTEST:
            continue
        alone = 2 if lexicon.exact(w) else 1 if lexicon.misspelled(w) else 0
        near += alone == 1
        assert lexicon.kind(w) == alone, (w, terms)
    assert near > 500


def one_error(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1] <= 1


def test_automaton_against_edit_distances():
    rng = random.Random(13)
    made = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randint(lo, hi)))
    for _ in range(60):
        terms = {made(5, 7): False for _ in range(6)}
        lexicon = toxicity.Lexicon(terms)
        for _ in range(60):
            w = made(4, 8)
            assert lexicon.misspelled(w) == any(one_error(w, t) for t in terms)


def test_toxicity_of_odd_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string, score string")
    y = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.digest(d, y).count() == 0 and toxicity.drop_toxic(d, y).columns == d.columns
    long = spark.createDataFrame([(1, "fine words " * 100_000), (2, "you moron " * 50_000), (3, "ok"), (3, "ok")], EMPTY)
    got = rows(toxicity.digest(long, y), "doc_id", "predicted")
    assert got == [(1, 0), (2, 1), (3, 0), (3, 0)]


# ---- 7

EMB = "vec_id long, embedding array<float>, score string"


def brute_nearest(data, k=10, every=100):
    """query id: [(distance, id)] over the usable rows."""
    use = [(i, np.array(e, dtype=np.float32).astype(float)) for i, e, *_ in data if i is not None and e is not None and len(e) == len(data[0][1]) and all(x is not None and np.isfinite(x) for x in e) and any(e)]
    out = {}
    for q, e in use:
        if q % every == 0:
            found = sorted((float(np.sqrt(((e - x) ** 2).sum())), i) for i, x in use if i != q)
            out[q] = found[:k]
    return out


def found_nearest(df):
    got = collections.defaultdict(list)
    for r in df.collect():
        got[r.query_id].append((r.rank, r.score, r.vec_id))
    assert all([x[0] for x in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())
    return {q: [(d, i) for _, d, i in sorted(v)] for q, v in got.items()}


def vectors(n, dim=12, seed=9):
    v = np.random.default_rng(seed).normal(size=(n, dim)).astype(np.float32)
    return [(i, [float(x) for x in e], "q") for i, e in enumerate(v)]


def test_nearest(spark):
    data = vectors(700)
    data += [(1000, None, "q"), (1001, [0.0] * 12, "q"), (1002, [float("nan")] + [1.0] * 11, "q"), (1003, [None] + [1.0] * 11, "q"), (1004, [1.0, 2.0], "q"), (None, [1.0] * 12, "q"), (7, data[7][1], "q")]
    got, want = found_nearest(hnsw.nearest(spark.createDataFrame(data, EMB))), brute_nearest(data)
    assert set(got) == set(want) == {i for i in range(700) if i % 100 == 0}
    near = [set(i for _, i in want[q]) & set(i for _, i in got[q]) for q in want]
    assert sum(map(len, near)) >= 0.9 * 10 * len(want)
    assert all(abs(d - dict((i, x) for x, i in brute_nearest(data, 10**6)[q])[i]) < 1e-12 for q in got for d, i in got[q])


def test_nearest_of_none_and_few(spark):
    assert hnsw.nearest(spark.createDataFrame([], EMB)).count() == 0
    for n in (1, 2, 4, 9, 12):
        data = vectors(n)
        assert found_nearest(hnsw.nearest(spark.createDataFrame(data, EMB))) == {q: v for q, v in brute_nearest(data).items() if v}


@pytest.mark.parametrize("shards", [1, 5])
def test_nearest_among_copies(spark, shards):
    """A third of the rows one vector, one id many times, and ties: exact, as all is found."""
    data = vectors(120)
    data += [(1000 + i, data[0][1], "q") for i in range(60)] + [(100, data[100][1], "q")] * 130 + [(5, data[6][1], "q")] * 3
    d = hnsw.usable(spark.createDataFrame(data, EMB).repartition(4))
    index = hnsw.build_index(d, shard=300 // shards).cache()
    got = found_nearest(hnsw.search(index, d.where("vec_id % 100 = 0").distinct(), room=400))
    want = {q: [(round(x, 9), i) for x, i in v] for q, v in brute_nearest(data).items()}
    assert {q: [(round(x, 9), i) for x, i in v] for q, v in got.items()} == want
    got = found_nearest(hnsw.nearest(spark.createDataFrame(data, EMB)))
    assert {q: [(round(x, 9), i) for x, i in v] for q, v in got.items()} == want


def test_nearest_of_equal_vectors(spark):
    data = [(i, [1.0, 2.0, 3.0], "q") for i in range(300)]
    assert found_nearest(hnsw.nearest(spark.createDataFrame(data, EMB))) == {q: [(0.0, i) for i in range(11) if i != q][:10] for q in (0, 100, 200)}


def test_graphs_are_one_piece():
    rng = np.random.default_rng(4)
    # tight clusters far apart
    v = np.concatenate([rng.normal(size=(150, 8)) * 0.01 + 100 * rng.normal(size=8) for _ in range(6)])
    g = hnsw.Graph(v, links=4, build=8)
    seen, front = {g.entry}, [g.entry]
    while front:
        front = [j for i in front for j in g.near[0][i].tolist() if j >= 0 and j not in seen and not seen.add(j)]
    assert len(seen) == len(v)
    assert sorted(g.search(v[3], len(v))) == list(range(len(v)))
    assert hnsw.Graph.load(g.dump()).search(v[3], 10) == g.search(v[3], 10)


# ---- 8

def test_licenses(spark):
    said = [
        (1, "Licensed under CC BY-NC 4.0.", "x"), (2, "Apache License, Version 2.0. MIT License", "x"), (3, None, "x"), (4, "", "x"), (5, "nothing here", "x"), (6, "GNU General Public LICENSE version 3 or MIT  license; mit-license", "x"),
        (7, "SPDX-License-Identifier: MIT", "x"), (8, "submit licensed Kelvin K", "x"), (9, "CC\nBY cc by", "x"), (None, "All rights reserved", "x"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(said, "doc_id long, text string, labels string")).collect()}
    assert len(got) == len(said) and len(licenses.RULES) > 200
    for i, t, _ in said:
        w = plain_words(t or "")
        places, names = [], set()
        for phrase, label in licenses.BASE:
            p = phrase.split()
            at = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            places += at
            names |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(names)))
        assert names <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert "cc-by-nc-4.0" in got[1].labels.split(",") or "cc-by-nc" in got[1].labels.split(",")
    assert got[7].labels == "mit" and got[7].score == 1.0 and got[5].labels == "" and got[None].labels == "proprietary"
    # what lies inside a higher-ranking match is suppressed
    spans = [(d.start, d.end) for d in got[2].detections]
    assert "apache-2.0" in got[2].labels and len(spans) == len(set(spans))
    for d in got[1].detections:
        assert "Licensed under CC BY-NC 4.0."[d.start : d.end]


def holds_stem(seq) -> bool:
    """Whether every match of the parsed expression holds one of the stems."""
    runs, inner = [""], []
    for op, arg in seq:
        name = str(op)
        if name == "LITERAL":
            runs[-1] += chr(arg)
        elif name not in ("AT", "ASSERT_NOT"):
            runs.append("")
        if name == "SUBPATTERN":
            inner.append(holds_stem(arg[3]))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            inner.append(arg[0] > 0 and holds_stem(arg[2]))
        elif name == "BRANCH":
            inner.append(all(map(holds_stem, arg[1])))
    return any(inner) or any(stem in run for run in runs for stem in licenses.STEMS)


def made_of(seq) -> list[str]:
    """Some matches of the parsed expression: each branch once, the fewest repeats."""
    out = [""]
    for op, arg in seq:
        name = str(op)
        more = [""]
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            kind, what = arg[0]
            more = [chr(what) if str(kind) == "LITERAL" else chr(what[0]) if str(kind) == "RANGE" else "2" if "DIGIT" in str(what) else " "]
        elif name == "SUBPATTERN":
            more = made_of(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            more = [made_of(arg[2])[0] * arg[0]]
        elif name == "BRANCH":
            more = [x for b in arg[1] for x in made_of(b)]
        out = [a + b for a in out for b in more]
    return out


def brute_matches(text: str) -> list[tuple]:
    import re

    low = ascii_lower(text)
    return [(m.start(), m.end(), rank, k, label) for k, (rank, label, word, p) in enumerate(licenses.rules()) if word in low for m in re.finditer(p, low, re.ASCII)]


def brute_remaining(found: list[tuple]) -> list[tuple]:
    def holds(t, s):
        longer, s_longer = t[1] - t[0], s[1] - s[0]
        return t[0] <= s[0] and t[1] >= s[1] and (t[2] > s[2] or t[2] == s[2] and (longer > s_longer or longer == s_longer and t[3] < s[3]))

    return sorted(s for s in found if not any(holds(t, s) for t in found))


@pytest.mark.parametrize("step", [2, 512])
def test_suppression_of_contained_matches(spark, monkeypatch, step):
    from pyspark.sql import functions as F

    monkeypatch.setattr(licenses, "STEP", step)
    rng = random.Random(14)
    ranks, made = [20, 50, 60, 90], []
    for i in range(150):
        found = set()
        for k in range(rng.randint(0, 14)):
            a = rng.randint(0, 12)
            found.add((a, a + rng.randint(1, 9), rng.choice(ranks), k, f"l{k}"))
        made.append((i, sorted(found, key=lambda m: m[3])))
    d = spark.createDataFrame(made, f"i long, found {licenses.MATCH}")
    got = {r.i: sorted(map(tuple, r.kept)) for r in d.select("i", licenses._remaining(F.col("found"), ranks).alias("kept")).collect()}
    assert got == {i: brute_remaining(found) for i, found in made}


def test_licenses_against_brute_force(spark):
    rng = random.Random(15)
    pieces = ["gnu general public license", "version 3", "version 2", "or (at your option) any later version", "Apache License, Version 2.0", "mit license", "CC BY-NC-SA 4.0", "creative commons attribution-share alike", "spdx-license-identifier: mit", "all rights reserved", "copyright (c) 2019", "without warranty of any kind", "BSD 3-clause", "2-clause BSD license", "the", "words", "licensed under the terms of", "see LICENSE", "Mozilla Public License 2.0", "é", "."]
    said = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    said += [(200, None), (201, ""), (202, "x " * 150_000 + "MIT License"), (203, "cc by mit license apache license " * 1500), (204, said[0][1]), (204, said[0][1]), (None, "mit license")]
    got = licenses.scan(spark.createDataFrame(said, EMPTY).repartition(4)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in said)
    text = dict(said)
    for r in got:
        found = brute_remaining(brute_matches(text[r.doc_id] or "")) if r.doc_id != 203 else None
        if found is None:
            assert r.n_base == 4500 and len(r.detections) == 4500 and r.labels == "apache,cc-by,mit"
            continue
        assert sorted(map(tuple, r.detections or [])) == found
        base = set(r.base_labels.split(",")) - {""}
        assert set(r.labels.split(",")) - {""} == base | {m[4] for m in found}
        assert r.score == max([m[2] / 100 for m in found] + [0.6] * bool(r.n_base) + [0.0])
    assert licenses.scan(spark.createDataFrame([], EMPTY)).count() == 0


def test_every_license_rule_fires_alone(spark):
    import re

    made = []
    for rank, label, keyword, pattern in licenses.rules():
        tree = re._parser.parse(pattern)
        assert holds_stem(tree), pattern
        for text in made_of(tree):
            assert re.search(pattern, text) and keyword in text, (pattern, text)
            made.append((len(made), text, label, rank))
    for text, label in (("neither the name of x nor the names of its contributors", "bsd-3-clause"), ("see copying", "license-mention"), ("\u00a9 2019", "copyright"), ("asl-2.0", "apache"), ("CeCILL", "cecill"), ("MIT no attribution", "mit-0")):
        made.append((len(made), text, label, 20))
    got = {r.doc_id: r for r in licenses.digest(spark.createDataFrame([x[:2] for x in made], EMPTY).repartition(4)).collect()}
    missed = [x for x in made if x[2] not in got[x[0]].labels.split(",") and got[x[0]].score * 100 < x[3] - 0.001]
    assert not missed, missed


# ---- 9

def test_bpe_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    t = Tokenizer.from_file(path)
    own = texts() + [(100 + i, s, "", "", "") for i, s in enumerate(["Σίσυφος ΟΔΟΣ İstanbul ½ x² 日本語", "é é <|endoftext|>foo <|startoftext|>", "it's we'll I'M don't ''s", "a b\x85c\x1cd ​zero", "ǅ ẞ ﬁ ٣ Ⅷ _x_ __", "🙂🙃 e🙂", "नमस्ते ภาษาไทย", "\x00\x01", "K Å"])]
    got = bpe.encode(spark.createDataFrame(own, DOC), path).collect()
    want = []
    for i, s, *_ in own:
        ids = t.encode(s or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(t.decode(ids, skip_special_tokens=False).encode()), ids))
    assert sorted([(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in got], key=str) == sorted(want, key=str)


def test_segment_tree_merges_like_a_scan():
    rng = random.Random(6)
    ranks = {}
    for r in range(60):
        a, b = ("".join(rng.choice("ab") for _ in range(rng.randint(1, 3))) for _ in range(2))
        ranks.setdefault((a, b), r)
    for _ in range(300):
        s = [rng.choice("ab") for _ in range(rng.randint(1, 25))]
        plain = list(s)
        while True:
            best = min(((ranks[p], i) for i, p in enumerate(zip(plain, plain[1:])) if p in ranks), default=None)
            if best is None:
                break
            i = best[1]
            plain[i : i + 2] = [plain[i] + plain[i + 1]]
        assert bpe.merge_symbols(list(s), ranks) == plain


# ---- 10

def test_substring_dedup(spark, docs):
    own = texts()
    seen: dict[tuple, list] = {}
    split = [(i, (t or "").replace("\x0b", " ").split()) for i, t, *_ in own]
    for i, w in split:
        for k in range(len(w) - 11):
            seen.setdefault(tuple(w[k : k + 12]), []).append(i)
    rank = lambda i: float("inf") if i is None else i
    want = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - 11):
            if min(map(rank, seen[tuple(w[k : k + 12])])) < rank(i):
                gone.update(range(k, k + 12))
        want.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    assert rows(substring.digest(docs, 12), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)
    assert substring.digest(spark.createDataFrame([], EMPTY)).count() == 0
    out = substring.remove_repeats(docs, 12)
    assert out.columns == docs.columns and out.count() == len(own)
