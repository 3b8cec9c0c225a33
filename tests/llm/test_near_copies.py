"""The pipeline's near-copy stage against brute force: groups tied by fingerprints of operator 3 or by Jaccard similarity."""

import random

import numpy as np
import pytest

from foliograph.llm import simhash

EMPTY = "doc_id long, text string"


def true_groups(texts: dict[int, str], similarity: float = 0.8) -> dict[int, int]:
    sets = {i: np.unique(simhash.shingles(t.encode())) for i, t in texts.items()}
    fps = {i: simhash.fingerprint(t.encode()) for i, t in texts.items()}
    ids, root = sorted(texts), {i: i for i in texts}
    for i in ids:
        for j in ids:
            if j < i and root[i] != root[j] and ((fps[i] ^ fps[j]).bit_count() <= 4 or simhash.jaccard(sets[i], sets[j]) >= similarity):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


def varied(rng: random.Random, edits: list[int], words: int = 200) -> dict[int, str]:
    """For each number of edits, a text and a copy with so many words changed."""
    made = {}
    for i, n in enumerate(edits):
        w = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words)]
        made[2 * i] = " ".join(w)
        for k in rng.sample(range(words), n):
            w[k] = f"x{rng.randrange(10**6)}"
        made[2 * i + 1] = " ".join(w)
    return made


def test_copies_of_every_distance(spark):
    made = varied(random.Random(11), [n % 9 for n in range(120)])
    want = true_groups(made)
    found = simhash.components(simhash.similar_links(spark.createDataFrame(list(made.items()), EMPTY).repartition(4))).collect()
    got = {i: i for i in made} | {r.node: r.root for r in found}
    pairs = [(i, i + 1) for i in made if i % 2 == 0 and want[i + 1] == i]
    assert len(pairs) > 50 and sum(got[b] == a for a, b in pairs) >= 0.97 * len(pairs)
    # what is not similar enough stays apart, but for what was sure by its sketch
    others = [(i, i + 1) for i in made if i % 2 == 0 and want[i + 1] != i]
    assert len(others) > 30 and sum(got[b] == a for a, b in others) <= 0.05 * len(others)


def test_one_of_a_group_stays(spark):
    made = varied(random.Random(3), [0, 1, 2, 90, 100])
    d = [(i, t, "x") for i, t in made.items()]
    d += [(900, None, "x"), (901, "", "x"), (902, made[0], "x"), (None, made[0], "x"), (None, made[0], "x"), (0, made[0], "x")]
    frame = spark.createDataFrame(d, "doc_id long, text string, node string")
    kept = simhash.keep_one_similar(frame)
    assert kept.columns == frame.columns
    want = {i for i, r in true_groups(made).items() if i == r}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*want, 900, None], key=str)
    assert simhash.keep_one_similar(spark.createDataFrame([], EMPTY)).count() == 0


@pytest.mark.parametrize("crowd", [1, 3, 4096])
def test_crowded_keys(spark, crowd):
    rng = random.Random(5)
    groups = []
    for _ in range(2):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        for _ in range(20):
            copy = list(base)
            copy[rng.randrange(300)] = f"w{rng.randrange(10**6)}"
            groups.append(" ".join(copy))
    assert len({tuple(simhash.sketch(t.encode()).tolist()) for t in groups}) > 30
    assert true_groups(dict(enumerate(groups))) == {i: 0 if i < 20 else 20 for i in range(40)}
    docs = spark.createDataFrame(list(enumerate(groups)), EMPTY)
    found = [(r.node, r.root) for r in simhash.components(simhash.similar_links(docs, crowd=crowd)).collect()]
    assert sorted(found) == [(i, 0 if i < 20 else 20) for i in range(40) if i % 20]


def test_pairs_of_intervals():
    rng = np.random.default_rng(1)
    a, c = rng.integers(0, 50, 30), rng.integers(50, 90, 30)
    b, d = a + rng.integers(1, 9, 30), c + rng.integers(1, 9, 30)
    want = sorted((x, y) for i in range(30) for x in range(a[i], b[i]) for y in range(c[i], d[i]))
    for room in (1, 7, 100, 10**6):
        got = sorted((x, y) for p, q in simhash.cross(a, b, c, d, room) for x, y in zip(p.tolist(), q.tolist()))
        assert got == want


def test_runs_of_equal_first_words_are_joined_whole():
    fps = np.zeros(6, dtype=np.uint64)
    other = np.array([0, 9, 9, 0, 5, 5])
    x, y = simhash.trie_join(np.zeros(6, dtype=np.int64), fps, 4, lambda x, y, _: other[x] == other[y])
    forest = simhash.Forest(6)
    forest.link(x, y)
    assert [forest.root[0] == forest.root[3], forest.root[1] == forest.root[2], forest.root[4] == forest.root[5], len(set(forest.root.tolist()))] == [True, True, True, 3]


def groups_of(links, ids):
    forest = {i: i for i in ids} | {r.node: r.root for r in simhash.components(links).collect()}
    return [forest[i] for i in sorted(ids)]


@pytest.mark.parametrize("common", [256, 2])
def test_no_pair_at_the_threshold_is_left_out(spark, common):
    rng, made = random.Random(8), {}
    # pairs of 0.80 and a little more, next to pairs of a little less
    for i, n in enumerate([4, 4, 5] * 120):
        made |= {2 * i + k: t for k, t in varied(rng, [n]).items()}
    # a crowd of copies of one text, at all distances from each other
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    for i in range(40):
        copy = list(base)
        for k in rng.sample(range(120), i % 5):
            copy[k] = f"w{rng.randrange(10**6)}"
        made[1000 + i] = " ".join(copy)
    sets = {i: np.unique(simhash.shingles(t.encode())) for i, t in made.items()}
    forest, ids = simhash.Forest(len(made)), sorted(made)
    near = [(x, y) for x, a in enumerate(ids) for y, b in enumerate(ids[:x]) if a // 1000 == b // 1000 and (a >= 1000 or a // 2 == b // 2) and simhash.jaccard(sets[a], sets[b]) >= 0.8]
    forest.link(*np.array(near).T)
    assert 200 < sum(ids[x] < 1000 for x, _ in near) < 360
    docs = spark.createDataFrame(list(made.items()), EMPTY).repartition(4)
    links = simhash.similar_links(docs, common=common) if common < 256 else simhash.similar_links(docs)
    assert groups_of(links, ids) == [ids[k] for k in forest.root]


def test_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(50)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    for few in (1, 10, 100):
        got = simhash.overlaps(sets, few)
        assert all(got[x, y] == want[x][y] for x in range(50) for y in range(50) if x != y)


def crowd_of(rng: random.Random, many: int, edits: int = 5, words: int = 120) -> dict[int, str]:
    """Copies of one text, each with fewer than so many words changed."""
    base, made = [f"w{rng.randrange(10**6)}" for _ in range(words)], {}
    for i in range(many):
        copy = list(base)
        for k in rng.sample(range(words), i % edits):
            copy[k] = f"w{rng.randrange(10**6)}"
        made[i] = " ".join(copy)
    return made


def similar_groups(made: dict[int, str]) -> list[int]:
    sets = {i: np.unique(simhash.shingles(t.encode())) for i, t in made.items()}
    forest, ids = simhash.Forest(len(made)), sorted(made)
    near = [(x, y) for x, a in enumerate(ids) for y, b in enumerate(ids[:x]) if simhash.jaccard(sets[a], sets[b]) >= 0.8]
    forest.link(*np.array(near).T)
    return [ids[k] for k in forest.root]


def test_links_of_a_crowd_do_not_grow_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SURE", 1000)  # no link by sketches
    monkeypatch.setattr(simhash, "SIDE", 4)
    made = crowd_of(random.Random(21), 160)
    links = simhash.similar_links(spark.createDataFrame(list(made.items()), EMPTY).repartition(4), common=4)
    want = similar_groups(made)
    assert max(want.count(r) for r in set(want)) > 100
    assert links.distinct().count() < 2 * len(made)
    assert groups_of(links, made) == want


def test_the_smallest_of_a_cluster_is_tied(spark):
    sets = {k: np.append(np.arange(10), np.arange(10, 9 + k)).astype(np.uint64) for k in (1, 2, 3)}
    held = spark.createDataFrame([(k, h.tobytes()) for k, h in sets.items()], "node long, shingles binary")
    postings = spark.createDataFrame([(100, k, k) for k in sets], "token long, node long, root long")
    assert groups_of(simhash._counted(postings, held, 0.8), sets) == [1, 1, 1]


def test_a_passage_in_common_makes_no_crowd(spark):
    rng, made = random.Random(23), crowd_of(random.Random(24), 12, 3)
    passage = [f"p{k}" for k in range(60)]
    made |= {100 + i: " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(60)]) for i in range(30)}
    sets = {i: np.unique(simhash.shingles(t.encode())) for i, t in made.items()}
    rows = spark.createDataFrame([(i, len(h), h.tobytes()) for i, h in sets.items()], "node long, n long, low binary")
    tokens = {}
    for r in simhash._postings(rows, 0.8, whole=True).collect():
        tokens.setdefault(r.node, set()).add(r.token)
    near = [(a, b) for a in sets for b in sets if a < b and simhash.jaccard(sets[a], sets[b]) >= 0.8]
    assert len(near) > 20 and all(tokens[a] & tokens[b] for a, b in near)
    assert max(tokens) < 100


def test_cells_hold_all_pairs_of_different_roots_and_few_others(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SIDE", 5)
    rng = random.Random(25)
    # nodes of a large root, of small ones, and of a cluster apart
    root = {i: 1 if i < 200 else i - i % 2 for i in range(1, 230)}
    of = {i: 1000 + (i >= 220) for i in root}
    rows = [(of[i], i, root[i]) for i in root] + [(2000 + rng.randrange(3), i, root[i]) for i in range(1, 220)]
    cells = {}
    for r in simhash._cells(spark.createDataFrame(rows, "token long, node long, root long")).collect():
        cells.setdefault(r.cell, set()).add(r.node)
    met = {(a, b) for c in cells.values() for a in c for b in c}
    assert all(((a, b) in met) or root[a] == root[b] or (a < 220) != (b < 220) for a in root for b in root)
    # 40 blocks and more of the large root do not meet each other
    assert len(cells) < 40 * 40 / 4
