import pytest

from foliograph.operators import graph as G
from foliograph.operators import quality as Q
from foliograph.operators import retrieval as R
from foliograph.operators import segments as SG

EDGE = "edge_id string, source_node_id string, target_node_id string, edge_type string"


@pytest.fixture
def table(spark):
    def make(*pairs, kind="parent_of"):
        return spark.createDataFrame([(f"{a}{b}", a, b, kind) for a, b in pairs], EDGE)

    return make


def nodes(spark, names):
    return spark.createDataFrame([(n, "doc_root" if n == "r" else "box_section") for n in names], "node_id string, node_type string")


def ids(df, c="node_id"):
    return sorted(r[c] for r in df.collect())


def test_cycles_and_reach(spark, table):
    assert ids(G.cycle_nodes(table(("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")))) == ["a", "b", "c"]
    assert ids(G.cycle_nodes(table(("a", "b"), ("b", "c")))) == [] and ids(G.cycle_nodes(table(("a", "a")))) == ["a"]
    assert {r.node_id: r.steps for r in G.reachable(table(("r", "a"), ("a", "b"), ("x", "y")), spark.createDataFrame([("r",)], "node_id string")).collect()} == {"r": 0, "a": 1, "b": 2}


def test_components(spark, table):
    got = G.connected_components(nodes(spark, "abcdefz"), table(("a", "b"), ("c", "b"), ("e", "f"), ("z", "z")))
    assert {r.node_id: r.component for r in got.collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e", "f": "e", "z": "z"}
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(120)]
    long = G.connected_components(nodes(spark, sorted({x for p in chain for x in p})), table(*chain))
    assert {r.component for r in long.collect()} == {"n000"}


def test_gates(spark, table):
    v, e = nodes(spark, "rab"), table(("r", "a"), ("r", "b"))
    assert all(x.passed for x in Q.report([Q.id_integrity(v, "node_id"), Q.endpoints(v, e), Q.structural_dag(e), Q.reachability(v, e)]).collect())
    assert not Q.id_integrity(v.unionByName(v), "node_id").first().passed
    assert not Q.endpoints(v, table(("r", "q"))).first().passed
    assert not Q.structural_dag(table(("r", "a"), ("a", "r"))).first().passed
    assert not Q.structural_dag(table(("r", "a"), kind="follows")).first().passed
    assert Q.structural_dag(e.unionByName(table(("a", "b"), ("b", "a"), kind="references_box"))).first().passed
    assert not Q.reachability(nodes(spark, "abc"), e).first().passed


def test_corpus_gates(spark):
    lines = spark.createDataFrame([(f"Box {k}. Amount", 1) for k in [f"{n}{c}" for n in range(1, 10) for c in "ab"]], "line_text string, page int")
    assert Q.box_discovery(lines).first().passed and Q.box_discovery(lines.limit(0)).first().passed
    assert not Q.box_discovery(lines.limit(2)).first().passed
    again = spark.createDataFrame([("Page footer", 1), ("Page footer", 2)], "line_text string, page int")
    assert not Q.artifact_contamination(again, spark.createDataFrame([("page footer",)], "text string")).first().passed


def test_as_of_and_intervals(spark):
    e = spark.createDataFrame([("d", 1), ("d", 5), ("d", 9), ("x", 1)], "doc_id string, pos int")
    a = spark.createDataFrame([("d", 2, "A"), ("d", 9, "B")], "doc_id string, pos int, anchor_id string")
    assert sorted((r.doc_id, r.pos, r.anchor_id) for r in SG.assign_as_of(e, a, ["doc_id"], "pos").collect()) == [("d", 1, "preamble"), ("d", 5, "A"), ("d", 9, "B"), ("x", 1, "preamble")]
    i = spark.createDataFrame([("d", 0, 200, "w"), ("d", 5, 5, "p")], "doc_id string, start int, end int, name string")
    assert sorted((r.pos, r.name) for r in SG.interval_join(e, i, ["doc_id"], "pos").collect()) == [(1, "w"), (5, "p"), (5, "w"), (9, "w")]


def test_measures(spark):
    got = R.ranking_measures(spark.createDataFrame([(1, 7, 2), (1, 8, 3)], "query_id int, item int, rank int"), spark.createDataFrame([(1, 7), (1, 9), (2, 5)], "query_id int, item int"))
    assert {r.query_id: (r.recall, r.rr) for r in got.collect()} == {1: (0.5, 0.5), 2: (0.0, 0.0)}
    text = "# Form 1099-DIV Ontology\n## 3. Distributions\n### Rule: Ordinary First\n* **Ordinary Dividends** (Box 1a)\n* **Box 1a** —(includes)—> **Box 1b**\n* Box 2a —(excludes)—> Box 3\ntext"
    assert R.parse_ontology(text) == (["Distributions", "Ordinary First", "Ordinary Dividends"], [("Box 1a", "includes", "Box 1b"), ("Box 2a", "excludes", "Box 3")])
    assert R.ontology_form(text) == "1099-DIV"


def test_long_chains_are_no_cycles(spark):
    n = 2500
    link = spark.range(n).selectExpr("cast(id as string) as source_node_id", "cast(id + 1 as string) as target_node_id")
    assert G.cycle_nodes(link).count() == 0
    ring = spark.createDataFrame([("2500", "x"), ("x", "y"), ("y", "x"), ("y", "z"), ("z", "u"), ("u", "v"), ("v", "u"), ("v", "w")], "source_node_id string, target_node_id string")
    assert ids(G.cycle_nodes(link.unionByName(ring))) == ["u", "v", "x", "y", "z"]
    p = link.selectExpr("source_node_id as higher", "target_node_id as lower", "true as active", "true as revived")
    order = G.precedence_order(spark.range(n + 1).selectExpr("cast(id as string) as rule"), p)
    assert order.count() == n + 1 and order.where("level <> int(rule) or level is null").count() == 0


def test_cycles_and_levels_against_brute_force(spark):
    import random

    rng = random.Random(3)
    for size, many in ((8, 9), (12, 14), (12, 24)):
        e = sorted({(str(rng.randrange(size)), str(rng.randrange(size))) for _ in range(many)})
        left = set(e)
        while True:
            kept = {(a, b) for a, b in left if a in {y for _, y in left} and b in {x for x, _ in left}}
            if kept == left:
                break
            left = kept
        d = spark.createDataFrame(e, "source_node_id string, target_node_id string")
        assert ids(G.cycle_nodes(d)) == sorted({x for pair in left for x in pair})
        level, todo, k = {}, {str(i) for i in range(size)}, 0
        while free := {x for x in todo if not any(b == x and a in todo for a, b in e)}:
            level |= dict.fromkeys(free, k)
            todo, k = todo - free, k + 1
        p = d.selectExpr("source_node_id as higher", "target_node_id as lower", "true as active", "false as revived")
        got = G.precedence_order(spark.range(size).selectExpr("cast(id as string) as rule"), p).collect()
        assert {r.rule: r.level for r in got} == {str(i): level.get(str(i)) for i in range(size)}
