import pytest

from foliograph.operators import claims as C
from foliograph.operators import quality as Q

SCHEMA = "claim_id string, precedence_scope_id string, topic_key string, topic_key_source string, predicate string, source_element_id string, sentence_idx int, char_start int, char_end int, evidence_text string, subject_canonical_id string, object_canonical_id string"
EDGE = "from_claim_id string, to_claim_id string, relation string, scope_struct_node_id string, sentence_distance int, topic_key string"


def claim(i, sentence=0, text="rule", element="el1", predicate="defines", scope="s"):
    return (i, scope, "t", "fallback_scope", predicate, element, sentence, 0, 4, text, None, None)


@pytest.fixture
def make(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def edges(df):
    return sorted((r.from_claim_id, r.to_claim_id, r.relation, r.sentence_distance) for r in df.collect())


def test_precedence(make):
    assert edges(C.claim_precedence(make(claim("c1", element="el2"), claim("c2", element="el1")))) == [("c2", "c1", "precedes", 1)]
    assert edges(C.claim_precedence(make(claim("c1"), claim("c2", 1, "Exception: other")))) == [("c1", "c2", "precedes", 1), ("c2", "c1", "exception_of", 1)]
    far = make(claim("a", 0, predicate="excludes"), claim("m", 1, predicate="excludes", element="el1"), claim("z", 5, predicate="excludes"))
    assert ("a", "m", "precedes", 1) in edges(C.claim_precedence(far))
    assert edges(C.claim_precedence(make(claim("only")))) == []


def statuses(make, spark, rows, links=None):
    c = make(*rows)
    p = C.claim_precedence(c) if links is None else spark.createDataFrame(links, EDGE)
    r, g = C.resolve(c, p)
    return {x.claim_id: (x.status, x.rank, x.suppressed_by) for x in r.collect()}, [(x.group_status, x.error_code) for x in g.collect()]


def test_chain_and_exception(make, spark):
    got, groups = statuses(make, spark, [claim("a", 0), claim("b", 1), claim("c", 2)])
    assert {k: v[0] for k, v in got.items()} == {"a": "applies", "b": "suppressed", "c": "suppressed"} and groups == [("RESOLVED", None)]
    assert got["c"] == ("suppressed", 3, "b")
    got, _ = statuses(make, spark, [claim("a", 0), claim("b", 1, "however not this")])
    assert got["a"][0] == "suppressed" and got["a"][2] == "b" and got["b"][0] == "exception"


def test_errors(make, spark):
    two = [claim("a", 0), claim("b", 1)]
    cycle = [("a", "b", "precedes", "s", 1, "defines|scope:s"), ("b", "a", "precedes", "s", 1, "defines|scope:s")]
    got, groups = statuses(make, spark, two, cycle)
    assert groups == [("ERROR_GRAPH", "invalid_chain")] and {v[0] for v in got.values()} == {"undecidable"}
    got, groups = statuses(make, spark, two, [("a", "zz", "precedes", "s", 1, "defines|scope:s")])
    assert groups == [("ERROR_GRAPH", "cross_group_edge")]
    got, groups = statuses(make, spark, two, [("a", "b", "precedes", "s", 9, "defines|scope:s")])
    assert groups == [("ERROR_GRAPH", "distance_limit")]
    got, groups = statuses(make, spark, two, [("a", "b", "precedes", "s", None, "defines|scope:s")])
    assert groups == [("ERROR_GRAPH", "missing_distance")]
    assert statuses(make, spark, two, []) == ({}, [("SKIP_NO_EDGES", "missing_precedes")])
    assert statuses(make, spark, [claim("a")], [])[0]["a"][0] == "applies"


def test_directives_and_gates(make, spark):
    c = make(claim("a", 0), claim("b", 1), claim("c", 2, "except that it is so"))
    r, _ = C.resolve(c, C.claim_precedence(c))
    d, k = C.compile_directives(r)
    rows = d.collect()
    assert all(x.directive_id.startswith("dir_") for x in rows) and {x.supporting_claim_ids[0] for x in rows} == {"a", "c"}
    assert all(x.passed for x in Q.report([Q.directive_join(d, k, r), Q.rank_integrity(r), Q.competition(c)]).collect())
    assert Q.table_hash(r).first() == Q.table_hash(r.repartition(3)).first()


def test_null_topic_parts(make):
    got = C.topic_keys(make(claim("a"))).first()
    assert got.topic_key == "defines|scope:s" and got.topic_key_source == "fallback_scope" and got.topic_key_parts == ["defines", "", ""]


def odd_claims(spark, n=600):
    import random

    r = random.Random(5)
    pick = lambda *xs: r.choice(xs)
    rows = [
        (f"c{i}", pick(None, *[f"s{k}" for k in range(40)]), pick(None, *"tuv"), pick("canonical_ids", "fallback_scope"), pick(None, "defines", "excludes", "requires"), pick(None, "a", "b"), pick(None, 0, 1, 9), pick(None, 0, 5), 8, pick(None, "rule", "However so"), None, "o")
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("limits", [None, {"defines": 0, "excludes": 0}])
def test_own_order_resolves_like_its_edges(spark, limits):
    c = odd_claims(spark)
    general, own = C.resolve(c, C.claim_precedence(c, limits), limits), C.resolve_in_order(c, limits)
    assert all(rows_of(a) == rows_of(b) for a, b in zip(general, own))
    if limits:
        assert {"RESOLVED", "SKIP_SINGLETON", "SKIP_NO_EDGES", "ERROR_GRAPH"} == {g.group_status for g in own[1].collect()}


def test_own_order_moves_claims_once_and_writes_nothing(spark):
    import os

    folder = spark.conf.get("spark.checkpoint.dir")
    count = lambda: sum(len(files) for _, _, files in os.walk(folder))
    before = count()
    c = odd_claims(spark)
    r, g = C.resolve_in_order(c)
    for d in (r, g, C.status_counts(r), C.compile_directives(r)[1]):
        assert d._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert count() == before


def test_gates_in_one_pass_are_those_one_by_one(spark):
    c = odd_claims(spark)
    r, g = C.resolve_in_order(c)
    d, _ = C.compile_directives(r)
    p = C.claim_precedence(c)
    each = [Q.chain_order(p, r), Q.precedence_dag(p), Q.deterministic(r, r.repartition(3)), Q.trace_completeness(r), Q.nonempty(d, "V26"), Q.support(d), Q.ir_schema(d), Q.rank_integrity(r), Q.outcome_coverage(r), Q.competition(c)]
    again, _ = C.resolve_in_order(c.repartition("precedence_scope_id"))
    once = [Q.order_gates(p, r), Q.resolution_gates(r, again), Q.outcomes(r), Q.competition_of(g)]
    assert rows_of(Q.report(each)) == rows_of(Q.report(once))
    # a run that differs fails, and a circle is found
    assert {x.gate_id: x.passed for x in Q.resolution_gates(r, again.where("rank > 1")).collect()}["V24"] is False
    ring = [("a", "b", "precedes", "s", 1, "defines|scope:s"), ("b", "a", "precedes", "s", 1, "defines|scope:s")]
    two = spark.createDataFrame([claim("a", 0), claim("b", 1)], SCHEMA)
    p = spark.createDataFrame(ring, EDGE)
    got = {x.gate_id: (x.passed, x.total) for x in Q.order_gates(p, C.resolve_in_order(two)[0]).collect()}
    assert got == {"V12": (False, 2), "V13": (False, 2)}
