"""Further queries: regimes, authorities, accounting, graph questions and the remaining gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliograph.functions import text as X
from foliograph.functions.terms import bindings_table
from foliograph.operators import claims as C
from foliograph.operators import graph as G
from foliograph.operators import mentions as M
from foliograph.operators import quality as Q
from foliograph.operators import regimes as RG
from foliograph.plans import inputs as I
from foliograph.plans.catalog import GRAPH, query


def _regime_sections(spark, sf):
    p = F.col("p_partkey")
    text = F.when(p % 4 == 0, F.concat(F.lit("Only RICs and REITs should complete boxes "), (1 + p % 5).cast("string"), F.lit("e and 2f."))).when(p % 4 == 1, "Report section 897 gain here.").when(p % 4 == 2, "Under section 301 it is so.").otherwise("Nothing")
    return I.read(spark, sf, "part").select(F.concat(F.lit("d"), (p % 3).cast("string")).alias("doc_id"), F.concat(F.lit("a"), p.cast("string")).alias("anchor_id"), F.when(p % 4 == 1, "2e").alias("box_key"), F.when(p % 4 == 1, "box").otherwise("subsection").alias("anchor_type"), text.alias("full_text"), p.alias("ordinal"))


@query("g6_regimes", """WITH s AS (SELECT 'd' || (p_partkey % 3) AS doc_id, p_partkey AS k FROM part),
r AS (SELECT doc_id, 'RIC_REIT_Regime' AS regime_id, (1 + k % 5) || 'e' AS b FROM s WHERE k % 4 = 0 UNION SELECT doc_id, 'RIC_REIT_Regime', '2f' FROM s WHERE k % 4 = 0 UNION SELECT doc_id, 'Section897_Regime', '2e' FROM s WHERE k % 4 = 1)
SELECT doc_id, regime_id, string_agg(b, ',' ORDER BY b) AS governed_boxes FROM r GROUP BY ALL UNION ALL SELECT DISTINCT doc_id, 'regime_301', '' FROM s WHERE k % 4 = 2""")
def _(spark, sf):
    d = RG.regimes(_regime_sections(spark, sf))
    return d.select("doc_id", "regime_id", F.array_join(F.array_sort("governed_boxes"), ",").alias("governed_boxes"))


@query("e25_regime_governs", """WITH s AS (SELECT 'd' || (p_partkey % 3) AS doc_id, p_partkey AS k FROM part), q AS (SELECT DISTINCT doc_id, 'Section897_Regime' AS rg, '2e' AS b FROM s WHERE k % 4 = 1 UNION SELECT DISTINCT doc_id, 'RIC_REIT_Regime', '2e' FROM s WHERE k % 4 = 0 AND k % 5 = 1)
SELECT q.doc_id || ':' || rg AS source_node_id, s.doc_id || ':a' || k AS target_node_id, 0.95::DOUBLE AS confidence FROM q JOIN s ON s.doc_id = q.doc_id AND k % 4 = 1""")
def _(spark, sf):
    s = _regime_sections(spark, sf)
    _, e = RG.regime_graph(RG.regimes(s), s)
    return e.where("edge_type = 'governs'").select("source_node_id", "target_node_id", "confidence")


@query("j14_authority_links", f"""WITH {I.ELEMENTS}, r AS (SELECT doc_id, element_id, l_partkey, l_linenumber, 'authority:pub:' || (500 + l_partkey % 60) AS a FROM e UNION ALL SELECT doc_id, element_id, l_partkey, l_linenumber, 'authority:irc:' || (300 + l_suppkey % 50) || '(c)(1)' FROM e)
SELECT element_id, a AS authority_id, CASE WHEN l_partkey % 4 = 0 THEN 'unresolved' ELSE 'paragraph' END AS source_node_type FROM r""")
def _(spark, sf):
    e = I.elements(spark, sf)
    nodes = e.where("l_partkey % 4 <> 0").select("doc_id", "element_id", F.concat(F.lit("n:"), "element_id").alias("node_id"), F.lit("paragraph").alias("node_type"), F.lit(None).cast("string").alias("anchor_id"))
    d = RG.authority_links(M.references(e).where("ref_type in ('publication', 'irc_section')"), nodes)
    return d.select(F.col("source_element_id").alias("element_id"), "authority_id", "source_node_type")


@query("p24_edge_accounting", """SELECT CASE WHEN l_partkey % 5 = 0 THEN 'missing_source_element' WHEN l_suppkey % 4 = 0 THEN 'missing_sentence_idx' WHEN l_linenumber = 1 THEN 'missing_char_span' WHEN l_returnflag = 'A' THEN 'rule_class' WHEN l_returnflag = 'N' THEN 'edge_type' ELSE 'non_semantic_edge' END AS claimable_reason, count(*) AS n, sum((l_partkey % 5 = 0)::INT + (l_suppkey % 4 = 0)::INT + (l_linenumber = 1)::INT + (l_returnflag <> 'A')::INT)::BIGINT AS missing FROM lineitem GROUP BY 1""")
def _(spark, sf):
    c = F.col
    d = I.read(spark, sf, "lineitem").select(
        F.lit("d").alias("doc_id"), c("l_orderkey").cast("string").alias("edge_id"), F.when(c("l_partkey") % 5 != 0, "e").alias("source_element_id"), F.when(c("l_suppkey") % 4 != 0, 1).alias("evidence_sentence_idx"),
        F.when(c("l_linenumber") != 1, 0).alias("evidence_char_start"), F.lit(5).alias("evidence_char_end"), F.when(c("l_returnflag") == "A", "GATING").alias("rule_class"), F.when(c("l_returnflag") == "N", "defines").otherwise("follows").alias("edge_type"), F.lit("p").alias("pattern_matched"), F.lit("positive").alias("polarity"),
    )
    return RG.account(d).groupBy("claimable_reason").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("missing_required_fields")).alias("missing"))


@query("p25_missing_provenance", """SELECT CASE WHEN l_partkey % 2 = 0 AND l_suppkey % 2 = 0 THEN 'source_element_id,sentence_idx' WHEN l_partkey % 2 = 0 THEN 'source_element_id' WHEN l_suppkey % 2 = 0 THEN 'sentence_idx' END AS missing, count(*) AS n FROM lineitem GROUP BY 1""")
def _(spark, sf):
    d = I.read(spark, sf, "lineitem").select(F.when(F.col("l_partkey") % 2 != 0, "e").alias("source_element_id"), F.when(F.col("l_suppkey") % 2 != 0, 1).alias("sentence_idx"), F.lit(0).alias("char_start"), F.lit(1).alias("char_end"))
    return d.groupBy(RG.missing_provenance().alias("missing")).agg(F.count(F.lit(1)).alias("n"))


@query("p27_carrier_types", "SELECT p_type, CASE WHEN p_type LIKE 'LINE%' THEN 'line' ELSE 'field' END AS carrier FROM (SELECT DISTINCT p_type FROM part) UNION ALL SELECT * FROM (VALUES ('Box 1a', 'box'), ('Line 5', 'line'), ('a statement', 'statement'), ('Checkbox 2', 'checkbox')) v(a, b)")
def _(spark, sf):
    d = I.read(spark, sf, "part").select("p_type").distinct().unionByName(spark.createDataFrame([("Box 1a",), ("Line 5",), ("a statement",), ("Checkbox 2",)], "p_type string"))
    return d.select("p_type", RG.carrier_type(F.col("p_type")).alias("carrier"))


@query("p27_slots", "SELECT * FROM (VALUES ('box', 31), ('line', 5), ('statement', 2)) v(kind, n)")
def _(spark, sf):
    return bindings_table(spark).groupBy(RG.carrier_type(F.col("place")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("p20_canonical_nodes", f"""WITH {I.NODES} SELECT node_id, CASE node_type WHEN 'doc_root' THEN 'doc:form:x' WHEN 'section' THEN 'concept:' || regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') WHEN 'concept' THEN 'concept:' || substr(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g'), 1, 60) ELSE node_id END AS canonical_id FROM v WHERE node_type <> 'paragraph'""")
def _(spark, sf):
    d = I.nodes(spark, sf).where("node_type <> 'paragraph'").withColumns({"label": F.col("text"), "box_key": F.lit(None).cast("string"), "anchor_id": F.lit(None).cast("string")})
    return RG.canonical_nodes(d, "form:x").select("node_id", "canonical_id")


@query("c4_claim_scope", """SELECT DISTINCT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS claim_id, CASE WHEN l_linenumber <= 2 THEN 'd:' || l_orderkey || ':sent:' || l_linenumber WHEN l_orderkey % 2 = 0 THEN 'p' || l_orderkey ELSE 'own' END AS scope_id FROM lineitem""")
def _(spark, sf):
    d = I.read(spark, sf, "lineitem").select(*I.ROW).distinct()
    o = d.select("l_orderkey").distinct()
    none = F.lit(None).cast("int")
    sent = o.select(F.lit("d").alias("doc_id"), F.col("l_orderkey").alias("source_element_id"), F.explode(F.array(F.lit(1), F.lit(2))).alias("sentence_idx")).select(F.concat_ws(":", F.lit("d"), F.col("source_element_id").cast("string"), F.lit("sent"), F.col("sentence_idx").cast("string")).alias("struct_node_id"), "doc_id", F.lit("element_sentence").alias("struct_type"), "source_element_id", "sentence_idx")
    para = o.where("l_orderkey % 2 = 0").select(F.concat(F.lit("p"), F.col("l_orderkey").cast("string")).alias("struct_node_id"), F.lit("d").alias("doc_id"), F.lit("paragraph").alias("struct_type"), F.col("l_orderkey").alias("source_element_id"), none.alias("sentence_idx"))
    c = d.select(F.lit("d").alias("doc_id"), F.concat_ws("-", *[F.col(x).cast("string") for x in I.ROW]).alias("claim_id"), F.col("l_orderkey").alias("source_element_id"), F.col("l_linenumber").alias("sentence_idx"), F.lit("own").alias("scope_node_id"))
    return RG.claim_scopes(c, sent.unionByName(para)).select("claim_id", "scope_id")


@query("d1_children", f"WITH {I.EDGES} SELECT target_node_id AS node_id FROM g WHERE edge_type = 'parent_of' AND source_node_id = 'n3'")
def _(spark, sf):
    return G.children(I.edges(spark, sf), "n3")


@query("d2_reading_sequence", f"WITH RECURSIVE {I.EDGES}, f AS (SELECT 'o' || first(o_orderkey ORDER BY o_orderdate, o_orderkey) AS node_id FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders)), r AS (SELECT node_id, 0 AS step FROM f UNION ALL SELECT target_node_id, step + 1 FROM r JOIN g ON source_node_id = node_id AND edge_type = 'follows') SELECT node_id, step FROM r")
def _(spark, sf):
    first = I.read(spark, sf, "orders").orderBy("o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey").first()[0]
    return G.reading_sequence(I.edges(spark, sf), f"o{first}")


@query("d14_precedence_order", "WITH RECURSIVE r AS (SELECT n_nationkey AS k, 0 AS level FROM nation WHERE n_nationkey < 3 UNION ALL SELECT k + 3, level + 1 FROM r WHERE k + 3 <= 24) SELECT 'n' || k AS rule, level FROM r")
def _(spark, sf):
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    n = I.read(spark, sf, "nation").select(F.col("n_nationkey").alias("k"))
    p = n.where("k + 3 <= 24").select(name(F.col("k")).alias("higher"), name(F.col("k") + 3).alias("lower"), F.lit(True).alias("active"), F.lit(False).alias("revived"))
    # a cycle that a revival breaks
    back = n.where("k = 6").select(name(F.col("k")).alias("higher"), F.lit("n0").alias("lower"), F.lit(True).alias("active"), F.lit(True).alias("revived"))
    return G.precedence_order(n.select(name(F.col("k")).alias("rule")), p.unionByName(back))


@query("d15_same_field", "SELECT 'a' || a.n_nationkey AS s, 'b' || b.n_nationkey AS t FROM nation a JOIN nation b USING (n_regionkey)")
def _(spark, sf):
    side = lambda p: I.read(spark, sf, "nation").select(F.concat(F.lit(p), F.col("n_nationkey").cast("string")).alias("node_id"), F.col("n_regionkey").alias("canonical_id"))
    return G.same_field(side("a"), side("b")).select(F.col("source_node_id").alias("s"), F.col("target_node_id").alias("t"))


@query("q14_skeleton_limits", "SELECT 4 AS depth, 1.0::DOUBLE AS reference_share, false AS passed")
def _(spark, sf):
    return G.skeleton_limits(I.nodes(spark, sf), I.edges(spark, sf))


@query("q7_reference_targets", f"WITH {GRAPH} SELECT node_type, direction, count(*) AS n FROM (SELECT source_node_id AS node_id, 'out' AS direction FROM g WHERE edge_type = 'references_box' UNION ALL SELECT target_node_id, 'in' FROM g WHERE edge_type = 'references_box') JOIN v USING (node_id) GROUP BY ALL")
def _(spark, sf):
    d = G.neighbours(I.edges(spark, sf), ["references_box"]).join(I.nodes(spark, sf), "node_id")
    return d.groupBy("node_type", "direction").agg(F.count(F.lit(1)).alias("n"))


@query("v_resolution_gates", f"""WITH {I.CLAIMS}, k AS (SELECT count(*) AS n, count(*) FILTER (status <> 'undecidable') AS m FROM res), p AS (SELECT count(*) AS n FROM prec JOIN res ON res.claim_id = from_claim_id WHERE relation = 'precedes' AND status <> 'undecidable'), q AS (SELECT count(*) AS n FROM st), d AS (SELECT count(*) AS n FROM res WHERE status IN ('applies', 'exception'))
SELECT 'V12' AS gate_id, true AS passed, n AS total, n AS succeeded FROM p UNION ALL SELECT 'V13', true, 0, 0 UNION ALL SELECT 'V23', true, n, n FROM q UNION ALL SELECT 'V24', true, n, n FROM k UNION ALL SELECT 'V25', true, n, n FROM k UNION ALL SELECT 'V26', true, n, n FROM d UNION ALL SELECT 'V27', true, n, n FROM d UNION ALL SELECT 'V28', true, n, n FROM d""")
def _(spark, sf):
    c = I.claims(spark, sf)
    r, g = C.resolve_in_order(c)
    # another run, its groups dealt otherwise
    again, _ = C.resolve_in_order(c.repartition("precedence_scope_id"))
    return Q.report([Q.order_gates(C.claim_precedence(c), r), Q.group_integrity(c, r, g), Q.resolution_gates(r, again)])


@query("v_reference_gates", f"""WITH {I.ELEMENTS}, n AS (SELECT count(*) AS n FROM e) SELECT 'V3' AS gate_id, true AS passed, 2 * n AS total, 2 * n AS succeeded FROM n UNION ALL SELECT 'V7', true, 2 * n, 2 * n FROM n UNION ALL SELECT 'V15', true, n, n FROM n UNION ALL SELECT 'V18', true, 2 * n, 2 * n FROM n UNION ALL SELECT 'V19', true, 25, 25 UNION ALL SELECT 'V20', true, n, n FROM n""")
def _(spark, sf):
    e = I.elements(spark, sf)
    nodes = e.select("doc_id", "element_id", F.concat(F.lit("n:"), "element_id").alias("node_id"), F.lit("paragraph").alias("node_type"), "anchor_id", "text")
    refs = M.references(e).where("ref_type in ('publication', 'irc_section')")
    spans = refs.select("doc_id", "source_element_id", F.col("position").alias("char_start"), (F.col("position") + F.length("ref_text")).alias("char_end"), F.col("ref_text").alias("evidence_text"))
    links = RG.authority_links(refs, nodes)
    return Q.report([Q.reference_join(links), Q.nonempty(links, "V7"), Q.alignment(nodes, e), Q.spans_inside(spans, e), Q.exact_spans(spans, e), Q.filled(nodes, "V20", "node_id", "text")])


@query("x14_canonical_boxes", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'form:z:box:' || p_size || 'a' ELSE 'form:1099-div:box:' || p_size END AS box FROM part")
def _(spark, sf):
    k, n = F.col("p_partkey") % 2, F.col("p_size").cast("string")
    text = F.when(k == 0, F.concat(F.lit("see Box "), n, F.lit("A"))).otherwise(F.concat(F.lit("box "), n))
    return I.read(spark, sf, "part").select("p_partkey", X.canonical_box(text, F.when(k == 0, F.lit("form:z"))).alias("box"))
