"""Inputs for the queries, made of the TPC-H-like tables, and the same as SQL.

The tables hold no instruction text, boxes or geometry, so these are derived from their columns by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROW = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruction elements: one for each distinct (order, line, part, supplier)."""
    d = read(spark, sf_dir, "lineitem").select(*ROW).distinct()
    o, n, p, s = (F.col(c) for c in ROW)
    one = lambda c: (1 + c % 8).cast("string")
    text = F.concat(
        F.lit("Box "), n.cast("string"), F.substr(F.lit("abcdef"), (1 + p % 6).cast("int"), F.lit(1)), F.lit(". Include amounts from boxes "), one(s), F.lit("a and "), one(p),
        F.lit("b. See Pub. "), (500 + p % 60).cast("string"), F.lit(" and section "), (300 + s % 50).cast("string"), F.lit("(c)(1). Held for "), (30 + p % 90).cast("string"), F.lit(" days."),
    )
    return d.select(F.concat(F.lit("d"), (o % 50).cast("string")).alias("doc_id"), F.concat_ws("-", *[c.cast("string") for c in (o, n, p, s)]).alias("element_id"), text.alias("text"), n.cast("int").alias("page"), F.lit(None).cast("string").alias("anchor_id"), *ROW)


ELEMENTS = """e AS (SELECT 'd' || (l_orderkey % 50) AS doc_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS element_id,
  concat('Box ', l_linenumber, substr('abcdef', CAST(1 + l_partkey % 6 AS INT), 1), '. Include amounts from boxes ', 1 + l_suppkey % 8, 'a and ', 1 + l_partkey % 8,
    'b. See Pub. ', 500 + l_partkey % 60, ' and section ', 300 + l_suppkey % 50, '(c)(1). Held for ', 30 + l_partkey % 90, ' days.') AS text,
  l_linenumber AS page, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem))"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents: one for each text line, 40 to a page, with geometry by a rule."""
    d = read(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("n", "line_text"))
    n, size = F.col("n"), F.length("line_text")
    x = ((n % 3) * 4 + F.when(n % 5 == 0, 300).otherwise(50)).cast("double")
    return d.select(
        "doc_id", (1 + F.floor(n / 40)).cast("int").alias("page"), (F.floor(n / 8)).cast("int").alias("block_id"), n.cast("int").alias("line_id"), "line_text",
        x.alias("geom_x0"), ((n % 40) * 12).cast("double").alias("geom_y0"), (x + F.least(size, F.lit(100)) * 2).alias("geom_x1"), ((n % 40) * 12 + 8 + n % 3).cast("double").alias("geom_y1"),
        F.when(n % 7 == 0, 12.0).otherwise(9.0).alias("line_size"), (n % 4 == 0).alias("line_bold"), F.array(F.concat(F.lit("s"), n.cast("string"))).alias("span_ids"), (n % 8).cast("int").alias("line_idx_in_block"),
    )


LINES = r"""l AS (SELECT *, x0 AS geom_x0, x0 + least(size, 100) * 2.0 AS geom_x1 FROM (
  SELECT doc_id, 1 + n // 40 AS page, n // 8 AS block_id, n AS line_id, t AS line_text, length(t) AS size,
    ((n % 3) * 4 + CASE WHEN n % 5 = 0 THEN 300 ELSE 50 END)::DOUBLE AS x0, ((n % 40) * 12)::DOUBLE AS geom_y0, ((n % 40) * 12 + 8 + n % 3)::DOUBLE AS geom_y1,
    CASE WHEN n % 7 = 0 THEN 12.0 ELSE 9.0 END::DOUBLE AS line_size, n % 4 = 0 AS line_bold, n % 8 AS line_idx_in_block
  FROM (SELECT 'd' || doc_id AS doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)))"""


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hierarchy of regions, nations, customers and orders under one root, with parts and suppliers beside it."""
    t = lambda name: read(spark, sf_dir, name)
    row = lambda p, c, kind, text: (F.concat(F.lit(p), F.col(c).cast("string")).alias("node_id"), F.lit(kind).alias("node_type"), F.col(text).cast("string").alias("text"))
    root = spark.createDataFrame([("root", "doc_root", "root")], "node_id string, node_type string, text string")
    out = root
    for name, prefix, key, kind, text in (("region", "r", "r_regionkey", "section", "r_name"), ("nation", "n", "n_nationkey", "section", "n_name"), ("customer", "c", "c_custkey", "box_section", "c_name"), ("orders", "o", "o_orderkey", "paragraph", "o_orderpriority"), ("part", "p", "p_partkey", "concept", "p_name"), ("supplier", "s", "s_suppkey", "concept", "s_name")):
        out = out.unionByName(t(name).select(*row(prefix, key, kind, text)))
    return out


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parent_of down the hierarchy, follows along a customer's orders, and references from parts to suppliers."""
    from foliograph.operators.graph import follows_edges, make_edges, union_all

    t = lambda name: read(spark, sf_dir, name)
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    down = [
        t("region").select(F.lit("root").alias("a"), name("r", "r_regionkey").alias("b")), t("nation").select(name("r", "n_regionkey").alias("a"), name("n", "n_nationkey").alias("b")),
        t("customer").select(name("n", "c_nationkey").alias("a"), name("c", "c_custkey").alias("b")), t("orders").select(name("c", "o_custkey").alias("a"), name("o", "o_orderkey").alias("b")),
    ]
    sequence = follows_edges(t("orders").select(name("o", "o_orderkey").alias("node_id"), "o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    refs = t("lineitem").select(name("p", "l_partkey").alias("a"), name("s", "l_suppkey").alias("b")).distinct()
    return union_all(*[make_edges(d, "parent_of", "a", "b") for d in down], sequence, make_edges(refs, "references_box", "a", "b"))


NODES = """v AS (SELECT 'root' AS node_id, 'doc_root' AS node_type, 'root' AS text
  UNION ALL SELECT 'r' || r_regionkey, 'section', r_name FROM region UNION ALL SELECT 'n' || n_nationkey, 'section', n_name FROM nation
  UNION ALL SELECT 'c' || c_custkey, 'box_section', c_name FROM customer UNION ALL SELECT 'o' || o_orderkey, 'paragraph', o_orderpriority FROM orders
  UNION ALL SELECT 'p' || p_partkey, 'concept', p_name FROM part UNION ALL SELECT 's' || s_suppkey, 'concept', s_name FROM supplier)"""
EDGES = """pairs AS (SELECT 'parent_of' AS edge_type, 'root' AS s, 'r' || r_regionkey AS t FROM region
  UNION ALL SELECT 'parent_of', 'r' || n_regionkey, 'n' || n_nationkey FROM nation UNION ALL SELECT 'parent_of', 'n' || c_nationkey, 'c' || c_custkey FROM customer
  UNION ALL SELECT 'parent_of', 'c' || o_custkey, 'o' || o_orderkey FROM orders
  UNION ALL SELECT 'follows', s, t FROM (SELECT 'o' || o_orderkey AS s, 'o' || lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS t FROM orders) WHERE t IS NOT NULL
  UNION ALL SELECT DISTINCT 'references_box', 'p' || l_partkey, 's' || l_suppkey FROM lineitem),
g AS (SELECT 'e_' || substr(edge_type, 1, 3) || '_' || substr(sha256(concat_ws('|', edge_type, s, t)), 1, 8) AS edge_id, s AS source_node_id, t AS target_node_id, edge_type FROM pairs)"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims: scoped by order, predicate by return flag, element by supplier, sentence by line number."""
    d = read(spark, sf_dir, "lineitem").select(*ROW, "l_returnflag").distinct()
    s = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    predicate = F.when(F.col("l_returnflag") == "A", "excludes").when(F.col("l_returnflag") == "N", "defines").otherwise("requires")
    known = F.col("l_partkey") % 3 == 0
    d = d.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ROW], "l_returnflag").alias("claim_id"), s("o", "l_orderkey").alias("precedence_scope_id"), predicate.alias("predicate"), s("s", "l_suppkey").alias("source_element_id"),
        F.col("l_linenumber").cast("int").alias("sentence_idx"), (F.col("l_partkey") % 100).cast("int").alias("char_start"), (F.col("l_partkey") % 100 + 20).cast("int").alias("char_end"),
        F.when(F.col("l_partkey") % 11 == 0, "Exception: this one").otherwise("the rule").alias("evidence_text"),
        F.when(known, F.lit("form:x")).alias("subject_canonical_id"), F.when(known, (F.lit("form:y"))).alias("object_canonical_id"),
    )
    from foliograph.operators.claims import topic_keys

    return topic_keys(d)


CLAIMS = """c AS (SELECT *, CASE WHEN sub <> '' THEN predicate || '|' || sub || '|' || obj ELSE predicate || '|scope:' || precedence_scope_id END AS topic_key,
    CASE WHEN sub <> '' THEN 'canonical' ELSE 'predicate' END AS group_kind,
    CASE WHEN sub <> '' THEN predicate || '|' || sub || '|' || obj ELSE predicate END AS group_key,
    CASE WHEN predicate = 'excludes' THEN 1 ELSE 2 END AS lim
  FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS claim_id, 'o' || l_orderkey AS precedence_scope_id,
    CASE l_returnflag WHEN 'A' THEN 'excludes' WHEN 'N' THEN 'defines' ELSE 'requires' END AS predicate, 's' || l_suppkey AS source_element_id, l_linenumber AS sentence_idx,
    l_partkey % 100 AS char_start, CASE WHEN l_partkey % 11 = 0 THEN 'Exception: this one' ELSE 'the rule' END AS evidence_text,
    CASE WHEN l_partkey % 3 = 0 THEN 'form:x' ELSE '' END AS sub, CASE WHEN l_partkey % 3 = 0 THEN 'form:y' ELSE '' END AS obj
    FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem))),
o AS (SELECT *, dense_rank() OVER (w0 ORDER BY source_element_id, sentence_idx) AS place, row_number() OVER w AS n, count(*) OVER (w0) AS size
  FROM c WINDOW w0 AS (PARTITION BY precedence_scope_id, group_kind, group_key), w AS (w0 ORDER BY source_element_id, sentence_idx, char_start, claim_id)),
x AS (SELECT *, lead(claim_id) OVER w AS next_id, lead(place) OVER w - place AS distance, lead(evidence_text) OVER w AS next_text
  FROM o WINDOW w AS (PARTITION BY precedence_scope_id, group_kind, group_key ORDER BY n)),
prec AS (SELECT claim_id AS from_claim_id, next_id AS to_claim_id, 'precedes' AS relation, distance, precedence_scope_id, group_kind, group_key, predicate FROM x WHERE next_id IS NOT NULL AND distance <= lim
  UNION ALL SELECT next_id, claim_id, 'exception_of', distance, precedence_scope_id, group_kind, group_key, predicate FROM x WHERE next_id IS NOT NULL AND lower(next_text) LIKE '%exception%'),
st AS (SELECT precedence_scope_id, group_kind, group_key, max(size) AS size,
    CASE WHEN max(size) = 1 THEN 'SKIP_SINGLETON' WHEN count(k) = 0 THEN 'SKIP_NO_EDGES' WHEN count(k) < max(size) - 1 THEN 'ERROR_GRAPH' ELSE 'RESOLVED' END AS group_status
  FROM o LEFT JOIN (SELECT from_claim_id AS k FROM prec WHERE relation = 'precedes') ON k = claim_id GROUP BY ALL),
res AS (SELECT o.claim_id, precedence_scope_id, group_kind, group_key, topic_key, predicate, n AS rank, group_status,
    CASE WHEN group_status = 'SKIP_SINGLETON' THEN 'applies' WHEN group_status = 'ERROR_GRAPH' THEN 'undecidable' WHEN b.t IS NOT NULL THEN 'suppressed' WHEN f.s IS NOT NULL THEN 'exception' WHEN n = 1 THEN 'applies' ELSE 'suppressed' END AS status
  FROM o JOIN st USING (precedence_scope_id, group_kind, group_key)
  LEFT JOIN (SELECT DISTINCT to_claim_id AS t FROM prec WHERE relation = 'exception_of') b ON b.t = o.claim_id
  LEFT JOIN (SELECT DISTINCT from_claim_id AS s FROM prec WHERE relation = 'exception_of') f ON f.s = o.claim_id WHERE group_status <> 'SKIP_NO_EDGES')"""


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts: one for each row of lineitem, with holding days by part and a hedge by line status."""
    d = read(spark, sf_dir, "lineitem")
    n = lambda c: c.cast("int")
    return d.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in ROW]).alias("fact_set_id"),
        F.struct(n(30 + F.col("l_partkey") % 90).alias("holding_days"), n(F.col("l_suppkey") % 5).alias("diminished_risk_days"), n(F.when(F.col("l_partkey") % 17 == 0, 3).otherwise(0)).alias("short_sale_days"), F.lit(0).alias("put_obligation_days"), (F.col("l_linestatus") == "F").alias("has_hedge_position")).alias("holding"),
        F.struct(F.col("l_extendedprice").cast("decimal(18,2)").alias("gross_amount")).alias("amounts"),
        F.create_map(F.lit("is_ric"), F.col("l_linenumber") % 2 == 0).alias("flags"),
    )


FACTS = """f AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS fact_set_id, 30 + l_partkey % 90 - l_suppkey % 5 - CASE WHEN l_partkey % 17 = 0 THEN 3 ELSE 0 END AS days,
  l_partkey % 17 = 0 AS short, l_linestatus = 'F' AS hedge, l_extendedprice::DECIMAL(18,2) AS gross, l_linenumber % 2 = 0 AS ric FROM lineitem)"""
