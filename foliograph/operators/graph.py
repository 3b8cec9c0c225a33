"""The property graph: building nodes and edges, and questions about them.

A graph is two tables. Reachability, components and cycles are rounds of joins; each round's table is a checkpoint in the
shared folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliograph.functions.text import edge_id
from foliograph.sources.scratch import settled

EDGE = ["edge_id", "source_node_id", "target_node_id", "edge_type"]


def make_edges(pairs: DataFrame, kind: str, source: str = "source_node_id", target: str = "target_node_id", suffix: str | None = None, **more: Column) -> DataFrame:
    """Edges of one type from a table of node pairs."""
    s, t, k = F.col(source), F.col(target), F.lit(kind)
    return pairs.select(edge_id(k, s, t, F.col(suffix) if suffix else None).alias("edge_id"), s.alias("source_node_id"), t.alias("target_node_id"), k.alias("edge_type"), *[c.alias(n) for n, c in more.items()])


def section_nodes(sections: DataFrame) -> DataFrame:
    kind = F.when(F.col("anchor_type") == "box", "box_section").when(F.col("anchor_type") == "section", "section").when(F.col("anchor_type") == "preamble", "preamble").otherwise("concept")
    return sections.select(F.concat_ws(":", "doc_id", "anchor_id").alias("node_id"), "doc_id", kind.alias("node_type"), "anchor_id", "box_key", F.substr("header_text", F.lit(1), F.lit(60)).alias("label"), F.col("full_text").alias("text"))


def root_nodes(sections: DataFrame) -> DataFrame:
    return sections.select("doc_id").distinct().select(F.concat(F.col("doc_id"), F.lit(":doc_root")).alias("node_id"), "doc_id", F.lit("doc_root").alias("node_type"))


def paragraph_nodes(elements: DataFrame, forced: DataFrame | None = None) -> DataFrame:
    """Body and list elements with text, and referenced ones whatever their role (E1, F4). forced: doc_id, element_id."""
    bare = F.regexp_replace("element_id", F.concat(F.lit("^"), F.regexp_replace("doc_id", r"([^\w])", r"\\\\$1"), F.lit(":")), F.lit(""))
    fit = F.col("role").isin("BodyTextBlock", "ListBlock") & (F.trim(F.coalesce("text", F.lit(""))) != "")
    d = elements
    if forced is not None:
        d = d.join(forced.select("doc_id", "element_id", F.lit(True).alias("__forced")).distinct(), ["doc_id", "element_id"], "left")
        fit = fit | F.coalesce("__forced", F.lit(False))
    return d.where(fit).select(F.concat(F.col("doc_id"), F.lit(":el_"), bare).alias("node_id"), "doc_id", F.lit("paragraph").alias("node_type"), "anchor_id", F.substr("text", F.lit(1), F.lit(60)).alias("label"), "text", "element_id", "reading_order")


def hierarchy_edges(anchors: DataFrame) -> DataFrame:
    """parent_of: a section's parent is the root; a box's the last section; a subsection's the last box since that section.

    anchors: doc_id, node_id, anchor_type, position.
    """
    w = Window.partitionBy("doc_id").orderBy("position", "node_id")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    last = lambda kind, c: F.last(F.when(F.col("anchor_type") == kind, F.col(c)), ignorenulls=True).over(before)
    d = anchors.withColumn("n", F.row_number().over(w))
    d = d.withColumns({"sec": last("section", "node_id"), "sec_n": last("section", "n"), "box": last("box", "node_id"), "box_n": last("box", "n")})
    root = F.concat(F.col("doc_id"), F.lit(":doc_root"))
    box = F.when(F.col("box_n") > F.coalesce("sec_n", F.lit(0)), F.col("box"))
    parent = F.when(F.col("anchor_type") == "section", root).when(F.col("anchor_type") == "box", F.coalesce("sec", root)).otherwise(F.coalesce(box, F.col("sec"), root))
    return make_edges(d.select("node_id", parent.alias("parent")), "parent_of", "parent", "node_id")


def follows_edges(nodes: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """follows: each node to the next of its group."""
    w = Window.partitionBy(*by).orderBy(*order)
    return make_edges(nodes.withColumn("next", F.lead("node_id").over(w)).where("next is not null"), "follows", "node_id", "next")


def in_section_edges(anchors: DataFrame) -> DataFrame:
    """in_section: subsections to the section they stand in."""
    w = Window.partitionBy("doc_id").orderBy("position", "node_id").rowsBetween(Window.unboundedPreceding, -1)
    d = anchors.withColumn("sec", F.last(F.when(F.col("anchor_type") == "section", F.col("node_id")), ignorenulls=True).over(w))
    return make_edges(d.where("anchor_type = 'subsection' and sec is not null"), "in_section", "node_id", "sec")


def paragraph_edges(paragraphs: DataFrame, nodes: DataFrame) -> DataFrame:
    """parent_of from a paragraph's anchor, or from the root at confidence 0.5 where the anchor is no node."""
    known = nodes.select("node_id").withColumnRenamed("node_id", "parent").distinct()
    d = paragraphs.withColumn("parent", F.concat_ws(":", "doc_id", "anchor_id")).join(known.withColumn("__known", F.lit(True)), "parent", "left")
    parent = F.when(F.col("__known"), F.col("parent")).otherwise(F.concat(F.col("doc_id"), F.lit(":doc_root")))
    return make_edges(d.withColumn("parent", parent), "parent_of", "parent", "node_id", confidence=F.when(F.col("__known"), 1.0).otherwise(0.5))


def reference_edges(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """references_box: the first reference of each pair of nodes that exist (E6, J12). refs: source, target, ordinal."""
    first = Window.partitionBy("source", "target").orderBy("ordinal")
    d = refs.where("source <> target").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    return existing(make_edges(d, "references_box", "source", "target"), nodes)


def same_group_edges(anchors: DataFrame) -> DataFrame:
    """same_group, both ways, for members of a grouped header (E7, J13). anchors: group_id, node_id, member.

    A header names a handful of boxes, so its pairs are few; groups are explicit, not found by likeness.
    """
    a = anchors.select("group_id", F.col("node_id").alias("x"), F.col("member").alias("i"))
    b = anchors.select("group_id", F.col("node_id").alias("y"), F.col("member").alias("j"))
    return make_edges(a.join(b, "group_id").where("i <> j"), "same_group", "x", "y")


def existing(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose both ends are nodes."""
    known = nodes.select("node_id").distinct()
    d = edges.join(known.withColumnRenamed("node_id", "source_node_id"), "source_node_id", "left_semi")
    return d.join(known.withColumnRenamed("node_id", "target_node_id"), "target_node_id", "left_semi").select(edges.columns)


def union_all(*tables: DataFrame) -> DataFrame:
    """One table; columns that some lack are null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without an edge (Q1)."""
    ends = edges.select(F.col("source_node_id").alias("node_id")).unionByName(edges.select(F.col("target_node_id").alias("node_id")))
    return nodes.join(ends.distinct(), "node_id", "left_anti")


def self_edges(edges: DataFrame) -> DataFrame:
    return edges.where("source_node_id = target_node_id")


def edge_distribution(edges: DataFrame) -> DataFrame:
    """Edges and share in percent of each type (Q2, Q8); the total is a window over one row for each type."""
    n = edges.groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))
    return n.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def neighbours(edges: DataFrame, kinds: list[str], node: str | None = None) -> DataFrame:
    """Edges of the kinds from either end: node_id, direction, edge_type, other (Q6, Q7)."""
    e = edges.where(F.col("edge_type").isin(kinds))
    out = e.select(F.col("source_node_id").alias("node_id"), F.lit("out").alias("direction"), "edge_type", F.col("target_node_id").alias("other"))
    into = e.select(F.col("target_node_id").alias("node_id"), F.lit("in").alias("direction"), "edge_type", F.col("source_node_id").alias("other"))
    both = out.unionByName(into)
    return both.where(F.col("node_id") == node) if node else both


def graph_summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, edge types, orphans, self edges (Q9)."""
    e = edges.agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("edge_type").alias("edge_types"), F.count_if(F.col("source_node_id") == F.col("target_node_id")).alias("self_edges"))
    n = nodes.agg(F.count(F.lit(1)).alias("nodes"))
    return n.join(e).join(orphans(nodes, edges).agg(F.count(F.lit(1)).alias("orphans")))


def provenance_coverage(edges: DataFrame, column: str = "source_evidence") -> DataFrame:
    """Share of edges with evidence, by type and in all (Q5)."""
    has = F.col(column).isNotNull() & (F.col(column) != "")
    return edges.rollup("edge_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(has).alias("with_evidence"))


def roots(edges: DataFrame) -> DataFrame:
    """Parents that are nobody's child (Q13)."""
    parents = edges.select(F.col("source_node_id").alias("node_id")).distinct()
    return parents.join(edges.select(F.col("target_node_id").alias("node_id")), "node_id", "left_anti")


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """node_id and the least number of steps from a start node (Q11), however far. start: node_id."""
    step = edges.select(F.col("source_node_id").alias("node_id"), F.col("target_node_id").alias("next")).distinct()
    seen = settled(start.select("node_id").distinct().withColumn("steps", F.lit(0)))
    front, n = seen, 0
    while not front.isEmpty():
        n += 1
        new = front.join(step, "node_id").select(F.col("next").alias("node_id")).distinct().join(seen, "node_id", "left_anti")
        front = settled(new.withColumn("steps", F.lit(n)))
        seen = seen.unionByName(front)
        if n % 16 == 0:  # one table instead of many
            seen = settled(seen)
    return seen


def connected_components(nodes: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node_id and component (its smallest node id), by alternating stars: about logarithmically many rounds (Q3)."""
    s, t = F.col("source_node_id"), F.col("target_node_id")
    e = settled(edges.where(s != t).select(F.greatest(s, t).alias("a"), F.least(s, t).alias("b")).distinct())
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = settled(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        changed = not new.join(e, ["a", "b"], "left_anti").isEmpty() or not e.join(new, ["a", "b"], "left_anti").isEmpty()
        e = new
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    parts = e.select(F.col("a").alias("node_id"), F.col("b").alias("component"))
    return nodes.select("node_id").distinct().join(parts, "node_id", "left").select("node_id", F.coalesce("component", "node_id").alias("component"))


def _followed(hop: DataFrame) -> DataFrame:
    """s, t, steps, endless: the node without a hop that each node's hops lead to, by doubling; endless if they lead to a circle.

    hop: s, t, one row for each s.
    """
    now, reach = settled(hop.select("s", "t", F.lit(1).cast("long").alias("steps"))), 1
    n = now.count()
    while True:
        on = now.select(F.col("s").alias("t"), F.col("t").alias("next"), F.col("steps").alias("more"))
        # n hops that have not ended go round
        if reach > n or now.join(on, "t", "left_semi").isEmpty():
            break
        now, reach = settled(now.join(on, "t", "left").select("s", F.coalesce("next", "t").alias("t"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))), 2 * reach
    return settled(now.join(on.select("t", F.lit(True).alias("endless")), "t", "left").select("s", "t", "steps", F.coalesce("endless", F.lit(False)).alias("endless")))


def _endless(e: DataFrame) -> DataFrame:
    """node_id of the nodes that a walk along e (s, t) without an end starts from.

    Each round takes out nodes with one successor, which share its fate, and edges into nodes without any. A node known
    to be endless keeps an edge to itself alone. Chains of any length take one round.
    """
    e, found, alias = settled(e.select("s", "t").distinct()), [], []
    n = e.count()
    while n:
        deg = settled(e.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t")))
        followed = _followed(deg.where("n = 1"))
        found.append(followed.where("endless").select(F.col("s").alias("node_id")))
        alias.append(followed.where("not endless").select(F.col("s").alias("node_id"), F.col("t").alias("to")))
        forked = deg.where("n > 1").select("s")
        d = e.join(forked, "s", "left_semi").join(followed.select(F.col("s").alias("t"), F.col("t").alias("to"), "endless"), "t", "left")
        d = d.select("s", F.when(F.col("endless"), F.col("s")).otherwise(F.coalesce("to", "t")).alias("t"))
        d = d.join(forked.select(F.col("s").alias("t")), "t", "left_semi").distinct()
        own = d.where("s = t").select("s")
        e = settled(d.where("s <> t").join(own, "s", "left_anti").select("s", "t").unionByName(own.select("s", F.col("s").alias("t"))))
        left = e.count()
        if left == n and followed.isEmpty():  # every node has successors for ever
            found.append(e.select(F.col("s").alias("node_id")).distinct())
            break
        n = left
    out = e.select(F.col("s").alias("node_id")).limit(0)
    for part in found:
        out = out.unionByName(part)
    out = settled(out.distinct())
    for part in reversed(alias):
        more = part.join(out.withColumnRenamed("node_id", "to"), "to", "left_semi").select("node_id")
        if not more.isEmpty():
            out = settled(out.unionByName(more).distinct())
    return out


def cycle_nodes(edges: DataFrame) -> DataFrame:
    """Nodes that no stripping of sources and sinks removes: those on or between cycles; none if the graph is acyclic (Q12).

    That is, nodes that walks without an end both start from and lead to.
    """
    e = settled(edges.select(F.col("source_node_id").alias("s"), F.col("target_node_id").alias("t")).where("s is not null and t is not null").distinct())
    on = _endless(e)
    if on.isEmpty():
        return on
    e = e.join(on.withColumnRenamed("node_id", "s"), "s", "left_semi").join(on.withColumnRenamed("node_id", "t"), "t", "left_semi")
    return _endless(e.select(F.col("t").alias("s"), F.col("s").alias("t")))


def parent_violations(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes other than roots without exactly one parent_of parent."""
    p = edges.where("edge_type = 'parent_of'").groupBy(F.col("target_node_id").alias("node_id")).agg(F.count(F.lit(1)).alias("parents"))
    d = nodes.where("node_type <> 'doc_root'").select("node_id").join(p, "node_id", "left").withColumn("parents", F.coalesce("parents", F.lit(0).cast("long")))
    return d.where("parents <> 1")


def polarity_conflicts(edges: DataFrame) -> DataFrame:
    """Pairs of nodes that both exclude and include each other."""
    pair = ["source_node_id", "target_node_id"]
    no = edges.where("edge_type = 'excludes'").select(*pair).distinct()
    yes = edges.where(F.col("edge_type").isin("includes", "aggregates")).select(*pair).distinct()
    return no.intersect(yes)


def children(edges: DataFrame, node: str) -> DataFrame:
    """Targets of a node's parent_of edges."""
    return edges.where((F.col("edge_type") == "parent_of") & (F.col("source_node_id") == node)).select(F.col("target_node_id").alias("node_id"))


def reading_sequence(edges: DataFrame, start: str) -> DataFrame:
    """node_id and step along follows from a node, by doubling (D2); a circle ends where it closes."""
    hop = settled(edges.where("edge_type = 'follows'").select(F.col("source_node_id").alias("node_id"), F.col("target_node_id").alias("next")).distinct())
    seen = settled(edges.sparkSession.createDataFrame([(start, 0)], "node_id string, step int"))
    reach = 1
    while True:
        more = seen.join(hop, "node_id").select(F.col("next").alias("node_id"), (F.col("step") + reach).alias("step"))
        new = settled(more.join(seen.select("node_id"), "node_id", "left_anti"))
        if new.isEmpty():
            break
        seen = seen.unionByName(new)
        on = hop.select(F.col("node_id").alias("next"), F.col("next").alias("top"))
        hop, reach = settled(hop.join(on, "next").select("node_id", F.col("top").alias("next"))), 2 * reach
    return seen


def same_field(left: DataFrame, right: DataFrame) -> DataFrame:
    """same_field edges between two documents' nodes of equal canonical id."""
    a = left.where("canonical_id is not null").select("canonical_id", F.col("node_id").alias("x"))
    b = right.where("canonical_id is not null").select("canonical_id", F.col("node_id").alias("y"))
    return make_edges(a.join(b, "canonical_id").where("x <> y"), "same_field", "x", "y")


def precedence_order(rules: DataFrame, precedences: DataFrame) -> DataFrame:
    """rule and level: those that nothing active precedes come first, then those they alone preceded, and so on.

    precedences: higher, lower, active, revived. Active edges count; revived ones that lie on a cycle are cut first.
    What stays on a cycle has no level.
    """
    e = precedences.where("active").select(F.col("higher").alias("source_node_id"), F.col("lower").alias("target_node_id"), F.coalesce("revived", F.lit(False)).alias("revived"))
    circle = cycle_nodes(e)
    on = e.join(circle.withColumnRenamed("node_id", "source_node_id"), "source_node_id", "left_semi").join(circle.withColumnRenamed("node_id", "target_node_id"), "target_node_id", "left_semi").where("revived")
    e = settled(e.join(on.select("source_node_id", "target_node_id"), ["source_node_id", "target_node_id"], "left_anti").select("source_node_id", "target_node_id"))
    # a rule that one rule alone precedes is a fixed number of levels below the end of its chain; the others take rounds
    rule = settled(rules.select("rule").where("rule is not null").distinct())
    into = settled(e.select(F.col("target_node_id").alias("s"), F.col("source_node_id").alias("t")).where("t is not null").distinct().join(rule.select(F.col("rule").alias("s")), "s", "left_semi"))
    many = into.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    chain = _followed(into.join(many.where("n = 1"), "s", "left_semi"))
    place = settled(rule.join(chain.withColumnRenamed("s", "rule"), "rule", "left").select("rule", F.coalesce("t", "rule").alias("top"), F.coalesce("steps", F.lit(0)).alias("steps"), F.coalesce("endless", F.lit(False)).alias("endless")))
    tops = settled(into.join(many.where("n > 1"), "s", "left_semi").join(place.withColumnRenamed("rule", "t"), "t", "left").select("s", F.when(~F.coalesce("endless", F.lit(False)), F.coalesce("top", "t")).alias("top"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps")))
    done = settled(rule.join(into.select(F.col("s").alias("rule")), "rule", "left_anti").withColumn("level", F.lit(0).cast("long")))
    while True:
        open_ = tops.join(done.select(F.col("rule").alias("s")), "s", "left_anti").join(done.select(F.col("rule").alias("top"), "level"), "top", "left")
        more = settled(open_.groupBy(F.col("s").alias("rule")).agg(F.bool_and(F.col("level").isNotNull()).alias("free"), F.max(F.col("level") + F.col("steps")).alias("level")).where("free").select("rule", "level"))
        if more.isEmpty():
            break
        done = settled(done.unionByName(more))
    ranked = place.where("not endless").join(done.select(F.col("rule").alias("top"), F.col("level").alias("base")), "top").select("rule", (F.col("base") + F.col("steps")).cast("int").alias("level"))
    return rules.select("rule").distinct().join(ranked, "rule", "left")


def skeleton_limits(nodes: DataFrame, edges: DataFrame, depth: int = 5) -> DataFrame:
    """One row: deepest step from a root and share of references among other edges (Q14)."""
    top = nodes.where("node_type = 'doc_root'").select("node_id")
    deep = reachable(edges.where("edge_type = 'parent_of'"), top).agg(F.max("steps").alias("depth"))
    share = edges.where("edge_type not in ('parent_of', 'follows', 'in_section')").agg((F.count_if(F.col("edge_type") == "references_box") / F.greatest(F.count(F.lit(1)), F.lit(1))).alias("reference_share"))
    return deep.join(share).withColumn("passed", (F.col("depth") <= depth) & (F.col("reference_share") < 0.8))
