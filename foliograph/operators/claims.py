"""Claims: their ids, scopes, precedence, resolution and compilation.

Groups of competing claims are windows. An order that comes from sorting is ranked by row_number; a chain that comes as
edges is ranked by pointer doubling, so a chain of n claims takes log2(n) joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliograph.functions.text import blank, overlaps, stable_id
from foliograph.sources.scratch import settled

# Bases of semantic precedence by rule class
BASES = {"GATING": 1, "PROHIBITION": 2, "FALLBACK": 3, "POPULATION": 10, "AGGREGATION": 11}
# Predicates whose claims compete within one sentence, and those scoped to anchors
NEAR = ("excludes", "gated_by", "fallback_include")
ANCHORED = ("defines", "excludes")
EXCEPTIONS = ("exception", "however", "but not", "except that")


def semantic_precedence(rule_class: Column, reading_order: Column, sentence_idx: Column) -> Column:
    """base * 10^9 + reading order * 1000 + sentence, as a long."""
    base = F.lit(20)
    for name, n in BASES.items():
        base = F.when(rule_class == name, n).otherwise(base)
    return base.cast("long") * 1_000_000_000 + F.coalesce(reading_order, F.lit(0)).cast("long") * 1000 + F.coalesce(sentence_idx, F.lit(0)).cast("long")


def distance_limit(predicate: Column, limits: dict[str, int] | None = None) -> Column:
    """Sentences apart that claims may be: 1 for some predicates, else 2; limits override."""
    out = F.when(predicate.isin(*NEAR), 1).otherwise(2)
    for name, n in (limits or {}).items():
        out = F.when(predicate == name, n).otherwise(out)
    return out


def topic_keys(claims: DataFrame) -> DataFrame:
    """topic_key, its source and parts."""
    p, s, o = (blank(F.col(c)) for c in ("predicate", "subject_canonical_id", "object_canonical_id"))
    known = (p != "") & (s != "") & (o != "")
    key = F.when(known, F.concat_ws("|", p, s, o)).otherwise(F.concat(p, F.lit("|scope:"), F.coalesce("precedence_scope_id", F.lit("none"))))
    return claims.withColumns({"topic_key": key, "topic_key_source": F.when(known, "canonical_ids").otherwise("fallback_scope"), "topic_key_parts": F.array(p, s, o)})


def grouped(claims: DataFrame) -> DataFrame:
    """group_kind and group_key of the claims that can compete."""
    canonical = F.lower(F.trim(blank(F.col("topic_key_source")))) == "canonical_ids"
    d = claims.where("precedence_scope_id is not null and topic_key is not null and predicate is not null")
    return d.withColumns({"group_kind": F.when(canonical, "canonical").otherwise("predicate"), "group_key": F.when(canonical, F.col("topic_key")).otherwise(F.col("predicate"))})


GROUP = ["precedence_scope_id", "group_kind", "group_key"]


def _order() -> list[Column]:
    """Element as a string, sentence, place, id; nulls last."""
    far = F.lit(10**9)
    return [F.coalesce(F.col("source_element_id").cast("string"), F.lit("~")), F.coalesce("sentence_idx", far), F.coalesce("char_start", far), F.col("claim_id")]


def _placed(claims: DataFrame) -> DataFrame:
    """The claims that can compete with what their order and an exception take, so that long texts need not be moved."""
    said = F.lower(blank(F.col("evidence_text")))
    exception = F.lit(False)
    for word in EXCEPTIONS:
        exception = exception | F.contains(said, F.lit(word))
    e, s, a, _ = _order()
    return grouped(claims).withColumns({"__e": e, "__s": s, "__a": a, "__said": exception})


def _neighbours(placed: DataFrame, limits: dict[str, int] | None) -> DataFrame:
    """__rank, the ids of the claims before and after, the distance to the next, and whether it precedes and excepts: one sort."""
    w = Window.partitionBy(*GROUP).orderBy("__e", "__s", "__a", "claim_id")
    d = placed.withColumns({"__rank": F.row_number().over(w), "__up": F.lag("claim_id").over(w), **{f"__next{c}": F.lead(c).over(w) for c in ("claim_id", "__e", "__s", "__said")}})
    # neighbours are in one sentence or in the next that has a claim
    far = F.when((F.col("__next__e") == F.col("__e")) & (F.col("__next__s") == F.col("__s")), 0).otherwise(1)
    last = F.col("__nextclaim_id").isNull()
    d = d.withColumn("__far", F.when(~last, far))
    return d.withColumns({"__down": ~last & (F.col("__far") <= distance_limit(F.col("predicate"), limits)), "__excepted": ~last & F.col("__next__said")})


def claim_precedence(claims: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """precedes between neighbours of a group within the limit, exception_of where the lower one speaks of an exception."""
    d = _neighbours(_placed(claims), limits)
    topic = F.when(F.col("group_kind") == "canonical", F.col("group_key")).otherwise(F.concat(F.col("predicate"), F.lit("|scope:"), F.col("precedence_scope_id").cast("string")))
    edge = lambda a, b, kind: F.struct(F.col(a).alias("from_claim_id"), F.col(b).alias("to_claim_id"), F.lit(kind).alias("relation"))
    both = F.array(F.when(F.col("__down"), edge("claim_id", "__nextclaim_id", "precedes")), F.when(F.col("__excepted"), edge("__nextclaim_id", "claim_id", "exception_of")))
    d = d.select(F.explode(F.filter(both, lambda x: x.isNotNull())).alias("x"), F.col("precedence_scope_id").cast("string").alias("scope_struct_node_id"), F.col("__far").alias("sentence_distance"), topic.alias("topic_key"))
    return d.select("x.*", "scope_struct_node_id", "sentence_distance", "topic_key")


def chain_ranks(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """claim_id, head and rank (from 1) of each node in its chain, by pointer doubling (C9). edges: from_claim_id, to_claim_id.

    Nodes of a circle never meet a head; they are left out, once as many steps are taken as there are nodes.
    """
    back = edges.select(F.col("to_claim_id").alias("claim_id"), F.col("from_claim_id").alias("up"))
    d = settled(nodes.select("claim_id").distinct().join(back, "claim_id", "left").select("claim_id", F.coalesce("up", "claim_id").alias("up"), F.when(F.col("up").isNull(), 0).otherwise(1).alias("hops"), F.col("up").isNull().alias("done")))
    reach, n = 1, d.count()
    while reach <= n and not d.where("not done").isEmpty():
        above = d.select(F.col("claim_id").alias("up"), F.col("up").alias("top"), F.col("hops").alias("more"), F.col("done").alias("ended"))
        d = settled(d.join(above, "up").select("claim_id", F.col("top").alias("up"), (F.col("hops") + F.col("more")).alias("hops"), F.col("ended").alias("done")))
        reach *= 2
    return d.where("done").select("claim_id", F.col("up").alias("head"), (F.col("hops") + 1).alias("rank"))


RESOLVED = ["claim_id", *GROUP, "topic_key", "predicate", "rank", "status", "reason", "suppressed_by", "source_element_id", "sentence_idx", "char_start", "char_end", "evidence_text", "subject_canonical_id", "object_canonical_id"]


def _outcomes(d: DataFrame) -> DataFrame:
    """status, reason and suppressed_by by group_status, error_code, rank, __by, __exc and __before."""
    alone, lost = F.col("group_status") == "SKIP_SINGLETON", F.col("group_status") == "ERROR_GRAPH"
    ok, top, exc, by = F.col("group_status") == "RESOLVED", F.col("rank") == 1, F.coalesce("__exc", F.lit(False)), F.col("__by")
    return d.withColumns({
        "status": F.when(alone, "applies").when(lost, "undecidable").when(by.isNotNull(), "suppressed").when(exc, "exception").when(top, "applies").otherwise("suppressed"),
        "reason": F.when(alone, "single_claim").when(lost, F.col("error_code")).when(by.isNotNull(), "exception_override").when(exc, "exception_of").when(top, "top_rank").otherwise("precedes"),
        "suppressed_by": F.when(ok & by.isNotNull(), by).when(ok & ~top, F.when(~exc, F.col("__before"))),
    })


def _group_status(error: Column, size: Column) -> Column:
    return F.when(size == 1, "SKIP_SINGLETON").when(error == "missing_precedes", "SKIP_NO_EDGES").when(error.isNotNull(), "ERROR_GRAPH").otherwise("RESOLVED")


def resolve_in_order(claims: DataFrame, limits: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """resolve() by the claims' own precedence, that of claim_precedence(claims, limits), from one shuffle and sort by group.

    Such edges lead from a claim to the next of its group's order, so they neither leave the group nor lack or pass a
    distance, and they chain it if there are n-1 for n claims; the rank is then the place in that order.
    """
    d = _neighbours(_placed(claims), limits)

    def judged(d: DataFrame, n: Column, links: Column) -> DataFrame:
        d = d.withColumn("error_code", F.when(n == 1, None).when(links == 0, "missing_precedes").when(links < n - 1, "invalid_chain"))
        return d.withColumn("group_status", _group_status(F.col("error_code"), n))

    g = d.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("group_size"), F.count_if("__down").alias("__links"))
    g = judged(g, F.col("group_size"), F.col("__links")).select(*GROUP, "group_size", "group_status", "error_code")
    w = Window.partitionBy(*GROUP)
    d = d.withColumns({"__n": F.count(F.lit(1)).over(w), "__links": F.count_if("__down").over(w)})
    d = judged(d, F.col("__n"), F.col("__links")).where("group_status <> 'SKIP_NO_EDGES'")
    d = d.withColumns({"rank": F.col("__rank"), "__before": F.col("__up"), "__by": F.when(F.col("__excepted"), F.col("__nextclaim_id")), "__exc": F.col("__said") & (F.col("__rank") > 1)})
    return _outcomes(d).select(*RESOLVED), g


def resolve(claims: DataFrame, precedence: DataFrame, limits: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolved claims and their groups (C7-C10), by any precedence edges.

    A group of one applies. A group without precedes edges is skipped. Edges that leave the group, lack a distance, pass the
    limit, or don't chain all claims make all of it undecidable. Else the first applies and each other is suppressed by the
    one before it; an exception suppresses what it is an exception of.
    """
    w = Window.partitionBy(*GROUP)
    topic = F.when(F.col("group_kind") == "canonical", F.col("group_key")).otherwise(F.concat(F.col("predicate"), F.lit("|scope:"), F.col("precedence_scope_id").cast("string")))
    c = grouped(claims).withColumns({"__n": F.count(F.lit(1)).over(w), "__topic": topic, "__rank": F.row_number().over(w.orderBy(*_order()))})
    c = settled(c.select("claim_id", *GROUP, "topic_key", "predicate", "source_element_id", "sentence_idx", "char_start", "char_end", "evidence_text", "subject_canonical_id", "object_canonical_id", "__n", "__topic", "__rank"))
    groups = c.select(*GROUP, "__topic", "__n").distinct()
    e = precedence.select("from_claim_id", "to_claim_id", "relation", "sentence_distance", F.col("scope_struct_node_id").alias("__scope"), F.col("topic_key").alias("__topic"))
    e = e.join(groups.where("__n > 1").withColumn("__scope", F.col("precedence_scope_id").cast("string")), ["__scope", "__topic"])
    ends = c.select("claim_id", *GROUP, "predicate", "__rank")
    for side in ("from", "to"):
        own = ends.select(F.col("claim_id").alias(f"{side}_claim_id"), *[F.col(g).alias(f"{side}_{g}") for g in GROUP], F.col("predicate").alias(f"{side}_predicate"), F.col("__rank").alias(f"{side}_rank"))
        e = e.join(own, f"{side}_claim_id", "left")
    inside = F.lit(True)
    for side in ("from", "to"):
        for g in GROUP:
            inside = inside & F.coalesce(F.col(f"{side}_{g}") == F.col(g), F.lit(False))
    e = settled(e.withColumn("__in", inside))
    down = F.col("relation") == "precedes"
    facts = e.groupBy(*GROUP).agg(
        F.count_if(down).alias("precedes"), F.count_if(~F.col("__in")).alias("outside"), F.count_if(down & F.col("sentence_distance").isNull()).alias("blind"),
        F.count_if(down & (F.col("sentence_distance") > distance_limit(F.col("from_predicate"), limits))).alias("far"),
        F.count_distinct(F.when(down, F.col("from_claim_id"))).alias("sources"), F.count_distinct(F.when(down, F.col("to_claim_id"))).alias("targets"),
    )
    links = e.where(down & F.col("__in")).select("from_claim_id", "to_claim_id").distinct()
    ranks = chain_ranks(links, c.where("__n > 1"))
    whole = c.where("__n > 1").join(ranks, "claim_id", "left").groupBy(*GROUP).agg(F.count_distinct("head").alias("heads"), F.count_if(F.col("rank").isNull()).alias("astray"))
    g = groups.join(facts, GROUP, "left").join(whole, GROUP, "left")
    n = F.col("__n")
    chain = (F.col("precedes") == n - 1) & (F.col("sources") == n - 1) & (F.col("targets") == n - 1) & (F.col("heads") == 1) & (F.col("astray") == 0)
    code = (
        F.when(n == 1, None).when(F.coalesce("precedes", F.lit(0)) == 0, "missing_precedes").when(F.col("outside") > 0, "cross_group_edge")
        .when(F.col("blind") > 0, "missing_distance").when(F.col("far") > 0, "distance_limit").when(~chain, "invalid_chain")
    )
    g = g.withColumn("error_code", code)
    g = settled(g.withColumn("group_status", _group_status(F.col("error_code"), n)).select(*GROUP, n.alias("group_size"), "group_status", "error_code"))
    d = c.join(g, GROUP).join(ranks.select("claim_id", "rank"), "claim_id", "left")
    d = d.withColumn("rank", F.when(F.col("group_status") == "RESOLVED", F.col("rank")).otherwise(F.col("__rank")))
    d = d.where("group_status <> 'SKIP_NO_EDGES'")
    before = F.lag("claim_id").over(Window.partitionBy(*GROUP).orderBy("rank"))
    base = e.where("relation = 'exception_of' and __in").groupBy(F.col("to_claim_id").alias("claim_id")).agg(F.max("from_claim_id").alias("__by"))
    over = e.where("relation = 'exception_of' and __in").select(F.col("from_claim_id").alias("claim_id"), F.lit(True).alias("__exc")).distinct()
    d = d.withColumn("__before", before).join(base, "claim_id", "left").join(over, "claim_id", "left")
    return _outcomes(d).select(*RESOLVED), g


def _json(c: Column) -> Column:
    """A value as JSON."""
    text = F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"})
    return F.substr(text, F.lit(6), F.length(text) - 6)


def _object(**fields: Column) -> Column:
    """A JSON object with sorted keys, a blank after each comma and colon."""
    parts = [F.concat(F.lit(f'"{k}": '), _json(c)) for k, c in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


ACTIVE = ("applies", "exception")


def directive_columns() -> dict[str, Column]:
    """The columns of the directive of a resolved claim, by name."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    ir = _object(kind=F.lit("predicate"), predicate=text("predicate"), subject_canonical_id=F.col("subject_canonical_id"), object_canonical_id=F.col("object_canonical_id"))
    payload = _object(scope=text("precedence_scope_id"), topic=text("topic_key"), claim=text("claim_id"), op=text("predicate"), condition_ir=ir)
    span = F.struct("source_element_id", "sentence_idx", "char_start", "char_end")
    return {
        "directive_id": F.concat(F.lit("dir_"), _short(payload)), "precedence_scope_id": text("precedence_scope_id"), "topic_key": text("topic_key"), "target_box_id": F.col("object_canonical_id"), "op": text("predicate"), "condition_ir": ir,
        "supporting_claim_ids": F.array(text("claim_id")), "supporting_spans": F.array(span), "resolution_reason_codes": F.filter(F.array(text("reason"), text("status")), lambda c: c != ""),
    }


def _short(c: Column) -> Column:
    return F.substr(F.sha2(c, 256), F.lit(1), F.lit(16))


def compile_directives(resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A directive and its constraint for each claim that applies or is an exception."""
    d = resolved.where(F.col("status").isin(*ACTIVE)).select(*[c.alias(name) for name, c in directive_columns().items()])
    return d, d.select(F.concat(F.lit("cr_"), _short(F.col("directive_id"))).alias("constraint_id"), *d.columns)


# Reasons for which an edge makes no claim, in order
REJECTIONS = (
    "missing_source_node", "missing_source_element", "missing_sentence_idx", "missing_char_span", "missing_pattern_id", "missing_polarity", "missing_rule_class",
    "missing_element_text", "invalid_span_bounds", "missing_sentence_index", "sentence_span_mismatch", "missing_evidence_text",
)


def claims_from_edges(edges: DataFrame, elements: DataFrame, index: DataFrame) -> DataFrame:
    """Edges with evidence text and claim id, or the first reason against one.

    edges: edge_id, doc_id, source_node_id, target_node_id, edge_type, source_element_id, sentence_idx, char_start,
    char_end, pattern_matched, polarity, rule_class; subject_canonical_id and object_canonical_id where there are any. A
    claim's id counts places within its sentence.
    """
    for name in ("subject_canonical_id", "object_canonical_id"):
        if name not in edges.columns:
            edges = edges.withColumn(name, F.lit(None).cast("string"))
    text = elements.select("doc_id", F.col("element_id").alias("source_element_id"), F.col("text").alias("__text"))
    s = index.select("doc_id", "source_element_id", "sentence_idx", F.col("sentence_char_start").alias("__s"), F.col("sentence_char_end").alias("__e"))
    d = edges.join(text, ["doc_id", "source_element_id"], "left").join(s, ["doc_id", "source_element_id", "sentence_idx"], "left")
    a, b = F.col("char_start"), F.col("char_end")
    evidence = F.substr("__text", a + 1, b - a)
    absent = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    tests = [
        absent("source_node_id"), F.col("source_element_id").isNull(), F.col("sentence_idx").isNull(), a.isNull() | b.isNull(), absent("pattern_matched"), absent("polarity"), absent("rule_class"),
        F.col("__text").isNull(), (a < 0) | (b > F.length("__text")) | (a >= b), F.col("__s").isNull() | F.col("__e").isNull(), (a < F.col("__s")) | (b > F.col("__e")), F.coalesce(evidence, F.lit("")) == "",
    ]
    reason = F.coalesce(*[F.when(t, r) for t, r in zip(tests, REJECTIONS)])
    start, end = a - F.col("__s"), b - F.col("__s")
    filled = lambda name: F.coalesce(F.col(name), F.lit(""))
    parts = [filled("doc_id"), F.col("source_element_id").cast("string"), F.col("sentence_idx").cast("string"), start.cast("string"), end.cast("string"), F.col("edge_type"), filled("subject_canonical_id"), filled("object_canonical_id"), F.col("polarity")]
    d = d.withColumn("rejection", reason)
    ok = F.col("rejection").isNull()
    claim_id = F.concat(F.lit("clm_"), F.substr(F.sha2(F.concat_ws("|", *parts), 256), F.lit(1), F.lit(16)))
    return d.withColumns({"evidence_text": F.when(ok, evidence), "claim_id": F.when(ok, claim_id), "sentence_start": F.when(ok, start), "sentence_end": F.when(ok, end)}).drop("__text", "__s", "__e")


def rejections(built: DataFrame) -> DataFrame:
    """predicate, source_node_id, reason, edge_id of the edges that make no claim."""
    return built.where("rejection is not null").select(F.col("edge_type").alias("predicate"), "source_node_id", F.col("rejection").alias("reason"), "edge_id")


def status_counts(resolved: DataFrame) -> DataFrame:
    """How many claims of each group apply, are suppressed, are exceptions, are undecidable. Other statuses count nowhere."""
    names = ("applies", "suppressed", "exception", "undecidable")
    return resolved.groupBy(*GROUP).agg(*[F.count_if(F.col("status") == n).alias(n) for n in names])


def crosswalk(built: DataFrame) -> DataFrame:
    """claim_id, source_node_id, target_node_id, predicate, edge_id: which edge each claim comes from."""
    return built.where("rejection is null").select("claim_id", "source_node_id", "target_node_id", F.col("edge_type").alias("predicate"), "edge_id")


def claim_constraints(claims: DataFrame, constraints: DataFrame) -> DataFrame:
    """claim_id, constraint_id: the constraints in a claim's sentence that its evidence holds."""
    c = constraints.select("doc_id", "source_element_id", "sentence_idx", "constraint_id").distinct()
    return claims.join(c, ["doc_id", "source_element_id", "sentence_idx"]).select("claim_id", "constraint_id").distinct()


def constraint_attributes(constraints: DataFrame) -> DataFrame:
    """constraint_id, name, value: each typed field that a constraint has."""
    fields = [c for c in constraints.columns if c not in ("doc_id", "source_element_id", "sentence_idx", "raw_text", "constraint_id")]
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in fields])
    return constraints.select("constraint_id", F.explode(cells).alias("a")).select("constraint_id", "a.*").where("value is not null").distinct()


def authority_overlaps(claims: DataFrame, mentions: DataFrame) -> DataFrame:
    """Claims and the authorities their spans or texts touch, in the same sentence."""
    m = mentions.select("source_element_id", "sentence_idx", "authority_id", F.col("char_start").alias("m0"), F.col("char_end").alias("m1"), F.col("evidence_text").alias("m_text"))
    flat = lambda c: F.lower(F.regexp_replace(blank(F.col(c)), r"\s+", " "))
    near = overlaps(F.col("char_start"), F.col("char_end"), F.col("m0"), F.col("m1")) | ((flat("m_text") != "") & F.contains(flat("evidence_text"), flat("m_text")))
    return claims.join(m, ["source_element_id", "sentence_idx"]).where(near).select("claim_id", "authority_id").distinct()


def structure_overlay(nodes: DataFrame, index: DataFrame) -> DataFrame:
    """Sentences under paragraphs under anchors, with parent pointers (C3). Anchors are their own parents."""
    s = index.select(
        F.concat_ws(":", "doc_id", "source_element_id", F.lit("sent"), F.col("sentence_idx").cast("string")).alias("struct_node_id"), "doc_id", F.lit("element_sentence").alias("struct_type"), "source_element_id", "sentence_idx",
        F.concat(F.col("doc_id"), F.lit(":el_"), F.col("source_element_id")).alias("parent_struct_node_id"),
    )
    p = nodes.where("node_type = 'paragraph'").select(F.col("node_id").alias("struct_node_id"), "doc_id", F.lit("paragraph").alias("struct_type"), F.col("element_id").alias("source_element_id"), F.lit(None).cast("int").alias("sentence_idx"), F.concat_ws(":", "doc_id", "anchor_id").alias("parent_struct_node_id"))
    a = nodes.where("node_type not in ('paragraph', 'doc_root')").select(F.col("node_id").alias("struct_node_id"), "doc_id", F.when(F.col("node_type") == "section", "section").otherwise("anchor").alias("struct_type"), F.lit(None).cast("string").alias("source_element_id"), F.lit(None).cast("int").alias("sentence_idx"), F.col("node_id").alias("parent_struct_node_id"))
    return s.unionByName(p).unionByName(a)


def precedence_scopes(claims: DataFrame, overlay: DataFrame, depth: int = 4) -> DataFrame:
    """claim_id and the first ancestor of the type that its predicate prefers, by preference, then nearness."""
    up = overlay.select(F.col("struct_node_id").alias("at"), "struct_type", F.col("parent_struct_node_id").alias("parent"))
    d = claims.select("claim_id", "predicate", F.col("scope_id").alias("at"), F.lit(0).alias("steps"))
    found = None
    for n in range(depth):
        here = d.join(up, "at")
        found = here.select("claim_id", "predicate", "at", "struct_type", "steps") if found is None else found.unionByName(here.select("claim_id", "predicate", "at", "struct_type", "steps"))
        d = here.where("parent <> at").select("claim_id", "predicate", F.col("parent").alias("at"), F.lit(n + 1).alias("steps"))
    first = F.when(F.col("predicate").isin(*ANCHORED), F.array_position(F.array(*map(F.lit, ("anchor", "section", "paragraph"))), F.col("struct_type"))).otherwise(F.array_position(F.array(*map(F.lit, ("paragraph", "anchor", "section"))), F.col("struct_type")))
    best = found.withColumn("__p", first).where("__p > 0").groupBy("claim_id").agg(F.min_by("at", F.struct("__p", "steps", "at")).alias("precedence_scope_id"))
    return claims.join(best, "claim_id", "left").withColumn("precedence_scope_id", F.coalesce("precedence_scope_id", "scope_id"))
