"""Spans to graph, claims and directives: the whole run, for any number of documents at once (§3.1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliograph.functions.text import canonical_authority, section_id, stable_id, subsection_id
from foliograph.operators import claims as C
from foliograph.operators import regimes as RG
from foliograph.operators import graph as G
from foliograph.operators import layout as L
from foliograph.operators import mentions as M
from foliograph.operators import quality as Q
from foliograph.operators import sections as S
from foliograph.operators import segments as SG
from foliograph.operators import typed_edges as TE
from foliograph.sources.scratch import settled
from foliograph.sources.tables import quality_report, write_table

FORM = "form:1099-div"


def anchors_of(elements: DataFrame) -> DataFrame:
    """Box, section and subsection anchors, the first of each id."""
    boxes = SG.box_anchors(elements.where("role = 'BoxHeader'"))
    others = elements.where("role in ('SectionHeader', 'SubsectionHeader')")
    box = F.col("role") == "SectionHeader"
    others = others.select(
        "doc_id", F.lit(0).alias("member"), F.lit(None).cast("string").alias("box_key"), F.lit("header").alias("parse_kind"), F.col("text").alias("label"), F.lit(False).alias("is_grouped"), F.lit(None).cast("string").alias("group_id"),
        F.col("element_id").alias("source_element_id"), F.col("text").alias("source_text"), "page", "reading_order",
        F.when(box, section_id(F.col("text"))).otherwise(subsection_id(F.col("text"), F.col("element_id"))).alias("anchor_id"), F.when(box, "section").otherwise("subsection").alias("anchor_type"),
    )
    return SG.dedupe_anchors(boxes.unionByName(others))


def build(spans: DataFrame, body_size: float = 9.0, form: str = FORM) -> dict[str, DataFrame]:
    """All relations by name."""
    lines = settled(L.line_features(spans, body_size))
    elements = settled(SG.element_roles(SG.split_elements(lines)))
    anchors = settled(anchors_of(elements))
    holders = anchors.select("doc_id", "page", "reading_order", "anchor_id")
    placed = SG.assign_as_of(elements, holders, ["doc_id", "page"], "reading_order")
    sections = S.materialize_sections(SG.anchor_elements(placed, anchors))
    meta = anchors.select("doc_id", "anchor_id", "box_key", "anchor_type")
    sections = settled(S.concept_roles(sections.join(meta, ["doc_id", "anchor_id"], "left").withColumn("anchor_type", F.coalesce("anchor_type", F.lit("preamble")))))
    index = settled(M.sentence_index(placed.where("role in ('BodyTextBlock', 'ListBlock')")))
    valid = anchors.where("box_key is not null").groupBy("doc_id").agg(F.collect_set("box_key").alias("valid_box_keys"))
    refs = M.references(placed.where("role in ('BodyTextBlock', 'ListBlock')")).join(valid, "doc_id", "left")
    inside = F.when(F.col("ref_type") == "box_reference", F.coalesce(F.array_contains("valid_box_keys", F.col("target_keys")[0]), F.lit(False)))
    refs = settled(M.locate_references(refs.withColumn("target_exists", inside).withColumn("confidence", F.when(F.col("ref_type") != "box_reference", F.col("confidence")).when(F.col("target_exists"), 0.95).otherwise(M.UNKNOWN_BOX)).drop("valid_box_keys"), index))
    forced = refs.where("target_exists").select("doc_id", F.col("source_element_id").alias("element_id"))
    nodes = settled(G.union_all(G.root_nodes(sections), G.section_nodes(sections), G.paragraph_nodes(placed, forced)))

    place = placed.groupBy("doc_id", "anchor_id").agg(F.min("reading_order").alias("position"))
    heads = sections.join(place, ["doc_id", "anchor_id"]).withColumn("node_id", F.concat_ws(":", "doc_id", "anchor_id"))
    paragraphs = nodes.where("node_type = 'paragraph'")
    box_refs = refs.where("ref_type = 'box_reference' and target_exists").select(F.concat(F.col("doc_id"), F.lit(":"), "source_anchor_id").alias("source"), F.concat(F.col("doc_id"), F.lit(":"), "target_anchor_id").alias("target"), F.struct("page", "position").alias("ordinal"))
    groups = anchors.where("is_grouped").select(F.concat_ws(":", "doc_id", "group_id").alias("group_id"), F.concat_ws(":", "doc_id", "anchor_id").alias("node_id"), "member")
    skeleton = G.union_all(
        G.hierarchy_edges(heads), G.follows_edges(heads, ["doc_id"], ["position", "node_id"]), G.follows_edges(paragraphs, ["doc_id", "anchor_id"], ["reading_order"]), G.in_section_edges(heads),
        G.paragraph_edges(paragraphs, nodes), G.reference_edges(box_refs, nodes), G.same_group_edges(groups),
    )
    typed = typed_edges(paragraphs, sections, valid, form)
    edges = settled(G.existing(G.union_all(skeleton, typed), nodes))

    built = built_claims(typed, paragraphs, index, form)
    claims = settled(C.topic_keys(built.where("rejection is null")))
    walk = C.crosswalk(built)
    precedence = settled(C.claim_precedence(claims))
    resolved, groups_ = C.resolve_in_order(claims)
    resolved = settled(resolved)
    directives, compiled = C.compile_directives(resolved)
    authorities = refs.where("ref_type <> 'box_reference'").withColumn("authority_id", F.coalesce(canonical_authority(F.col("ref_text")), stable_id("authority:raw:", [F.col("ref_text")])))
    mentions = authorities.select("doc_id", "authority_id", "source_element_id", "sentence_idx", F.col("position").alias("char_start"), (F.col("position") + F.length("ref_text")).alias("char_end"), F.col("ref_text").alias("evidence_text"))
    return {
        "lines": lines, "elements": placed, "anchors": anchors, "sections": sections, "element_sentences": index, "references": refs, "graph_nodes": nodes, "graph_edges": edges, "typed_edges": typed,
        "struct_nodes": C.structure_overlay(nodes, index), "authorities": authorities.groupBy("authority_id").agg(F.min_by("ref_text", F.struct("source_element_id", "position")).alias("raw_text")),
        "authority_mentions": mentions, "claims": claims, "constraints": M.constraints(index), "claim_authority_mentions": C.authority_overlaps(claims, mentions), "claim_precedence": precedence,
        "claim_rejections": C.rejections(built), "claim_edges": walk.select("claim_id", "source_node_id", "target_node_id", "predicate"), "typed_edge_claims": walk.select("edge_id", "claim_id", "predicate"),
        "claim_constraints": C.claim_constraints(claims, M.constraints(index)), "constraint_attributes": C.constraint_attributes(M.constraints(index)), "paragraph_authority_edges": RG.authority_links(refs, nodes),
        "resolved_claims": resolved, "resolution_groups": groups_, "compiled_directives": directives, "constraints_resolved": compiled,
    }


def typed_edges(paragraphs: DataFrame, sections: DataFrame, valid: DataFrame, form: str) -> DataFrame:
    """Typed edges of paragraphs and boxes, as graph edges with provenance."""
    none = F.lit(None).cast("string")
    p = paragraphs.join(valid, "doc_id").select(F.col("node_id").alias("row_id"), F.col("node_id").alias("source_node_id"), "text", "valid_box_keys", F.when(F.startswith("anchor_id", F.lit("box_")), F.substr("anchor_id", F.lit(5))).alias("parent_box_key"), F.lit(form).alias("form_id"), none.alias("exception_term"))
    b = sections.where("box_key is not null").join(valid, "doc_id").select(F.concat_ws(":", "doc_id", "anchor_id").alias("row_id"), F.concat_ws(":", "doc_id", "anchor_id").alias("source_node_id"), "box_key", F.col("full_text").alias("text"), "valid_box_keys")
    found = TE.concept_edges_df(p).unionByName(TE.box_edges_df(b))
    owner = paragraphs.select(F.col("node_id").alias("row_id"), "doc_id", F.col("element_id").alias("source_element_id"), "reading_order").unionByName(sections.select(F.concat_ws(":", "doc_id", "anchor_id").alias("row_id"), "doc_id", none.alias("source_element_id"), F.lit(None).cast("int").alias("reading_order")))
    d = found.join(owner, "row_id").withColumn("target_node_id", F.concat(F.col("doc_id"), F.lit(":box_"), F.col("target_box_key")))
    d = d.select(
        F.col("row_id").alias("source_node_id"), "target_node_id", "edge_type", "doc_id", "source_element_id", "confidence", "pattern_matched", "polarity", "rule_class", F.col("evidence_text").alias("source_evidence"),
        F.col("sentence_idx").alias("evidence_sentence_idx"), F.col("sentence_char_start").alias("evidence_char_start"), F.col("sentence_char_end").alias("evidence_char_end"), C.semantic_precedence(F.col("rule_class"), F.col("reading_order"), F.col("sentence_idx")).alias("precedence"),
    )
    from foliograph.functions.text import edge_id

    d = d.withColumn("edge_id", edge_id(F.col("edge_type"), F.col("source_node_id"), F.col("target_node_id")))
    return settled(TE.dedupe_edges(d, "pattern_matched"))


def built_claims(typed: DataFrame, paragraphs: DataFrame, index: DataFrame, form: str) -> DataFrame:
    """The typed edges of elements with what makes them claims, or the reason against it."""
    box = F.concat(F.lit(f"{form}:box:"), F.regexp_extract("target_node_id", ":box_(.+)$", 1))
    e = typed.where("source_element_id is not null").select(
        "edge_id", "doc_id", "source_node_id", "target_node_id", "edge_type", "source_element_id", F.col("evidence_sentence_idx").alias("sentence_idx"), F.col("evidence_char_start").alias("char_start"), F.col("evidence_char_end").alias("char_end"),
        "pattern_matched", "polarity", "rule_class", F.lit(None).cast("string").alias("subject_canonical_id"), box.alias("object_canonical_id"),
    )
    built = C.claims_from_edges(e, paragraphs.select("doc_id", "element_id", "text"), index)
    return settled(built.withColumns({"predicate": F.col("edge_type"), "precedence_scope_id": F.col("source_node_id")}))


def checks(tables: dict[str, DataFrame]) -> DataFrame:
    v, e = tables["graph_nodes"], tables["graph_edges"]
    return Q.report([Q.id_integrity(v, "node_id"), Q.endpoints(v, e), Q.structural_dag(e), Q.reachability(v, e), Q.traceability(v, tables["elements"]), Q.id_integrity(tables["claims"], "claim_id", "V6"), Q.rank_integrity(tables["resolved_claims"]), Q.cross_group(tables["claims"], tables["claim_precedence"])])


def run(spark: SparkSession, spans: DataFrame, folder: str, body_size: float | None = None, validate: bool = False) -> dict[str, str]:
    """Build, write and, if asked, audit (DEFECT-6: the flag is wired); where each table lies."""
    size = body_size if body_size is not None else L.body_font_size(spans).first()[0]
    tables = build(spans, size)
    out = {name: write_table(df, folder, name) for name, df in tables.items()}
    if validate:
        quality_report(spark, checks(tables), folder)
    return out
