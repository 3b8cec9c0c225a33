import pytest

from foliograph.functions import text as X
from foliograph.operators import layout as L
from foliograph.operators import sections as S
from foliograph.plans import pipeline
from foliograph.sources import tables as T

SPAN = "doc_id string, page int, block_id int, line_id int, span_id string, text string, font string, flags int, size double, bbox array<double>"


def page(doc="d"):
    texts = [
        ("Specific Instructions", 12.0, True), ("Box 1a. Total Ordinary Dividends", 10.0, True), ("Enter dividends. Include amounts from boxes 1b and 2e. See Pub. 550.", 9.0, False),
        ("Box 1b. Qualified Dividends", 10.0, True), ("Do not include amounts in box 1a. Held for 61 days under section 301(c)(1).", 9.0, False), ("Boxes 14-16. State Information", 10.0, True), ("Only RICs and REITs should complete boxes 14 and 15.", 9.0, False),
    ]
    return [(doc, 1, n, 0, f"s{n}", t, "Bold" if b else "Plain", 0, s, [50.0, 20.0 * n, 50.0 + 5 * len(t), 20.0 * n + 10]) for n, (t, s, b) in enumerate(texts)]


def test_spans_to_graph(spark, tmp_path):
    spans = spark.createDataFrame(page("d1") + page("d2"), SPAN)
    out = pipeline.run(spark, spans, str(tmp_path / "out"), validate=True)
    read = lambda n: spark.read.parquet(out[n])
    anchors = {(r.doc_id, r.anchor_id) for r in read("anchors").collect()}
    assert {("d1", "box_1a"), ("d1", "box_1b"), ("d1", "box_14"), ("d2", "box_16"), ("d1", "sec_specific_instructions")} <= anchors
    kinds = {(r.edge_type, r.target_node_id) for r in read("typed_edges").collect()}
    assert ("excludes", "d1:box_1a") in kinds and ("requires", "d1:box_1b") in kinds
    types = {r.edge_type for r in read("graph_edges").collect()}
    assert {"parent_of", "follows", "same_group"} <= types
    assert read("authorities").where("authority_id = 'authority:pub:550'").count() == 1
    report = T.read_json(spark, str(tmp_path / "out/quality_report.json"))
    assert {c["gate_id"]: c["passed"] for c in report["checks"]}["IS5"] and "IS1" in (T.read_text(spark, str(tmp_path / "out/quality_report.md")))
    # the same again gives the same
    from foliograph.operators.quality import table_hash

    assert T.missing_tables(spark, str(tmp_path / "out")) == []
    again = pipeline.run(spark, spans.repartition(5), str(tmp_path / "again"))
    for n in ("graph_nodes", "typed_edges", "resolved_claims"):
        assert table_hash(read(n)).first() == table_hash(spark.read.parquet(again[n])).first()


def test_sources(spark, tmp_path):
    assert T.read_table(spark, str(tmp_path), "none", "a int").count() == 0 and T.read_json(spark, str(tmp_path / "no.json")) == {}
    assert len(T.missing_tables(spark, str(tmp_path))) == 24
    with pytest.raises(ValueError):
        T.require(spark.range(1), "id", "other")
    T.write_text(spark, str(tmp_path / "x.txt"), "a\nb")
    assert T.read_text(spark, str(tmp_path / "x.txt")) == "a\nb"


def test_text_functions(spark):
    d = spark.createDataFrame([("Boxes 14 through 16. State information",)], "t string")
    r = d.select(X.parse_box_header(d.t).alias("h")).first().h
    assert (r.kind, r.keys, r.label) == ("through", ["14", "15", "16"], "State information")
    one = lambda c: d.select(c.alias("x")).first().x
    from pyspark.sql import functions as F

    assert one(X.parse_box_header(F.lit("Box 1a. Ordinary Dividends"))).keys == ["1a"]
    assert one(X.reference_keys(F.lit("1a, 1b, and 2a"))) == ["1a", "1b", "2a"] and one(X.reference_keys(F.lit("14-16"))) == ["14", "15", "16"]
    assert one(X.repair_hyphenation(F.lit("fur-\nnishing"))) == "furnishing"
    assert one(X.canonical_authority(F.lit("Treas. Reg. 1.61-1"))) == "authority:treas_reg:1.61-1" and one(X.canonical_authority(F.lit("nothing"))) is None
    assert one(X.canonical_authority(F.lit("Rev. Rul. 2003-1"))) == "authority:rev_rul:2003-1" and one(X.canonical_form(F.lit("Form 1099-DIV"))) == "form:1099-div"
    assert one(X.section_id(F.lit("What's New for 2024"))) == "sec_whats_new" and one(X.section_id(F.lit("Odd Title!"))) == "sec_odd_title"


def test_empty_lines(spark):
    assert L.line_features(spark.createDataFrame([], SPAN), 9.0).count() == 0


def test_merge_cascades():
    def row(i, body, header=""):
        return {"doc_id": "d", "anchor_id": i, "anchor_type": "subsection", "label": header or i, "header_text": header, "body_text": body, "full_text": body, "char_count": len(header) + len(body), "element_ids": [i], "pages": [1], "page": 1, "x_column": 0, "y0": float(ord(i[0])), "merged_from": []}

    got = S.merge_rows([row("a", "short"), row("b", "x" * 400), row("c", "y" * 400)])
    assert [(r["anchor_id"], r["merged_from"]) for r in got] == [("b", ["a"]), ("c", [])]
    assert got[0]["body_text"].startswith("short\n\nx") and got[0]["element_ids"] == ["a", "b"]
    other = row("d", "short") | {"page": 2}
    assert len(S.merge_rows([row("a", "x" * 400), other])) == 2


def test_what_may_take_a_thin_section():
    def row(i, kind="subsection", body="short", header="", y=0.0):
        return {"doc_id": "d", "anchor_id": i, "anchor_type": kind, "label": f"L{i}", "header_text": header, "body_text": body, "full_text": body, "char_count": len(body), "element_ids": [i], "pages": [1], "page": 1, "x_column": 0, "y0": y, "merged_from": []}

    big = "y" * 400
    assert S.fits(row("a"), row("b", body=big)) is None
    assert S.fits(row("a"), row("b", body=big, header="H")) == "target_has_header"
    assert S.fits(row("a"), row("b", "box_section")) == "target_is_box"
    assert S.fits(row("a", y=50.0), row("b", y=2.0)) == "source_below_target" and S.fits(row("a", y=3.0), row("b", y=2.0)) is None
    assert S.fits(row("a", body="x"), row("b", "section")) is None and S.fits(row("a", body=big), row("b", "section")) == "source_has_substantial_body"
    assert S.fits(row("a"), row("b") | {"page": 2}) == "different_page" and S.fits(row("a"), row("b") | {"x_column": 1}) == "different_column"
    got = S.merge_rows([row("a"), row("b", "section", big, "Head", 1.0)])
    assert [(r["header_text"], r["body_text"], r["char_count"]) for r in got] == [("La\nHead", f"short\n\n{big}", len(f"La\nHead\n\nshort\n\n{big}"))]
