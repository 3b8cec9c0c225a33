"""Scalar functions over text, ids and geometry, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliograph.functions import patterns as P


def blank(c: Column) -> Column:
    """Null as an empty string."""
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Without white space (not only blanks) at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Words one blank apart."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def stable_hash(parts: list[Column], length: int = 8) -> Column:
    """First hex digits of the SHA-256 of the parts, joined by bars; null parts are empty."""
    joined = F.concat_ws("|", *[blank(p.cast("string")) for p in parts])
    return F.substr(F.sha2(joined, 256), F.lit(1), F.lit(length))


def stable_id(prefix: str, parts: list[Column], length: int = 8) -> Column:
    return F.concat(F.lit(prefix), stable_hash(parts, length))


def digest(*parts: Column) -> Column:
    """16 bytes of the SHA-256 of the parts' JSON: equal where all are, nulls included."""
    cells = F.struct(*[p.alias(f"c{k}") for k, p in enumerate(parts)])
    return F.substring(F.unhex(F.sha2(F.to_json(cells), 256)), 1, 16)


def edge_id(kind: Column, source: Column, target: Column, suffix: Column | None = None) -> Column:
    """`e_<first three of the type>_<hash>`."""
    parts = [kind, source, target] + ([suffix] if suffix is not None else [])
    return F.concat(F.lit("e_"), F.substr(kind, F.lit(1), F.lit(3)), F.lit("_"), stable_hash(parts, 8))


def repair_hyphenation(c: Column) -> Column:
    """Joins words that a hyphen and a line feed (and indent) break before a small letter."""
    return F.regexp_replace(F.regexp_replace(c, r"(?U)(\w)-\n([a-z])", "$1$2"), r"(?U)(\w)-\n\s+([a-z])", "$1$2")


def slug(c: Column, length: int = 40) -> Column:
    """First line, lower case, other than a-z and 0-9 as underscores; stripped, then cut."""
    line = F.split_part(strip(c), F.lit("\n"), F.lit(1))
    tidy = F.regexp_replace(F.regexp_replace(F.lower(line), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.substr(tidy, F.lit(1), F.lit(length))


def window_quote(text: Column, start: Column, end: Column, around: int = 50) -> Column:
    """Text from `around` characters before start (0-based) to as many after end, with ellipses where cut."""
    a, b = F.greatest(start - around, F.lit(0)), F.least(end + around, F.length(text))
    quote = collapse(F.substr(text, a + 1, b - a))
    return F.concat(F.when(a > 0, "...").otherwise(""), quote, F.when(b < F.length(text), "...").otherwise(""))


def box_keys(c: Column) -> Column:
    """Keys such as 1a or 14, in order, lower case, repeats included."""
    return F.transform(F.regexp_extract_all(c, F.lit(P.BOX_KEY), F.lit(1)), F.lower)


def number_range(lo: Column, hi: Column) -> Column:
    """All whole numbers between two, as strings; letters are ignored."""
    a, b = (F.regexp_replace(x, "[a-z]", "").cast("int") for x in (lo, hi))
    return F.transform(F.sequence(F.least(a, b), F.greatest(a, b)), lambda n: n.cast("string"))


def reference_keys(c: Column) -> Column:
    """Keys of a reference: a range's numbers first, then single keys, each once."""
    at = r"(?i)(\d+)\s*(?:[-–]|through|to)\s*(\d+)"
    lo, hi = F.regexp_extract(c, at, 1), F.regexp_extract(c, at, 2)
    spread = F.when(lo != "", number_range(lo, hi)).otherwise(F.expr("cast(array() as array<string>)"))
    return F.array_distinct(F.concat(spread, box_keys(c)))


def parse_box_header(c: Column) -> Column:
    """struct(kind, keys, label) of a box header: range, through, double or single."""
    t = strip(blank(c))
    forms = [
        ("range", r"(?i)^Box(?:es)?\s+(\d+[a-z]?)\s*[-–]\s*(\d+[a-z]?)\b"),
        ("through", r"(?i)^Box(?:es)?\s+(\d+)\s+through\s+(\d+)\b"),
        ("double", r"(?i)^Box(?:es)?\s+(\d+[a-z]?)\s+and\s+(\d+[a-z]?)\b"),
        ("single", r"(?i)^Box(?:es)?\s+(\d+[a-z]?)\b"),
    ]
    out = F.struct(F.lit("unknown").alias("kind"), F.expr("cast(array() as array<string>)").alias("keys"), t.alias("label"))
    for kind, pattern in reversed(forms):
        first = F.lower(F.regexp_extract(t, pattern, 1))
        second = F.lower(F.regexp_extract(t, pattern, 2)) if kind != "single" else None
        keys = F.array(first) if kind == "single" else F.array(first, second) if kind == "double" else number_range(first, second)
        label = F.regexp_replace(F.regexp_replace(t, pattern, ""), r"^\s+|\s+$", "")
        label = F.regexp_replace(label, r"^[.\-–: ]+", "")
        out = F.when(t.rlike(pattern), F.struct(F.lit(kind).alias("kind"), keys.alias("keys"), label.alias("label"))).otherwise(out)
    return out


# Section headers and their ids
SECTION_IDS = {
    "future developments": "sec_future_developments",
    "reminders": "sec_reminders",
    "general instructions": "sec_general_instructions",
    "specific instructions": "sec_specific_instructions",
    "what's new": "sec_whats_new",
    "definitions": "sec_definitions",
    "how to": "sec_how_to",
    "where to": "sec_where_to",
    "paperwork reduction act notice": "sec_paperwork_reduction",
    "additional information": "sec_additional_info",
}


def section_id(c: Column) -> Column:
    """A known header's id, else one made of its first 30 characters."""
    t = strip(c)
    made = F.concat(F.lit("sec_"), F.regexp_replace(F.regexp_replace(F.substr(F.lower(t), F.lit(1), F.lit(30)), "[^a-z0-9]+", "_"), "^_+|_+$", ""))
    known = [F.when(F.startswith(F.lower(t), F.lit(k)), F.lit(v)) for k, v in SECTION_IDS.items()]
    return F.coalesce(*known, made)


def subsection_id(text: Column, element: Column) -> Column:
    return F.concat(F.lit("sub_"), slug(text, 30), F.lit("_"), stable_hash([element], 8))


def canonical_form(c: Column) -> Column:
    m = F.regexp_extract(c, r"(?iU)form\s+([0-9][\w\-]+)", 1)
    return F.when(m != "", F.concat(F.lit("form:"), F.lower(m)))


def canonical_box(c: Column, form: Column) -> Column:
    m = F.regexp_extract(c, r"(?i)box\s+(\d+[a-z]?)", 1)
    return F.when(m != "", F.concat(F.coalesce(form, F.lit("form:1099-div")), F.lit(":box:"), F.lower(m)))


# Kinds of authority, their expressions in order of priority, and whether the number is lower-cased
AUTHORITIES = [
    ("authority:irc:", r"(?i)(?:section|§)\s*(\d+[A-Za-z]?(?:\([a-z0-9]+\))*)", True),
    ("authority:treas_reg:", r"(?i)(?:treasury\s+reg(?:ulation)?|treas\.\s*reg\.?|reg\.)\s*([\d\.]+-[\w\(\)\.-]+)", True),
    ("authority:notice:", r"(?i)notice\s+(\d{4}-\d+)", False),
    ("authority:rev_rul:", r"(?i)rev\.\s*rul\.?\s*(\d{4}-\d+)", False),
    ("authority:rev_proc:", r"(?i)rev\.\s*proc\.?\s*(\d{4}-\d+)", False),
    ("authority:pub:", r"(?i)(?:pub\.?|publication)\s*(\d+)", False),
]


def canonical_authority(c: Column) -> Column:
    """The first kind of authority that stands in the text; a form counts last; else null."""
    found = []
    for prefix, pattern, lower in AUTHORITIES:
        m = F.regexp_extract(c, pattern, 1)
        found.append(F.when(m != "", F.concat(F.lit(prefix), F.lower(m) if lower else m)))
    return F.coalesce(*found, canonical_form(c))


def fingerprint(fields: dict[str, Column]) -> Column:
    """`cns_` and the hash of the fields that are not null, sorted by name."""
    items = [F.when(c.isNotNull(), F.concat(F.lit(f"{k}="), c.cast("string"))) for k, c in sorted(fields.items())]
    return F.concat(F.lit("cns_"), F.substr(F.sha2(F.concat_ws("|", *items), 256), F.lit(1), F.lit(16)))


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Half-open spans that share a place."""
    return (a1 > b0) & (b1 > a0)


def valid_at(day: Column, start: Column, end: Column) -> Column:
    """Both ends included; a null end is open."""
    return (start.isNull() | (start <= day)) & (end.isNull() | (day <= end))


def effective_days(held: Column, *less: Column) -> Column:
    """Holding days less days of diminished risk, short sales and put obligations."""
    out = F.coalesce(held, F.lit(0))
    for c in less:
        out = out - F.coalesce(c, F.lit(0))
    return out


def bbox_part(box: Column, k: int) -> Column:
    """A part of [x0, y0, x1, y1]; null unless all four are there."""
    return F.when(F.size(box) >= 4, F.try_element_at(box, F.lit(k + 1)))


def bbox_union(boxes: Column) -> Column:
    """The smallest box around all."""
    return F.array(*[(F.array_min if k < 2 else F.array_max)(F.transform(boxes, lambda b: b[k])) for k in range(4)])


def is_bold(font: Column, flags: Column) -> Column:
    """The font's name or the fifth flag says bold."""
    return F.contains(F.lower(blank(font)), F.lit("bold")) | (F.coalesce(flags, F.lit(0)).bitwiseAND(16) != 0)


def margin_tolerance(width: Column) -> Column:
    return F.coalesce(F.greatest(F.lit(2.0), 0.02 * width), F.lit(2.0))
