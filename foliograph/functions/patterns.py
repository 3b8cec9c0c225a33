r"""Regular expressions, names and confidences that results depend on.

Fixed values: names are emitted as pattern_matched, so names, expressions and confidences have to be these. They are
Python expressions; java() turns one into Java's dialect with Unicode classes.
"""

from __future__ import annotations

# Line headers
BOX_STRONG = r"(?i)^Box(?:es)?\s+\d+[a-z]?(?:\s*[-–]\s*\d+[a-z]?)?(?:\.\s+[A-Z]|:\s+[A-Z]|\s+[-–]\s+[A-Z])"
BOX_WEAK = r"(?i)^Box(?:es)?\s+\d+[a-z]?(?:\s*[-–]\s*\d+[a-z]?)?[.:]"
SECTION_HEADER = r"(?i)^(Specific Instructions|General Instructions|Definitions|Future Developments|Reminders|What's New|How To|Where To|Paperwork Reduction Act Notice|Additional Information)\b"
PAGE_MARKER = r"^\s*-\s*\d{1,3}\s*-\s*$"
BULLET = r"^\s*[•\-\*]\s*"
ENUMERATION = r"^\s*\(?\d{1,2}\s*[.)]\s+[A-Za-z]"
TITLE_CASE = r"^[A-Z][A-Za-z0-9\s\-\(\)\']+$"
LOOKS_LIKE_DATE = r"^[A-Z][a-z]+\s+\d{1,2},?\s+\d{4}$"

# references
BOX_REF = r"(?i)[Bb]ox(?:es)?\s+(\d+[a-z]?(?:[^\n]*?(?:,|and|through|[-–]|to)\s*\d+[a-z]?)*)"
PUB_REF = r"[Pp]ub(?:lication)?\.?\s*(\d+)"
IRC_REF = r"(?:[Ss]ection|§)\s*(\d+[A-Za-z]?(?:\([a-z0-9]+\))*)"
FORM_REF = r"[Ff]orm\s+(\d+[A-Z\-]*|[A-Z]-?\d+)"
BOX_MENTION = r"(?i)[Bb]ox(?:es)?\s+(\d+[a-z]?(?:\s*(?:,|and|or)\s*\d+[a-z]?)*)"
BOX_KEY = r"(?i)\b(\d+[a-z]?)\b"

# Sentence splitting
ABBREVIATIONS = "u.s. no. sec. pub. rev. i.e. e.g. etc. fig. vol. mr. mrs. ms. dr. jr. sr. inc. ltd. corp. cat.".split()
LIST_BREAK = r"(?:\n\s*(?:[-•]|(?:\(\d+\))|(?:\d+\.))\s+)"

#: A list of box keys. Unlike nested repetition it can't backtrack without end; it takes the same keys.
KEYS = r"(\d+[a-z]?(?:[,\s]*(?:(?:and|or)\s+)?\d+[a-z]?)*)"

# Typed edges (name, expression, confidence), in order of priority
EXCLUDES = [
    ("does_not_include", r"(?i)does\s+not\s+include", 0.95),
    ("do_not_include", r"(?i)do\s+not\s+include", 0.95),
    ("do_not_report", r"(?i)do\s+not\s+report", 0.95),
    ("not_reported", r"(?i)(?:is|are)\s+not\s+reported", 0.90),
    ("except", r"(?i)\bexcept\s+(?:for\s+)?(?:the\s+)?(?:amounts?|dividends?|distributions?)?", 0.85),
    ("excluding", r"(?i)\bexcluding\b", 0.90),
    ("other_than", r"(?i)\bother\s+than\b", 0.85),
    ("not_qualified", r"(?i)(?:is|are)\s+not\s+qualified", 0.90),
    ("not_eligible", r"(?i)(?:is|are)\s+not\s+eligible", 0.85),
]
TERM_EXCLUDES = [
    ("term_not_qualified", r"(?i)\b(?:is|are)\s+not\s+(qualified\s+dividend(?:s|\s+income)?)", 0.90),
    ("term_not_treated", r"(?i)not\s+treated\s+as\s+(qualified\s+dividend(?:s|\s+income)?)", 0.90),
]
EXCEPT_BELOW = r"(?i)except\s+as\s+provided\s+below"
EXCLUDED_FROM = [
    ("boxes_coref_exclude", rf"(?is)(?:^|\n|\.\s+)boxes\s+{KEYS}(?:.*?)do\s+not\s+include\s+(?:these\s+)?(?:amounts?\s+)?in\s+box(?:es)?\s+{KEYS}", 0.95),
]
APPLIES_IF = [
    ("report_if", r"(?i)report\s+(?:.+?\s+)?in\s+box\s+(\d+[a-z]?)\s+if\b", 0.90),
    ("include_when", r"(?i)include\s+(?:.+?\s+)?in\s+box\s+(\d+[a-z]?)\s+when\b", 0.90),
    ("if_report", r"(?i)if\s+.{1,60}?,\s*report\s+(?:.+?\s+)?in\s+box\s+(\d+[a-z]?)", 0.85),
    ("only_if", r"(?i)only\s+if\s+.{1,60}?,\s*include\s+(?:.+?\s+)?in\s+box\s+(\d+[a-z]?)", 0.85),
    ("holding_period_box", r"(?i)holding\s+period\s+requirement.{0,40}?box\s+(\d+[a-z]?)", 0.90),
    ("qualifies_for_box", r"(?i)qualifies\s+for.{0,60}?box\s+(\d+[a-z]?)", 0.85),
]
DEFINES = [
    ("box_is", r"(?i)box\s+(\d+[a-z]?)\s+(?:is|means)\b", 0.95),
    ("term_refers", r'(?i)\bthe\s+term\s+"?([A-Za-z][A-Za-z\s\-]{2,40})"?\s+refers\s+to\b', 0.90),
    ("noun_phrase_are_dividends", r"(?i)^([A-Z][A-Za-z][A-Za-z\s\-]{2,40})\s+are\s+dividends\s+(?:that|paid|received|from)\b", 0.85),
    ("noun_phrase_are_dividends_anywhere", r"(?i)([A-Za-z][A-Za-z\s\-]{2,40})\s+are\s+dividends\s+(?:that|paid|received|from)\b", 0.80),
    ("noun_phrase_are", r"(?i)^([A-Z][A-Za-z][A-Za-z\s\-]{2,40})\s+are\s+dividends\s+that\b", 0.85),
    ("includes_definition", r"(?i)^([A-Z][A-Za-z][A-Za-z\s\-]{2,40})\s+includes?\s+dividends\s+that\b", 0.85),
]
QUALIFIES = [
    ("includes_only", r"(?i)box\s+(\d+[a-z]?)\s+includes\s+only\b", 0.95),
    ("applies_to_box", r"(?i)for\s+box\s+(\d+[a-z]?),\s+this\s+applies\s+to\b", 0.90),
    ("only_portion", r"(?i)only\s+the\s+.+?\s+portion\s+.{0,40}?\s+reported\s+in\s+box\s+(\d+[a-z]?)", 0.85),
    ("limited_to", r"(?i)limited\s+to\s+amounts\s+reported\s+in\s+box\s+(\d+[a-z]?)", 0.85),
]
REQUIRES = [
    ("include_from", rf"(?i)include\s+amounts?\s+from\s+box(?:es)?\s+{KEYS}", 0.95),
    ("also_report", r"(?i)also\s+report\s+.{0,40}?\s+in\s+box\s+(\d+[a-z]?)", 0.85),
    ("see_box", r"(?i)see\s+box\s+(\d+[a-z]?)", 0.80),
    ("combine_with", r"(?i)combine\s+with\s+amounts?\s+in\s+box\s+(\d+[a-z]?)", 0.85),
]
AGGREGATES = [
    ("aggregates_amounts", rf"(?i)box\s+(\d+[a-z]?)\s+includes\s+(?:the\s+)?amounts?\s+(?:in|from|entered\s+in|reported\s+in)\s+box(?:es)?\s+{KEYS}", 0.95),
    ("aggregates_include_all", rf"(?i)include\s+(?:all\s+)?(?:the\s+)?amounts?\s+(?:shown|reported|entered)\s+in\s+box(?:es)?\s+{KEYS}", 0.95),
    ("aggregates_also_includes", r"(?is)also\s+includes?\s+.*?box\s+(\d+[a-z]?)", 0.90),
    ("aggregates_implicit", rf"(?i)includes?\s+(?:the\s+)?amounts?\s+(?:in|from|entered\s+in|reported\s+in)\s+box(?:es)?\s+{KEYS}", 0.90),
    ("aggregates_passive", rf"(?i)amounts?\s+(?:from|in)\s+box(?:es)?\s+{KEYS}\s+(?:are|is)\s+included", 0.90),
    ("aggregates_this", rf"(?i)this\s+(?:amount|total|figure)\s+includes?\s+(?:the\s+)?(?:amounts?\s+)?(?:in|from)?\s*box(?:es)?\s+{KEYS}", 0.85),
]
SUBSET_OF = [
    ("subset_enter_included", r"(?i)enter\s+(?:any\s+)?(?:the\s+)?amounts?\s+(?:included|reported|entered|shown)\s+in\s+box\s+(\d+[a-z]?)(?:\s+that\s+(?:is|are))?", 0.95),
    ("subset_included_in", r"(?i)this\s+(?:amount|total)\s+is\s+included\s+in\s+(?:the\s+)?(?:amount\s+)?(?:reported\s+in\s+)?box\s+(\d+[a-z]?)", 0.95),
    ("subset_amount_in", r"(?i)(?:the\s+)?amount\s+(?:is\s+)?included\s+in\s+box\s+(\d+[a-z]?)", 0.90),
]
INCLUDES = [
    ("reported_in_both", r"(?i)reported\s+in\s+both\s+box(?:es)?\s+(\d+[a-z]?)\s+and\s+(\d+[a-z]?)", 0.85),
    ("also_includes", rf"(?i)also\s+includes?\s+(?:the\s+)?(?:in|from|entered\s+in)?\s*box(?:es)?\s+{KEYS}", 0.85),
]
PORTION_OF = [
    ("any_part_of_box", r"(?i)(?:if\s+)?any\s+part\s+of\s+(?:the\s+)?(?:amount|total|dividends?|distribution|gain|income)?\s*(?:reported\s+in\s+)?box\s+(\d+[a-z]?)", 0.95),
    ("some_of_box", r"(?i)some\s+of\s+(?:the\s+)?(?:amount|total|dividends?|distribution|gain|income)?\s*(?:reported\s+in\s+)?box\s+(\d+[a-z]?)", 0.90),
    ("portion_of_reported", r"(?i)(?:the\s+)?portion\s+of\s+(?:the\s+)?(?:amount|total|distribution|dividends?|gain|income)\s+reported\s+in\s+box\s+(\d+[a-z]?)", 0.90),
    ("box_attributable", r"(?i)(?:reported|entered|shown)\s+in\s+box\s+(\d+[a-z]?)\s+(?:is|are)\s+attributable\s+to", 0.90),
]
SUBSET_CUES = r"(?i)\bany\s+part\s+of\b|\bpart\s+of\b|\bportion\s+of\b|\bsome\s+of\b|\bto\s+the\s+extent\b|\battributable\s+to\b|\bthe\s+qualified\s+portion\b|\bonly\s+the\s+portion\b|\bsubset\s+of\b"
NARRATION = r"(?i)\bwas\s+determined\b|\bdetermined\s+by\b|\bwas\s+calculated\b|\bhas\s+been\s+allocated\b|\bwas\s+allocated\b"
GATING = [
    ("gating_only_should", rf"(?i)only\s+([A-Za-z\s]+?)\s+should\s+complete\s+box(?:es)?\s+{KEYS}", 0.95),
    ("gating_apply_only", rf"(?i)box(?:es)?\s+{KEYS}\s+appl(?:y|ies)\s+only\s+to\s+([A-Za-z\s]+)", 0.90),
    ("gating_unless", rf"(?i)do\s+not\s+complete\s+box(?:es)?\s+{KEYS}\s+unless\b", 0.90),
    ("gating_only_if", rf"(?i)complete\s+box(?:es)?\s+{KEYS}\s+only\s+if\b", 0.90),
]
FALLBACK = [
    ("fallback_impractical", r"(?i)(?:include|report|enter)\s+(?:.*?)\s+for\s+which\s+it\s+is\s+impractical\s+(?:to\s+determine|for\s+the\s+[A-Za-z]+\s+to\s+determine)", 0.95),
    ("fallback_unable", r"(?i)if\s+you\s+(?:are\s+)?unable\s+to\s+determine\s+.*?(?:by\s+the\s+time|before)\s+(?:you\s+must\s+)?file", 0.90),
    ("fallback_entire", r"(?i)report\s+(?:the\s+)?entire\s+(?:amount|distribution)\s+as\b", 0.85),
    ("fallback_even_if", r"(?i)include\s+(?:.*?)\s+even\s+if\s+(?:the\s+)?(?:holding\s+period|requirement|condition)", 0.90),
]


def java(pattern: str) -> str:
    """The expression with Unicode classes and case folding, as Java's engine needs them spelled out."""
    if pattern.startswith("(?i)"):
        return "(?iuU)" + pattern[4:]
    return pattern if pattern.startswith("(?") and pattern[2] not in ":=!<" else "(?U)" + pattern
