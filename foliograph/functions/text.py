"""Text expressions with the whitespace and case rules the data model expects.

`\\s` of the JVM's patterns knows ASCII only and trim() blanks only, so both are spelt out here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Enums of the knowledge graph, salience from low to high.
ENTITY_TYPES = [
    "Tax", "Duty", "Levy", "Relief", "Allowance", "Exemption", "Deduction", "Credit", "Charge", "Penalty", "Rate", "Threshold", "Legislation",
    "StatutoryProvision", "CaseLaw", "Regulation", "Treaty", "Form", "Scheme", "Procedure", "Obligation", "Deadline", "Organisation",
    "TaxpayerType", "Asset", "Income", "Expense", "AccountingConcept", "AccountingStandard", "FinancialInstrument", "Transaction", "Valuation",
    "Jurisdiction", "Definition", "Threshold_Test", "Other",
]
RELATIONSHIP_TYPES = [
    "DEFINED_BY", "GOVERNED_BY", "APPLIES_TO", "EXCLUDES", "EXEMPTS", "RELIEVES", "REQUIRES", "CALCULATED_FROM", "SUBJECT_TO", "PART_OF",
    "SUPERSEDES", "REPLACED_BY", "REFERENCES", "HAS_RATE", "HAS_THRESHOLD", "HAS_DEADLINE", "QUALIFIES_FOR", "ADMINISTERED_BY", "PENALTY_FOR",
    "REPORTED_ON", "MEASURED_BY", "EXAMPLE_OF", "RELATED_TO",
]
SALIENCE = ["mentioned", "secondary", "primary"]


def strip(c: Column) -> Column:
    """Without Unicode blanks at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of Unicode blanks as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean(c: Column) -> Column:
    """Runs of blanks, tabs, no-break and zero-width blanks as one blank, ends stripped; line ends stay."""
    return strip(F.regexp_replace(c, r"[ \t\u00A0\u200B]+", " "))


def word_count(c: Column) -> Column:
    """Number of runs of non-blank characters; 0 for null and empty text."""
    return F.coalesce(F.regexp_count(c, F.lit(r"(?U)\S+")), F.lit(0))


def norm(c: Column) -> Column:
    """Key of a name: lower case, one leading article off, curly quotes straight, other characters than a-z, digits
    and '&./§- as blanks, blanks collapsed, blanks and dots off the ends; empty for null."""
    s = F.lower(strip(F.coalesce(c, F.lit(""))))
    s = F.regexp_replace(s, r"(?U)^(the|a|an)\s+", "")
    s = F.regexp_replace(s, "[‘’“”]", "'")
    s = F.regexp_replace(s, r"[^a-z0-9'&./§\- ]+", " ")
    return F.regexp_replace(F.regexp_replace(s, r"\s+", " "), r"^[ .]+|[ .]+$", "")


def last_path_segment(c: Column, default: str = "manual") -> Column:
    """Slug of a link: its last segment without closing slashes; the default if there is none."""
    return F.coalesce(F.nullif(F.element_at(F.split(F.regexp_replace(c, "/+$", ""), "/"), -1), F.lit("")), F.lit(default))


def heading(title: Column, section_id: Column) -> Column:
    """Title without the identifier it starts with, in any case, and the dash or colon after it; else the title."""
    rest = strip(F.regexp_replace(F.substring(title, F.length(section_id) + 1, F.length(title)), r"^[ \-–—:]+", ""))
    cut = F.startswith(F.upper(title), F.upper(section_id)) & (F.length(section_id) > 0)
    return F.when(cut & (rest != ""), rest).otherwise(title)


def snippet(c: Column, n: int = 400) -> Column:
    return F.left(c, F.lit(n))


def ellipsis(c: Column, n: int = 40) -> Column:
    """Collapsed text of at most n characters, the last an ellipsis if it was cut."""
    s = collapse(c)
    return F.when(F.length(s) > n, F.concat(F.rtrim(F.left(s, F.lit(n - 1))), F.lit("…"))).otherwise(s)


def content_key(parts: list[Column], length: int = 32) -> Column:
    """First hex digits of the SHA-256 of the parts joined by NUL characters."""
    nul = F.char(F.lit(0))
    joined = [x for p in parts for x in (nul, F.coalesce(p.cast("string"), F.lit("")))][1:]
    return F.left(F.sha2(F.concat(*joined), 256), F.lit(length))


def salience_rank(c: Column) -> Column:
    """3 for primary, 2 for secondary, 1 for mentioned, 0 for anything else and null."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, SALIENCE)), c), F.lit(0)).cast("int")
