"""Start-anchored text classifiers (semantic types, date-like text) as built-in expressions.

Classification happens on the text rendering of a value. Python's ``re.match`` anchors
at the start only, so every pattern is wrapped as ``(?i)^(?:...)``; the same string works
for Spark ``rlike`` (Java regex) and for DuckDB ``regexp_matches`` (RE2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: must equal the reference's classifier patterns and label order. ---
# All are case-insensitive and anchored at the start of the text only.
REFERENCE_PATTERNS = {
    "date": r"[0-9]{4}.[0-9]{2}.[0-9]{2}.*",
    "date_alt": r"[0-9]{2}.[0-9]{2}.[0-9]{4}.*",
    "a_numeric": r"[A-Za-z0-9]+",
    "text": r"[A-Za-z]+",
    "float": r"[0-9]*\.[0-9]+",
    "int": r"[0-9]+",
    "phone_num": r"\+[0-9]+.*",
    "email": r"[A-Za-z0-9]+@",
}
REFERENCE_LABEL_ORDER = ("date", "phone_num", "email", "text", "float", "int", "a_numeric")
# --- end of fixed values ---

# Our stricter defaults (see SURVEY B3 / B19): a date needs real separators, and an
# e-mail local part may hold dots, underscores, percent, plus and minus.
STRICT_OVERRIDES = {
    "date": r"[0-9]{4}[-./ ][0-9]{2}[-./ ][0-9]{2}.*",
    "date_alt": r"[0-9]{2}[-./ ][0-9]{2}[-./ ][0-9]{4}.*",
    "email": r"[A-Za-z0-9._%+-]+@",
}
# Opt-in label for text that mixes letters and digits in its leading token.
MIXED_PATTERN = r"[A-Za-z0-9]*([A-Za-z][0-9]|[0-9][A-Za-z])"


def patterns(strict: bool = True) -> dict[str, str]:
    p = dict(REFERENCE_PATTERNS)
    if strict:
        p.update(STRICT_OVERRIDES)
    return p


def anchored(pattern: str) -> str:
    return f"(?i)^(?:{pattern})"


def label_rules(strict: bool = True, mixed: bool = False) -> list[tuple[str, list[str]]]:
    """Ordered (label, [anchored patterns]) pairs; the first label with a match wins."""
    p = patterns(strict)
    rules: list[tuple[str, list[str]]] = []
    for label in REFERENCE_LABEL_ORDER:
        if label == "date":
            rules.append(("date", [anchored(p["date"]), anchored(p["date_alt"])]))
        elif label == "text" and mixed:
            rules.append(("a_numeric", [anchored(MIXED_PATTERN)]))
            rules.append(("text", [anchored(p["text"])]))
        else:
            rules.append((label, [anchored(p[label])]))
    return rules


def semantic_type(text: Column, strict: bool = True, mixed: bool = False) -> Column:
    """Label of the first matching rule, null when nothing matches or the text is null."""
    expr = None
    for label, pats in label_rules(strict, mixed):
        cond = None
        for pat in pats:
            m = text.rlike(pat)
            cond = m if cond is None else (cond | m)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def is_date_text(text: Column, strict: bool = True) -> Column:
    p = patterns(strict)
    return text.rlike(anchored(p["date"])) | text.rlike(anchored(p["date_alt"]))


def sql_semantic_type(text_sql: str, strict: bool = True, mixed: bool = False) -> str:
    """The same classifier as an ANSI ``CASE`` for a DuckDB oracle."""
    parts = []
    for label, pats in label_rules(strict, mixed):
        cond = " OR ".join(f"regexp_matches({text_sql}, '{pat}')" for pat in pats)
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def sql_is_date_text(text_sql: str, strict: bool = True) -> str:
    p = patterns(strict)
    return (
        f"(regexp_matches({text_sql}, '{anchored(p['date'])}') OR "
        f"regexp_matches({text_sql}, '{anchored(p['date_alt'])}'))"
    )
