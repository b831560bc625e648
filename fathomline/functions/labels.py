"""Labels, icons and prompts of the filing tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Class names, icons, prompt texts and score limits.
LABELS = [
    "M&A", "IPO", "Restructuring", "Executive_Change", "Financial_Restatement", "Material_Event", "Other",
]
CLASS_ICONS = {"M&A": "🤝", "IPO": "🚀", "Restructuring": "🏗️"}
SENTIMENT_ICONS = {"positive": "📈", "negative": "📉"}
DEFAULT_ICON = "📄"
SCORE_LIMIT = 0.2
SUMMARY_PROMPT = (
    "Summarize this SEC filing in 2-3 sentences, focusing on key business events, "
    "M&A activity, or material changes:\n\n"
)
CLASSIFY_PROMPT = (
    "Classify this SEC filing into ONE of these categories: M&A, IPO, Restructuring, "
    "Executive_Change, Financial_Restatement, Material_Event, Other. "
    "Respond with only the category name.\n\n"
)


def sentiment_label(score: Column) -> Column:
    return (
        F.when(score > SCORE_LIMIT, "positive")
        .when(score < -SCORE_LIMIT, "negative")
        .otherwise("neutral")
    )


def filing_icon(classification: Column, sentiment: Column) -> Column:
    """The class decides before the sentiment."""
    icon = F
    for value, mark in CLASS_ICONS.items():
        icon = icon.when(classification == value, mark)
    for value, mark in SENTIMENT_ICONS.items():
        icon = icon.when(sentiment == value, mark)
    return icon.otherwise(DEFAULT_ICON)


def prompt(instruction: str, text: Column, chars: int | None = None) -> Column:
    return F.concat(F.lit(instruction), capped(text, chars))


def capped(text: Column, chars: int | None) -> Column:
    """The first ``chars`` characters, or all of them."""
    return text if chars is None else F.substring(text, 1, chars)


def first_of(cases: Sequence[tuple[Column, object]], default) -> Column:
    """Value of the first case that holds; ``default`` if none does or there are no cases."""
    if not cases:
        return F.lit(default)
    found = F
    for hit, value in cases:
        found = found.when(hit, value)
    return found.otherwise(default)


def known_label(reply: Column, labels: Sequence[str] = tuple(LABELS)) -> Column:
    """Map a free-form reply onto the label set; anything else is the last label."""
    cleaned = F.regexp_replace(F.lower(F.trim(F.regexp_replace(reply, r"[\s.\"'`]+", " "))), " ", "_")
    return first_of([(cleaned == name.lower(), name) for name in labels], labels[-1] if labels else None)


def portable(pattern: str) -> str:
    """``pattern`` with ASCII word boundaries and Unicode white space in ``\\b`` and ``\\s``.

    Java's own ``\\b`` follows Unicode letters and its ``\\s`` is ASCII, the other way
    round than in the script dialect the trigger patterns come from.  A boundary before
    a literal word character needs only the cheaper look-behind.
    """
    anywhere = r"(?:(?<=\w)(?!\w)|(?<!\w)(?=\w))"
    space = r"\s\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
    with_starts = re.sub(r"\\b(?=\w)", lambda m: r"(?<!\w)", pattern)
    bounded = with_starts.replace(r"\b", anywhere)
    in_class = re.sub(r"(\[[^\]]*)\\s([^\]]*\])", lambda m: m[1] + "<space>" + m[2], bounded)
    return in_class.replace(r"\s", f"[{space}]").replace("<space>", space)


def first_match(text: Column, rules: Sequence[tuple[str, str]], default: str | None) -> Column:
    """Label of the first rule whose pattern occurs in ``text``, ignoring case."""
    return first_of([(text.rlike(f"(?i){pattern}"), name) for name, pattern in rules], default)


def settings_rows(table: DataFrame, most: int) -> list:
    """Rows of a settings table that becomes part of an expression; more than ``most`` is an error."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a settings table holds at most {most} rows")
    return rows
