"""Text providers: functions from a text column to a result column.

The built-in ones are deterministic expressions evaluated per row, so enriching
documents never shuffles their text.  ``external_text`` wraps a user's own client
in the same shape.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.arrays import let, run_lengths
from fathomline.functions.labels import LABELS, first_match, known_label, settings_rows

Provider = Callable[[Column], Column]

_WORD_GAP = r"[^a-z]+"
_CUT = "\u0001"

# Default rule, lexicon and entity vocabularies; all of them can be replaced.
DEFAULT_LEXICON = {
    "gain": 1.0, "growth": 1.0, "improve": 1.0, "increase": 1.0, "profit": 1.0, "record": 1.0, "strong": 1.0,
    "decline": -1.0, "default": -1.0, "impairment": -1.0, "loss": -1.0, "lawsuit": -1.0, "weak": -1.0,
}
DEFAULT_RULES = [
    ("M&A", r"\b(acquisition|merger|buyout|acquire[sd]?)\b"),
    ("IPO", r"\b(initial public offering|ipo)\b"),
    ("Restructuring", r"\b(restructuring|layoffs?|reorgani[sz]ation)\b"),
    ("Executive_Change", r"\b(resign(s|ed|ation)|appoint(s|ed|ment)|successor)\b"),
    ("Financial_Restatement", r"\b(restat(e|es|ed|ement|ements)|non-reliance)\b"),
    ("Material_Event", r"\b(material (event|agreement|change)|default)\b"),
]
DEFAULT_ENTITY_PATTERNS = {
    "companies": r"\b(?:[A-Z][A-Za-z&]+ ){1,3}(?:Inc|Corp|Corporation|LLC|Ltd|Company|Group)\b",
    "executives": r"\b(?:CEO|CFO|COO|CTO|Chairman|President|Director) [A-Z][a-z]+(?: [A-Z][a-z]+)?",
    "financial_amounts": r"\$[0-9][0-9,]*(?:\.[0-9]+)?(?: (?:thousand|million|billion))?",
}
DEFAULT_PLACES = ["New York", "London", "California", "Texas", "Delaware", "Tokyo", "Paris", "Berlin"]
ENTITY_FIELDS = ["companies", "executives", "financial_amounts", "locations"]


def lexicon_sentiment(lexicon: Mapping[str, float] | None = None) -> Provider:
    """(positive - negative) / (positive + negative) term weight; 0 without any term.

    Words are counted with one hash-set test per distinct weight.
    """
    by_weight: dict[float, list[str]] = {}
    for term, weight in (DEFAULT_LEXICON if lexicon is None else lexicon).items():
        by_weight.setdefault(float(weight), []).append(term)

    def weight_of(words: Column, weight: float) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(by_weight[weight]))) * abs(weight)

    def score(text: Column) -> Column:
        def from_words(words: Column) -> Column:
            hits = {weight: weight_of(words, weight) for weight in by_weight}
            up = sum((h for w, h in hits.items() if w > 0), F.lit(0.0))
            down = sum((h for w, h in hits.items() if w < 0), F.lit(0.0))
            return let(
                F.struct(up.alias("up"), down.alias("down")),
                lambda s: F.coalesce(F.try_divide(s.up - s.down, s.up + s.down), F.lit(0.0)),
            )

        return let(F.split(F.lower(text), _WORD_GAP), from_words)

    return score


def rule_classifier(rules: Sequence[tuple[str, str]] | None = None, default: str = "Other") -> Provider:
    """First matching (label, pattern) rule in the given order."""
    chosen = DEFAULT_RULES if rules is None else rules
    return lambda text: first_match(text, chosen, default)


def normalised(provider: Provider, labels: Sequence[str] = tuple(LABELS)) -> Provider:
    """``provider`` with its free-form replies mapped onto the label set."""
    return lambda text: known_label(provider(text), labels)


def lexicon_from(table: DataFrame) -> dict[str, float]:
    """Lexicon of a table (term, weight); larger ones go to ``sentiment_by_join``."""
    return {row["term"]: row["weight"] for row in settings_rows(table, 20_000)}


def rules_from(table: DataFrame) -> list[tuple[str, str]]:
    """Rules of a table (label, priority, regex) in order of priority."""
    rows = settings_rows(table, 2_000)
    return [(row["label"], row["regex"]) for row in sorted(rows, key=lambda row: row["priority"])]


def sentences(text: Column) -> Column:
    """Split after sentence marks and at line breaks; blanks are dropped."""
    marked = F.regexp_replace(F.regexp_replace(text, r"([.!?])\s+", "$1" + _CUT), r"[\r\n]+", _CUT)
    return F.filter(F.transform(F.split(marked, _CUT), lambda s: F.trim(s)), lambda s: s != "")


def extractive_summary(count: int = 3, min_letters: int = 4) -> Provider:
    """The ``count`` sentences sharing most terms with other sentences, in text order.

    A term is a word of at least ``min_letters`` letters; it counts when it occurs in
    two or more sentences, once per sentence.  Earlier sentences win ties.  All steps
    sort arrays inside the row, so the work is n log n in the length of the text.
    """

    # One cached pattern finds the long words; splitting compiles its pattern again for every sentence.
    word = rf"\p{{L}}{{{max(min_letters, 1)},}}"

    def terms(sentence: Column) -> Column:
        return F.array_distinct(F.regexp_extract_all(F.lower(sentence), F.lit(word), F.lit(0)))

    def from_sentences(parts: Column) -> Column:
        pairs = F.flatten(
            F.transform(
                parts,
                lambda s, i: F.transform(terms(s), lambda w: F.struct(w.alias("term"), i.alias("at"))),
            )
        )
        shared = let(
            F.sort_array(pairs),
            lambda a: F.filter(
                a,
                lambda p, i: F.get(a, i - 1)["term"].eqNullSafe(p.term) | F.get(a, i + 1)["term"].eqNullSafe(p.term),
            ),
        )
        # Every sentence is listed once more, so that those without shared terms rank too.
        places = F.concat(
            F.transform(shared, lambda p: p["at"]), F.transform(parts, lambda s, i: i)
        )
        ranked = F.sort_array(
            F.transform(
                run_lengths(F.sort_array(places)),
                lambda r: F.struct((-r["n"]).alias("rank"), r["value"].alias("at")),
            )
        )
        best = F.sort_array(F.transform(F.slice(ranked, 1, count), lambda r: r["at"]))
        return F.array_join(F.transform(best, lambda i: F.get(parts, i)), " ")

    def summary(text: Column) -> Column:
        return let(
            sentences(text),
            lambda parts: F.when(F.size(parts) <= count, F.array_join(parts, " ")).otherwise(
                from_sentences(parts)
            ),
        )

    return summary


def java_literal(text: str) -> str:
    """A pattern that matches ``text`` itself."""
    return re.sub(r"([^\w\s])", r"\\\1", text)


def pattern_entities(
    patterns: Mapping[str, str] | None = None, places: Sequence[str] | None = None
) -> Provider:
    """Struct of four sorted distinct arrays: companies, executives, amounts, locations."""
    chosen = DEFAULT_ENTITY_PATTERNS if patterns is None else patterns
    names = sorted(DEFAULT_PLACES if places is None else places, key=lambda p: (-len(p), p))
    if names:
        chosen = {**chosen, "locations": r"(?<!\w)(?:" + "|".join(map(java_literal, names)) + r")(?!\w)"}

    def entities(text: Column) -> Column:
        return F.struct(
            *[
                F.sort_array(
                    F.array_distinct(F.regexp_extract_all(text, F.lit(chosen[field]), F.lit(0)))
                    if field in chosen
                    else F.when(text.isNotNull(), F.array().cast("array<string>"))
                ).alias(field)
                for field in ENTITY_FIELDS
            ]
        )

    return entities


def parse_entities(reply: Column) -> Column:
    """Typed form of an entity reply given as JSON text."""
    return F.from_json(reply, ", ".join(f"{f} array<string>" for f in ENTITY_FIELDS))


def external_text(
    open_client: Callable[[], Callable[[Iterable[str]], Iterable]], result_type: str = "string"
) -> Provider:
    """Provider around a user's own model client.

    ``open_client`` runs once per task and returns a function from a batch of texts
    to as many results; batches arrive through Arrow.
    """

    @F.pandas_udf(result_type)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        client = open_client()
        for batch in batches:
            yield pd.Series(list(client(batch)))

    return lambda text: call(text)


CALL = "struct<reply:string,error:string,attempts:int>"


def external_calls(open_client: Callable[[], Callable[[str], str]], attempts: int = 3) -> Provider:
    """Provider that calls a client text by text and keeps what went wrong.

    ``open_client`` runs once per task and returns a function from a text to its reply.
    A call that raises is repeated up to ``attempts`` times; the result has the reply, or
    the last error, and the number of calls.  One failing text fails no other.
    """

    @F.pandas_udf(CALL)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = open_client()
        for batch in batches:
            rows = []
            for text in batch:
                reply = error = None
                for used in range(1, attempts + 1):
                    try:
                        reply, error = client(text), None
                        break
                    except Exception as problem:
                        error = f"{type(problem).__name__}: {problem}"
                rows.append((reply, error, used))
            yield pd.DataFrame(rows, columns=["reply", "error", "attempts"])

    return lambda text: call(text)
