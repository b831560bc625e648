"""Conversation triggers and review-comment triage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.labels import capped, first_of, portable, settings_rows

# Trigger patterns by family, in order of precedence.
CORRECTION = [
    r"^no[,.]?\s+",
    r"\bno[,.]?\s+(that's|thats|it's|its|actually|wait|make|don't|do|use|I)\b",
    r"\bthat's\s+(wrong|incorrect|not right|not what)\b",
    r"\bactually[,.]?\s+(it|the|you|we|I)\b",
    r"\byou\s+(misunderstood|missed|got it wrong|are wrong)\b",
    r"\bthat's\s+not\s+(what|how|correct)\b",
    r"\bI\s+(meant|mean|was asking|wanted)\b",
    r"\blet me clarify\b",
    r"\bto be clear\b",
    r"\bnot quite\b",
    r"\binstead[,.]?\s+(use|do|try|make)\b",
    r"\bdon't\s+(do|use|make)\s+that\b",
]
DISAGREEMENT = [
    r"\bI\s+disagree\b",
    r"\bI\s+don't\s+think\s+(that's|so)\b",
    r"\bthat\s+doesn't\s+(seem|sound|make sense)\b",
    r"\bI'd\s+prefer\b",
    r"\bI\s+think\s+we\s+should\b",
    r"\bwhy\s+(not|would|wouldn't)\b",
    r"\bbut\s+what\s+about\b",
]
CLARIFICATION = [
    r"\bwhat\s+I\s+(mean|meant)\s+is\b",
    r"\bto\s+clarify\b",
    r"\bmore\s+specifically\b",
    r"\bin\s+other\s+words\b",
    r"\bwhat\s+I'm\s+(asking|looking for|trying)\b",
]
DISCOVERY = [
    r"\bit\s+turns\s+out\b",
    r"\bI\s+(found|discovered|realized|noticed)\b",
    r"\bwe\s+(found|discovered|realized|noticed)\b",
    r"\bthe\s+problem\s+(was|is|turned out)\b",
    r"\bthe\s+(issue|bug|error)\s+(was|is)\b",
    r"\binteresting(ly)?\b",
    r"\bturns\s+out\b",
    r"\bthe\s+lesson[:\s]",
    r"\bkey\s+(detail|insight|learning)\b",
]
DECISION = [
    r"\blet's\s+(go|use|do|try)\s+with\b",
    r"\bwe('ll| will| should)\s+(use|go|do)\b",
    r"\bI('ve| have)\s+decided\b",
    r"\bthe\s+decision\s+is\b",
    r"\blet's\s+proceed\s+with\b",
]
# Fixed values: (family, confidence, patterns).
TRIGGER_FAMILIES = [
    ("correction", "high", CORRECTION),
    ("disagreement", "medium", DISAGREEMENT),
    ("clarification", "medium", CLARIFICATION),
    ("discovery", "high", DISCOVERY),
    ("decision", "medium", DECISION),
]
# Reviewer families and the account names that belong to them.
REVIEWER_FAMILIES = [
    ("coderabbit", ["coderabbitai[bot]", "coderabbit[bot]"]),
    ("bugbot", ["cursor-bugbot[bot]", "bugbot[bot]"]),
    ("greptile", ["greptile[bot]", "greptile-bot"]),
    ("copilot", ["github-actions[bot]", "copilot[bot]"]),
]

Families = Sequence[tuple[str, str, Sequence[str]]]


def families_from(table: DataFrame) -> list[tuple[str, str, list[str]]]:
    """Trigger families of a table (family, priority, confidence, regex) in order of priority."""
    families: dict[str, tuple[str, str, list[str]]] = {}
    for row in sorted(settings_rows(table, 2_000), key=lambda row: row["priority"]):
        families.setdefault(row["family"], (row["family"], row["confidence"], []))[2].append(row["regex"])
    return list(families.values())


def trigger(text: Column, families: Families = TRIGGER_FAMILIES) -> Column:
    """Struct (type, confidence) of the first family with a matching pattern, else null.

    A family without patterns never matches.
    """
    cases = [
        (
            text.rlike("(?i)" + "|".join(f"(?:{portable(p)})" for p in patterns)),
            F.struct(F.lit(family).alias("type"), F.lit(confidence).alias("confidence")),
        )
        for family, confidence, patterns in families
        if patterns
    ]
    return first_of(cases, None).cast("struct<type:string,confidence:string>")


def carry_forward(
    df: DataFrame, key: str, order: str, value: Column, out: str, chunk: int = 4096
) -> DataFrame:
    """Last non-null ``value`` of the earlier rows of ``key``; ``order`` is an integer position.

    A key is cut into chunks of ``chunk`` positions.  A window inside each chunk
    finds the value where the chunk has one; the last value per chunk is aggregated
    separately, carried over the chunks, and fills the rows before the first one.
    With (key, order) unique no window holds more than ``chunk`` full rows, and the
    carry sees one short row per chunk.
    """
    rows = df.withColumns({"_chunk": F.floor(F.col(order) / chunk), "_value": value})
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.groupBy(key, "_chunk").agg(
        F.max(F.when(F.col("_value").isNotNull(), F.struct(order, "_value"))).alias("_last")
    )
    carried = last.select(
        key, "_chunk", F.last("_last._value", ignorenulls=True).over(across).alias("_carried")
    )
    local = rows.withColumn("_local", F.last("_value", ignorenulls=True).over(inside))
    return local.join(carried, [key, "_chunk"], "left").select(
        *df.columns, F.coalesce("_local", "_carried").alias(out)
    )


def conversation_triggers(
    turns: DataFrame,
    families: Families = TRIGGER_FAMILIES,
    since=None,
    min_len: int = 10,
    message_chars: int | None = None,
    context_chars: int | None = None,
    newest_first: bool = False,
) -> DataFrame:
    """User turns that match a trigger family, with the assistant text before them.

    Patterns read the whole turn; the reported message and context are cut only where
    ``message_chars`` and ``context_chars`` say so.
    With ``since`` (needs a ``ts`` column) older turns are skipped but still give
    context.  ``newest_first`` sorts by ``ts`` (undated last), then by conversation and
    turn from the end.
    """
    heard = F.when((F.col("role") == "assistant") & (F.length("text") > 0), capped(F.col("text"), context_chars))
    rows = carry_forward(turns, "conv_id", "turn", heard, "assistant_context")
    text = F.col("text")
    dense = F.length(F.trim(F.regexp_replace(text, portable(r"\s+"), " "))) >= F.length(text) * 0.5
    keep = (F.col("role") == "user") & (F.length(text) >= min_len) & dense
    if since is not None:
        keep = keep & (F.col("ts").isNull() | (F.col("ts") >= F.lit(since).cast("timestamp_ntz")))
    found = rows.where(keep).withColumn("_hit", trigger(text, families)).where(F.col("_hit").isNotNull())
    stamp = ["ts"] if "ts" in turns.columns else []
    out = found.select(
        "conv_id", "turn", *stamp, "_hit.type", "_hit.confidence",
        capped(text, message_chars).alias("user_message"), "assistant_context",
    )
    latest = [F.desc_nulls_last(c) for c in stamp]
    return out.orderBy(*latest, F.desc("conv_id"), F.desc("turn")) if newest_first else out


def trigger_counts(triggers: DataFrame) -> DataFrame:
    """Triggers and conversations per trigger type."""
    return (
        triggers.groupBy("type")
        .agg(F.count("*").alias("triggers"), F.countDistinct("conv_id").alias("conversations"))
        .orderBy("type")
    )


def session_totals(turns: DataFrame) -> DataFrame:
    return turns.agg(
        F.countDistinct("conv_id").alias("sessions_analyzed"), F.count("*").alias("messages_analyzed")
    )


def flatten_content(content: Column) -> Column:
    """Text of a message whose content is a string or a JSON array of typed parts."""
    parts = F.from_json(content, "array<struct<type:string,text:string>>")
    texts = F.filter(parts, lambda p: (p["type"] == "text") & (F.length(p["text"]) > 0))
    joined = F.array_join(F.transform(texts, lambda p: p["text"]), "\n")
    return F.when(F.ltrim(content).startswith("["), joined).otherwise(content)


@dataclass(frozen=True)
class CommentRule:
    """A named predicate over review comments."""

    name: str
    pattern: str | None = None
    ignore_case: bool = False
    without: str | None = None
    reply: bool | None = None
    human: bool | None = None

    def column(self) -> Column:
        test = F.lit(True)
        if self.pattern is not None:
            test = test & F.col("body").rlike(("(?i)" if self.ignore_case else "") + self.pattern)
        if self.without is not None:
            test = test & ~F.col("body").rlike(self.without)
        if self.reply is not None:
            parent = F.col("in_reply_to_id")
            test = test & (parent.isNotNull() if self.reply else parent.isNull())
        if self.human is not None:
            bot = F.lower("user_login").contains("bot")
            test = test & (~bot if self.human else bot)
        return F.coalesce(test, F.lit(False))


# Noise rules and priority buckets of review comments.
NOISE_RULES = [
    CommentRule("confirmations", "review_comment_addressed", ignore_case=True),
    CommentRule("bot_confirmations", "Confirmed", ignore_case=True),
    CommentRule("thank_you_replies", "Thank you for", ignore_case=True, reply=True),
    CommentRule("learnings", "Learnings used", ignore_case=True, without="_⚠️|_🔴|_🟠|_🟡|_🔵|_🧹|_🛠️"),
    CommentRule("fingerprints", "fingerprinting:", ignore_case=True),
    CommentRule("human_fixed", "Fixed in commit", ignore_case=True, human=True),
]
PRIORITY_RULES = [
    CommentRule("critical", "_🔴 Critical_", reply=False),
    CommentRule("high", "_⚠️ Potential issue_.*_🟠 Major_", reply=False),
    CommentRule("medium", "_🟡 Minor_|_🛠️ Refactor suggestion_.*_🟠 Major_", reply=False),
    CommentRule("low", "_🔵 Trivial_|_🧹 Nitpick_", reply=False),
    CommentRule("human", reply=False, human=True),
]


def comment_triage(
    comments: DataFrame,
    noise: Sequence[CommentRule] = tuple(NOISE_RULES),
    priority: Sequence[CommentRule] = tuple(PRIORITY_RULES),
) -> DataFrame:
    """One row with a count per rule in one pass; the counts may overlap."""
    return comments.agg(
        F.count("*").alias("total"), *[F.count_if(r.column()).alias(r.name) for r in (*noise, *priority)]
    )


def with_priority(comments: DataFrame, priority: Sequence[CommentRule] = tuple(PRIORITY_RULES)) -> DataFrame:
    """Add the first matching priority bucket of each comment, null for none."""
    return comments.withColumn("priority", F.coalesce(*[F.when(r.column(), F.lit(r.name)) for r in priority]))


def unanswered(comments: DataFrame, id_col: str = "id", parent: str = "in_reply_to_id") -> DataFrame:
    """Top-level comments without a reply; a parent with many replies is one row in the join."""
    answered = comments.where(F.col(parent).isNotNull()).select(F.col(parent).alias(id_col)).distinct()
    return comments.where(F.col(parent).isNull()).join(answered, id_col, "left_anti")


def review_gate(comments: DataFrame) -> DataFrame:
    """One row: number of unanswered comments and whether the review is blocked."""
    return unanswered(comments).agg(F.count("*").alias("unanswered")).select(
        "unanswered", (F.col("unanswered") > 0).alias("blocked")
    )


def author_family(login: Column, families: Sequence[tuple[str, Sequence[str]]] = tuple(REVIEWER_FAMILIES)) -> Column:
    """Reviewer family of a login; other bots are ``unknown``, everybody else ``human``."""
    name = F.lower(F.coalesce(login, F.lit("unknown")))
    cases = []
    for label, accounts in families:
        hit = F.lit(False)
        for account in accounts:
            hit = hit | name.contains(account.lower().replace("[bot]", "", 1))
        cases.append((hit, label))
    cases.append((name.contains("[bot]") | name.contains("-bot"), "unknown"))
    return first_of(cases, "human")


def collect_comments(
    reviews: DataFrame,
    issues: DataFrame,
    families: Sequence[tuple[str, Sequence[str]]] = tuple(REVIEWER_FAMILIES),
    min_len: int = 50,
) -> DataFrame:
    """Both kinds of comments, long enough and by a known family; issue comments have no path."""
    both = reviews.unionByName(issues, allowMissingColumns=True)
    return (
        both.where(F.length("body") >= min_len)
        .withColumn("family", author_family(F.col("user_login"), families))
        .where("family <> 'unknown'")
    )


def family_counts(collected: DataFrame) -> DataFrame:
    return collected.groupBy("family").agg(F.count("*").alias("comments")).orderBy("family")
