"""Roll-ups and dashboards over enriched filings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.labels import filing_icon
from fathomline.operators.dates import as_of_column, since
from fathomline.operators.ranks import running_total

# The terms of the deal spotlight and the briefing instruction.
DEAL_TERMS = ["acquisition", "merger", "buyout"]
BRIEFING_PROMPT = (
    "You are a financial analyst. Write a concise executive briefing (3 paragraphs) summarizing "
    "these recent SEC filings. Focus on trends, notable M&A activity, and market sentiment. "
    "Be professional and data-driven.\n\nRecent Filings:\n"
)


def sentiment_trends(df: DataFrame) -> DataFrame:
    """Filings, mean score and label counts per company and month."""
    labels = {f"{v}_count": F.count_if(F.col("sentiment") == v) for v in ("positive", "negative", "neutral")}
    return (
        df.groupBy("company_name", F.trunc("filing_date", "MM").alias("month"))
        .agg(
            F.count("*").alias("num_filings"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            *[c.alias(n) for n, c in labels.items()],
        )
        .orderBy("company_name", F.desc("month"))
    )


def classification_share(df: DataFrame, digits: int = 2) -> DataFrame:
    """Filings per class and their percentage of all filings.

    The total is a scalar, so classes may be any in number.
    """
    counts = df.groupBy("classification").agg(F.count("*").alias("count"))
    total = df.agg(F.count("*").alias("n")).scalar()
    share = F.round((F.col("count") * 100.0 / total).cast("double"), digits)
    return counts.select("classification", "count", share.alias("percent")).orderBy(
        F.desc("count"), "classification"
    )


def classification_members(
    df: DataFrame, page_size: int = 1000, group: str = "classification", member: str = "company_name"
) -> DataFrame:
    """Members of each class in order, duplicates kept, as comma-separated text.

    The list of a class is cut into numbered pages of ``page_size`` names; joined in
    page order they give the whole list.  Names are counted first, so only
    (class, name, count) rows are ordered, and no row or task ever holds more than a
    page.
    """
    counts = df.where(F.col(member).isNotNull()).groupBy(group, member).agg(F.count("*").alias("n"))
    placed = running_total(counts, [group, member], "n", "_before")
    base = placed.groupBy(group).agg(F.min("_before").alias("_base")).withColumnRenamed(group, "_group")
    start = F.col("_before") - F.col("_base")
    spans = placed.join(base, F.col(group).eqNullSafe(F.col("_group"))).select(
        group, member, start.alias("start"), (start + F.col("n")).alias("stop")
    )
    pages = spans.select(
        "*",
        F.explode(
            F.sequence(
                F.floor(F.col("start") / page_size), F.floor((F.col("stop") - 1) / page_size)
            )
        ).alias("page"),
    )
    low = F.greatest(F.col("start"), F.col("page") * page_size)
    high = F.least(F.col("stop"), (F.col("page") + 1) * page_size)
    names = F.array_join(F.array_repeat(F.col(member), (high - low).cast("int")), ", ")
    return (
        pages.withColumn("_names", names)
        .groupBy(group, (F.col("page") + 1).alias("page"))
        .agg(
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct(member, "_names"))), lambda r: r["_names"]),
                ", ",
            ).alias("companies")
        )
        .orderBy(group, "page")
    )


def sentiment_heatmap(df: DataFrame) -> DataFrame:
    """Mean score per week (from Monday) and class."""
    return (
        df.groupBy(F.trunc("filing_date", "WEEK").alias("week"), "classification")
        .agg(F.avg("sentiment_score").alias("avg_sentiment"))
        .orderBy(F.desc("week"), "classification")
    )


def filing_summary_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_filings_processed"),
        F.countDistinct("company_name").alias("unique_companies"),
        F.max("processed_at").alias("last_processed"),
        F.avg("sentiment_score").alias("avg_sentiment"),
        F.count_if(F.col("classification") == "M&A").alias("ma_count"),
        F.count_if(F.col("classification") == "IPO").alias("ipo_count"),
    )


def filing_dashboard(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Dashboard rows with an icon; ``ordered`` adds the newest-first global sort."""
    rows = df.select(
        "filing_id", "company_name", "form_type", "filing_date", "ai_summary", "sentiment",
        "sentiment_score", "classification",
        filing_icon(F.col("classification"), F.col("sentiment")).alias("icon"),
        "processed_at",
    )
    return rows.orderBy(F.desc_nulls_last("filing_date"), "filing_id") if ordered else rows


def deal_activity(
    df: DataFrame,
    terms: Sequence[str] = tuple(DEAL_TERMS),
    label: str = "M&A",
    case_sensitive: bool = False,
    ordered: bool = False,
) -> DataFrame:
    """Filings of class ``label`` or whose summary contains one of ``terms``."""
    summary = F.col("ai_summary") if case_sensitive else F.lower("ai_summary")
    hit = F.col("classification") == label
    for term in terms:
        hit = hit | summary.contains(term if case_sensitive else term.lower())
    rows = df.where(hit).select(
        "filing_id", "company_name", "filing_date", "ai_summary", "sentiment", "sentiment_score"
    )
    return rows.orderBy(F.desc_nulls_last("filing_date"), "filing_id") if ordered else rows


def recent_activity(df: DataFrame, as_of=None, days: int = 7, k: int = 10, tie: str = "cik") -> DataFrame:
    """The ``k`` newest filings of the last ``days`` days."""
    return (
        df.where(since(df, "filing_date", as_of, days=days))
        .orderBy(F.desc("filing_date"), tie)
        .limit(k)
    )


def briefing_lines(recent: DataFrame, tie: str = "cik") -> DataFrame:
    """One row: the recent filings as a list of lines, newest first; empty text for none."""
    line = F.concat(
        F.lit("- "), "company_name", F.lit(" ("), F.col("filing_date").cast("string"), F.lit("): "),
        "ai_summary", F.lit(" [Sentiment: "), "sentiment", F.lit(", Type: "), "classification", F.lit("]"),
    )
    item = F.struct((-F.unix_date("filing_date")).alias("at"), F.col(tie).alias("tie"), line.alias("line"))
    lines = F.transform(F.sort_array(F.collect_list(item)), lambda x: x["line"])
    return recent.agg(
        F.coalesce(F.array_join(lines, "\n"), F.lit("")).alias("filing_list"),
        F.count("*").alias("num_filings"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment") == "negative").alias("negative_count"),
        F.count_if(F.col("classification") == "M&A").alias("deal_count"),
    )


def templated_briefing() -> Column:
    """Three plain paragraphs from the counts and lines of :func:`briefing_lines`."""
    n = F.col("num_filings").cast("string")
    return F.concat(
        F.lit("Recent filings: "), n, F.lit(" in the period, "), F.col("deal_count").cast("string"),
        F.lit(" of them on deals.\n\nSentiment: "), F.col("positive_count").cast("string"),
        F.lit(" positive, "), F.col("negative_count").cast("string"), F.lit(" negative, "),
        (F.col("num_filings") - F.col("positive_count") - F.col("negative_count")).cast("string"),
        F.lit(" neutral.\n\nDetails:\n"), "filing_list",
    )


def briefing(
    df: DataFrame,
    as_of=None,
    days: int = 7,
    k: int = 10,
    tie: str = "cik",
    provider: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """One row with the briefing text, or none when nothing is recent.

    With a ``provider`` the text is its reply to the instruction and the line list.
    """
    lines = briefing_lines(recent_activity(df, as_of, days, k, tie), tie).where("num_filings > 0")
    if provider is None:
        text = templated_briefing()
    else:
        text = provider(F.concat(F.lit(BRIEFING_PROMPT), F.col("filing_list")))
    return lines.select(
        text.alias("briefing_text"), as_of_column(df, "filing_date", as_of).alias("report_date")
    )
