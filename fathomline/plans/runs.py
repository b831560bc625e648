"""End-to-end runs over price and filing tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline import schemas
from fathomline.operators.enrich import TextProviders, enrich_filings
from fathomline.operators.forecast import forecast_flat
from fathomline.operators.price_features import REGRESSOR_FEATURES, price_features
from fathomline.operators.regress import FULL_GRID, fit_regressor
from fathomline.operators.reports import (
    DEAL_TERMS,
    briefing,
    classification_share,
    deal_activity,
    filing_dashboard,
    filing_summary_stats,
    sentiment_heatmap,
    sentiment_trends,
)
from fathomline.sources.files import read_table
from fathomline.sources.tables import replace_table, write_aligned


@dataclass(frozen=True)
class PriceRun:
    """Settings of a price run; ``score_on`` is ``latest_complete`` or ``latest``."""

    lookback: dict | None = field(default_factory=lambda: {"days": 180})
    as_of: object = None
    grid: dict = field(default_factory=lambda: FULL_GRID)
    horizon: int = 7
    layout: str = "ranged"
    version: str = "trees_v1"
    score_on: str = "latest_complete"


def run_prices(
    prices: DataFrame, cfg: PriceRun, features_path: str, predictions_path: str
) -> tuple[DataFrame, DataFrame]:
    """Features, regressor and stored forecasts; returns (predictions, hold-out metrics).

    ``latest_complete`` scores the last row with a known next day, as the null drop
    leaves it; ``latest`` scores the true last day.  The feature rows are stored once
    and read back by every later step.
    """
    rows = price_features(
        prices, cfg.as_of, cfg.lookback, target="next_day", dropna=False, layout=cfg.layout
    )
    stored = replace_table(rows, features_path)
    complete = stored.dropna()
    model, metrics = fit_regressor(complete, REGRESSOR_FEATURES, "target_price", cfg.grid)
    scored = complete if cfg.score_on == "latest_complete" else stored.dropna(subset=REGRESSOR_FEATURES)
    made = forecast_flat(scored, model, cfg.horizon, version=cfg.version)
    write_aligned(made, predictions_path, schemas.PREDICTIONS)
    return read_table(prices.sparkSession, predictions_path, schemas.PREDICTIONS), metrics


@dataclass(frozen=True)
class FilingRun:
    """Settings of a filing run."""

    providers: TextProviders = field(default_factory=TextProviders)
    min_len: int = 100
    limit: int | None = None
    as_of: Column | None = None
    deal_terms: tuple[str, ...] = tuple(DEAL_TERMS)
    case_sensitive: bool = False
    stored_text: str | None = None  # see enrich_filings


def run_filings(filings: DataFrame, cfg: FilingRun, path: str) -> dict[str, DataFrame]:
    """Enrich once into the table at ``path`` and derive every report from the stored rows.

    The briefing of the run is a table of one row (or none) at ``path`` + ``_briefing``.
    """
    done = replace_table(enrich_filings(filings, cfg.providers, cfg.min_len, cfg.limit, stored_text=cfg.stored_text), path)
    return {
        "filing_summaries": done,
        "sentiment_trends": sentiment_trends(done),
        "classification_share": classification_share(done),
        "deal_activity": deal_activity(done, cfg.deal_terms, case_sensitive=cfg.case_sensitive),
        "executive_briefing": replace_table(briefing(done, cfg.as_of, tie="filing_id"), f"{path.rstrip('/')}_briefing"),
        "filing_dashboard": filing_dashboard(done),
        "filing_summary_stats": filing_summary_stats(done),
        "sentiment_heatmap": sentiment_heatmap(done),
    }


def train_classifier(df: DataFrame, text: str, label: str, features: int = 1 << 14, steps: int = 20):
    """Bag-of-words classifier: hashed term counts, inverse document frequency, logistic regression."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[^\p{L}]+"),
            HashingTF(inputCol="_words", outputCol="_counts", numFeatures=features),
            IDF(inputCol="_counts", outputCol="_weights"),
            LogisticRegression(featuresCol="_weights", labelCol=label, maxIter=steps),
        ]
    ).fit(df)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column half up by plain arithmetic, which any engine repeats exactly."""
    scale = float(10**digits)

    def floor(x: Column) -> Column:
        return x - F.pmod(x, F.lit(1.0))  # stays a double: no limit at the size of a bigint

    return df.select(
        *[(floor(F.col(c) * scale + 0.5) / scale).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
