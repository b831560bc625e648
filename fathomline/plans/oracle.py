"""Reference SQL (DuckDB dialect) for the registered queries, over the whole tables."""

from __future__ import annotations

from fathomline.functions import labels, providers
from fathomline.operators import forecast, gazetteer, mining
from fathomline.plans import catalog as c

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def parts(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes)


def half_up(value: str, digits: int = 6) -> str:
    return f"floor(({value}) * {10**digits} + 0.5::DOUBLE) / {10**digits}"


def r(*names: str) -> str:
    return ", ".join(f"{half_up(n)} AS {n}" for n in names)


# --- shared relations -------------------------------------------------------

BARS = """bars AS (
  SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
    arg_min(price, (k, price)) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, (k, price)) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM (SELECT *, l_extendedprice / l_quantity AS price, l_orderkey * 10 + l_linenumber AS k FROM lineitem) l
  JOIN part ON l_partkey = p_partkey
  GROUP BY p_brand, CAST(l_shipdate AS DATE))"""

LAST = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"

FEATURES = """feats AS (
  SELECT *,
    avg(close) OVER w7 AS ma_7, avg(close) OVER w30 AS ma_30,
    lag(close, 1) OVER w AS prev_close_1d, lag(close, 7) OVER w AS prev_close_7d,
    (close - lag(close, 1) OVER w) / nullif(lag(close, 1) OVER w, 0) * 100 AS momentum_1d,
    (close - lag(close, 7) OVER w) / nullif(lag(close, 7) OVER w, 0) * 100 AS momentum_7d,
    stddev_samp(close) OVER w7 AS volatility_7d,
    avg(CAST(volume AS DOUBLE)) OVER w7 AS avg_volume_7d,
    (volume - avg(CAST(volume AS DOUBLE)) OVER w7) / nullif(avg(CAST(volume AS DOUBLE)) OVER w7, 0) AS volume_momentum,
    CAST(dayofweek(date) AS BIGINT) AS day_of_week,
    lead(close, 1) OVER w AS target_price
  FROM bars
  WINDOW w AS (PARTITION BY symbol ORDER BY date),
    w7 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 7 PRECEDING AND CURRENT ROW),
    w30 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 30 PRECEDING AND CURRENT ROW))"""

COMPLETE = """complete AS (
  SELECT * FROM feats WHERE prev_close_7d IS NOT NULL AND momentum_1d IS NOT NULL AND momentum_7d IS NOT NULL
    AND volatility_7d IS NOT NULL AND volume_momentum IS NOT NULL AND target_price IS NOT NULL)"""

NEXT_DAY_COLUMNS = "symbol, date, volume, day_of_week, " + r(
    "open", "high", "low", "close", "ma_7", "ma_30", "prev_close_1d", "prev_close_7d", "momentum_1d",
    "momentum_7d", "volatility_7d", "avg_volume_7d", "volume_momentum", "target_price",
)


def lines(source: str, where: str = "true") -> str:
    return f"""lines AS (
  SELECT symbol, regr_slope(close, t) AS slope, regr_intercept(close, t) AS base,
    sqrt(greatest(regr_syy(close, t) - regr_slope(close, t) * regr_sxy(close, t), 0)
      / CASE WHEN count(*) > 2 THEN count(*) - 2 END) AS err, max(date) AS last_day
  FROM (SELECT *, CAST(date - DATE '1970-01-01' AS DOUBLE) AS t FROM {source} WHERE {where}) x GROUP BY symbol)"""


def outlook(horizon: int) -> str:
    return f"""outlook AS (
  SELECT symbol, ts, base + slope * t AS forecast,
    base + slope * t - 1.96::DOUBLE * err AS lower, base + slope * t + 1.96::DOUBLE * err AS upper
  FROM (SELECT *, CAST(ts - DATE '1970-01-01' AS DOUBLE) AS t
    FROM (SELECT *, last_day + CAST(h AS INTEGER) AS ts FROM lines, range(1, {horizon + 1}) AS g(h)) a) b)"""


PAST = lines("bars", f"date < {LAST} - {c.BACK_DAYS}")
PREDICTED = f"""preds AS (
  SELECT symbol, ts AS prediction_date, forecast AS predicted_close, lower AS confidence_interval_low,
    upper AS confidence_interval_high, 'v1.0' AS model_version, TIMESTAMP '2024-12-31 00:00:00' AS created_at
  FROM outlook)"""
TESTED = f"""tested AS (
  SELECT symbol, date, close AS actual_price, predicted_close, abs(close - predicted_close) AS absolute_error,
    abs(close - predicted_close) / nullif(close, 0) * 100 AS percent_error
  FROM bars JOIN preds USING (symbol) WHERE date = prediction_date AND date >= {LAST} - {c.BACK_DAYS})"""
PREDS = (BARS, PAST, outlook(c.BACK_DAYS), PREDICTED)

FILINGS = """filings AS (
  SELECT CAST(doc_id AS VARCHAR) AS cik, source AS company_name, lang AS form_type,
    DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) AS filing_date, text AS filing_text,
    'https://files/data/' || CAST(doc_id AS VARCHAR) || '/index.htm' AS url
  FROM documents)"""


def _term_count(weight: float) -> str:
    terms = ", ".join(text(t) for t, w in c.LEXICON.items() if w == weight)
    return f"len(list_filter(words, lambda x: x IN ({terms}))) * {abs(weight)}::DOUBLE"


_UP = " + ".join(_term_count(w) for w in sorted({w for w in c.LEXICON.values() if w > 0}))
_DOWN = " + ".join(_term_count(w) for w in sorted({w for w in c.LEXICON.values() if w < 0}))


def scored(source: str) -> str:
    return f"""scored AS (
  SELECT cik, coalesce((up - down) / nullif(up + down, 0), 0) AS sentiment_score
  FROM (SELECT cik, {_UP} AS up, {_DOWN} AS down
    FROM (SELECT cik, string_split_regex(lower(filing_text), '[^a-z]+') AS words FROM {source}) a) b)"""


CLASS = (
    "CASE "
    + " ".join(f"WHEN regexp_matches(filing_text, {text('(?i)' + p)}) THEN {text(n)}" for n, p in c.RULES)
    + " ELSE 'Other' END"
)
LABEL = (
    "CASE WHEN sentiment_score > 0.2 THEN 'positive' WHEN sentiment_score < -0.2 THEN 'negative' ELSE 'neutral' END"
)


def summaries(source: str) -> str:
    """Sentence rows, shared terms, three best sentences per text, back in order."""
    return f"""sents AS (
  SELECT cik, s, row_number() OVER (PARTITION BY cik ORDER BY n) AS pos
  FROM (SELECT cik, trim(unnest(p)) AS s, generate_subscripts(p, 1) AS n
    FROM (SELECT cik, string_split(regexp_replace(regexp_replace(filing_text, '([.!?])\\s+', '\\1' || chr(1), 'g'),
      '[\\r\\n]+', chr(1), 'g'), chr(1)) AS p FROM {source}) a) b
  WHERE s <> ''),
terms AS (
  SELECT DISTINCT cik, pos, w FROM (
    SELECT cik, pos, unnest(string_split_regex(lower(s), '[^\\p{{L}}]+')) AS w FROM sents) a
  WHERE length(w) >= 4),
shared AS (SELECT cik, w FROM terms GROUP BY cik, w HAVING count(*) >= 2),
points AS (SELECT cik, pos, count(*) AS n FROM terms JOIN shared USING (cik, w) GROUP BY cik, pos),
best AS (
  SELECT cik, pos, s, row_number() OVER (PARTITION BY cik ORDER BY coalesce(n, 0) DESC, pos) AS place
  FROM sents LEFT JOIN points USING (cik, pos)),
summed AS (
  SELECT f.cik, coalesce(string_agg(s, ' ' ORDER BY pos), '') AS ai_summary
  FROM {source} f LEFT JOIN (SELECT * FROM best WHERE place <= 3) b ON f.cik = b.cik GROUP BY f.cik)"""


KEPT = "kept AS (SELECT * FROM filings WHERE length(filing_text) > 100)"
NUMBERED = """numbered AS (
  SELECT row_number() OVER (ORDER BY filing_date DESC, cik, form_type, url) AS filing_id, * FROM kept)"""
DONE = f"""done AS (
  SELECT filing_id, cik, company_name, form_type, filing_date, filing_text AS original_text, ai_summary,
    {LABEL} AS sentiment, sentiment_score, {CLASS} AS classification,
    TIMESTAMP '2024-12-31 00:00:00' AS processed_at
  FROM numbered JOIN scored USING (cik) JOIN summed USING (cik))"""
ENRICHED = (FILINGS, KEPT, NUMBERED, scored("kept"), summaries("kept"), DONE)
# For reports that do not show the summary.
LIGHT_DONE = f"""done AS (
  SELECT filing_id, cik, company_name, filing_date, {LABEL} AS sentiment, sentiment_score, {CLASS} AS classification
  FROM numbered JOIN scored USING (cik))"""
LIGHT = (FILINGS, KEPT, NUMBERED, scored("kept"), LIGHT_DONE)

COMMENTS = """comments AS (
  SELECT conv_id * 1000000000 + turn AS id,
    CASE WHEN role = 'assistant' AND turn > 0 THEN conv_id * 1000000000 + turn - 1 END AS in_reply_to_id,
    CASE role WHEN 'assistant' THEN 'Assistant[bot]' WHEN 'system' THEN 'sys-bot' ELSE role END AS user_login,
    text AS body, 'src/' || CAST(conv_id AS VARCHAR) AS path
  FROM conversations)"""

USAGE = """usage AS (
  SELECT event_type AS model, CAST(trunc(value * 100) AS BIGINT) AS input_tokens,
    CAST(trunc(value * 10) AS BIGINT) AS output_tokens, value AS credits_used, ts AS start_time
  FROM events)"""
RATES = "rates(model, input_rate, output_rate) AS (VALUES " + ", ".join(
    f"({text(m)}, {i}::DOUBLE, {o}::DOUBLE)" for m, i, o in c.RATES
) + ")"

# --- prices -----------------------------------------------------------------

BAR_COLUMNS = "symbol, date, volume, " + r("open", "high", "low", "close")
bars = parts(BARS)
ORACLES["scan_prices"] = f"{bars} SELECT {BAR_COLUMNS} FROM bars"
ORACLES["project_alias"] = (
    f"{bars} SELECT symbol, date, floor((close) * 1000000 + 0.5::DOUBLE) / 1000000 AS price, 'actual' AS type, 'v1.0' AS model_version FROM bars"
)
ORACLES["symbol_history"] = f"{bars} SELECT {BAR_COLUMNS} FROM bars WHERE symbol = 'Brand#1'"
ORACLES["lookback_filter"] = (
    f"{bars} SELECT symbol, date, floor((close) * 1000000 + 0.5::DOUBLE) / 1000000 AS close FROM bars"
    f" WHERE date >= CAST({LAST} - INTERVAL 6 MONTH AS DATE)"
)
feats = parts(BARS, FEATURES)
complete = parts(BARS, FEATURES, COMPLETE)
ORACLES["features_same_day"] = (
    f"{feats} SELECT symbol, date, floor((close) * 1000000 + 0.5::DOUBLE) / 1000000 AS target_price, day_of_week, floor((prev_close_1d) * 1000000 + 0.5::DOUBLE) / 1000000 AS prev_close, "
    + r("ma_7", "ma_30", "momentum_1d", "momentum_7d", "volatility_7d", "volume_momentum")
    + " FROM feats"
)
ORACLES["features_next_day"] = f"{complete} SELECT {NEXT_DAY_COLUMNS} FROM complete"
ORACLES["features_split_series"] = ORACLES["features_next_day"]
ORACLES["drop_incomplete"] = (
    f"{complete} SELECT symbol, date, {r('close', 'prev_close_7d', 'target_price')} FROM complete"
)
for name, cols in {
    "moving_averages": ("ma_7", "ma_30"),
    "momentum": ("momentum_1d", "momentum_7d"),
    "rolling_volatility": ("volatility_7d",),
    "volume_momentum": ("volume_momentum",),
}.items():
    ORACLES[name] = f"{feats} SELECT symbol, date, {r(*cols)} FROM feats"
ORACLES["prev_close"] = f"{feats} SELECT symbol, date, floor((prev_close_1d) * 1000000 + 0.5::DOUBLE) / 1000000 AS prev_close FROM feats"
ORACLES["day_of_week"] = f"{bars} SELECT symbol, date, CAST(dayofweek(date) AS BIGINT) AS day_of_week FROM bars"
ORACLES["backtest"] = (
    f"{parts(*PREDS, TESTED)} SELECT symbol, date, "
    + r("actual_price", "predicted_close", "absolute_error", "percent_error")
    + " FROM tested"
)
for name, digits in {"error_metrics": 6, "error_metrics_rounded": 2}.items():
    ORACLES[name] = f"""{parts(*PREDS, TESTED)}
SELECT symbol, count(*) AS num_predictions, floor((avg(absolute_error)) * {10**digits} + 0.5::DOUBLE) / {10**digits} AS mae,
  floor((sqrt(avg(power(absolute_error, 2)))) * {10**digits} + 0.5::DOUBLE) / {10**digits} AS rmse, floor((avg(percent_error)) * {10**digits} + 0.5::DOUBLE) / {10**digits} AS mape
FROM tested GROUP BY symbol"""
ORACLES["latest_per_symbol"] = f"""{bars} SELECT {BAR_COLUMNS} FROM bars
QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1"""
ORACLES["latest_stats"] = f"""{bars} SELECT symbol, max(date) AS last_date, floor((avg(close)) * 1000000 + 0.5::DOUBLE) / 1000000 AS avg_price,
  floor((stddev_samp(close)) * 1000000 + 0.5::DOUBLE) / 1000000 AS price_stddev
FROM bars WHERE date >= CAST({LAST} - INTERVAL 1 MONTH AS DATE) GROUP BY symbol"""
ORACLES["holdout_metrics"] = f"""{complete},
tail AS (SELECT target_price AS y, ma_7 AS p FROM complete
  QUALIFY row_number() OVER (ORDER BY date, symbol) > count(*) OVER () - ceil(count(*) OVER () * 0.2::DOUBLE))
SELECT count(*) AS n, floor((avg(abs(y - p))) * 1000000 + 0.5::DOUBLE) / 1000000 AS mae, floor((sqrt(avg((y - p) * (y - p)))) * 1000000 + 0.5::DOUBLE) / 1000000 AS rmse,
  floor((avg(abs((y - p) / nullif(y, 0))) * 100) * 1000000 + 0.5::DOUBLE) / 1000000 AS mape,
  floor((1 - sum((y - p) * (y - p)) / nullif(var_pop(y) * count(y), 0)) * 1000000 + 0.5::DOUBLE) / 1000000 AS r2 FROM tail"""
ORACLES["prediction_summary"] = f"""{parts(*PREDS)}
SELECT count(DISTINCT symbol) AS num_stocks, count(*) AS num_predictions, max(created_at) AS last_run,
  floor((avg(predicted_close)) * 1000000 + 0.5::DOUBLE) / 1000000 AS avg_predicted_price FROM preds"""
ORACLES["feature_profile"] = (
    f"{complete} SELECT count(DISTINCT symbol) AS num_symbols, count(*) AS num_rows FROM complete"
)
ORACLES["ingest_profile"] = (
    f"{bars} SELECT symbol, count(*) AS num_rows, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY symbol"
)
ORACLES["actual_vs_predicted"] = f"""{parts(*PREDS)}
SELECT symbol, date, floor((close) * 1000000 + 0.5::DOUBLE) / 1000000 AS price, 'actual' AS type FROM bars WHERE date >= {LAST} - {c.BACK_DAYS}
UNION ALL SELECT symbol, prediction_date, floor((predicted_close) * 1000000 + 0.5::DOUBLE) / 1000000, 'predicted' FROM preds"""
ORACLES["recent_prices_topk"] = f"{bars} SELECT {BAR_COLUMNS} FROM bars ORDER BY date DESC, symbol LIMIT 20"
ORACLES["sample_half"] = f"""{bars} SELECT {BAR_COLUMNS} FROM bars
WHERE CAST('0x' || substr(md5('7|' || symbol || '|' || date), 1, 8) AS BIGINT) < {1 << 31}"""
ORACLES["forecast_linear"] = (
    f"{parts(BARS, lines('bars'), outlook(7))} SELECT symbol, ts, {r('forecast', 'lower', 'upper')} FROM outlook"
)
_weights = ", ".join(f"({a}::DOUBLE, {b}::DOUBLE)" for a, b in forecast.SETTINGS)
ORACLES["forecast_holt"] = f"""WITH RECURSIVE {BARS},
days AS (SELECT symbol, date, close, row_number() OVER w AS n, lead(close) OVER w - close AS rise
  FROM bars WHERE close IS NOT NULL WINDOW w AS (PARTITION BY symbol ORDER BY date, close)),
smooth AS (
  SELECT symbol, a, b, n, close AS l, coalesce(rise, 0) AS t, 0::DOUBLE AS sse
  FROM days, (VALUES {_weights}) AS g(a, b) WHERE n = 1
  UNION ALL
  SELECT s.symbol, a, b, d.n, l + t + a * (d.close - l - t), t + a * b * (d.close - l - t),
    sse + (d.close - l - t) * (d.close - l - t)
  FROM smooth s JOIN days d ON d.symbol = s.symbol AND d.n = s.n + 1),
best AS (SELECT s.*, date FROM smooth s JOIN days USING (symbol, n)
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY n DESC, sse, a, b) = 1),
outlook AS (SELECT symbol, date + CAST(h AS INTEGER) AS ts, l + h * t AS forecast,
  1.96::DOUBLE * sqrt(sse / CASE WHEN n > 2 THEN n - 2 END
    * (1 + (h - 1) * (a * a + a * a * b * h + a * a * b * b * h * (2 * h - 1) / 6))) AS margin
  FROM best, range(1, 8) AS g(h))
SELECT symbol, ts, {r('forecast')}, {half_up('forecast - margin')} AS lower, {half_up('forecast + margin')} AS upper FROM outlook"""
ORACLES["forecast_flat"] = f"""{complete},
latest AS (SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
SELECT symbol, date + CAST(h AS INTEGER) AS prediction_date, floor((ma_7) * 1000000 + 0.5::DOUBLE) / 1000000 AS predicted_close,
  floor((ma_7 - 1.96::DOUBLE * volatility_7d) * 1000000 + 0.5::DOUBLE) / 1000000 AS confidence_interval_low,
  floor((ma_7 + 1.96::DOUBLE * volatility_7d) * 1000000 + 0.5::DOUBLE) / 1000000 AS confidence_interval_high, 'flat_v1' AS model_version
FROM latest, range(1, 8) AS g(h)"""
ORACLES["regressor_scores"] = f"""{complete}
SELECT CAST(ceil(count(*) * 0.2::DOUBLE) AS BIGINT) AS test_rows, count(*) - CAST(ceil(count(*) * 0.2::DOUBLE) AS BIGINT) AS train_rows,
  CAST(3 * 3 * 2 * 2 * 2 AS INTEGER) AS combinations, true AS chosen_from_grid, true AS no_worse_than_mean,
  true AS errors_in_order, true AS all_trees
FROM complete"""
CHECKED = """symbol, date + CAST(h AS INTEGER) AS prediction_date,
  floor((2 * 1.96::DOUBLE * volatility_7d) * 1000000 + 0.5::DOUBLE) / 1000000 AS interval_width, true AS in_range, true AS centred"""
ORACLES["model_roundtrip"] = f"""{complete},
latest AS (SELECT * FROM complete QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
SELECT {CHECKED}, 'v1' AS model_version, true AS reloaded_equal FROM latest, range(1, 8) AS g(h)"""
ORACLES["price_run"] = f"""{complete},
latest AS (SELECT * FROM feats WHERE momentum_1d IS NOT NULL AND momentum_7d IS NOT NULL AND volatility_7d IS NOT NULL
    AND volume_momentum IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
SELECT {CHECKED}, 'trees_v1' AS model_version FROM latest, range(1, 8) AS g(h)"""
PLACED = """placed AS (
  SELECT *, row_number() OVER (ORDER BY date, symbol) AS rn, count(*) OVER () AS n FROM bars),
split AS (SELECT *, CASE WHEN rn <= n - ceil(n * 0.2::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM placed)"""
ORACLES["ordered_split"] = f"{parts(BARS, PLACED)} SELECT symbol, date, part FROM split"
ORACLES["cv_folds"] = (
    f"{bars} SELECT symbol, date, CAST(ntile(3) OVER (ORDER BY date, symbol) - 1 AS INTEGER) AS fold FROM bars"
)
ORACLES["standardize"] = (
    f"{parts(BARS, PLACED)} SELECT symbol, date, part, "
    + ", ".join(
        f"floor((({v} - (SELECT avg({v}) FROM split WHERE part = 'train'))"
        f" / (SELECT stddev_pop({v}) FROM split WHERE part = 'train')) * 1000000 + 0.5::DOUBLE) / 1000000 AS {v}"
        for v in ("high", "low", "close")
    )
    + " FROM split"
)
ORACLES["feature_table"] = (
    f"{complete} SELECT CAST(year(date) AS INTEGER) AS year, {NEXT_DAY_COLUMNS} FROM complete"
)
PREDICTION_COLUMNS = "symbol, prediction_date, created_at, " + r(
    "predicted_close", "confidence_interval_low", "confidence_interval_high"
)
ORACLES["ctas_predictions"] = (
    f"{parts(BARS, lines('bars'), outlook(7), PREDICTED)} SELECT model_version, {PREDICTION_COLUMNS} FROM preds"
)
ORACLES["append_aligned"] = f"""{parts(*PREDS)}
SELECT model_version, {PREDICTION_COLUMNS} FROM preds
UNION ALL SELECT 'v2.0', {PREDICTION_COLUMNS} FROM preds"""
ORACLES["merge_upsert_prices"] = f"""{bars}
SELECT symbol, date, volume, {r("open", "high", "low")},
  floor((CASE WHEN date >= {LAST} - {2 * c.BACK_DAYS} THEN close * 1.01::DOUBLE ELSE close END) * 1000000 + 0.5::DOUBLE) / 1000000 AS close,
  CASE WHEN date >= {LAST} - {2 * c.BACK_DAYS} THEN TIMESTAMP '2025-01-01 00:00:00'
    ELSE TIMESTAMP '2024-12-31 00:00:00' END AS ingested_at
FROM bars"""

# --- filings ----------------------------------------------------------------

filings = parts(FILINGS)
ORACLES["scan_filings"] = f"{filings} SELECT * FROM filings"
ORACLES["cap_text"] = f"{filings} SELECT cik, substr(filing_text, 1, 10000) AS filing_text FROM filings"
ORACLES["nonempty_filings"] = f"""{parts(FILINGS, KEPT)}
SELECT cik, company_name, filing_date, CAST(length(filing_text) AS INTEGER) AS n_chars FROM kept"""
ORACLES["filing_preview"] = f"{filings} SELECT cik, substr(filing_text, 1, 200) AS preview FROM filings"
ORACLES["prompt_text"] = f"""{filings}
SELECT cik, {text(labels.SUMMARY_PROMPT)} || filing_text AS summary_prompt,
  {text(labels.CLASSIFY_PROMPT)} || filing_text AS classify_prompt FROM filings"""
ORACLES["filing_ids"] = f"{parts(FILINGS, KEPT, NUMBERED)} SELECT filing_id, cik, filing_date FROM numbered"
ORACLES["merge_insert_filings"] = f"""{filings}
SELECT cik, form_type, filing_date,
  sha256(CASE WHEN filing_date < DATE '2024-11-01' THEN filing_text ELSE 'new ' || filing_text END) AS text_hash
FROM filings"""
ORACLES["lexicon_sentiment"] = (
    f"{parts(FILINGS, scored('filings'))} SELECT cik, floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score FROM scored"
)
ORACLES["lexicon_table_sentiment"] = f"""{filings},
lexicon AS (SELECT w, CASE WHEN length(w) % 2 = 0 THEN 1 ELSE -1 END AS weight FROM (
  SELECT DISTINCT unnest(string_split_regex(lower(text), '[^a-z]+')) AS w FROM benchmark) a WHERE w <> ''),
words AS (SELECT cik, unnest(string_split_regex(lower(filing_text), '[^a-z]+')) AS w FROM filings),
hits AS (SELECT cik, sum(weight) AS net, count(*) AS n FROM words JOIN lexicon USING (w) GROUP BY cik)
SELECT cik, {half_up('coalesce(CAST(net AS DOUBLE) / n, 0)')} AS sentiment_score
FROM filings LEFT JOIN hits USING (cik)"""
ORACLES["sentiment_label"] = f"{parts(FILINGS, scored('filings'))} SELECT cik, {LABEL} AS sentiment FROM scored"
ORACLES["rule_classify"] = f"{filings} SELECT cik, {CLASS} AS classification FROM filings"
ORACLES["classify_default"] = f"""{filings} SELECT cik, CASE
  {" ".join(f"WHEN regexp_matches(marked, {text('(?i)' + p)}) THEN {text(n)}" for n, p in providers.DEFAULT_RULES)} ELSE 'Other' END AS classification
FROM (SELECT cik, CASE CAST(cik AS BIGINT) % {len(c.CLASS_MARKS) + 1}
  {" ".join(f"WHEN {i} THEN {text(m)}" for i, m in enumerate(c.CLASS_MARKS))} ELSE '' END || filing_text AS marked FROM filings) m"""
ORACLES["classify_replies"] = f"""{parts(FILINGS, KEPT)} SELECT cik, CASE length(filing_text) % 9 WHEN 0 THEN 'M&A' WHEN 1 THEN 'IPO'
  WHEN 2 THEN 'Executive_Change' WHEN 3 THEN 'Restructuring' WHEN 4 THEN 'Financial_Restatement' WHEN 5 THEN 'Material_Event'
  ELSE 'Other' END AS classification FROM kept"""
ORACLES["external_calls"] = f"""{filings},
firsts AS (SELECT filing_text, bool_or(filing_date < DATE '2024-07-01') AS early FROM filings GROUP BY filing_text)
SELECT cik, CASE WHEN length(filing_text) % 11 <> 0 THEN 'seen ' || length(filing_text) END AS reply,
  CASE WHEN length(filing_text) % 11 = 0 THEN 'TimeoutError: busy' END AS error,
  CAST(CASE WHEN length(filing_text) % 11 = 0 OR length(filing_text) % 5 = 0 THEN 3 ELSE 1 END AS INTEGER) AS attempts,
  CAST(CASE WHEN early AND length(filing_text) % 11 = 0 THEN 2 ELSE 1 END AS BIGINT) AS calls_stored
FROM filings JOIN firsts USING (filing_text)"""
ORACLES["extractive_summary"] = f"{parts(FILINGS, summaries('filings'))} SELECT cik, ai_summary FROM summed"
_places = r"\b(?:" + "|".join(sorted(c.PLACES, key=lambda p: (-len(p), p))) + r")\b"
ORACLES["filing_entities"] = (
    f"{filings} SELECT cik, "
    + ", ".join(
        f"array_to_string(list_sort(list_distinct(regexp_extract_all(filing_text, {text(p)}, 0))), '|') AS {n}"
        for n, p in {**c.ENTITY_PATTERNS, "locations": _places}.items()
    )
    + " FROM filings WHERE length(filing_text) > 200"
)


def named(fold: str) -> str:
    """Names found by walking from each to the first that starts after its end."""
    def cut(value: str) -> str:
        return f"regexp_extract_all({fold.format(value)}, '{gazetteer.TOKEN}', 0)"

    return f"""WITH RECURSIVE {FILINGS},
asked AS (SELECT regexp_extract_all(text, '{gazetteer.TOKEN}', 0) AS p FROM conversations WHERE role = 'user'),
phrases AS (SELECT DISTINCT array_to_string(p[i:i + n - 1], ' ') AS name
  FROM asked, (VALUES (2), (3)) v(n), unnest(range(1, len(p) - n + 2)) u(i) WHERE len(p) >= 3),
keys AS (SELECT array_to_string({cut('name')}, ' ') AS key, min(name) AS name FROM phrases GROUP BY 1),
cuts AS (SELECT cik, {cut('filing_text')} AS p FROM filings),
spans AS (SELECT cik, i - 1 AS start, n, array_to_string(p[i:i + n - 1], ' ') AS key
  FROM cuts, (VALUES (2), (3)) v(n), unnest(range(1, len(p) - n + 2)) u(i)),
longest AS (SELECT cik, start, n, name FROM spans JOIN keys USING (key)
  QUALIFY row_number() OVER (PARTITION BY cik, start ORDER BY n DESC) = 1),
linked AS (SELECT a.*, b.start AS next FROM longest a ASOF LEFT JOIN longest b ON a.cik = b.cik AND a.start + a.n <= b.start),
found AS (
  SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY cik ORDER BY start) = 1
  UNION ALL SELECT l.* FROM found f JOIN linked l ON l.cik = f.cik AND l.start = f.next)"""


ORACLES["filing_names"] = f"""{named('{}')}
SELECT cik, CAST(start AS INTEGER) AS start, CAST(n AS INTEGER) AS n, name FROM found"""
ORACLES["filing_name_lists"] = f"""{named('lower({})')},
lists AS (SELECT cik, list_sort(list(DISTINCT name)) AS names FROM found GROUP BY cik)
SELECT cik, CAST(coalesce(len(names), 0) AS BIGINT) AS n_names, sha256(coalesce(array_to_string(names, '|'), '')) AS names_sha256
FROM filings LEFT JOIN lists USING (cik)"""
enriched, light = parts(*ENRICHED), parts(*LIGHT)
ORACLES["enriched_filings"] = f"""{enriched}
SELECT filing_id, cik, company_name, form_type, filing_date, original_text, ai_summary, sentiment,
  floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score, classification, processed_at FROM done"""
ORACLES["bounded_docs"] = f"""{light}
SELECT filing_id, cik, floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score, classification FROM done WHERE filing_id <= 50"""
_hit = {
    "deal_activity_ci": [f"contains(lower(ai_summary), {text(t.lower())})" for t in c.DEAL_TERMS],
    "deal_activity_cs": [f"contains(ai_summary, {text(t)})" for t in c.DEAL_TERMS],
}
for name, tests in _hit.items():
    ORACLES[name] = f"""{enriched}
SELECT filing_id, company_name, filing_date, ai_summary, sentiment, floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score
FROM done WHERE classification = 'M&A' OR {" OR ".join(tests)}"""
ORACLES["filing_dashboard"] = f"""{enriched}
SELECT filing_id, company_name, form_type, filing_date, ai_summary, sentiment,
  floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score, classification,
  CASE WHEN classification = 'M&A' THEN '🤝' WHEN classification = 'IPO' THEN '🚀'
    WHEN classification = 'Restructuring' THEN '🏗️' WHEN sentiment = 'positive' THEN '📈'
    WHEN sentiment = 'negative' THEN '📉' ELSE '📄' END AS icon, processed_at
FROM done"""
TRENDS = """SELECT company_name, CAST(date_trunc('month', filing_date) AS DATE) AS month, count(*) AS num_filings,
  floor((avg(sentiment_score)) * 1000000 + 0.5::DOUBLE) / 1000000 AS avg_sentiment,
  CAST(count(*) FILTER (sentiment = 'positive') AS BIGINT) AS positive_count,
  CAST(count(*) FILTER (sentiment = 'negative') AS BIGINT) AS negative_count,
  CAST(count(*) FILTER (sentiment = 'neutral') AS BIGINT) AS neutral_count
FROM done GROUP BY ALL"""
HEATMAP = """SELECT CAST(date_trunc('week', filing_date) AS DATE) AS week, classification,
  floor((avg(sentiment_score)) * 1000000 + 0.5::DOUBLE) / 1000000 AS avg_sentiment FROM done GROUP BY ALL"""
ORACLES["sentiment_trends"] = f"{light} {TRENDS}"
ORACLES["classification_share"] = f"""{light}
SELECT classification, count(*) AS count,
  floor((count(*) * 100.0::DOUBLE / (SELECT count(*) FROM done)) * 100 + 0.5::DOUBLE) / 100 AS percent FROM done GROUP BY classification"""
ORACLES["classification_members"] = f"""{light},
placed AS (SELECT classification, company_name,
    (row_number() OVER (PARTITION BY classification ORDER BY company_name) - 1) // 100 + 1 AS page FROM done)
SELECT classification, CAST(page AS BIGINT) AS page, string_agg(company_name, ', ' ORDER BY company_name) AS companies
FROM placed GROUP BY classification, page"""
ORACLES["sentiment_heatmap"] = f"{light} {HEATMAP}"
ORACLES["filing_summary_stats"] = f"""{light}
SELECT count(*) AS total_filings_processed, count(DISTINCT company_name) AS unique_companies,
  TIMESTAMP '2024-12-31 00:00:00' AS last_processed, floor((avg(sentiment_score)) * 1000000 + 0.5::DOUBLE) / 1000000 AS avg_sentiment,
  CAST(count(*) FILTER (classification = 'M&A') AS BIGINT) AS ma_count,
  CAST(count(*) FILTER (classification = 'IPO') AS BIGINT) AS ipo_count FROM done"""
RECENT = """recent AS (
  SELECT * FROM done WHERE filing_date >= (SELECT max(filing_date) FROM done) - 7
  ORDER BY filing_date DESC, cik LIMIT 10)"""
LIST = """list AS (
  SELECT coalesce(string_agg('- ' || company_name || ' (' || CAST(filing_date AS VARCHAR) || '): ' || ai_summary
    || ' [Sentiment: ' || sentiment || ', Type: ' || classification || ']', chr(10) ORDER BY filing_date DESC, cik), '')
    AS filing_list, count(*) AS n, count(*) FILTER (sentiment = 'positive') AS up,
    count(*) FILTER (sentiment = 'negative') AS down, count(*) FILTER (classification = 'M&A') AS deals
  FROM recent)"""
ORACLES["recent_activity"] = f"""{parts(*ENRICHED, RECENT)}
SELECT cik, company_name, form_type, filing_date, ai_summary, sentiment, classification FROM recent"""
ORACLES["briefing_input"] = f"{parts(*ENRICHED, RECENT, LIST)} SELECT filing_list FROM list"
ORACLES["executive_briefing"] = f"""{parts(*ENRICHED, RECENT, LIST)}
SELECT 'Recent filings: ' || n || ' in the period, ' || deals || ' of them on deals.' || chr(10) || chr(10)
  || 'Sentiment: ' || up || ' positive, ' || down || ' negative, ' || (n - up - down) || ' neutral.'
  || chr(10) || chr(10) || 'Details:' || chr(10) || filing_list AS briefing_text,
  (SELECT max(filing_date) FROM done) AS report_date
FROM list WHERE n > 0"""
ORACLES["stored_briefing"] = ORACLES["executive_briefing"]
ORACLES["unprocessed_docs"] = f"""{filings}
SELECT cik, sha256(filing_text) AS text_hash FROM filings
WHERE sha256(filing_text) NOT IN (SELECT sha256(filing_text) FROM filings WHERE filing_date < DATE '2024-07-01')"""
ORACLES["cached_enrichment"] = f"""{parts(FILINGS, scored("filings"), summaries("filings"))}
SELECT cik, sha256(filing_text) AS text_hash, floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score,
  {CLASS} AS classification, ai_summary
FROM filings JOIN scored USING (cik) JOIN summed USING (cik)"""
ORACLES["filing_report"] = f"""{enriched}
SELECT 'filing_summaries' AS report, count(*) AS num_rows FROM done
UNION ALL SELECT 'sentiment_trends', count(*) FROM ({TRENDS}) t
UNION ALL SELECT 'classification_share', count(DISTINCT classification) FROM done
UNION ALL SELECT 'deal_activity', count(*) FROM done
  WHERE classification = 'M&A' OR {" OR ".join(_hit["deal_activity_ci"])}
UNION ALL SELECT 'executive_briefing', CAST(count(*) > 0 AS BIGINT) FROM done
UNION ALL SELECT 'filing_dashboard', count(*) FROM done
UNION ALL SELECT 'filing_summary_stats', 1
UNION ALL SELECT 'sentiment_heatmap', count(*) FROM ({HEATMAP}) h"""

# --- files and payloads -----------------------------------------------------

ORACLES["csv_null_rules"] = """SELECT doc_id, source || ', ' || lang AS name,
  CASE WHEN lang = 'en' THEN source END AS note, n_chars FROM documents"""
ORACLES["json_read"] = "SELECT * FROM documents"
ORACLES["staged_load"] = f"""{parts(BARS, FILINGS)}
SELECT 'stock-data' AS dataset, count(*) AS num_rows, min(date) AS first_date, max(date) AS last_date FROM bars
UNION ALL SELECT 'filings', count(*), min(filing_date), max(filing_date) FROM filings"""
ORACLES["parse_daily_series"] = ORACLES["scan_prices"]
ORACLES["payload_rejects"] = """SELECT
  CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'rate_limit' ELSE 'unexpected' END AS reason,
  CASE WHEN event_type IN ('error', 'view') THEN 'event ' || event_id ELSE '{"other":"event ' || event_id || '"}' END
    AS message FROM events"""
ORACLES["parse_filing_feed"] = f"""{filings}
SELECT cik, company_name, '8-K' AS form_type, filing_date, filing_text, url FROM filings"""
ORACLES["reset_outputs"] = (
    f"{bars} SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after, true AS derived_dropped, "
    "CAST(0 AS BIGINT) AS rows_recreated FROM bars"
)

# --- conversations, comments, usage -----------------------------------------

_any = {f: "(?i)" + "|".join(f"(?:{p})" for p in ps) for f, _, ps in c.FAMILIES}
_type = "CASE " + " ".join(f"WHEN regexp_matches(text, {text(p)}) THEN {text(f)}" for f, p in _any.items()) + " END"
_sure = "CASE type " + " ".join(f"WHEN {text(f)} THEN {text(s)}" for f, s, _ in c.FAMILIES) + " END"
TRIGGERS = f"""heard AS (
  SELECT *, last_value(CASE WHEN role = 'assistant' AND length(text) > 0 THEN text END IGNORE NULLS)
    OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS assistant_context
  FROM conversations),
hits AS (
  SELECT conv_id, turn, {_type} AS type, text AS user_message, assistant_context FROM heard
  WHERE role = 'user' AND length(text) >= 10
    AND length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) >= length(text) * 0.5),
triggers AS (
  SELECT conv_id, turn, type, {_sure} AS confidence, user_message, assistant_context FROM hits WHERE type IS NOT NULL)"""
ORACLES["conversation_triggers"] = f"{parts(TRIGGERS)} SELECT * FROM triggers"
ORACLES["trigger_counts"] = f"""{parts(TRIGGERS)}
SELECT type, count(*) AS triggers, count(DISTINCT conv_id) AS conversations FROM triggers GROUP BY type"""
_pick = "CASE (conv_id + turn) % " + str(len(c.TRIGGER_MARKS) + 1) + " " + " ".join(f"WHEN {i} THEN {text(m)}" for i, m in enumerate(c.TRIGGER_MARKS)) + " ELSE '' END"
_defaults = {f: "(?i)" + "|".join(f"(?:{p})" for p in ps) for f, _, ps in mining.TRIGGER_FAMILIES}
MARKED = (
    TRIGGERS.replace(" FROM conversations)", f" FROM (SELECT conv_id, turn, role, {_pick} || text AS text FROM conversations) c)")
    .replace(_type, "CASE " + " ".join(f"WHEN regexp_matches(text, {text(p)}) THEN {text(f)}" for f, p in _defaults.items()) + " END")
    .replace(_sure, "CASE type " + " ".join(f"WHEN {text(f)} THEN {text(s)}" for f, s, _ in mining.TRIGGER_FAMILIES) + " END")
)
ORACLES["triggers_default"] = f"{parts(MARKED)} SELECT * FROM triggers"
ORACLES["triggers_newest"] = f"{parts(MARKED)} SELECT conv_id, turn, type, confidence FROM triggers ORDER BY conv_id DESC, turn DESC LIMIT 25"
ORACLES["session_totals"] = (
    "SELECT count(DISTINCT conv_id) AS sessions_analyzed, count(*) AS messages_analyzed FROM conversations"
)
ORACLES["flatten_content"] = """SELECT conv_id, turn,
  CASE WHEN role = 'assistant' THEN coalesce(array_to_string(
    list_filter(string_split(text, chr(10)), lambda s: s <> ''), chr(10)), '') ELSE text END AS text
FROM conversations"""


def rule_sql(rule) -> str:
    tests = ["true"]
    if rule.pattern is not None:
        tests.append(f"regexp_matches(body, {text(('(?i)' if rule.ignore_case else '') + rule.pattern)})")
    if rule.without is not None:
        tests.append(f"NOT regexp_matches(body, {text(rule.without)})")
    if rule.reply is not None:
        tests.append("in_reply_to_id IS " + ("NOT NULL" if rule.reply else "NULL"))
    if rule.human is not None:
        tests.append(("NOT " if rule.human else "") + "contains(lower(user_login), 'bot')")
    return " AND ".join(tests)


ORACLES["comment_triage"] = (
    f"{parts(COMMENTS)} SELECT count(*) AS total, "
    + ", ".join(f"CAST(count(*) FILTER ({rule_sql(x)}) AS BIGINT) AS {x.name}" for x in [*c.NOISE, *c.PRIORITY])
    + " FROM comments"
)
ORACLES["comment_priority"] = (
    f"{parts(COMMENTS)} SELECT id, CASE "
    + " ".join(f"WHEN {rule_sql(x)} THEN {text(x.name)}" for x in c.PRIORITY)
    + " END AS priority FROM comments"
)
OPEN = """unanswered AS (
  SELECT * FROM comments a WHERE in_reply_to_id IS NULL
    AND NOT EXISTS (SELECT 1 FROM comments b WHERE b.in_reply_to_id = a.id))"""
ORACLES["unanswered_items"] = f"{parts(COMMENTS, OPEN)} SELECT id, user_login FROM unanswered"
ORACLES["review_gate"] = (
    f"{parts(COMMENTS, OPEN)} SELECT count(*) AS unanswered, count(*) > 0 AS blocked FROM unanswered"
)
FAMILY = """CASE WHEN contains(lower(user_login), 'assistant') THEN 'helper'
  WHEN contains(lower(user_login), 'runner') THEN 'runner'
  WHEN contains(lower(user_login), '[bot]') OR contains(lower(user_login), '-bot') THEN 'unknown' ELSE 'human' END"""
COLLECTED = f"""collected AS (
  SELECT id, user_login, CASE WHEN user_login = 'Assistant[bot]' THEN path END AS path, {FAMILY} AS family,
    CAST(length(body) AS INTEGER) AS n_chars
  FROM comments WHERE length(body) >= 50 AND {FAMILY} <> 'unknown')"""
ORACLES["union_comments"] = f"{parts(COMMENTS, COLLECTED)} SELECT * FROM collected"
ORACLES["family_counts"] = (
    f"{parts(COMMENTS, COLLECTED)} SELECT family, count(*) AS comments FROM collected GROUP BY family"
)
_families = ["coderabbit", "bugbot", "greptile", "copilot", "human", "unknown", "unknown"]
ORACLES["families_default"] = f"""{parts(COMMENTS)} SELECT id, CASE id % {len(c.ACCOUNTS)}
  {" ".join(f"WHEN {i} THEN {text(f)}" for i, f in enumerate(_families))} END AS family FROM comments"""
ORACLES["author_family"] = f"{parts(COMMENTS)} SELECT id, {FAMILY} AS family FROM comments"
TOTALS = """totals AS (
  SELECT model, count(*) AS requests, CAST(sum(input_tokens) AS BIGINT) AS input_tokens,
    CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM usage GROUP BY model)"""
ORACLES["usage_cost"] = f"""{parts(USAGE, RATES, TOTALS)}
SELECT totals.*, floor(((input_tokens * input_rate + output_tokens * output_rate) / 1000000) * 1000000 + 0.5::DOUBLE) / 1000000 AS estimated_usd
FROM totals JOIN rates USING (model)"""
ORACLES["usage_rejects"] = (
    f"{parts(USAGE, RATES, TOTALS)} SELECT * FROM totals WHERE model NOT IN (SELECT model FROM rates)"
)
ORACLES["usage_by_day"] = f"""{parts(USAGE)}
SELECT CAST(start_time AS DATE) AS day, count(*) AS requests, floor((sum(credits_used)) * 1000000 + 0.5::DOUBLE) / 1000000 AS total_credits
FROM usage WHERE model IN ('view', 'click', 'purchase') GROUP BY day"""
ORACLES["run_log_recent"] = """SELECT event_id, event_type AS name,
  CASE WHEN value > 50 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, ts AS scheduled_time,
  CASE WHEN value > 50 THEN 'E1' END AS error_code
FROM events WHERE event_type IN ('view', 'signup') ORDER BY ts DESC, event_id LIMIT 10"""

# --- incremental ------------------------------------------------------------

ORACLES["stream_ingest_prices"] = ORACLES["scan_prices"]
ORACLES["refresh_available_now"] = f"""{bars}
SELECT symbol, date, floor((close + CASE WHEN date >= {LAST} - {c.BACK_DAYS} THEN 1 ELSE 0 END) * 1000000 + 0.5::DOUBLE) / 1000000 AS close FROM bars"""
ORACLES["stream_rejects"] = ORACLES["payload_rejects"]
ORACLES["stream_new_filings"] = (
    f"{light} SELECT cik, floor((sentiment_score) * 1000000 + 0.5::DOUBLE) / 1000000 AS sentiment_score, classification FROM done"
)
ORACLES["stream_late_rows"] = f"""
WITH firsts AS (SELECT max(ts) AS seen FROM events WHERE coalesce(hour(ts) % 2, 0) = 0),
days AS (
  SELECT CAST(ts AS DATE) AS day, event_type, value, hour(ts) % 2 = 1 AND
    CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL {1 + c.LATENESS.days} DAY <= (SELECT seen FROM firsts) AS late FROM events)
SELECT day, event_type, count(*) AS n,
  CAST(day AS TIMESTAMP) + INTERVAL {1 + c.LATENESS.days} DAY <= (SELECT max(ts) FROM events) AS final,
  CASE WHEN count(*) FILTER (WHERE late) > 0 THEN CAST(count(*) FILTER (WHERE late) AS BIGINT) END AS late_n,
  floor((sum(value) FILTER (WHERE late)) * 1000000 + 0.5::DOUBLE) / 1000000 AS late_total
FROM days GROUP BY day, event_type"""
for name, every in {"stream_daily_counts": "day", "stream_weekly_counts": "week", "stream_two_queries": "day"}.items():
    ORACLES[name] = f"""SELECT CAST(date_trunc('{every}', ts) AS DATE) AS {every}, event_type, count(*) AS n,
  floor((sum(value)) * 1000000 + 0.5::DOUBLE) / 1000000 AS total FROM events GROUP BY ALL"""
