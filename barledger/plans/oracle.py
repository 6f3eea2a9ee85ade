"""The registered queries as SQL over the same tables."""

from __future__ import annotations

from barledger import fixed_values as fv

ORACLES: dict[str, str] = {}

SYMBOL = "'S' || CAST(l_suppkey AS VARCHAR) || '.NS'"
DAY = "CAST(l_shipdate AS DATE)"
CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"

BARS = f"""
trades AS (
  SELECT {SYMBOL} AS symbol, {DAY} AS date, {CENTS} AS cents, CAST(l_quantity AS BIGINT) AS quantity,
    row_number() OVER (PARTITION BY l_suppkey, {DAY} ORDER BY l_orderkey, l_linenumber, {CENTS}) AS nth,
    row_number() OVER (PARTITION BY l_suppkey, {DAY} ORDER BY l_orderkey DESC, l_linenumber DESC, {CENTS} DESC) AS nth_last
  FROM lineitem),
bars AS (
  SELECT symbol, date,
    max(CASE WHEN nth = 1 THEN cents END) / 100.0 AS open, max(cents) / 100.0 AS high, min(cents) / 100.0 AS low,
    max(CASE WHEN nth_last = 1 THEN cents END) / 100.0 AS close,
    max(CASE WHEN nth_last = 1 THEN cents END) AS close_cents, CAST(sum(quantity) AS BIGINT) AS volume
  FROM trades GROUP BY symbol, date)
"""

RAW = f"""
base AS (
  SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t,
    l_extendedprice AS p, l_quantity AS q, l_shipdate + to_hours(l_linenumber) AS stamp,
    CASE WHEN CAST(round(l_discount * 100) AS BIGINT) = 7 AND l_linenumber >= 6 THEN CAST(round(l_tax * 100) AS BIGINT) ELSE -1 END AS rare
  FROM lineitem),
raw AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS run_id, {SYMBOL} AS symbol, l_orderkey * 10 + l_linenumber AS row_position,
    CASE WHEN d = 9 AND t = 6 THEN NULL WHEN d = 9 AND t = 5 THEN stamp + INTERVAL 31 DAY ELSE stamp END AS ts,
    CASE WHEN (d = 10 AND t = 8) OR (d = 8 AND t = 8) THEN CASE WHEN q > 25 THEN CAST('NaN' AS DOUBLE) END
         WHEN rare = 3 THEN CAST('Infinity' AS DOUBLE) WHEN rare = 7 THEN 0.0 ELSE p END AS open,
    CASE WHEN (d = 10 AND t = 7) OR (d = 8 AND t = 8) THEN CAST('Infinity' AS DOUBLE)
         WHEN d = 9 AND t = 7 THEN p - q - 100 WHEN rare = 0 THEN NULL WHEN rare = 8 THEN -1.0 ELSE p + d END AS high,
    CASE WHEN d = 10 AND t = 6 THEN 0.0 WHEN d = 8 AND t = 8 THEN -1.0 WHEN rare = 1 THEN NULL
         WHEN rare = 4 THEN CAST('Infinity' AS DOUBLE) ELSE p - q - t END AS low,
    CASE WHEN rare = 2 THEN CAST('NaN' AS DOUBLE) WHEN rare = 5 THEN CAST('Infinity' AS DOUBLE)
         WHEN d = 6 AND t = 8 AND l_linenumber >= 6 THEN 0.0 ELSE p - q END AS close,
    CASE WHEN d = 9 AND t = 8 THEN 'bad' WHEN l_returnflag = 'N' THEN NULL
         ELSE CAST(CAST(q AS BIGINT) AS VARCHAR) END AS adj_close,
    CASE WHEN (d = 10 AND t = 5) OR (d = 8 AND t = 8) THEN -q WHEN d = 10 AND t = 4 THEN q + 0.5
         WHEN d = 10 AND t = 3 THEN NULL WHEN rare = 6 THEN CAST('Infinity' AS DOUBLE) ELSE q END AS volume,
    CAST(date_trunc('month', l_shipdate) AS DATE) AS request_start,
    CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE) AS request_end
  FROM base)
"""


def _missing(name: str) -> str:
    return f"({name} IS NULL OR isnan({name}))"


def _usable(name: str) -> str:
    return f"({name} IS NOT NULL AND NOT isnan({name}) AND NOT isinf({name}) AND {name} > 0)"


def _field(label: str, name: str, tail: str) -> str:
    return (
        f"CASE WHEN {_missing(name)} THEN 'missing:{label}' WHEN isinf({name}) THEN 'nonfinite:{label}' {tail} END"
    )


_FIELDS = ",\n      ".join(
    [_field(label, label.lower(), f"WHEN {label.lower()} <= 0 THEN 'nonpositive:{label}'")
     for label in ("Open", "High", "Low", "Close")]
    + [_field("Volume", "volume",
              "WHEN volume < 0 THEN 'negative:Volume' WHEN volume % 1 <> 0 THEN 'fractional:Volume'")]
)
_FOUR_USABLE = " AND ".join(_usable(name) for name in ("open", "high", "low", "close"))

AUDITED = RAW + f""",
dated AS (SELECT *, CAST(ts AS DATE) AS session_date FROM raw),
marked AS (
  SELECT *, session_date IS NOT NULL AND count(*) OVER (PARTITION BY run_id, symbol, session_date) > 1 AS repeated
  FROM dated),
audited AS (
  SELECT *, concat_ws(',',
      CASE WHEN session_date IS NULL THEN 'missing_date' END,
      CASE WHEN NOT (session_date >= request_start AND session_date < request_end) THEN 'date_outside_request' END,
      CASE WHEN repeated THEN 'duplicate_date' END,
      {_FIELDS},
      CASE WHEN adj_close = 'bad' THEN 'invalid:Adj Close' END,
      CASE WHEN {_FOUR_USABLE} THEN
        CASE WHEN high < greatest(open, close, low) OR low > least(open, close, high) THEN 'ohlc_order' END END
    ) AS reasons
  FROM marked)
"""

VERDICTS = AUDITED + """,
judged AS (
  SELECT *, reasons = '' AS accepted,
    CASE WHEN reasons LIKE '%_date%' OR reasons LIKE '%date_%' THEN 1 ELSE 0 END AS other
  FROM audited),
verdicts AS (
  SELECT run_id, symbol, count(*) AS frame_rows, count(*) FILTER (accepted) AS usable_rows,
    count(*) FILTER (NOT accepted) AS rejected_rows,
    count(*) FILTER (NOT accepted) = 0 AS passed,
    CASE WHEN count(*) FILTER (NOT accepted) = 0 THEN 'admitted_frame'
         WHEN count(*) FILTER (accepted) > 0 AND sum(other) = 0 THEN 'row_quality_rejected'
         ELSE 'unverified_response' END AS category
  FROM judged GROUP BY run_id, symbol)
"""

REQUESTS = f"""
seen AS (SELECT DISTINCT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS quarter FROM lineitem),
requests AS (
  SELECT strftime(start, '%Y-%m') AS run_id, l_suppkey AS ordinal, {SYMBOL} AS symbol, start,
    CAST(start + INTERVAL 1 MONTH AS DATE) AS "end"
  FROM (SELECT l_suppkey, CAST(quarter + to_months(CAST(unnest(range(3)) AS INTEGER)) AS DATE) AS start FROM seen))
"""

POLICIES = """
policies AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) || '.NS' AS symbol,
    DATE '1995-01-01' + CAST(s_nationkey * 60 AS INTEGER) AS effective_date,
    'policy-' || CAST(s_nationkey AS VARCHAR) AS policy_id, 'account_in_debt' AS reason, s_name AS evidence_urls
  FROM supplier WHERE s_acctbal < 0)
"""

DEFERRED = REQUESTS + "," + POLICIES + """,
deferred AS (
  SELECT r.*, p.effective_date IS NOT NULL AS deferred, p.effective_date, p.policy_id, p.reason, p.evidence_urls
  FROM requests r LEFT JOIN policies p ON r.symbol = p.symbol AND r.start >= p.effective_date)
"""

LEDGER = DEFERRED + "," + VERDICTS + """,
fetched AS (
  SELECT '199' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 + 2 AS VARCHAR) || '-'
      || lpad(CAST(day(ts) % 12 + 1 AS VARCHAR), 2, '0') AS run_id,
    'S' || CAST(user_id AS VARCHAR) || '.NS' AS symbol, value < 50 AS denied
  FROM events WHERE event_type = 'error'),
faults AS (SELECT run_id, symbol, bool_or(denied) AS denied FROM fetched GROUP BY run_id, symbol),
known AS (
  SELECT d.run_id, d.ordinal, d.symbol, d.deferred,
    CASE WHEN f.denied THEN 'source_denied_or_rate_limited' WHEN f.run_id IS NOT NULL THEN 'source_or_processing_error'
      ELSE coalesce(v.category, 'unverified_response') END AS category
  FROM deferred d LEFT JOIN verdicts v ON d.run_id = v.run_id AND d.symbol = v.symbol
    LEFT JOIN faults f ON d.run_id = f.run_id AND d.symbol = f.symbol),
stops AS (
  SELECT run_id, min(ordinal) AS stop_ordinal FROM known
  WHERE NOT deferred AND category NOT IN ('admitted_frame', 'row_quality_rejected') GROUP BY run_id),
reached AS (
  SELECT k.*, NOT k.deferred AND (s.stop_ordinal IS NULL OR k.ordinal <= s.stop_ordinal) AS attempted,
    coalesce(k.ordinal = s.stop_ordinal AND NOT k.deferred, false) AS is_stop
  FROM known k LEFT JOIN stops s ON k.run_id = s.run_id),
ledger AS (
  SELECT run_id, ordinal, symbol, deferred,
    CASE WHEN deferred THEN 'archival_required' WHEN attempted THEN category END AS category, attempted,
    attempted AND category = 'admitted_frame' AS returned,
    NOT attempted AND NOT deferred AS pending_provider,
    attempted AND category = 'row_quality_rejected' AS row_quality_rejected, is_stop
  FROM reached),
coverage AS (
  SELECT run_id, count(*) AS requested, count(*) FILTER (deferred) AS deferred,
    count(*) FILTER (NOT deferred) AS provider_candidates, count(*) FILTER (attempted) AS attempted,
    count(*) FILTER (NOT attempted) AS not_attempted, count(*) FILTER (returned) AS returned,
    count(*) FILTER (NOT returned) AS not_returned, count(*) FILTER (pending_provider) AS pending_provider,
    count(*) FILTER (row_quality_rejected) AS row_quality_rejected,
    max(CASE WHEN is_stop THEN symbol END) AS stop_symbol, max(CASE WHEN is_stop THEN category END) AS stop_category,
    coalesce(max(CASE WHEN is_stop THEN category END) = 'source_denied_or_rate_limited', false) AS raised, count(*) FILTER (returned) > 0 AND count(*) FILTER (NOT returned) = 0 AS success,
    'not_verified' AS historical_completeness
  FROM ledger GROUP BY run_id)
"""

EVENTS = "numbered AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"

DEALS = f"""
deals AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'bulk' ELSE 'block' END AS kind, {DAY} AS deal_date, {SYMBOL} AS symbol,
    CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice AS price, l_returnflag AS client
  FROM lineitem)
"""

SNAPSHOTS = """
customers AS (
  SELECT *, 'C' || CAST(c_custkey AS VARCHAR) || '.NS' AS symbol,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey ELSE -1 END AS odd
  FROM customer),
gated AS (
  SELECT *, CASE WHEN odd IN (6, 7, 8) THEN 'issuer_identity_mismatch'
    WHEN odd IN (1, 2, 3, 4) OR c_acctbal <= 0 THEN 'no_valid_market_cap'
    WHEN odd = 5 THEN 'currency_not_verified' END AS fault
  FROM customers)
"""

CHARTS = BARS + """,
windowed AS (
  SELECT *, DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', date) / 10.0) * 10 AS INTEGER) AS start
  FROM bars),
chart_bars AS (
  SELECT *, first_value(volume) OVER (PARTITION BY symbol, start ORDER BY date) AS v0
  FROM windowed WHERE volume <> 14),
coded AS (
  SELECT *, CASE v0 WHEN 1 THEN 'chart_error_or_missing' WHEN 2 THEN 'ambiguous_chart_results'
      WHEN 3 THEN 'chart_identity_mismatch' WHEN 4 THEN 'invalid_chart_timestamps'
      WHEN 5 THEN 'ambiguous_chart_indicators' WHEN 6 THEN 'chart_array_length_mismatch'
      WHEN 7 THEN 'invalid_chart_cell_type' WHEN 8 THEN 'nonstandard_json_number'
      WHEN 9 THEN 'chart_date_scope_or_duplicate' END AS chart_code,
    CASE WHEN volume IN (11, 12) THEN NULL ELSE close END AS source_close
  FROM chart_bars),
valid AS (SELECT DISTINCT symbol, start FROM coded WHERE chart_code IS NULL),
source AS (
  SELECT symbol, start, date, open, high, low, source_close AS close, CAST(volume AS DOUBLE) AS volume,
    source_close AS adjclose
  FROM coded WHERE chart_code IS NULL),
frames AS (
  SELECT symbol, start, date, open, high, low, volume,
    CASE WHEN volume IN (11, 15) THEN NULL WHEN volume = 16 THEN close + 1 ELSE close END AS close
  FROM windowed WHERE volume <> 13),
adapter AS (
  SELECT f.symbol, f.start, f.date, f.open, f.high, f.low, f.close, CAST(f.volume AS DOUBLE) AS volume, f.close AS adjclose
  FROM frames f JOIN valid v ON f.symbol = v.symbol AND f.start = v.start),
paired AS (
  SELECT coalesce(s.symbol, a.symbol) AS symbol, coalesce(s.start, a.start) AS start, coalesce(s.date, a.date) AS date,
    CASE WHEN s.symbol IS NULL THEN 'adapter_only_date' WHEN a.symbol IS NULL THEN 'source_only_date' ELSE 'both' END AS class,
    s.open AS s_open, s.high AS s_high, s.low AS s_low, s.close AS s_close, s.volume AS s_volume, s.adjclose AS s_adjclose,
    a.open AS a_open, a.high AS a_high, a.low AS a_low, a.close AS a_close, a.volume AS a_volume, a.adjclose AS a_adjclose
  FROM source s FULL JOIN adapter a ON s.symbol = a.symbol AND s.start = a.start AND s.date = a.date),
sided AS (
""" + "\n  UNION ALL ".join(
    f"SELECT symbol, start, date, '{name}' AS field, s_{name} AS source_value, a_{name} AS adapter_value "
    "FROM paired WHERE class = 'both'"
    for name in fv.CHART_FIELDS
) + """),
cells AS (
  SELECT *, CASE WHEN source_value IS NULL AND adapter_value IS NULL THEN 'missing_in_source_and_frame'
    WHEN source_value IS NULL THEN 'source_missing_adapter_changed' WHEN adapter_value IS NULL THEN 'adapter_only_missing'
    WHEN source_value = adapter_value THEN 'agree' ELSE 'value_changed' END AS classification
  FROM sided
  UNION ALL SELECT symbol, start, date, NULL, NULL, NULL, class FROM paired WHERE class <> 'both')
"""


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = " ".join(line.strip() for line in sql.strip().splitlines())


# --- analytics ---

oracle("price_change", f"""WITH {BARS}, ends AS (
  SELECT symbol, arg_min(close, date) AS first_close, arg_max(close, date) AS last_close FROM bars GROUP BY symbol)
SELECT *, (last_close - first_close) / nullif(first_close, 0) * 100 AS change_pct FROM ends""")

oracle("first_symbols", f"""SELECT {SYMBOL} AS symbol, min(l_orderkey) AS first_ordinal FROM lineitem
GROUP BY 1 ORDER BY 2, 1 LIMIT 5""")

oracle("summary_report", f"""WITH {BARS}, {DEALS}
SELECT 'bhavcopy' AS section, 'records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM bars
UNION ALL SELECT 'bhavcopy', 'symbols', CAST(count(DISTINCT symbol) AS VARCHAR) FROM bars
UNION ALL SELECT 'bhavcopy', 'first_date', CAST(min(date) AS VARCHAR) FROM bars
UNION ALL SELECT 'bhavcopy', 'last_date', CAST(max(date) AS VARCHAR) FROM bars
UNION ALL SELECT 'fundamentals', 'records', CAST(count(*) AS VARCHAR) FROM customer
UNION ALL SELECT 'bulk_deals', 'records', CAST(count(*) AS VARCHAR) FROM deals WHERE kind = 'bulk'
UNION ALL SELECT 'block_deals', 'records', CAST(count(*) AS VARCHAR) FROM deals WHERE kind = 'block'
UNION ALL SELECT 'corporate_actions', 'records', CAST(count(*) AS VARCHAR) FROM orders""")

for _rows in (50, 200):
    oracle(f"moving_average_{_rows}", f"""WITH {BARS}
SELECT symbol, date, close, CASE WHEN count(*) OVER span = {_rows}
  THEN CAST(sum(close_cents) OVER span AS DOUBLE) / {_rows} / 100 END AS average
FROM bars WINDOW span AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN {_rows - 1} PRECEDING AND CURRENT ROW)""")

oracle("moving_average_200_trades", f"""SELECT {SYMBOL} AS symbol, {DAY} AS day, l_orderkey, l_linenumber, l_partkey,
  CASE WHEN count(*) OVER span = 200 THEN CAST(sum({CENTS}) OVER span AS DOUBLE) / 200 / 100 END AS average
FROM lineitem WINDOW span AS (PARTITION BY l_suppkey
  ORDER BY {DAY}, l_orderkey, l_linenumber, l_partkey, {CENTS}, l_quantity ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""")

oracle("sorted_prices", f"""WITH {BARS}
SELECT symbol, date, close, row_number() OVER (ORDER BY symbol, date) - 1 AS place FROM bars""")

oracle("top_market_cap", """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_acctbal AS market_cap,
  c_acctbal / 1000000000 AS market_cap_billions FROM customer ORDER BY 2 DESC NULLS LAST, 1 LIMIT 5""")

oracle("lowest_ratio", """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_acctbal / (c_nationkey + 1) AS pe_ratio,
  CAST(c_nationkey AS DOUBLE) AS dividend_yield FROM customer WHERE c_acctbal > 0 ORDER BY 2, 1 LIMIT 5""")

oracle("deal_quantity", f"""WITH {DEALS}
SELECT symbol, CAST(sum(quantity) AS BIGINT) AS quantity FROM deals GROUP BY symbol""")

oracle("top_deal_quantity", f"""WITH {DEALS}
SELECT symbol, CAST(sum(quantity) AS BIGINT) AS quantity FROM deals WHERE kind = 'bulk'
GROUP BY symbol ORDER BY 2 DESC, 1 LIMIT 10""")

oracle("topk_per_group", f"""SELECT symbol, price, l_orderkey, rank FROM (
  SELECT {SYMBOL} AS symbol, l_extendedprice AS price, l_orderkey,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rank
  FROM lineitem) WHERE rank <= 3""")

# --- audit ---

oracle("audit_reasons", f"WITH {AUDITED} SELECT run_id, symbol, row_position, reasons FROM audited WHERE reasons <> ''")

oracle("audit_partition", f"""WITH {AUDITED}
SELECT run_id, symbol, row_position, session_date, reasons = '' AS accepted, reasons FROM audited""")

oracle("duplicate_dates", f"WITH {AUDITED} SELECT run_id, symbol, session_date, row_position FROM audited WHERE repeated")

oracle("rejection_counts", f"""WITH {AUDITED}
SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM audited WHERE reasons <> '')
GROUP BY reason""")

_CELLS = "\n  UNION ALL ".join(
    [f"""SELECT run_id, symbol, row_position, ts, '{label}' AS field,
      CASE WHEN {label.lower()} IS NULL THEN 'null' ELSE 'double' END AS type,
      CASE WHEN {label.lower()} IS NULL THEN 'NULL' WHEN isnan({label.lower()}) THEN 'NaN'
        WHEN isinf({label.lower()}) THEN 'Infinity' ELSE CAST({label.lower()} AS VARCHAR) END AS text
      FROM audited WHERE reasons <> ''""" for label in fv.PRICE_COLUMNS]
    + ["""SELECT run_id, symbol, row_position, ts, 'Adj Close', CASE WHEN adj_close IS NULL THEN 'null' ELSE 'string' END,
      coalesce('''' || adj_close || '''', 'NULL') FROM audited WHERE reasons <> ''"""]
)
oracle("typed_cells", f"""WITH {AUDITED}, cells AS ({_CELLS})
SELECT run_id, symbol, row_position, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS date, field, type, text FROM cells""")

oracle("frame_admission", f"""WITH {VERDICTS}
SELECT run_id, symbol, frame_rows, usable_rows, rejected_rows, passed FROM verdicts""")

oracle("failure_kind", f"""WITH {REQUESTS}, {VERDICTS}, failed AS (
  SELECT DISTINCT '199' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 + 2 AS VARCHAR) || '-'
      || lpad(CAST(day(ts) % 12 + 1 AS VARCHAR), 2, '0') AS run_id, 'S' || CAST(user_id AS VARCHAR) || '.NS' AS symbol
  FROM events WHERE event_type = 'error'
  UNION SELECT run_id, symbol FROM requests JOIN supplier ON s_suppkey = ordinal WHERE s_nationkey < 10)
SELECT r.run_id, r.symbol, coalesce(v.category, 'unverified_response') AS category,
  CASE WHEN v.symbol IS NOT NULL THEN '' WHEN f.symbol IS NOT NULL THEN 'not_a_dataframe' ELSE 'empty_frame' END AS frame_errors
FROM requests r LEFT JOIN verdicts v ON r.run_id = v.run_id AND r.symbol = v.symbol
  LEFT JOIN failed f ON r.run_id = f.run_id AND r.symbol = f.symbol""")

oracle("evidence_manifest", f"""WITH {VERDICTS},
reasons AS (SELECT run_id, symbol, unnest(string_split(reasons, ',')) AS reason FROM judged WHERE NOT accepted),
counted AS (SELECT run_id, symbol, reason, count(*) AS n FROM reasons GROUP BY ALL),
texts AS (SELECT run_id, symbol, string_agg(reason || '=' || CAST(n AS VARCHAR), ',' ORDER BY reason) AS rejection_counts
  FROM counted GROUP BY ALL)
SELECT v.run_id, v.symbol, frame_rows, usable_rows, rejected_rows, rejection_counts,
  'not_verified' AS historical_completeness
FROM verdicts v JOIN texts t ON v.run_id = t.run_id AND v.symbol = t.symbol""")

oracle("usable_positions", f"""WITH {AUDITED}, accepted AS (
  SELECT run_id, symbol, row_position FROM audited WHERE reasons = '')
SELECT run_id, symbol, CAST(floor(row_position / 4096.0) AS BIGINT) AS block,
  string_agg(CAST(row_position AS VARCHAR), ',' ORDER BY row_position) AS positions
FROM accepted GROUP BY ALL""")

_PROVENANCE = """'yahoo_finance' AS source, symbol AS provider_symbol, '1' AS provider_version,
  'provider_ohlc_no_additional_yfinance_adjustment' AS price_basis, '2026-09-22T04:30:00+00:00' AS retrieved_at_utc"""

oracle("admitted_prices", f"""WITH {VERDICTS}, admitted AS (
  SELECT a.* FROM audited a JOIN verdicts v ON a.run_id = v.run_id AND a.symbol = v.symbol WHERE v.passed)
SELECT strftime(session_date, '%Y-%m-%d') AS date, open, high, low, close, adj_close, volume,
  replace(symbol, '.NS', '') AS symbol, {_PROVENANCE.replace('symbol AS', 'admitted.symbol AS')} FROM admitted""")

oracle("provenance", f"""WITH {BARS}
SELECT strftime(date, '%Y-%m-%d') AS date, open, high, low, close, volume, replace(symbol, '.NS', '') AS symbol,
  {_PROVENANCE.replace('symbol AS', 'bars.symbol AS')} FROM bars""")

# --- table quality ---

oracle("clean_rows", f"""WITH {RAW}
SELECT DISTINCT symbol, adj_close, volume, request_start FROM raw""")

oracle("validate_table", f"""WITH {RAW}, cells AS (SELECT symbol, ts, open, volume, adj_close FROM raw),
totals AS (
  SELECT count(*) AS rows,
    CAST(count(*) FILTER (ts IS NULL) + count(*) FILTER ({_missing('open')}) + count(*) FILTER ({_missing('volume')})
      + count(*) FILTER (adj_close IS NULL) AS BIGINT) AS null_cells,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM cells)) AS duplicate_rows
  FROM cells)
SELECT *, rows > 0 AND null_cells = 0 AND duplicate_rows = 0 AS valid FROM totals""")

oracle("standardize_columns", f"WITH {BARS} SELECT date, open, close, volume, symbol FROM bars")

oracle("deals_union", f"""WITH {DEALS}
SELECT kind, deal_date, symbol, quantity, CASE WHEN kind = 'bulk' THEN price END AS price,
  CASE WHEN kind = 'block' THEN client END AS client FROM deals""")

# --- identity and ledgers ---

oracle("universe_check", """WITH requested AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS run_id,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN lower('C' || CAST(o_custkey AS VARCHAR) || '.NS')
      ELSE 'C' || CAST(o_custkey AS VARCHAR) || '.NS' END AS symbol
  FROM orders),
counted AS (SELECT run_id, symbol, count(*) AS times FROM requested GROUP BY ALL)
SELECT run_id, symbol, times, concat_ws(',',
    CASE WHEN NOT regexp_full_match(symbol, '[A-Z0-9][A-Z0-9&.\\-]*\\.NS') THEN 'invalid_symbol' END,
    CASE WHEN times > 1 THEN 'repeated_symbol' END,
    CASE WHEN n_name IS NOT NULL THEN 'known_typo' END) AS faults, n_name AS use_instead
FROM counted LEFT JOIN nation ON symbol = 'C' || CAST(n_nationkey AS VARCHAR) || '.NS'""")

oracle("snapshot_deferral", f"""WITH {DEFERRED}
SELECT run_id, symbol, deferred, CASE WHEN deferred THEN 'archival_required' END AS status, reason, effective_date,
  coalesce(evidence_urls, '') AS evidence_urls, CAST(NULL AS VARCHAR) AS replacement_symbol FROM deferred""")

oracle("archival_worklist", f"""WITH {DEFERRED}
SELECT run_id, policy_id, 'archival_required' AS status, symbol AS provider_symbol, 'yahoo_finance' AS source_adapter,
  'daily_ohlcv' AS data_family, reason, strftime(start, '%Y-%m-%d') AS requested_start,
  strftime("end", '%Y-%m-%d') AS requested_end_exclusive, strftime(effective_date, '%Y-%m-%d') AS reviewed_on,
  evidence_urls, true AS historical_obligation_preserved, 'not_verified' AS historical_completeness,
  CAST(NULL AS VARCHAR) AS replacement_symbol, CAST(NULL AS VARCHAR) AS last_trading_date,
  CAST(NULL AS VARCHAR) AS archive_source, 'awaiting_verified_source' AS archive_fetch_status
FROM deferred WHERE deferred""")

oracle("archival_plan", f"""WITH {DEFERRED}
SELECT run_id, count(*) AS original_requested, count(*) FILTER (deferred) AS archival_requests,
  count(*) FILTER (NOT deferred) AS provider_candidates, 'outstanding_price_archival_work_not_market_data' AS kind,
  'not_verified' AS historical_completeness, CAST(0 AS BIGINT) AS downloaded_rows FROM deferred GROUP BY run_id""")

oracle("persisted_plan", f"""WITH {DEFERRED}
SELECT run_id, ordinal, symbol AS provider_symbol, policy_id, strftime(start, '%Y-%m-%d') AS requested_start,
  strftime("end", '%Y-%m-%d') AS requested_end_exclusive, archival_requests, original_requested,
  original_requested - archival_requests AS provider_candidates, 'outstanding_price_archival_work_not_market_data' AS kind,
  '2026-09-22T04:30:00+00:00' AS planned_at_utc
FROM (SELECT *, count(*) OVER (PARTITION BY run_id) AS original_requested,
  count(*) FILTER (deferred) OVER (PARTITION BY run_id) AS archival_requests FROM deferred) WHERE deferred""")

oracle("planned_ledger", f"WITH {LEDGER} SELECT * FROM ledger")

oracle("unplanned_coverage", f"""WITH {DEFERRED}
SELECT run_id, count(*) AS requested, CAST(0 AS BIGINT) AS deferred, count(*) FILTER (NOT deferred) AS provider_candidates,
  CAST(0 AS BIGINT) AS attempted, count(*) AS not_attempted, CAST(0 AS BIGINT) AS returned, count(*) AS not_returned,
  count(*) FILTER (NOT deferred) AS pending_provider, CAST(0 AS BIGINT) AS row_quality_rejected,
  CAST(NULL AS VARCHAR) AS stop_symbol, 'archival_plan_persistence_failed' AS stop_category, true AS raised,
  false AS success, 'not_verified' AS historical_completeness
FROM deferred GROUP BY run_id HAVING count(*) FILTER (deferred) > 0""")

oracle("provider_candidates", f"WITH {DEFERRED} SELECT run_id, ordinal, symbol FROM deferred WHERE NOT deferred")

oracle("price_ledger", f"WITH {LEDGER} SELECT * FROM ledger")

oracle("price_coverage", f"WITH {LEDGER} SELECT * FROM coverage")

oracle("returned_symbols", f"""WITH {LEDGER}
SELECT run_id, CAST(floor(ordinal / 1000.0) AS BIGINT) AS block, string_agg(symbol, ',' ORDER BY ordinal, symbol) AS symbols
FROM ledger WHERE returned GROUP BY ALL""")

oracle("history_audit", f"""WITH {LEDGER}, frames AS (
  SELECT l.run_id, CAST(sum(frame_rows) AS BIGINT) AS frame_rows, CAST(sum(usable_rows) AS BIGINT) AS usable_rows,
    CAST(sum(rejected_rows) AS BIGINT) AS rejected_rows
  FROM ledger l JOIN verdicts v ON l.run_id = v.run_id AND l.symbol = v.symbol
  WHERE l.attempted AND l.category NOT IN ('source_denied_or_rate_limited', 'source_or_processing_error') GROUP BY l.run_id)
SELECT c.run_id, 'bounded_historical_diagnostic_not_full_production' AS kind, requested, attempted, returned, not_returned,
  stop_symbol, stop_category, coalesce(frame_rows, 0) AS frame_rows, coalesce(usable_rows, 0) AS usable_rows,
  coalesce(rejected_rows, 0) AS rejected_rows, success
FROM coverage c LEFT JOIN frames f ON c.run_id = f.run_id""")

oracle("fundamentals_coverage", f"""WITH {SNAPSHOTS}, {EVENTS},
failed AS (SELECT user_id, bool_or(k < 3) AS denied FROM numbered WHERE event_type = 'error' AND k < 6 GROUP BY user_id),
marked AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS run_id, c_custkey AS ordinal, symbol, c_acctbal < -900 AS deferred,
    CASE WHEN denied THEN 'source_denied_or_rate_limited' WHEN user_id IS NOT NULL THEN 'source_or_processing_error'
      ELSE fault END AS reason
  FROM gated LEFT JOIN failed ON user_id = c_custkey),
stops AS (SELECT run_id, min(ordinal) AS stop_ordinal FROM marked WHERE NOT deferred AND reason IS NOT NULL GROUP BY run_id),
reached AS (
  SELECT m.*, NOT deferred AND reason IS NULL AND (stop_ordinal IS NULL OR ordinal <= stop_ordinal) AS returned,
    coalesce(NOT deferred AND ordinal = stop_ordinal, false) AS is_stop
  FROM marked m LEFT JOIN stops s ON m.run_id = s.run_id)
SELECT run_id, count(*) AS requested, count(*) FILTER (deferred) AS deferred, count(*) FILTER (returned) AS returned,
  count(*) FILTER (NOT returned) AS not_returned, max(CASE WHEN is_stop THEN symbol END) AS stop_symbol,
  max(CASE WHEN is_stop THEN reason END) AS stop_reason,
  coalesce(max(CASE WHEN is_stop THEN reason END) = 'source_denied_or_rate_limited', false) AS raised,
  count(*) FILTER (returned) > 0 AND count(*) FILTER (NOT returned) = 0 AS success,
  DATE '2026-09-22' AS snapshot_as_of_date_ist, 'not_verified' AS historical_completeness
FROM reached GROUP BY run_id""")

_TASKS = EVENTS + """, tasks AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS task,
    CASE WHEN min(k) = 0 THEN 'ERROR' WHEN max(k) < 97 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    CASE WHEN min(k) = 0 THEN 0 ELSE CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) END AS cents
  FROM numbered GROUP BY user_id, event_type)"""

# --- deals ---

oracle("deal_day_gaps", f"""WITH {DEALS}, windows AS (
  SELECT symbol, min(deal_date) AS start, max(deal_date) AS stop FROM deals GROUP BY symbol),
spine AS (SELECT symbol, CAST(unnest(generate_series(start, stop, INTERVAL 1 DAY)) AS DATE) AS day FROM windows)
SELECT s.symbol, s.day, 'unverified' AS status FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM deals d WHERE d.symbol = s.symbol AND d.deal_date = s.day)""")

_DEALS_LEDGER = EVENTS + """, keyed AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, CASE WHEN k < 50 THEN 'bulk' ELSE 'block' END AS kind,
    CAST(ts AS DATE) AS day, k,
    CASE WHEN event_type = 'error' THEN CASE WHEN value < 80 THEN 404 ELSE 503 END ELSE 200 END AS status,
    row_number() OVER (PARTITION BY user_id, k < 50, CAST(ts AS DATE) ORDER BY event_id DESC) AS nth
  FROM numbered),
fetches AS (SELECT run_id, kind, day, status, k < 98 AS header_ok, k AS rows FROM keyed WHERE nth = 1),
windows AS (
  SELECT CAST(user_id AS VARCHAR) AS run_id, min(CAST(ts AS DATE)) AS start, max(CAST(ts AS DATE)) AS stop
  FROM events GROUP BY user_id),
families AS (SELECT *, 0 AS rank, 'bulk' AS kind FROM windows UNION ALL SELECT *, 1, 'block' FROM windows),
obligations AS (
  SELECT run_id, kind, day,
    rank * (date_diff('day', start, stop) + 1) + date_diff('day', start, day) AS ordinal
  FROM (SELECT *, CAST(unnest(generate_series(start, stop, INTERVAL 1 DAY)) AS DATE) AS day FROM families)),
seen AS (
  SELECT o.*, f.rows, CASE WHEN f.run_id IS NULL OR f.status = 404 THEN 'unverified'
      WHEN f.status = 200 AND f.header_ok THEN 'observed' ELSE 'source_blocked' END AS found
  FROM obligations o LEFT JOIN fetches f ON o.run_id = f.run_id AND o.kind = f.kind AND o.day = f.day),
stops AS (SELECT run_id, min(ordinal) AS stop_ordinal FROM seen WHERE found = 'source_blocked' GROUP BY run_id),
ledger AS (
  SELECT s.run_id, kind, day, ordinal,
    CASE WHEN ordinal > stop_ordinal THEN 'not_attempted' ELSE found END AS outcome,
    CASE WHEN ordinal > stop_ordinal OR found <> 'observed' THEN 0 ELSE rows END AS rows
  FROM seen s LEFT JOIN stops t ON s.run_id = t.run_id)"""

oracle("deals_ledger", f"WITH {_DEALS_LEDGER} SELECT * FROM ledger")

oracle("deals_coverage", f"""WITH {_DEALS_LEDGER}
SELECT run_id, kind, count(*) AS days, count(*) FILTER (outcome = 'observed') AS observed,
  count(*) FILTER (outcome = 'unverified') AS unverified, count(*) FILTER (outcome = 'not_attempted') AS not_attempted,
  count(*) FILTER (outcome = 'source_blocked') AS blocked, CAST(sum(rows) AS BIGINT) AS rows,
  count(*) FILTER (outcome = 'observed') = count(*) AND sum(rows) > 0 AS success FROM ledger GROUP BY run_id, kind""")

# coverage rows as documents, their fields in alphabetical order
_DOCUMENTS = f"""prices AS ({ORACLES["price_coverage"]}), fundamentals AS ({ORACLES["fundamentals_coverage"]}),
sold AS ({ORACLES["deals_coverage"]}), {_TASKS},
documents AS (
  SELECT run_id, 'prices' AS task, success AS complete, raised, requested AS size, to_json({{
    'attempted': attempted, 'deferred': deferred, 'historical_completeness': historical_completeness,
    'not_attempted': not_attempted, 'not_returned': not_returned, 'pending_provider': pending_provider,
    'provider_candidates': provider_candidates, 'raised': raised, 'requested': requested, 'returned': returned,
    'row_quality_rejected': row_quality_rejected, 'stop_category': stop_category, 'stop_symbol': stop_symbol,
    'success': success}})::VARCHAR AS coverage FROM prices
  UNION ALL
  SELECT run_id, 'fundamentals', success, raised, requested, to_json({{
    'deferred': deferred, 'historical_completeness': historical_completeness, 'not_returned': not_returned,
    'raised': raised, 'requested': requested, 'returned': returned,
    'snapshot_as_of_date_ist': snapshot_as_of_date_ist, 'stop_reason': stop_reason, 'stop_symbol': stop_symbol,
    'success': success}})::VARCHAR FROM fundamentals
  UNION ALL
  SELECT run_id, 'deals', bool_and(success), false, sum(days), '{{' || string_agg('"' || kind || '":' || to_json({{
    'blocked': blocked, 'days': days, 'not_attempted': not_attempted, 'observed': observed, 'rows': rows,
    'success': success, 'unverified': unverified}})::VARCHAR, ',' ORDER BY kind) || '}}' FROM sold GROUP BY run_id),
statuses AS (
  SELECT run_id, task, status, cents, CAST(NULL AS VARCHAR) AS coverage FROM tasks
  UNION ALL
  SELECT run_id, task, CASE WHEN raised THEN 'ERROR' WHEN complete THEN 'SUCCESS' ELSE 'FAILED' END,
    CASE WHEN raised THEN 0 ELSE CAST(size AS BIGINT) END, coverage FROM documents)"""

oracle("task_statuses", f"WITH {_DOCUMENTS} SELECT run_id, task, status, cents / 100.0 AS seconds, coverage FROM statuses")

oracle("run_summary", f"""WITH {_DOCUMENTS}
SELECT run_id, count(*) AS tasks, count(*) FILTER (status = 'SUCCESS') AS successful,
  count(*) FILTER (status <> 'SUCCESS') AS failed, CAST(sum(cents) AS BIGINT) / 100.0 AS total_seconds,
  count(*) FILTER (status <> 'SUCCESS') = 0 AS all_tasks_success, 'not_verified' AS historical_completeness
FROM statuses GROUP BY run_id""")

oracle("fetch_outcomes", f"""WITH {EVENTS}, fetched AS (
  SELECT event_id, CASE WHEN event_type = 'signup' AND k < 30 THEN 'tls' WHEN event_type = 'signup' AND k < 60 THEN 'timeout' END AS error,
    CASE WHEN event_type = 'error' THEN 400 + k WHEN event_type = 'click' AND k < 20 THEN 503 ELSE 200 END AS status,
    CASE WHEN value < 50 THEN 1 WHEN value < 100 THEN 2 ELSE 3 END AS attempt FROM numbered)
SELECT event_id, CASE WHEN error = 'tls' THEN 'tls_error' WHEN error IS NULL AND status IN (401, 403, 429) THEN 'denied'
  WHEN error IS NULL AND status BETWEEN 400 AND 499 THEN 'client_error'
  WHEN (error IS NOT NULL OR status >= 400) AND attempt >= 3 THEN 'exhausted'
  WHEN error IS NOT NULL OR status >= 400 THEN 'retry' ELSE 'received' END AS outcome FROM fetched""")

# --- documents ---

oracle("listing_flatten", """SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS name, p_brand AS "group", p_type AS status,
  CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) END AS isin FROM part""")

oracle("action_counts", """SELECT CAST(floor(o_orderkey / 50.0) AS BIGINT) AS document, count(*) AS actions
FROM orders GROUP BY 1""")

oracle("html_actions", """WITH bodies AS (
  SELECT * FROM pages WHERE contains(html, '</body>'))
SELECT page_id, url AS symbol, 'Page row' AS type, '2024-01-02' AS ex_date, 'N/A' AS value, DATE '2024-01-02' AS ex_day FROM bodies
UNION ALL SELECT page_id, CAST(page_id AS VARCHAR), 'Split', 'n/a', '2:1 & more', NULL FROM bodies""")

oracle("payload_shape", f"""WITH {SNAPSHOTS}
SELECT symbol AS requested_symbol,
  CASE odd WHEN 7 THEN 'array' WHEN 8 THEN 'missing' ELSE 'object' END AS payload_type,
  CASE WHEN odd IN (7, 8) THEN NULL WHEN odd = 4 THEN 16 ELSE 17 END AS field_count,
  CASE WHEN odd IN (7, 8) THEN '' WHEN odd = 4 THEN
    'bookValue,currency,currentPrice,debtToEquity,dividendYield,fiftyTwoWeekHigh,fiftyTwoWeekLow,financialCurrency,longName,' ||
    'netIncomeToCommon,priceToBook,returnOnEquity,sector,symbol,totalRevenue,trailingPE'
    ELSE 'bookValue,currency,currentPrice,debtToEquity,dividendYield,fiftyTwoWeekHigh,fiftyTwoWeekLow,financialCurrency,longName,' ||
    'marketCap,netIncomeToCommon,priceToBook,returnOnEquity,sector,symbol,totalRevenue,trailingPE' END AS fields,
  CASE WHEN odd IN (4, 7, 8) THEN NULL WHEN odd = 1 THEN 'string' WHEN odd = 2 THEN 'boolean' WHEN odd = 3 THEN 'void'
    ELSE 'decimal' END AS market_cap_type,
  odd NOT IN (4, 7, 8) AS market_cap_present,
  CASE WHEN odd IN (7, 8) THEN NULL WHEN odd = 5 THEN 'USD' ELSE 'INR' END AS currency,
  odd NOT IN (6, 7, 8) AS symbol_matches
FROM customers""")

oracle("fundamentals_gate", f"WITH {SNAPSHOTS} SELECT symbol, fault FROM gated")

oracle("fundamentals_table", f"""WITH {SNAPSHOTS}
SELECT replace(symbol, '.NS', '') AS symbol, gated.symbol AS provider_symbol, 'yahoo_finance' AS source,
  '1' AS provider_version, '2026-09-22T04:30:00+00:00' AS retrieved_at_utc, true AS snapshot_only,
  'INR' AS market_cap_currency, 'INR' AS financial_currency, c_name AS name, c_mktsegment AS sector,
  CAST(NULL AS VARCHAR) AS industry, c_acctbal AS market_cap, CAST(c_nationkey AS DOUBLE) AS pe_ratio, """ + ", ".join(
    f'CASE WHEN (c_custkey + {i}) % 7 <> 0 THEN CAST(c_custkey * 3 + {i} AS DOUBLE) END AS "{name}"'
    for i, name in enumerate((
        "dividend_yield", "book_value", "pb_ratio", "revenue", "net_income", "roe", "debt_to_equity", "current_price",
        "52_week_high", "52_week_low",
    ))
) + " FROM gated WHERE fault IS NULL")

oracle("content_hash", "SELECT doc_id, sha256(text) AS sha256, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")

oracle("checksum_verification", """SELECT d.doc_id AS file, CASE WHEN d.source = 'src0' THEN 'missing_file'
  WHEN d.source = 'src1' THEN 'unexpected_file' WHEN l.doc_id IS NOT NULL THEN 'checksum_mismatch'
  ELSE 'verified' END AS status
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) l ON d.doc_id = l.doc_id""")

oracle("artifact_gate", f"""WITH {RAW},
expected AS (SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS run_id, {SYMBOL} AS symbol, {DAY} AS date FROM lineitem),
prices AS (SELECT run_id, symbol, CAST(ts AS DATE) AS date, adj_close FROM raw),
actual AS (SELECT DISTINCT run_id, symbol, date FROM prices),
dates AS (
  SELECT coalesce(e.run_id, a.run_id) AS run_id, coalesce(e.symbol, a.symbol) AS symbol,
    count(*) FILTER (a.run_id IS NULL OR e.run_id IS NULL) = 0 AS dates_match
  FROM expected e FULL JOIN actual a ON e.run_id = a.run_id AND e.symbol = a.symbol AND e.date = a.date
  GROUP BY ALL),
wanted AS (SELECT run_id, symbol, count(*) AS n FROM expected GROUP BY ALL),
counts AS (
  SELECT run_id, symbol, count(*) AS n, count(*) FILTER (adj_close = '50') = 0 AS provenance_matches FROM prices GROUP BY ALL),
lines AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS run_id, {SYMBOL} AS symbol, l_suppkey, l_linenumber AS n, CAST(l_quantity AS BIGINT) AS q,
    CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t FROM lineitem),
parts AS (
  SELECT run_id, symbol, n, min(d) AS d, max(t) AS t, 'part-' || CAST(n AS VARCHAR) || '.csv' AS file,
    run_id || ',' || symbol || ',' || CAST(n AS VARCHAR) || ',' || CAST(sum(q) AS VARCHAR) AS text
  FROM lines GROUP BY run_id, symbol, n),
sides AS (
  SELECT run_id, symbol, file, true AS wanted, NOT (n = 4 AND t = 8) AS recorded, NOT (n = 7 AND d = 1) AS present,
    NOT (n = 6 AND t = 3) AS same FROM parts
  UNION ALL SELECT run_id, symbol, 'notes.txt', false, false, true, true FROM parts WHERE n = 5 AND d = 2),
inventory AS (
  SELECT run_id, symbol, bool_and(recorded = wanted) AS manifest_files_exact, bool_and(present OR NOT wanted) AS no_file_missing,
    bool_and(wanted OR NOT present) AS no_file_extra, bool_and((present AND same) OR NOT recorded) AS checksums_match
  FROM sides GROUP BY run_id, symbol),
producers AS (
  SELECT run_id, symbol, sum(q) % 13 <> 5 AS one_manifest,
    sum(q) % 11 <> 3 AND sum(q) % 17 <> 2 AND sum(q) % 19 <> 1 AS producer_matches
  FROM lines GROUP BY run_id, symbol),
complete AS (
  SELECT run_id, symbol, count(*) FILTER (d = 10 AND t = 2) = 0
    AND coalesce(any_value(s_nationkey <> 7 AND s_acctbal <= 9000), false) AS coverage_complete
  FROM lines LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY run_id, symbol),
checks AS (
  SELECT d.run_id, d.symbol, d.dates_match, coalesce(c.n = w.n, false) AS count_matches,
    coalesce(c.provenance_matches, false) AS provenance_matches, s.s_suppkey IS NOT NULL AS one_snapshot,
    coalesce(s.s_acctbal > 0, false) AS cap_positive, coalesce(s.s_nationkey <> 3, false) AS currency_verified,
    coalesce(contains(lower(s.s_name), 'supplier#00000000'), false) AS name_matches,
    coalesce(one_manifest, false) AS one_manifest, coalesce(producer_matches, false) AS producer_matches,
    coalesce(manifest_files_exact, false) AS manifest_files_exact, coalesce(no_file_missing, false) AS no_file_missing,
    coalesce(no_file_extra, false) AS no_file_extra, coalesce(checksums_match, false) AS checksums_match,
    coalesce(coverage_complete, false) AS coverage_complete
  FROM dates d LEFT JOIN counts c ON d.run_id = c.run_id AND d.symbol = c.symbol
    LEFT JOIN wanted w ON d.run_id = w.run_id AND d.symbol = w.symbol
    LEFT JOIN supplier s ON d.symbol = 'S' || CAST(s.s_suppkey AS VARCHAR) || '.NS'
    LEFT JOIN producers p ON d.run_id = p.run_id AND d.symbol = p.symbol
    LEFT JOIN inventory i ON d.run_id = i.run_id AND d.symbol = i.symbol
    LEFT JOIN complete f ON d.run_id = f.run_id AND d.symbol = f.symbol)
SELECT *, dates_match AND count_matches AND provenance_matches AND one_snapshot AND cap_positive AND currency_verified
  AND name_matches AND one_manifest AND producer_matches AND manifest_files_exact AND no_file_missing AND no_file_extra
  AND checksums_match AND coverage_complete AS accepted FROM checks""")

# --- charts and reconciliation ---

oracle("window_epochs", """WITH windows AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 3 AS days FROM orders)
SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', start) AS BIGINT) * 86400 - 19800 AS period1,
  CAST(date_diff('day', DATE '1970-01-01', start) + days AS BIGINT) * 86400 - 19800 AS period2,
  days BETWEEN 1 AND 10 AS valid FROM windows""")

oracle("request_match", f"""WITH {CHARTS}, scopes AS (SELECT DISTINCT symbol, start FROM windowed),
fetched AS (
  SELECT *, date_diff('day', DATE '1970-01-01', start) * 86400 - 19800 AS period1,
    CASE WHEN dayofyear(start) > 300 THEN 'query2' WHEN month(start) = 6 THEN 'query3' ELSE 'query1' END AS host
  FROM scopes)
SELECT symbol, start, start + 10 AS "end", period1, period1 + 864000 AS period2,
  'https://' || host || '.finance.yahoo.com/v8/finance/chart/' || symbol AS url
FROM fetched WHERE month(start) NOT IN (1, 6, 7)""")

oracle("chart_decode", f"""WITH {CHARTS}
SELECT symbol, start, CAST(NULL AS VARCHAR) AS chart_code, date, open, high, low, close, volume, adjclose FROM source
UNION ALL
SELECT DISTINCT symbol, start, chart_code, CAST(NULL AS DATE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)
FROM coded WHERE chart_code IS NOT NULL""")

oracle("kept_bodies", f"""WITH {CHARTS}, docs AS (
  SELECT symbol, start, max(chart_code) AS code, count(*) AS n, day(start) = 11 AS failed FROM coded GROUP BY symbol, start)
SELECT symbol, start, CASE WHEN NOT failed THEN code END AS chart_code, code IS NULL AND NOT failed AS kept,
  CASE WHEN code IS NULL AND NOT failed THEN n END AS sessions FROM docs""")

oracle("reconcile_dates", f"WITH {CHARTS} SELECT symbol, start, date, class AS classification FROM paired")

oracle("reconcile_cells", f"""WITH {CHARTS}
SELECT symbol, start, date, field, source_value, adapter_value, classification FROM cells""")

oracle("reconcile_counts", f"WITH {CHARTS} SELECT classification, count(*) AS cells FROM cells GROUP BY classification")

oracle("adapter_gate", f"""WITH {RAW}, days AS (
  SELECT run_id, symbol, CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT ts) AS instants, count(ts) AS dated
  FROM raw GROUP BY ALL)
SELECT run_id, symbol, CAST(sum(n) AS BIGINT) AS adapter_rows,
  CASE WHEN bool_or(day IS NULL) OR bool_or(instants < dated) THEN 'ambiguous_adapter_frame'
    WHEN max(instants) > 1 THEN 'duplicate_adapter_dates' END AS adapter_error
FROM days GROUP BY ALL""")

oracle("boundary_probe", f"""WITH {CHARTS}, scopes AS (SELECT DISTINCT symbol, start FROM windowed),
documents AS (SELECT symbol, start, max(chart_code) AS code FROM coded GROUP BY ALL),
shape AS (
  SELECT symbol, start, count(*) AS adapter_rows, bool_or(volume = 17) AS infinite,
    bool_and(volume <> 17 AND close IS NOT NULL AND {_FOUR_USABLE}
    AND NOT (high < greatest(open, close, low) OR low > least(open, close, high))) AS passed
  FROM frames GROUP BY ALL),
compared AS (
  SELECT symbol, start, count(*) FILTER (classification = 'agree') AS agreeing,
    count(*) FILTER (classification <> 'agree') AS differing FROM cells GROUP BY ALL),
probed AS (
  SELECT s.symbol, s.start, CAST(s.start + 10 AS DATE) AS "end", CASE WHEN d.symbol IS NULL THEN 0 WHEN day(s.start) = 21 THEN 2 ELSE 1 END AS responses,
    d.code AS decode_code, CASE WHEN d.symbol IS NULL OR d.code IS NOT NULL OR day(s.start) IN (11, 21)
        THEN 'expected_one_valid_matching_response'
      WHEN f.symbol IS NULL THEN 'expected_one_adapter_frame'
      WHEN f.infinite THEN 'nonfinite_adapter_cell' END AS error_code,
    f.adapter_rows, c.agreeing, c.differing, f.passed
  FROM scopes s LEFT JOIN documents d ON s.symbol = d.symbol AND s.start = d.start
    LEFT JOIN shape f ON s.symbol = f.symbol AND s.start = f.start
    LEFT JOIN compared c ON s.symbol = c.symbol AND s.start = c.start)
SELECT symbol, start, "end", responses, decode_code,
  CASE WHEN error_code IS NULL THEN 'complete' ELSE 'incomplete' END AS probe_status, error_code,
  CASE WHEN error_code IS NULL THEN coalesce(adapter_rows, 0) END AS adapter_rows,
  CASE WHEN error_code IS NULL THEN coalesce(agreeing, 0) END AS agreeing_cells,
  CASE WHEN error_code IS NULL THEN coalesce(differing, 0) END AS differing_cells,
  error_code IS NULL AND coalesce(passed, false) AS passed FROM probed""")

LANDED = f"""
base AS (
  SELECT *, CAST(round(l_discount * 100) AS BIGINT) AS d, CAST(round(l_tax * 100) AS BIGINT) AS t, {CENTS} AS c,
    CAST(l_quantity AS BIGINT) AS q, l_suppkey % 8 AS v, strftime(l_shipdate, '%Y-%m') AS run_id, {SYMBOL} AS symbol
  FROM lineitem),
cells AS (
  SELECT run_id, symbol, v, d, t, l_orderkey, l_linenumber, l_partkey, c, q,
    CASE WHEN v = 7 AND d = 7 THEN 'soon' ELSE CAST({DAY} AS VARCHAR) END AS date,
    CASE WHEN v = 3 AND d = 5 THEN 'abc' ELSE CAST(c AS VARCHAR) END AS opened,
    CAST(c + d AS VARCHAR) AS high, CAST(c - q AS VARCHAR) AS low, CAST(c - 1 AS VARCHAR) AS closed,
    CASE WHEN l_returnflag = 'N' THEN '' ELSE CAST(q AS VARCHAR) END AS adjusted, CAST(q AS VARCHAR) AS volume,
    CAST(d AS VARCHAR) AS paid
  FROM base),
files AS (
  SELECT run_id, symbol, count(*) AS frame_rows,
    CASE any_value(v) WHEN 1 THEN 'missing_ohlcv_columns' WHEN 2 THEN 'ambiguous_columns' WHEN 6 THEN 'not_a_datetime_index'
      WHEN 3 THEN CASE WHEN bool_or(d = 5) THEN 'nonnumeric_column:Open' ELSE '' END
      WHEN 5 THEN CASE WHEN bool_or(t = 8) THEN 'ambiguous_columns' ELSE '' END
      WHEN 7 THEN CASE WHEN bool_or(d = 7) THEN 'not_a_datetime_index' ELSE '' END ELSE '' END AS frame_errors
  FROM cells GROUP BY run_id, symbol)
"""
HEADS = "['Date', 'Open', 'High', 'Low', 'Close', 'Adj Close', 'Volume']"

oracle("frame_gate", f"WITH {LANDED} SELECT * FROM files")

oracle("landed_cells", f"""WITH {LANDED},
rows AS (
  SELECT run_id, symbol,
    CASE v WHEN 1 THEN [date, opened, high, low, volume] WHEN 2 THEN [date, opened, high, low, closed, volume]
      WHEN 4 THEN [date, opened, high, low, closed, adjusted, volume, paid]
      WHEN 5 THEN CASE WHEN t = 8 THEN [date, opened, high, low, closed, adjusted, volume, paid]
        ELSE [date, opened, high, low, closed, adjusted, volume] END
      ELSE [date, opened, high, low, closed, adjusted, volume] END AS parts,
    CASE v WHEN 1 THEN ['Date', 'Open', 'High', 'Low', 'Volume'] WHEN 2 THEN ['Date', 'Open', 'Open', 'Low', 'Close', 'Volume']
      WHEN 4 THEN list_append({HEADS}, 'Dividends') WHEN 5 THEN list_append({HEADS}, '')
      WHEN 6 THEN list_prepend('Day', {HEADS}[2:]) ELSE {HEADS} END AS labels,
    l_orderkey, l_linenumber, l_partkey, c, q
  FROM cells JOIN files USING (run_id, symbol) WHERE frame_errors <> ''),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, symbol ORDER BY l_orderkey, l_linenumber, l_partkey, c, q,
    array_to_string(parts, ',')) - 1 AS row_position FROM rows),
each AS (SELECT run_id, symbol, row_position, unnest(range(len(parts))) AS i, labels, parts FROM placed),
named AS (SELECT run_id, symbol, row_position, i, labels[i + 1] AS field, parts[i + 1] AS x FROM each)
SELECT run_id, symbol, row_position, CAST(i AS INTEGER) AS place, field,
  CASE WHEN x = '' THEN 'null' WHEN try_cast(x AS DOUBLE) IS NOT NULL THEN 'double' ELSE 'string' END AS type,
  CASE WHEN x = '' THEN 'NULL' WHEN try_cast(x AS DOUBLE) IS NOT NULL THEN x ELSE chr(39) || x || chr(39) END AS text
FROM named""")

DEAL_LINES = f"""
base AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'bulk' ELSE 'block' END AS kind, {DAY} AS file_day, {SYMBOL} AS symbol,
    day({DAY}) % 5 AS v, l_linenumber AS n, {CENTS} AS c, CAST(l_quantity AS BIGINT) AS q, l_returnflag AS flag
  FROM lineitem)
"""

oracle("deal_headers", f"""WITH {DEAL_LINES}
SELECT kind, file_day AS day, count(*) AS rows,
  CASE any_value(v) WHEN 0 THEN 'Date,Symbol,Quantity,Price' WHEN 1 THEN 'SYMBOL,date,Price,Quantity,Client'
    WHEN 2 THEN 'Date,Name' WHEN 3 THEN 'Date,Symbol,SYMBOL,Quantity' ELSE 'Date,Symbol,Quantity' END AS names,
  any_value(v) <> 2 AS header_ok
FROM base GROUP BY kind, file_day""")

oracle("landed_deals", f"""WITH {DEAL_LINES},
broken AS (SELECT kind, file_day, bool_or(v = 2 OR (v = 4 AND n = 7)) AS bad FROM base GROUP BY kind, file_day),
texts AS (
  SELECT base.*, CASE WHEN n = 3 THEN NULL WHEN n = 4 THEN 'not-a-date' ELSE CAST(file_day AS VARCHAR) END AS date_text,
    CASE WHEN n = 2 THEN 'many' ELSE CAST(q AS VARCHAR) END AS quantity_text,
    CASE WHEN v IN (0, 1) THEN CAST(c AS VARCHAR) || CASE WHEN n = 5 THEN '.005' ELSE '' END END AS price_text
  FROM base JOIN broken USING (kind, file_day) WHERE NOT bad)
SELECT kind, file_day, CASE WHEN n NOT IN (3, 4) THEN file_day END AS deal_date, symbol,
  CASE WHEN n <> 2 THEN q END AS quantity,
  CASE WHEN v IN (0, 1) THEN c * 1000 + CASE WHEN n = 5 THEN 5 ELSE 0 END END AS price_mills,
  CASE WHEN v = 1 THEN flag END AS client, date_text, quantity_text, price_text,
  CASE WHEN v = 3 THEN 'SYMBOL=' || flag ELSE '' END AS extras
FROM texts""")

oracle("bundle_manifest", f"""WITH {VERDICTS}
SELECT run_id, symbol, frame_rows, usable_rows, rejected_rows, passed, '1' AS run_attempt,
  'not_verified' AS historical_completeness, CAST(sum(frame_rows) OVER () AS BIGINT) AS frame_part_rows,
  CAST(sum(rejected_rows) OVER () AS BIGINT) AS rejected_part_rows, true AS files_verified FROM verdicts""")

oracle("rejected_lines", f"""WITH {AUDITED}
SELECT run_id, symbol, row_position, reasons, CAST(6 AS INTEGER) AS cells FROM audited WHERE reasons <> ''""")

oracle("loaded_table", """SELECT l_orderkey * 10 + l_linenumber AS id,
  CAST(l_linenumber AS VARCHAR) || '.' || lpad(CAST(l_orderkey AS VARCHAR), 19, '0') AS exact, CAST(l_quantity AS DOUBLE) AS quantity,
  CASE l_linenumber WHEN 3 THEN 'first' || chr(10) || chr(10) || '"' || l_returnflag || '", last' WHEN 4 THEN 'a, b'
    WHEN 5 THEN NULL ELSE l_linestatus END AS note FROM lineitem""")
