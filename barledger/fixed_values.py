"""Names, lists, patterns and dates that results must carry exactly."""

from __future__ import annotations

from datetime import date

# --- fixed values: requested universes, in request order ---------------------------------
PRICE_UNIVERSE = (
    "RELIANCE.NS", "TCS.NS", "INFY.NS", "WIPRO.NS", "HDFC.NS",
    "ICICIBANK.NS", "SBIN.NS", "MARUTI.NS", "BAJAJFINSV.NS", "TITAN.NS",
    "LT.NS", "NESTLEIND.NS", "ASIANPAINT.NS", "SUNPHARMA.NS", "DRREDDY.NS",
    "CIPLA.NS", "DMART.NS", "POWERGRID.NS", "ULTRACEMCO.NS", "COALINDIA.NS",
)
FUNDAMENTALS_UNIVERSE = (
    "RELIANCE.NS", "TCS.NS", "INFY.NS", "WIPRO.NS", "HDFC.NS",
    "ICICIBANK.NS", "SBIN.NS", "MARUTI.NS", "BAJAJFINSV.NS", "TITAN.NS",
    "LT.NS", "NESTLEIND.NS", "ASIANPAINT.NS", "SUNPHARMA.NS", "DRREDDY.NS",
)
SYMBOL_PATTERN = r"^[A-Z0-9][A-Z0-9&.\-]*\.NS$"

# --- fixed values: identity policies ------------------------------------------------------
KNOWN_TYPOS = {"INFOSY.NS": "INFY.NS"}
MERGER_EVIDENCE_URL = (
    "https://www.hdfc.bank.in/press-release/2023/q2/"
    "hdfc-ltd-to-merge-into-hdfc-bank-effective-july-1-2023"
)
SNAPSHOT_POLICIES = (
    {
        "symbol": "HDFC.NS",
        "effective_date": date(2023, 7, 1),
        "reason": "merged_issuer_has_no_current_standalone_snapshot",
        "evidence_url": MERGER_EVIDENCE_URL,
    },
)
# The second evidence address of this policy belongs to the caller's own run log.
PRICE_POLICIES = (
    {
        "symbol": "HDFC.NS",
        "effective_date": date(2026, 9, 22),
        "policy_id": "hdfc-yahoo-price-archive-v1",
        "reason": "reviewed_merged_issuer_and_unavailable_provider_history",
        "evidence_urls": [MERGER_EVIDENCE_URL],
    },
)
DEFERRED_STATUS = "archival_required"
ARCHIVE_FETCH_STATUS = "awaiting_verified_source"
NOT_VERIFIED = "not_verified"

# --- fixed values: provider price frame ---------------------------------------------------
PRICE_COLUMNS = {"Open": "open", "High": "high", "Low": "low", "Close": "close", "Volume": "volume"}
ADJUSTED_LABEL = "Adj Close"
PUBLISHED_COLUMNS = {
    "Date": "date", "Open": "open", "High": "high", "Low": "low", "Close": "close",
    "Adj Close": "adj_close", "Volume": "volume", "Symbol": "symbol",
}
PRICE_SOURCE = "yahoo_finance"
PRICE_BASIS = "provider_ohlc_no_additional_yfinance_adjustment"

# --- fixed values: rejection reasons, in reporting order ----------------------------------
FRAME_REASONS = (
    "ambiguous_columns", "missing_ohlcv_columns",
    "nonnumeric_column:Open", "nonnumeric_column:High", "nonnumeric_column:Low",
    "nonnumeric_column:Close", "nonnumeric_column:Volume",
    "not_a_datetime_index",
)
# Of a whole frame without rows: no table came, or an empty one.
NO_TABLE, EMPTY_FRAME = "not_a_dataframe", "empty_frame"
DATE_REASONS = ("missing_date", "date_outside_request", "duplicate_date")
NUMERIC_REASONS = (
    "missing:Open", "nonfinite:Open", "nonpositive:Open",
    "missing:High", "nonfinite:High", "nonpositive:High",
    "missing:Low", "nonfinite:Low", "nonpositive:Low",
    "missing:Close", "nonfinite:Close", "nonpositive:Close",
    "missing:Volume", "nonfinite:Volume", "negative:Volume", "fractional:Volume",
    "invalid:Adj Close", "ohlc_order",
)
ALL_REASONS = FRAME_REASONS + DATE_REASONS + NUMERIC_REASONS

# --- fixed values: outcome categories -----------------------------------------------------
ADMITTED = "admitted_frame"
ROW_QUALITY_REJECTED = "row_quality_rejected"
UNVERIFIED_RESPONSE = "unverified_response"
DENIED = "source_denied_or_rate_limited"
PROCESSING_ERROR = "source_or_processing_error"
PLAN_NOT_PERSISTED = "archival_plan_persistence_failed"
DENIED_STATUSES = (401, 403, 429)
MAX_ATTEMPTS = 3

# --- fixed values: source chart documents -------------------------------------------------
CHART_MAX_BYTES = 2_000_000
CHART_FIELDS = ("open", "high", "low", "close", "volume", "adjclose")
CHART_HOSTS = ("query1.finance.yahoo.com", "query2.finance.yahoo.com")
CHART_PATH = "/v8/finance/chart/"
CHART_INTERVAL = "1d"
EXCHANGE_ZONE = "Asia/Kolkata"
CHART_META = {
    "currency": "INR", "exchangeTimezoneName": EXCHANGE_ZONE,
    "instrumentType": "EQUITY", "dataGranularity": CHART_INTERVAL,
}
MAX_WINDOW_DAYS = 10

# --- fixed values: listings, deals, actions, catalog --------------------------------------
LISTING_COLUMNS = {
    "Scrip Code": "code", "Scrip Name": "name", "Group": "group", "Status": "status", "ISIN": "isin",
}
DEAL_KINDS = ("bulk", "block")
DEAL_REQUIRED = ("date", "symbol")
DEAL_LOOKBACK_DAYS = 90
MISSING_ACTION_VALUE = "N/A"
CATALOG_FILES = {
    "bhavcopy": "nse_bhavcopy.csv",
    "fundamentals": "fundamentals.csv",
    "bulk_deals": "bulk_deals.csv",
    "block_deals": "block_deals.csv",
    "corporate_actions": "corporate_actions.csv",
}

# --- fixed values: fundamentals snapshot columns and the document keys they come from -----
SNAPSHOT_TEXT = {
    "financial_currency": "financialCurrency", "name": "longName",
    "sector": "sector", "industry": "industry",
}
SNAPSHOT_NUMBERS = {
    "market_cap": "marketCap", "pe_ratio": "trailingPE", "dividend_yield": "dividendYield",
    "book_value": "bookValue", "pb_ratio": "priceToBook", "revenue": "totalRevenue",
    "net_income": "netIncomeToCommon", "roe": "returnOnEquity", "debt_to_equity": "debtToEquity",
    "current_price": "currentPrice", "52_week_high": "fiftyTwoWeekHigh", "52_week_low": "fiftyTwoWeekLow",
}
SNAPSHOT_CURRENCY = "INR"

# --- fixed values: text tokens a CSV reader takes as missing ------------------------------
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
