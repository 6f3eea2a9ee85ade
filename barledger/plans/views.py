"""The given tables seen as market data.

Every view is a whole table, or a derivation of all its rows; faults come from the values of the
rows themselves, so each rule meets data that breaks it at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barledger.functions.market import local_midnight_epoch
from barledger.functions.values import held, once

WINDOW_DAYS = 10
WINDOW_ORIGIN = "1995-01-01"
SESSION_OPEN_SECONDS = 33_300


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def provider_symbol(key: Column, prefix: str = "S") -> Column:
    return F.concat(F.lit(prefix), key.cast("string"), F.lit(".NS"))


def cents(value: Column) -> Column:
    """Whole hundredths of an amount that has no smaller part."""
    return F.floor(value * 100 + 0.5)


def month(value: Column) -> Column:
    """``yyyy-MM`` of a day, cut from its ISO text."""
    return F.substring(day(value).cast("string"), 1, 7)


def day(value: Column) -> Column:
    return value.cast("date")


# --- prices ------------------------------------------------------------------------------------

# Packs (order, line, price in cents) into one exact number that sorts like the three. A number
# keeps the aggregation buffer fixed-width, so the bars are built by hash and not by sorting.
PRICE_DIGITS = 12
LINE_DIGITS = 3


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each supplier: first, highest, lowest and last price, and summed quantity."""
    daily = _daily(
        table(spark, sf_dir, "lineitem"), ("l_suppkey", day(F.col("l_shipdate")).alias("date")),
        F.col("l_orderkey"), F.col("l_linenumber"), cents(F.col("l_extendedprice")), F.col("l_quantity").cast("bigint"),
    )
    return daily.select(provider_symbol(F.col("l_suppkey")).alias("symbol"), "date", *BAR_VALUES)


BAR_VALUES = ("open", "high", "low", "close", "close_cents", "volume")


def _daily(
    lines: DataFrame, keys: tuple[str | Column, ...], order_key: Column, number: Column, price: Column, quantity: Column,
) -> DataFrame:
    """Bars of the lines of each of the keys."""
    line_and_price = (number * F.lit(10**PRICE_DIGITS) + price).cast("decimal(18,0)")
    order = order_key.cast("decimal(20,0)") * F.lit(10 ** (PRICE_DIGITS + LINE_DIGITS)).cast("decimal(16,0)")
    trade = (order + line_and_price).cast("decimal(38,0)")
    daily = lines.groupBy(*keys).agg(
        F.min(trade).alias("first"), F.max(price).alias("high"), F.min(price).alias("low"),
        F.max(trade).alias("last"), F.sum(quantity).alias("volume"),
    )
    # the last digits as text: a remainder of numbers of this length costs several times more
    opened = F.right(F.col("first").cast("string"), F.lit(PRICE_DIGITS)).cast("bigint")
    closed = F.right(F.col("last").cast("string"), F.lit(PRICE_DIGITS)).cast("bigint")
    return daily.withColumns({
        "open": opened / 100, "high": F.col("high") / 100, "low": F.col("low") / 100, "close": closed / 100,
        "close_cents": closed,
    })


def raw_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as a provider row of its supplier's frame in a monthly run."""
    discount, tax = cents(F.col("l_discount")), cents(F.col("l_tax"))
    base = table(spark, sf_dir, "lineitem").select(
        "*", discount.alias("d"), tax.alias("t"),
        F.col("l_extendedprice").alias("p"), F.col("l_quantity").alias("q"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("stamp"),
    )
    d, t, p, q = (F.col(name) for name in "dtpq")
    null, infinite = F.lit(None).cast("double"), F.lit(float("inf"))
    many = (d == 8) & (t == 8)
    # late lines with this discount break one more field each, by their tax
    rare = lambda tax: (d == 7) & (t == tax) & (F.col("l_linenumber") >= 6)
    return base.select(
        month(F.col("l_shipdate")).alias("run_id"),
        provider_symbol(F.col("l_suppkey")).alias("symbol"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_position"),
        F.when((d == 9) & (t == 6), F.lit(None))
        .when((d == 9) & (t == 5), F.col("stamp") + F.expr("interval 31 days"))
        .otherwise(F.col("stamp")).alias("ts"),
        F.when(((d == 10) & (t == 8)) | many, F.when(q > 25, F.lit(float("nan"))).otherwise(null))
        .when(rare(3), infinite).when(rare(7), F.lit(0.0)).otherwise(p).alias("open"),
        F.when(((d == 10) & (t == 7)) | many, infinite)
        .when((d == 9) & (t == 7), p - q - 100)
        .when(rare(0), null).when(rare(8), F.lit(-1.0))
        .otherwise(p + d).alias("high"),
        F.when((d == 10) & (t == 6), F.lit(0.0)).when(many, F.lit(-1.0)).when(rare(1), null).when(rare(4), infinite)
        .otherwise(p - q - t).alias("low"),
        F.when(rare(2), F.lit(float("nan"))).when(rare(5), infinite)
        .when((d == 6) & (t == 8) & (F.col("l_linenumber") >= 6), F.lit(0.0)).otherwise(p - q).alias("close"),
        F.when((d == 9) & (t == 8), F.lit("bad")).when(F.col("l_returnflag") == "N", F.lit(None))
        .otherwise(q.cast("bigint").cast("string")).alias("adj_close"),
        F.when(((d == 10) & (t == 5)) | many, -q).when((d == 10) & (t == 4), q + 0.5)
        .when((d == 10) & (t == 3), null).when(rare(6), infinite).otherwise(q).alias("volume"),
        day(F.trunc("l_shipdate", "month")).alias("request_start"),
        F.add_months(F.trunc("l_shipdate", "month"), 1).alias("request_end"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier seen in a quarter is requested in each month of that quarter."""
    seen = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", day(F.trunc("l_shipdate", "quarter")).alias("quarter")
    ).distinct()
    months = seen.select("l_suppkey", F.explode(F.array(*[F.add_months("quarter", n) for n in range(3)])).alias("start"))
    return months.select(
        month(F.col("start")).alias("run_id"),
        F.col("l_suppkey").alias("ordinal"),
        provider_symbol(F.col("l_suppkey")).alias("symbol"),
        "start",
        F.add_months("start", 1).alias("end"),
    )


def tableless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests that no table came for, if nothing was traded: their fetch failed, or the supplier is of one of ten nations."""
    silent = table(spark, sf_dir, "supplier").where("s_nationkey < 10").select(F.col("s_suppkey").alias("ordinal"))
    asked = requests(spark, sf_dir).join(silent, "ordinal", "left_semi").select("run_id", "symbol")
    return asked.unionByName(price_fetches(spark, sf_dir).where("status <> 200").select("run_id", "symbol"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers in debt are deferred from a day that depends on their nation."""
    return table(spark, sf_dir, "supplier").where(F.col("s_acctbal") < 0).select(
        provider_symbol(F.col("s_suppkey")).alias("symbol"),
        F.date_add(F.lit(WINDOW_ORIGIN).cast("date"), (F.col("s_nationkey") * 60).cast("int")).alias("effective_date"),
        F.concat(F.lit("policy-"), F.col("s_nationkey").cast("string")).alias("policy_id"),
        F.lit("account_in_debt").alias("reason"),
        F.array("s_name").alias("evidence_urls"),
    )


# --- charts ------------------------------------------------------------------------------------


def window_start(date: Column) -> Column:
    """First day of the ten-day request window that a date is in."""
    offset = F.datediff(date, F.lit(WINDOW_ORIGIN).cast("date"))
    return F.date_add(F.lit(WINDOW_ORIGIN).cast("date"), (F.floor(offset / WINDOW_DAYS) * WINDOW_DAYS).cast("int"))


def chart_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with the start of their ten-day request window.

    The lines of a symbol's window are brought together once, and what is grouped by symbol and window, or by more, stays
    there. Their values travel as one array, so that a job that needs some of them here and others there moves them once.
    The day is one of them: beside ``start``, which is made of it, the planner would know two ways to tell the places apart,
    and sides with other ways are not known to be together.
    """
    values = {
        "order_key": F.col("l_orderkey"), "number": F.col("l_linenumber").cast("bigint"), "price": cents(F.col("l_extendedprice")),
        "quantity": F.col("l_quantity").cast("bigint"), "day": F.unix_date(day(F.col("l_shipdate"))).cast("bigint"),
    }
    value = {name: F.get("values", F.lit(i)) for i, name in enumerate(values)}
    date = F.date_from_unix_date(value.pop("day").cast("int"))
    symbol, start = provider_symbol(F.col("l_suppkey")), window_start(date)
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.array(*values.values()).alias("values"))
    together = lines.repartition(symbol, start).select(
        symbol.alias("symbol"), start.alias("start"), held(F.col("values")).alias("values")
    )
    return _daily(together.withColumn("date", date), ("symbol", "start", "date"), *value.values()).select(
        "symbol", "date", *BAR_VALUES, "start"
    )


def chart_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chart document per symbol and window; a group holds at most ten daily bars.

    The volume of the first session decides whether and how a document is broken.
    """
    source = chart_bars(spark, sf_dir).where(F.col("volume") != 14)
    session = F.struct("date", "open", "high", "low", "close", "volume")
    folded = source.groupBy("symbol", "start").agg(F.sort_array(F.collect_list(session)).alias("s"))
    first = F.col("s")[0]["volume"]
    stamps = F.transform("s", lambda x: local_midnight_epoch(x["date"]) + SESSION_OPEN_SECONDS)
    closes = F.transform("s", lambda x: F.when(~x["volume"].isin(11, 12), x["close"]))

    def values(name: str) -> Column:
        return F.transform("s", lambda x: x[name].cast("double"))

    # Each part is a column before it is used twice, so the plan holds one copy of it.
    lows = F.when(first == 6, F.slice(values("low"), F.lit(2), F.size("s"))).otherwise(values("low"))
    quote = F.struct(
        values("open").alias("open"), values("high").alias("high"), lows.alias("low"),
        closes.alias("close"), F.transform("s", lambda x: x["volume"]).alias("volume"),
    )
    folded = folded.withColumn("quote", quote)
    indicators = F.struct(
        F.when(first == 5, F.array("quote", "quote")).otherwise(F.array("quote")).alias("quote"),
        F.array(F.struct(closes.alias("adjclose"))).alias("adjclose"),
    )
    result = F.struct(
        F.struct(
            F.col("symbol"),
            F.when(first == 3, F.lit("USD")).otherwise(F.lit("INR")).alias("currency"),
            F.lit("EQUITY").alias("instrumentType"),
            F.lit("Asia/Kolkata").alias("exchangeTimezoneName"),
            F.lit("1d").alias("dataGranularity"),
        ).alias("meta"),
        F.when(first == 4, F.concat(stamps, F.slice(stamps, 1, 1)))
        .when(first == 9, F.transform(stamps, lambda x, i: x + F.when(i == 0, WINDOW_DAYS * 86_400).otherwise(0)))
        .otherwise(stamps).alias("timestamp"),
        indicators.alias("indicators"),
    )
    folded = folded.withColumn("result", result)
    chart = F.struct(
        F.when(first == 1, F.lit("not found")).alias("error"),
        F.when(first == 2, F.array("result", "result")).otherwise(F.array("result")).alias("result"),
    )
    folded = folded.withColumn("text", F.to_json(F.struct(chart.alias("chart"))))
    text = F.col("text")
    body = (
        F.when(first == 7, F.regexp_replace(text, r'"close":\[[^,\]]*', '"close":["x"'))
        .when(first == 8, F.regexp_replace(text, r'"open":\[[^,\]]*', '"open":[NaN'))
        .otherwise(text)
    )
    return folded.select(
        "symbol", "start", F.date_add("start", WINDOW_DAYS).alias("end"), F.lit(200).alias("status_code"),
        body.alias("body"),
    )


def adapter_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars as an adapter returned them: some absent, missing or changed."""
    volume, close = F.col("volume"), F.col("close")
    adapted = (
        F.when(volume == 11, F.lit(None).cast("double"))
        .when(volume == 15, F.lit(float("nan")))
        .when(volume == 16, close + 1)
        .otherwise(close)
    )
    return chart_bars(spark, sf_dir).where(volume != 13).select(
        "symbol", "start", "date", F.col("date").cast("timestamp_ntz").alias("ts"),
        "open", "high", "low", adapted.alias("close"), adapted.alias("adj_close"), volume.cast("double").alias("volume"),
    )


def chart_scopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (symbol, window) with a bar, as a chart request. Every traded line is in a bar, so the bars need not be built."""
    seen = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", window_start(day(F.col("l_shipdate"))).alias("start")
    ).distinct()
    return seen.select(
        provider_symbol(F.col("l_suppkey")).alias("symbol"), "start", F.date_add("start", WINDOW_DAYS).alias("end")
    )


def fetch_log(spark: SparkSession, sf_dir: str, scopes: DataFrame) -> DataFrame:
    """Requests of all scopes, some of them not quite right, among all page fetches."""
    year_day = F.dayofyear("start")
    early = year_day <= 73
    scheme = F.when(early & (F.month("start") == 1), F.lit("http://")).otherwise(F.lit("https://"))
    host = F.when(year_day > 300, F.lit("query2.finance.yahoo.com")).when(
        F.month("start") == 6, F.lit("query3.finance.yahoo.com")
    ).otherwise(F.lit("query1.finance.yahoo.com"))
    interval = F.when(F.month("start") == 7, F.lit("1wk")).otherwise(F.lit("1d"))
    charts = scopes.select(
        F.concat(scheme, host, F.lit("/v8/finance/chart/"), F.col("symbol")).alias("url"),
        once(F.create_map(
            F.lit("period1"), F.col("period1").cast("string"), F.lit("period2"), F.col("period2").cast("string"),
            F.lit("interval"), interval,
        )).alias("params"),
    )
    pages = table(spark, sf_dir, "pages").select("url", F.lit(None).cast("map<string,string>").alias("params"))
    return charts.unionByName(pages)


# --- fundamentals, listings, actions -------------------------------------------------------------

# Number fields of a fundamentals response besides the market cap and the price-earnings ratio, as documents name them.
DOCUMENT_NUMBERS = (
    "dividendYield", "bookValue", "priceToBook", "totalRevenue", "netIncomeToCommon", "returnOnEquity", "debtToEquity",
    "currentPrice", "fiftyTwoWeekHigh", "fiftyTwoWeekLow",
)


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a fundamentals response; some are not what was asked for."""
    building = F.col("c_mktsegment") == "BUILDING"

    def odd(nation: int) -> Column:
        return building & (F.col("c_nationkey") == nation)

    symbol = provider_symbol(F.col("c_custkey"), "C")
    cap = (
        F.when(odd(1), F.lit(',"marketCap":"N/A"')).when(odd(2), F.lit(',"marketCap":true'))
        .when(odd(3), F.lit(',"marketCap":null')).when(odd(4), F.lit(""))
        .otherwise(F.concat(F.lit(',"marketCap":'), F.col("c_acctbal").cast("string")))
    )
    currency = F.when(odd(5), F.lit("USD")).otherwise(F.lit("INR"))
    named = F.when(odd(6), F.lit("OTHER.NS")).otherwise(symbol)
    numbers = [
        F.concat(F.lit(f',"{key}":'), F.when((F.col("c_custkey") + i) % 7 == 0, F.lit("null")).otherwise((F.col("c_custkey") * 3 + i).cast("string")))
        for i, key in enumerate(DOCUMENT_NUMBERS)
    ]
    body = F.concat(
        F.lit('{"symbol":"'), named, F.lit('","longName":"'), F.col("c_name"), F.lit('","sector":"'),
        F.col("c_mktsegment"), F.lit('"'), cap, F.lit(',"currency":"'), currency,
        F.lit('","financialCurrency":"INR","trailingPE":'), F.col("c_nationkey").cast("string"), *numbers, F.lit("}"),
    )
    whole = F.when(odd(7), F.concat(F.lit("["), body, F.lit("]"))).when(odd(8), F.lit("<html>busy</html>")).otherwise(body)
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").cast("string").alias("run_id"), F.col("c_custkey").alias("ordinal"),
        symbol.alias("symbol"), whole.alias("body"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as already collected snapshots."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
        F.col("c_acctbal").alias("market_cap"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / (F.col("c_nationkey") + 1)).alias("pe_ratio"),
        F.col("c_nationkey").cast("double").alias("dividend_yield"),
    )


def listing_documents(spark: SparkSession, sf_dir: str, block: int = 100) -> DataFrame:
    """Parts as listing documents of up to ``block`` companies, by part number."""
    company = F.create_map(
        F.lit("Scrip Code"), F.col("p_partkey").cast("string"), F.lit("Scrip Name"), F.col("p_name"),
        F.lit("Group"), F.col("p_brand"), F.lit("Status"), F.col("p_type"),
    )
    with_isin = F.when(F.col("p_size") > 25, F.map_concat(company, F.create_map(F.lit("ISIN"), F.col("p_size").cast("string")))).otherwise(company)
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(F.col("p_partkey") / block).alias("document"))
        .agg(F.collect_list(with_isin).alias("Table"))
        .select("document", F.to_json(F.struct("Table")).alias("body"))
    )


def action_documents(spark: SparkSession, sf_dir: str, block: int = 50) -> DataFrame:
    """Orders as JSON arrays of corporate actions, by blocks of order numbers."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.floor(F.col("o_orderkey") / block).alias("document"))
        .agg(F.collect_list(F.struct(F.col("o_custkey").alias("symbol"), F.col("o_orderpriority").alias("type"))).alias("a"))
        .select("document", F.to_json("a").alias("body"))
    )


def escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text


def action_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All web pages, each with a table about itself before the end of its body."""
    url = escaped(F.col("url"))
    rows = F.concat(
        F.lit("<TABLE class=x><tr><th>Symbol<th>Type</tr><tr><td> "), url,
        F.lit(" </td><td><b>Page</b> row<br></td><td>2024-01-02</td></tr><tr><td>"), F.col("page_id").cast("string"),
        F.lit("</td><td>Split</td><td>n/a</td><td>2:1 &amp; more</td><td>extra</td></tr>"
              "<tr><td>two</td><td>cells</td></tr></TABLE>"),
    )
    return table(spark, sf_dir, "pages").select(
        "page_id", F.replace(F.col("html"), F.lit("</body>"), F.concat(rows, F.lit("</body>"))).alias("html")
    )


# --- deals and events ------------------------------------------------------------------------------


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linestatus") == "O", F.lit("bulk")).otherwise(F.lit("block")).alias("kind"),
        day(F.col("l_shipdate")).alias("deal_date"),
        provider_symbol(F.col("l_suppkey")).alias("symbol"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("client"),
    )


def event_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the number in their properties as ``k``."""
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def price_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a fetch of its user's frame in a monthly run: errors are denials or faults after the last attempt."""
    event = event_number(spark, sf_dir)
    failed = F.col("event_type") == "error"
    run = F.concat(
        F.lit("199"), (F.col("k") % 7 + 2).cast("string"), F.lit("-"),
        F.lpad((F.dayofmonth("ts") % 12 + 1).cast("string"), 2, "0"),
    )
    return event.select(
        run.alias("run_id"), provider_symbol(F.col("user_id")).alias("symbol"),
        F.when(failed & (F.col("value") < 50), F.lit(403)).when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.lit(None).cast("string").alias("error_kind"), F.lit(3).alias("attempt"),
    )


def snapshot_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of users who are customers as fetches of their documents; some errors are denials, some faults."""
    event = event_number(spark, sf_dir)
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("string").alias("run_id")
    )
    failed = (F.col("event_type") == "error") & (F.col("k") < 6)
    return event.join(customer, "user_id").select(
        "run_id", provider_symbol(F.col("user_id"), "C").alias("symbol"),
        F.when(failed & (F.col("k") < 3), F.lit(429)).when(failed, F.lit(500)).otherwise(F.lit(200)).alias("status"),
        F.lit(None).cast("string").alias("error_kind"), F.lit(3).alias("attempt"),
    )


def deal_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last fetch of each user (as run), family and day."""
    event = event_number(spark, sf_dir)
    failed = F.col("event_type") == "error"
    status = F.when(failed & (F.col("value") < 80), F.lit(404)).when(failed, F.lit(503)).otherwise(F.lit(200))
    return event.groupBy(
        F.col("user_id").cast("string").alias("run_id"),
        F.when(F.col("k") < 50, F.lit("bulk")).otherwise(F.lit("block")).alias("kind"),
        day(F.col("ts")).alias("day"),
    ).agg(
        F.max_by(status, "event_id").alias("status"),
        F.max_by(F.col("k") < 98, "event_id").alias("header_ok"),
        F.max_by(F.col("k"), "event_id").alias("rows"),
    )


def deal_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's window: the first to the last day the user was seen."""
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("run_id")).agg(
        F.min(day(F.col("ts"))).alias("start"), F.max(day(F.col("ts"))).alias("end")
    )


def run_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user as a run of five tasks, one per kind of event."""
    return event_number(spark, sf_dir).groupBy(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_type").alias("task")
    ).agg(
        (F.max("k") < 97).alias("succeeded"),
        F.when(F.min("k") == 0, F.lit("fault")).alias("error"),
        (F.sum(cents(F.col("value"))) / 100).alias("seconds"),
    )


# --- artifacts -----------------------------------------------------------------------------------


def _month_start(value: Column) -> Column:
    """A number to group a month's rows by; its text is made once a group."""
    return day(F.trunc(value, "month"))


def sample_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each run and symbol: whether wanted, as its manifest records them, as they lie there.

    There is a file for each line number a supplier has in a month, whose content its quantities decide. Some are recorded
    and not there, or there and not recorded, some were changed after they were recorded.
    """
    parts = table(spark, sf_dir, "lineitem").groupBy(
        _month_start(F.col("l_shipdate")).alias("month"), "l_suppkey", "l_linenumber"
    ).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.min(cents(F.col("l_discount"))).alias("d"),
        F.max(cents(F.col("l_tax"))).alias("t"),
    ).select(
        month(F.col("month")).alias("run_id"), provider_symbol(F.col("l_suppkey")).alias("symbol"),
        F.col("l_linenumber").alias("n"), "q", "d", "t",
    )
    n, q, d, t = (F.col(name) for name in "nqdt")

    def content(text: Column) -> Column:
        return F.struct(F.octet_length(text).cast("bigint").alias("bytes"), F.sha2(text, 256).alias("sha256"))

    texts = parts.withColumn("text", F.concat_ws(",", "run_id", "symbol", n.cast("string"), q.cast("string")))
    held = texts.withColumn("content", content(F.col("text")))
    changed = F.when((n == 6) & (t == 3), content(F.concat("text", F.lit("!")))).otherwise(F.col("content"))
    extra = (n == 5) & (d == 2)

    def listed(name: Column, wanted: bool, recorded: Column, actual: Column) -> Column:
        return F.struct(name.alias("file"), F.lit(wanted).alias("wanted"), recorded.alias("recorded"), actual.alias("actual"))

    part = listed(
        F.concat(F.lit("part-"), n.cast("string"), F.lit(".csv")), True,
        F.when(~((n == 4) & (t == 8)), F.col("content")), F.when(~((n == 7) & (d == 1)), changed),
    )
    notes = F.when(extra, listed(F.lit("notes.txt"), False, F.when(~extra, F.col("content")), F.col("content")))
    rows = held.select("run_id", "symbol", F.explode(F.array(part, notes)).alias("row"))
    return rows.where(F.col("row").isNotNull()).select("run_id", "symbol", "row.*")


def sample_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of each run and symbol: who produced it, of what; some runs were made by another commit or twice."""
    grouped = table(spark, sf_dir, "lineitem").groupBy(_month_start(F.col("l_shipdate")).alias("month"), "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("q")
    ).select(month(F.col("month")).alias("run_id"), provider_symbol(F.col("l_suppkey")).alias("symbol"), "q")
    q = F.col("q")
    copies = F.explode(F.sequence(F.lit(1), F.when(q % 13 == 5, 2).otherwise(1)))
    return grouped.select(
        "run_id", "symbol", F.when(q % 11 == 3, F.lit("0ld")).otherwise(F.lit("c0ffee")).alias("commit_sha"),
        F.when(q % 17 == 2, F.lit("1")).otherwise(F.col("run_id")).alias("producer_run"),
        (q % 19 == 1).alias("synthetic"), copies.alias("copy"),
    )


def sample_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and returns of each run and symbol: prices by line, fundamentals of suppliers outside one nation."""
    back = ~((cents(F.col("l_discount")) == 10) & (cents(F.col("l_tax")) == 2))
    lines = table(spark, sf_dir, "lineitem").groupBy(_month_start(F.col("l_shipdate")).alias("month"), "l_suppkey").agg(
        F.count(F.lit(1)).alias("requested"), F.count_if(back).alias("returned")
    )
    known = table(spark, sf_dir, "supplier").where("s_nationkey <> 7").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_acctbal") > 9000, 0).otherwise(1).cast("bigint").alias("answered"),
    )

    def family(name: str, requested: Column, returned: Column) -> Column:
        return F.struct(F.lit(name).alias("family"), requested.alias("requested"), returned.alias("returned"))

    both = F.array(
        family("prices", F.col("requested"), F.col("returned")),
        F.when(F.col("answered").isNotNull(), family("fundamentals", F.lit(1).cast("bigint"), F.col("answered"))),
    )
    rows = lines.join(known, "l_suppkey", "left").select(
        month(F.col("month")).alias("run_id"), provider_symbol(F.col("l_suppkey")).alias("symbol"), F.explode(both).alias("row"),
    )
    return rows.where(F.col("row").isNotNull()).select("run_id", "symbol", "row.*")


# --- landed files ------------------------------------------------------------------------------

PRICE_HEADER = "Date,Open,High,Low,Close,Adj Close,Volume"


def numbered_lines(rows: DataFrame, file: Column, name: Column, line: Column, header: Column) -> DataFrame:
    """Lines of files: each file's header at -1, its rows from 0 in the order of their keys.

    Rows come without their texts, which are made where the rows of a file are together. A file's first row brings the header.
    """
    texts = {"file": file, "name": name, "line": line, "header": header}
    together = rows.repartition(file).select("*", *[text.alias(column) for column, text in texts.items()])
    order = Window.partitionBy("file").orderBy("l_orderkey", "l_linenumber", "l_partkey", "c", "q", "line")
    placed = together.withColumn("row_position", (F.row_number().over(order) - 1).cast("bigint"))
    body, head = F.struct("row_position", "line"), F.struct(F.lit(-1).cast("bigint").alias("row_position"), F.col("header").alias("line"))
    first = F.col("file").isNotNull() & (F.col("row_position") == 0)
    lines = placed.select("file", "name", F.explode(F.when(first, F.array(head, body)).otherwise(F.array(body))).alias("l"))
    # rows that are in no file may differ in their headers
    loose = rows.where(file.isNull()).select(file.alias("file"), name.alias("name"), F.lit(-1).cast("bigint").alias("row_position"), header.alias("line"))
    return lines.select("file", "name", "l.*").unionByName(loose.distinct())


def landed_price_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as a line of its supplier's monthly price file; suppliers differ in what is wrong with theirs."""
    text = lambda value: value.cast("string")
    base = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", day(F.col("l_shipdate")).alias("day"),
        cents(F.col("l_discount")).alias("d"), cents(F.col("l_tax")).alias("t"), cents(F.col("l_extendedprice")).alias("c"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    d, t, c, q = (F.col(name) for name in "dtcq")
    v = F.col("l_suppkey") % 8
    date = F.when((v == 7) & (d == 7), F.lit("soon")).otherwise(text(F.col("day")))
    opened = F.when((v == 3) & (d == 5), F.lit("abc")).otherwise(text(c))
    adjusted = F.when(F.col("l_returnflag") == "N", F.lit("")).otherwise(text(q))
    head, tail = [date, opened, text(c + d), text(c - q)], [text(c - 1), adjusted, text(q)]
    line = (
        F.when(v == 1, F.concat_ws(",", *head, text(q)))
        .when(v == 2, F.concat_ws(",", *head, text(c - 1), text(q)))
        .when((v == 4) | ((v == 5) & (t == 8)), F.concat_ws(",", *head, *tail, text(d)))
        .otherwise(F.concat_ws(",", *head, *tail))
    )
    header = (
        F.when(v == 1, F.lit("Date,Open,High,Low,Volume")).when(v == 2, F.lit("Date,Open,Open,Low,Close,Volume"))
        .when(v == 4, F.lit(PRICE_HEADER + ",Dividends")).when(v == 6, F.lit(PRICE_HEADER.replace("Date", "Day")))
        .otherwise(F.lit(PRICE_HEADER))
    )
    name = F.concat(provider_symbol(F.col("l_suppkey")), F.lit(".csv"))
    file = F.concat(F.lit("/landing/"), month(F.col("day")), F.lit("/"), name)
    return numbered_lines(base, file, name, line, header)


def landed_deal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as a line of its day's deal file; days differ in their headers."""
    base = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        day(F.col("l_shipdate")).alias("day"), cents(F.col("l_extendedprice")).alias("c"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    v, n, symbol = F.dayofmonth("day") % 5, F.col("l_linenumber"), provider_symbol(F.col("l_suppkey"))
    date = F.when(n == 3, F.lit("")).when(n == 4, F.lit("not-a-date")).otherwise(F.col("day").cast("string"))
    price = F.concat(F.col("c").cast("string"), F.when(n == 5, F.lit(".005")).otherwise(F.lit("")))
    quantity = F.when(n == 2, F.lit("many")).otherwise(F.col("q").cast("string"))
    line = (
        F.when(v == 0, F.concat_ws(",", date, symbol, quantity, price))
        .when(v == 1, F.concat_ws(",", symbol, date, price, quantity, "l_returnflag"))
        .when(v == 3, F.concat_ws(",", date, symbol, "l_returnflag", quantity))
        .when(v == 4, F.concat_ws(",", date, symbol, quantity, F.when(n == 7, F.lit("x"))))
        .otherwise(F.concat_ws(",", date, symbol))
    )
    header = (
        F.when(v == 0, F.lit("Date,Symbol,Quantity,Price")).when(v == 1, F.lit("SYMBOL,date,Price,Quantity,Client"))
        .when(v == 2, F.lit("Date,Name")).when(v == 3, F.lit("Date,Symbol,SYMBOL,Quantity"))
        .otherwise(F.lit("Date,Symbol,Quantity"))
    )
    kind = F.when(F.col("l_linestatus") == "O", F.lit("bulk")).otherwise(F.lit("block"))
    name = F.concat(kind, F.lit("deals_"), F.date_format("day", "ddMMMyyyy"), F.lit(".csv"))
    return numbered_lines(base, F.concat(F.lit("/landing/"), name), name, line, header)
