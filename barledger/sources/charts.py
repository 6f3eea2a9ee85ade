"""Source chart documents: matching requests, strict decoding, one row per session."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from barledger import fixed_values as fv
from barledger.functions.market import address, is_chart_request, local_day, local_midnight_epoch
from barledger.functions.values import once
from barledger.operators.skew import HOT_ROWS, row_counts

NONSTANDARD_NUMBER = r"[\[:,]\s*(NaN|-?Infinity)\s*[,\]}]"
NUMBER_ARRAY = r"^ARRAY<(VOID|BIGINT|DOUBLE|DECIMAL\([0-9]+,[0-9]+\))>$"
# What a valid document holds. A document that does not fit has its text in the last column.
UNREAD = "__unread"
_META = ",".join(f"{name}:string" for name in ("symbol", *fv.CHART_META))
_QUOTE = ",".join(f"{name}:array<double>" for name in fv.CHART_FIELDS if name != "adjclose")
CHART_SCHEMA = (
    "chart struct<error:string,result:array<struct<"
    f"meta:struct<{_META}>,timestamp:array<bigint>,"
    f"indicators:struct<quote:array<struct<{_QUOTE}>>,adjclose:array<struct<adjclose:array<double>>>>>>>, {UNREAD} string"
)
CHART_OPTIONS = {
    "mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREAD,
    "allowNonNumericNumbers": "false", "allowSingleQuotes": "false",
}


def request_scopes(requests: DataFrame) -> DataFrame:
    """Add the epoch bounds and the interval to requests of (symbol, start, end)."""
    return requests.withColumns({
        "period1": local_midnight_epoch(F.col("start")),
        "period2": local_midnight_epoch(F.col("end")),
        "interval": F.lit(fv.CHART_INTERVAL),
    })


def match_requests(fetch_log: DataFrame, scopes: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Fetches that are exactly the chart request of a scope, with the scope's columns.

    ``fetch_log`` has ``url`` and a string map ``params``. A fetch names its symbol and window, and is judged by them before
    it is moved: an exact request of its own scope is matched by one equi join, any other fetch goes nowhere. Requests that
    were repeated many times meet their scopes, few by counting, without moving a row.
    """
    # what an exact request's address has after the path; taking addresses apart is left to the fetches that may match
    text = F.substring_index(F.substring_index("url", "?", 1), "#", 1)
    place = F.locate(fv.CHART_PATH, text)
    symbol = F.when(place > 0, F.substring(text, place + len(fv.CHART_PATH), F.length("url")))
    windows = [F.try_element_at("params", F.lit(name)).try_cast("bigint").alias(f"__{name}") for name in ("period1", "period2")]
    asked = once(F.struct(symbol.alias("__symbol"), *windows)).alias("__asked")
    named = fetch_log.select("*", asked).select(*fetch_log.columns, "__asked.*")
    keys = ["__symbol", "__period1", "__period2"]
    hot = row_counts(named.dropna(subset=keys), keys, "__fetches").where(F.col("__fetches") > hot_rows).select(*keys)
    read = named.dropna(subset=keys).select("*", once(address(F.col("url"))).alias("__at"))
    exact = read.where(is_chart_request(F.col("__at"), F.col("params"), *map(F.col, keys))).drop("__at")
    wanted = scopes.withColumns({name: F.col(name[2:]) for name in keys})
    # not broadcast for the size of its compressed files
    rare = exact.join(F.broadcast(hot), keys, "left_anti").join(wanted.hint("merge"), keys)
    often = exact.join(F.broadcast(wanted.join(F.broadcast(hot), keys, "left_semi")), keys)
    return rare.unionByName(often).drop(*keys)


def _outside_or_repeated(days: Column) -> Column:
    outside = F.exists(days, lambda day: (day < F.col("start")) | (day >= F.col("end")))
    return outside | (F.size(F.array_distinct(days)) != F.size(days))


def _sessions(days: Column, cells: Mapping[str, Column]) -> Column:
    return F.arrays_zip(days.alias("date"), *[cells[name].alias(name) for name in fv.CHART_FIELDS])


def _read_by_schema(documents: DataFrame, body: str) -> DataFrame:
    """Add ``__sessions`` of the documents that fit the schema of a valid one and break no rule.

    ``__json`` stays for the others only, whose code is found part by part. A number is read as text where text is
    expected, but no number begins with a capital letter.
    """
    parsed = documents.select("*", once(F.try_parse_json(body)).alias("__json"))
    fitting = F.col("__json").isNotNull() & (F.octet_length(body) <= fv.CHART_MAX_BYTES) & F.col("symbol").rlike("^[A-Z]")
    read = parsed.select("*", once(F.when(fitting, F.from_json(body, CHART_SCHEMA, CHART_OPTIONS))).alias("__read"))
    result = F.get("__read.chart.result", F.lit(0))
    quote, adjusted = F.get(result["indicators"]["quote"], F.lit(0)), F.get(result["indicators"]["adjclose"], F.lit(0))
    cells = {name: (adjusted if name == "adjclose" else quote)[name] for name in fv.CHART_FIELDS}
    parts = read.select(
        "*", once(F.struct(result["timestamp"].alias("stamps"), *[value.alias(name) for name, value in cells.items()])).alias("__fit"),
    )
    stamps, days, count = F.col("__fit.stamps"), F.col("__days"), F.size("__fit.stamps")
    cells = {name: F.col(f"__fit.{name}") for name in fv.CHART_FIELDS}
    valid = (
        F.col(f"__read.{UNREAD}").isNull() & F.col("__read.chart.error").isNull() & (F.size("__read.chart.result") == 1)
        & (F.size(result["indicators"]["quote"]) == 1) & (F.size(result["indicators"]["adjclose"]) == 1)
        & (result["meta"]["symbol"] == F.col("symbol"))
    )
    for name, value in fv.CHART_META.items():
        valid = valid & (result["meta"][name] == value)
    for value in cells.values():
        valid = valid & (F.size(value) == count)
    numbers = F.concat(*cells.values())
    infinite = F.exists(numbers, lambda cell: F.isnan(cell) | (F.abs(cell) == float("inf")))
    valid = (
        valid & (count > 0) & ~F.exists(stamps, lambda stamp: stamp.isNull()) & (F.size(F.array_distinct(stamps)) == count)
        & ~F.coalesce(infinite, F.lit(False)) & ~_outside_or_repeated(days)
    )
    # lambdas stand in projections: inside a generated column one of them would have all of it interpreted
    judged = parts.withColumn("__days", F.transform("__fit.stamps", lambda stamp: local_day(stamp))).withColumn(
        "__valid", F.coalesce(valid, F.lit(False))
    )
    sessions = once(F.when(F.col("__valid"), _sessions(days, cells))).alias("__sessions")
    return judged.select(*documents.columns, F.when(~F.col("__valid"), F.col("__json")).alias("__json"), sessions)


def decode_charts(documents: DataFrame, *, body: str = "body") -> DataFrame:
    """Add ``chart_code`` (null when valid) and the decoded arrays to documents of one scope each.

    Documents carry ``symbol``, ``start`` and ``end``. The codes are fixed and tested in order;
    provider text is never part of one. Arrays are given for valid documents only.
    """
    parsed = _read_by_schema(documents, body)
    unfit = F.col("__sessions").isNull()
    # each part of a document is walked to once, and its values are read from there
    parts = {
        "chart": "$.chart", "meta": "$.chart.result[0].meta", "stamps": "$.chart.result[0].timestamp",
        "quotes": "$.chart.result[0].indicators.quote", "adjusted": "$.chart.result[0].indicators.adjclose",
    }
    walked = [F.try_variant_get("__json", path, "variant").alias(name) for name, path in parts.items()]
    parsed = parsed.select("*", once(F.when(unfit, F.struct(*walked))).alias("__part"))
    cells = {name: ("quotes", f"$[0].{name}") for name in fv.CHART_FIELDS} | {"adjclose": ("adjusted", "$[0].adjclose")}
    values = [F.try_variant_get(f"__part.{part}", path, "variant").alias(name) for name, (part, path) in cells.items()]
    parsed = parsed.select("*", once(F.when(unfit, F.struct(*values))).alias("__cell"))

    def at(part: str, path: str = "$", kind: str = "variant") -> Column:
        return F.try_variant_get(f"__part.{part}", path, kind)

    def size(value: Column) -> Column:
        return F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")), F.lit(-1))

    def type_of(value: Column) -> Column:
        return F.coalesce(F.schema_of_variant(value), F.lit(""))

    cell = {name: F.col(f"__cell.{name}") for name in fv.CHART_FIELDS}
    error = at("chart", "$.error")
    identity = at("meta", "$.symbol", "string") == F.col("symbol")
    for name, value in fv.CHART_META.items():
        identity = identity & (at("meta", f"$.{name}", "string") == value)
    stamps = at("stamps", kind="array<bigint>")
    facts = {
        "has_chart": type_of(F.col("__part.chart")).startswith("OBJECT") & (error.isNull() | F.is_variant_null(error)),
        "results": size(at("chart", "$.result")),
        "identified": F.coalesce(identity, F.lit(False)),
        "stamp_type": type_of(F.col("__part.stamps")),
        "stamps": stamps,
        "days": F.transform(stamps, lambda stamp: local_day(stamp)),
        "quotes": size(F.col("__part.quotes")),
        "adjusted": size(F.col("__part.adjusted")),
        **{name: F.try_variant_get(value, "$", "array<double>") for name, value in cell.items()},
        **{f"{name}_type": type_of(value) for name, value in cell.items()},
        **{f"{name}_size": size(value) for name, value in cell.items()},
    }
    found = F.struct(*[fact.alias(name) for name, fact in facts.items()])
    shaped = parsed.select("*", once(F.when(unfit, found)).alias("__doc"))
    doc = {name: F.col(f"__doc.{name}") for name in facts}

    code = (
        F.when(~unfit, F.lit(None).cast("string"))
        .when(F.octet_length(body) > fv.CHART_MAX_BYTES, F.lit("chart_body_too_large"))
        .when(F.col("__json").isNull() & F.col(body).rlike(NONSTANDARD_NUMBER), F.lit("nonstandard_json_number"))
        .when(F.col("__json").isNull(), F.lit("malformed_json"))
        .when(~doc["has_chart"], F.lit("chart_error_or_missing"))
        .when(doc["results"] != 1, F.lit("ambiguous_chart_results"))
        .when(~doc["identified"], F.lit("chart_identity_mismatch"))
        .when(
            (doc["stamp_type"] != "ARRAY<BIGINT>")
            | F.exists(doc["stamps"], lambda stamp: stamp.isNull())
            | (F.size(F.array_distinct(doc["stamps"])) != F.size(doc["stamps"])),
            F.lit("invalid_chart_timestamps"),
        )
        .when((doc["quotes"] != 1) | (doc["adjusted"] != 1), F.lit("ambiguous_chart_indicators"))
    )
    for name in fv.CHART_FIELDS:
        infinite = F.exists(doc[name], lambda cell: F.isnan(cell) | (F.abs(cell) == float("inf")))
        code = code.when(
            doc[f"{name}_size"] != F.size(doc["stamps"]), F.lit("chart_array_length_mismatch")
        ).when(
            ~doc[f"{name}_type"].rlike(NUMBER_ARRAY) | F.coalesce(infinite, F.lit(False)),
            F.lit("invalid_chart_cell_type"),
        )
    code = code.when(_outside_or_repeated(doc["days"]), F.lit("chart_date_scope_or_duplicate"))

    sessions = F.coalesce("__sessions", _sessions(doc["days"], doc))
    coded = shaped.select("*", once(F.struct(code.alias("code"))).alias("__verdict"))
    valid = F.col("__verdict.code").isNull()
    return coded.select(
        *[name for name in documents.columns if name != body],
        F.col("__verdict.code").alias("chart_code"),
        F.when(valid, F.col(body)).alias(body),
        F.when(valid, sessions).alias("sessions"),
    )


def chart_rows(decoded: DataFrame, *, outer: bool = False) -> DataFrame:
    """One row per session of every valid document, with the six fields as doubles.

    With ``outer`` a valid document without sessions gives one row without a date.
    """
    spread = F.explode_outer if outer else F.explode
    keep = [name for name in decoded.columns if name not in ("sessions", "body", "chart_code", "status_code")]
    return (
        decoded.where(F.col("chart_code").isNull())
        .select(*keep, spread("sessions").alias("__session"))
        .select(
            *keep,
            F.col("__session")["date"].alias("date"),
            *[F.col("__session")[name].alias(name) for name in fv.CHART_FIELDS],
        )
    )


def keep_valid_bodies(decoded: DataFrame) -> DataFrame:
    """Only successful, decodable bodies are kept; for the rest the fixed code stays, no text."""
    kept = (F.col("status_code") == 200) & F.col("chart_code").isNull()
    return decoded.withColumn("body", F.when(kept, F.col("body"))).withColumn(
        "chart_code", F.when(F.col("status_code") == 200, F.col("chart_code"))
    )
