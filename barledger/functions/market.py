"""Symbol, zone and request expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barledger import fixed_values as fv


def issuer_symbol(provider_symbol: Column) -> Column:
    """``RELIANCE.NS`` becomes ``RELIANCE``."""
    return F.regexp_replace(provider_symbol, r"\.NS$", "")


def is_valid_symbol(provider_symbol: Column) -> Column:
    return F.coalesce(provider_symbol.rlike(fv.SYMBOL_PATTERN), F.lit(False))


SECONDS_PER_DAY = 86_400


def local_midnight_epoch(day: Column, zone: str = fv.EXCHANGE_ZONE) -> Column:
    """Epoch seconds of local midnight at the start of ``day``, whatever the session's zone."""
    wall_clock = F.timestamp_seconds(F.unix_date(day) * F.lit(SECONDS_PER_DAY).cast("bigint"))
    return F.unix_seconds(F.to_utc_timestamp(wall_clock, zone))


def day_of_instant(instant: Column, zone: str = fv.EXCHANGE_ZONE) -> Column:
    """Calendar day of an instant in the exchange's zone, whatever the session's zone."""
    shifted = F.unix_seconds(F.from_utc_timestamp(instant, zone))
    return F.date_from_unix_date(F.floor(shifted / SECONDS_PER_DAY).cast("int"))


def local_day(epoch_seconds: Column, zone: str = fv.EXCHANGE_ZONE) -> Column:
    return day_of_instant(F.timestamp_seconds(epoch_seconds), zone)


def day_bit(day: Column) -> tuple[Column, Column]:
    """A day as the number of its block of 64 days and its bit in there, so that sets of days are small numbers."""
    number = F.unix_date(day)
    return F.shiftright(number, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63))


def is_valid_window(start: Column, end: Column) -> Column:
    """A half-open request window of one to ten calendar days."""
    return F.datediff(end, start).between(1, fv.MAX_WINDOW_DAYS)


def address(url: Column) -> Column:
    """Scheme, host and path of an address. Each takes a pass over its text, so it is made a column before it is used."""
    parts = {"scheme": "PROTOCOL", "host": "HOST", "path": "PATH"}
    return F.struct(*[F.try_parse_url(url, F.lit(part)).alias(name) for name, part in parts.items()])


def is_chart_request(at: Column, params: Column, symbol: Column, period1: Column, period2: Column) -> Column:
    """True for exactly the chart request of this symbol and window; ``at`` is its address, ``params`` a string map."""
    matches = (
        (at["scheme"] == "https")
        & F.lower(at["host"]).isin(*fv.CHART_HOSTS)
        & (at["path"] == F.concat(F.lit(fv.CHART_PATH), symbol))
        & (F.try_element_at(params, F.lit("period1")) == period1.cast("string"))
        & (F.try_element_at(params, F.lit("period2")) == period2.cast("string"))
        & (F.try_element_at(params, F.lit("interval")) == fv.CHART_INTERVAL)
    )
    return F.coalesce(matches, F.lit(False))


def fetch_outcome(status: Column, error_kind: Column, attempt: Column) -> Column:
    """Class of one fetch attempt: only transient faults are worth another attempt.

    ``error_kind`` is null when the transport worked, ``tls`` for a certificate fault, other
    text for any other transport fault.
    """
    fault = error_kind.isNotNull() | (status >= 400) | status.isNull()
    return (
        F.when(error_kind == "tls", F.lit("tls_error"))
        .when(status.isin(*fv.DENIED_STATUSES), F.lit("denied"))
        .when(status.between(400, 499), F.lit("client_error"))
        .when(fault & (attempt >= fv.MAX_ATTEMPTS), F.lit("exhausted"))
        .when(fault, F.lit("retry"))
        .otherwise(F.lit("received"))
    )
