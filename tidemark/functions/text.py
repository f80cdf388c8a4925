"""Scalar text / time columns (C4-C6, C10, C12-C14, C17-C20), JVM-side built-ins."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructType

# Fixed values that must equal the reference's behaviour:
# text written in place of an unknown API's symbol in a landing file name
UNKNOWN_SYMBOL = "None"
# date pattern of landing file names
LANDING_DATE_FORMAT = "MM-dd-yyyy"
# extension of landing files
LANDING_EXTENSION = ".json"
# APIs whose landing file is named after the symbol
KNOWN_APIS = ("stock/insider-transactions", "stock/financials-reported", "stock/insider-sentiment")
# medallion layers; the default is the first one
LAYERS = ("bronze", "silver", "platinum", "gold")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- schema text (C4-C6) -------------------------------------------------

def schema_text(schema: StructType) -> str:
    """Schema as text, the form stored in the registry (driver-side metadata)."""
    return str(schema)


def prepare_schema_text(text) -> Column:
    """Single quotes -> double quotes (the storable form of a schema text)."""
    return F.replace(_c(text), F.lit("'"), F.lit('"'))


def restore_schema_text(text) -> Column:
    """Double quotes -> single quotes; exact inverse only if the original had no ``"``."""
    return F.replace(_c(text), F.lit('"'), F.lit("'"))


def prepare_schema_str(schema) -> str:
    """Driver-side twin of :func:`prepare_schema_text` for one schema object."""
    return str(schema).replace("'", '"')


# --- layers (F9) -----------------------------------------------------------

def check_layer(layer: str) -> str:
    value = layer.lower() if isinstance(layer, str) else layer
    if value not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
    return value


def is_valid_layer(layer) -> Column:
    return _c(layer).isin(*LAYERS)


# --- landing names (C12-C14) ---------------------------------------------

def landing_symbol(api, symbol, known_apis=KNOWN_APIS) -> Column:
    """Symbol for a known API, NULL otherwise (dictionary lookup with default None)."""
    return F.when(_c(api).isin(*known_apis), _c(symbol))


def landing_file_name(api, symbol, ts, known_apis=KNOWN_APIS) -> Column:
    """``<symbol>-MM-dd-yyyy.json``; an unknown API gives ``None-...``."""
    return F.concat(
        F.coalesce(landing_symbol(api, symbol, known_apis), F.lit(UNKNOWN_SYMBOL)),
        F.lit("-"),
        F.date_format(_c(ts), LANDING_DATE_FORMAT),
        F.lit(LANDING_EXTENSION),
    )


# --- request statistics (C18-C20) ------------------------------------------

def request_url(base_url, api, url_args) -> Column:
    """``f'{base_url}{api}?{url_args}'``; ``base_url`` is a literal when a ``str``,
    ``api`` and ``url_args`` are column names or Columns."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    return F.concat(base, _c(api), F.lit("?"), _c(url_args))


def payload_size(payload) -> Column:
    """Bytes of the UTF-8 payload text."""
    return F.octet_length(_c(payload))


def add_seconds(ts, seconds) -> Column:
    """``ts`` plus a (fractional) number of seconds, at microsecond precision."""
    micros = F.round(_c(seconds) * F.lit(1_000_000)).cast("long")
    return F.timestamp_add("MICROSECOND", micros, _c(ts))


def elapsed_seconds(start, end) -> Column:
    """``end - start`` in seconds (double), exact to the microsecond; works on NTZ."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(1_000_000.0)


def epoch_to_utc(epoch_seconds) -> Column:
    return F.timestamp_micros(F.round(_c(epoch_seconds) * F.lit(1_000_000)).cast("long"))


# --- clock (C10) -----------------------------------------------------------

def clock(as_of: _dt.datetime | None = None) -> Column:
    """Now as UTC wall-clock time (``TIMESTAMP_NTZ``), or a fixed UTC time when
    one is injected (tests, reruns). Zone-free, so a stamp reads back the same
    whatever the session or client time zone."""
    if as_of is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
