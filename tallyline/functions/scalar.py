"""Column-level helpers.

Everything here returns a built-in Catalyst expression, so it stays inside
whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- I1 dates -------------------------------------------------------------

def days_between(later, earlier) -> Column:
    """DATEDIFF(later, earlier) in whole days (dates of the timestamps)."""
    return F.datediff(_c(later), _c(earlier))


def iso_date_prefix(s) -> Column:
    """First 10 characters of ISO-8601 text, as a DATE."""
    return F.to_date(F.substring(_c(s), 1, 10))


def date_window(d, as_of, before: int = 7, after: int | None = 7) -> Column:
    """C11 predicate: d within [as_of - before, as_of + after] (after=None:
    open to the future is NOT implied; use after=0 for [as_of-before, as_of])."""
    d = _c(d).cast("date")
    a = F.lit(as_of).cast("date") if not isinstance(as_of, Column) else as_of.cast("date")
    lo = F.date_sub(a, before)
    if after is None:
        return d >= lo
    return d.between(lo, F.date_add(a, after))


# ---- I2-I5 time zones / parsing ---------------------------------------------

def utc_to_zone(ts, tz: str) -> Column:
    """UTC instant (timestamp or ISO text) -> local wall-clock time in tz,
    as TIMESTAMP_NTZ (a local time carries no zone)."""
    t = _c(ts)
    return F.from_utc_timestamp(F.to_timestamp(t), tz).cast("timestamp_ntz")


def utc_to_zone_date(ts, tz: str) -> Column:
    return utc_to_zone(ts, tz).cast("date")


def kickoff_local(day, hhmm, src: str = "America/New_York", dst: str = "America/Chicago",
                  default_time: str = "12:00") -> Column:
    """Local date + 'HH:mm' text in `src` -> wall-clock time in `dst`."""
    text = F.concat_ws(" ", _c(day).cast("string"), F.coalesce(_c(hhmm), F.lit(default_time)))
    local = F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm"))
    return F.convert_timezone(F.lit(src), F.lit(dst), local)


def local_hhmm(iso, tz: str = "America/New_York") -> Column:
    """I4: first 19 chars of ISO text (UTC) -> 'HH:mm' in tz."""
    t = F.to_timestamp(F.substring(_c(iso), 1, 19))
    return F.date_format(F.from_utc_timestamp(t, tz), "HH:mm")


def parse_iso(s) -> Column:
    """ISO-8601 text (with 'Z' or offset) -> TIMESTAMP; '' / bad -> NULL."""
    return F.try_to_timestamp(F.nullif(F.trim(_c(s)), F.lit("")))


# ---- I6/I7 math & conditionals ---------------------------------------------

def safe_div(a, b) -> Column:
    """NULLIF-guarded division."""
    return _c(a) / F.nullif(_c(b), F.lit(0))


def close_to(a, b, tol: float = 0.01) -> Column:
    return F.abs(_c(a) - _c(b)) < F.lit(tol)


def safe_double(x) -> Column:
    """C5 `proj_safe_cast`: NULL, '' and unparsable -> NULL (never raises)."""
    return F.nullif(F.trim(_c(x).cast("string")), F.lit("")).try_cast("double") \
        if not isinstance(x, (int, float)) else F.lit(float(x))


def empty_to_null(df: DataFrame) -> DataFrame:
    """C6: '' -> NULL for every string column (one projection)."""
    return df.select(*[
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f.name) for f in df.schema.fields])


# ---- I8 strings -------------------------------------------------------------

def url_for(template: str, *cols) -> Column:
    """URL templating by round/week etc. (`format_string`)."""
    return F.format_string(template, *[_c(c) for c in cols])


# ---- I11 JSON ---------------------------------------------------------------

def pythonish_to_json(s) -> Column:
    """Python-literal list text -> JSON text: the bare tokens None/True/False
    become null/true/false; quoted strings are left as they are (single quotes
    are accepted by from_json already, allowSingleQuotes)."""
    quoted = r'"(?:[^"\\]|\\.)*"|\'(?:[^\'\\]|\\.)*\''
    pieces = F.regexp_extract_all(_c(s), F.lit(f"(?s)(?:{quoted}|[^\"']+|.)"), F.lit(0))

    def bare(x: Column) -> Column:
        for token, json in (("None", "null"), ("True", "true"), ("False", "false")):
            x = F.regexp_replace(x, rf"\b{token}\b", json)
        return x

    return F.array_join(F.transform(pieces, lambda x: F.when(x.rlike("^[\"']"), x).otherwise(bare(x))), "")


def parse_list(s, schema: T.DataType) -> Column:
    """Text (JSON or Python literal) -> typed array."""
    return F.from_json(pythonish_to_json(s), schema, {"allowSingleQuotes": "true"})


# ---- I12 arrays -------------------------------------------------------------

def non_null(arr) -> Column:
    return F.filter(_c(arr), lambda x: x.isNotNull())


def array_mean(arr) -> Column:
    a = non_null(arr)
    total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(a) > 0, total / F.size(a))


# ---- I13 logit --------------------------------------------------------------

def logit(p) -> Column:
    p = _c(p)
    return F.ln(p / (F.lit(1.0) - p))


def expit(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))
