"""Scalar column expressions used across the operators.

All of them are built from ``pyspark.sql.functions`` so they stay inside
whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "dbl", "parse_event_time", "flight_id_expr", "delay_category",
    "flight_status", "severity_band", "board_time", "flight_number",
    "route_label", "coerce_int", "abs_error", "squared_error",
    "relative_error", "anomaly_score", "day_name", "safe_div", "pct",
    "DELAY_CATEGORY_LABELS", "DAY_NAMES", "STATUS_LABELS",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(x) -> Column:
    return F.lit(float(x))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(col_of(num).cast("double"), col_of(den).cast("double"))


def pct(part, whole) -> Column:
    return safe_div(col_of(part) * dbl(100), whole)


# --- ingestion -------------------------------------------------------------

def parse_event_time(raw, fallback: Column | None = None) -> Column:
    """ISO-8601 text -> TIMESTAMP, cut to milliseconds.

    A date and a time to the second are required; the fraction may have any
    number of digits or be missing, and a ``Z`` or an offset is honoured.
    A missing value becomes ``fallback`` (default: the processing time); a
    malformed one stays NULL and can be quarantined.
    """
    s = col_of(raw)
    whole = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}")
    parsed = F.when(whole, F.date_trunc("millisecond", s.try_cast("timestamp")))
    fb = fallback if fallback is not None else F.current_timestamp()
    return F.when(s.isNull(), fb).otherwise(parsed)


def flight_id_expr(ts, airline, origin, dest) -> Column:
    """Digits of the timestamp's text + ``_airline_origin_dest`` (a fixed
    layout: ids are compared with those of the original).

    NULL when any part is NULL (``concat`` semantics), like the reference.
    """
    digits = F.regexp_replace(col_of(ts).cast("string"), "[^0-9]", "")
    return F.concat(digits, F.lit("_"), col_of(airline), F.lit("_"),
                    col_of(origin), F.lit("_"), col_of(dest))


# --- presentation-independent labels -------------------------------------

# Delay category labels of the right-closed bins
# (-inf,0] (0,15] (15,30] (30,60] (60,inf), in bin order.
DELAY_CATEGORY_LABELS = [
    "Early/On-time",
    "Minor (1-15min)",
    "Moderate (16-30min)",
    "Significant (31-60min)",
    "Severe (60+min)",
]

# Day names, Monday first.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
             "Saturday", "Sunday"]

# Board status labels (left-closed bins <0, [0,15), [15,60), >=60).
STATUS_LABELS = ["EARLY", "ON TIME", "DELAYED", "SEVERE", "PENDING"]


def delay_category(delay) -> Column:
    """Right-closed 5-bin category; NULL delay -> NULL category."""
    d = col_of(delay)
    L = DELAY_CATEGORY_LABELS
    return (F.when(d <= 0, L[0]).when(d <= 15, L[1]).when(d <= 30, L[2])
            .when(d <= 60, L[3]).when(d > 60, L[4]))


def flight_status(delay) -> Column:
    """Left-closed status; missing delay -> PENDING."""
    d = col_of(delay)
    S = STATUS_LABELS
    return (F.when(d.isNull() | F.isnan(d), S[4]).when(d < 0, S[0])
            .when(d < 15, S[1]).when(d < 60, S[2]).otherwise(S[3]))


def severity_band(delay) -> Column:
    """Severity of a delay: >60 severe, >15 delayed, <0 early, else on time."""
    d = col_of(delay)
    return (F.when(d.isNull(), "missing").when(d > 60, "severe")
            .when(d > 15, "delayed").when(d < 0, "early").otherwise("on_time"))


def board_time(ts) -> Column:
    return F.date_format(col_of(ts), "HH:mm")


def flight_number(airline, flight_id) -> Column:
    """Airline + space + last four characters of the id."""
    fid = col_of(flight_id).cast("string")
    return F.concat(col_of(airline), F.lit(" "),
                    F.substring(fid, -4, 4))


def route_label(origin, dest) -> Column:
    return F.concat(col_of(origin), F.lit(" → "), col_of(dest))


def day_name(ts) -> Column:
    return F.date_format(col_of(ts), "EEEE")


def coerce_int(x) -> Column:
    """Text or number -> INT, anything unparseable -> 0 ('12.7' -> 12)."""
    return F.coalesce(col_of(x).cast("string").try_cast("double").try_cast("int"), F.lit(0))


# --- prediction errors ----------------------------------------------------

def abs_error(pred="predicted_delay", actual="dep_delay") -> Column:
    return F.abs(col_of(pred) - col_of(actual))


def squared_error(pred="predicted_delay", actual="dep_delay") -> Column:
    return F.pow(col_of(pred) - col_of(actual), 2)


def relative_error(pred="predicted_delay", actual="dep_delay") -> Column:
    return abs_error(pred, actual) / (F.abs(col_of(actual)) + dbl(1))


def anomaly_score(pred="predicted_delay", actual="dep_delay") -> Column:
    return abs_error(pred, actual) / (F.abs(col_of(pred)) + dbl(1))
