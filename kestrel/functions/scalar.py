"""Column expressions (all JVM-side; none of them is a Python UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---- P13 / P14 -------------------------------------------------------------

def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-col_(c)))


def cosine_to_unit(c) -> Column:
    """(s + 1) / 2 clipped to [0, 1], rounded to 4 places."""
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (col_(c) + 1.0) / 2.0)), 4)


def clip(c, lo, hi) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), col_(c)))


# ---- P4 ---------------------------------------------------------------------

def epoch_to_ts(c) -> Column:
    """Unix seconds -> TIMESTAMP_NTZ in UTC."""
    return F.timestamp_seconds(col_(c)).cast("timestamp_ntz")


def ts_to_epoch_seconds(c) -> Column:
    """TIMESTAMP or TIMESTAMP_NTZ -> fractional unix seconds (UTC session)."""
    return F.unix_micros(col_(c).cast("timestamp")) / F.lit(1_000_000.0)


def ts_to_micros(c) -> Column:
    return F.unix_micros(col_(c).cast("timestamp"))


def ts_to_date(c) -> Column:
    return F.to_date(col_(c))


def days_between(later, earlier) -> Column:
    """(later - earlier) in fractional days."""
    return (ts_to_micros(later) - ts_to_micros(earlier)) / F.lit(86_400_000_000.0)


# ---- A1: md5 bucket ---------------------------------------------------------

def ab_bucket_expr(user_col, experiment_col) -> Column:
    """md5("{user}:{experiment}") -> first 8 hex digits -> int -> mod 10000 / 10000."""
    h = F.md5(F.concat(col_(user_col).cast("string"), F.lit(":"), col_(experiment_col)))
    as_int = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return F.pmod(as_int, F.lit(10000)) / F.lit(10000.0)


# ---- A6: standard normal tail -----------------------------------------------

SERIES_TERMS, FRACTION_TERMS = 60, 120


def two_sided_p(z) -> Column:
    """2 * (1 - Phi(|z|)) = erfc(x) with x = |z| / sqrt 2; relative error below 1e-12.

    Up to x = 2, 1 - erf(x) by the series with positive terms
    erf(x) = 2/sqrt(pi) exp(-x^2) sum 2^n x^(2n+1) / (2n+1)!!; beyond, the continued
    fraction erfc(x) = exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + (2/2)/(x + (3/2)/...))),
    both evaluated from the innermost term outwards.
    """
    x = F.abs(col_(z)).cast("double") / F.lit(math.sqrt(2.0))
    scale = F.exp(-x * x) / F.lit(math.sqrt(math.pi))
    down = lambda n: F.sequence(F.lit(n), F.lit(1), F.lit(-1))
    series = F.aggregate(down(SERIES_TERMS), F.lit(1.0), lambda acc, n: acc * 2.0 * x * x / (n * 2.0 + 1.0) + 1.0)
    fraction = F.aggregate(down(FRACTION_TERMS), x, lambda acc, n: x + n / F.lit(2.0) / acc)
    return F.when(x <= 2.0, F.lit(1.0) - scale * 2.0 * x * series).otherwise(scale / fraction)


# ---- P16 / P17 ----------------------------------------------------------------

def sanitize_metric_name(c) -> Column:
    """'@' -> '_at_'; anything outside [A-Za-z0-9_\\-./ ] -> '_'."""
    return F.regexp_replace(F.replace(col_(c), F.lit("@"), F.lit("_at_")), r"[^A-Za-z0-9_\-./ ]", "_")


def format_p_value(c) -> Column:
    p = col_(c)
    return (F.when(p.isNull() | F.isnan(p) | (F.abs(p) == F.lit(float("inf"))), F.lit("N/A"))
            .when(p == 0.0, F.lit("<1e-16"))
            .when(p < 1e-4, F.format_string("%.2e", p))
            .otherwise(F.format_string("%.4f", p)))


# ---- I6 / R3 / H1 -------------------------------------------------------------

def release_year_strict(title) -> Column:
    """Trailing '(dddd)' accepted in 1888..2030, else 0."""
    y = F.regexp_extract(F.trim(col_(title)), r"\((\d{4})\)\s*$", 1)
    yi = F.when(y == "", F.lit(None)).otherwise(y.cast("int"))
    return F.coalesce(F.when(yi.between(1888, 2030), yi), F.lit(0))


def first_year_anywhere(title) -> Column:
    """First '(dddd)' anywhere in the title, else 0."""
    y = F.regexp_extract(col_(title), r"\((\d{4})\)", 1)
    return F.when(y == "", F.lit(0)).otherwise(y.cast("int"))


def normalize_title(c) -> Column:
    """trim, lower, drop trailing '(yyyy)', non-alphanumerics -> space, squeeze, trim."""
    s = F.lower(F.trim(F.coalesce(col_(c), F.lit(""))))
    s = F.regexp_replace(s, r"\s*\(\d{4}\)$", "")
    s = F.regexp_replace(s, r"[^a-z0-9]+", " ")
    s = F.regexp_replace(s, r"\s+", " ")
    return F.trim(s)


# ---- E6 / P12 -------------------------------------------------------------------

def pad_left(seq, length: int = 50, pad: int = 0) -> Column:
    """Keep the last ``length`` elements, left-pad with ``pad`` to exactly ``length``."""
    s = col_(seq)
    n = F.size(s)
    keep = F.least(n, F.lit(length))
    tail = F.when(keep > 0, F.slice(s, -keep, keep)).otherwise(F.array().cast("array<bigint>"))
    return F.concat(F.array_repeat(F.lit(pad).cast("bigint"), F.greatest(F.lit(length) - keep, F.lit(0))),
                    tail.cast("array<bigint>"))


def clamp_ids(seq, n_items) -> Column:
    return F.transform(col_(seq), lambda x: F.greatest(F.least(x, F.lit(n_items - 1)), F.lit(0)))
