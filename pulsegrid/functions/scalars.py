"""Column-level building blocks. All are built-in Spark expressions, so every
operator that uses them stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: ColumnOrName) -> Column:
    """Text or number -> double; unparseable text and NaN -> null (P06), like
    a coercing numeric parse. ``try_cast`` keeps ANSI mode from failing the
    job on bad text."""
    d = _c(c).try_cast("double")
    return F.when(~F.isnan(d), d)


def np_round(c: ColumnOrName, places: int = 0) -> Column:
    """Round like pandas/numpy `round`: scale in double arithmetic, round half
    to even (`rint`), scale back. Spark's `bround` rounds the shortest decimal
    text instead and disagrees on values such as 135.705."""
    k = float(10 ** places)
    return F.rint(_c(c) * k) / k if places else F.rint(_c(c))


def py_round(c: ColumnOrName, places: int = 2) -> Column:
    """Round like Python's `round(x, places)`: the exact binary value of x
    is rounded, half to even only on exact ties (2.675 -> 2.67, 25.125 ->
    25.12). p = x*10^n is a rounded product; its exact error comes from
    Dekker's two-product with a Veltkamp split (plain double arithmetic,
    exact on the JVM). Only when p lands on .5 does the error's sign decide
    the direction. For |x| below about 1e292 (the split's range)."""
    x = _c(c)
    k = float(10 ** places)
    p = x * k
    big = x * F.lit(134217729.0)  # 2^27 + 1
    hi = big - (big - x)
    lo = x - hi
    err = (hi * k - p) + lo * k  # p + err == x * 10^n exactly
    fl = F.floor(p)
    at_half = (p - fl) == F.lit(0.5)
    r = (F.when(at_half & (err > 0), fl + 1)
         .when(at_half & (err < 0), fl)
         .otherwise(F.rint(p)))
    return r / k  # NaN and infinities pass through unchanged


def valid_reading(c: ColumnOrName) -> Column:
    """A reading the rule engine acts on: present, a number, and not 0.

    A 0 from a device means 'no reading' (the consumer engine skips falsy
    values), and Spark orders NaN above every number, so NaN is excluded too.
    """
    c = _c(c)
    return c.isNotNull() & ~F.isnan(c) & (c != 0)


def event_time(epoch_seconds: ColumnOrName) -> Column:
    """Epoch seconds (double, sub-second kept) -> TIMESTAMP; bad input -> null."""
    # to the nearest micro-second (a double's product is not exact); text, NaN
    # and out-of-range values become null
    s = _c(epoch_seconds).try_cast("double")
    return F.timestamp_micros(F.rint(s * 1_000_000).try_cast("long"))


def utc_wall(ts: ColumnOrName) -> Column:
    """Instant -> TIMESTAMP_NTZ holding the UTC wall clock, whatever the
    session time zone is. Results compare equal to engines without zones."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(ts).cast("timestamp_ntz"))


def svm(x: ColumnOrName = "x", y: ColumnOrName = "y", z: ColumnOrName = "z") -> Column:
    """Signal vector magnitude sqrt(x^2 + y^2 + z^2)."""
    x, y, z = _c(x), _c(y), _c(z)
    return F.sqrt(x * x + y * y + z * z)


def is_fall(svm_col: ColumnOrName, threshold: float) -> Column:
    """1 when the magnitude is above the threshold, else 0; null -> 0."""
    s = _c(svm_col)
    return F.when(s.isNotNull() & ~F.isnan(s) & (s > F.lit(threshold)), 1).otherwise(0)


# --- early-warning scores ----------------------------------------------------
# fixed values: score bands of the heart-rate and SpO2 components
def mews_hr(avg_hr: ColumnOrName) -> Column:
    """Heart-rate component: >130:3, >=111:2, >=101:1, >=51:0, >=41:1, else 2."""
    h = _c(avg_hr)
    return (F.when(h.isNull(), F.lit(None).cast("int"))
            .when(h > 130, 3).when(h >= 111, 2).when(h >= 101, 1)
            .when(h >= 51, 0).when(h >= 41, 1).otherwise(2))


def mews_spo2(avg_spo2: ColumnOrName) -> Column:
    """SpO2 component: <90:3, <93:2, <95:1, else 0."""
    s = _c(avg_spo2)
    return (F.when(s.isNull(), F.lit(None).cast("int"))
            .when(s < 90, 3).when(s < 93, 2).when(s < 95, 1).otherwise(0))


def mews_simple(avg_hr: ColumnOrName, avg_spo2: ColumnOrName) -> Column:
    """First-match score of the Spark batch job (A02): hr>130:3, hr>=111:2,
    hr<=40:2, spo2<90:3, else 0."""
    h, s = _c(avg_hr), _c(avg_spo2)
    return (F.when(h > 130, 3).when(h >= 111, 2).when(h <= 40, 2)
            .when(s < 90, 3).otherwise(0))


def severity_label(level: ColumnOrName) -> Column:
    """MEWS level -> Low / Medium / High / Critical."""
    v = _c(level)
    return (F.when(v == 1, "Low").when(v == 2, "Medium").when(v == 3, "High")
            .otherwise("Critical"))


def mews_bucket(score: ColumnOrName) -> Column:
    """Colour bucket: the score clamped to 5."""
    return F.least(_c(score), F.lit(5))


def kpi_mews_class(max_mews: ColumnOrName) -> Column:
    m = _c(max_mews)
    return F.when(m >= 3, "alert").when(m >= 2, "warn").otherwise("good")


def kpi_falls_class(total_falls: ColumnOrName) -> Column:
    return F.when(_c(total_falls) > 0, "alert").otherwise("good")


def radar_norms(avg_hr: ColumnOrName, avg_spo2: ColumnOrName, max_mews: ColumnOrName,
                avg_act: ColumnOrName, falls: ColumnOrName) -> dict[str, Column]:
    """Radar axes scaled to 0..1 (F01). Activity and falls are capped at 1;
    missing movement counts as 0 (Spark ``least`` would skip a null)."""
    return {
        "hr_norm": (_c(avg_hr) - 30) / (220 - 30),
        "spo2_norm": (_c(avg_spo2) - 90) / (100 - 90),
        "mews_inv": 1 - _c(max_mews) / 6,
        "act_norm": F.least(F.coalesce(_c(avg_act), F.lit(0.0)) / 50, F.lit(1.0)),
        "fall_risk": F.least(F.coalesce(_c(falls), F.lit(0)) / 10, F.lit(1.0)),
    }


def fmt_minute(ts: ColumnOrName) -> Column:
    """`yyyy-MM-dd HH:mm`, em dash when missing."""
    return F.coalesce(F.date_format(_c(ts), "yyyy-MM-dd HH:mm"), F.lit("—"))


def fmt_clock(ts: ColumnOrName) -> Column:
    """`HH:mm`, em dash when missing."""
    return F.coalesce(F.date_format(_c(ts), "HH:mm"), F.lit("—"))


def time_parts(ts: ColumnOrName) -> dict[str, Column]:
    """Zero-padded year/month/day/hour/minute text used as landing partitions."""
    t = _c(ts)
    return {
        "year": F.date_format(t, "yyyy"),
        "month": F.date_format(t, "MM"),
        "day": F.date_format(t, "dd"),
        "hour": F.date_format(t, "HH"),
        "minute": F.date_format(t, "mm"),
    }


def percent(n: ColumnOrName, total: ColumnOrName) -> Column:
    """Raw percentage n/total*100 in double arithmetic, divided first as the
    profiling script does (29/50*100 is 57.99999999999999, not 58), so text
    bars built from it have the same length; null when total is 0."""
    t = _c(total)
    return F.when(t > 0, _c(n).cast("double") / t * 100.0)


def text_bar(pct: ColumnOrName, per_point: int = 2) -> Column:
    """A bar of int(per_point*pct) blocks."""
    return F.repeat(F.lit("█"), F.coalesce(F.floor(_c(pct) * per_point).cast("int"), F.lit(0)))


def strip_trailing_semicolons(c: ColumnOrName) -> Column:
    """`1.25;` -> `1.25`."""
    return F.regexp_replace(_c(c), ";+$", "")


def value_range_text(lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """`min - max` text."""
    return F.concat_ws(" - ", _c(lo).cast("string"), _c(hi).cast("string"))


def activity_name(code: ColumnOrName) -> Column:
    """Activity code -> name, unknown -> null (P25) as an inline literal map:
    an 18-entry constant folded into the plan, no join needed."""
    from pulsegrid.schemas import ACTIVITY_NAMES
    m = F.create_map(*[F.lit(x) for kv in ACTIVITY_NAMES.items() for x in kv])
    return F.try_element_at(m, _c(code))
