"""Lenient text parsers and small normalisers, all as native Column expressions.

Every function maps Column -> Column and stays inside whole-stage codegen:
regex gates decide validity first, then ``try_*`` functions convert, so ANSI
mode never raises on dirty input and no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system's rules)
# ---------------------------------------------------------------------------
# Characters removed by "trim space" (Unicode White_Space), in code-point order:
# TAB, LF, VT, FF, CR, SPACE, NEL U+0085, NBSP U+00A0, U+1680, U+2000..U+200A,
# LINE SEPARATOR U+2028, PARAGRAPH SEPARATOR U+2029, U+202F, U+205F, U+3000.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Text accepted as boolean true (compared after lower-casing and trimming).
TRUE_WORDS = ["1", "true", "t", "yes", "y"]
# Branch id used for entity-wide high-water marks.
GLOBAL_BRANCH = "ALL"

INT64_MAX = 9223372036854775807
INT64_MIN = -9223372036854775808

_DECIMAL_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_HEXFLOAT_RE = r"^[+-]?0[xX]([0-9a-fA-F]+[.]?[0-9a-fA-F]*|[.][0-9a-fA-F]+)[pP][+-]?[0-9]+$"
_INF_RE = r"^[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])$"
_NAN_RE = r"^[nN][aA][nN]$"
_INT_RE = r"^[+-]?[0-9]+$"
_DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_CLOCK_RE = r"^([0-9]{1,2}):([0-9]{2})(:([0-9]{2})([.,]([0-9]+))?)?$"
# date, separator, hour (1-2 digits), minute, second, optional fraction, optional zone
_TS_RE = (r"^([0-9]{4}-[0-9]{2}-[0-9]{2})([T ])([0-9]{1,2}):([0-9]{2}):([0-9]{2})"
          r"([.,]([0-9]+))?(Z|[+-][0-9]{2}:[0-9]{2})?$")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_space(c) -> Column:
    """Strip leading/trailing Unicode white space (SQL ``trim`` strips only ' ')."""
    return F.btrim(_c(c), F.lit(UNICODE_SPACE))


def text(c) -> Column:
    """CSV text cell: missing/blank stays ``''``, never NULL."""
    return F.coalesce(_c(c), F.lit(""))


def _float_or_null(t: Column) -> Column:
    ok = t.rlike("|".join((_DECIMAL_RE, _HEXFLOAT_RE, _INF_RE, _NAN_RE)))
    return F.when(ok, t.try_cast("double"))


def lenient_double(c, default: float | None = 0.0) -> Column:
    """Float parse.

    ``default`` is returned for blank or malformed text. With ``default=0``
    an overflowing literal keeps its +-Infinity (the error is discarded);
    with ``default=None`` (nullable columns) an overflow is NULL.
    """
    t = trim_space(c)
    v = _float_or_null(t)
    if default is None:
        overflow = F.isnull(v) | (F.abs(v) == F.lit(float("inf"))) & ~t.rlike(_INF_RE)
        return F.when(~overflow, v)
    return F.coalesce(v, F.lit(float(default)))


def lenient_long(c, default: int | None = 0, on_overflow: str = "clamp") -> Column:
    """Base-10 integer parse.

    ``on_overflow``: ``'clamp'`` (int64 min/max by sign), ``'default'``.
    Blank or malformed text (``'1.5'``, ``'abc'``) gives ``default``.
    """
    t = trim_space(c)
    valid = t.rlike(_INT_RE)
    v = t.try_cast("long")
    if on_overflow == "clamp":
        clamped = F.when(t.startswith("-"), F.lit(INT64_MIN)).otherwise(F.lit(INT64_MAX))
        parsed = F.when(valid, F.coalesce(v, clamped))
    else:
        parsed = F.when(valid, v)
    if default is None:
        return parsed
    return F.coalesce(parsed, F.lit(int(default)).cast("long"))


def lenient_bool(c) -> Column:
    """True iff the trimmed, lower-cased text is one of TRUE_WORDS."""
    return F.coalesce(F.lower(trim_space(c)).isin(TRUE_WORDS), F.lit(False))


def lenient_date(c, trim: bool = True) -> Column:
    """``yyyy-MM-dd`` only (strict widths, valid calendar day), else NULL.
    ``trim=False`` for JSON payload values, which are not trimmed."""
    t = trim_space(c) if trim else _c(c)
    return F.when(t.rlike(_DATE_RE), F.try_to_date(t, "yyyy-MM-dd"))


def _ts_parts(t: Column):
    g = lambda i: F.regexp_extract(t, _TS_RE, i)
    return g(1), g(2), g(3), g(4), g(5), g(7), g(8)


def lenient_ts(c, forms: str = "all") -> Column:
    """Timestamp parse -> TIMESTAMP (instant).

    Accepted: ``yyyy-MM-ddTHH:mm:ss[.f][Z|+hh:mm]`` and
    ``yyyy-MM-dd HH:mm:ss[.f]`` (no zone); zone-less values are UTC.
    ``forms='t_only'`` accepts only the ``T`` separated forms, ``'rfc3339'``
    only ``T`` forms with a zone (JSON instants).
    The hour may have one digit; fractions of any length are truncated to
    microseconds. Invalid calendar/clock values give NULL.
    """
    t = trim_space(c)
    date, sep, hh, mi, ss, frac, zone = _ts_parts(t)
    ok = t.rlike(_TS_RE) & ((sep == "T") | (zone == ""))
    if forms == "t_only":
        ok = ok & (sep == "T")
    elif forms == "rfc3339":
        ok = ok & (sep == "T") & (zone != "")
    zone_txt = F.when(zone.isin("", "Z"), F.lit("+00:00")).otherwise(zone)
    canon = F.concat(date, F.lit(" "), F.lpad(hh, 2, "0"), F.lit(":"), mi, F.lit(":"), ss,
                     F.lit("."), F.rpad(F.substring(frac, 1, 6), 6, "0"), zone_txt)
    return F.when(ok, F.try_to_timestamp(canon, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSXXX")))


def lenient_clock(c) -> Column:
    """Time of day ``H:mm[:ss[.f]]`` -> canonical text ``HH:mm:ss.SSS`` or NULL."""
    t = trim_space(c)
    g = lambda i: F.regexp_extract(t, _CLOCK_RE, i)
    hh, mi, ss, frac = g(1), g(2), g(4), g(6)
    ss = F.when(ss == "", F.lit("00")).otherwise(ss)
    ok = (t.rlike(_CLOCK_RE) & (hh.cast("int") < 24) & (mi.cast("int") < 60)
          & (ss.cast("int") < 60))
    return F.when(ok, F.concat(F.lpad(hh, 2, "0"), F.lit(":"), mi, F.lit(":"), ss, F.lit("."),
                               F.rpad(F.substring(frac, 1, 3), 3, "0")))


def lenient_date3(c, second_form: str = "T", trim: bool = True) -> Column:
    """Day of a ``yyyy-MM-dd`` / RFC3339 / ``yyyy-MM-ddTHH:mm:ss`` value.

    The calendar day is taken in the value's own offset (no zone shift).
    ``second_form=' '`` accepts ``yyyy-MM-dd HH:mm:ss`` instead of the
    zone-less ``T`` form (staff feed). NULL when nothing matches.
    """
    t = trim_space(c) if trim else _c(c)
    date, sep, hh, mi, ss, frac, zone = _ts_parts(t)
    valid_ts = t.rlike(_TS_RE) & F.isnotnull(lenient_ts(t))
    if second_form == "T":
        ok_ts = valid_ts & (sep == "T")
    else:
        ok_ts = valid_ts & (((sep == "T") & (zone != "")) | ((sep == " ") & (zone == "")))
    return F.coalesce(lenient_date(t, trim), F.when(ok_ts, F.try_to_date(date, "yyyy-MM-dd")))


def clean_text(c, mode: str = "runs") -> Column:
    """Invalid UTF-8: the reader decodes bad bytes to U+FFFD.

    ``mode='runs'`` turns each run of replacement characters into one ``?``;
    ``mode='replace'`` keeps U+FFFD per bad byte sequence.
    """
    c = text(c)
    if mode == "runs":
        return F.when(F.contains(c, F.lit("\ufffd")), F.regexp_replace(c, "\\x{FFFD}+", "?")).otherwise(c)
    return c


def day(c) -> Column:
    """Timestamp -> its calendar day (session zone for instants); the zero time has none."""
    d = F.to_date(_c(c))
    return F.when(d != F.lit("0001-01-01").cast("date"), d)


def global_branch(c) -> Column:
    """Empty or NULL branch -> ``'ALL'``; other ids stay as they are, blanks included."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(GLOBAL_BRANCH))


def blank_to_null(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def zero_to_null(c) -> Column:
    c = _c(c)
    return F.when(c != 0, c)


def date_text(c) -> Column:
    """Date -> ``yyyy-MM-dd`` text, NULL -> ``''``."""
    return F.coalesce(F.date_format(_c(c), "yyyy-MM-dd"), F.lit(""))


def iso_millis_utc(c) -> Column:
    """Timestamp -> ``yyyy-MM-ddTHH:mm:ss.SSSZ`` (UTC wall clock)."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
