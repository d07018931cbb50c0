"""Date and time expressions (T1-T10).  Times stay text (``HH:mm``) as in the
source data; dates are ``date``.  Every function is a pure column expression,
so it also runs on a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harmonia.functions.exprs import C

# Fixed value: 24-hour ``H:MM`` / ``HH:MM`` clock text accepted as a valid time.
VALID_TIME = r"^([01]?[0-9]|2[0-3]):[0-5][0-9]$"
# Fixed value: spreadsheet day-serial origin (the alternative 1900-01-01 is a parameter).
EXCEL_ORIGIN = "1899-12-30"


def excel_serial_to_date(x, origin: str = EXCEL_ORIGIN) -> Column:
    """Spreadsheet serial day number -> date."""
    n = F.floor(C(x).cast("double")).cast("int")
    return F.date_add(F.lit(origin).cast("date"), n)


def day_fraction_to_hhmm(x) -> Column:
    """Fraction of a day (0..1) -> ``HH:mm`` (seconds truncated)."""
    secs = F.floor(F.round(C(x).cast("double") * 86400.0, 6)).cast("long")
    h = F.pmod(F.floor(secs / 3600), F.lit(24))
    m = F.floor(F.pmod(secs, F.lit(3600)) / 60)
    return F.format_string("%02d:%02d", h.cast("int"), m.cast("int"))


def parse_date_multi(x, formats=("M/d/yyyy", "d/M/yyyy", "yyyy-M-d")) -> Column:
    """First format that parses wins, per value."""
    return F.coalesce(*[F.try_to_date(C(x).cast("string"), f) for f in formats])


def clean_time_text(x) -> Column:
    """T4: drop a trailing ``:00`` (as the source does, literally: a clock
    already without seconds loses its ``:00`` minutes too); ``00:00`` means
    unknown -> NULL."""
    t = F.regexp_replace(C(x), r":00$", "")
    return F.when(t == "00:00", None).otherwise(t)


def time_from_stamp(x) -> Column:
    """T5: ``m/d/yyyy h:mm[...]`` text -> ``h:mm``; text that does not look
    like a stamp is returned unchanged (a pattern replace, as in the source)."""
    return F.regexp_replace(C(x), r"^\d{1,2}/\d{1,2}/\d{4}\s+(\d{1,2}:\d{2}).*$", "$1")


def flag_to_bool(x, yes: str = "y", no: str = "n") -> Column:
    """T5: replicate flag ``y`` / ``n`` -> TRUE / FALSE, anything else NULL."""
    return F.when(C(x) == yes, F.lit(True)).when(C(x) == no, F.lit(False))


def date_from_stamp(x) -> Column:
    """T5: ``m/d/yyyy h:mm`` text -> date."""
    return F.try_to_date(F.regexp_extract(C(x), r"^(\d{1,2}/\d{1,2}/\d{4})", 1), "M/d/yyyy")


def dst_start(year) -> Column:
    """US DST start: second Sunday of March."""
    return F.next_day(F.make_date(C(year), F.lit(3), F.lit(7)), "SU")


def dst_end(year) -> Column:
    """US DST end: first Sunday of November."""
    return F.next_day(F.make_date(C(year), F.lit(10), F.lit(31)), "SU")


def in_us_dst(d) -> Column:
    d = C(d)
    y = F.year(d)
    return (d >= dst_start(y)) & (d < dst_end(y))


def time_hour(t) -> Column:
    return F.split(C(t), ":").getItem(0).try_cast("int")


def time_minutes_text(t) -> Column:
    """Text after the last colon (R ``sub('.*:', '', t)``)."""
    return F.regexp_replace(C(t), r"^.*:", "")


def shift_clock(date_col, time_col, from_tz: str) -> Column:
    """Bring clock text to Pacific daylight time.  PDT +0 h, PST +1 h,
    mixed: +0 inside the US DST window else +1.  Hours wrap mod 24 (the date
    is not rolled); invalid or NULL times are returned unchanged."""
    t = C(time_col)
    if from_tz == "PDT":
        off = F.lit(0)
    elif from_tz == "PST":
        off = F.lit(1)
    else:
        off = F.when(in_us_dst(C(date_col).cast("date")), 0).otherwise(1)
    valid = t.isNotNull() & t.rlike(VALID_TIME)
    new_h = F.pmod(time_hour(t) + off, F.lit(24))
    return F.when(valid, F.format_string("%02d:%s", new_h, time_minutes_text(t))).otherwise(t)


def local_to_fixed_offset(date_col, time_col, from_zone: str = "America/Los_Angeles",
                          to_zone: str = "Etc/GMT+8", out_format: str = "HH:mm:ss"):
    """A local wall-clock (date + ``H:mm[:ss]``) in ``from_zone``
    shown in the fixed zone ``to_zone`` (UTC-8 by default).  A NULL time is
    taken as midnight for the shift and NULL again afterwards; a time that
    does not parse gives NULL date and time.  Returns (date, time).

    Wall clocks are ``TIMESTAMP_NTZ`` and zones are converted with
    ``convert_timezone``, so the result does not depend on the session
    time zone."""
    t = C(time_col)
    missing = t.isNull() | (t == "")
    clock = F.when(missing, F.lit("00:00:00")).otherwise(t)
    clock = F.when(clock.rlike(r"^([01]?\d|2[0-3]):[0-5]\d$"), F.concat(clock, F.lit(":00"))).otherwise(clock)
    text = F.concat_ws(" ", C(date_col).cast("date").cast("string"), clock)
    ok = clock.rlike(r"^([01]?\d|2[0-3]):[0-5]\d:[0-5]\d$") & C(date_col).isNotNull()
    ts = F.when(ok, F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd H:mm:ss")))
    utc = F.lit("UTC")
    if from_zone.upper() == "UTC":
        u = ts
    else:
        # A repeated (fall-back) wall time takes the later, standard-time
        # offset, as lubridate does by default; Java would take the earlier.
        u = F.convert_timezone(F.lit(from_zone), utc, ts)
        u2 = u + F.expr("INTERVAL 1 HOUR")
        u = F.when(F.convert_timezone(utc, F.lit(from_zone), u2) == ts, u2).otherwise(u)
    shifted = F.convert_timezone(utc, F.lit(to_zone), u)
    new_date = F.to_date(shifted)
    # formatted from the wall-clock fields: date_format would pass through the
    # session zone, where this wall time may not exist
    if out_format == "HH:mm":
        txt = F.format_string("%02d:%02d", F.hour(shifted), F.minute(shifted))
    else:
        txt = F.format_string("%02d:%02d:%02d", F.hour(shifted), F.minute(shifted), F.second(shifted))
    new_time = F.when(missing | shifted.isNull(), None).otherwise(txt)
    return new_date, new_time


def month_floor(d) -> Column:
    return F.trunc(C(d), "MM")


def year_month_key(d) -> Column:
    """``year-month`` with the month not zero padded (R ``paste0``)."""
    return F.concat_ws("-", F.year(C(d)).cast("string"), F.month(C(d)).cast("string"))


def month_label(d) -> Column:
    return F.date_format(C(d), "MMM")


def timezone_preview(df: DataFrame, from_tz: str, date_col: str = "Date", time_col: str = "Time") -> DataFrame:
    """The distinct dates and times that ``shift_clock`` would move: those
    outside summer time, with ``PST`` all of them and with ``PDT`` none; a
    time that is missing or not valid is not moved."""
    valid = F.col(time_col).isNotNull() & F.col(time_col).rlike(VALID_TIME)
    moved = {"PDT": F.lit(False), "PST": valid}.get(from_tz, valid & ~in_us_dst(F.col(date_col)))
    return df.where(moved).select(date_col, time_col).distinct().orderBy(date_col, time_col)
