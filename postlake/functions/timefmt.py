"""Time conversions. None depends on the session's time zone: dates and ISO
texts of unix seconds are always those of UTC."""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "1970-01-01 00:00:00"
_DS_RE = re.compile(r"^\d{4}-\d{2}-\d{2}$")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_from_unix(unix_seconds: Column | str) -> Column:
    """Unix seconds → TIMESTAMP. Zone-free, unlike from_unixtime + to_utc_timestamp,
    which shifts by an hour in a DST fall-back hour of a non-UTC session."""
    return F.timestamp_seconds(_col(unix_seconds))


def iso_from_unix(unix_seconds: Column | str) -> Column:
    """Unix seconds → 'YYYY-MM-DDTHH:MM:SS' in UTC."""
    wall_clock = F.lit(_EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=_col(unix_seconds).cast("decimal(18,6)"))
    return F.translate(wall_clock.cast("string"), " ", "T")


def utc_date_from_unix(unix_seconds: Column | str) -> Column:
    """Unix seconds → the UTC date."""
    return F.date_from_unix_date(F.floor(_col(unix_seconds) / 86400).cast("int"))


def parse_ds(ds: str | _dt.date) -> _dt.date:
    """Validate a run date up front (a malformed string must not reach SQL)."""
    if isinstance(ds, _dt.datetime):
        raise TypeError("ds must be a date, not a datetime")
    if isinstance(ds, _dt.date):
        return ds
    if not isinstance(ds, str) or not _DS_RE.match(ds):
        raise ValueError(f"ds must look like YYYY-MM-DD, got {ds!r}")
    return _dt.date.fromisoformat(ds)


def date_from_string(value: Column | str) -> Column:
    """'YYYY-MM-DD…' string column → DATE; malformed → NULL (never an error)."""
    return F.try_to_date(F.substring(_col(value), 1, 10), "yyyy-MM-dd")


def ds_literal(ds: str | _dt.date) -> Column:
    return F.lit(parse_ds(ds))


def ds_range(ds_from: str | _dt.date, ds_to: str | _dt.date) -> list[_dt.date]:
    a, b = parse_ds(ds_from), parse_ds(ds_to)
    if b < a:
        raise ValueError("ds_to before ds_from")
    return [a + _dt.timedelta(days=i) for i in range((b - a).days + 1)]
