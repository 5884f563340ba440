"""Channel rules and local-zone time expressions."""

from __future__ import annotations

import datetime as _dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from ..config import SearchConfig


def business_channel(account_id: Column, device_type: Column, cfg: SearchConfig) -> Column:
    """Web-account events get a channel from their device type, others keep the account.

    Comparisons are case-sensitive (a lower-case web account keeps its own name).
    """
    expr = None
    for device, channel in cfg.device_channels:
        label = channel if channel is not None else f"{cfg.web_account}({device})"
        cond = (account_id == F.lit(cfg.web_account)) & (device_type == F.lit(device))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(account_id) if expr is not None else account_id


def app_version(account_id: Column, version: Column, cfg: SearchConfig) -> Column:
    """Web-account events report a fixed app version."""
    return F.when(account_id == F.lit(cfg.web_account), F.lit(cfg.web_app_version)).otherwise(version)


def utc_wall_clock(ts: Column, dtype: DataType) -> Column:
    """The UTC wall-clock of an event time as TIMESTAMP_NTZ.

    Zone-less input is taken as UTC already; an instant is rendered in UTC
    from its microseconds, so the session zone and its clock changes play no part.
    """
    if isinstance(dtype, TimestampNTZType):
        return ts
    secs = (F.unix_micros(ts).cast("decimal(18,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def local_datetime(utc_ts: Column, zone: str) -> Column:
    """DATETIME(ts, zone) - the local wall-clock time, zone-less."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_ts)


def local_date(utc_ts: Column, zone: str) -> Column:
    """DATE(ts, zone)."""
    return F.to_date(local_datetime(utc_ts, zone))


def _tzinfo(zone: str) -> _dt.tzinfo:
    """Region ids ('Asia/Jakarta') and fixed offsets ('+07:00') as accepted by Spark."""
    m = re.fullmatch(r"(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?", zone)
    if m:
        delta = _dt.timedelta(hours=int(m.group(2)), minutes=int(m.group(3) or 0))
        return _dt.timezone(delta if m.group(1) == "+" else -delta)
    return ZoneInfo(zone)


def local_midnight_utc(day: _dt.date, zone: str) -> str:
    """UTC wall-clock of local midnight starting ``day`` (driver-side constant)."""
    local = _dt.datetime(day.year, day.month, day.day, tzinfo=_tzinfo(zone))
    utc = local.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return utc.strftime("%Y-%m-%d %H:%M:%S")


def local_date_at_least(ts: Column, dtype: DataType, day: _dt.date, zone: str) -> Column:
    """DATE(ts, zone) >= day, written so the Parquet scan can use it.

    ``ts`` is the stored column and ``dtype`` its type. The first conjunct is
    a plain bound on that column (pushed down as a Parquet filter): a
    zone-less literal for TIMESTAMP_NTZ, an instant for TIMESTAMP. The second
    keeps the result exact in zones whose offset changes around midnight.
    """
    midnight = local_midnight_utc(day, zone)
    if isinstance(dtype, TimestampNTZType):
        bound = F.lit(midnight).cast("timestamp_ntz")
    else:
        utc = _dt.datetime.fromisoformat(midnight).replace(tzinfo=_dt.timezone.utc)
        bound = F.timestamp_seconds(F.lit(int(utc.timestamp())))
    return (ts >= bound) & (local_date(utc_wall_clock(ts, dtype), zone) >= F.lit(day))


def date_between(ts: Column, date_from: _dt.date, date_to: _dt.date) -> Column:
    """DATE(ts) BETWEEN a AND b on a zone-less timestamp, as a range on ts."""
    lo = F.lit(f"{date_from.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(date_to + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    return (ts >= lo) & (ts < hi)
