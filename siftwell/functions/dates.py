"""Free-form dates: ISO 8601 and the dates of mails and feeds in the JVM, all else by an Arrow UDF."""

from __future__ import annotations

from datetime import UTC, datetime

import pandas as pd
from dateutil import parser
from pyspark.sql import Column
from pyspark.sql import functions as F

_ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?(?:Z|[+-]\d{2}:\d{2})?)?$"
#: What a value leaves open is taken from here, so that results don't change from day to day.
_DEFAULT = datetime(2000, 1, 1)


#: 21 Apr 2025 10:30:00.5 GMT, as in mails and feeds, with or without the day's name and seconds.
_MAIL = r"^(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun), )?(\d{1,2}) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (\d{4}) (\d{2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?))? (?:GMT|UTC|Z|([+-]\d{2}):?(\d{2}))$"


def parse_value(value: str | None) -> datetime | None:
    """The moment in UTC, or None; without a zone it is UTC."""
    try:
        found = parser.parse(value, default=_DEFAULT) if value else None
        if found is None:
            return None
        return found.replace(tzinfo=UTC) if found.tzinfo is None else found.astimezone(UTC)
    except (TypeError, ValueError, OverflowError):
        return None


def parse_datetime(c: Column) -> Column:
    """Timestamp of a free-form text; null if it can't be read. The UDF gets only what isn't ISO."""

    def loose(values: pd.Series) -> pd.Series:
        return pd.Series([parse_value(v) for v in values], dtype="datetime64[us, UTC]")

    native = F.when(c.rlike(_ISO), F.try_to_timestamp(c)).when(c.rlike(_MAIL), _from_mail(c))
    return F.coalesce(native, F.pandas_udf(loose, "timestamp")(F.when(native.isNotNull(), None).otherwise(c)))


def _from_mail(c: Column) -> Column:
    day, month, year, hour, minute, second, zone_hour, zone_minute = (F.regexp_extract(c, _MAIL, i + 1) for i in range(8))
    number = F.lpad(((F.instr(F.lit("JanFebMarAprMayJunJulAugSepOctNovDec"), month) + 2) / 3).cast("int").cast("string"), 2, "0")
    zone = F.when(zone_hour == "", "Z").otherwise(F.concat(zone_hour, F.lit(":"), zone_minute))
    time = F.concat_ws(":", hour, minute, F.when(second == "", "00").otherwise(second))
    return F.try_to_timestamp(F.concat(year, F.lit("-"), number, F.lit("-"), F.lpad(day, 2, "0"), F.lit("T"), time, zone))
