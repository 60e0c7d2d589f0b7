"""Date rules: lenient date-times that roll over, and strict calendar dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats accepted for date-times, and the dates that mean "none".
DATE_TIME = r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?: ([0-9]{1,2}):([0-9]{2}):([0-9]{2}))?\z"
STRICT_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ZERO_DATES = ["0000-00-00", "0000-00-00 00:00:00"]


def datetime_seconds(s: Column) -> Column:
    """UTC seconds of ``Y-m-d`` or ``Y-m-d H:i:s``.

    Days, months and hours beyond their range carry over, so 2020-02-31 is 2020-03-02.
    """
    def part(i: int) -> Column:
        # A part that is not there is blank; casting a blank would cost an exception per row.
        return F.coalesce(F.nullif(F.regexp_extract(s, DATE_TIME, i), F.lit("")).cast("int"), F.lit(0))

    moment = s.try_cast("timestamp_ntz")
    regular = (
        F.unix_date(moment.cast("date")).cast("bigint") * 86400
        + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment))
    month_start = F.add_months(F.make_date(part(1), F.lit(1), F.lit(1)), part(2) - 1)
    days = F.unix_date(month_start).cast("bigint") + part(3) - 1
    rolled_over = days * 86400 + part(4) * 3600 + part(5) * 60 + part(6)
    return F.when(s.rlike(DATE_TIME) & ~s.isin(ZERO_DATES), F.coalesce(regular, rolled_over))


def strict_date(s: Column) -> Column:
    """The text itself when it is a real calendar date from year 1000 on."""
    return F.when(s.rlike(STRICT_DATE) & (s >= "1000") & s.try_cast("date").isNotNull(), s)


def strict_date_seconds(s: Column) -> Column:
    """UTC seconds of midnight of a strict date; independent of the session zone."""
    return F.unix_date(strict_date(s).try_cast("date")).cast("bigint") * 86400
