"""Column expressions shared by batch, training and streaming. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted trip length in minutes (both ends included) and the code of an
# unknown zone.
MIN_MINUTES = 1
MAX_MINUTES = 60
UNKNOWN_ZONE = -1
ZONE_COLUMNS = ("PULocationID", "DOLocationID")


def as_timestamp(c: Column | str) -> Column:
    """Zone-less timestamp from text or from a timestamp."""
    return F.to_timestamp_ntz(_col(c))


def trip_interval(pickup: Column | str, dropoff: Column | str) -> Column:
    return _col(dropoff) - _col(pickup)


def duration_minutes(pickup: Column | str, dropoff: Column | str) -> Column:
    """Minutes between two timestamps as double, exact to the microsecond.

    The interval becomes decimal seconds, which involves no time zone; `timestampdiff` would read
    zone-less times in the session's zone and be off across a clock change.
    """
    seconds = trip_interval(pickup, dropoff).cast("interval second").cast("decimal(18,6)")
    return seconds.cast("double") / F.lit(60.0)


def in_bounds(duration: Column | str) -> Column:
    """True for an accepted trip length; null stays null, and NaN fails the upper bound."""
    return _col(duration).between(MIN_MINUTES, MAX_MINUTES)


def trip_in_bounds(pickup: Column | str, dropoff: Column | str) -> Column:
    """`in_bounds` of the duration, compared as intervals: no conversion per row."""
    low, high = (F.expr(f"INTERVAL '{m}' MINUTE") for m in (MIN_MINUTES, MAX_MINUTES))
    return trip_interval(pickup, dropoff).between(low, high)


def is_missing(c: Column | str) -> Column:
    """Null or NaN (a table that went through floating point may hold either)."""
    c = _col(c)
    return c.isNull() | F.isnan(c.cast("double"))


def required(name: str) -> Column:
    """A number that must be there: missing (null or NaN) fails the job with the column's name."""
    number = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return F.coalesce(number, F.raise_error(F.lit(f"{name} is missing")).cast("double"))


def zone_number(c: Column | str) -> Column:
    """Zone as a whole number, missing (null or NaN) as -1. Cheap to group and join by."""
    number = F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))
    return F.coalesce(number, F.lit(float(UNKNOWN_ZONE))).cast("bigint")


def zone_code(c: Column | str) -> Column:
    """Zone as text: missing is `-1`, `1.0` is `1`. Applying it to its own result changes nothing."""
    return zone_number(c).cast("string")


def zone_text(c: Column | str) -> Column:
    """Zone printed as it is stored (`1.0` for a double, `1` for an integer), missing as `nan`.

    Kept for comparisons with tables made that way; models use `zone_code`.
    """
    return F.when(is_missing(c), "nan").otherwise(_col(c).cast("string"))


def pair_key(pickup_zone: Column | str, dropoff_zone: Column | str) -> Column:
    return F.concat_ws("_", zone_code(pickup_zone), zone_code(dropoff_zone))


def ride_id(year: Column | str, month: Column | str, position: Column | str) -> Column:
    """`YYYY/MM_<position>`. Built by padding: `format_string` parses its pattern for every row."""
    yyyy = F.lpad(_col(year).cast("string"), 4, "0")
    mm = F.lpad(_col(month).cast("string"), 2, "0")
    return F.concat(yyyy, F.lit("/"), mm, F.lit("_"), _col(position).cast("string"))


def next_month(year: Column | str, month: Column | str) -> Column:
    """First day of the following month (December rolls into the next year)."""
    return F.add_months(F.make_date(_col(year), _col(month), F.lit(1)), 1)


def month_split(period: Column | str, train, val, test) -> Column:
    """`train`/`val`/`test` by month; any other month is null."""
    period = _col(period)
    return F.when(period == F.lit(train), "train").when(period == F.lit(val), "val").when(period == F.lit(test), "test")


def quantised(low: float, high: float, step: float, seed: int) -> Column:
    """A uniform draw from [low, high], rounded to a multiple of `step`."""
    return (F.round((F.lit(low) + F.rand(seed) * F.lit(high - low)) / F.lit(step)) * F.lit(step)).cast("int")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
