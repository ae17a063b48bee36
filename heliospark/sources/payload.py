"""Parallel-array hourly payloads -> one row per hour.

A payload is ``{"hourly": {"time": [...], "<variable>": [...], ...}}``. Parsing
is ``from_json`` with an explicit schema and ``posexplode`` over the time
array; each variable is read positionally with ``get`` (NULL when the array
is missing or shorter, never an error). Everything is JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import HOURLY_VARIABLES
from ..functions.numeric import no_nan

HOURLY_SCHEMA = T.StructType(
    [T.StructField("time", T.ArrayType(T.StringType()))]
    + [T.StructField(v, T.ArrayType(T.DoubleType())) for v in HOURLY_VARIABLES]
)
PAYLOAD_SCHEMA = T.StructType([T.StructField("hourly", HOURLY_SCHEMA)])

RAW_SCHEMA = T.StructType(
    [T.StructField("city_name", T.StringType(), False), T.StructField("timestamp", T.TimestampType(), False)]
    + [T.StructField(v, T.DoubleType()) for v in HOURLY_VARIABLES]
)

# ISO-8601 date and time, extended or basic, down to any unit; the offset is
# part of the pattern so that it is told from a date's last part.
ISO_TIME = (
    r"^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:[^\d](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,6})\d*)?)?)?\s*(?:[Zz]|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)?)?$"
)
PLAIN_TIME = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"


def parse_wall_time(s: Column) -> Column:
    """Parse an ISO time as UTC wall time; a trailing offset is dropped, not
    applied (the reference replaces the zone instead of converting)."""
    text = F.trim(s)

    def part(group: int, width: int, left: bool = True) -> Column:
        pad = F.lpad if left else F.rpad
        return pad(F.regexp_extract(text, ISO_TIME, group), width, "0")

    date = F.concat_ws("-", part(1, 4), part(3, 2), part(4, 2))
    time = F.concat(part(5, 2), F.lit(":"), part(6, 2), F.lit(":"), part(7, 2), F.lit("."), part(8, 6, left=False))
    whole = F.try_to_timestamp(F.concat(date, F.lit(" "), time), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    # Most texts have the full width already; taking the others apart costs seven more matches.
    plain = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.when(text.rlike(PLAIN_TIME), plain).when(text.rlike(ISO_TIME), whole)


def explode_payload(df: DataFrame, city: str = "city", payload: str = "payload", strict: bool = False) -> DataFrame:
    """One row per parseable hour of each payload.

    Empty or missing ``time`` -> no rows; missing variable -> NULL column;
    unparseable time -> row dropped. A payload without ``hourly`` raises in
    ``strict`` mode (current loads) and is skipped otherwise (historic loads).
    """
    parsed = df.select(F.col(city).alias("city_name"), F.from_json(F.col(payload), PAYLOAD_SCHEMA).alias("p"))
    if strict:
        parsed = parsed.withColumn(
            "p",
            F.when(F.col("p.hourly").isNull(), F.raise_error(F.lit("payload has no 'hourly' object"))).otherwise(
                F.col("p")
            ),
        )
    else:
        parsed = parsed.filter(F.col("p.hourly").isNotNull())
    return payload_rows(parsed)


def payload_rows(parsed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The hours of parsed payloads: one row per parseable time of
    (``city_name``, ``p``), with the columns ``keep`` beside them."""
    keep = keep or []
    rows = parsed.select(
        "city_name",
        "p",
        *keep,
        F.posexplode(F.coalesce(F.col("p.hourly.time"), F.array().cast("array<string>"))).alias("pos", "t"),
    )
    out = rows.select(
        "city_name",
        parse_wall_time(F.col("t")).alias("timestamp"),
        *[no_nan(F.get(F.col(f"p.hourly.{v}"), F.col("pos"))).alias(v) for v in HOURLY_VARIABLES],
        *keep,
    )
    return out.filter(F.col("timestamp").isNotNull())


def _field(name: str):
    return lambda r: r[name]


def fold_payloads(hourly: DataFrame, variables: dict[str, str], city: str = "city", ts: str = "ts") -> DataFrame:
    """Build one JSON payload per (city, UTC day) from an hourly table.

    Groups are bounded (<= 24 hours per city-day), so ``collect_list`` is
    safe; the arrays are sorted by time.
    """
    day = F.to_date(F.col(ts))
    rows = hourly.select(
        F.col(city).alias("city"),
        day.alias("date"),
        F.struct(F.col(ts).alias("t"), *[F.col(src).alias(dst) for dst, src in variables.items()]).alias("r"),
    )
    g = rows.groupBy("city", "date").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    hourly_struct = F.struct(
        F.transform("rs", lambda r: F.date_format(r["t"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
        *[F.transform("rs", _field(dst)).alias(dst) for dst in variables],
    )
    return g.select("city", "date", F.to_json(F.struct(hourly_struct.alias("hourly"))).alias("payload"))
