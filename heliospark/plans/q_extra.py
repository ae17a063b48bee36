"""Plans over inputs off the clean path, and the operators with a range or a
window of their own (S1, S3, S5, T1, J6, B23, A10, A11, A30, D3, D4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..functions import decisions as D
from ..operators import timeseries as TS
from ..operators.global_order import with_global_index
from ..operators.models import chronological_split
from ..sources import fixtures as FX
from ..sources import ingest as I
from ..sources.payload import fold_payloads, parse_wall_time
from ..session import shared_path
from ..sources.tables import append_registry, read_registry, weather_scan
from ..sources.upsert import UpsertTable, contract_violations, request_rules, upsert
from ..streaming.jobs import UpsertLog, payload_stream
from . import catalog
from . import q_features as Q
from . import sqltext as S
from .catalog import query
from .common import AS_OF, dense_hourly, long_hourly
from .ghi_analysis import ghi_analysis
from .q_daily import _SQL_GHI_DAILY, _SQL_SUMMARY_CTE
from .q_forecast import predictions
from .q_ingest import DENSE_CITIES, PAYLOAD_VARS, REDELIVER_FROM, UPSERT_CUTOFF, _upsert_inputs
from .q_quality import clip_and_drop_sparse_days, training_window

# -- values that are missing, NaN or out of order ---------------------------------

# Every third reading has no GHI (NaN), every fifth no temperature (NULL or NaN in turn).
_SQL_HOLES = (
    f"holed AS (SELECT event_type AS city, CAST(ts AS TIMESTAMP) AS ts, "
    "CASE WHEN event_id % 3 = 0 THEN NULL ELSE round(value * 8, 4) END AS ghi, "
    "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 37 AS DOUBLE) END AS temp FROM events)"
)


def holed_readings(spark, sf_dir):
    ev = FX.table(spark, sf_dir, "events")
    nan = F.lit(float("nan"))
    raw = ev.select(
        F.col("event_type").alias("place"),
        F.col("ts").cast("timestamp").alias("at"),
        F.when(F.col("event_id") % 3 == 0, nan).otherwise(F.round(F.col("value") * 8, 4)).alias("g"),
        F.when(F.col("event_id") % 10 == 0, nan).when(F.col("event_id") % 5 != 0, (F.col("event_id") % 37).cast("double")).alias("t"),
    )
    return weather_scan(raw, {"city": "place", "ts": "at", "ghi": "g", "temp": "t"})


@query("nan_hourly_means", "S3 T1", f"WITH {_SQL_HOLES}, {S.hourly_cte('holed')} SELECT city, ts, ghi, temp FROM hourly", dates=())
def nan_hourly_means(spark, sf_dir):
    """Hourly means where NaN stands for a missing value."""
    return TS.hourly_means(holed_readings(spark, sf_dir))


@query(
    "nan_daily_summary",
    "A5 S3",
    f"WITH {_SQL_HOLES}, {S.hourly_cte('holed')} SELECT city, CAST(ts AS DATE) AS date, count(*) AS n_hours, count(ghi) AS n_ghi, "
    f"max(ghi) AS peak, min(CASE WHEN ghi >= 1 THEN hour(ts) END) AS first_hour FROM hourly GROUP BY 1, 2",
)
def nan_daily_summary(spark, sf_dir):
    """Hours, values, peak and first sunny hour of a day with NaN readings."""
    h = TS.hourly_means(holed_readings(spark, sf_dir))
    return h.groupBy("city", F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n_hours"),
        F.count("ghi").alias("n_ghi"),
        F.max("ghi").alias("peak"),
        F.min(F.when(F.col("ghi") >= 1, F.hour("ts"))).cast("bigint").alias("first_hour"),
    )


@query(
    "upsert_null_sequence",
    "S5",
    "WITH base AS (SELECT user_id AS k, max(value) AS v FROM events WHERE event_id % 2 = 0 GROUP BY 1), "
    "batch AS (SELECT user_id AS k, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v, "
    "CASE WHEN event_id % 4 = 1 THEN NULL ELSE event_id - 40 END AS seq FROM events WHERE event_id % 2 = 1), "
    "last AS (SELECT k, v FROM (SELECT k, v, row_number() OVER (PARTITION BY k ORDER BY seq DESC NULLS LAST, v DESC NULLS LAST) AS rn "
    "FROM batch) q WHERE rn = 1) "
    "SELECT b.k, b.v, 'target' AS origin FROM base b WHERE b.k NOT IN (SELECT k FROM batch) "
    "UNION ALL SELECT k, v, 'batch' AS origin FROM last",
    dates=(),
)
def upsert_null_sequence(spark, sf_dir):
    """Keyed merge whose deliveries have negative and NULL sequences (NULL is
    the lowest; among equal ones the greatest value wins)."""
    ev = FX.table(spark, sf_dir, "events").select(F.col("user_id").alias("k"), "event_id", "value")
    base = ev.where("event_id % 2 = 0").groupBy("k").agg(F.max("value").alias("v"))
    batch = ev.where("event_id % 2 = 1").select(
        "k", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"), F.when(F.col("event_id") % 4 != 1, F.col("event_id") - 40).alias("seq")
    )
    return upsert(base, batch, ["k"], "seq")


# Two deliveries to a stored table: the re-delivered hours, then the odd hours of
# the last two days again with their radiation taken back and no temperature.
_SECOND_FROM = "2024-01-27 00:00:00"
_STORED_SQL = (
    f"WITH {S.CTE_DENSE}, base AS (SELECT city AS city_name, date_trunc('hour', ts) AS timestamp, "
    f"{S.xavg('temp')} AS temperature_2m, {S.xavg('ghi')} AS shortwave_radiation FROM dense "
    f"WHERE ts < TIMESTAMP '{UPSERT_CUTOFF}' GROUP BY 1, 2), one AS (SELECT city AS city_name, "
    f"date_trunc('hour', ts) AS timestamp, CASE WHEN count(*) > 1 THEN {S.xavg('temp')} END AS temperature_2m, "
    f"{S.xavg('ghi')} AS shortwave_radiation FROM dense WHERE ts >= TIMESTAMP '{REDELIVER_FROM}' GROUP BY 1, 2), "
    "two AS (SELECT city_name, timestamp, CAST(NULL AS DOUBLE) AS temperature_2m, -shortwave_radiation AS shortwave_radiation "
    f"FROM one WHERE timestamp >= TIMESTAMP '{_SECOND_FROM}' AND hour(timestamp) % 2 = 1), "
    "u AS (SELECT *, 0 AS r FROM base UNION ALL SELECT *, 1 FROM one UNION ALL SELECT *, 2 FROM two) "
    "SELECT city_name, timestamp, temperature_2m, shortwave_radiation FROM (SELECT *, row_number() OVER "
    "(PARTITION BY city_name, timestamp ORDER BY r DESC) AS rn FROM u) q WHERE rn = 1"
)


def _deliveries(spark, sf_dir):
    base, one = _upsert_inputs(spark, sf_dir)
    late = (F.col("timestamp") >= F.lit(_SECOND_FROM).cast("timestamp")) & (F.hour("timestamp") % 2 == 1)
    two = one.where(late).withColumns({"temperature_2m": F.lit(None).cast("double"), "shortwave_radiation": -F.col("shortwave_radiation")})
    return base, one, two


@query("upsert_stored", "S5 J4 S6", _STORED_SQL, dates=())
def upsert_stored(spark, sf_dir):
    """A table partitioned by city and day takes in a first load and two
    deliveries, one of them twice, and is read back."""
    loads = [d.withColumn("day", F.to_date("timestamp")) for d in _deliveries(spark, sf_dir)]
    table = UpsertTable(spark, shared_path(spark, "raw-hourly"), ["city_name", "timestamp"], ["city_name", "day"], loads[0].schema)
    for number in (0, 1, 1, 2):
        table.apply(loads[number], number)
    return table.read().drop("day")


@query("stream_upsert_compacted", "ST2 S5", _STORED_SQL, dates=())
def stream_upsert_compacted(spark, sf_dir):
    """The deliveries as a stream into a log that is compacted after the first
    two; the snapshot and the batches after it are read."""
    loads = [d.withColumn("_delivery", F.lit(k)) for k, d in enumerate(_deliveries(spark, sf_dir))]
    landing = shared_path(spark, "landing-log")
    log = UpsertLog(spark, shared_path(spark, "upsert-log"), loads[0].schema, ["city_name", "timestamp"], "_delivery")
    for k, load in enumerate(loads):
        load.write.parquet(f"{landing}/d{k}")
        log.append(spark.readStream.schema(load.schema).option("recursiveFileLookup", "true").parquet(landing))
        if k == 1:
            log.compact()
    return log.read()


@query(
    "stream_payloads",
    "ST1 S1 S2 F4",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS (SELECT *, (day(ts) + length(city)) % 7 AS kind FROM hourly) "
    "SELECT city AS city_name, ts AS timestamp, temp AS temperature_2m, ghi AS shortwave_radiation, 'hour' AS part FROM d WHERE kind > 2 "
    "UNION ALL SELECT city, CAST(CAST(ts AS DATE) AS TIMESTAMP), NULL, NULL, "
    "CASE kind WHEN 0 THEN 'malformed' WHEN 1 THEN 'no hourly object' ELSE 'no time array' END FROM d WHERE kind <= 2 GROUP BY ALL",
    dates=(),
)
def stream_payloads(spark, sf_dir):
    """City-day payloads land as JSON files, some broken off, some without
    hours, and are streamed to hourly rows and rejects."""
    day = (F.dayofmonth("date") + F.length("city")) % 7
    made = fold_payloads(dense_hourly(spark, sf_dir), PAYLOAD_VARS).withColumn("kind", day)
    whole = F.concat(F.lit('{"city":"'), "city", F.lit('","day":"'), F.col("date").cast("string"), F.lit('",'), F.substr("payload", F.lit(2)))
    line = (
        F.when(F.col("kind") == 0, F.left(whole, F.length(whole) - 9))
        .when(F.col("kind") == 1, F.regexp_replace(whole, '"hourly"', '"daily"'))
        .when(F.col("kind") == 2, F.regexp_replace(whole, '"time"', '"moment"'))
        .otherwise(whole)
    )
    landing = shared_path(spark, "landing-payloads")
    made.select(line.alias("value"), "date").write.partitionBy("date").text(landing)
    hourly, rejected = payload_stream(spark, landing, shared_path(spark, "payloads"), max_files=20)
    hours = hourly.select("city_name", "timestamp", "temperature_2m", "shortwave_radiation", F.lit("hour").alias("part"))
    # What a broken record still tells of its city and day is in its text.
    no = F.lit(None).cast("double")
    city, date = (F.regexp_extract("record", f'"{k}":"([^"]*)"', 1) for k in ("city", "day"))
    back = rejected.select(city.alias("city_name"), date.cast("timestamp").alias("timestamp"), no.alias("temperature_2m"), no.alias("shortwave_radiation"), F.col("reason").alias("part"))
    return hours.unionByName(back)


@query(
    "iso_times",
    "S1",
    "SELECT event_id, CAST(date_trunc(CASE event_id % 4 WHEN 0 THEN 'hour' WHEN 1 THEN 'minute' WHEN 2 THEN 'second' ELSE 'day' END, "
    "CAST(ts AS TIMESTAMP)) AS TIMESTAMP) AS at FROM events",
    dates=(),
)
def iso_times(spark, sf_dir):
    """Event times written in basic and extended ISO forms, with and without
    offsets (which are dropped), and parsed again."""
    ev = FX.table(spark, sf_dir, "events")
    t = F.col("ts").cast("timestamp")
    tail = F.when(F.col("event_id") % 4 == 3, "").otherwise(F.element_at(F.array(*[F.lit(z) for z in ("", "Z", "+05:00", "-0330", "+05")]), (F.col("event_id") % 5 + 1).cast("int")))
    shapes = [F.date_format(t, f) for f in ("yyyy-MM-dd'T'HH", "yyyyMMdd'T'HHmm", "yyyy-MM-dd HH:mm:ss", "yyyyMMdd")]
    written = F.element_at(F.array(*shapes), (F.col("event_id") % 4 + 1).cast("int"))
    return ev.select("event_id", parse_wall_time(F.concat(written, tail)).alias("at"))


# -- slices, windows and ranges ----------------------------------------------------

SLICE = ("click", "2024-01-10 06:00:00", "2024-01-20 18:00:00")


@query(
    "city_time_slice",
    "B23",
    f"WITH {S.CTE_DENSE_HOURLY} SELECT city, ts, ghi, temp FROM hourly WHERE city = '{SLICE[0]}' "
    f"AND ts BETWEEN TIMESTAMP '{SLICE[1]}' AND TIMESTAMP '{SLICE[2]}' AND hour(ts) BETWEEN 8 AND 17",
    dates=(),
)
def city_time_slice(spark, sf_dir):
    """One city between two instants, hours 8 to 17."""
    return I.slice_city_range(dense_hourly(spark, sf_dir), *SLICE).where(F.hour("ts").between(8, 17))


@query(
    "city_daylight_summary",
    "A11 B23",
    f"WITH {S.CTE_DENSE_HOURLY}, {_SQL_SUMMARY_CTE}, "
    f"g AS (SELECT city, CAST(ts AS DATE) AS date, max(ghi) AS peak, count(*) AS n, {S.xsum('ghi')} AS sg FROM hourly "
    "WHERE hour(ts) BETWEEN 8 AND 17 GROUP BY 1, 2) SELECT d.city, d.date, "
    f"{S.qmean(f'CAST((solar_hours + no_cooling_hours) * 100 AS {S.DEC})', 'greatest(total_hours, 1)', 1)} AS operating_pct, "
    "coalesce(CASE WHEN n < 10 THEN greatest(peak, 0.0) ELSE peak END, 0.0) AS peak_ghi, "
    "CAST(coalesce(sg, 0) AS DOUBLE) / 10.0 AS avg_ghi, CAST(coalesce(sg, 0) AS DOUBLE) / 1000.0 AS psh FROM summ d LEFT JOIN g USING (city, date)",
)
def city_daylight_summary(spark, sf_dir):
    """The city summary over hours 8 to 17, with the day's operating percentage."""
    return A.city_operating(dense_hourly(spark, sf_dir), hour_range=(8, 17))


@query(
    "missing_cities",
    "J6 S12",
    f"WITH {S.CTE_SITES}, expected AS (SELECT DISTINCT city FROM sites), batch AS (SELECT city FROM sites "
    f"WHERE ts BETWEEN TIMESTAMP '{AS_OF} 09:00:00' AND TIMESTAMP '{AS_OF} 13:00:00') "
    "SELECT city FROM expected WHERE city NOT IN (SELECT city FROM batch)",
    dates=(),
)
def missing_cities(spark, sf_dir):
    """Expected stations that delivered nothing in the current slice."""
    sites = FX.sites(spark, sf_dir)
    batch = I.incremental_slice(sites, f"{AS_OF} 12:00:00")
    return I.missing_keys(sites, batch)


@query(
    "training_window",
    "D3",
    f"WITH {S.CTE_LONG_HOURLY} SELECT city, ts, ghi, temp FROM hourly WHERE ts >= TIMESTAMP '1997-06-01' - INTERVAL 120 DAY AND ts < TIMESTAMP '1997-06-01'",
    dates=(),
)
def rolling_window(spark, sf_dir):
    """The rolling 120-day training window before an instant."""
    return training_window(long_hourly(spark, sf_dir), "1997-06-01 00:00:00", 120)


@query(
    "clipped_days",
    "D4 B22",
    f"WITH {_SQL_HOLES}, {S.hourly_cte('holed')}, c AS (SELECT city, ts, least(greatest(ghi, 0.0), 1400.0) AS ghi, "
    "least(greatest(temp, -10.0), 55.0) AS temp FROM (SELECT city, ts, ghi, temp FROM hourly) h), "
    "m AS (SELECT city, CAST(ts AS DATE) AS d, avg((CAST(ghi IS NULL AS INTEGER) + CAST(temp IS NULL AS INTEGER)) / 2.0) AS gone FROM hourly GROUP BY 1, 2) "
    "SELECT c.city, c.ts, CASE WHEN h.ghi IS NULL THEN NULL ELSE c.ghi END AS ghi, CASE WHEN h.temp IS NULL THEN NULL ELSE c.temp END AS temp "
    "FROM c JOIN hourly h USING (city, ts) JOIN m ON m.city = c.city AND m.d = CAST(c.ts AS DATE) WHERE gone <= 0.30",
    dates=(),
)
def clipped_days(spark, sf_dir):
    """Values clipped to physical ranges; days with over 30 % missing fields dropped."""
    return clip_and_drop_sparse_days(TS.hourly_means(holed_readings(spark, sf_dir)))


_SPINE_SQL = "spine AS (SELECT {k}, CAST(h AS BIGINT) AS hour FROM (SELECT DISTINCT {k} FROM cells) d, range(0, 24) r(h))"


def _pivot_sql(key: str, dim: str, values) -> str:
    cells = ", ".join(f"coalesce(max(CASE WHEN c.{dim} = '{v}' THEN c.ghi END), 0.0) AS \"{v}\"" for v in values)
    return (
        f"WITH {S.CTE_DENSE_HOURLY}, cells AS (SELECT CAST(ts AS DATE) AS date, strftime(ts, '%Y-%m-%d') AS day, hour(ts) AS hour, city, ghi FROM hourly), "
        f"{_SPINE_SQL.format(k=key)} SELECT s.{key}, s.hour, {cells} FROM spine s LEFT JOIN cells c ON s.{key} = c.{key} AND s.hour = c.hour GROUP BY 1, 2"
    )


def _cells(spark, sf_dir):
    day = F.to_date("ts")
    return dense_hourly(spark, sf_dir).select(day.alias("date"), day.cast("string").alias("day"), F.hour("ts").cast("bigint").alias("hour"), "city", "ghi")


@query("hour_pivot_by_city", "A10", _pivot_sql("date", "city", DENSE_CITIES))
def hour_pivot_by_city(spark, sf_dir):
    """For each date an hour by city table of GHI, missing cells 0."""
    return A.hour_pivot(_cells(spark, sf_dir), "city", DENSE_CITIES, "ghi", key="date")


WEEK = [f"2024-01-{d:02d}" for d in range(22, 29)]  # the seven days up to AS_OF


@query("hour_pivot_by_date", "A10", _pivot_sql("city", "day", WEEK), dates=())
def hour_pivot_by_date(spark, sf_dir):
    """For each city an hour by date table of GHI over a week, missing cells 0."""
    return A.hour_pivot(_cells(spark, sf_dir), "day", WEEK, "ghi")


@query(
    "daylight_labels",
    "B18 A5",
    f"WITH {S.CTE_DENSE_HOURLY}, d AS ({_SQL_GHI_DAILY}) SELECT city, date, 24 - zero_hours AS daylight_hours, "
    f"coalesce({S.hour_label('sunrise_hour')} || ' – ' || {S.hour_label('sunset_hour')}, '—') AS daylight FROM d",
)
def daylight_labels(spark, sf_dir):
    """Hours of daylight and their range as text for each city-day."""
    daily = A.ghi_daily(dense_hourly(spark, sf_dir))
    return daily.select("city", "date", (24 - F.col("zero_hours")).alias("daylight_hours"), D.daylight_range("sunrise_hour", "sunset_hour").alias("daylight"))


# The composite analysis: one city and day of seven years of hours.
A30_CITY, A30_DAY = "R", "1994-03-15"
_METRICS = ("peak_ghi", "avg_ghi", "total_irradiance_whm2", "psh", "zero_hours", "sunrise_hour", "sunset_hour")
_PROFILE = ("peak_ghi", "avg_ghi", "psh")
_CURVE = ("avg_ghi_wm2", "avg_temp_c")


def _ghi_analysis_sql() -> str:
    from .q_dashboard import _curve_sql

    def metrics(part: str, src: str, label: str, place: str, names) -> str:
        return " UNION ALL ".join(f"SELECT '{part}' AS part, {label} AS label, {place} AS place, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}" for m in names)

    day = f"DATE '{A30_DAY}'"
    mode = f"SELECT 'statistics', city || ' ' || CASE WHEN date <= DATE '{AS_OF}' THEN 'HISTORICAL' ELSE 'PREDICTION' END, CAST(date AS VARCHAR), 'source_mode', NULL FROM daily WHERE date = {day}"
    return (
        f"WITH {S.CTE_LONG_HOURLY}, every AS ({_SQL_GHI_DAILY}), daily AS (SELECT * FROM every WHERE city = '{A30_CITY}'), "
        f"curve AS (SELECT * FROM ({_curve_sql('representative')}) c WHERE city = '{A30_CITY}'), "
        f"prof AS (SELECT city, CAST(ts AS DATE) AS date, {S.rnd('max(ghi)', 2)} AS peak_ghi, {S.qmean(S.xsum('ghi'), '24', 2)} AS avg_ghi, "
        f"{S.psh_from_sum(S.xsum('ghi'), 3)} AS psh FROM hourly GROUP BY 1, 2) "
        + " UNION ALL ".join([
            metrics("statistics", f"daily WHERE date = {day}", "city", "CAST(date AS VARCHAR)", _METRICS),
            mode,
            metrics("weekly_trend", f"daily WHERE date BETWEEN {day} - 6 AND {day}", "city", "CAST(date AS VARCHAR)", _METRICS),
            metrics("city_comparison", f"prof WHERE date = {day}", "city", "CAST(date AS VARCHAR)", _PROFILE),
            metrics("seasonal", "curve", "season", "CAST(hour AS VARCHAR)", _CURVE),
        ])
    )


@query("ghi_analysis", "A30", _ghi_analysis_sql(), dates=())
def ghi_analysis_parts(spark, sf_dir):
    """The four parts of the composite analysis of one city and day, in long form."""
    parts = ghi_analysis(long_hourly(spark, sf_dir), A30_CITY, A30_DAY, AS_OF)

    def long(part: str, label, place, names):
        cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in names])).alias("c")
        return parts[part].select(F.lit(part).alias("part"), label.alias("label"), place.cast("string").alias("place"), cells).select("part", "label", "place", "c.metric", "c.value")

    city, date = F.col("city"), F.col("date")
    mode = parts["statistics"].select(
        F.lit("statistics").alias("part"), F.concat_ws(" ", "city", "source_mode").alias("label"), date.cast("string").alias("place"), F.lit("source_mode").alias("metric"), F.lit(None).cast("double").alias("value")
    )
    out = long("statistics", city, date, _METRICS).unionByName(mode).unionByName(long("weekly_trend", city, date, _METRICS))
    return out.unionByName(long("city_comparison", city, date, _PROFILE)).unionByName(long("seasonal", F.col("season"), F.col("hour"), _CURVE))


# -- contracts, coverage, guards and order ------------------------------------------


@query(
    "request_contract",
    "B19 S6",
    "WITH r AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_id) % 5 AS panels, min(value) - 5 AS rating, min(event_id) % 14 AS month, "
    "count(*) FILTER (WHERE value > 20) AS hours, count(*) FILTER (WHERE value > 20 AND value < 30) AS low FROM events GROUP BY 1, 2) "
    "SELECT unnest(['null_user_id', 'null_day', 'negative_ghi', 'panel_count_below_1', 'rating_not_positive', 'month_out_of_range', 'no_hours', 'duplicate_key']) AS rule, "
    "unnest([0, 0, count(*) FILTER (WHERE low > 0), count(*) FILTER (WHERE panels < 1), count(*) FILTER (WHERE rating <= 0), "
    "count(*) FILTER (WHERE month < 1 OR month > 12), count(*) FILTER (WHERE hours = 0), 0]) AS violations FROM r",
    dates=(),
)
def request_contract(spark, sf_dir):
    """Simulation requests, one for each user's day, against the request rules."""
    ev = FX.table(spark, sf_dir, "events")
    requests = ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        (F.min("event_id") % 5).alias("panel_count"),
        (F.min("value") - 5).alias("panel_watt_rating"),
        (F.min("event_id") % 14).alias("month"),
        F.collect_list(F.when(F.col("value") > 20, F.col("value") - 30)).alias("hourly_ghi"),  # a user's day
    )
    return contract_violations(requests, ["user_id", "day"], ["user_id", "day"], request_rules())


@query(
    "ingest_report",
    "S12 J6",
    f"WITH {S.CTE_SITES}, e AS (SELECT DISTINCT 'site_' || c_custkey AS city FROM customer), b AS (SELECT DISTINCT city FROM sites "
    f"WHERE ts BETWEEN TIMESTAMP '{AS_OF} 09:00:00' AND TIMESTAMP '{AS_OF} 13:00:00') "
    "SELECT count(*) AS total, count(b.city) AS successes, count(*) - count(b.city) AS failures, count(*) > count(b.city) AS partial FROM e LEFT JOIN b USING (city)",
    dates=(),
)
def ingest_report(spark, sf_dir):
    """The latest poll against a given list of stations (one a customer)."""
    expected = FX.table(spark, sf_dir, "customer").select(F.concat(F.lit("site_"), F.col("c_custkey").cast("string")).alias("city"))
    return I.ingest_summary(I.coverage(expected, I.incremental_slice(FX.sites(spark, sf_dir), f"{AS_OF} 12:00:00")))


@query(
    "guarded_training_rows",
    "B21 B20 M1",
    f"WITH {S.CTE_DENSE_HOURLY}, s AS (SELECT * FROM hourly WHERE ts <= TIMESTAMP '{AS_OF} 12:00:00' - INTERVAL 2 DAY), "
    "r AS (SELECT city, ts, ghi, temp, row_number() OVER (ORDER BY ts, city) - 1 AS i, count(*) OVER () AS n FROM s) "
    "SELECT city, ts, ghi, temp, CASE WHEN i < CAST(floor(n * 0.8) AS BIGINT) THEN 'train' ELSE 'test' END AS split FROM r",
    dates=(),
)
def guarded_training_rows(spark, sf_dir):
    """The rows that training may see: the stable slice, past the guard, split by time."""
    rows = I.stable_recent_split(dense_hourly(spark, sf_dir), f"{AS_OF} 12:00:00", 2)
    guarded = I.guard_training_slice(rows.where("slice = 'stable'"))
    return chronological_split(guarded, ["ts", "city"], 0.8).select("city", "ts", "ghi", "temp", "split")


@query(
    "ordered_scan",
    "O1 S3",
    f"WITH {S.CTE_DENSE} SELECT city, CAST(row_number() OVER (ORDER BY city) AS BIGINT) AS place, min(ts) AS first_ts, max(ts) AS last_ts, "
    "CAST(count(*) AS BIGINT) AS n FROM dense GROUP BY city",
    dates=(),
)
def ordered_scan(spark, sf_dir):
    """The scan sorted by city and time, written and read back: each city's
    place in the order and its first and last row."""
    raw = FX.dense(spark, sf_dir)
    path = shared_path(spark, "ordered")
    ordered = weather_scan(raw, {c: c for c in ("city", "ts", "ghi", "temp")}, order=True)
    ordered.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    cities = spark.read.parquet(path).groupBy("city").agg(F.min("_at").alias("_a"), F.min_by("ts", "_at").alias("first_ts"), F.max_by("ts", "_at").alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return with_global_index(cities, ["_a"], "place").select("city", (F.col("place") + 1).cast("bigint").alias("place"), "first_ts", "last_ts", "n")


# -- saved parameters and registries -------------------------------------------------


@query("scaler_reapplied", "T10 S7 S8", catalog.ORACLES["feature_matrix"], dates=())
def scaler_reapplied(spark, sf_dir):
    """The feature matrix from parameters that were fitted, written and read
    again, applied to the stored unscaled features."""
    features, params = shared_path(spark, "features"), shared_path(spark, "scaler")
    Q.features_unscaled(spark, sf_dir).write.parquet(features)
    stored = spark.read.parquet(features)
    TS.scaler_params(stored, Q.SCALED).write.parquet(params)
    return Q._round_cyc(TS.apply_scaler(stored, spark.read.parquet(params)))


@query("metrics_registry", "S10 S11 A22", catalog.ORACLES["model_metrics"], dates=())
def metrics_registry(spark, sf_dir):
    """Metrics of two runs appended to a registry table; the last run read back."""
    path = shared_path(spark, "registry")
    metrics = A.regression_metrics(predictions(spark, sf_dir), ["model_name", "target"])
    append_registry(metrics.withColumn("mae", F.lit(0.0)), path, "run-0")
    append_registry(metrics, path, "run-1")
    return read_registry(spark, path).where("run_id = 'run-1'").select(*metrics.columns)
