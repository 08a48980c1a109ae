"""The registered queries in plain SQL over the supplied tables."""

from __future__ import annotations

from tripline.workload import BATCH_NO, DELIVERY, INGESTED_AT, ORDER, RAW_SQL

NOW = "TIMESTAMP '2014-09-30 00:00:00'"
AS_OF = "TIMESTAMP '2012-06-15 12:00:00'"
TODAY = "DATE '2012-06-15'"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def iso(ts: str, sep: str = "T") -> str:
    return f"strftime({ts}, '%Y-%m-%d{sep}%H:%M:%S+00:00')"


VENDOR = (
    "CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'"
    " ELSE 'Unknown' END"
)
PAYMENT = (
    "CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'"
    " WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END"
)
RATE = (
    "CASE rate_code_id WHEN 1 THEN 'Standard' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'"
    " WHEN 4 THEN 'Nassau or Westchester' WHEN 5 THEN 'Negotiated fare'"
    " WHEN 6 THEN 'Group ride' ELSE 'Unknown' END"
)
FLAG = (
    "CASE store_and_fwd_flag WHEN 'Y' THEN 'Yes' WHEN 'y' THEN 'Yes' WHEN 'N' THEN 'No'"
    " WHEN 'n' THEN 'No' ELSE 'Unknown' END"
)
PAX = (
    "CASE WHEN passenger_count IS NULL OR passenger_count < 1 THEN 1"
    " ELSE CAST(trunc(passenger_count) AS BIGINT) END"
)

_cols = ",\n  ".join(f"{sql} AS {name}" for name, sql in RAW_SQL.items())

RAW = f"""
sent AS (
  SELECT *, 1 AS write_seq FROM lineitem
  UNION ALL
  SELECT *, 2 AS write_seq FROM lineitem WHERE l_returnflag = 'R'
),
raw AS (
  SELECT {_cols},
  {BATCH_NO} AS batch_no,
  sha256('lineitem.parquet|' || CAST(({BATCH_NO}) AS VARCHAR) || '|'
         || CAST(({DELIVERY}) AS VARCHAR)) AS batch_id,
  {INGESTED_AT} AS sent_at,
  {", ".join(ORDER)}
  FROM sent
)"""

GATED = (
    RAW
    + f""",
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN pickup_datetime IS NULL
         THEN 'pickup_datetime: Input should be a valid datetime' END,
    CASE WHEN pickup_location_id <= 0 THEN
         'pickup_location_id: Value error, location_id must be positive, got '
         || CAST(pickup_location_id AS VARCHAR) END,
    CASE WHEN dropoff_location_id IS NULL
         THEN 'dropoff_location_id: Input should be a valid integer' END,
    CASE WHEN extra IS NOT NULL AND TRY_CAST(extra AS DOUBLE) IS NULL THEN
         'extra: Input should be a valid number, unable to parse string as a number' END
  ) AS field_errors FROM raw
),
gated AS (
  SELECT *, CASE WHEN field_errors <> '' THEN field_errors
    WHEN dropoff_datetime < pickup_datetime THEN
      ': Value error, dropoff_datetime (' || {iso('dropoff_datetime', ' ')}
      || ') must be after pickup_datetime (' || {iso('pickup_datetime', ' ')} || ')'
    END AS schema_error FROM checked
)"""
)


def judged(gate: bool = True, now: str = NOW) -> str:
    first = (
        "WHEN schema_error IS NOT NULL THEN 'schema' WHEN isinf(rate_code_id) THEN 'infinite'"
        if gate
        else "WHEN isinf(rate_code_id) THEN 'infinite'"
        " WHEN pickup_datetime IS NULL THEN 'parse_pickup'"
        " WHEN dropoff_location_id IS NULL THEN 'parse_location'"
    )
    parse = "" if gate else " WHEN TRY_CAST(coalesce(extra, '0') AS DOUBLE) IS NULL THEN 'parse_extra'"
    return (
        GATED
        + f""",
measured AS (
  SELECT *, {VENDOR} AS vendor, {PAX} AS pax,
    date_diff('second', pickup_datetime, dropoff_datetime) AS secs FROM gated
),
judged AS (
  SELECT *, CASE {first}
    WHEN trip_distance < 0 THEN 'distance'
    WHEN fare_amount < 0 THEN 'money'{parse}
    WHEN isnan(congestion_surcharge) THEN 'nan'
    WHEN tolls_amount >= 9999999.995 THEN 'range'
    WHEN secs <= 0 OR secs >= 86400 THEN 'duration'
    WHEN pax > 9 THEN 'passengers'
    WHEN pickup_datetime < TIMESTAMP '2009-01-01 00:00:00' THEN 'early'
    WHEN pickup_datetime > {now} + INTERVAL '1' DAY THEN 'future'
    ELSE 'ok' END AS first_failure,
    sha256(vendor || '|' || {iso('pickup_datetime')} || '|' || {iso('dropoff_datetime')}
      || '|' || CAST(pickup_location_id AS VARCHAR)) AS full_id
  FROM measured
),
ranked AS (
  SELECT *, CASE WHEN first_failure IN ('ok', 'duration', 'passengers', 'early', 'future')
    THEN full_id END AS trip_id,
    row_number() OVER (PARTITION BY batch_id, full_id, first_failure = 'ok'
      ORDER BY {", ".join(ORDER)}) AS place
  FROM judged
),
verdict AS (
  SELECT *, CASE WHEN first_failure = 'ok' AND place > 1 THEN 'duplicate'
    ELSE first_failure END AS failure FROM ranked
)"""
    )


def errors(gate: bool = True, now: str = NOW) -> str:
    return (
        judged(gate, now)
        + f""",
rejected AS (
  SELECT *,
    CASE WHEN failure = 'duplicate' THEN 'deduplication'
      WHEN failure IN ('schema', 'money', 'duration', 'passengers', 'early', 'future')
      THEN 'validation' ELSE 'parsing' END AS stage,
    CASE failure WHEN 'schema' THEN 'SchemaValidationError'
      WHEN 'infinite' THEN 'OverflowError' WHEN 'range' THEN 'OverflowError'
      WHEN 'nan' THEN 'InvalidOperation' WHEN 'distance' THEN 'ValueError'
      WHEN 'money' THEN 'NegativeMoneyError' WHEN 'duration' THEN 'InvalidTripDurationError'
      WHEN 'passengers' THEN 'InvalidPassengerCountError'
      WHEN 'duplicate' THEN 'WithinBatchDuplicate'
      WHEN 'early' THEN 'InvalidPickupDatetimeError'
      WHEN 'future' THEN 'InvalidPickupDatetimeError' ELSE 'TripParseError' END AS error_type,
    CASE failure WHEN 'schema' THEN schema_error
      WHEN 'infinite' THEN 'cannot convert float infinity to integer'
      WHEN 'range' THEN 'A monetary amount does not fit the range of the fare columns'
      WHEN 'nan' THEN 'Fare field ''congestion_surcharge'' is not a number'
      WHEN 'distance' THEN 'Distance cannot be negative, got ' || CAST(trip_distance AS VARCHAR)
      WHEN 'money' THEN 'Fare field ''fare_amount'' has negative value '
        || CAST(CAST(fare_amount AS DOUBLE) AS VARCHAR) || '. All monetary amounts must be >= 0.'
      WHEN 'duration' THEN 'Trip duration ' || CAST(secs AS VARCHAR)
        || 's is invalid. Must be > 0 and < 86400 (24 hours).'
      WHEN 'passengers' THEN 'Passenger count ' || CAST(pax AS VARCHAR)
        || ' is invalid. Must be between 1 and 9.'
      WHEN 'early' THEN 'Pickup datetime ''' || {iso('pickup_datetime', ' ')}
        || ''' is invalid: before TLC minimum date 2009-01-01'
      WHEN 'future' THEN 'Pickup datetime ''' || {iso('pickup_datetime', ' ')}
        || ''' is invalid: is in the future'
      WHEN 'duplicate' THEN 'Duplicate trip_id within batch: ' || trip_id
      WHEN 'parse_pickup' THEN
        'Cannot parse field ''pickup_datetime'' with value ''None'': cannot convert to datetime'
      WHEN 'parse_location' THEN 'Cannot parse field ''location_id'' with value '''
        || CAST(pickup_location_id AS VARCHAR) || ''': cannot convert None to int'
      WHEN 'parse_extra' THEN 'Cannot parse field ''extra'' with value ''' || extra
        || ''': not a valid decimal'
    END AS error_message
  FROM verdict WHERE failure <> 'ok'
)"""
    )


ZONES = """
zone_table AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def valid_of(source: str, ingested: str = "sent_at") -> str:
    return f"""
valid_rows AS (
  SELECT trip_id, vendor AS vendor_id, pickup_datetime, dropoff_datetime,
    secs AS trip_duration_seconds, pax AS passenger_count,
    coalesce(trip_distance, 0) AS trip_distance,
    pickup_location_id, dropoff_location_id,
    coalesce(pz.zone, 'Unknown') AS pickup_zone, coalesce(dz.zone, 'Unknown') AS dropoff_zone,
    coalesce(pz.borough, 'Unknown') AS pickup_borough,
    coalesce(dz.borough, 'Unknown') AS dropoff_borough,
    CAST(fare_amount AS DECIMAL(9,2)) AS fare_amount,
    CAST(coalesce(extra, '0') AS DECIMAL(9,2)) AS extra,
    CAST(mta_tax AS DECIMAL(9,2)) AS mta_tax,
    CAST(tip_amount AS DECIMAL(9,2)) AS tip_amount,
    CAST(coalesce(tolls_amount, 0) AS DECIMAL(9,2)) AS tolls_amount,
    CAST(0 AS DECIMAL(9,2)) AS improvement_surcharge,
    CAST(coalesce(congestion_surcharge, 0) AS DECIMAL(9,2)) AS congestion_surcharge,
    CAST(0 AS DECIMAL(9,2)) AS airport_fee,
    CAST(total_amount AS DECIMAL(9,2)) AS total_amount,
    {PAYMENT} AS payment_type, {RATE} AS rate_code, {FLAG} AS store_and_fwd_flag,
    {ingested} AS ingested_at, batch_id, 'lineitem.parquet' AS source_file, write_seq,
    l_orderkey, l_linenumber, l_partkey
  FROM {source} v
  LEFT JOIN zone_table pz ON pz.location_id = v.pickup_location_id
  LEFT JOIN zone_table dz ON dz.location_id = v.dropoff_location_id
)"""


VALID = (
    judged()
    + ","
    + ZONES
    + ", accepted AS (SELECT * FROM verdict WHERE failure = 'ok'),"
    + valid_of("accepted")
)

CURRENT = (
    VALID
    + """,
current_rows AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY pickup_datetime, vendor_id, trip_id
      ORDER BY ingested_at DESC, write_seq DESC, batch_id DESC) AS version FROM valid_rows
  ) WHERE version = 1
)"""
)


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.lstrip().lstrip(',')}\n{body}"


MONEY = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "congestion_surcharge", "airport_fee", "total_amount",
]
_TRIP = [
    "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "trip_duration_seconds",
    "passenger_count", "trip_distance", "pickup_location_id", "dropoff_location_id",
    "pickup_zone", "dropoff_zone", "pickup_borough", "dropoff_borough", *MONEY,
    "payment_type", "rate_code", "store_and_fwd_flag", "ingested_at", "batch_id", "source_file",
]
_INTS = {"trip_duration_seconds", "passenger_count", "pickup_location_id", "dropoff_location_id",
         "write_seq", "l_orderkey", "l_linenumber", "l_partkey"}


def out(*names: str) -> str:
    """Select list with the types the queries return."""

    def one(n: str) -> str:
        if n in ("pickup_datetime", "dropoff_datetime", "ingested_at"):
            return f"{text(n)} AS {n}"
        if n in MONEY or n == "trip_distance":
            return f"CAST({n} AS DOUBLE) AS {n}"
        if n in _INTS:
            return f"CAST({n} AS BIGINT) AS {n}"
        return n

    return ", ".join(one(n) for n in names)


IDS = out("l_orderkey", "l_linenumber", "l_partkey", "write_seq")
_ERR = f"{IDS}, batch_id, trip_id, stage, error_type, error_message"


def rule(failures: str, gate: bool = True) -> str:
    return with_(errors(gate), f"SELECT {_ERR} FROM rejected WHERE failure IN ({failures})")


def labelled(expr: str) -> str:
    return with_(
        RAW,
        f"SELECT {expr} AS label, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS key_sum"
        " FROM raw GROUP BY 1",
    )


def rollup(source: str, bucket: str, keys: list[str], sums: list[str], ctes: str = CURRENT) -> str:
    grain = "hour" if "hour" in bucket else "day"
    shown = text("bucket") if grain == "hour" else "CAST(CAST(bucket AS DATE) AS VARCHAR)"
    plain = {"trip_duration_seconds", "passenger_count"}
    totals = [
        f"CAST(s_{m} AS {'BIGINT' if m in plain else 'DOUBLE'}) AS total_{m}" for m in sums
    ]
    means = [f"CAST(s_{m} AS DOUBLE) / n AS avg_{m}" for m in sums]
    return with_(
        ctes,
        f"SELECT {shown} AS {grain}, {', '.join(keys)}, n AS trips, {', '.join(totals + means)}"
        f" FROM (SELECT {bucket} AS bucket, {', '.join(keys)}, count(*) AS n, "
        + ", ".join(f"sum({m}) AS s_{m}" for m in sums)
        + f" FROM {source} GROUP BY ALL)",
    )


_HOUR, _DAY = "date_trunc('hour', pickup_datetime)", "CAST(pickup_datetime AS DATE)"
HOURLY = ["total_amount", "trip_distance", "trip_duration_seconds", "passenger_count"]
DAILY = ["total_amount", "tip_amount", "trip_distance", "trip_duration_seconds"]
A1 = rollup("current_rows", _HOUR, ["vendor_id"], HOURLY)
A2 = rollup("current_rows", _DAY, ["vendor_id", "payment_type"], DAILY)
A3 = rollup(
    "current_rows", _DAY, ["pickup_borough", "dropoff_borough"], ["total_amount", "trip_distance"]
)
A4 = rollup("current_rows", _DAY, ["payment_type"], ["total_amount", "tip_amount"])
A5 = rollup("current_rows", _DAY, ["pickup_zone", "pickup_borough"], ["total_amount"])


def mean(m: str) -> str:
    return f"CAST(sum({m}) AS DOUBLE) / count(*)"


_MONTH = "CAST(year(pickup_datetime) * 100 + month(pickup_datetime) AS BIGINT)"


def months(source: str, where: str = "") -> str:
    return with_(
        CURRENT,
        f"SELECT {_MONTH} AS pickup_month, count(*) AS trips,"
        f" CAST(sum(total_amount) AS DOUBLE) AS revenue FROM {source} {where} GROUP BY 1",
    )


# Letters replayed a month later, without the gate and without the repeats.
_LATER = "TIMESTAMP '2014-10-30 00:00:00'"


def replayed(now: str) -> str:
    """First judgement picks the letters, the second one judges them again."""
    again = f""",
letters AS (SELECT * FROM rejected WHERE stage <> 'deduplication'),
rejudged AS (
  SELECT * REPLACE (CASE WHEN isinf(rate_code_id) THEN 'infinite'
    WHEN pickup_datetime IS NULL THEN 'parse_pickup'
    WHEN dropoff_location_id IS NULL THEN 'parse_location'
    WHEN trip_distance < 0 THEN 'distance'
    WHEN fare_amount < 0 THEN 'money'
    WHEN TRY_CAST(coalesce(extra, '0') AS DOUBLE) IS NULL THEN 'parse_extra'
    WHEN isnan(congestion_surcharge) THEN 'nan'
    WHEN tolls_amount >= 9999999.995 THEN 'range'
    WHEN secs <= 0 OR secs >= 86400 THEN 'duration'
    WHEN pax > 9 THEN 'passengers'
    WHEN pickup_datetime < TIMESTAMP '2009-01-01 00:00:00' THEN 'early'
    WHEN pickup_datetime > {now} + INTERVAL '1' DAY THEN 'future' ELSE 'ok' END AS failure)
  FROM letters
)"""
    return errors() + again


_REPLAY = replayed(_LATER)
_RE_ERR = errors().split("rejected AS (")[1].replace(
    "FROM verdict WHERE failure <> 'ok'",
    "FROM (SELECT * EXCLUDE (stage, error_type, error_message) FROM rejudged)"
    " WHERE failure <> 'ok'",
)

_EVENT_RUNS = """
runs AS (
  SELECT event_type AS source_file, CAST(event_id AS VARCHAR) AS batch_id, ts AS ended_at,
    CAST(floor(value * 20000) AS BIGINT) AS micros,
    CAST(floor(value * 10) AS BIGINT) AS size, CAST(floor(value / 5) AS BIGINT) AS bad,
    CASE WHEN event_type = 'error' THEN CAST(floor(value * 10) AS BIGINT) ELSE 0 END AS refused,
    CASE WHEN event_type = 'signup' THEN 0 ELSE CAST(floor(value * 10) AS BIGINT) END AS stored
  FROM events
)"""

_OFFSETS = """
offsets AS (
  SELECT topic, "partition", current_offset,
    CASE WHEN low < 3 THEN -1001 ELSE current_offset - low * 40 + 2000 END AS committed_offset
  FROM (SELECT event_type AS topic, user_id % 4 AS "partition", max(event_id) AS current_offset,
    min(event_id) AS low FROM events GROUP BY 1, 2)
),
lags AS (
  SELECT *, CASE WHEN committed_offset < 0 THEN current_offset
    ELSE greatest(0, current_offset - committed_offset) END AS lag FROM offsets
)"""


def histogram(value: str, bounds: list, names: str) -> str:
    parts = [
        f"SELECT source_file, CAST({b} AS DOUBLE) AS bound,"
        f" count(*) FILTER (WHERE {value} <= {b}) AS cumulative{names} FROM runs GROUP BY 1"
        for b in bounds
    ]
    parts.append(
        "SELECT source_file, CAST(NULL AS DOUBLE) AS bound, count(*) AS cumulative"
        f"{names} FROM runs GROUP BY 1"
    )
    return with_(_EVENT_RUNS, " UNION ALL ".join(parts))


_QUANTITIES = ["", *"thousand million billion trillion quadrillion quintillion".split()]
_SIZES = "B KiB MiB GiB TiB PiB EiB ZiB YiB".split()
#: Why a message made from an event cannot be stored.
_UNUSABLE = (
    "CASE event_type WHEN 'view' THEN 'not a JSON object' WHEN 'signup' THEN 'not a JSON object'"
    " WHEN 'error' THEN 'total_amount cannot be read' WHEN 'purchase' THEN 'trip_id is missing' END"
)
_DUR = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def bucket_quantile(q: float) -> str:
    cases, low, below = [], 0.0, "0"
    for i, b in enumerate(_DUR):
        cases.append(
            f"WHEN le_{i} >= {q}::DOUBLE * n AND le_{i} > 0 THEN {low}::DOUBLE + ({b}::DOUBLE"
            f" - {low}::DOUBLE) * (({q}::DOUBLE * n - {below}) / nullif(le_{i} - {below}, 0))"
        )
        low, below = b, f"le_{i}"
    return f"CASE {' '.join(cases)} ELSE 10.0::DOUBLE END"


def readable(n: str, base: int, units: list[str]) -> str:
    cases = []
    for p, unit in enumerate(units):
        shown = f"printf('%.2f', round({n} / {float(base ** p)}::DOUBLE, 2))" + (f" || ' {unit}'" if unit else "")
        last = p == len(units) - 1
        cases.append(f"ELSE {shown}" if last else f"WHEN {n} < {base ** (p + 1)} THEN {shown}")
    return f"CASE {' '.join(cases)} END"


def oracle() -> dict[str, str]:
    raw_out = ", ".join(
        {
            "pickup_datetime": f"{text('pickup_datetime')} AS pickup_datetime",
            "dropoff_datetime": f"{text('dropoff_datetime')} AS dropoff_datetime",
            "rate_code_id": "CASE WHEN isinf(rate_code_id) THEN NULL ELSE rate_code_id END"
            " AS rate_code_id",
            "congestion_surcharge": "CASE WHEN isnan(congestion_surcharge) THEN NULL"
            " ELSE congestion_surcharge END AS congestion_surcharge",
            "improvement_surcharge": "CAST(NULL AS DOUBLE) AS improvement_surcharge",
        }.get(
            n,
            f"CAST({n} AS BIGINT) AS {n}"
            if n in ("vendor_id", "pickup_location_id", "dropoff_location_id", "payment_type")
            else f"CAST({n} AS DOUBLE) AS {n}"
            if n not in ("extra", "store_and_fwd_flag")
            else n,
        )
        for n in RAW_SQL
    )
    sql = {
        "s1_trip_scan": with_(RAW, f"SELECT {raw_out} FROM raw"),
        "s2_column_pruning": with_(
            RAW,
            "SELECT count(*) AS rows, "
            + ", ".join(
                f"count({n}) AS {n}" if n != "improvement_surcharge" else f"0 AS {n}"
                for n in RAW_SQL
            )
            + " FROM raw",
        ),
        "s3_rename": with_(
            RAW,
            "SELECT CAST(vendor_id AS BIGINT) AS vendor_id, CAST(pickup_location_id AS BIGINT) AS"
            " pickup_location_id, CAST(dropoff_location_id AS BIGINT) AS dropoff_location_id,"
            f" count(*) AS rows, {text('min(pickup_datetime)')} AS pickup_datetime,"
            f" {text('max(dropoff_datetime)')} AS dropoff_datetime, count(rate_code_id) AS"
            " rate_code_id FROM raw GROUP BY 1, 2, 3",
        ),
        "s4_provenance": "SELECT 'lineitem.parquet' AS source_file,"
        " least(1000, n - b * 1000) AS rows, b * 1000 AS first_row, TRUE AS id_known"
        " FROM (SELECT count(*) AS n FROM lineitem),"
        " LATERAL (SELECT unnest(range(0, (n + 999) // 1000)) AS b)",
        "s5_zone_scan": "SELECT CAST(n_nationkey AS BIGINT) AS location_id, r_name AS borough,"
        " n_name AS zone, 'Boro Zone' AS service_zone"
        " FROM nation JOIN region ON n_regionkey = r_regionkey",
        "s6_message_stream": with_(
            VALID,
            "SELECT "
            + out("trip_id", "vendor_id", "pickup_datetime", "total_amount", "batch_id")
            + " FROM valid_rows",
        ),
        "s7_json_decode": "SELECT event_id, event_type IN ('view', 'signup') AS malformed, "
        + _UNUSABLE
        + " AS unusable, CAST(CASE WHEN event_type = 'click' THEN CASE WHEN event_id % 3 < 2 THEN 2"
        " ELSE 0 END END AS BIGINT) AS passenger_count,"
        " CASE WHEN event_type = 'click' THEN 12.5::DOUBLE END AS total_amount FROM events",
        "s8_rejected_scan": with_(
            errors(),
            "SELECT trip_id, error_message, error_type, stage, batch_id,"
            f" 'lineitem.parquet' AS source_file, {text('l_shipdate')} AS failed_at,"
            " CAST(0 AS BIGINT) AS retry_count FROM rejected",
        ),
        "s8_broken_files": with_(
            errors(),
            "SELECT 'letter' AS kind, error_type, count(*) AS rows FROM rejected GROUP BY 2"
            " UNION ALL SELECT 'file cut', 'cut short after', 0"
            " UNION ALL SELECT 'file odd', 'damaged after', 0",
        ),
        "s9_table_scan": with_(CURRENT, f"SELECT {out(*_TRIP)} FROM current_rows"),
        "k1_publish_messages": with_(
            VALID,
            "SELECT trip_id AS key, vendor_id, " + iso("pickup_datetime") + " AS pickup_datetime,"
            " CAST(passenger_count AS BIGINT) AS passenger_count, pickup_zone,"
            " CAST(total_amount AS DOUBLE) AS total_amount FROM valid_rows",
        ),
        "k2_fact_insert": with_(
            VALID, f"SELECT {out(*_TRIP)}, {_MONTH} AS pickup_month FROM valid_rows"
        ),
        "k3_upsert": with_(CURRENT, f"SELECT {out(*_TRIP)} FROM current_rows"),
        "k4_dead_letter_write": with_(
            errors(),
            "SELECT d.destination, stage, error_type, count(*) AS letters,"
            " count(trip_id) AS with_trip_id FROM rejected,"
            " (VALUES ('files'), ('files'), ('topic'), ('topic')) AS d(destination)"
            " GROUP BY 1, 2, 3",
        ),
        "k5_deliver_then_commit": months("current_rows"),
        "k6_small_insert": with_(
            VALID,
            "SELECT " + out("trip_id", "vendor_id", "pickup_datetime", "batch_id")
            + ", CAST(0 AS BIGINT) AS passenger_count, CAST(0 AS DOUBLE) AS total_amount,"
            " CAST(NULL AS VARCHAR) AS pickup_zone FROM valid_rows",
        ),
        "k7_drop_month": months("current_rows", "WHERE pickup_datetime >= TIMESTAMP '2012-01-01'"),
        "v6_split": with_(
            GATED,
            "SELECT CAST(write_seq AS BIGINT) AS write_seq, schema_error IS NULL AS passed,"
            " count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS key_sum FROM gated"
            " GROUP BY 1, 2",
        ),
        "n1_vendor": labelled(VENDOR),
        "n2_payment": labelled(PAYMENT),
        "n3_rate": labelled(RATE),
        "n4_passengers": labelled(PAX),
        "n5_flag": labelled(FLAG),
        "p1_parse_timestamp": "SELECT event_id, epoch_us(ts) AS plain,"
        " epoch_us(date_trunc('second', ts)) AS seconds,"
        " epoch_us(date_trunc('millisecond', ts)) AS millis, epoch_us(ts) AS iso,"
        " epoch_us(date_trunc('second', ts) - INTERVAL '2' HOUR) AS shifted,"
        " CAST(NULL AS BIGINT) AS word FROM events",
        "p2_strict_parse": "SELECT event_id, CASE WHEN event_type <> 'error' THEN "
        + text("ts")
        + " END AS parsed, CASE WHEN event_type = 'error' THEN"
        " 'Cannot parse ''timestamp'' value ''' || props || ''' as a datetime.' END AS error"
        " FROM events",
        "p3_truncate_format": f"SELECT event_id, {text(chr(100) + 'ate_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS hour,"
        " CAST(CAST(ts AS DATE) AS VARCHAR) AS day,"
        " CAST(year(ts) * 100 + month(ts) AS BIGINT) AS month,"
        f" {text('ts')} AS text FROM events",
        "p4_duration": with_(
            RAW,
            f"SELECT {IDS}, s AS seconds, s / 60.0::DOUBLE AS minutes, s / 3600.0::DOUBLE AS hours"
            " FROM (SELECT *, date_diff('second', pickup_datetime, dropoff_datetime) AS s FROM raw"
            " WHERE pickup_datetime IS NOT NULL)",
        ),
        "p5_money": with_(
            RAW,
            f"SELECT {IDS}, CAST(fare_amount AS DOUBLE) AS fare_amount,"
            " coalesce(TRY_CAST(extra AS DOUBLE), 0) AS extra,"
            " CAST(mta_tax AS DOUBLE) AS mta_tax, CAST(tip_amount AS DOUBLE) AS tip_amount,"
            " coalesce(CASE WHEN tolls_amount < 9999999 THEN tolls_amount END, 0) AS tolls_amount,"
            " CAST(0 AS DOUBLE) AS airport_fee FROM raw",
        ),
        "p6_distance": with_(
            RAW,
            "SELECT coalesce(trip_distance, 0) AS miles, count(*) AS rows FROM raw GROUP BY 1",
        ),
        "p7_trip_id": with_(
            judged(), f"SELECT {IDS}, full_id AS trip_id FROM judged"
            " WHERE pickup_datetime IS NOT NULL"
        ),
        "p8_field_hash": "SELECT o_orderkey, sha256(concat_ws('|', CAST(o_orderkey AS VARCHAR),"
        " CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE o_orderstatus END, o_orderpriority))"
        " AS digest, substr(sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderpriority,"
        " CAST(o_orderkey AS VARCHAR))), 1, 16) AS tag FROM orders",
        "p9_json_encode": "SELECT event_id, '{\"event_id\":' || event_id || ',\"ts\":\"'"
        " || strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN ''"
        " ELSE strftime(ts, '.%f') END || '+00:00\",\"user_id\":'"
        " || CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(user_id AS VARCHAR) END"
        " || ',\"event_type\":\"' || event_type || '\",\"value\":'"
        " || CAST(CAST(CAST(value AS DECIMAL(9,2)) AS DOUBLE) AS VARCHAR)"
        " || ',\"props\":\"' || lower(hex(encode(props))) || '\"}' AS json FROM events",
        "p10_json_lines": "SELECT event_type, count(*) AS lines FROM events GROUP BY 1",
        "j1_zone_lookup": with_(
            RAW + "," + ZONES,
            f"SELECT {IDS}, coalesce(pz.zone, 'Unknown') AS pickup_zone,"
            " coalesce(pz.borough, 'Unknown') AS pickup_borough,"
            " coalesce(dz.zone, 'Unknown') AS dropoff_zone,"
            " coalesce(dz.borough, 'Unknown') AS dropoff_borough FROM raw r"
            " LEFT JOIN zone_table pz ON pz.location_id = r.pickup_location_id"
            " LEFT JOIN zone_table dz ON dz.location_id = r.dropoff_location_id",
        ),
        "j2_zone_reload": with_(
            RAW + "," + ZONES,
            "SELECT CAST(write_seq AS BIGINT) AS write_seq, coalesce(zone || CASE WHEN"
            " write_seq = 2 THEN ' (new)' ELSE '' END, 'Unknown') AS pickup_zone,"
            " count(*) AS rows FROM raw LEFT JOIN zone_table ON location_id = pickup_location_id"
            " GROUP BY 1, 2",
        ),
        "j3_required_zone": with_(
            RAW + "," + ZONES,
            f"SELECT {IDS}, 'enrichment' AS stage, 'ZoneNotFoundError' AS error_type,"
            " 'Zone not found for location_id=' || CAST(CASE WHEN pz.location_id IS NULL THEN"
            " pickup_location_id ELSE dropoff_location_id END AS VARCHAR) || '.' AS error_message"
            " FROM raw r LEFT JOIN zone_table pz ON pz.location_id = r.pickup_location_id"
            " LEFT JOIN zone_table dz ON dz.location_id = r.dropoff_location_id"
            " WHERE pz.location_id IS NULL OR dz.location_id IS NULL",
        ),
        "r1_schema": rule("'schema'"),
        "r2_parse_time": rule("'parse_pickup'", gate=False),
        "r3_parse_location": rule("'parse_location'", gate=False),
        "r4_distance": rule("'distance'"),
        "r5_money": rule("'money'"),
        "r6_duration": rule("'duration'", gate=False),
        "r7_passengers": rule("'passengers'"),
        "r8_too_early": rule("'early'"),
        "r9_future": rule("'future'"),
        "r10_unexpected": rule("'infinite', 'range', 'nan'"),
        "r11_duplicate": rule("'duplicate'"),
        "r12_process_valid": with_(VALID, f"SELECT {out(*_TRIP, 'write_seq')} FROM valid_rows"),
        "r12_process_rejected": with_(errors(), f"SELECT {_ERR} FROM rejected"),
        "r13_each_record": with_(
            judged() + "," + ZONES,
            f"SELECT {IDS}, trip_id, coalesce(zone, 'Unknown') AS pickup_zone,"
            " CAST(total_amount AS DOUBLE) AS total_amount FROM ranked"
            " LEFT JOIN zone_table ON location_id = pickup_location_id"
            " WHERE first_failure = 'ok'",
        ),
        "r14_run_summary": with_(
            judged(),
            "SELECT *, round((total_invalid + total_schema_rejected) / total_rows::DOUBLE, 4)"
            " AS reject_rate, (total_invalid + total_schema_rejected) / total_rows::DOUBLE > 0.1"
            " AS warn FROM (SELECT 'lineitem.parquet' AS source_file,"
            " count(DISTINCT batch_id) AS total_batches, count(*) AS total_rows,"
            " count(*) FILTER (WHERE failure = 'ok') AS total_valid,"
            " count(*) FILTER (WHERE failure NOT IN ('ok', 'schema')) AS total_invalid,"
            " count(*) FILTER (WHERE failure = 'schema') AS total_schema_rejected FROM verdict)",
        ),
        "d1_keep_first": with_(
            RAW,
            f"SELECT {IDS}, batch_id, pickup_location_id > 0 AND row_number() OVER ("
            "PARTITION BY batch_id, l_linenumber, pickup_location_id > 0 ORDER BY "
            + ", ".join(ORDER)
            + ") > 1 AS repeat FROM raw",
        ),
        "l1_latest": with_(
            CURRENT,
            "SELECT "
            + out("pickup_datetime", "vendor_id", "trip_id", "ingested_at", "batch_id",
                  "total_amount")
            + " FROM current_rows",
        ),
        "l1_bucketed": with_(
            CURRENT,
            "SELECT "
            + out("pickup_datetime", "vendor_id", "trip_id", "ingested_at", "batch_id",
                  "total_amount")
            + " FROM current_rows",
        ),
        "l4_stream_latest": with_(CURRENT, f"SELECT {out(*_TRIP)} FROM current_rows"),
        "l3_sketch_count": with_(
            CURRENT,
            f"SELECT {_MONTH} AS month, count(*) AS trips, TRUE AS within_error FROM current_rows GROUP BY 1"
            " UNION ALL SELECT NULL, count(*), TRUE FROM current_rows",
        ),
        "h1_sketch_quantiles": with_(
            CURRENT,
            "SELECT year, trips, probability::DOUBLE AS probability, TRUE AS within_error FROM ("
            "SELECT CAST(year(pickup_datetime) AS BIGINT) AS year, count(*) AS trips FROM current_rows GROUP BY 1),"
            " (VALUES (0.25), (0.5), (0.75), (0.95), (0.99)) AS q(probability)",
        ),
        "r14_observed_run": with_(
            judged(),
            "SELECT 'lineitem.parquet' AS source_file, count(*) AS total_rows,"
            " count(*) FILTER (WHERE failure = 'ok') AS valid_rows,"
            " count(*) FILTER (WHERE failure NOT IN ('ok', 'schema')) AS invalid_rows,"
            " count(*) FILTER (WHERE failure = 'schema') AS schema_rejected_rows FROM verdict",
        ),
        "o5_stream_lag": with_(
            VALID,
            "SELECT CAST(0 AS BIGINT) AS partition, count(*) AS current_offset,"
            " count(*) FILTER (WHERE write_seq = 1) AS committed_offset,"
            " count(*) FILTER (WHERE write_seq = 2) AS lag FROM valid_rows",
        ),
        "o6_stream_rates": with_(
            VALID,
            "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS rejected FROM valid_rows WHERE write_seq = 1",
        ),
        "t1_bounded_flush": with_(
            VALID, "SELECT TRUE AS within_bound, TRUE AS several, count(*) AS messages FROM valid_rows"
        ),
        "a8_update_mode": rollup("valid_rows", _HOUR, ["vendor_id"], HOURLY, VALID),
        "l2_latest_count": with_(CURRENT, "SELECT count(*) AS trips FROM current_rows"),
        "l3_repeat_check": with_(
            VALID,
            "SELECT count(*) AS raw_rows, count(DISTINCT trip_id) AS distinct_trip_ids"
            " FROM valid_rows",
        ),
        "l4_stream_dedup": with_(VALID, "SELECT DISTINCT trip_id, vendor_id FROM valid_rows"),
        "q1_dead_letters": with_(
            errors(),
            "SELECT trip_id, error_message, error_type, stage, batch_id,"
            f" {text('l_shipdate')} AS failed_at, CAST(0 AS BIGINT) AS retry_count,"
            " CAST(vendor_id AS BIGINT) AS vendor_id,"
            " CAST(pickup_location_id AS BIGINT) AS pickup_location_id,"
            " CAST(payment_type AS BIGINT) AS payment_type,"
            " CAST(total_amount AS DOUBLE) AS total_amount FROM rejected",
        ),
        "q2_routing_key": with_(
            errors(),
            "SELECT coalesce(trip_id, batch_id) AS key, count(*) AS letters FROM rejected"
            " GROUP BY 1",
        ),
        "q3_replay_recovered": with_(
            _REPLAY
            + ","
            + ZONES
            + ", recovered AS (SELECT * REPLACE (full_id AS trip_id, 'replay' AS batch_id)"
            " FROM rejudged WHERE failure = 'ok'),"
            + valid_of("recovered"),
            "SELECT "
            + out(*[c for c in _TRIP if c not in ("ingested_at", "source_file")])
            + " FROM valid_rows",
        ),
        "q3_replay_generations": with_(
            _REPLAY,
            "SELECT CASE failure WHEN 'ok' THEN 'recovered' ELSE 'still invalid' END AS outcome,"
            " CASE WHEN failure <> 'ok' THEN 2 END AS retry_count, count(*) AS letters"
            " FROM rejudged GROUP BY 1, 2"
            " UNION ALL SELECT 'consumed load', 1, 1 UNION ALL SELECT 'consumed replay', 2, 1",
        ),
        "q4_replay_still_invalid": with_(
            _REPLAY + ", still AS (" + _RE_ERR,
            "SELECT trip_id, error_message, error_type, stage, batch_id,"
            f" {text('l_shipdate')} AS failed_at, CAST(1 AS BIGINT) AS retry_count FROM still",
        ),
        "q5_one_batch": with_(
            errors(),
            "SELECT trip_id, error_type, error_message, stage, batch_id FROM rejected"
            " WHERE batch_id = sha256('lineitem.parquet|3|1')",
        ),
        "q6_recovery_summary": with_(
            _REPLAY,
            "SELECT count(*) AS total_replayed, count(*) FILTER (WHERE failure = 'ok') AS"
            " recovered, count(*) FILTER (WHERE failure <> 'ok') AS still_invalid,"
            " count(*) FILTER (WHERE failure = 'ok') / count(*)::DOUBLE AS recovery_rate"
            " FROM rejudged",
        ),
        "q7_dry_run": with_(
            errors(), "SELECT batch_id, count(*) AS records FROM rejected GROUP BY 1"
        ),
        "q8_by_error": with_(
            errors(), "SELECT error_type, count(*) AS records FROM rejected GROUP BY 1"
        ),
        "q9_by_stage_over_time": with_(
            errors(),
            f"SELECT {text('l_shipdate')} AS window_start, stage, count(*) AS records"
            " FROM rejected GROUP BY 1, 2",
        ),
        "q10_exhausted": with_(
            replayed(NOW) + ", still AS (" + _RE_ERR,
            "SELECT error_type, CAST(3 AS BIGINT) AS retry_count, count(*) AS letters FROM still"
            " GROUP BY 1",
        ),
        "q11_replay_topic": with_(
            replayed(_LATER),
            "SELECT CASE WHEN failure = 'ok' THEN 'recovered' ELSE 'still_invalid' END AS outcome,"
            " count(*) AS letters FROM rejudged GROUP BY 1",
        ),
        "a1_hourly": A1,
        "a2_daily": A2,
        "a3_borough": A3,
        "a4_payment": A4,
        "a5_zone": A5,
        "a6_state_merge": rollup("valid_rows", _HOUR, ["vendor_id"], HOURLY, VALID),
        "a7_incremental": A2,
        "a8_stream_rollup": "SELECT "
        + text("hour")
        + " AS hour, vendor_id, n, sum_total_amount, n * 0.25::DOUBLE AS sum_trip_distance,"
        " sum_trip_duration_seconds, n AS sum_passenger_count FROM (SELECT date_trunc('hour', ts) AS hour,"
        " event_type AS vendor_id, count(*) AS n,"
        " CAST(sum(CAST(value AS DECIMAL(9,2))) AS DOUBLE) AS sum_total_amount,"
        " CAST(sum(user_id) AS BIGINT) AS sum_trip_duration_seconds FROM events GROUP BY 1, 2)"
        " WHERE hour + INTERVAL '1' HOUR <= (SELECT max(ts) FROM events) - INTERVAL '2' HOUR",
        "m1_hourly_volume": with_(
            CURRENT,
            f"SELECT {text(_HOUR)} AS hour, count(*) AS trips,"
            " CAST(sum(total_amount) AS DOUBLE) AS revenue,"
            f" {mean('total_amount')} AS avg_fare, {mean('trip_distance')} AS avg_distance_miles,"
            f" {mean('trip_duration_seconds')} / 60 AS avg_duration_minutes FROM current_rows"
            f" WHERE {_HOUR} >= {AS_OF} - INTERVAL '24' HOUR GROUP BY 1",
        ),
        "m2_daily_summary": with_(
            CURRENT,
            f"SELECT CAST({_DAY} AS VARCHAR) AS day, count(*) AS trips,"
            " CAST(sum(total_amount) AS DOUBLE) AS revenue,"
            f" {mean('total_amount')} AS avg_fare, {mean('tip_amount')} AS avg_tip,"
            f" {mean('trip_distance')} AS avg_distance_miles FROM current_rows"
            f" WHERE {_DAY} >= {TODAY} - 30 GROUP BY 1",
        ),
        "m3_borough_breakdown": with_(
            CURRENT,
            "SELECT pickup_borough, count(*) AS trips,"
            " CAST(sum(total_amount) AS DOUBLE) AS revenue,"
            f" {mean('total_amount')} AS avg_fare, {mean('trip_distance')} AS avg_distance_miles"
            f" FROM current_rows WHERE {_DAY} = {TODAY} GROUP BY 1",
        ),
        "m4_borough_flow": with_(
            CURRENT,
            "SELECT pickup_borough, dropoff_borough, count(*) AS trips FROM current_rows"
            f" WHERE {_DAY} = {TODAY} GROUP BY 1, 2 ORDER BY trips DESC, 1, 2 LIMIT 20",
        ),
        "m5_payment_mix": with_(
            CURRENT,
            "SELECT payment_type, trips, round(CAST(trips AS DOUBLE) * 100.0::DOUBLE"
            " / CAST(sum(trips) OVER () AS DOUBLE), 2) AS pct, avg_tip FROM ("
            f"SELECT payment_type, count(*) AS trips, {mean('tip_amount')} AS avg_tip"
            f" FROM current_rows WHERE {_DAY} >= {TODAY} - 7 GROUP BY 1)",
        ),
        "m6_top_zones": with_(
            CURRENT,
            f"SELECT pickup_zone, pickup_borough, count(*) AS trips, {mean('total_amount')} AS"
            f" avg_fare FROM current_rows WHERE {_DAY} = {TODAY} GROUP BY 1, 2"
            " ORDER BY trips DESC, 1, 2 LIMIT 20",
        ),
        "o1_partition_rows": with_(
            VALID,
            f"SELECT {_MONTH} AS pickup_month, count(*) AS rows FROM valid_rows GROUP BY 1",
        ),
        "o1_partition_sizes": with_(
            VALID,
            'SELECT m AS "partition", '
            + readable("n", 1000, _QUANTITIES)
            + f" AS row_count, TRUE AS has_size FROM (SELECT {_MONTH} AS m, count(*) AS n"
            " FROM valid_rows GROUP BY 1)",
        ),
        "o2_readable": "SELECT o_orderkey, "
        + readable("n", 1000, _QUANTITIES)
        + " AS quantity, "
        + readable("n", 1024, _SIZES)
        + " AS size FROM (SELECT o_orderkey, o_orderkey * o_custkey * 4096 AS n FROM orders)",
        "o3_recent_batches": with_(
            VALID,
            "SELECT source_file, batch_id, rows, "
            + ", ".join(
                f"{text(c)} AS {c}" for c in ("earliest_pickup", "latest_pickup", "ingested_at")
            )
            + " FROM (SELECT source_file, batch_id, count(*) AS rows,"
            " min(pickup_datetime) AS earliest_pickup, max(pickup_datetime) AS latest_pickup,"
            " min(v.ingested_at) AS ingested_at FROM valid_rows v"
            " WHERE v.ingested_at >= TIMESTAMP '2014-09-29 21:00:00' GROUP BY 1, 2"
            " ORDER BY min(v.ingested_at) DESC, 1, 2 LIMIT 50)",
        ),
        "o4_batch_rows": with_(
            CURRENT,
            "SELECT " + out("trip_id", "batch_id", "ingested_at") + " FROM current_rows c"
            " WHERE c.batch_id = sha256('lineitem.parquet|3|1')",
        ),
        "o5_partition_lag": with_(
            _OFFSETS,
            'SELECT topic, "partition", current_offset, committed_offset, lag FROM lags',
        ),
        "o5_total_lag": with_(
            _OFFSETS,
            "SELECT topic, CAST(sum(lag) AS BIGINT) AS total_lag, sum(lag) > 10000 AS"
            " over_threshold FROM lags GROUP BY 1",
        ),
        "o6_throughput": with_(
            _EVENT_RUNS,
            "SELECT "
            + text("date_trunc('minute', ended_at)")
            + " AS window_start, sum(size) / 60.0::DOUBLE AS valid_per_second,"
            " sum(bad + refused) / 60.0::DOUBLE AS invalid_per_second,"
            " sum(stored) / 60.0::DOUBLE AS persisted_per_second FROM runs GROUP BY 1",
        ),
        "o7_latency": with_(
            _EVENT_RUNS,
            f"SELECT window_start, {bucket_quantile(0.5)} AS p50, {bucket_quantile(0.95)} AS p95,"
            f" {bucket_quantile(0.99)} AS p99, CAST(m AS DOUBLE) / 1000000 / n AS mean_seconds,"
            " n / 86400.0::DOUBLE AS batches_per_second FROM (SELECT "
            + text("date_trunc('day', ended_at)")
            + " AS window_start, count(*) AS n, sum(micros) AS m, "
            + ", ".join(
                f"count(*) FILTER (WHERE micros / 1000000.0::DOUBLE <= {b}) AS le_{i}"
                for i, b in enumerate(_DUR)
            )
            + " FROM runs GROUP BY 1)",
        ),
        "o8_duration_histogram": histogram(
            "micros / 1000000.0::DOUBLE",
            _DUR,
            ", round(CAST(sum(micros) AS DOUBLE) / 1000000, 3) AS value_sum",
        ),
        "o8_size_histogram": histogram(
            "(size + bad + refused)",
            [50, 100, 250, 500, 1000, 2500, 5000],
            ", CAST(sum(size + bad + refused) AS BIGINT) AS value_sum",
        ),
        "o9_run_summary": with_(
            _EVENT_RUNS,
            "SELECT *, round((total_invalid + total_schema_rejected) / total_rows::DOUBLE, 4)"
            " AS reject_rate FROM (SELECT source_file, count(*) AS total_batches,"
            " CAST(sum(size + bad + refused) AS BIGINT) AS total_rows,"
            " CAST(sum(size) AS BIGINT) AS total_valid, CAST(sum(bad) AS BIGINT) AS total_invalid,"
            " CAST(sum(refused) AS BIGINT) AS total_schema_rejected,"
            + text("min(ended_at - micros * INTERVAL '1' MICROSECOND)")
            + " AS started_at, "
            + text("max(ended_at)")
            + " AS finished_at FROM runs GROUP BY 1)",
        ),
        "h1_fare_distribution": with_(
            CURRENT,
            "SELECT "
            + ", ".join(
                f"round(quantile_cont(CAST(total_amount AS DOUBLE), {q}), 6) AS q{round(q * 100):02d}"
                for q in (0.25, 0.5, 0.75, 0.95, 0.99)
            )
            + ", CAST(min(total_amount) AS DOUBLE) AS min_fare,"
            f" CAST(max(total_amount) AS DOUBLE) AS max_fare, {mean('total_amount')} AS avg_fare"
            f" FROM current_rows WHERE {_DAY} = {TODAY}",
        ),
        "h2_distance_distribution": with_(
            CURRENT,
            "SELECT CASE WHEN trip_distance < 1 THEN '< 1 mile' WHEN trip_distance < 3 THEN"
            " '1-3 miles' WHEN trip_distance < 5 THEN '3-5 miles' WHEN trip_distance < 10 THEN"
            " '5-10 miles' ELSE '>= 10 miles' END AS distance_bucket, count(*) AS trips,"
            f" {mean('total_amount')} AS avg_fare FROM current_rows WHERE {_DAY} = {TODAY}"
            " GROUP BY 1",
        ),
        "h3_peak_hours": with_(
            CURRENT,
            "SELECT CAST(hour(pickup_datetime) AS BIGINT) AS hour_of_day, count(*) AS trips,"
            f" {mean('total_amount')} AS avg_fare, {mean('trip_duration_seconds')} / 60 AS"
            f" avg_duration_minutes FROM current_rows WHERE {_DAY} BETWEEN {TODAY} - 7 AND {TODAY}"
            " GROUP BY 1",
        ),
        "h4_vendor_comparison": with_(
            CURRENT,
            f"SELECT vendor_id, count(*) AS trips, {mean('total_amount')} AS avg_fare,"
            f" {mean('tip_amount')} AS avg_tip, {mean('trip_distance')} AS avg_distance,"
            f" {mean('trip_duration_seconds')} / 60 AS avg_duration_minutes FROM current_rows"
            f" WHERE {_MONTH} = 201206 GROUP BY 1",
        ),
        "t1_micro_batches": "SELECT *, TRUE AS several_batches FROM ("
        + months("current_rows")
        + ")",
        "t2_kept_messages": "SELECT coalesce("
        + _UNUSABLE
        + ", 'stored') AS outcome, count(*) AS messages FROM events GROUP BY 1",
        "k8_interrupted_fold": "SELECT * FROM ("
        + A2
        + "), (VALUES (FALSE), (TRUE)) AS f(folded)",
        "t2_stream_ingest": A4,
        "t3_stream_produce": with_(
            errors(),
            "SELECT error_type, count(*) AS rows FROM rejected WHERE failure <> 'duplicate'"
            " GROUP BY 1 UNION ALL SELECT 'none', count(DISTINCT trip_id) FROM verdict"
            " WHERE first_failure = 'ok'",
        ),
        "t4_redelivery": A5,
        "t5_drain": with_(
            VALID,
            "SELECT CAST(write_seq AS BIGINT) AS write_seq, count(*) AS rows FROM valid_rows"
            " GROUP BY 1",
        ),
        "t6_late_data": A1,
    }
    for name, like in {
        "v1_required_fields": "schema_error LIKE '%valid datetime%'"
        " OR schema_error LIKE '%valid integer%'",
        "v2_optional_types": "schema_error LIKE '%extra: %'",
        "v3_location_positive": "schema_error LIKE '%must be positive%'",
        "v4_dropoff_order": "schema_error LIKE '%must be after%'",
        "v5_all_errors": "schema_error IS NOT NULL",
    }.items():
        sql[name] = with_(GATED, f"SELECT {IDS}, schema_error FROM gated WHERE {like}")
    return sql
