"""Every operator as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline import workload
from tripline.functions import codes, encode, identity, times, values
from tripline.operators import dedup, enrich, gate, rollup, staging
from tripline.plans import adhoc, dashboard, deadletters, generations, ingest, operations
from tripline.schema import MESSAGES, RAW_COLUMNS, TRIPS, raw_types
from tripline.session import prepare
from tripline.sinks import bucketed, sketches
from tripline.sinks import deadletters as letter_sink
from tripline.sinks import messages as message_sink
from tripline.sinks.tables import FactTable, RollupTables, touched_days
from tripline.sources import messages, rejects, trips, zones
from tripline.streaming import jobs, progress
from tripline.workload import AS_OF, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return portable(fn(prepare(spark), sf_dir.rstrip("/")))

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return register


def portable(df: DataFrame) -> DataFrame:
    """Column types any engine's client shows alike."""

    def plain(f: T.StructField) -> Column:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ShortType, T.IntegerType)):
            return col.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return col.cast("string").alias(f.name)
        return col

    return df.select(*[plain(f) for f in df.schema])


def now() -> Column:
    return F.lit(str(workload.NOW)).cast("timestamp")


def processed(
    spark: SparkSession, sf_dir: str, by_time: bool = False, by_folder: bool = False, **options
) -> ingest.Processed:
    options = {
        "now": now(),
        "ingested_at": F.col("sent_at"),
        "keep": ("write_seq",),
        "dealt": (workload.MINUTE,) if by_time else (workload.FOLDER,) if by_folder else (),
        **options,
    }
    return ingest.process(
        workload.raw_rides(spark, sf_dir, by_time, by_folder), workload.zones(spark, sf_dir), **options
    )


IDS = ("l_orderkey", "l_linenumber", "l_partkey", "write_seq")


def rejections(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    done = processed(spark, sf_dir, keep=IDS, **options)
    return done.rejected.select(
        *IDS, "batch_id", "trip_id", "stage", "error_type", "error_message"
    )


# -- derived data, written once per application ----------------------------

_derived: dict[tuple[str, str, str], object] = {}


def once(make):
    """Derive something from the tables of a folder the first time it is asked for."""

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
        if key not in _derived:
            _derived[key] = make(spark, sf_dir)
        return _derived[key]

    return get


@once
def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    with staging.Scratch(spark):  # the shuffle of the lines goes with it, before others are written
        return staging.stage(processed(spark, sf_dir).valid, "valid")


def fresh_letters(spark: SparkSession, sf_dir: str, by_folder: bool = False) -> DataFrame:
    """Dead letters as they come, for queries that read them once: nothing is written."""
    done = processed(spark, sf_dir, by_folder=by_folder, keep=("write_seq", "row_order"))
    failed_at = F.col("row_order.l_shipdate").cast("timestamp")
    return deadletters.dead_letters(done.rejected, failed_at)


@once
def letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deadletters.stage_letters(fresh_letters(spark, sf_dir, by_folder=True))


@dataclass(frozen=True)
class Store:
    facts: FactTable
    rollups: RollupTables


@once
def stored_facts(spark: SparkSession, sf_dir: str) -> FactTable:
    """Fact table of both deliveries."""
    return filled_facts(spark, sf_dir)


@once
def stored_rollups(spark: SparkSession, sf_dir: str) -> RollupTables:
    """Its rollups, for the reports that read them."""
    facts = stored_facts(spark, sf_dir)
    rollups = RollupTables(spark, staging.new_folder(spark, "rollups"))
    rollups.refresh(facts, touched_days(facts.versions()))
    return rollups


def store(spark: SparkSession, sf_dir: str) -> Store:
    """Fact table of both deliveries and its rollups."""
    return Store(stored_facts(spark, sf_dir), stored_rollups(spark, sf_dir))


def filled_facts(spark: SparkSession, sf_dir: str) -> FactTable:
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    with staging.Scratch(spark):  # the lines are dealt by time and move no more
        facts.load(processed(spark, sf_dir, by_time=True).valid, "load")
    return facts


@once
def source_path(spark: SparkSession, sf_dir: str) -> str:
    """Ride records in a Parquet folder under the source's own column names."""
    path = staging.new_folder(spark, "source")
    workload.source_rides(spark, sf_dir).write.parquet(path)
    return path


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinity as null: clients show them differently."""

    def fix(f: T.StructField) -> Column:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            return F.when(F.abs(col) < float("inf"), col).alias(f.name)
        return col

    return df.select(*[fix(f) for f in df.schema])


# -- sources ---------------------------------------------------------------


@query("s1_trip_scan")
def _(spark, sf_dir):
    rows = trips.read_trips(spark, source_path(spark, sf_dir))
    return finite(rows.select(*RAW_COLUMNS))


@query("s2_column_pruning")
def _(spark, sf_dir):
    rows = trips.read_trips(spark, source_path(spark, sf_dir)).select(*RAW_COLUMNS)
    return rows.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in RAW_COLUMNS])


@query("s3_rename")
def _(spark, sf_dir):
    rows = trips.read_trips(spark, source_path(spark, sf_dir))
    renamed = ["vendor_id", "pickup_location_id", "dropoff_location_id"]
    return rows.groupBy(*renamed).agg(
        F.count("*").alias("rows"),
        F.min("pickup_datetime").alias("pickup_datetime"),
        F.max("dropoff_datetime").alias("dropoff_datetime"),
        F.count("rate_code_id").alias("rate_code_id"),
    )


@query("s4_provenance")
def _(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = F.col("_metadata.file_path")
    tagged = lines.select("l_orderkey", *trips.provenance(), path.alias("path"))
    batches = tagged.groupBy("source_file", "batch_id", "path").agg(
        F.count("*").alias("rows"), F.min("row_order").alias("first_row")
    )
    # the id depends on where the file lies: what it is made from is told instead
    made_from = F.concat_ws("|", "path", (F.col("first_row") / 1000).cast("bigint"))
    known = F.col("batch_id") == F.sha2(made_from, 256)
    return batches.select("source_file", "rows", "first_row", known.alias("id_known"))


@query("s5_zone_scan")
def _(spark, sf_dir):
    path = staging.new_folder(spark, "zones")
    wanted = workload.zone_rows(spark, sf_dir)

    def line(key: Column, borough: Column) -> Column:
        return F.struct(
            key.alias("LocationID"),
            borough.alias("Borough"),
            F.concat(F.lit("  "), F.col("zone"), F.lit(" ")).alias("Zone"),
            F.col("service_zone"),
        )

    key = F.col("location_id").cast("string")
    lines = F.array(
        line(key, F.lit("superseded")),
        line(F.concat(F.lit("x"), key), F.col("borough")),
        line(F.concat(F.lit(" "), key), F.col("borough")),
    )
    (
        wanted.select(F.explode(lines).alias("l"))
        .select("l.*")
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return zones.read_zones(spark, path)


@once
def message_folder(spark: SparkSession, sf_dir: str) -> str:
    path = staging.new_folder(spark, "messages")
    valid = valid_trips(spark, sf_dir)
    for number in (1, 2):
        part = valid.filter(F.col("write_seq") == number)
        message_sink.publish(message_sink.trip_messages(part), path, number, "load")
    return path


def drain(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to its present end and read what it wrote."""
    out = staging.new_folder(spark, name)
    run = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", out + "-offsets")
        .trigger(availableNow=True)
        .start(out)
    )
    run.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("s6_message_stream")
def _(spark, sf_dir):
    folder = message_folder(spark, sf_dir)
    stream = messages.message_stream(spark, folder)
    rows = drain(spark, jobs.trip_stream(stream), "arrived")
    return rows.select("trip_id", "vendor_id", "pickup_datetime", "total_amount", "batch_id")


def odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of every form: one for each event, its kind saying what is odd about it."""
    kind, number = F.col("event_type"), F.col("event_id")
    count = F.when(number % 3 == 0, F.lit('"2"')).when(number % 3 == 1, F.lit("2.0")).otherwise("null")
    head = F.concat(F.lit('{"trip_id":"t'), number.cast("string"), F.lit('","payment_type":"Odd",'))
    pickup = F.lit('"pickup_datetime":"2014-01-02T03:04:05+00:00"')
    whole = F.concat(head, pickup, F.lit(',"total_amount":"12.5","passenger_count":'), count, F.lit("}"))
    text = (
        F.when(kind == "click", whole)
        .when(kind == "view", F.concat(F.lit("["), whole, F.lit("]")))
        .when(kind == "error", F.concat(head, pickup, F.lit(',"total_amount":100000000.0}')))
        .when(kind == "purchase", F.concat(F.lit('{"vendor_id":"v",'), pickup, F.lit("}")))
    )
    value = F.when(kind == "signup", F.unhex(F.lit("FFFE7B7D"))).otherwise(text.cast("binary"))
    return table(spark, sf_dir, "events").select("event_id", value.alias("value"))


@query("s7_json_decode")
def _(spark, sf_dir):
    """Every message sorted into usable and not, with the reason; none is lost."""
    decoded = messages.decode(odd_messages(spark, sf_dir), messages.TRIP_WIRE)
    judged = messages.sorted_trips(decoded, now())
    usable = F.col("unusable").isNull()
    return judged.select(
        "event_id",
        "malformed",
        F.substring_index("unusable", ":", 1).alias("unusable"),
        F.when(usable, F.col("trip.passenger_count")).alias("passenger_count"),
        F.when(usable, F.col("trip.total_amount")).alias("total_amount"),
    )


@query("s8_rejected_scan")
def _(spark, sf_dir):
    folder = staging.new_folder(spark, "rejected")
    with staging.Scratch(spark):  # the lines are dealt by folder, the letters move no more
        letter_sink.write_files(fresh_letters(spark, sf_dir, by_folder=True), folder, 1, "load", moved=False)
    found, _bad = rejects.read_rejects(spark, folder, whole=True)
    return found.drop("original_record")


@query("s8_broken_files")
def _(spark, sf_dir):
    """Reject files, some of them cut short or no gzip at all: all other letters, and the broken files."""
    folder = staging.new_folder(spark, "rejected")
    letter_sink.write_files(letters(spark, sf_dir), folder, 1, "load")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    spoil(spark, files.select("path", F.expr("substring(content, 1, 20)").alias("head")), "cut")
    spoil(spark, files.select("path", F.expr("substring(content, 30, 40)").alias("head")), "odd")
    found, _bad = rejects.read_rejects(spark, folder)
    kinds = found.select(F.lit("letter").alias("kind"), "error_type")
    broken = rejects.broken_files(spark, folder)
    name = F.regexp_extract("file", "([a-z]+)-[^/]*$", 1)
    broken = broken.select(
        F.concat(F.lit("file "), name).alias("kind"), F.regexp_extract("reason", "^[a-z ]+[a-z]", 0).alias("error_type")
    )
    both = kinds.unionByName(broken).groupBy("kind", "error_type").agg(F.count("*").alias("rows"))
    # how many files there are depends on the writer: told is whether all that were spoilt are listed
    return both.withColumn("rows", F.when(F.col("kind") == "letter", F.col("rows")).otherwise(
        F.col("rows") - F.lit(files.filter("path not like '%/cut-%' and path not like '%/odd-%'").count())
    ))


def spoil(spark: SparkSession, heads: DataFrame, name: str) -> None:
    """Put a broken file beside each of the given ones: a few of its bytes, one file a folder."""
    for row in heads.collect():
        folder, own = row.path.rsplit("/", 1)
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-{own}")
        out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
        out.write(bytearray(row.head))
        out.close()


@query("s9_table_scan")
def _(spark, sf_dir):
    return stored_facts(spark, sf_dir).current().select(*TRIPS.names)


# -- sinks -----------------------------------------------------------------


@query("k1_publish_messages")
def _(spark, sf_dir):
    folder = staging.new_folder(spark, "messages")
    with staging.Scratch(spark):  # both deliveries in the pass that makes the trips
        trips_of = processed(spark, sf_dir, by_time=True).valid
        message_sink.publish_all(message_sink.trip_messages(trips_of, "write_seq"), folder, "load", "write_seq")
    sent = spark.read.schema(MESSAGES).parquet(folder)
    text = F.col("value").cast("string")
    fields = ["vendor_id", "pickup_datetime", "passenger_count", "pickup_zone", "total_amount"]
    return sent.select(
        "key", *[F.get_json_object(text, f"$.{name}").alias(name) for name in fields]
    ).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "total_amount": F.col("total_amount").cast("double"),
        }
    )


@query("k2_fact_insert")
def _(spark, sf_dir):
    return filled_facts(spark, sf_dir).versions().select(*TRIPS.names, "pickup_month")


@query("k3_upsert")
def _(spark, sf_dir):
    facts = filled_facts(spark, sf_dir)
    # the second delivery comes again, then months are merged
    again = staging.stage(facts.versions().filter("write_seq = 2").select(*TRIPS.names), "again")
    facts.append(again, 2, "load")
    facts.compact([m for m in facts.months() if m < 201200])
    return facts.current().select(*TRIPS.names)


def delivered(ready: DataFrame, topic: str | None, folder: str | None, number: int) -> None:
    """Send letters; what did not reach every destination is an error, not a smaller result."""
    failed = letter_sink.send(ready, topic, folder, number, "load", moved=False)  # staged by folder
    if failed:
        raise RuntimeError(f"dead letters did not reach: {', '.join(failed)}")


@query("k4_dead_letter_write")
def _(spark, sf_dir):
    ready = letters(spark, sf_dir)
    topic, folder = staging.new_folder(spark, "dlq"), staging.new_folder(spark, "rejected")
    for number in (1, 2, 2):  # two deliveries, one of them twice: both count once
        delivered(ready, topic, folder, number)
    from_files, _bad = rejects.read_rejects(spark, folder, whole=True)
    sent = spark.read.parquet(topic).select("key", "value")
    from_topic = messages.dead_letter_rows(messages.decode(sent, messages.DEAD_LETTER_WIRE))
    both = from_files.withColumn("destination", F.lit("files")).unionByName(
        from_topic.withColumn("destination", F.lit("topic"))
    )
    return both.groupBy("destination", "stage", "error_type").agg(
        F.count("*").alias("letters"), F.count("trip_id").alias("with_trip_id")
    )


def month_totals(facts: FactTable) -> DataFrame:
    return facts.current().groupBy("pickup_month").agg(
        F.count("*").alias("trips"), F.sum("total_amount").alias("revenue")
    )


@query("k8_interrupted_fold")
def _(spark, sf_dir):
    """Rollups while merged months and their deliveries lie side by side, and merged again."""
    facts = filled_facts(spark, sf_dir)
    tables = RollupTables(spark, staging.new_folder(spark, "rollups"))
    days = touched_days(facts.versions())
    # the write of a compact that stopped half-way: some months merged, no delivery deleted
    merged = facts.current().filter("pickup_month % 2 = 0")
    with staging.Scratch(spark) as scratch:
        facts.merged.write(staging.stage(merged, "half-merged", scratch), dedup.TRIP_KEY)
    half = rollup.build(facts.current(), rollup.DAILY)
    half = rollup.finish(half, rollup.DAILY).withColumn("folded", F.lit(False))
    staged = staging.stage(half, "half-folded")
    facts.compact()
    tables.refresh(facts, days, [rollup.DAILY])
    whole = rollup.finish(tables.read(rollup.DAILY), rollup.DAILY).withColumn("folded", F.lit(True))
    return staged.unionByName(whole)


def consumed(
    spark: SparkSession,
    sf_dir: str,
    twice: bool = False,
    per_trigger: int = 64,
    folder: str | None = None,
    unusable: str | None = None,
    batches: list[int] | None = None,
    facts_only: bool = False,
):
    """Message files through the consuming stream into fresh tables."""
    folder = folder or message_folder(spark, sf_dir)
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    rollups = RollupTables(spark, staging.new_folder(spark, "rollups"))
    stream = messages.message_stream(spark, folder, maxFilesPerTrigger=str(per_trigger))
    each = jobs.consume(facts, None if facts_only else rollups, "consumer", unusable, now=now())

    def taken(batch: DataFrame, number: int) -> None:
        if batches is not None:
            batches.append(number)
        each(batch, number)
        if twice:
            each(batch, number)

    run = jobs.start(stream, taken, staging.new_folder(spark, "offsets"), drain=True)
    run.awaitTermination()
    return facts, rollups


@query("k5_deliver_then_commit")
def _(spark, sf_dir):
    facts, _rollups = consumed(spark, sf_dir, twice=True, facts_only=True)
    return month_totals(facts)


@query("k6_small_insert")
def _(spark, sf_dir):
    """Rows that carry only part of the fields: the rest takes its insert default."""
    valid = valid_trips(spark, sf_dir)
    part = ["trip_id", "vendor_id", "pickup_datetime", "batch_id"]
    text = F.to_json(F.struct(*part)).cast("binary")
    decoded = messages.decode(valid.select(text.alias("value")), messages.TRIP_WIRE)
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    facts.append(messages.trip_rows(decoded), 1, "small")
    return facts.versions().select(*part, "passenger_count", "total_amount", "pickup_zone")


@query("k7_drop_month")
def _(spark, sf_dir):
    facts = filled_facts(spark, sf_dir)
    facts.drop_months(before=201201)
    return month_totals(facts)


# -- schema gate -----------------------------------------------------------


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.gate(workload.raw_rides(spark, sf_dir)).select(*IDS, "schema_error")


@query("v1_required_fields")
def _(spark, sf_dir):
    return gated(spark, sf_dir).filter(
        "schema_error LIKE '%valid datetime%' OR schema_error LIKE '%valid integer%'"
    )


@query("v2_optional_types")
def _(spark, sf_dir):
    return gated(spark, sf_dir).filter("schema_error LIKE '%extra: %'")


@query("v3_location_positive")
def _(spark, sf_dir):
    return gated(spark, sf_dir).filter("schema_error LIKE '%must be positive%'")


@query("v4_dropoff_order")
def _(spark, sf_dir):
    return gated(spark, sf_dir).filter("schema_error LIKE '%must be after%'")


@query("v5_all_errors")
def _(spark, sf_dir):
    return gated(spark, sf_dir).filter("schema_error IS NOT NULL")


@query("v6_split")
def _(spark, sf_dir):
    passing, failing = gate.split(workload.raw_rides(spark, sf_dir))
    marked = passing.select(*IDS, F.lit(True).alias("passed")).unionByName(
        failing.select(*IDS, F.lit(False).alias("passed"))
    )
    return marked.groupBy("write_seq", "passed").agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("key_sum")
    )


# -- labels, parsing, identity --------------------------------------------


def labelled(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    raw = workload.raw_rides(spark, sf_dir)
    dtype = raw_types(raw)[name]
    return raw.groupBy(make(F.col(name), dtype).alias("label")).agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("key_sum")
    )


@query("n1_vendor")
def _(spark, sf_dir):
    return labelled(spark, sf_dir, "vendor_id", codes.vendor_label)


@query("n2_payment")
def _(spark, sf_dir):
    return labelled(spark, sf_dir, "payment_type", codes.payment_label)


@query("n3_rate")
def _(spark, sf_dir):
    return labelled(spark, sf_dir, "rate_code_id", codes.rate_label)


@query("n4_passengers")
def _(spark, sf_dir):
    return labelled(spark, sf_dir, "passenger_count", codes.passengers)


@query("n5_flag")
def _(spark, sf_dir):
    return labelled(spark, sf_dir, "store_and_fwd_flag", lambda c, _t: codes.flag_label(c))


@query("p1_parse_timestamp")
def _(spark, sf_dir):
    """One instant in four forms, and text that is none."""
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    second = F.unix_seconds("at")
    forms = events.select(
        "event_id",
        F.col("ts").alias("plain"),
        second.alias("seconds"),
        F.unix_millis("at").alias("millis"),
        times.iso_text(F.col("at")).alias("iso"),
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss'+02:00'").alias("shifted"),
        F.col("event_type").alias("word"),
    )
    parsed = {
        f.name: F.unix_micros(times.parse_timestamp(F.col(f.name), f.dataType)).alias(f.name)
        for f in forms.schema
        if f.name != "event_id"
    }
    return forms.select("event_id", *parsed.values())


@query("p2_strict_parse")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    )
    judged = times.strict_timestamp(F.col("raw"), T.StringType())
    return events.select("event_id", raw.alias("raw")).select("event_id", judged.alias("j")).select("event_id", "j.*")


@query("p3_truncate_format")
def _(spark, sf_dir):
    at = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        times.hour_of(at).alias("hour"),
        times.day_of(at).alias("day"),
        times.month_of(at).alias("month"),
        times.table_text(at).alias("text"),
    )


@query("p4_duration")
def _(spark, sf_dir):
    seconds = times.duration_seconds(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    rides = workload.raw_rides(spark, sf_dir).filter("pickup_datetime IS NOT NULL")
    return rides.select(*IDS, seconds.alias("seconds")).withColumns(
        {"minutes": times.minutes(F.col("seconds")), "hours": times.hours(F.col("seconds"))}
    )


@query("p5_money")
def _(spark, sf_dir):
    raw = workload.raw_rides(spark, sf_dir)
    held = raw_types(raw)
    names = ["fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "airport_fee"]
    return raw.select(*IDS, *[values.money(F.col(n), held[n]).alias(n) for n in names])


@query("p6_distance")
def _(spark, sf_dir):
    raw = workload.raw_rides(spark, sf_dir)
    miles = values.distance(F.col("trip_distance"), raw_types(raw)["trip_distance"])
    return raw.groupBy(miles.alias("miles")).agg(F.count("*").alias("rows"))


@query("p7_trip_id")
def _(spark, sf_dir):
    raw = workload.raw_rides(spark, sf_dir).filter("pickup_datetime IS NOT NULL")
    return raw.select(*IDS, ingest.identify(raw).alias("trip_id"))


@query("p8_field_hash")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return orders.select(
        "o_orderkey",
        identity.hash_fields(F.col("o_orderkey"), state, F.col("o_orderpriority")).alias("digest"),
        identity.batch_hash(
            F.col("o_custkey"), F.col("o_orderpriority"), F.col("o_orderkey")
        ).alias("tag"),
    )


def event_json_fields() -> list[Column]:
    return [
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
        F.col("event_type"),
        F.col("value").cast("decimal(9,2)").alias("value"),
        F.col("props").cast("binary").alias("props"),
    ]


@query("p9_json_encode")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(*event_json_fields())
    return events.select("event_id", encode.json_text(list(events.schema)).alias("json"))


@query("p10_json_lines")
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(*event_json_fields())
    path = staging.new_folder(spark, "jsonl")
    encode.json_lines(events).write.option("compression", "gzip").text(path)
    lines = spark.read.text(path)
    return lines.select(F.get_json_object("value", "$.event_type").alias("event_type")).groupBy(
        "event_type"
    ).agg(F.count("*").alias("lines"))


# -- lookup ----------------------------------------------------------------


@query("j1_zone_lookup")
def _(spark, sf_dir):
    raw = workload.raw_rides(spark, sf_dir)
    with_zones = enrich.add_zones(raw, workload.zones(spark, sf_dir))
    return with_zones.select(
        *IDS, "pickup_zone", "pickup_borough", "dropoff_zone", "dropoff_borough"
    )


@query("j2_zone_reload")
def _(spark, sf_dir):
    """Each delivery sees the zone table as it is then: the second finds new names."""
    raw = workload.raw_rides(spark, sf_dir)
    before = workload.zones(spark, sf_dir)
    renamed = before.df.withColumn("zone", F.concat("zone", F.lit(" (new)")))
    after = zones.zone_dimension(renamed)
    parts = [
        enrich.add_zones(raw.filter(F.col("write_seq") == number), dim)
        for number, dim in ((1, before), (2, after))
    ]
    both = parts[0].unionByName(parts[1])
    return both.groupBy("write_seq", "pickup_zone").agg(F.count("*").alias("rows"))


@query("j3_required_zone")
def _(spark, sf_dir):
    raw = workload.raw_rides(spark, sf_dir)
    missing = enrich.without_zone(raw, workload.zones(spark, sf_dir))
    return missing.select(*IDS, "stage", "error_type", "error_message")


# -- rules -----------------------------------------------------------------

RULE_FILTERS = {
    "r1_schema": ("error_type = 'SchemaValidationError'", True),
    "r2_parse_time": ("error_message LIKE '%_datetime\\' with value%'", False),
    "r3_parse_location": ("error_message LIKE '%location_id\\' with value%'", False),
    "r4_distance": ("error_type = 'ValueError'", True),
    "r5_money": ("error_type = 'NegativeMoneyError'", True),
    "r6_duration": ("error_type = 'InvalidTripDurationError'", False),
    "r7_passengers": ("error_type = 'InvalidPassengerCountError'", True),
    "r8_too_early": ("error_message LIKE '%before TLC minimum%'", True),
    "r9_future": ("error_message LIKE '%in the future'", True),
    "r10_unexpected": ("error_type IN ('OverflowError', 'InvalidOperation')", True),
    "r11_duplicate": ("error_type = 'WithinBatchDuplicate'", True),
}


def _rule_query(name: str, condition: str, with_gate: bool) -> None:
    @query(name)
    def _(spark, sf_dir):
        return rejections(spark, sf_dir, schema_gate=with_gate).filter(condition)


for _name, (_condition, _gate) in RULE_FILTERS.items():
    _rule_query(_name, _condition, _gate)


@query("r12_process_valid")
def _(spark, sf_dir):
    return processed(spark, sf_dir).valid


@query("r12_process_rejected")
def _(spark, sf_dir):
    return rejections(spark, sf_dir)


@query("r13_each_record")
def _(spark, sf_dir):
    done = processed(spark, sf_dir, one_by_one=True, keep=IDS)
    return done.valid.select(*IDS, "trip_id", "pickup_zone", "total_amount")


@query("r14_run_summary")
def _(spark, sf_dir):
    return processed(spark, sf_dir).summary()


@query("r14_observed_run")
def _(spark, sf_dir):
    """Run-log row of a staged run: what its writes counted, without another pass."""
    done = processed(spark, sf_dir).staged()
    return ingest.observed_run(done, "run", workload.NOW).select(
        "source_file", "total_rows", "valid_rows", "invalid_rows", "schema_rejected_rows"
    )


# -- repeats and versions --------------------------------------------------


@query("d1_keep_first")
def _(spark, sf_dir):
    """First delivery of each order line number within an order block, whole rows."""
    raw = workload.raw_rides(spark, sf_dir)
    marked = dedup.mark_repeats(
        raw,
        ["batch_id", "l_linenumber"],
        "row_order",
        F.col("pickup_location_id") > 0,
        ["batch_id", "row_order"],
    )
    return marked.select(*IDS, "batch_id", "repeat")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_facts(spark, sf_dir).versions()


@query("l1_latest")
def _(spark, sf_dir):
    order = ["ingested_at", "write_seq", "batch_id"]
    rows = dedup.latest(versions(spark, sf_dir), dedup.TRIP_KEY, order)
    return rows.select(*dedup.TRIP_KEY, "ingested_at", "batch_id", "total_amount")


@query("l2_latest_count")
def _(spark, sf_dir):
    return dedup.latest_count(versions(spark, sf_dir), dedup.TRIP_KEY)


@query("l3_repeat_check")
def _(spark, sf_dir):
    return dedup.repeat_check(versions(spark, sf_dir))


@query("l4_stream_dedup")
def _(spark, sf_dir):
    stream = messages.message_stream(spark, message_folder(spark, sf_dir))
    once = jobs.drop_redelivered(jobs.trip_stream(stream), "30 days")
    return drain(spark, once.select("trip_id", "vendor_id"), "once")


@query("l4_stream_latest")
def _(spark, sf_dir):
    """Whole trips of a stream, the latest of the versions that came within the bound.

    Both deliveries, the second correcting the first an hour later, and a message a day after that by
    which the stream's clock passes all of them.
    """
    folder = staging.new_folder(spark, "messages")
    valid = valid_trips(spark, sf_dir)
    later = valid.limit(1).withColumns(
        {"trip_id": F.lit("later"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL '2' DAY")}
    )
    for number in (1, 2):
        part = message_sink.trip_messages(valid.filter(F.col("write_seq") == number))
        message_sink.publish(part, folder, number, "load")
    message_sink.publish(message_sink.trip_messages(later), folder, 3, "load")
    stream = jobs.trip_stream(messages.message_stream(spark, folder))
    return drain(spark, jobs.latest_within(stream, "90 minutes", "1 hour"), "latest").select(*TRIPS.names)


@query("l1_bucketed")
def _(spark, sf_dir):
    """Latest versions from a table bucketed by trip id."""
    name, folder = "trips_bucketed", staging.new_folder(spark, "bucketed")
    bucketed.write_bucketed(versions(spark, sf_dir), name, folder, 8)
    rows = bucketed.latest_of_bucketed(spark, name)
    return rows.select(*dedup.TRIP_KEY, "ingested_at", "batch_id", "total_amount")


@once
def sketch_table(spark: SparkSession, sf_dir: str) -> tuple[sketches.SketchTable, FactTable]:
    """Daily sketches and their facts, the days of the second delivery computed anew when it has come."""
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    held = sketches.SketchTable(spark, staging.new_folder(spark, "sketches"))
    with staging.Scratch(spark) as scratch:
        valid = staging.stage(processed(spark, sf_dir, by_time=True).valid, "valid", scratch)
        for number in (1, 2):
            part = valid.filter(F.col("write_seq") == number)
            facts.append(part, number, "load", moved=False)  # staged by pickup time
            held.refresh(facts, touched_days(part))
    return held, facts


@query("l3_sketch_count")
def _(spark, sf_dir):
    """Different trip ids per month and in all, estimated without reading trips: off by how much."""
    told = sketches.repeat_check(sketch_table(spark, sf_dir)[0])
    off = F.abs(F.col("distinct_trip_ids") / F.col("trips") - 1)
    return told.select("month", "trips", (off <= sketches.COUNT_ERROR).alias("within_error"))


@query("h1_sketch_quantiles")
def _(spark, sf_dir):
    """Fare quantiles of each year from merged daily sketches, by the exact ranks of what they tell."""
    table, facts = sketch_table(spark, sf_dir)
    year = F.year("day").alias("year")
    told = sketches.merged(table.read(), year).select(
        "year",
        "trips",
        F.explode(F.array(*[
            F.struct(F.lit(p).alias("probability"), sketches.quantile(p).alias("value")) for p in adhoc.QUANTILES
        ])).alias("q"),
    ).select("year", "trips", "q.*")
    fares = facts.current().select(
        F.year("pickup_datetime").alias("of_year"), F.col("total_amount").cast("double").alias("fare")
    )
    counts = fares.groupBy("of_year", "fare").agg(F.count("*").alias("n"))
    ranked = told.join(counts, F.col("year") == F.col("of_year")).groupBy("year", "trips", "probability").agg(
        (F.sum(F.when(F.col("fare") < F.col("value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(F.col("fare") <= F.col("value"), F.col("n")).otherwise(0)) / F.sum("n")).alias("upto"),
    )
    error = F.lit(sketches.RANK_ERROR)
    near = (F.col("below") - error <= F.col("probability")) & (F.col("upto") + error >= F.col("probability"))
    return ranked.select("year", "trips", "probability", near.alias("within_error"))


# -- dead letters ----------------------------------------------------------


@query("q1_dead_letters")
def _(spark, sf_dir):
    record = F.col("original_record")
    return fresh_letters(spark, sf_dir).select(
        "trip_id",
        "error_message",
        "error_type",
        "stage",
        "batch_id",
        "failed_at",
        "retry_count",
        *[
            F.get_json_object(record, f"$.{n}").cast("bigint").alias(n)
            for n in ("vendor_id", "pickup_location_id", "payment_type")
        ],
        F.get_json_object(record, "$.total_amount").cast("double").alias("total_amount"),
    )


@query("q2_routing_key")
def _(spark, sf_dir):
    keyed = fresh_letters(spark, sf_dir).select(letter_sink.routing_key().alias("key"))
    return keyed.groupBy("key").agg(F.count("*").alias("letters"))


def replayed(spark: SparkSession, sf_dir: str) -> deadletters.Replayed:
    """Replay with a clock a month later, when some future pickups have become valid."""
    a_month_on = F.lit("2014-10-30 00:00:00").cast("timestamp")
    return deadletters.replay(
        fresh_letters(spark, sf_dir), workload.zones(spark, sf_dir), a_month_on, F.lit("replay"), staged=False
    )


@query("q3_replay_recovered")
def _(spark, sf_dir):
    rows = replayed(spark, sf_dir).recovered
    return rows.drop("ingested_at", "source_file")


@query("q3_replay_generations")
def _(spark, sf_dir):
    """Two replays a month apart, each run twice: every letter recovers once or is kept once."""
    folder = staging.new_folder(spark, "rejected")
    with staging.Scratch(spark):
        letter_sink.write_files(fresh_letters(spark, sf_dir, by_folder=True), folder, 1, "load", moved=False)
    ledger, recovered = staging.new_folder(spark, "ledger"), staging.new_folder(spark, "recovered")
    a_month_on = F.lit("2014-10-30 00:00:00").cast("timestamp")
    for number, clock in ((1, now()), (2, a_month_on), (2, a_month_on), (1, now())):
        run = generations.ReplayRun(folder, ledger, recovered, number)
        generations.replay_pending(spark, run, workload.zones(spark, sf_dir), clock, F.lit("replay"))
    kept, _bad = rejects.read_rejects(spark, f"{folder}/writer=replay/generation=2", whole=True)
    outcomes = [
        spark.read.parquet(recovered).select(F.lit("recovered").alias("outcome"), F.lit(None).cast("int").alias("retry_count")),
        kept.select(F.lit("still invalid").alias("outcome"), "retry_count"),
        generations.consumed(spark, ledger).select(
            F.concat(F.lit("consumed "), "writer").alias("outcome"), F.col("run").cast("int").alias("retry_count")
        ),
    ]
    rows = outcomes[0].unionByName(outcomes[1]).unionByName(outcomes[2])
    return rows.groupBy("outcome", "retry_count").agg(F.count("*").alias("letters"))


@query("q4_replay_still_invalid")
def _(spark, sf_dir):
    return replayed(spark, sf_dir).still_invalid.drop("original_record", "source_file")


@query("q5_one_batch")
def _(spark, sf_dir):
    """Letters of each batch, found through the folder its id leads to."""
    folder = staging.new_folder(spark, "rejected")
    letter_sink.write_files(letters(spark, sf_dir), folder, 1, "load")
    batch = identity.hash_fields(F.lit(workload.SOURCE_FILE), F.lit(3), F.lit(1))
    batch_id = spark.range(1).select(batch.alias("b")).first().b
    found, _bad = rejects.read_rejects(spark, folder, batch_id, whole=True)
    return found.select("trip_id", "error_type", "error_message", "stage", "batch_id")


@query("q6_recovery_summary")
def _(spark, sf_dir):
    return replayed(spark, sf_dir).summary()


@query("q7_dry_run")
def _(spark, sf_dir):
    return deadletters.dry_run(fresh_letters(spark, sf_dir))


@query("q8_by_error")
def _(spark, sf_dir):
    return deadletters.by_error(fresh_letters(spark, sf_dir))


@query("q9_by_stage_over_time")
def _(spark, sf_dir):
    return deadletters.by_stage_over_time(fresh_letters(spark, sf_dir), "1 day")


@query("q10_exhausted")
def _(spark, sf_dir):
    """Letters after three fruitless replays."""
    generation = letters(spark, sf_dir)
    for _round in range(3):
        again = deadletters.replay(
            generation, workload.zones(spark, sf_dir), now(), F.lit("replay")
        )
        generation = again.still_invalid
    return deadletters.exhausted(generation).groupBy("error_type", "retry_count").agg(
        F.count("*").alias("letters")
    )


@query("q11_replay_topic")
def _(spark, sf_dir):
    topic = staging.new_folder(spark, "dlq")
    ready = letters(spark, sf_dir)
    delivered(ready, topic, None, 1)
    to = jobs.Destinations(
        messages=staging.new_folder(spark, "recovered"),
        letters_topic=staging.new_folder(spark, "dlq-next"),
        strict=True,
    )
    dimension = workload.zones(spark, sf_dir)
    a_month_on = F.lit("2014-10-30 00:00:00").cast("timestamp")
    each = jobs.replay_topic(lambda: dimension, to, "replay", a_month_on, F.lit("replay"))
    stream = messages.message_stream(spark, topic)
    jobs.start(stream, each, staging.new_folder(spark, "offsets"), drain=True).awaitTermination()
    outcomes = [
        spark.read.parquet(path).select(F.lit(name).alias("outcome"))
        for name, path in (("recovered", to.messages), ("still_invalid", to.letters_topic))
    ]
    return outcomes[0].unionByName(outcomes[1]).groupBy("outcome").agg(
        F.count("*").alias("letters")
    )


# -- rollups ---------------------------------------------------------------


def _rollup_query(name: str, spec: rollup.RollupSpec) -> None:
    @query(name)
    def _(spark, sf_dir):
        return rollup.finish(rollup.build(stored_facts(spark, sf_dir).current(), spec), spec)


for _name, _spec in zip(
    ["a1_hourly", "a2_daily", "a3_borough", "a4_payment", "a5_zone"], rollup.ROLLUPS
):
    _rollup_query(_name, _spec)


@query("a6_state_merge")
def _(spark, sf_dir):
    """Counting every insert: components of two deliveries merged."""
    facts = stored_facts(spark, sf_dir)
    tables = RollupTables(spark, staging.new_folder(spark, "raw-rollups"))
    for number in (1, 2, 2):  # the second comes twice and counts once
        part = facts.versions().filter(F.col("write_seq") == number)
        tables.append_raw(part, number, "load", [rollup.HOURLY])
    return rollup.finish(tables.read(rollup.HOURLY, raw=True), rollup.HOURLY)


@query("a7_incremental")
def _(spark, sf_dir):
    """Deliveries one by one, refreshing touched days only."""
    valid = valid_trips(spark, sf_dir)
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    tables = RollupTables(spark, staging.new_folder(spark, "rollups"))
    for number in (1, 2):
        part = valid.filter(F.col("write_seq") == number)
        facts.append(part, number, "load")
        tables.refresh(facts, touched_days(part), [rollup.DAILY])
    return rollup.finish(tables.read(rollup.DAILY), rollup.DAILY)


@query("a8_stream_rollup")
def _(spark, sf_dir):
    """Events per hour and type as a watermarked stream; all but the open hours."""
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    trips_of = stream.select(
        F.col("ts").cast("timestamp").alias("pickup_datetime"),
        F.col("event_type").alias("vendor_id"),
        F.col("value").cast("decimal(9,2)").alias("total_amount"),
        F.lit(0.25).alias("trip_distance"),
        F.col("user_id").alias("trip_duration_seconds"),
        F.lit(1).alias("passenger_count"),
    )
    return drain(spark, jobs.rollup_stream(trips_of, rollup.HOURLY, "2 hours"), "hourly")


#: Trips of one arriving file, which one task writes.
ARRIVING_ROWS = 2_000_000


@query("a8_update_mode")
def _(spark, sf_dir):
    """Hourly rollup of a stream in update mode, batch by batch: open hours and late trips count."""
    valid = valid_trips(spark, sf_dir)
    folder = staging.new_folder(spark, "arriving")
    parts = ["vendor_id = 'Unknown'", "vendor_id <> 'Unknown' AND payment_type = 'Cash'",
             "vendor_id <> 'Unknown' AND payment_type <> 'Cash'"]
    for part in parts:  # newest first is not needed: hours of all parts overlap
        rows = valid.filter(part).select(*TRIPS.names)
        files = -(-rows.count() // ARRIVING_ROWS) or 1
        rows.coalesce(files).write.mode("append").parquet(folder)
    trips_of = spark.readStream.schema(TRIPS).option("maxFilesPerTrigger", 1).parquet(folder)
    tables = RollupTables(spark, staging.new_folder(spark, "rollups"))
    changed = jobs.rollup_stream(trips_of, rollup.HOURLY, "5000 days")
    each = jobs.update_rollup(tables, rollup.HOURLY)
    jobs.start(changed, each, staging.new_folder(spark, "offsets"), drain=True, mode="update").awaitTermination()
    return rollup.finish(tables.read(rollup.HOURLY), rollup.HOURLY)


# -- dashboards ------------------------------------------------------------


def _report(name: str, report) -> None:
    @query(name)
    def _(spark, sf_dir):
        return report(stored_rollups(spark, sf_dir), AS_OF)


_report("m1_hourly_volume", dashboard.hourly_volume)
_report("m2_daily_summary", dashboard.daily_summary)
_report("m3_borough_breakdown", dashboard.borough_breakdown)
_report("m4_borough_flow", dashboard.borough_flow)
_report("m5_payment_mix", dashboard.payment_mix)
_report("m6_top_zones", dashboard.top_zones)


# -- operations ------------------------------------------------------------


@query("o1_partition_rows")
def _(spark, sf_dir):
    return stored_facts(spark, sf_dir).statistics().select("pickup_month", "rows")


@query("o1_partition_sizes")
def _(spark, sf_dir):
    """Readable rows and sizes per month. Sizes depend on the writer: only that there are."""
    told = operations.readable_statistics(stored_facts(spark, sf_dir).statistics())
    sized = F.col("disk_size").rlike("^[0-9.]+ [KMGTPEZY]?i?B$") & ~F.col("disk_size").startswith("0 ")
    return told.select("partition", "row_count", sized.alias("has_size"))


@query("o2_readable")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    # 2**k and 10**k around the unit limits, driven by the order key
    n = F.col("o_orderkey") * F.col("o_custkey") * 4096
    return orders.select(
        "o_orderkey",
        encode.readable_quantity(n).alias("quantity"),
        encode.readable_size(n).alias("size"),
    )


@query("o3_recent_batches")
def _(spark, sf_dir):
    return operations.recent_batches(stored_facts(spark, sf_dir), datetime(2014, 9, 29, 22, 0, 0))


@query("o4_batch_rows")
def _(spark, sf_dir):
    """What is current of one batch, part of which a later delivery has replaced."""
    batch = identity.hash_fields(F.lit(workload.SOURCE_FILE), F.lit(3), F.lit(1))
    batch_id = spark.range(1).select(batch.alias("b")).first().b
    rows = operations.rows_of_batch(versions(spark, sf_dir), batch_id)
    return rows.select("trip_id", "batch_id", "ingested_at")


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    per_partition = events.groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition")
    ).agg(F.max("event_id").alias("current_offset"), F.min("event_id").alias("low"))
    committed = F.when(F.col("low") < 3, F.lit(-1001)).otherwise(
        F.col("current_offset") - F.col("low") * 40 + 2000
    )
    return per_partition.withColumn("committed_offset", committed).drop("low")


@query("o5_partition_lag")
def _(spark, sf_dir):
    return operations.partition_lag(offsets(spark, sf_dir))


@query("o5_total_lag")
def _(spark, sf_dir):
    return operations.total_lag(offsets(spark, sf_dir))


@once
def followed(spark: SparkSession, sf_dir: str):
    """A drained stream of the first delivery, told by a listener; the second came after it."""
    folder = staging.new_folder(spark, "messages")
    valid = valid_trips(spark, sf_dir)
    log = progress.ProgressLog(spark, staging.new_folder(spark, "progress"), held=2)
    spark.streams.addListener(log)
    try:
        for number in (1, 2):
            part = message_sink.trip_messages(valid.filter(F.col("write_seq") == number))
            message_sink.publish(part, folder, number, "load")
            if number == 1:
                stream = messages.message_stream(spark, folder, maxFilesPerTrigger="3")
                arrived = staging.new_folder(spark, "arrived")
                run = (
                    stream.writeStream.format("parquet").option("checkpointLocation", arrived + "-offsets")
                    .queryName("followed").trigger(availableNow=True).start(arrived)
                )
                run.awaitTermination()
                log.wait(run)
    finally:
        spark.streams.removeListener(log)
    return log, folder


@query("o5_stream_lag")
def _(spark, sf_dir):
    """What a stream has yet to read, from its own progress events."""
    log, folder = followed(spark, sf_dir)
    offsets = progress.with_published(log.offsets(), spark.read.parquet(folder))
    return operations.partition_lag(offsets).select("partition", "current_offset", "committed_offset", "lag")


@query("o6_stream_rates")
def _(spark, sf_dir):
    """Rows per second of a stream's run log, summed up again over its windows."""
    log, _folder = followed(spark, sf_dir)
    rates = operations.throughput(log.runs())
    return rates.agg(
        F.round(F.sum(F.col("persisted_per_second") * 60)).cast("bigint").alias("rows"),
        F.round(F.sum(F.col("invalid_per_second") * 60)).cast("bigint").alias("rejected"),
    )


@query("o6_throughput")
def _(spark, sf_dir):
    return operations.throughput(workload.event_runs(spark, sf_dir))


@query("o7_latency")
def _(spark, sf_dir):
    return operations.latency(workload.event_runs(spark, sf_dir), "1 day", 86_400)


@query("o8_duration_histogram")
def _(spark, sf_dir):
    runs = workload.event_runs(spark, sf_dir)
    return operations.histogram(
        runs, operations.duration_of_batch(), operations.DURATION_BOUNDS, ["source_file"]
    ).withColumn("value_sum", F.round("value_sum", 3))


@query("o8_size_histogram")
def _(spark, sf_dir):
    runs = workload.event_runs(spark, sf_dir)
    return operations.histogram(
        runs, F.col("total_rows"), operations.SIZE_BOUNDS, ["source_file"]
    )


@query("o9_run_summary")
def _(spark, sf_dir):
    return operations.run_summary(workload.event_runs(spark, sf_dir))


# -- ad-hoc ----------------------------------------------------------------


def _adhoc(name: str, report) -> None:
    @query(name)
    def _(spark, sf_dir):
        return report(stored_facts(spark, sf_dir).current(), AS_OF)


_adhoc("h1_fare_distribution", adhoc.fare_distribution)
_adhoc("h2_distance_distribution", adhoc.distance_distribution)
_adhoc("h3_peak_hours", adhoc.peak_hours)
_adhoc("h4_vendor_comparison", adhoc.vendor_comparison)


# -- streams ---------------------------------------------------------------


@query("t1_micro_batches")
def _(spark, sf_dir):
    """Small triggers, so many batches, give the same table as large ones."""
    batches: list[int] = []
    facts, _rollups = consumed(spark, sf_dir, per_trigger=2, batches=batches, facts_only=True)
    return month_totals(facts).withColumn("several_batches", F.lit(len(set(batches)) > 2))


@query("t1_bounded_flush")
def _(spark, sf_dir):
    """Micro-batches bounded by bytes: none holds more, and together they hold every message."""
    folder = message_folder(spark, sf_dir)
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    largest, total = sizes.load(folder).agg(F.max("length"), F.sum("length")).first()
    bound = max(largest, total // 4)
    source = spark.readStream.schema(MESSAGES).option("maxBytesPerTrigger", str(bound)).parquet(folder)
    log = staging.new_folder(spark, "flushes")

    def each(batch: DataFrame, number: int) -> None:
        files = batch.groupBy("file", "size").agg(F.count("*").alias("messages"))
        flush = files.agg(F.sum("size").alias("bytes"), F.sum("messages").alias("messages"))
        flush.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{log}/batch={number}")

    marked = source.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    jobs.start(marked, each, staging.new_folder(spark, "offsets"), drain=True).awaitTermination()
    flushes = spark.read.parquet(log)
    return flushes.agg(
        (F.max("bytes") <= bound).alias("within_bound"),
        (F.count("*") >= 4).alias("several"),
        F.sum("messages").alias("messages"),
    )


@query("t2_stream_ingest")
def _(spark, sf_dir):
    _facts, rollups = consumed(spark, sf_dir)
    return rollup.finish(rollups.read(rollup.PAYMENT), rollup.PAYMENT)


@query("t2_kept_messages")
def _(spark, sf_dir):
    """Odd messages through the consumer: stored and kept aside are all that were sent."""
    folder, aside = staging.new_folder(spark, "odd"), staging.new_folder(spark, "unusable")
    odd = odd_messages(spark, sf_dir).select(F.lit(None).cast("string").alias("key"), "value")
    message_sink.publish(odd, folder, 1, "load")
    facts, _rollups = consumed(spark, sf_dir, folder=folder, unusable=aside, facts_only=True)
    kept = spark.read.parquet(aside).select(F.substring_index("unusable", ":", 1).alias("outcome"))
    stored = facts.versions().select(F.lit("stored").alias("outcome"))
    return stored.unionByName(kept).groupBy("outcome").agg(F.count("*").alias("messages"))


def produced(spark: SparkSession, sf_dir: str) -> jobs.Destinations:
    to = jobs.Destinations(
        messages=staging.new_folder(spark, "messages"),
        letters_topic=staging.new_folder(spark, "dlq"),
        letters_folder=staging.new_folder(spark, "rejected"),
        run_log=staging.new_folder(spark, "runs"),
        strict=True,
    )
    path = source_path(spark, sf_dir)
    schema = spark.read.parquet(path).schema
    stream = trips.stream_trips(spark, path, schema)
    dimension = workload.zones(spark, sf_dir)
    each = jobs.produce(lambda: dimension, to, "producer", now(), now())
    jobs.start(stream, each, staging.new_folder(spark, "offsets"), drain=True).awaitTermination()
    return to


@query("t3_stream_produce")
def _(spark, sf_dir):
    """Distinct trips published, and rejections other than repeats by error type."""
    to = produced(spark, sf_dir)
    sent = spark.read.parquet(to.messages).select("key").distinct()
    found, _bad = rejects.read_rejects(spark, to.letters_folder, whole=True)
    counts = found.filter("stage <> 'deduplication'").groupBy("error_type").agg(
        F.count("*").alias("rows")
    )
    trips_sent = sent.agg(F.lit("none").alias("error_type"), F.count("*").alias("rows"))
    return counts.unionByName(trips_sent)


@query("t4_redelivery")
def _(spark, sf_dir):
    """Every micro-batch delivered twice: rollups are as if once."""
    _facts, rollups = consumed(spark, sf_dir, twice=True)
    return rollup.finish(rollups.read(rollup.ZONE), rollup.ZONE)


@query("t5_drain")
def _(spark, sf_dir):
    """Two drains with one checkpoint: the second takes only what came since."""
    folder = staging.new_folder(spark, "messages")
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    offsets_at = staging.new_folder(spark, "offsets")
    valid = valid_trips(spark, sf_dir)
    for number in (1, 2):
        part = valid.filter(F.col("write_seq") == number)
        message_sink.publish(message_sink.trip_messages(part), folder, number, "load")
        stream = messages.message_stream(spark, folder)
        each = jobs.consume(facts, None, "consumer", now=now())
        jobs.start(stream, each, offsets_at, drain=True).awaitTermination()
    drain = (F.col("write_seq") + 1).alias("write_seq")  # micro-batches are numbered from 0
    return facts.versions().groupBy(drain).agg(F.count("*").alias("rows"))


@query("t6_late_data")
def _(spark, sf_dir):
    """Newest trips first, older ones late: hours already reported are corrected."""
    valid = valid_trips(spark, sf_dir)
    facts = FactTable(spark, staging.new_folder(spark, "trips"))
    tables = RollupTables(spark, staging.new_folder(spark, "rollups"))
    parts = [
        valid.filter("vendor_id = 'Unknown'"),
        valid.filter("vendor_id <> 'Unknown' AND payment_type = 'Cash'"),
        valid.filter("vendor_id <> 'Unknown' AND payment_type <> 'Cash'"),
    ]
    for number, part in enumerate(parts):
        facts.append(part, number, "load")
        tables.refresh(facts, touched_days(part), [rollup.HOURLY])
    return rollup.finish(tables.read(rollup.HOURLY), rollup.HOURLY)
