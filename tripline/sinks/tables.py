"""Fact and rollup tables on plain Parquet, partitioned by month.

Deliveries are written as they come, each into a folder of its own named after its writer and
number, ``deliveries/writer=w/number=n/month=yyyyMM``: one that comes again replaces itself.
``months/month=yyyyMM`` holds one version of every trip. ``compact`` brings it up to date:
the touched months and their deliveries are read, the latest versions staged, and these months
replaced by dynamic partition overwrite. Readers pick the latest version from both, so they agree
before, during and after; months without new deliveries need no picking.

Rollups are kept the same way: touched days are recomputed, put together with the other days of
their months, staged, and the months overwritten.

Any number of jobs may append deliveries; one job compacts a fact table, and one refreshes a
rollup. A reader whose plan was made before folders went fails and has to be run again.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripline.functions.identity import packed, unpacked
from tripline.functions.times import month_of
from tripline.operators.dedup import BROADCAST_ROWS, TRIP_KEY, latest
from tripline.operators.rollup import ROLLUPS, SUM_TYPES, RollupSpec, build, merge
from tripline.operators.staging import PACKED, Scratch, stage
from tripline.schema import TRIPS
from tripline.sources.messages import as_stored

#: Greatest wins; the batch only settles ties, a batch holds a trip once.
VERSION_ORDER = ["ingested_at", "write_seq", "batch_id"]

#: Columns of hex digests, which are moved as bytes.
DIGESTS = ["trip_id", "batch_id"]

#: Columns the rollups are built from.
ROLLUP_INPUT = sorted(
    {"pickup_datetime"} | {c for r in ROLLUPS for c in (*r.keys, *r.sums)}
)


class MonthFiles:
    """Parquet below one folder, by month, and by writer and number where they are kept apart."""

    def __init__(self, spark: SparkSession, path: str, month: str, columns: T.StructType):
        self.spark, self.path, self.month = spark, path, month
        self.schema = T.StructType([*columns, T.StructField(month, T.IntegerType())])

    def folders(self, below: str = "") -> dict[str, int]:
        """Month folders and their months. Foreign folders are passed over."""
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}{self.month}=*")
        files = where.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = {}
        for status in files.globStatus(where) or []:
            name = status.getPath().toString()
            if (number := name.rsplit("=", 1)[1]).isdigit():
                found[name] = int(number)
        return found

    def read(self, folders: Iterable[str]) -> DataFrame:
        """Rows of month folders; only these are listed."""
        folders = sorted(folders)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        source = self.spark.read.schema(self.schema).option("basePath", self.path)
        return source.parquet(*folders).select(*self.schema.names)

    def write(
        self, rows: DataFrame, order: list[str], below: str = "", by: tuple[str, ...] = (), moved: bool = True
    ) -> None:
        """Write by month. ``below`` is replaced whole; without it, the months in ``rows`` are.

        The rebalance splits a hot month over several files and joins up small ones. Rows that
        need no move, as those of a task lie in few months, are written where they are. ``by``
        names columns that get a folder above the months.
        """
        which = "static" if below else "dynamic"
        dealt = self._dealt(rows) if moved else rows
        sorted_rows = dealt.sortWithinPartitions(*by, self.month, *order)
        writer = sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", which)
        writer.options(**PACKED).partitionBy(*by, self.month).parquet(f"{self.path}/{below}")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        digests = [c for c in DIGESTS if c in rows.columns]
        return unpacked(packed(rows, digests).hint("rebalance", F.col(self.month)), digests)

    def delete(self, folders: Iterable[str]) -> None:
        for folder in folders:
            where = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def delivery_folder(writer: str, sequence: int) -> str:
    return f"writer={writer}/number={sequence}/"


#: Any delivery.
EVERY = "writer=*/number=*/"


def _in_groups(months: list[int], many: dict[int, int], most: int) -> list[list[int]]:
    """Months in groups of at most ``most`` counted rows; a month with more is alone."""
    groups: list[list[int]] = []
    held = 0
    for month in months:
        if not groups or held + many.get(month, 0) > most:
            groups.append([])
            held = 0
        groups[-1].append(month)
        held += many.get(month, 0)
    return groups


def _in_months(rows: DataFrame) -> DataFrame:
    without = F.raise_error(F.lit("a trip without a pickup time cannot be stored"))
    pickup = F.coalesce("pickup_datetime", without.cast("timestamp"))
    return rows.withColumn("pickup_month", month_of(pickup))


def as_fact(df: DataFrame, *keep: str) -> DataFrame:
    """Typed fact rows from trip columns in any of their forms.

    Absent money and passenger counts are 0; a value its column cannot hold is an error.
    """
    return df.select(*[as_stored(f, df.schema[f.name].dataType) for f in TRIPS], *keep)


class FactTable:
    """Trips below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        columns = T.StructType([*TRIPS, T.StructField("write_seq", T.LongType())])
        self.spark = spark
        self.deliveries = MonthFiles(spark, f"{path}/deliveries", "pickup_month", columns)
        self.merged = MonthFiles(spark, f"{path}/months", "pickup_month", columns)

    def append(self, trips: DataFrame, sequence: int, writer: str, moved: bool = True) -> None:
        """Store one delivery. The same writer's same number again replaces it.

        ``write_seq`` is that number: of versions ingested at one time the later delivery
        counts. A trip without a pickup time has no month to lie in and raises an error: see
        ``sources.messages.sorted_trips`` for a place to keep such rows. Trips of which a task has few
        months need not be ``moved``.
        """
        rows = as_fact(trips).withColumn("write_seq", F.lit(sequence).cast("bigint"))
        self.deliveries.write(_in_months(rows), TRIP_KEY, delivery_folder(writer, sequence), moved=moved)

    def load(self, trips: DataFrame, writer: str) -> None:
        """Store all deliveries of a writer in one pass; those it had are replaced.

        ``write_seq`` of a row is the number of its delivery. The rows of a task have to lie in
        few months, as after ``repartitionByRange`` by pickup: they are written where they lie.
        """
        number = F.col("write_seq").cast("bigint")
        rows = as_fact(trips.withColumn("_number", number), "_number").withColumnRenamed("_number", "write_seq")
        rows = _in_months(rows).withColumn("number", F.col("write_seq"))
        self.deliveries.write(rows, TRIP_KEY, f"writer={writer}/", ("number",), moved=False)

    def delivered(self, sequence: int, writer: str) -> DataFrame:
        """Rows of one delivery as it was stored, until it is merged."""
        return self.deliveries.read(self.deliveries.folders(delivery_folder(writer, sequence)))

    def _held(self, months: Iterable[int] | None = None) -> tuple[dict[str, int], dict[str, int]]:
        """Folders of deliveries and of merged months, all or of the given months."""
        both = self.deliveries.folders(EVERY), self.merged.folders()
        if months is None:
            return both
        wanted = set(months)
        return tuple({f: m for f, m in held.items() if m in wanted} for held in both)

    def compact(self, months: list[int] | None = None) -> None:
        """Keep only the latest version of every trip in the given months.

        Deliveries are deleted after the months that now hold them are complete. A run that
        is cut short changes nothing for readers and can be repeated.
        """
        new, merged = self._held(months)
        touched = set(new.values())
        if not touched:
            return
        old = [f for f, m in merged.items() if m in touched]
        rows = self.deliveries.read(new).unionByName(self.merged.read(old))
        with Scratch(self.spark) as scratch:
            self.merged.write(stage(self._latest(rows), "months", scratch), TRIP_KEY)
        self.deliveries.delete(new)

    def drop_months(self, before: int) -> list[int]:
        """Retention: remove whole months earlier than ``before`` (yyyyMM)."""
        gone: set[int] = set()
        for files, held in zip((self.deliveries, self.merged), self._held(), strict=True):
            old = [f for f, m in held.items() if m < before]
            gone.update(held[f] for f in old)
            files.delete(old)
        return sorted(gone)

    def months(self) -> list[int]:
        return sorted({m for held in self._held() for m in held.values()})

    def versions(self) -> DataFrame:
        """Every stored row, superseded ones too.

        After a ``compact`` that was cut short, until it is repeated, a row may lie in both places.
        """
        new, merged = self._held()
        if not merged:
            return self.deliveries.read(new)
        return self.deliveries.read(new).unionByName(self.merged.read(merged))

    @staticmethod
    def _latest(rows: DataFrame) -> DataFrame:
        keys = ["pickup_month", *TRIP_KEY, "_trip_id"]
        return unpacked(latest(packed(rows, ["trip_id"]), keys, VERSION_ORDER), ["trip_id"])

    def current(self, where: Column | None = None, months: Iterable[int] | None = None) -> DataFrame:
        """Latest version of every trip; months without new deliveries are read as they are.

        ``where`` may use only key columns (pickup time, vendor, trip id, month):
        filtering others before choosing versions would change the choice. Only ``months``
        are listed, where given.
        """
        new, merged = self._held(months)
        touched = set(new.values())
        settled = [f for f, m in merged.items() if m not in touched]
        open_months = [f for f, m in merged.items() if m in touched]

        def kept(rows: DataFrame) -> DataFrame:
            return rows if where is None else rows.filter(where)

        parts = []
        if settled:
            parts.append(kept(self.merged.read(settled)))
        if touched or not settled:
            rows = kept(self.deliveries.read(new))
            if open_months:
                rows = rows.unionByName(kept(self.merged.read(open_months)))
            parts.append(self._latest(rows))
        out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return out.select(*TRIPS.names, "write_seq", "pickup_month")

    def staged_current(
        self, columns: list[str], where: Column, months: Iterable[int], scratch: Scratch
    ) -> DataFrame:
        """``current``, staged: only trips that may have several stored versions are moved.

        These are found by a hash of their keys, which is all that is moved of the others, and told
        from them by broadcasts of at most ``BROADCAST_ROWS`` hashes, for as many months at a time.
        A month with more of them is ranked whole.
        """
        new, merged = self._held(months)
        touched = set(new.values())
        settled = [f for f, m in merged.items() if m not in touched]
        rows = self.deliveries.read(new)
        if open_months := [f for f, m in merged.items() if m in touched]:
            rows = rows.unionByName(self.merged.read(open_months))
        rows = rows.filter(where).withColumn("_key", F.xxhash64("pickup_month", *TRIP_KEY))
        keys = rows.groupBy("pickup_month", "_key").agg(F.count("*").alias("n")).filter("n > 1")
        keys = stage(keys.select("pickup_month", "_key"), "keys", scratch)
        many = {r.pickup_month: r["count"] for r in keys.groupBy("pickup_month").count().collect()}
        parts = [self.merged.read(settled).filter(where).select(*columns)] if settled else []
        for group in _in_groups(sorted(touched), many, BROADCAST_ROWS):
            own = rows.filter(F.col("pickup_month").isin(group))
            if sum(many.get(m, 0) for m in group) > BROADCAST_ROWS:
                picked = self._latest(own.drop("_key")).select(*columns)
            else:
                side = F.broadcast(keys.filter(F.col("pickup_month").isin(group)).select("_key"))
                several = own.join(side, "_key", "left_semi").drop("_key")
                picked = own.join(side, "_key", "left_anti").select(*columns)
                picked = picked.unionByName(self._latest(several).select(*columns))
            parts.append(stage(picked, "days", scratch))
        return reduce(DataFrame.unionByName, parts) if parts else rows.select(*columns)

    def is_settled(self, months: Iterable[int]) -> bool:
        """Whether no delivery waits to be merged into these months."""
        new, merged = self._held(months)
        return not new and set(months) <= set(merged.values())

    def written_since(self, since: Column) -> DataFrame:
        """Stored rows with ``ingested_at`` at or after ``since``, superseded ones too.

        The test is on the rows' own time; row groups are skipped by their statistics.
        """
        return self.versions().filter(F.col("ingested_at") >= since)

    def statistics(self) -> DataFrame:
        """Rows, bytes and newest file time per month, from files and footers alone."""
        file = [
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("bytes"),
            F.col("_metadata.file_modification_time").alias("modified"),
        ]
        per_file = None
        for files, held in zip((self.deliveries, self.merged), self._held(), strict=True):
            if held:
                rows = self.spark.read.schema(files.schema).option("basePath", files.path).parquet(*sorted(held))
                own = rows.groupBy("pickup_month", *file).agg(F.count("*").alias("rows"))
                per_file = own if per_file is None else per_file.unionByName(own)
        if per_file is None:
            schema = "pickup_month int, file string, bytes bigint, modified timestamp, rows bigint"
            per_file = self.spark.createDataFrame([], schema)
        return per_file.groupBy("pickup_month").agg(
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.max("modified").alias("modified"),
        )


def between(low: datetime, high: datetime) -> Column:
    """Pickup in [low, high): the month test prunes folders, the time test row groups."""
    last = max(low, high - timedelta(microseconds=1))
    return (
        F.col("pickup_month").between(low.year * 100 + low.month, last.year * 100 + last.month)
        & (F.col("pickup_datetime") >= F.lit(str(low)).cast("timestamp"))
        & (F.col("pickup_datetime") < F.lit(str(high)).cast("timestamp"))
    )


def day_list(days: list[date]) -> str:
    """Days as a list in SQL: one text is planned far faster than a literal for each day."""
    return ", ".join(f"DATE '{d}'" for d in sorted(set(days)))


def on_days(days: list[date]) -> Column:
    """Pickup on one of the days: months prune folders, the range from first to last day
    row groups, and the set of days the rows."""
    months = sorted({d.year * 100 + d.month for d in days})
    listed = day_list(days)
    return F.expr(
        f"pickup_month IN ({', '.join(map(str, months))})"
        f" AND pickup_datetime >= TIMESTAMP '{min(days)} 00:00:00'"
        f" AND pickup_datetime < TIMESTAMP '{max(days) + timedelta(days=1)} 00:00:00'"
        f" AND to_date(pickup_datetime) IN ({listed})"
    )


def touched_days(trips: DataFrame) -> list[date]:
    """Days a delivery touches.

    Of checked trips (``sorted_trips`` or ``process``): pickups lie between 2009 and
    tomorrow, so there is at most one row per calendar day since.
    """
    days = trips.select(F.to_date("pickup_datetime").alias("day")).distinct().collect()
    return sorted(r.day for r in days if r.day is not None)


class RollupTables:
    """The five rollups below one folder, one table each.

    Two ways to fill them, kept apart. ``refresh`` recomputes whole days from the current
    trips. ``append_raw`` adds the components of every insert, repeats included.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def files(self, spec: RollupSpec, raw: bool = False) -> MonthFiles:
        grain = T.TimestampType() if spec.grain == "hour" else T.DateType()
        columns = [
            T.StructField(spec.grain, grain),
            *[T.StructField(k, TRIPS[k].dataType) for k in spec.keys],
            T.StructField("n", T.LongType()),
            *[T.StructField(f"sum_{m}", SUM_TYPES[m]) for m in spec.sums],
        ]
        kind = "deliveries" if raw else "months"
        return MonthFiles(
            self.spark, f"{self.path}/{spec.name}/{kind}", "rollup_month", T.StructType(columns)
        )

    def refresh(self, facts: FactTable, days: list[date], specs=tuple(ROLLUPS)) -> None:
        """Recompute the given days. Call it after the delivery has been stored.

        Late, corrected and redelivered trips all end in the same rollup, however often it is
        called. The number of days is bounded: see ``touched_days``.
        """
        if not days:
            return
        months = {d.year * 100 + d.month for d in days}
        def one(spec: RollupSpec) -> None:
            files = self.files(spec)
            states = build(trips, spec).withColumn("rollup_month", month_of(F.col(spec.grain)))
            held = [f for f, m in files.folders().items() if m in months]
            if held:  # read and overwritten: the new months are staged before the old ones go
                other = files.read(held).filter(f"to_date({spec.grain}) NOT IN ({day_list(days)})")
                states = stage(states.unionByName(other), "rollup", scratch)
            files.write(states, spec.key_columns)

        with Scratch(self.spark) as scratch:
            if facts.is_settled(months):
                trips = facts.current(on_days(days), months).select(*ROLLUP_INPUT)
            else:  # picking versions shuffles: once for all rollups, not once for each
                trips = facts.staged_current(ROLLUP_INPUT, on_days(days), months, scratch)
            _together(one, specs)

    def upsert(self, states: DataFrame, spec: RollupSpec) -> None:
        """Put in groups with all that has been counted of them; stored ones of the same key go."""
        files = self.files(spec)
        new = states.select(*spec.key_columns, *spec.states)
        new = new.withColumn("rollup_month", month_of(F.col(spec.grain)))
        with Scratch(self.spark) as scratch:
            new = stage(new, "changed", scratch)
            months = {r.rollup_month for r in new.select("rollup_month").distinct().collect()}
            held = [f for f, m in files.folders().items() if m in months]
            if held:
                same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in spec.key_columns]
                other = files.read(held).alias("old").join(new.alias("new"), same, "left_anti")
                new = stage(new.unionByName(other), "rollup", scratch)
            files.write(new, spec.key_columns)

    def append_raw(
        self, trips: DataFrame, sequence: int, writer: str, specs=tuple(ROLLUPS)
    ) -> None:
        """Add one delivery's components; the same number again replaces them."""

        def one(spec: RollupSpec) -> None:
            states = build(held, spec).withColumn("rollup_month", month_of(F.col(spec.grain)))
            self.files(spec, raw=True).write(states, spec.key_columns, delivery_folder(writer, sequence))

        with Scratch(self.spark) as scratch:
            held = trips.select(*ROLLUP_INPUT)
            if len(specs) > 1:  # read once for all rollups, not once for each
                held = stage(held, "raw", scratch)
            _together(one, specs)

    def read(
        self, spec: RollupSpec, first: date | None = None, last: date | None = None,
        raw: bool = False,
    ) -> DataFrame:
        """Components, optionally of a range of days. ``raw`` for appended tables.

        Folders of other months are not even listed, and the range is tested on the grain, so
        row groups are pruned as well.
        """
        files = self.files(spec, raw)
        low = first.year * 100 + first.month if first is not None else 0
        high = last.year * 100 + last.month if last is not None else 999999
        folders = files.folders(EVERY if raw else "")
        states = files.read(f for f, m in folders.items() if low <= m <= high)
        hourly = spec.grain == "hour"

        def bound(day: date) -> Column:
            return F.lit(str(day)).cast("timestamp" if hourly else "date")

        if first is not None:
            states = states.filter((F.col("rollup_month") >= low) & (F.col(spec.grain) >= bound(first)))
        if last is not None:
            after = bound(last + timedelta(days=1))
            states = states.filter((F.col("rollup_month") <= high) & (F.col(spec.grain) < after))
        if raw:
            return merge(states, spec)
        return states.select(*spec.key_columns, *spec.states)


def _together(job, specs) -> None:
    """Independent jobs: the small ones fill the cores the others leave idle."""
    with ThreadPoolExecutor(len(specs)) as pool:
        list(pool.map(job, specs))
