"""Target tables: replace, append, replace one period.

Two backends. With `fmt="iceberg"` the table lives in a v2 catalog and every
operation is one atomic commit. With the built-in `fmt="parquet"` the same
operations are composed from what the session catalog offers.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from costflow.operators.distribute import distribute_sorted
from costflow.operators.layout import partition_last_items
from costflow.sqltext import literal, quote, select_statement

# Properties a replaced table carries on the v2 backend.
REPLACE_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "zstd",
    "write.metadata.compression-codec": "none",
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "1",
    "commit.manifest-merge.enabled": "true",
    "write.spark.fanout.enabled": "true",
}

# Properties a table loaded period by period carries there.
APPEND_PROPERTIES = {
    "format-version": "2",
    "write.format.default": "parquet",
    "write.parquet.compression-codec": "zstd",
    "write.distribution-mode": "hash",
    "write.target-file-size-bytes": "134217728",
    "commit.manifest-merge.enabled": "true",
}


# Added to a table's name while its replacement takes its place.
ASIDE = "__aside"
# Added to a versioned table's name, before a number that grows with time.
VERSION = "__v_"
#: Partition column behind the date that names the batch of rows loaded by `replace_batch`.
BATCH = "load_batch"
#: The folder level of rows that a load set aside.
SET_ASIDE = "rejected=true"
#: The property that the built-in backend heeds for the size of files.
FILE_SIZE = "write.target-file-size-bytes"
CODEC = "write.parquet.compression-codec"

Period = tuple[date, date]


@dataclass(frozen=True)
class TableSink:
    """Where and how a table is written.

    `location` is a folder, by default one beside the other tables of the
    database. Each full write goes to a fresh folder below it, so a failed write
    never touches the table in use. The table is partitioned by `partition_col` where the data has
    that column. `cluster` brings equal partition values together first, so a
    date does not end up as one small file per task; turn it off for input that
    is already laid out by date. On the v2 backend the table's own distribution
    mode does this.

    With `versioned`, the name is a view on the version of the table in use. A
    replacement is one statement that moves the view, so readers never miss the
    table, and those at work keep the version they began with until `purge`.

    `properties` are those of the table. The built-in backend heeds the codec
    (over `options`) and, in `compact`, the file size.
    """

    table: str
    location: str | None = None
    partition_col: str | None = "partitiondate"
    fmt: str = "parquet"
    cluster: bool = True
    properties: Mapping[str, str] | None = None
    versioned: bool = False
    options: Mapping[str, str] = field(default_factory=lambda: {"compression": "zstd"})

    # -- whole table ---------------------------------------------------------

    def replace(self, df: DataFrame, accept: Callable[[DataFrame], None] | None = None) -> None:
        """Replace schema and data of the table, or create it.

        `accept` sees the new table when it is written and before it takes its
        place; an exception of it leaves the old one. The v2 backend commits in one
        step and calls it afterwards.
        """
        spark, df = df.sparkSession, self._prepared(df)
        if self.fmt == "iceberg":
            self._v2_writer(df, REPLACE_PROPERTIES).createOrReplace()
            if accept:
                accept(spark.table(self.table))
            return
        staged = self.staged_name()
        self._new_v1_writer(df).saveAsTable(staged)
        self.publish(spark, staged, accept)

    def publish(self, spark: SparkSession, staged: str, accept: Callable[[DataFrame], None] | None = None) -> None:
        """Put a table that is written whole in the place of the present one, unless `accept` raises."""
        if accept:
            try:
                accept(spark.table(staged))
            except Exception:
                spark.sql(f"DROP TABLE {staged}")
                raise
        self._describe(spark, staged)
        self._show(spark, staged) if self.versioned else self._swap_in(spark, staged)

    def replace_from_view(self, spark: SparkSession, view: str) -> None:
        """`replace` as one SQL statement that selects from a view."""
        source = spark.table(view)
        partition = self.partition_of(source)
        relation = quote(view)
        if partition and self.cluster and self.fmt != "iceberg":
            hint = f"/*+ REBALANCE({quote(partition)}) */"
            relation = f"(SELECT {hint} * FROM {relation})"
        items = partition_last_items(source.schema, partition) if partition else [
            (c, quote(c)) for c in source.columns
        ]
        query = select_statement(items, relation)
        by = f"PARTITIONED BY ({quote(partition)})" if partition else ""
        if self.fmt == "iceberg":
            properties = self.properties or REPLACE_PROPERTIES
            spark.sql(
                f"CREATE OR REPLACE TABLE {self.table} USING iceberg {by} "
                f"TBLPROPERTIES ({_pairs(properties)}) AS {query}"
            )
            return
        staged = self.staged_name()
        place = literal(self.fresh_folder(spark))
        spark.sql(
            f"CREATE TABLE {staged} USING {self.fmt} OPTIONS ({_pairs(self.write_options())}) "
            f"{by} LOCATION {place} AS {query}"
        )
        self.publish(spark, staged)

    # -- period by period ----------------------------------------------------

    def create_or_append(self, df: DataFrame) -> None:
        """Create the table on first use, later add rows. A repeated load adds them again."""
        spark, df = df.sparkSession, self._prepared(df)
        exists = table_exists(spark, self.table)
        if self.fmt == "iceberg":
            writer = self._v2_writer(df, APPEND_PROPERTIES)
            writer.append() if exists else writer.create()
        elif exists:
            self._require_columns(df)
            self._v1_writer(df).mode("append").saveAsTable(self.current(spark))
        else:
            self._create(df)

    def replace_period(self, df: DataFrame, first: date, past: date) -> None:
        """Make `df` the table's only rows with `first <= partition date < past`.

        Running the same period again changes nothing. Rows outside the period
        fail the job: they would wipe out a date that belongs to another load.
        """
        self.replace_periods(df, [(first, past)])

    def replace_periods(self, df: DataFrame, periods: Sequence[Period]) -> None:
        """`replace_period` for several periods at once: one pass over `df`, one overwrite.

        The dates that were loaded are observed in the pass that writes; those of
        the periods that the table had and the load has not become empty.
        """
        spark = df.sparkSession
        if self.partition_of(df) is None:
            raise ValueError(f"replace_periods needs the column {self.partition_col!r}")
        day = F.col(quote(self.partition_col))
        inside = _any_of(day.cast("date"), periods)
        message = F.format_string(f"partition date %s is outside {_shown(periods)}", day.cast("string"))
        df = df.withColumn(self.partition_col, F.when(inside, day.cast("date")).otherwise(F.raise_error(message).cast("date")))
        if not table_exists(spark, self.table):
            self.create_or_append(df)
            return
        if self.fmt == "iceberg":
            self._v2_writer(self._prepared(df), APPEND_PROPERTIES).overwrite(_any_of(day, periods))
            return
        before = self._dates(spark, periods)
        loaded = Observation()
        df = df.observe(loaded, F.collect_set(day).alias("days"))
        self._require_columns(df)
        self._overwrite(self._prepared(df))
        # At most one date per day of the periods, like the partitions listed before.
        for gone in sorted(before - set(loaded.get["days"])):
            self._empty(spark, f"{quote(self.partition_col)} = DATE'{gone}'")

    # -- batch by batch ------------------------------------------------------

    def replace_batch(self, df: DataFrame, batch: str) -> None:
        """Make `df` the table's only rows of `batch`; the same batch again changes nothing.

        The batch is a partition column behind the date, so a batch that was cut
        off in the middle, or comes again with other rows, replaces just its own.
        Columns that the table lacks are added to it, those that the data lacks
        are null, and a column of another type is refused by name.
        """
        spark = df.sparkSession
        df = self._prepared(df).withColumn(BATCH, F.lit(batch))
        if not table_exists(spark, self.table):
            self._create(df.drop(*(f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType))))
            return
        df = self._aligned(df)
        if self.fmt == "iceberg":
            self._v2_writer(df, APPEND_PROPERTIES).overwrite(F.col(BATCH) == batch)
            return
        own = self.batches(spark).where(F.col(BATCH) == batch)
        date = self.partition_of(df)
        before = {row[1] for row in own.collect()} if date else set()
        if before:
            loaded = Observation()
            df = df.observe(loaded, F.collect_set(quote(date)).alias("days"))
        self._overwrite(df)
        for gone in before - set(loaded.get["days"]) if before else ():
            self._empty(spark, f"{quote(date)} = DATE'{gone}', {quote(BATCH)} = {literal(batch)}")

    def batches(self, spark: SparkSession) -> DataFrame:
        """(load_batch, partition date) of every batch in the table, from its partitions alone."""
        listed = spark.sql(f"SHOW PARTITIONS {self.current(spark)}")
        part = lambda name: F.regexp_extract("partition", f"(?:^|/){name}=([^/]*)", 1)
        return listed.select(part(BATCH).alias(BATCH), part(self.partition_col).try_cast("date").alias(self.partition_col))

    # -- upkeep --------------------------------------------------------------

    def compact(self, spark: SparkSession, target_bytes: int | None = None) -> int:
        """Pack the small files of each partition to about `target_bytes`; returns how many partitions changed.

        The file sizes come from a scan that reads no column. The files of a
        partition are dealt in order of size to groups of the target size, and where
        that gives fewer files the partition is written anew, a task per group,
        beside the old one; then its entry in the catalog moves, one statement per
        partition. A job cut off leaves every partition as it was or done. Old
        folders stay for readers at work. On the v2 backend this is the format's own
        procedure.
        """
        target = int(target_bytes or (self.properties or APPEND_PROPERTIES)[FILE_SIZE])
        if self.fmt == "iceberg":
            catalog = self.table.split(".")[0]
            spark.sql(f"CALL {catalog}.system.rewrite_data_files(table => {literal(self.table)}, options => map('target-file-size-bytes', '{target}'))")
            return 0
        table = spark.table(self.current(spark))
        keys = self._partitions_of(table)
        if not keys:
            raise ValueError(f"{self.table} has no partitions to compact")
        path, size = F.col("_metadata.file_path"), F.col("_metadata.file_size")
        files = table.select(*map(quote, keys), path.alias("_path"), size.alias("_size")).distinct()
        window = Window.partitionBy(*map(quote, keys))
        running = F.sum("_size").over(window.orderBy(F.desc("_size"), "_path")) - F.col("_size")
        dealt = files.withColumn("_group", F.floor(running / target)).withColumns(
            {"_files": F.count("*").over(window), "_groups": F.max("_group").over(window) + 1}
        )
        plan = dealt.where("_groups < _files").drop("_size", "_files", "_groups")
        # One number per group of files, in no order; the list is as long as that of the groups.
        named = plan.select(*map(quote, keys), "_group").distinct()
        groups = named.collect()
        if not groups:
            return 0
        schema = T.StructType([*named.schema.fields, T.StructField("_slot", T.IntegerType())])
        slots = spark.createDataFrame([(*row, n) for n, row in enumerate(groups)], schema)
        numbered = plan.join(slots, [*keys, "_group"]).select("_path", "_slot")
        # Partition values as literals, so that the scan leaves all other partitions out.
        touched = table.where(F.col(quote(keys[0])).isin(*{row[0] for row in groups}))
        rows = touched.withColumn("_path", path).join(numbered, "_path").drop("_path")
        folder = f"{self._place(spark)}/_compact-{uuid.uuid4().hex}"
        placed = rows.repartitionById(len(groups), "_slot").drop("_slot")
        placed.write.options(**self.write_options()).partitionBy(*keys).parquet(folder)
        changed = sorted({tuple(row[:-1]) for row in groups})
        for values in changed:
            spec = ", ".join(f"{quote(c)} = {literal(str(v))}" for c, v in zip(keys, values, strict=True))
            place = "/".join(f"{c}={v}" for c, v in zip(keys, values, strict=True))
            spark.sql(f"ALTER TABLE {self.current(spark)} PARTITION ({spec}) SET LOCATION {literal(f'{folder}/{place}')}")
        return len(changed)

    def purge(self, spark: SparkSession, keep: int = 1) -> int:
        """Delete the folders of replaced tables but for the `keep` newest; returns how many went.

        Only folders right below this sink's own are looked at, never the one in use,
        and none with rows set aside, which another table shows.
        """
        path = spark._jvm.org.apache.hadoop.fs.Path
        base = path(self._base(spark))
        files = base.getFileSystem(spark._jsc.hadoopConfiguration())
        used = self._folder(spark, self.current(spark))
        entries = [e for e in files.listStatus(base) if e.isDirectory() and e.getPath().getName() != used]
        entries = [e for e in entries if not files.exists(path(e.getPath(), SET_ASIDE))]
        old = sorted(entries, key=lambda e: e.getModificationTime(), reverse=True)[keep:]
        gone = {e.getPath().getName() for e in old}
        if self.versioned:
            for name in self._versions(spark):
                if self._folder(spark, name) in gone:
                    spark.sql(f"DROP TABLE {name}")
        for entry in old:
            files.delete(entry.getPath(), True)
        return len(old)

    def current(self, spark: SparkSession) -> str:
        """The table that holds the rows: itself, or the version that the view shows."""
        if not self.versioned:
            return self.table
        return self._described(spark, self.table, "View Text").rsplit(" ", 1)[-1]

    # -- parts ---------------------------------------------------------------

    def partition_of(self, df: DataFrame) -> str | None:
        return self.partition_col if self.partition_col in df.columns else None

    def _partitions_of(self, df: DataFrame) -> list[str]:
        return [c for c in (self.partition_col, BATCH) if c in df.columns]

    def _prepared(self, df: DataFrame) -> DataFrame:
        partition = self.partition_of(df)
        if partition is None:
            return df
        df = df.withColumn(partition, F.col(quote(partition)).cast("date"))
        own_layout = self.cluster and self.fmt != "iceberg"
        return distribute_sorted(df, partition) if own_layout else df

    def _require_columns(self, df: DataFrame) -> None:
        """An existing table takes rows with just its columns; nothing is dropped silently."""
        given, known = set(df.columns), set(df.sparkSession.table(self.table).columns)
        if given != known:
            raise ValueError(
                f"{self.table}: columns missing from the data: {sorted(known - given)}, "
                f"columns the table lacks: {sorted(given - known)}"
            )

    def _aligned(self, df: DataFrame) -> DataFrame:
        """`df` with the table's columns; the table gets those that it lacks."""
        spark = df.sparkSession
        known = {f.name: f.dataType for f in spark.table(self.table).schema.fields}
        # A column without any value has no type to keep.
        given = {f.name: f.dataType for f in df.schema.fields if not isinstance(f.dataType, T.NullType)}
        df = df.select(*map(quote, given))
        other = [f"{c}: {given[c].simpleString()} is not {known[c].simpleString()}" for c in given if c in known and given[c] != known[c]]
        if other:
            raise ValueError(f"{self.table}: columns of another type: {other}")
        new = [c for c in given if c not in known]
        if new:
            columns = ", ".join(f"{quote(c)} {given[c].simpleString()}" for c in new)
            spark.sql(f"ALTER TABLE {self.current(spark)} ADD COLUMNS ({columns})")
            if self.versioned:
                self._show(spark, self.current(spark))
        lacking = {c: F.lit(None).cast(known[c]) for c in known if c not in given}
        return df.withColumns(lacking) if lacking else df

    def _overwrite(self, df: DataFrame) -> None:
        """Replace just the partitions that `df` has rows of."""
        spark, name = df.sparkSession, self.current(df.sparkSession)
        ordered = df.select(*(quote(c) for c in spark.table(name).columns))
        # insertInto heeds the session setting only, not the writer option.
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            ordered.write.mode("overwrite").insertInto(name)

    def write_options(self) -> dict[str, str]:
        codec = (self.properties or {}).get(CODEC)
        return {**self.options, **({"compression": codec} if codec else {})}

    def _v1_writer(self, df: DataFrame):
        writer = df.write.format(self.fmt).options(**self.write_options())
        partitions = self._partitions_of(df)
        return writer.partitionBy(*partitions) if partitions else writer

    def _new_v1_writer(self, df: DataFrame):
        return self._v1_writer(df).option("path", self.fresh_folder(df.sparkSession))

    def _v2_writer(self, df: DataFrame, defaults: Mapping[str, str]):
        writer = df.writeTo(self.table).using("iceberg")
        for key, value in (self.properties or defaults).items():
            writer = writer.tableProperty(key, value)
        partitions = [F.col(quote(c)) for c in self._partitions_of(df)]
        return writer.partitionedBy(*partitions) if partitions else writer

    def _create(self, df: DataFrame) -> None:
        if self.fmt == "iceberg":
            self._v2_writer(df, APPEND_PROPERTIES).create()
            return
        name = self.staged_name() if self.versioned else self.table
        self._new_v1_writer(df).saveAsTable(name)
        if self.versioned:
            self.publish(df.sparkSession, name)
        else:
            self._describe(df.sparkSession, name)

    def _base(self, spark: SparkSession) -> str:
        if self.location is not None:
            return self.location.rstrip("/")
        database, _, name = self.table.rpartition(".")
        database = database or spark.catalog.currentDatabase()
        return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}.data"

    def fresh_folder(self, spark: SparkSession) -> str:
        return f"{self._base(spark)}/{uuid.uuid4().hex}"

    def staged_name(self) -> str:
        if self.versioned:
            return f"{self.table}{VERSION}{time.time_ns():020d}"
        return f"{self.table}__staged_{uuid.uuid4().hex[:12]}"

    def _described(self, spark: SparkSession, name: str, what: str) -> str:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what)
        return rows.first()["data_type"]

    def _place(self, spark: SparkSession, name: str | None = None) -> str:
        """The folder of the table, or of one of its versions."""
        return self._described(spark, name or self.current(spark), "Location").rstrip("/")

    def _folder(self, spark: SparkSession, name: str) -> str:
        """The name of the folder right below the sink's own in which the table lies."""
        plain = lambda place: re.sub("^[A-Za-z0-9]+:/*", "/", place).rstrip("/")
        return plain(self._place(spark, name)).removeprefix(f"{plain(self._base(spark))}/").split("/")[0]

    def _versions(self, spark: SparkSession) -> list[str]:
        database, dot, name = self.table.rpartition(".")
        listed = list_tables(spark, database or spark.catalog.currentDatabase(), f"{name}{VERSION}*")
        return [f"{database}{dot}{row['tableName']}" for row in listed.collect()]

    def _describe(self, spark: SparkSession, name: str) -> None:
        if self.properties:
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_pairs(self.properties)})")

    def _show(self, spark: SparkSession, version: str) -> None:
        # ALTER VIEW changes one catalog entry; CREATE OR REPLACE would drop it first.
        verb = "ALTER" if table_exists(spark, self.table) else "CREATE"
        spark.sql(f"{verb} VIEW {self.table} AS SELECT * FROM {version}")

    def _swap_in(self, spark: SparkSession, staged: str) -> None:
        # All data is written by now; only catalog entries change. The old one
        # is dropped last, so that a driver lost at any step leaves one of the two
        # under a known name. The old folder stays for whoever still reads it.
        self.recover(spark)
        aside = f"{self.table}{ASIDE}"
        if spark.catalog.tableExists(self.table):
            spark.sql(f"ALTER TABLE {self.table} RENAME TO {aside}")
        spark.sql(f"ALTER TABLE {staged} RENAME TO {self.table}")
        spark.sql(f"DROP TABLE IF EXISTS {aside}")

    def recover(self, spark: SparkSession) -> None:
        """Finish what a swap left undone: the old table back, or its spare entry gone."""
        aside = f"{self.table}{ASIDE}"
        if not spark.catalog.tableExists(aside):
            return
        if spark.catalog.tableExists(self.table):
            spark.sql(f"DROP TABLE {aside}")
        else:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {self.table}")

    def _dates(self, spark: SparkSession, periods: Sequence[Period]) -> set[date]:
        listed = spark.sql(f"SHOW PARTITIONS {self.current(spark)}")
        day = F.regexp_extract("partition", "^[^=]*=([^/]*)", 1).try_cast("date")
        inside = listed.select(day.alias("day")).where(_any_of(F.col("day"), periods))
        return {row.day for row in inside.collect()}

    def _empty(self, spark: SparkSession, spec: str) -> None:
        """Take all rows out of one partition."""
        name = self.current(spark)
        partitions = {c.split("=")[0].strip(" `") for c in spec.split(", ")}
        others = [f for f in spark.table(name).schema.fields if f.name not in partitions]
        nulls = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()})" for f in others)
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "static"):
            spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({spec}) SELECT {nulls} WHERE false")
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({spec})")


def _any_of(day: Column, periods: Sequence[Period]) -> Column:
    inside = F.lit(False)
    for first, past in periods:
        inside = inside | ((day >= F.lit(first)) & (day < F.lit(past)))
    return inside


def _shown(periods: Sequence[Period]) -> str:
    shown = [f"the period {first} to {past}" for first, past in periods[:3]]
    return ", ".join(shown) + (f" and {len(periods) - 3} more" if len(periods) > 3 else "")


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def list_databases(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW DATABASES IN {catalog}" if catalog else "SHOW DATABASES")


def list_tables(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    listed = spark.sql(f"SHOW TABLES IN {database} LIKE {literal(pattern)}")
    return listed.where("NOT isTemporary")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _pairs(properties: Mapping[str, str]) -> str:
    return ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
