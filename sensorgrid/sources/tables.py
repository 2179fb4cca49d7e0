"""Stored tables: append, keep-latest upsert, truncate, copy, and checks on them.

Tables are parquet folders with a fixed schema. A rewrite replaces only the partitions that the new
rows touch, and Spark swaps them in after all tasks have succeeded, so a lost executor or a failed
job leaves the old partitions in place. A table without partition columns is one partition. One
writer per table at a time.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorgrid.schemas import SCHEMAS, require_columns
from sensorgrid.session import Stage, remove_path, small_side

log = logging.getLogger(__name__)

PRUNED_PARTITIONS = 5_000  # partition values named in a filter


MONTH = "month"
_WHOLE = "part"  # the only partition of a table without partition columns


@dataclass(frozen=True)
class Table:
    """A stored table. ``partition_by`` must be part of ``key`` so that a key stays in its place.

    With ``month_of``, a time of the key, ``partition_by`` may also name ``month``: a number like
    202403 that is stored as a folder only.
    """

    path: str
    schema: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    version: str | None = None
    month_of: str | None = None

    def __post_init__(self):
        if self.month_of is not None and self.month_of not in self.key:
            raise ValueError(f"{self.month_of!r} is not part of the key")
        outside = set(self.partition_by) - set(self.key) - ({MONTH} if self.month_of else set())
        if outside:
            raise ValueError(f"partition columns {sorted(outside)} are not part of the key")

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.schema)

    @property
    def columns(self) -> list[str]:
        return self.struct.fieldNames()

    @property
    def placed(self) -> list[str]:
        """All stored columns: those of the schema and of the folders."""
        return [*self.columns, *[c for c in self.folders if c not in self.columns]]

    @property
    def folders(self) -> tuple[str, ...]:
        return self.partition_by or (_WHOLE,)

    def place(self, df: DataFrame) -> DataFrame:
        """The columns as stored."""
        if MONTH in self.partition_by:
            when = F.col(self.month_of)
            df = df.withColumn(MONTH, (F.year(when) * 100 + F.month(when)).cast("int"))
        if not self.partition_by:
            df = df.withColumn(_WHOLE, F.lit(0))
        return df.select(*self.placed)

    def scan(self, spark: SparkSession) -> DataFrame:
        """The table as stored, or an empty frame of its schema if it was never written."""
        struct = self.struct
        for name in self.placed[len(self.columns) :]:
            struct = struct.add(name, "integer")
        try:
            return spark.read.schema(struct).parquet(self.path).select(*self.placed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], struct)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.scan(spark).select(*self.columns)


def require_key(df: DataFrame, table: Table) -> None:
    """Replace-by-key needs a key whose columns exist and are never NULL."""
    if not table.key:
        raise ValueError(f"{table.path}: a table without a key cannot be replaced by key")
    require_columns(df, table.key, table.path)
    any_null = F.greatest(*[F.col(k).isNull() for k in table.key], F.lit(False))
    if not df.filter(any_null).isEmpty():
        raise ValueError(f"{table.path}: NULL in the key {table.key}")


def dedupe_latest(df: DataFrame, key: Sequence[str], version: Sequence[str] = ()) -> DataFrame:
    """One row per key: the one with the highest ``version``, then the highest other values.

    Spark keeps one row per key on the map side already, so a key with very many rows does not
    gather in one task.
    """
    rest = [c for c in df.columns if c not in key and c not in version]
    order = [F.col(c).desc_nulls_last() for c in [*version, *rest]] or [F.lit(0)]
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rn", first).filter(F.col("_rn") == 1).drop("_rn")


def merge_latest(
    old: DataFrame, new: DataFrame, key: Sequence[str], version: str | None = None
) -> DataFrame:
    """Old and new rows. New rows win, or with ``version`` the later one; rows of the same version
    go to the new side.

    With ``version`` one row per key is left. Without one, old rows whose key is not among the new
    ones pass as they are, and only the new rows are grouped; few new keys, by their counted number,
    are broadcast, and then the old rows are not shuffled. ``key`` is never NULL in ``new``.
    """
    if not version:
        kept = old.join(small_side(new.select(*key)), list(key), "left_anti")
        return kept.unionByName(dedupe_latest(new.select(*old.columns), key))
    both = old.withColumn("_side", F.lit(0)).unionByName(
        new.select(*old.columns).withColumn("_side", F.lit(1))
    )
    return dedupe_latest(both, key, [version, "_side"]).drop("_side")


def _write(df: DataFrame, table: Table, mode: str) -> None:
    writer = table.place(df).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*table.folders).parquet(table.path)


def _rewrite(df: DataFrame, table: Table) -> None:
    """Replace the touched partitions.

    Rebalancing brings the rows of a partition together, so that not every task writes into every
    partition, and adaptive execution splits a partition that is much larger than the others.
    """
    _write(table.place(df).hint("rebalance", *table.folders), table, "overwrite")


def _partitions_of(stored: DataFrame, rows: DataFrame, table: Table) -> DataFrame:
    """Stored rows in the partitions that ``rows`` fall into.

    The partition values, unless they are very many, also go into a filter, so that the other
    partitions are not even listed for the scan.
    """
    return _within(stored, table.place(rows).select(*table.partition_by).distinct(), table)


def _within(stored: DataFrame, touched: DataFrame, table: Table) -> DataFrame:
    """Stored rows in the partitions named by ``touched``, each once.

    The names are broadcast, few as they are: a shuffle by them would bring all rows of a partition
    into one task.
    """
    values = touched.limit(PRUNED_PARTITIONS + 1).collect()
    if any(part is None for v in values for part in v):
        raise ValueError(f"{table.path}: NULL in the key {table.key}")
    if len(values) <= PRUNED_PARTITIONS:
        for name in table.partition_by:
            stored = stored.filter(F.col(name).isin(sorted({v[name] for v in values})))
        names = F.broadcast(stored.sparkSession.createDataFrame(values, touched.schema))
    else:
        names = small_side(touched)
    return stored.join(names, list(table.partition_by), "left_semi").select(*table.columns)


_APPEND = "append_id"


def _appends(table: Table) -> Table:
    """The record of appends beside a table: a folder for each, with the partitions it touched."""
    kinds = {f.name: f.dataType.simpleString() for f in table.struct}
    columns = [f"{_APPEND} string", *[f"{name} {kinds.get(name, 'int')}" for name in table.folders]]
    return Table(f"{table.path.rstrip('/')}_appends", ", ".join(columns), (_APPEND,), (_APPEND,))


def append(df: DataFrame, table: Table, dry_run: bool = False) -> None:
    """Add rows. Rows with an existing key stay beside the old ones until ``compact``.

    The partitions that the rows fall into are recorded before the rows are added, so that a
    broken-off append is known to ``compact`` as well. For that the rows are staged; a table
    without a key, which is never compacted, takes them directly.
    """
    require_columns(df, table.columns, table.path)
    if dry_run:
        return
    if not table.key:
        _write(df, table, "append")
        return
    stage = Stage(df.sparkSession, "append")
    try:
        rows = stage.put(df.select(*table.columns))
        touched = table.place(rows).select(*table.folders).distinct()
        _write(touched.withColumn(_APPEND, F.lit(f"append-{uuid.uuid4().hex}")), _appends(table), "append")
        _write(rows, table, "append")
    finally:
        stage.clear()


def upsert_latest(df: DataFrame, table: Table, dry_run: bool = False) -> None:
    """Insert rows; a row replaces the stored row with the same key.

    The new rows are computed once and staged, then checked and merged.
    """
    require_columns(df, table.columns, table.path)
    if dry_run:
        return
    stage = Stage(df.sparkSession, "upsert")
    try:
        new = stage.put(df.select(*table.columns))
        require_key(new, table)
        old = table.scan(df.sparkSession)
        if table.partition_by:
            old = _partitions_of(old, new, table)
        old = old.select(*table.columns)
        _rewrite(merge_latest(old, new, table.key, table.version), table)
    finally:
        stage.clear()


def replace_partitions(df: DataFrame, table: Table) -> None:
    """Write rows in place of all rows of the partitions that they fall into."""
    _write(df, table, "overwrite")


def rewrite_without(stored: DataFrame, kept: DataFrame, table: Table) -> None:
    """Write ``kept`` in place of ``stored``, which is all rows of some partitions.

    Both hold the folders' columns, as ``scan`` gives them. Partitions of which nothing is kept are
    removed as folders, since an overwrite leaves partitions alone that it has no rows for; their
    names, which must be numbers, come to the driver. A run that breaks off can be repeated.
    """
    names, spark = list(table.partition_by), stored.sparkSession
    emptied = stored.select(*names).distinct().join(kept.select(*names).distinct(), names, "left_anti").collect()
    _rewrite(kept.select(*table.columns), table)
    for row in emptied:
        remove_path(spark, "/".join([table.path.rstrip("/"), *[f"{name}={row[name]}" for name in names]]))


def compact(
    spark: SparkSession, table: Table, within: Mapping[str, object] | None = None, recorded: bool = True
) -> None:
    """Remove superseded rows left by appends. Partitions without any are not rewritten.

    Only partitions that an append has touched since the last compaction are read, by the record
    that ``append`` keeps beside the table; a table without such records is done at once.
    ``recorded=False`` reads all partitions, for tables that something else has written into.
    ``within`` limits the work to given values of partition columns. A record is deleted when all
    its partitions are done, so a compaction that breaks off can be repeated.
    """
    within = within or {}
    for name in within:
        if name not in table.partition_by:
            raise ValueError(f"{table.path}: {name!r} is not a partition column")
    stored, record = table.scan(spark), _appends(table)
    noted = record.read(spark)
    done = [r[_APPEND] for r in noted.select(_APPEND).distinct().collect()]
    for name, value in within.items():
        stored, noted = stored.filter(F.col(name) == value), noted.filter(F.col(name) == value)
    if recorded:
        if noted.isEmpty():
            return
        if table.partition_by:
            stored = _within(stored, noted.select(*table.partition_by).distinct(), table)
    _drop_superseded(stored, table)
    if not within:
        for append_id in done:
            remove_path(spark, f"{record.path}/{_APPEND}={append_id}")


def _drop_superseded(stored: DataFrame, table: Table) -> None:
    """Rewrite those partitions of ``stored`` in which a key has several rows."""
    require_key(stored, table)
    repeated = stored.groupBy(*table.key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if repeated.isEmpty():
        return
    if table.partition_by:
        stored = _partitions_of(stored, repeated.withColumns(_nulls(table)), table)
    version = [table.version] if table.version else []
    _rewrite(dedupe_latest(stored.select(*table.columns), table.key, version), table)


def _nulls(table: Table) -> dict:
    """The columns outside the key, empty."""
    return {f.name: F.lit(None).cast(f.dataType) for f in table.struct if f.name not in table.key}


def truncate(spark: SparkSession, table: Table) -> None:
    """Remove all rows; readers keep the schema from the table's definition."""
    writer = table.place(spark.createDataFrame([], table.struct)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "static").partitionBy(*table.folders).parquet(
        table.path
    )
    remove_path(spark, _appends(table).path)


@dataclass(frozen=True)
class TransferSpec:
    """A table to copy between schemas; a schema is a folder under a common root."""

    table: str
    schema: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    version: str | None = None
    month_of: str | None = None
    source_schema: str = "features"
    target_schema: str = "prod_features"

    def at(self, root: str, schema_name: str) -> Table:
        path = f"{root.rstrip('/')}/{schema_name}/{self.table}"
        return Table(path, self.schema, self.key, self.partition_by, self.version, self.month_of)


def transfer_registry() -> dict[str, TransferSpec]:
    """The five tables that go from development to production, by name."""
    predictions = dict(
        schema=SCHEMAS["predictions"],
        key=("model_id", "date_time", "x", "y"),
        partition_by=("model_id", MONTH),
        month_of="date_time",
    )
    output = dict(source_schema="output", target_schema="prod_output")
    # --- Fixed values: names of the tables and their schemas
    specs = [
        TransferSpec("traffic_model_predictions_stations", **predictions),
        TransferSpec("traffic_model_predictions_grid", **predictions),
        TransferSpec("traffic_models_final", SCHEMAS["final_models"], ("depvar",)),
        TransferSpec("traffic_model_scaling", SCHEMAS["scaling"], ("x", "y")),
        TransferSpec(
            "traffic_model_description", SCHEMAS["model_description"], ("model_id",), **output
        ),
    ]
    # ---
    return {s.table: s for s in specs}


def copy_table(spark: SparkSession, root: str, spec: TransferSpec, dry_run: bool = False) -> int:
    """Copy the source rows into the target by key; returns the number of source rows.

    The target is left without duplicates even where the copy fails.
    """
    target = spec.at(root, spec.target_schema)
    try:
        source = spark.read.schema(target.struct).parquet(spec.at(root, spec.source_schema).path)
        rows = source.count()
        upsert_latest(source, target, dry_run)
        return rows
    except Exception:
        if not dry_run:
            compact(spark, target, recorded=False)
        raise


def transfer_tables(
    spark: SparkSession, root: str, specs: Iterable[TransferSpec] | None = None, dry_run: bool = False
) -> tuple[DataFrame, int]:
    """Copy each table; an error in one does not stop the others.

    Returns a report (table, ok, rows, error) and 0, or 1 if any copy failed.
    """
    report = []
    for spec in transfer_registry().values() if specs is None else specs:
        log.info("copy %s from %s to %s", spec.table, spec.source_schema, spec.target_schema)
        try:
            report.append((spec.table, True, copy_table(spark, root, spec, dry_run), None))
        except Exception as error:  # reported below
            log.exception("copy of %s failed", spec.table)
            report.append((spec.table, False, None, str(error)))
    schema = "table string, ok boolean, rows bigint, error string"
    return spark.createDataFrame(report, schema), int(not all(r[1] for r in report))


def completeness_check(
    predictions: DataFrame, cells: DataFrame, hours: int | DataFrame, slack_hours: Sequence[int] = (0,)
) -> DataFrame:
    """Have predictions arrived for every cell and hour?

    ``hours`` is a number or the calendar rows of the range. ``slack_hours=(-1, 0, 1)`` also
    accepts a range with a change of the clock.
    """
    n_cells = cells.agg(F.count(F.lit(1)).alias("n")).scalar()
    if isinstance(hours, DataFrame):
        n_hours = hours.agg(F.count(F.lit(1)).alias("n")).scalar()
    else:
        n_hours = F.lit(hours).cast("bigint")
    expected = [F.col("cells") * (F.col("hours") + s) for s in slack_hours]
    return (
        predictions.agg(F.count(F.lit(1)).alias("n"))
        .select("n", n_cells.alias("cells"), n_hours.alias("hours"))
        .withColumn("all_preds_arrived", reduce(or_, [F.col("n") == e for e in expected]))
    )


def hour_coverage(
    predictions: DataFrame, cells: DataFrame, hours: DataFrame, ts: str = "date_time"
) -> DataFrame:
    """Which hours of each cell are missing: (x, y, n_rows, n_hours, n_missing, first_missing).

    ``hours`` are the calendar rows wanted, ``cells`` the places. A cell's hours are bits, one number
    for each 32 hours, merged by ``bit_or`` before anything is shuffled: a repeated row sets a bit
    that is set already, so it can't stand in for one that is missing, as in a count of rows. Rows
    of other cells or hours do not count. Every cell comes back, also one without any row. The first
    gap is found in one pass over a cell's words beside the wanted ones.
    """
    since = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    number = F.timestamp_diff("HOUR", since, F.col(ts)).alias("_hour")
    wanted = hours.select(F.col(ts)).distinct().select(number).filter("_hour IS NOT NULL")
    word, bit = F.floor(F.col("_hour") / 32).alias("_word"), F.pmod(F.col("_hour"), F.lit(32)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    words = wanted.groupBy(word).agg(F.bit_or(one).alias("_wanted"))
    places = cells.select("x", "y").distinct()
    seen = (
        predictions.select("x", "y", number)
        .groupBy("x", "y", word)
        .agg(F.bit_or(one).alias("_seen"), F.sum(F.lit(1)).alias("_rows"))
    )
    # one row for each cell: its words side by side, in the order of time
    here = F.col("_seen").bitwiseAND(F.col("_wanted"))
    lacking = F.col("_wanted").bitwiseAND(F.bitwise_not(F.col("_seen")))
    held = seen.join(F.broadcast(words), "_word").groupBy("x", "y").agg(
        F.sum("_rows").alias("n_rows"),
        F.sum(F.bit_count(here)).cast("bigint").alias("n_hours"),
        F.array_sort(F.collect_list(F.struct("_word", lacking.alias("_lacking")))).alias("_held"),
    )
    total = words.agg(F.sum(F.bit_count("_wanted")).cast("bigint").alias("n")).scalar()
    list_ = words.agg(F.array_sort(F.collect_list(F.struct("_word", "_wanted"))).alias("words")).scalar()

    def first_of(word: Column, bits: Column) -> Column:
        """The first of some hours of a word."""
        return word * 32 + F.bit_count(bits.bitwiseAND(-bits) - 1)

    def gap(held: Column, place: Column) -> Column:
        """What a cell's word tells of missing hours: some are missing in it, or the wanted word of
        the same place stands before it, so that one up to that place is missing altogether."""
        wanted = F.get("_words", place)
        return F.when(held["_word"] > wanted["_word"], first_of(wanted["_word"], wanted["_wanted"])).when(
            held["_lacking"] != 0, first_of(held["_word"], held["_lacking"])
        )

    out = places.join(held, ["x", "y"], "left").withColumns({"_total": F.coalesce(total, F.lit(0)), "_words": list_})
    # a cell's words are some of those wanted, so the two lists agree up to its first missing word
    out = out.withColumn("_after", F.get("_words", F.when(F.col("_held").isNull(), 0).otherwise(F.size("_held"))))
    first = F.least(
        F.array_min(F.transform("_held", gap)), first_of(F.col("_after._word"), F.col("_after._wanted"))
    )
    n_hours = F.coalesce("n_hours", F.lit(0))
    return out.select(
        "x",
        "y",
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        n_hours.cast("bigint").alias("n_hours"),
        (F.col("_total") - n_hours).cast("bigint").alias("n_missing"),
        F.timestamp_add("HOUR", first, since).alias("first_missing"),
    )


def covered(coverage: DataFrame) -> DataFrame:
    """One row of ``hour_coverage``: cells, cells with gaps, missing hours, repeated rows, and the verdict."""
    return coverage.agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("n_missing") > 0).alias("cells_with_gaps"),
        F.coalesce(F.sum("n_missing"), F.lit(0)).cast("bigint").alias("n_missing"),
        F.coalesce(F.sum(F.col("n_rows") - F.col("n_hours")), F.lit(0)).cast("bigint").alias("n_extra"),
        F.coalesce(F.sum("n_missing") == 0, F.lit(True)).alias("all_preds_arrived"),
    )
