"""Market snapshots: summaries of a whole universe, appended as one row each and read by type, by id or as a list."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.schemas import SNAPSHOT, SUMMARY_COLUMNS

TYPES = ("all-stocks", "all-etfs", "all-combined")
LIST_LIMIT = 50


def check_type(kind: str) -> str:
    if kind not in TYPES:
        raise ValueError(f"type must be one of {TYPES}")
    return kind


def parse_id(text: str) -> int:
    """The integer that a text begins with."""
    m = re.match(r"\s*[+-]?\d+", text)
    if not m:
        raise ValueError("id must be a number")
    return int(m[0])


def build(items: DataFrame, kind: str, snapshot_id: int, fetched_at: Column) -> DataFrame:
    """One row with all items in order; symbol_count counts requested symbols, duplicates too. The universe bounds its size."""
    check_type(kind)
    rows = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct(*SUMMARY_COLUMNS).alias("i")))), lambda e: e.i)
    out = items.agg(F.count("*").cast("int").alias("symbol_count"), rows.alias("results"))
    return out.select(F.lit(snapshot_id).cast("long").alias("id"), F.lit(kind).alias("type"), x.et_date(x.eastern(fetched_at)).alias("trade_date"), fetched_at.alias("fetched_at"), "symbol_count", "results")


def capture(items: DataFrame, kind: str, snapshot_id: int, fetched_at: Column, path: str) -> None:
    """Append a snapshot to the store, a folder of Parquet partitioned by type."""
    build(items, kind, snapshot_id, fetched_at).write.mode("append").partitionBy("type").parquet(path)


def store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SNAPSHOT).parquet(path)


def latest(snapshots: DataFrame, kind: str) -> DataFrame:
    """The newest of a type; equally new ones by id."""
    return snapshots.filter(F.col("type") == check_type(kind)).orderBy(F.desc("fetched_at"), F.desc("id")).limit(1)


def by_id(snapshots: DataFrame, snapshot_id: int) -> DataFrame:
    return snapshots.filter(F.col("id") == snapshot_id).limit(1)


def listing(snapshots: DataFrame, kind: str | None = None, limit: int = LIST_LIMIT) -> DataFrame:
    """The newest snapshots without their results."""
    rows = snapshots.filter(F.col("type") == check_type(kind)) if kind is not None else snapshots
    return rows.select("id", "type", "trade_date", "fetched_at", "symbol_count").orderBy(F.desc("fetched_at"), F.desc("id")).limit(limit)


def listing_of_type(snapshots: DataFrame, kind: str, limit: int = LIST_LIMIT) -> DataFrame:
    """As the page shows it: the filter comes after the limit, so there may be fewer than there are."""
    return listing(snapshots, None, limit).filter(F.col("type") == kind)


def items(snapshots: DataFrame) -> DataFrame:
    """A row for each item, with the snapshot's id and place."""
    return snapshots.select("id", F.posexplode("results").alias("pos", "i")).select("id", "pos", "i.*")


def envelope(snapshots: DataFrame) -> DataFrame:
    """The response document of each snapshot, with its results if it has them."""
    names = {"id": "id", "type": "type", "trade_date": "tradeDate", "fetched_at": "fetchedAt", "symbol_count": "symbolCount", "results": "results"}
    value = lambda n: x.iso_utc(n) if n == "fetched_at" else F.col(n)
    doc = F.struct(*(value(n).alias(v) for n, v in names.items() if n in snapshots.columns))
    return snapshots.select("id", F.to_json(doc, {"ignoreNullFields": "false"}).alias("body"))


def list_envelope(listed: DataFrame) -> DataFrame:
    """The response document of a list, one row: snapshots, newest first. The list's limit bounds its size."""
    at = F.struct("fetched_at", "id", "type", "trade_date", "symbol_count")
    rows = F.transform(F.sort_array(F.collect_list(at), asc=False), lambda r: F.struct(r.id.alias("id"), r.type.alias("type"), r.trade_date.alias("tradeDate"), x.iso_utc(r.fetched_at).alias("fetchedAt"), r.symbol_count.alias("symbolCount")))
    return listed.agg(F.to_json(F.struct(rows.alias("snapshots"))).alias("body"))


def store_jdbc(spark: SparkSession, url: str, table: str = "market_snapshots", **options: str) -> DataFrame:
    """The same store in a relational database, its results as JSON text; filters, columns and limits are pushed to it."""
    rows = spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
    return rows.withColumn("results", F.from_json(F.col("results").cast("string"), ITEMS))


ITEMS = SNAPSHOT[SNAPSHOT.index("array<") :]
