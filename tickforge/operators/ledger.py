"""The snapshots' store: items as rows of semi-structured values, and a log with one entry for each snapshot.

An append writes its items to a folder of their own and then enters them in the log under the next number, which is the
snapshot's id. An entry appears whole or not at all, and a number is taken once, by whoever comes first; the other looks at what was
entered meanwhile and tries the next. Items that no entry names aren't there for readers, so that a failed or repeated append
leaves nothing behind. An entry tells what is needed to choose a snapshot, so that one is read without opening the others' files.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators.snapshots import LIST_LIMIT, check_type
from tickforge.schemas import SUMMARY, SUMMARY_COLUMNS

LOG = "id long, type string, trade_date string, fetched_at timestamp, symbol_count int, batch string, part string"
ITEM = "pos long, item variant"
#: Entries after which ``compact`` is worth its while.
ENTRIES = 500


def publish_local(folder: str, name: str, text: str) -> bool:
    """Gives a file of a local folder its name, with all its text, unless there is one."""
    draft = f"{folder}/.{uuid.uuid4().hex}"
    with open(draft, "w", encoding="utf-8") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(draft, f"{folder}/{name}")
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True


class SnapshotStore:
    """A store in the folder ``path`` of any file system whose renames are atomic and don't replace; a local folder will do."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, str(path)
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._log = self._at("log")
        self._fs = self._log.getFileSystem(self._conf)
        self.local = self._fs.getScheme() == "file"
        self._fs.mkdirs(self._log)

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def _publish(self, snapshot_id: int, entry: dict) -> bool:
        name, text = f"{snapshot_id:020d}.json", json.dumps(entry | {"id": snapshot_id})
        if self.local:
            return publish_local(self._fs.makeQualified(self._log).toUri().getPath(), name, text)
        return self._publish_by_rename(name, text)

    def _publish_by_rename(self, name: str, text: str) -> bool:
        draft = self._at("log", f".{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        no_replacing = self.spark.sparkContext._gateway.new_array(kinds, 1)
        no_replacing[0] = kinds.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at("log", name)), no_replacing)
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            self._fs.delete(draft, False)
            return False
        return True

    def _numbers(self) -> list[int]:
        names = (f.getPath().getName() for f in self._fs.listStatus(self._log))
        return sorted(int(n[:20]) for n in names if n.endswith(".json") and n[:20].isdigit())

    def _entries(self, numbers: list[int]) -> DataFrame:
        files = [f"{self.path}/log/{n:020d}.json" for n in numbers]
        return self.spark.read.schema(LOG).json(files) if files else self.spark.range(0).select(*(F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in LOG.split(", ")))

    def log(self) -> DataFrame:
        """A row for each snapshot, without items: of entries that ``compact`` has put together, and of those that came after."""
        numbers = self._numbers()
        sums = self._at("sums")
        done = [int(f.getPath().getName()) for f in self._fs.listStatus(sums) if f.getPath().getName().isdigit()] if self._fs.exists(sums) else []
        if not done:
            return self._entries(numbers)
        upto = max(done)
        return self.spark.read.schema(LOG).parquet(f"{self.path}/sums/{upto:020d}").unionByName(self._entries([n for n in numbers if n > upto]))

    def compact(self, least: int = ENTRIES) -> bool:
        """Put the entries so far together, if there are ``least`` more than last time; they stay as they are for whoever looks for one."""
        numbers = self._numbers()
        sums = self._at("sums")
        done = max([0, *(int(f.getPath().getName()) for f in self._fs.listStatus(sums) if f.getPath().getName().isdigit())]) if self._fs.exists(sums) else 0
        if not numbers or sum(n > done for n in numbers) < least:
            return False
        draft = self._at("sums", f".{uuid.uuid4().hex}")
        self.log().filter(F.col("id") <= numbers[-1]).sort("id").coalesce(1).write.parquet(draft.toString())  # a row a snapshot
        return self._fs.rename(draft, self._at("sums", f"{numbers[-1]:020d}"))

    def _of_batch(self, kind: str, batch: str, after: int) -> tuple[int | None, int]:
        """The id of a batch if it was entered after an id, and the last id there is."""
        numbers = self._numbers()
        rows = self.log() if after < 0 else self._entries([n for n in numbers if n > after])
        found = rows.filter((F.col("type") == kind) & (F.col("batch") == batch) & (F.col("id") <= (numbers[-1] if numbers else 0))).agg(F.min("id")).first()[0]
        return found, numbers[-1] if numbers else 0

    def append(self, items: DataFrame, kind: str, fetched_at: Column, batch: str | None = None) -> int:
        """Append a snapshot of ``items`` (pos and any columns) and give its id; a batch that is there already keeps its id and adds nothing.

        symbol_count counts rows, duplicates too. Items are written by as many tasks as make them; ids follow each other, over all
        processes that write to the store.
        """
        check_type(kind)
        batch = batch or uuid.uuid4().hex
        known, last = self._of_batch(kind, batch, -1)
        if known is not None:
            return known
        part = f"items/part-{uuid.uuid4().hex}"
        try:
            value = F.to_variant_object(F.struct(*(F.col(c) for c in items.columns if c != "pos")))
            items.select(F.col("pos").cast("long").alias("pos"), value.alias("item")).write.parquet(f"{self.path}/{part}")
            count = self.spark.read.schema("pos long").parquet(f"{self.path}/{part}").count()
            at = self.spark.range(1).select(F.date_format(fetched_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), x.et_date(x.eastern(fetched_at))).first()
            entry = {"type": kind, "trade_date": at[1], "fetched_at": at[0], "symbol_count": count, "batch": batch, "part": part}
            while not self._publish(last + 1, entry):
                known, last = self._of_batch(kind, batch, last)
                if known is not None:
                    self._fs.delete(self._at(part), True)
                    return known
            return last + 1
        except Exception:
            self._fs.delete(self._at(part), True)
            raise

    def _items(self, entries: DataFrame) -> DataFrame:
        """id, type, fetched_at, pos and item of entries, one or none, which are looked up at once."""
        e = entries.first()
        if e is None:
            return self.spark.range(0).select(F.col("id"), F.lit("").alias("type"), F.lit(None).cast("timestamp").alias("fetched_at"), F.lit(0).cast("long").alias("pos"), F.parse_json(F.lit("null")).alias("item"))
        rows = self.spark.read.schema(ITEM).parquet(f"{self.path}/{e['part']}")
        return rows.select(F.lit(e["id"]).cast("long").alias("id"), F.lit(e["type"]).alias("type"), F.lit(e["fetched_at"]).cast("timestamp").alias("fetched_at"), "pos", "item")

    def entry(self, snapshot_id: int) -> DataFrame:
        """The log's row of an id; no other entry is read."""
        there = snapshot_id > 0 and self._fs.exists(self._at("log", f"{snapshot_id:020d}.json"))
        return self._entries([snapshot_id] if there else [])

    def newest(self, kind: str) -> DataFrame:
        """The log's row of the newest of a type; equally new ones by id."""
        return self.log().filter(F.col("type") == check_type(kind)).orderBy(F.desc("fetched_at"), F.desc("id")).limit(1)

    def by_id(self, snapshot_id: int) -> DataFrame:
        """The items of a snapshot. Its files alone are opened."""
        return self._items(self.entry(snapshot_id))

    def latest(self, kind: str) -> DataFrame:
        """The items of the newest snapshot of a type. Its files alone are opened."""
        return self._items(self.newest(kind))

    def listing(self, kind: str | None = None, limit: int = LIST_LIMIT) -> DataFrame:
        """The newest snapshots without items, from the log alone."""
        rows = self.log() if kind is None else self.log().filter(F.col("type") == check_type(kind))
        return rows.select("id", "type", "trade_date", "fetched_at", "symbol_count").orderBy(F.desc("fetched_at"), F.desc("id")).limit(limit)

    def items(self, kind: str | None = None) -> DataFrame:
        """The items of all snapshots, with the log's columns."""
        rows = self.log() if kind is None else self.log().filter(F.col("type") == check_type(kind))
        if not self._fs.exists(self._at("items")):
            return rows.select("id", "type", "fetched_at", F.lit(0).cast("long").alias("pos"), F.parse_json(F.lit("null")).alias("item")).limit(0)
        every = self.spark.read.schema(ITEM).option("recursiveFileLookup", "true").parquet(f"{self.path}/items")
        every = every.select("pos", "item", F.regexp_extract("_metadata.file_path", r"(items/part-[0-9a-f]+)/", 1).alias("part"))
        return every.join(rows, "part").select("id", "type", "fetched_at", "pos", "item")

    def sweep(self, older_than: float = 86_400.0) -> int:
        """Delete items that no entry names and that are so many seconds old: what a process that died has left."""
        named = {r["part"] for r in self.log().select("part").toLocalIterator()}
        now, gone = self._jvm.java.lang.System.currentTimeMillis(), 0
        for f in self._fs.listStatus(self._at("items")) if self._fs.exists(self._at("items")) else []:
            if f"items/{f.getPath().getName()}" not in named and now - f.getModificationTime() >= older_than * 1000:
                gone += bool(self._fs.delete(f.getPath(), True))
        return gone


def summaries(items: DataFrame, keep: tuple[str, ...] = ("id", "pos")) -> DataFrame:
    """``keep`` and the summary's columns of items; what an item lacks, or has as something else, is null."""
    kinds = dict(c.split() for c in SUMMARY.split(", "))
    return items.select(*keep, *(F.try_variant_get("item", f"$.{c}", kinds[c].replace("long", "bigint")).alias(c) for c in SUMMARY_COLUMNS))


def fields(items: DataFrame) -> DataFrame:
    """The schema that all items have together, one row."""
    return items.agg(F.schema_of_variant_agg("item").alias("fields"))


def row(entries: DataFrame, items: DataFrame) -> DataFrame:
    """One snapshot as the row that its page shows, its results in order: its universe bounds them."""
    i = summaries(items)
    results = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.struct(*SUMMARY_COLUMNS).alias("i")))), lambda e: e.i)
    return entries.drop("batch", "part").join(i.groupBy("id").agg(results.alias("results")), "id", "left").select("id", "type", "trade_date", "fetched_at", "symbol_count", F.coalesce("results", F.array().cast(f"array<struct<{SUMMARY.replace(' ', ': ').replace(',: ', ', ')}>>")).alias("results"))


def document(entries: DataFrame, items: DataFrame) -> DataFrame:
    """The response document of one snapshot, with all that its items hold, known or not: its universe bounds them."""
    results = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.to_json("item").alias("i")))), lambda e: e.i)
    body = items.groupBy("id").agg(F.concat(F.lit("["), F.array_join(results, ","), F.lit("]")).alias("_r"))
    head = F.to_json(F.struct("id", "type", F.col("trade_date").alias("tradeDate"), x.iso_utc("fetched_at").alias("fetchedAt"), F.col("symbol_count").alias("symbolCount")), {"ignoreNullFields": "false"})
    return entries.join(body, "id", "left").select("id", F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"results":'), F.coalesce("_r", F.lit("[]")), F.lit("}")).alias("body"))
