"""Days of ticks as rows that add up, the newest two of each symbol as a table that is kept, and the quotes they make."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.functions import expr as x
from tickforge.operators import bars as b

DAY = "symbol string, day string, o long, h long, l long, c long, v long, hi long, lo long"


def days(ticks: DataFrame) -> DataFrame:
    """A row for each symbol and Eastern day (DAY, prices in cents); hi and lo are the day's own. Partial aggregates meet."""
    at = F.struct("ts", "seq")
    out = ticks.groupBy("symbol", x.et_date(x.eastern("ts")).alias("day")).agg(F.min_by("cents", at).alias("o"), F.max("cents").alias("h"), F.min("cents").alias("l"), F.max_by("cents", at).alias("c"), F.sum("volume").alias("v"))
    return out.select("*", F.col("h").alias("hi"), F.col("l").alias("lo"))


def newest(rows: DataFrame) -> DataFrame:
    """Of rows of days the newest two of each symbol, with hi and lo over all of them. Ranks are cut before the shuffle, so that no task holds a symbol's days."""
    both = rows.withColumn("_k", F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("day")))).filter("_k <= 2").drop("_k", "hi", "lo")
    return both.join(rows.groupBy("symbol").agg(F.max("hi").alias("hi"), F.min("lo").alias("lo")), "symbol")


def quotes(two: DataFrame) -> DataFrame:
    """Quotes of the newest two days of each symbol."""
    price = lambda c: (F.col(c) / 100.0)
    both = two.groupBy("symbol").agg(F.max_by(F.struct("o", "h", "l", "c", "v"), "day").alias("d"), F.when(F.count("*") > 1, F.min_by("c", "day")).alias("_c"), F.max("hi").alias("hi"), F.min("lo").alias("lo"))
    before, odd = F.col("_c") / 100.0, F.length("symbol") % 2 == 1
    return both.select(
        "symbol", F.initcap("symbol").alias("shortName"), F.concat(F.initcap("symbol"), F.lit(", Inc.")).alias("longName"), F.lit("NMS").alias("exchange"), F.lit("USD").alias("currency"),
        price("d.o").alias("regularMarketOpen"), price("d.h").alias("regularMarketDayHigh"), price("d.l").alias("regularMarketDayLow"), price("d.c").alias("regularMarketPrice"),
        F.when(~odd, before).alias("regularMarketPreviousClose"), before.alias("previousClose"),
        F.lit(None).cast("double").alias("regularMarketChangePercent"), price("hi").alias("fiftyTwoWeekHigh"), price("lo").alias("fiftyTwoWeekLow"),
        F.col("d.v").alias("regularMarketVolume"), (F.col("d.v") * 1000).alias("marketCap"),
    )


class DailyTable:
    """The newest two days of each symbol before a date, kept in the folder ``path``; later days are added to it, earlier ones not read again.

    A version is written whole and then gets its name, the date up to which it goes. A run that fails leaves the version
    before it, and one that is repeated finds its version there.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, str(path)
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[str]:
        top = self._path(self.path)
        return sorted(n[5:] for n in (f.getPath().getName() for f in self._fs.listStatus(top)) if n.startswith("upto=")) if self._fs.exists(top) else []

    def state(self, before: str | None = None) -> tuple[DataFrame, str | None]:
        """Rows of the newest version, up to ``before`` at most, and its date; none at first."""
        there = [v for v in self.versions() if before is None or v <= before]
        if not there:
            return self.spark.createDataFrame([], DAY), None
        return self.spark.read.schema(DAY).parquet(f"{self.path}/upto={there[-1]}"), there[-1]

    def _with(self, ticks: DataFrame, until: Column, before: str | None = None) -> DataFrame:
        """The newest two days of each symbol: the version's, and those of the ticks since then. Only those are read."""
        kept, upto = self.state(before)
        since = F.lit("0001-01-01").cast("timestamp") if upto is None else b.day_range(upto)[0]
        return newest(kept.unionByName(days(b.between(ticks, since, until))))

    def advance(self, ticks: DataFrame, day: str) -> bool:
        """Make the version of all days before an Eastern date; False if there is one that goes as far."""
        if any(v >= day for v in self.versions()):
            return False
        draft = f"{self.path}/draft-{uuid.uuid4().hex}"
        self._with(ticks, b.day_range(day)[0]).write.parquet(draft)
        if not self._fs.rename(self._path(draft), self._path(f"{self.path}/upto={day}")):
            raise RuntimeError(f"can't name the version of {day}")
        return True

    def quotes(self, ticks: DataFrame, as_of: Column) -> DataFrame:
        """The quotes at an instant, from the version before its day and the ticks since."""
        day = self.spark.range(1).select(x.et_date(x.eastern(as_of))).first()[0]
        return quotes(self._with(ticks, as_of, day))

    def trim(self, keep: int = 7) -> int:
        """Drop all but the newest versions, and what runs that failed have left for over a day."""
        gone = 0
        for v in self.versions()[:-keep]:
            gone += bool(self._fs.delete(self._path(f"{self.path}/upto={v}"), True))
        old = self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis() - timedelta(days=1) // timedelta(milliseconds=1)
        for f in self._fs.listStatus(self._path(self.path)) if self._fs.exists(self._path(self.path)) else []:
            if f.getPath().getName().startswith("draft-") and f.getModificationTime() < old:
                gone += bool(self._fs.delete(f.getPath(), True))
        return gone


def dates(first: str, last: str, step: int = 1) -> list[str]:
    """Dates from the first to the last, ``step`` days apart."""
    a, z = date.fromisoformat(first), date.fromisoformat(last)
    return [(a + timedelta(days=k)).isoformat() for k in range(0, (z - a).days + 1, step)]
