"""A pluggable source of daily rows: a Spark data source over any function that fetches a range of dates.

``spark.dataSource.register(Daily)``, then ``spark.read.format("daily").option("fetch",
"package.module:function").option("symbol", ...).option("start", ...).option("end", ...)``.
The function gets (symbol, first, last, adjust) and yields rows (date, open, high, low, close,
volume, amount); it must be importable on the workers.  With the option source it gets that,
too, as a keyword.  A partition fetches a month, so a long range is fetched in parallel and a
lost task repeats one month.

``DailyPushed`` (``daily_pushed``) also takes filters on the date: months that they rule out
are not fetched, others only between the days that are left; a filter for another symbol
fetches nothing.  Spark asks it only with spark.sql.python.filterPushdown.enabled, and
refuses it without.
"""

from __future__ import annotations

import importlib
from datetime import date, timedelta

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "symbol string, date date, open double, high double, low double, close double, volume double, amount double"


class Month(InputPartition):
    def __init__(self, first: date, last: date):
        super().__init__(None)
        self.first, self.last = first, last


class Daily(DataSource):
    @classmethod
    def name(cls) -> str:
        return "daily"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return DailyReader(self.options)


class DailyReader(DataSourceReader):
    def __init__(self, options):
        missing = [k for k in ("fetch", "symbol", "start", "end") if k not in options]
        if missing:
            raise ValueError(f"options are missing: {', '.join(missing)}")
        self.fetch, self.symbol, self.adjust = options["fetch"], options["symbol"], options.get("adjust", "")
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])
        self.extra = {"source": options["source"]} if "source" in options else {}

    def partitions(self) -> list[Month]:
        out, first = [], self.start
        while first <= self.end:
            following = (first.replace(day=1) + timedelta(days=32)).replace(day=1)
            out.append(Month(first, min(self.end, following - timedelta(days=1))))
            first = following
        return out

    def read(self, partition: Month):
        module, _, name = self.fetch.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        for row in fetch(self.symbol, partition.first, partition.last, self.adjust, **self.extra):
            yield (self.symbol, *row)


class PushedReader(DailyReader):
    def pushFilters(self, filters: list[Filter]):
        """Narrow the range by what compares the date or the symbol with a value; give back all else."""
        one = timedelta(days=1)
        for f in filters:
            value = getattr(f, "value", None)
            if f.attribute == ("symbol",) and isinstance(f, EqualTo):
                if value != self.symbol:
                    self.end = self.start - one
            elif f.attribute == ("date",) and isinstance(value, date) and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                if not isinstance(f, (LessThan, LessThanOrEqual)):
                    self.start = max(self.start, value + one if isinstance(f, GreaterThan) else value)
                if not isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.end = min(self.end, value - one if isinstance(f, LessThan) else value)
            else:
                yield f


class DailyPushed(Daily):
    """The source ``daily_pushed``: filters are pushed into the range that is fetched."""

    @classmethod
    def name(cls) -> str:
        return "daily_pushed"

    def reader(self, schema) -> DataSourceReader:
        return PushedReader(self.options)


def stored_month(symbol: str, first: date, last: date, adjust: str, source: str):
    """Rows of a store of daily rows in folders by month (month=YYYY-MM), as sinks.write_table leaves them: one folder is read."""
    import pyarrow.compute as pc
    import pyarrow.dataset as ds
    from pyarrow.fs import FileSystem, FileType

    fs, base = FileSystem.from_uri(f"{source}/month={first:%Y-%m}")
    if fs.get_file_info(base).type == FileType.NotFound:
        return
    names = ["date", "open", "high", "low", "close", "volume", "amount"]
    wanted = (pc.field("code") == symbol) & (pc.field("date") >= first) & (pc.field("date") <= last)
    for batch in ds.dataset(base, filesystem=fs, format="parquet").to_batches(columns=names, filter=wanted):
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def made_up(symbol: str, first: date, last: date, adjust: str):
    """Rows by a formula of the date, for tests and as an example of a fetch function: weekdays only."""
    day = first
    while day <= last:
        if day.weekday() < 5:
            n = day.toordinal()
            price = 100.0 + n % 37
            yield day, price, price + 1.0, price - 1.0, price + 0.5, float(n % 11 * 100), (price + 0.5) * (n % 11 * 100)
        day += timedelta(days=1)
