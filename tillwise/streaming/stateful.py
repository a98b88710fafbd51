"""Orders and items joined by keyed state, with a log of changes that add up.

One operator holds, per order, the order row, its items by id and their running count and sum.
Each access to the state store is a message of the worker, so orders are keyed in ``GROUPS`` groups, and
the orders of a group lie in pages of about ``PAGE`` orders; a micro-batch reads and writes each page
it touches once. An order of up to ``FEW`` items lies there whole. The items of a
larger order are kept by id, so an item that comes to an order of a million items costs one item. What has changed is emitted with a sign,
the old row with -1 and the new one with +1, so amounts of any day are sums over the log, and the
present rows are those of the highest version of a key.

Spark writes rows as JSON before they go to the worker and reads the changes' JSON after it, since
values that pass one by one between both cost far more than the join; the worker takes a row's text as it is.
"""

from __future__ import annotations

import json
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tillwise import schemas
from tillwise.operators import enrich
from tillwise.sources.files import exists
from tillwise.streaming.incremental import change_log

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ARRIVED = T.StructField("arrived", T.LongType())
_TOTAL = T.DecimalType(22, 2)
_LINE_TOTAL = schemas.ORDER_ITEMS.names.index("line_total")
_ITEM_ID = schemas.ORDER_ITEMS.names.index("order_item_id")
_ITEM = T.StructType([*schemas.ORDER_ITEMS.fields, _ARRIVED])
#: Items of an order that are kept in one value with it.
FEW = 64
#: Groups of orders by hash; a checkpoint keeps the number it was begun with.
GROUPS = 4096
#: Orders of a page on average, at most; a group's pages double in number when it holds more.
PAGE = 128
#: Changes that go from the worker to Spark together, about.
CHUNK = 4096
_OWN = T.StructType([
    T.StructField("order", T.StructType([*schemas.ORDERS.fields, _ARRIVED])),
    T.StructField("n", T.LongType()), T.StructField("summed", T.LongType()), T.StructField("total", _TOTAL),
    T.StructField("version", T.LongType()), T.StructField("few", T.ArrayType(_ITEM))])

#: A change: an order's row with its sums (``order`` is set), or one of its items (``item`` is set).
CHANGES = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("sign", T.IntegerType()),
    T.StructField("version", T.LongType()), T.StructField("items_per_order", T.LongType()),
    T.StructField("order_items_total", _TOTAL), T.StructField("order", schemas.ORDERS),
    T.StructField("item", schemas.ORDER_ITEMS)])
_CHANGE_TEXT = T.StructType([T.StructField("change", T.StringType())])
_PAGE_VALUE = T.StructType([T.StructField("orders", T.BinaryType())])
_TEXT_ITEM = T.StructType([
    T.StructField("order_item_id", T.StringType()), T.StructField("cents", T.LongType()),
    T.StructField("body", T.StringType()), _ARRIVED])
_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_CHANGE, _ORDER_ROW, _ITEM_ROW = Row(*CHANGES.names), Row(*schemas.ORDERS.names), Row(*schemas.ORDER_ITEMS.names)


class JoinByOrder(StatefulProcessor):
    """State of a group's orders; a row counts if it arrived later than the one it replaces.

    Rows with the same ``arrived`` are decided by their values, so a result does not depend on the
    order inside a micro-batch, and a row that comes again as it is changes nothing.
    """

    def __init__(self, keep_ms: int | None = None):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        text = T.StringType()
        own = T.StructType([T.StructField("order_id", text)])
        name = T.StructType([T.StructField("order_id", text), T.StructField("order_item_id", text)])
        self.own = handle.getMapState("own", own, _OWN, self.keep_ms)
        self.items = handle.getMapState("items", name, _ITEM, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held: dict[str, _Order] = {}
        for row in rows:
            order = held.get(row["order_id"])
            if order is None:
                order = held[row["order_id"]] = _Order(row["order_id"], self.own, self.items)
            yield from order.take(row)
        for order in held.values():
            yield from order.close()

    def close(self) -> None:
        pass


class _Order:
    """One order while a micro-batch is handled."""

    #: Places of an item's id and amount among its values, and the sum of no amounts.
    ID, AMOUNT, NOTHING = _ITEM_ID, _LINE_TOTAL, Decimal(0)

    def __init__(self, order_id: str, own, items):
        self.id, self._own, self._items = order_id, own, items
        known = own.getValue((order_id,))
        order, self.n, self.summed, self.total, self.version, few = (
            (None, 0, 0, self.NOTHING, 0, []) if known is None else known)
        self.order = None if order is None else tuple(order)
        self.few = None if few is None else {values[self.ID]: tuple(values) for values in few}
        self._before = self._contributed()

    @staticmethod
    def _values(row) -> tuple[tuple | None, tuple | None]:
        """The order of a row, or else its item; the arrival comes last."""
        item = row["item"]
        if item is None:
            return (*[row["order"][c] for c in schemas.ORDERS.names], row["arrived"]), None
        return None, (*[item[c] for c in schemas.ORDER_ITEMS.names], row["arrived"])

    @staticmethod
    def _shown(values: tuple) -> str:
        """Decides between rows of the same arrival."""
        return repr(values[:-1])

    def _newer(self, new: tuple, old: tuple | None) -> bool:
        """Later arrival; of the same arrival, the larger values."""
        if old is None or new[-1] > old[-1]:
            return True
        return new[-1] == old[-1] and self._shown(new) > self._shown(old)

    def _changed(self, *change, **row):
        return _change(self.id, *change, **row)

    def _contributed(self) -> tuple | None:
        """An order without items, and items without an order, are in no fact."""
        if self.order is None or self.n == 0:
            return None
        return self.order[:-1], self.n, self.total if self.summed else None

    def _old(self, name: str) -> tuple | None:
        if self.few is not None:
            return self.few.get(name)
        old = self._items.getValue((self.id, name))
        return None if old is None else tuple(old)

    def _keep(self, name: str, new: tuple) -> None:
        if self.few is None:
            self._items.updateValue((self.id, name), new)
            return
        self.few[name] = new
        if len(self.few) > FEW:
            for moved, values in self.few.items():
                self._items.updateValue((self.id, moved), values)
            self.few = None

    def take(self, row) -> Iterator[Row]:
        order, new = self._values(row)
        if new is None:
            if self._newer(order, self.order):
                self.order = order
            return
        name = new[self.ID]
        old = self._old(name)
        if not self._newer(new, old):
            return
        self._keep(name, new)
        if old is not None and old[:-1] == new[:-1]:
            return
        for sign, values in ((-1, old), (1, new)):
            if values is not None:
                self.n += sign
                if values[self.AMOUNT] is not None:
                    self.summed, self.total = self.summed + sign, self.total + sign * values[self.AMOUNT]
                self.version += 1
                yield self._changed(sign, self.version, item=values[:-1])

    def close(self) -> Iterator[Row]:
        after = self._contributed()
        if self._before != after:
            for sign, values in ((-1, self._before), (1, after)):
                if values is not None:
                    self.version += 1
                    yield self._changed(sign, self.version, *values)
        few = None if self.few is None else list(self.few.values())
        self._own.updateValue((self.id,), (self.order, self.n, self.summed, self.total, self.version, few))


def _change(order_id, sign, version, order=None, n=None, total=None, item=None) -> Row:
    return _CHANGE(order_id, sign, version, n, total,
                   None if order is None else _ORDER_ROW(*order), None if item is None else _ITEM_ROW(*item))


class JoinInPages(JoinByOrder):
    """The same join over frames of text, with the state in pages.

    A row is its group, a JSON head with order id (``o``), arrival (``a``) and, of an item, its id (``i``) and amount in
    cents (``c``), and a JSON body with all its values. Out come frames of about ``CHUNK`` changes, each a JSON text.
    With ``keep_ms`` each order carries the time of its last row, and a page or group that got none for so long goes.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        text = T.StringType()
        page = T.StructType([T.StructField("page", T.IntegerType())])
        name = T.StructType([T.StructField("order_id", text), T.StructField("order_item_id", text)])
        self.pages = handle.getMapState("pages", page, _PAGE_VALUE, self.keep_ms)
        self.items = handle.getMapState("items", name, _TEXT_ITEM, self.keep_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = 0 if self.keep_ms is None else timerValues.getCurrentProcessingTimeInMs()
        own = _Pages(self.pages, now, self.keep_ms)
        held: dict[str, _TextOrder] = {}
        changes: list[str] = []
        for frame in rows:
            heads = json.loads(f"[{','.join(frame['head'])}]")
            for head, body in zip(heads, frame["body"]):
                name = head["o"]
                order = held.get(name)
                if order is None:
                    order = held[name] = _TextOrder(name, own, self.items)
                changes.extend(order.take((head, body)))
            if len(changes) >= CHUNK:
                yield pd.DataFrame({"change": changes})
                changes = []
        for order in held.values():
            changes.extend(order.close())
            if len(changes) >= CHUNK:
                yield pd.DataFrame({"change": changes})
                changes = []
        if changes:
            yield pd.DataFrame({"change": changes})
        own.write()


class _TextOrder(_Order):
    """An order whose values are (text, arrived) and an item's (id, cents, text, arrived)."""

    ID, AMOUNT, NOTHING = 0, 1, 0

    def __init__(self, order_id: str, own, items):
        super().__init__(order_id, own, items)
        self._start = f'{{"order_id":{json.dumps(order_id)},"sign":'

    @staticmethod
    def _values(row):
        head, body = row
        if "i" in head:
            return None, (head["i"], head.get("c"), body, head.get("a"))
        return (body, head.get("a")), None

    @staticmethod
    def _shown(values):
        schema = schemas.ORDERS if len(values) == 2 else schemas.ORDER_ITEMS
        known = json.loads(values[-2], parse_float=Decimal)
        return repr(tuple(_EPOCH + timedelta(microseconds=known[f.name]) if f.name in known and isinstance(
            f.dataType, T.TimestampType) else known.get(f.name) for f in schema))

    def _newer(self, new, old):
        # The text is the same where all values are, so only other values need to be read.
        return super()._newer(new, old) if old is None or new[:-1] != old[:-1] else new[-1] > old[-1]

    def _changed(self, sign, version, order=None, n=None, cents=None, item=None):
        if item is not None:
            return f'{self._start}{sign},"version":{version},"item":{item[-1]}}}'
        total = "null" if cents is None else _decimal(cents)
        return (f'{self._start}{sign},"version":{version},"items_per_order":{n},'
                f'"order_items_total":{total},"order":{order[-1]}}}')


def _decimal(cents: int) -> str:
    whole, part = divmod(abs(cents), 100)
    return f"{'-' if cents < 0 else ''}{whole}.{part:02d}"


class _Pages:
    """The orders of a group in 2 ** ``level`` pages by hash, read when first asked for and written together.

    Page -1 holds the level and the number of orders. When orders outgrow the pages, all of the group
    are dealt anew to twice as many or more, so an order is moved a bounded number of times on average.
    """

    def __init__(self, state, now: int, keep_ms: int | None):
        self._state, self._now, self._keep = state, now, keep_ms
        self._held: dict[int, dict[str, tuple]] = {}
        self._changed: set[int] = set()
        self._level, self._orders = self._read(-1) or (0, 0)

    def _read(self, page: int):
        value = self._state.getValue((page,))
        return None if value is None else pickle.loads(zlib.decompress(value[0]))

    def _write(self, page: int, value) -> None:
        self._state.updateValue((page,), (zlib.compress(pickle.dumps(value, pickle.HIGHEST_PROTOCOL), 1),))

    def _page(self, order_id: str) -> int:
        return zlib.crc32(order_id.encode("utf-8", "surrogatepass")) & ((1 << self._level) - 1)

    def _orders_of(self, page: int) -> dict[str, tuple]:
        held = self._held.get(page)
        if held is None:
            held = self._held[page] = self._read(page) or {}
            if self._keep is not None:
                old = [name for name, (_, at) in held.items() if at + self._keep <= self._now]
                for name in old:
                    del held[name]
                self._orders -= len(old)
        return held

    def getValue(self, key: tuple) -> tuple | None:
        found = self._orders_of(self._page(key[0])).get(key[0])
        return None if found is None else found[0]

    def updateValue(self, key: tuple, value: tuple) -> None:
        page = self._page(key[0])
        held = self._orders_of(page)
        self._orders += key[0] not in held
        held[key[0]] = (value, self._now)
        self._changed.add(page)

    def write(self) -> None:
        """Write the pages that have changed, or all of them where they are too few for the orders."""
        level = self._level
        while self._orders > PAGE << level:
            level += 1
        if level > self._level:
            orders = [o for page in range(1 << self._level) for o in self._orders_of(page).items()]
            self._level, self._orders, self._held = level, len(orders), {}
            for name, found in orders:
                self._held.setdefault(self._page(name), {})[name] = found
            self._changed = set(self._held)
        for page in self._changed:
            self._write(page, self._held[page])
        self._write(-1, (self._level, self._orders))


def _text(schema: T.StructType) -> T.StructType:
    """The schema with times as whole numbers of microseconds."""
    return T.StructType([T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.TimestampType) else f.dataType)
                         for f in schema])


def _body(schema: T.StructType):
    """The declared values of a row as JSON."""
    def plain(f):
        value = F.col(f.name).cast(f.dataType)
        return (F.unix_micros(value) if isinstance(f.dataType, T.TimestampType) else value).alias(f.name)

    return F.to_json(F.struct(*[plain(f) for f in schema]))


def _typed(name: str, schema: T.StructType):
    """The struct of a body that was read, or NULL."""
    fields = [(F.timestamp_micros(F.col(f"{name}.{f.name}")) if isinstance(f.dataType, T.TimestampType)
               else F.col(f"{name}.{f.name}")).alias(f.name) for f in schema]
    return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)


def joined_changes(orders: DataFrame, items: DataFrame, keep_ms: int | None = None) -> DataFrame:
    """Signed changes from streams of orders and items, each with a long column ``arrived``.

    Rows without a key are left out; an item belongs to its order for good; columns beyond the
    declared ones are not kept. With ``keep_ms`` the state of an order that got no row for so long is
    forgotten, such as items whose order never comes; without it all is kept. The session must use
    the RocksDB state store, as :meth:`StatefulMarts.run` does.
    """
    known = F.col("order_id").isNotNull()
    group = F.pmod(F.xxhash64("order_id"), F.lit(GROUPS)).alias("group")
    own = [F.col("order_id").cast("string").alias("o"), F.col("arrived").cast("long").alias("a")]
    cents = (F.col("line_total").cast(_ITEM["line_total"].dataType) * F.lit(100)).cast("long")
    named = [F.col("order_item_id").cast("string").alias("i"), cents.alias("c")]
    left = orders.filter(known).select(
        group, F.to_json(F.struct(*own)).alias("head"), _body(schemas.ORDERS).alias("body"))
    right = items.filter(known & F.col("order_item_id").isNotNull()).select(
        group, F.to_json(F.struct(*own, *named)).alias("head"), _body(schemas.ORDER_ITEMS).alias("body"))
    written = left.unionByName(right).groupBy("group").transformWithStateInPandas(
        statefulProcessor=JoinInPages(keep_ms), outputStructType=_CHANGE_TEXT, outputMode="Append",
        timeMode="None" if keep_ms is None else "ProcessingTime")
    shape = T.StructType([T.StructField(f.name, _text(f.dataType)) if f.name in ("order", "item") else f for f in CHANGES])
    read = F.from_json("change", shape, {"mode": "FAILFAST"}).alias("change")
    rows = written.select(read).select("change.*")
    return rows.select(*[_typed(f.name, f.dataType) if f.name in ("order", "item") else f.name for f in CHANGES])


@dataclass
class StatefulMarts:
    """The log of changes below ``root``, and the fact and daily figures read from it.

    Each micro-batch writes a folder of its own, which a replay replaces.
    """

    spark: SparkSession
    root: str
    keep_ms: int | None = None

    def run(self, orders: DataFrame, items: DataFrame, checkpoint: str) -> None:
        """Process everything that has arrived on both streams."""
        before = self.spark.conf.get(_PROVIDER)
        self.spark.conf.set(_PROVIDER, _ROCKSDB)
        try:
            change_log(joined_changes(orders, items, self.keep_ms), f"{self.root}/changes", checkpoint).awaitTermination()
        finally:
            self.spark.conf.set(_PROVIDER, before)

    def changes(self) -> DataFrame:
        if not exists(self.spark, f"{self.root}/changes"):
            return self.spark.createDataFrame([], CHANGES)
        return self.spark.read.schema(CHANGES).parquet(f"{self.root}/changes")

    def _present(self, kind: str, key: str) -> DataFrame:
        """The row of the highest version of each key; a log of one batch or of many gives the same."""
        rest = [c for c in ("items_per_order", "order_items_total") if kind == "order"]
        log = self.changes().filter(F.col(kind).isNotNull()).select(
            F.col(key).alias("key"), "version", F.struct("sign", *rest, kind).alias("row"))
        last = log.groupBy("key").agg(F.max_by("row", "version").alias("row")).filter("row.sign > 0")
        return last.select(*[f"row.{c}" for c in rest], f"row.{kind}.*")

    def orders(self) -> DataFrame:
        """One row per order that has items, with their count and total."""
        return self._present("order", "order_id")

    def fact(self) -> DataFrame:
        """One row per item with its order, as :func:`enrich.fact_orders` gives, sums from the state."""
        orders = self.orders()
        sums = orders.select("order_id", "items_per_order", "order_items_total")
        items = enrich.enriched_order_items(self._present("item", "item.order_item_id"))
        return enrich.enriched_orders(orders).join(sums, "order_id").join(items, "order_id")

    def daily_sums(self) -> DataFrame:
        """Orders, item rows and amounts of each day, added over the log without finding present rows."""
        sign = F.col("sign")
        own = self.changes().filter(F.col("order").isNotNull())
        return own.groupBy(F.to_date("order.order_date").alias("order_date_only")).agg(
            F.sum(sign).alias("total_orders"),
            F.sum(sign * F.col("items_per_order")).alias("item_rows"),
            F.sum(sign * F.col("items_per_order") * F.col("order.total_amount")).alias("total_revenue"),
            F.sum(sign * F.col("order_items_total")).alias("items_total"),
        ).filter("total_orders <> 0")
