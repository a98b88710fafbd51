import json
import random
from datetime import datetime, timezone
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise import schemas
from tillwise.operators import enrich
from tillwise.streaming import stateful
from tillwise.streaming.stateful import FEW, JoinByOrder, StatefulMarts


@pytest.fixture
def feed(spark, folder):
    """Append a batch of orders and items and process it, as after a restart."""
    def arrive(orders, items, at):
        for name, df in (("orders", orders), ("items", items)):
            df.withColumn("arrived", F.lit(at).cast("long")).coalesce(1).write.mode("append").parquet(f"{folder}/in/{name}")
        marts = StatefulMarts(spark, f"{folder}/out")

        def read(name, schema):
            return spark.readStream.schema(schema.add("arrived", "long")).parquet(f"{folder}/in/{name}")

        marts.run(read("orders", _copy(schemas.ORDERS)), read("items", _copy(schemas.ORDER_ITEMS)), f"{folder}/cp")
        return marts

    return arrive


def _copy(schema):
    return type(schema)(list(schema.fields))


def agree(marts, orders, items):
    full = enrich.fact_orders(enrich.enriched_orders(orders), enrich.enriched_order_items(items))
    got = marts.fact().select(*full.columns)
    assert got.count() == full.count() and got.exceptAll(full).count() == 0
    daily = enrich.daily_business_metrics(full).select("order_date_only", "total_orders", "total_revenue")
    sums = marts.daily_sums().select(*daily.columns)
    assert sums.count() == daily.count() and sums.exceptAll(daily).count() == 0


def test_equals_rebuild_whatever_the_order_of_arrival(spark, tables, feed):
    """Items before their orders, an order that comes again on another day, a changed item."""
    orders = tables.orders.filter("order_date >= DATE '2001-07-20'").cache()
    items = tables.order_items.join(orders.select("order_id"), "order_id", "left_semi").select(
        *tables.order_items.columns).cache()
    total = items.count()
    marts = feed(orders.limit(0), items, 0)
    assert marts.fact().count() == 0 and marts.changes().count() == total
    odd = spark.createDataFrame([(None, 1, None, "Pending", None, None, None)], schemas.ORDERS)
    marts = feed(orders.unionByName(odd), items.limit(0), 1)
    agree(marts, orders, items)

    written = marts.changes().count()
    one = orders.orderBy("order_id").limit(1)
    moved = one.withColumns({"order_date": F.col("order_date") - F.expr("INTERVAL 40 DAYS"), "order_status": F.lit("Changed")})
    changed = items.orderBy("order_item_id").limit(1).withColumn("line_total", F.lit(None).cast("decimal(12,2)"))
    marts = feed(moved, changed, 2)
    # Two rows per order and per item that changed, however large the table is.
    assert marts.changes().count() - written <= 6
    now = orders.join(one.select("order_id"), "order_id", "left_anti").select(*orders.columns).unionByName(moved)
    lines = items.join(changed.select("order_item_id"), "order_item_id", "left_anti").select(*items.columns).unionByName(
        changed)
    agree(marts, now, lines)

    # What comes again changes nothing, nor does what is older than the state.
    written = marts.changes().count()
    marts = feed(orders, items, 0)
    assert marts.changes().count() == written
    agree(marts, now, lines)


def test_nothing_arrived(spark, folder):
    marts = StatefulMarts(spark, folder)
    assert marts.fact().count() == 0 and marts.daily_sums().count() == 0


class _Counted:
    """A map that counts how often it is read or written."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getValue(self, key):
        self.calls += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.held[key] = value


class _Handle:
    def __init__(self):
        self.own, self.items = _Counted(), _Counted()

    def getMapState(self, name, key, schema, ttl=None):
        return getattr(self, name)


def _arrivals(numbers, arrived, total="1.00"):
    return [{"order_id": "o", "arrived": arrived, "order": None, "item": dict(zip(
        schemas.ORDER_ITEMS.names, (f"i{i}", "o", 1, "p", "c", 1, Decimal("1.00"), Decimal(total))))} for i in numbers]


def test_state_of_a_small_order_is_read_and_written_once_a_batch():
    handle, join = _Handle(), JoinByOrder()
    join.init(handle)
    got = list(join.handleInputRows((0,), iter(_arrivals(range(FEW), 0)), None))
    assert len(got) == FEW and handle.own.calls == 2 and handle.items.calls == 0


def test_order_that_grows_past_the_few(spark):
    """Its items are then kept by id, one read and one write each; sums and versions go on."""
    handle, join = _Handle(), JoinByOrder()
    join.init(handle)
    list(join.handleInputRows((0,), iter(_arrivals(range(FEW), 0)), None))
    list(join.handleInputRows((0,), iter(_arrivals(range(FEW, FEW + 10), 1)), None))
    assert len(handle.items.held) == FEW + 10 and handle.own.held[("o",)][-1] is None
    calls = handle.items.calls
    got = list(join.handleInputRows((0,), iter(_arrivals([3], 2, "5.00") + _arrivals([4], 0)), None))
    assert handle.items.calls - calls == 3
    assert [(r.sign, r.item.line_total) for r in got] == [(-1, Decimal("1.00")), (1, Decimal("5.00"))]
    _order, n, summed, total, version, few = handle.own.held[("o",)]
    assert (n, summed, total, version, few) == (FEW + 10, FEW + 10, Decimal(FEW + 14), FEW + 12, None)


def test_large_order_equals_rebuild(spark, feed):
    """An order of more items than the few, over three batches, one of which moves its items."""
    orders = spark.createDataFrame(
        [("o", 1, datetime(2001, 1, 1), "Pending", Decimal("9.00"), Decimal(0), Decimal(1))], schemas.ORDERS)
    lines = [(f"i{i}", "o", 1, "p", "c", 1, Decimal("1.00"), Decimal(i)) for i in range(3 * FEW)]
    parts = [spark.createDataFrame(lines[i * FEW - (i > 0):(i + 1) * FEW], schemas.ORDER_ITEMS) for i in range(3)]
    for at, part in enumerate(parts):
        marts = feed(orders, part, at)
    agree(marts, orders, spark.createDataFrame(lines, schemas.ORDER_ITEMS))


class _PagesHandle:
    def __init__(self):
        self.maps = {}

    def getMapState(self, name, key, schema, ttl=None):
        return self.maps.setdefault(name, _Counted())


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms


_DAY = datetime(2001, 1, 1, tzinfo=timezone.utc)


def _order(order_id, arrived, amount="9.00", status="Pending"):
    return {"order_id": order_id, "arrived": arrived, "item": None, "order": dict(zip(
        schemas.ORDERS.names, (order_id, 1, _DAY, status, Decimal(amount), None, Decimal("1.00"))))}


def _line(order_id, name, arrived, total="1.00"):
    return {"order_id": order_id, "arrived": arrived, "order": None, "item": dict(zip(
        schemas.ORDER_ITEMS.names, (name, order_id, 1, "p", "c", 1, Decimal("1.00"), None if total is None else Decimal(total))))}


def _frame(rows):
    """The rows as the worker gets them."""
    def text(values):
        known = {k: v if not isinstance(v, datetime) else int(v.timestamp()) * 10**6 for k, v in values.items() if v is not None}
        parts = [f"{json.dumps(k)}:{v if isinstance(v, Decimal) else json.dumps(v)}" for k, v in known.items()]
        return f"{{{','.join(parts)}}}"

    heads = []
    for r in rows:
        head = {"o": r["order_id"], "a": r["arrived"]}
        if r["item"]:
            total = r["item"]["line_total"]
            head |= {"i": r["item"]["order_item_id"]} | ({} if total is None else {"c": int(total * 100)})
        heads.append(json.dumps(head))
    return pd.DataFrame({"group": 0, "head": heads, "body": [text(r["item"] or r["order"]) for r in rows]})


def _joined(join, rows, clock=None):
    """Changes as tuples."""
    out = []
    for frame in join.handleInputRows((0,), iter([_frame(rows[:7]), _frame(rows[7:])]), clock):
        for change in map(lambda c: json.loads(c, parse_float=Decimal), frame["change"]):
            kind, schema = ("item", schemas.ORDER_ITEMS) if "item" in change else ("order", schemas.ORDERS)
            values = [change[kind].get(c) for c in schema.names]
            if kind == "order":
                values[2] = datetime.fromtimestamp(values[2] // 10**6, timezone.utc)
            out.append((change["order_id"], change["sign"], change["version"], change.get("items_per_order"),
                        change.get("order_items_total"), kind, tuple(values)))
    return out


def test_pages_give_the_changes_of_the_plain_join(monkeypatch):
    """Repeated rows, ties of arrival, orders beyond the few, pages that double: the same changes in the same order."""
    monkeypatch.setattr(stateful, "FEW", 5)
    monkeypatch.setattr(stateful, "PAGE", 4, raising=False)
    draw = random.Random(3)
    plain_state, paged_state = _Handle(), _PagesHandle()
    for batch in range(12):
        plain, paged = JoinByOrder(), stateful.JoinInPages()
        plain.init(plain_state)
        paged.init(paged_state)
        rows = []
        for _ in range(60):
            order, arrived = f"o{draw.randrange(3 + 5 * batch)}", draw.randrange(batch + 1)
            if draw.random() < 0.3:
                rows.append(_order(order, arrived, draw.choice(["9.00", "10.00", "-0.05"]), draw.choice(["a", "b"])))
            else:
                rows.append(_line(order, f"{order}-{draw.randrange(8)}", arrived, draw.choice([None, "2.50", "-0.07"])))
        want = []
        for r in plain.handleInputRows((0,), iter(rows), None):
            kind = "order" if r.order is not None else "item"
            want.append((r.order_id, r.sign, r.version, r.items_per_order, r.order_items_total, kind, tuple(r[kind])))
        assert _joined(paged, rows) == want
    level, orders = stateful._Pages(paged_state.maps["pages"], 0, None)._read(-1)
    assert orders == len(plain_state.own.held) and 4 << level >= orders > 4


def test_orders_of_a_group_share_their_messages():
    """A thousand orders cost a few reads and writes of pages, not two each."""
    state = _PagesHandle()
    for rows in ([_line(f"o{i}", f"i{i}", 0) for i in range(1000)], [_order(f"o{i}", 1) for i in range(1000)]):
        join = stateful.JoinInPages()
        join.init(state)
        before = state.getMapState("pages", None, None).calls
        assert len(_joined(join, rows)) == 1000
        assert state.maps["pages"].calls - before < 50 and state.maps["items"].calls == 0


def test_orders_without_rows_for_long_are_forgotten():
    state = _PagesHandle()
    for at, rows in ((0, [_line("o", "i", 0), _line("p", "j", 0)]), (60, [_line("p", "k", 0)])):
        join = stateful.JoinInPages(100)
        join.init(state)
        _joined(join, rows, _Clock(at))
    join.init(state)
    got = _joined(join, [_order("o", 1), _order("p", 1)], _Clock(120))
    assert [(c[0], c[3]) for c in got] == [("p", 2)]
