"""Table-state operators: upsert, mirror, reconcile, evolve, as-of, lineage.

Plain files cannot be updated in place, so every operator returns the new state of
the table as a DataFrame together with what happened to its rows; the caller writes
it to a new directory (see ``tillwise.sources.files.write_version``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.semantics import days_before, first_per_key, strict_least
from tillwise.sources.files import write_version

ACTION = "__action"

# Discount rule (minimum amount, added points), cap and window.
DISCOUNT_STEPS = [(1000, 5.0), (500, 2.5)]
DISCOUNT_CAP = 50.0
DISCOUNT_DAYS = 30


@dataclass(frozen=True)
class MergeResult:
    """New table state with the action that produced each row."""

    classified: DataFrame

    @property
    def table(self) -> DataFrame:
        return self.classified.filter(F.col(ACTION) != "delete").drop(ACTION)

    def counts(self) -> DataFrame:
        """One row: inserted, updated, deleted, unchanged and merged rows."""

        def n(*actions):
            return F.count_if(F.col(ACTION).isin(*actions))

        return self.classified.agg(
            n("insert").alias("inserted"), n("update").alias("updated"), n("delete").alias("deleted"),
            n("keep").alias("unchanged"), n("insert", "update").alias("records_merged"))


def write_merge(result: MergeResult, root: str) -> dict:
    """Write the new table state as the next version and report counts and duration."""
    start = datetime.now(timezone.utc)
    path = write_version(result.table, root)
    counts = result.counts().first().asDict()
    end = datetime.now(timezone.utc)
    return {**counts, "path": path, "start_time": start, "end_time": end,
            "duration_ms": int((end - start).total_seconds() * 1000)}


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by ``order``; all other columns break ties, so the result is fixed."""
    named = set(keys)
    tie = [F.col(c).desc_nulls_last() for c in df.columns if c not in named]
    return first_per_key(df, keys, [*order, *tie])


def dedupe_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, picked by the whole payload."""
    return dedupe_latest(df, keys, [])


def duplicate_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Rows beyond the first of each key, equal rows folded into ``extra_copies``.

    Equal rows are counted before anything is ordered, so a key that repeats very
    often costs one row per distinct payload.
    """
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    named = set(keys)
    tie = [F.col(c).desc_nulls_last() for c in df.columns if c not in named]
    payload = F.struct(*df.columns)
    winners = first_per_key(rows, keys, [*order, *tie]).select(
        *[F.col(k).alias(f"__k_{k}") for k in keys], payload.alias("__kept"))
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys])
    kept = payload.eqNullSafe(F.col("__kept")).cast("int")
    return rows.join(winners, same_key).withColumn("extra_copies", F.col("copies") - kept).filter(
        F.col("extra_copies") > 0).select(*df.columns, "extra_copies")


def _sides(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Target and source as (key, struct) with the source cast to the target's types."""
    present = [c for c in target.columns if c in source.columns]
    t = target.select(F.col(key).alias("__tk"), F.struct(*target.columns).alias("__t"))
    s = source.select(F.col(key).alias("__sk"), F.struct(*[
        F.col(c).cast(target.schema[c].dataType).alias(c) for c in present]).alias("__s"))
    return t, s, present


def _merged(joined: DataFrame, target: DataFrame, action: Column, present: Sequence[str],
            changed: Sequence[str]) -> DataFrame:
    """Final columns of joined (target, source) rows under an action."""
    out = []
    marked = joined.withColumn(ACTION, action)
    for f in target.schema:
        old = F.col(f"__t.{f.name}")
        new = F.col(f"__s.{f.name}") if f.name in present else F.lit(None)
        replaced = ["insert", "update"] if f.name in changed else ["insert"]
        out.append(F.when(F.col(ACTION).isin(*replaced), new).otherwise(old).cast(f.dataType).alias(f.name))
    return marked.select(*out, ACTION)


def _merge(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str] | None,
           update: Sequence[str] | None, delete_missing: bool = False) -> DataFrame:
    """Classified rows of an upsert.

    The source is looked up from the target's side, and its new keys are those the target
    does not hold. Spark broadcasts a source of a few rows by itself, and a merge into a
    very large table then neither shuffles nor sorts that table; for a large source the second
    look at the target reads its key only. A mirror needs both sides whole: one full outer join.
    """
    t, s, present = _sides(target, source, key)
    changed = present if update is None else update
    differs = F.lit(True) if tracked is None else reduce(lambda a, b: a | b, [
        ~F.col(f"__t.{c}").eqNullSafe(F.col(f"__s.{c}")) for c in tracked])
    same_key = F.col("__tk") == F.col("__sk")
    has_t, has_s = F.col("__tk").isNotNull(), F.col("__sk").isNotNull()
    if not delete_missing:
        action = F.when(has_s & differs, "update").otherwise("keep")
        old = _merged(t.join(s, same_key, "left"), target, action, present, changed)
        known = t.select("__tk").join(s.select("__sk"), same_key, "left_semi")
        fresh = s.join(known, same_key, "left_anti").withColumn("__t", F.lit(None).cast(t.schema["__t"].dataType))
        return old.unionByName(_merged(fresh, target, F.lit("insert"), present, changed))
    action = F.when(has_t & has_s, F.when(differs, "update").otherwise("keep")).when(has_s, "insert").otherwise(
        "delete" if delete_missing else "keep")
    return _merged(t.join(s, same_key, "full_outer"), target, action, present, changed)


def merge_upsert(target: DataFrame, source: DataFrame, key: str, order: Sequence[Column] = (),
                 update: Sequence[str] | None = None) -> MergeResult:
    """Update matching rows, insert the rest; the source is deduplicated first.

    Rows without a key cannot match; they are kept in the target and left out of the source.
    """
    clean = dedupe_latest(source.filter(F.col(key).isNotNull()), [key], order)
    return MergeResult(_merge(target, clean, key, None, update))


def merge_changed(target: DataFrame, source: DataFrame, key: str, tracked: Sequence[str]) -> MergeResult:
    """Like :func:`merge_upsert`, but a row only counts as updated when a tracked column changed.

    The comparison is null-safe, so a change from or to NULL is seen.
    """
    clean = dedupe_any(source.filter(F.col(key).isNotNull()), [key])
    return MergeResult(_merge(target, clean, key, tracked, None))


def mirror_sync(target: DataFrame, source: DataFrame, key: str) -> MergeResult:
    """Make the target equal the source: upsert all, delete what the source lost."""
    clean = dedupe_any(source.filter(F.col(key).isNotNull()), [key])
    return MergeResult(_merge(target.filter(F.col(key).isNotNull()), clean, key, None, None, True))


def missing_in_source(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key the source no longer holds; NULL keys match nothing."""
    return target.filter(F.col(key).isNotNull()).join(
        source.select(key).filter(F.col(key).isNotNull()), key, "left_anti")


# --- conditional updates ---------------------------------------------------------------

def apply_discounts(orders: DataFrame, as_of: date | str, days: int = DISCOUNT_DAYS) -> MergeResult:
    """Raise the discount of recent large orders, up to a cap."""
    amount, pct = F.col("total_amount"), F.col("discount_percent")
    kind = orders.schema["discount_percent"].dataType
    raised = None
    for limit, points in DISCOUNT_STEPS:
        value = strict_least(pct + F.lit(points), F.lit(DISCOUNT_CAP)).cast(kind)
        raised = F.when(amount >= limit, value) if raised is None else raised.when(amount >= limit, value)
    touched = F.coalesce((F.col("order_date") >= days_before(as_of, days)) & (pct < DISCOUNT_CAP), F.lit(False))
    return MergeResult(orders.withColumns({
        ACTION: F.when(touched, "update").otherwise("keep"),
        "discount_percent": F.when(touched, raised.otherwise(pct)).otherwise(pct),
    }))


def snapshot(orders: DataFrame, as_of: date | str, days: int = DISCOUNT_DAYS) -> DataFrame:
    """Discounts of recent orders, to be restored later."""
    return orders.filter(F.col("order_date") >= days_before(as_of, days)).select("order_id", "discount_percent")


def restore_discounts(orders: DataFrame, saved: DataFrame) -> DataFrame:
    """Put snapshot discounts back; orders outside the snapshot keep theirs."""
    s = saved.select("order_id", F.col("discount_percent").alias("__saved"), F.lit(True).alias("__hit"))
    kind = orders.schema["discount_percent"].dataType
    return orders.join(s, "order_id", "left").withColumn(
        "discount_percent", F.when(F.col("__hit"), F.col("__saved").cast(kind)).otherwise(F.col("discount_percent"))
    ).select(*orders.columns)


def update_where_in(df: DataFrame, key: str, keys: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns on rows whose key occurs in another relation."""
    hit = keys.select(F.col(key)).distinct().withColumn("__hit", F.lit(True))
    joined = df.join(hit, key, "left")
    return joined.withColumns({
        c: F.when(F.col("__hit"), v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in changes.items()
    }).select(*df.columns)


def delete_where_in(df: DataFrame, key: str, keys: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Drop rows whose key occurs in another relation and that meet a predicate."""
    hit = keys.select(F.col(key)).distinct().withColumn("__hit", F.lit(True))
    gone = F.coalesce(F.col("__hit"), F.lit(False))
    if predicate is not None:
        gone = gone & F.coalesce(predicate, F.lit(False))
    return df.join(hit, key, "left").filter(~gone).select(*df.columns)


def update_partitions(df: DataFrame, partition: str, values: Sequence, column: str, value: Column) -> DataFrame:
    """Recompute one column in some partitions, in a single pass."""
    return df.withColumn(column, F.when(F.col(partition).isin(*values), value).otherwise(F.col(column))
                         .cast(df.schema[column].dataType))


def incremental_append(target: DataFrame, source: DataFrame, ts: str) -> DataFrame:
    """Target plus the source rows newer than its newest row; all rows when it is empty."""
    newest = target.agg(F.max(ts)).scalar()
    return target.unionByName(source.filter(newest.isNull() | (F.col(ts) > newest)))


def append_counts(batches: Sequence[DataFrame]) -> DataFrame:
    """Rows of each appended batch and their sum."""
    parts = [b.agg(F.count("*").alias("rows_inserted")).withColumn("batch", F.lit(i))
             for i, b in enumerate(batches, 1)]
    return reduce(DataFrame.unionByName, parts).agg(
        F.count("*").alias("batches"), F.sum("rows_inserted").alias("total_rows_inserted"))


def staging_counts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Rows waiting in staging."""
    pending = items.agg(F.count("*")).scalar()
    return orders.agg(F.count("*").alias("orders_staging")).withColumn("order_items_staging", pending).withColumn(
        "total_pending", F.col("orders_staging") + F.col("order_items_staging"))


def truncate(df: DataFrame) -> DataFrame:
    """Empty table of the same schema."""
    return df.limit(0)


# --- reconcile -----------------------------------------------------------------------------

def orphan_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items.select("order_id"), "order_id", "left_anti").select(*orders.columns)


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders.select("order_id"), "order_id", "left_anti").select(*items.columns)


@dataclass(frozen=True)
class Reconciled:
    orders: DataFrame
    items: DataFrame
    stats: DataFrame


def reconcile(orders: DataFrame, items: DataFrame) -> Reconciled:
    """Drop repeated orders, orders without items and items without an order.

    One copy of each order is kept before orphans are sought, so cleaning a second
    time finds nothing.
    """
    unique = dedupe_latest(orders, ["order_id"], [F.asc("order_date")])
    good_orders = unique.join(items.select("order_id"), "order_id", "left_semi").select(*orders.columns)
    good_items = items.join(unique.select("order_id"), "order_id", "left_semi").select(*items.columns)

    def n(df):
        return df.agg(F.count("*")).scalar()

    # Every count is a scalar subquery over an aggregate; nothing is collected.
    counts = orders.agg(F.count("*").alias("all_orders")).withColumns({
        "unique_orders": n(unique), "all_items": n(items),
        "final_orders_count": n(good_orders), "final_items_count": n(good_items)})
    lost_orders = F.col("unique_orders") - F.col("final_orders_count")
    lost_items = F.col("all_items") - F.col("final_items_count")
    repeated = F.col("all_orders") - F.col("unique_orders")
    stats = counts.select(
        lost_orders.alias("orphaned_orders_found"), lost_orders.alias("orphaned_orders_deleted"),
        lost_items.alias("orphaned_items_found"), lost_items.alias("orphaned_items_deleted"),
        repeated.alias("duplicate_orders_found"), repeated.alias("duplicate_orders_deleted"),
        "final_orders_count", "final_items_count")
    return Reconciled(good_orders, good_items, stats)


# --- constraints and schema ----------------------------------------------------------------

class CheckRules:
    """Named CHECK constraints; a rule that evaluates to NULL passes."""

    def __init__(self, rules: Mapping[str, Column | str] = ()):
        self.rules = dict(rules)

    def add(self, name: str, rule: Column | str) -> CheckRules:
        if name in self.rules:
            raise ValueError(f"constraint {name} exists")
        return CheckRules({**self.rules, name: rule})

    def drop(self, name: str) -> CheckRules:
        return CheckRules({k: v for k, v in self.rules.items() if k != name})

    def violations(self) -> Column:
        def failed(rule):
            test = F.expr(rule) if isinstance(rule, str) else rule
            return ~F.coalesce(test, F.lit(True))

        return F.array_compact(F.array(*[
            F.when(failed(rule), F.lit(name)) for name, rule in self.rules.items()]))


def check_constraints(df: DataFrame, rules: CheckRules) -> tuple[DataFrame, DataFrame]:
    """Rows that meet all rules, and the rest with the names of the broken ones."""
    marked = df.withColumn("violated", rules.violations())
    return marked.filter(F.size("violated") == 0).drop("violated"), marked.filter(F.size("violated") > 0)


def length_rules(limits: Mapping[str, int]) -> dict[str, str]:
    """Maximum lengths of text columns as CHECK rules."""
    return {f"{c}_length": f"length({c}) <= {int(n)}" for c, n in limits.items()}


def evolve_schema(df: DataFrame | None, target: T.StructType, spark=None) -> DataFrame:
    """Create when absent, add missing columns as NULL, refuse removed or retyped columns."""
    if df is None:
        return spark.createDataFrame([], target)
    wanted = {f.name: f.dataType for f in target}
    removed = [c for c in df.columns if c not in wanted]
    if removed:
        raise ValueError(f"columns cannot be removed: {removed}")
    retyped = [f.name for f in df.schema if f.dataType != wanted[f.name]]
    if retyped:
        raise ValueError(f"columns cannot change type: {retyped}")
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in target])


def add_column_default(df: DataFrame, name: str, dtype: str, default) -> DataFrame:
    """A column whose old rows read as the default."""
    value = F.lit(default).cast(dtype)
    return df.withColumn(name, F.coalesce(F.col(name), value) if name in df.columns else value)


# --- change logs -------------------------------------------------------------------------------

def as_of(log: DataFrame, key: str, ts: str, at: datetime | str, seq: str = "commit_seq", op: str = "op") -> DataFrame:
    """State of a table at an instant: latest change per key, deleted rows left out."""
    seen = log.filter(F.col(ts) <= F.lit(str(at)).cast("timestamp"))
    last = first_per_key(seen, [key], [F.desc(ts), F.desc(seq)])
    return last.filter(F.col(op) != "DELETE").drop(ts, seq, op)


def snapshot_history(log: DataFrame, n: int = 20) -> DataFrame:
    """Commits with their changes, newest first."""

    def ops(name):
        return F.count_if(F.col("op") == name)

    return log.groupBy("commit_seq", "committed_at").agg(
        F.count("*").alias("changes"), ops("INSERT").alias("inserted"), ops("UPDATE").alias("updated"),
        ops("DELETE").alias("deleted")).orderBy(F.desc("commit_seq")).limit(n)


def row_lineage(log: DataFrame, key: str) -> DataFrame:
    """First and last commit that touched each row that still exists."""
    per_row = log.groupBy(key).agg(
        F.min("commit_seq").alias("created_seq"), F.max("commit_seq").alias("last_updated_seq"),
        F.max_by("op", "commit_seq").alias("last_op"))
    return per_row.filter(F.col("last_op") != "DELETE").drop("last_op")


def rows_per_commit(lineage: DataFrame) -> DataFrame:
    return lineage.groupBy(F.col("last_updated_seq").alias("commit_seq")).agg(F.count("*").alias("rows_touched"))


def changed_after(lineage: DataFrame, seq: int) -> DataFrame:
    return lineage.filter(F.col("last_updated_seq") > seq)
