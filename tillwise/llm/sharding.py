"""Sharding by balanced label propagation.

Documents with equal texts are linked. Groups start one after the other along the shards, so
that at most one group fewer than there are shards is cut beyond those too large for their
share; in each round the members of a group move towards the shard where most of their
neighbours are, as far as quotas allow, until nothing moves. A linked document that
enters a shard changes places with an unlinked one, so the row counts of the shards
never differ by more than one.

Members of a group that sit in the same shard are alike, so the rounds work on one row
per (group, shard) with a count: a group holding a third of all rows is as many rows as
there are shards. Only DataFrame operations are used.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import running, stage, text_or_empty


def link_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, size, checksum, group of equal texts and a row hash.

    The group is the pair of a 64-bit hash and (checksum, length) of the UTF-8 text.
    A null text counts as empty.
    """
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("th"),
    ).withColumn("rh", F.xxhash64(F.col("id"), F.col("th"), F.lit("row")))


def dealt(groups: DataFrame, n_shards: int) -> DataFrame:
    """Cells (gid, gh, shard, n) of groups laid end to end and cut into equal shares.

    ``groups`` has gid, gh and members; shares differ by one row at most, the first being larger.
    """
    total = groups.agg(F.sum("members")).first()[0] or 0
    share = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    pieces = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(sum(share[:s])).cast("long").alias("lo"),
                                F.lit(sum(share[:s + 1])).cast("long").alias("hi")) for s in range(n_shards)])
    laid = running(groups, [], "gid", ["gh"], value="members", out="ahead")
    return laid.select("gid", "gh", "ahead", "members", F.inline(pieces)).select(
        "gid", "gh", "shard",
        (F.least("hi", F.col("ahead") + F.col("members")) - F.greatest("lo", "ahead")).cast("long").alias("n")).filter("n > 0")


def propagate(cells: DataFrame, quota: list[int], rounds: int | None = None) -> DataFrame:
    """Move counts of linked rows between shards; ``cells`` has gid, gh, shard, n.

    Returns the final cells. ``quota`` is the number of rows each shard holds. Without
    ``rounds`` it goes on until nothing moves; the sum of squared counts grows with each move.
    """
    n_shards = len(quota)
    for _ in itertools.count() if rounds is None else range(rounds):
        linked = dict(cells.groupBy("shard").agg(F.sum("n")).collect())  # one row per shard
        free = [quota[s] - linked.get(s, 0) for s in range(n_shards)]
        room = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in free]), F.col("shard") + F.lit(1))
        # A group is drawn to the shard that holds most of it and still has unlinked rows to
        # swap; the group's own hash breaks ties, so that all members agree.
        ranked = Window.partitionBy("gid", "gh").orderBy(
            F.desc("n"), F.xxhash64("gid", "shard"), "shard")
        best = (
            cells.filter(room > F.lit(0)).withColumn("k", F.row_number().over(ranked)).filter("k = 1")
            .select("gid", "gh", F.col("shard").alias("to"), F.col("n").alias("there"))
        )
        # Rows leave only for a shard that holds more of the group, or as many and wins the tie.
        asks = (
            cells.join(best, ["gid", "gh"]).filter(F.col("shard") != F.col("to"))
            .filter((F.col("there") > F.col("n"))
                    | ((F.col("there") == F.col("n"))
                       & (F.xxhash64("gid", "to") < F.xxhash64("gid", "shard"))))
        )
        # Larger gains first: the top six bits hold the size class, the rest is a hash.
        level = F.lit(31) - F.floor(F.log2(F.col("there").cast("double"))).cast("int")
        asks = asks.withColumn("ah", F.shiftleft(F.greatest(level, F.lit(0)).cast("long"), 58).bitwiseOR(
            F.shiftrightunsigned(F.xxhash64("gid", "shard"), 6)))
        asks = running(asks, ["to"], "ah", ["gid", "gh", "shard"], value="n", out="ahead")
        space = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in free]), F.col("to") + F.lit(1))
        moves = stage(
            asks.withColumn("m", F.least(F.col("n"), space - F.col("ahead"))).filter("m > 0")
            .select("gid", "gh", "shard", "to", "m"))
        if moves.isEmpty():
            break
        cells = stage(
            cells.unionByName(moves.select("gid", "gh", "shard", (-F.col("m")).alias("n")))
            .unionByName(moves.select("gid", "gh", F.col("to").alias("shard"), F.col("m").alias("n")))
            .groupBy("gid", "gh", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))
    return cells


def shard_documents(docs: DataFrame, n_shards: int = 8, rounds: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Deal documents into shards of equal row counts, keeping equal texts together.

    Returns id, size (UTF-8 bytes plus 1), crc, th (hash of the text), shard and slot
    (position in the shard, gapless from 0). Row counts differ by one at most. A null
    text counts as empty; a null id is kept; repeated rows each get a slot of their own;
    other columns are ignored; an empty table gives an empty result.
    """
    rows = stage(link_groups(docs, id_col, text_col))
    rows = rows.withColumn("gid", F.col("th")).withColumn("gh", F.xxhash64("size", "crc"))
    total = rows.count()
    quota = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    groups = rows.groupBy("gid", "gh").agg(F.count("*").alias("members"))
    linked = groups.filter("members > 1").select("gid", "gh")

    in_group = rows.join(linked, ["gid", "gh"])
    cells = propagate(stage(dealt(groups.filter("members > 1"), n_shards)), quota, rounds)

    # Back to rows: members are ranked inside their group and cut at the cells' bounds.
    upto = Window.partitionBy("gid", "gh").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    bounds = cells.withColumn("hi", F.sum("n").over(upto)).withColumn("lo", F.col("hi") - F.col("n"))
    ranked = running(in_group, ["gid", "gh"], "rh", ["id"], out="pos")
    placed = (
        ranked.join(bounds.select("gid", "gh", "shard", "lo", "hi"), ["gid", "gh"])
        .filter((F.col("pos") >= F.col("lo")) & (F.col("pos") < F.col("hi")))
        .select("id", "size", "crc", "th", "rh", "shard")
    )
    # Unlinked rows fill every shard up to its quota.
    held = dict(cells.groupBy("shard").agg(F.sum("n")).collect())  # one row per shard
    edges, end = [], 0
    for s in range(n_shards):
        end += quota[s] - held.get(s, 0)
        edges.append(end)
    alone = running(rows.join(linked, ["gid", "gh"], "left_anti"), [], "rh", ["id"], out="pos")
    shard = F.lit(n_shards - 1)
    for s in reversed(range(n_shards - 1)):
        shard = F.when(F.col("pos") < F.lit(edges[s]), F.lit(s)).otherwise(shard)
    fillers = alone.select("id", "size", "crc", "th", "rh", shard.cast("int").alias("shard"))
    both = stage(placed.unionByName(fillers))
    return (
        running(both, ["shard"], "rh", ["id", "crc"], out="slot")
        .select("id", "size", "crc", "th", "shard", F.col("slot").cast("long").alias("slot"))
    )


def op10(docs: DataFrame) -> DataFrame:
    """The registered report: law ``rows``, eight shards."""
    return shard_documents(docs).select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
