"""Mixing sources to target weights by a low-discrepancy schedule.

The points frac(t * golden ratio), t = 0, 1, 2, ..., are mapped through the cumulative
weights of the sources: slot t belongs to the source whose interval holds its point, so
every stretch of the schedule has all sources in nearly exact proportion. The slots of a
source are ranked; the slot of rank r takes block r mod n of the source, in pass r div n.
A source's documents are shuffled by a hash, laid end to end and cut into n blocks of
equal numbers of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import GAP, WORD, running, stage, text_or_empty

#: Words per block of a large source, and blocks a small source has at least.
BLOCK = 512
MIN_BLOCKS = 128
#: Fractional part of the golden ratio, as a fraction of 2**62.
STEP = 2850181424110363369


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_key(source: str) -> Column:
    """Non-null key of a source that sorts by code point, null last."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))


def shuffle_hash(*parts: Column) -> Column:
    """A 64-bit number that shuffles alike in any engine: the first digits of an MD5 sum."""
    line = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.shiftleft(F.conv(F.substring(F.md5(line.cast("binary")), 1, 15), 16, 10).cast("long"), 3)


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """Target of each source (key, size): weights repeat in the order of the keys.

    A target stops at ``most`` times the source's size; the excess is shared again by
    weight among the others until none is above. The sources are positioned by a range
    partitioning, and each round is one aggregate: none is gathered in one place.
    """
    spark = sizes.sparkSession
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    cut = stage(sizes.repartitionByRange(int(parts), "key").withColumn("part", F.spark_partition_id()))
    per = cut.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = per.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    pos = F.row_number().over(Window.partitionBy("part").orderBy("key")) - F.lit(1) + F.col("before")
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    sources = stage(
        cut.join(before, "part")
        .withColumn("weight", F.element_at(cyc, (pos % F.lit(len(weights))).cast("int") + F.lit(1)))
        .select("key", "size", "weight"))
    total = sources.agg(F.sum("size")).first()[0] or 0
    cap = F.lit(float(most)) * F.col("size").cast("double")
    level = 0.0  # words per unit of weight; sources whose cap lies below are at their cap
    while True:
        capped = cap < F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(capped, cap).otherwise(0.0)).alias("c"),
                          F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if not row["w"]:
            break
        new = (total - row["c"]) / row["w"]
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def schedule(sources: DataFrame) -> DataFrame:
    """Blocks of each source with the number of times the schedule takes them.

    ``sources`` has key, size, target. Returns key, block, times. A source may
    be taken ``quota`` slots, its target in blocks, at most.
    """
    blocks = F.greatest(F.ceil(F.col("size") / F.lit(BLOCK)), F.least(F.col("size"), F.lit(MIN_BLOCKS)))
    plan = sources.filter((F.col("size") > 0) & (F.col("target") > 0)).select(
        "key", "size", "target", blocks.cast("long").alias("blocks"))
    # In steps of 1/1024, so that sums are exact in any order and reruns agree.
    plan = plan.withColumn("want", F.ceil(F.col("target") * F.col("blocks") / F.col("size") * F.lit(1024.0)) / F.lit(1024.0))
    plan = plan.withColumn("quota", F.least(F.round("want"), F.lit(3) * F.col("blocks")).cast("long"))
    plan = plan.withColumn("kh", shuffle_hash(F.col("key")))
    plan = stage(running(plan, [], "kh", ["key"], value="want", out="low"))
    whole = plan.agg(F.sum("want")).first()[0] or 0.0
    # A few slots more than needed, so that every source reaches its quota.
    slots = int(whole + max(64.0, whole / 64)) if whole else 0
    unit = float(2**62)
    points = sources.sparkSession.range(slots).select(
        F.col("id").alias("t"),
        # t * STEP mod 2**62 in two halves, since the product overflows 64 bits.
        _multiply_mod(F.col("id")).alias("u"))
    # The line of cumulative weights in cells, more than sources: a slot meets those of its cell only.
    grain = 4096 + 4 * plan.count()
    line = F.lit(whole / unit)
    points = points.withColumn("x", F.col("u").cast("double") * line)
    step = F.lit(max(whole, 1.0) / grain)
    points = points.withColumn("cell", F.floor(F.col("x") / step).cast("int"))
    spans = plan.withColumn("high", F.col("low") + F.col("want")).withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / step).cast("int"),
                                     F.floor(F.col("high") / step).cast("int"))))
    owned = points.join(spans, "cell").filter((F.col("x") >= F.col("low")) & (F.col("x") < F.col("high")))
    # Ranks per source in the order of t: t is dense, so its high bits are the ranges.
    owned = owned.withColumn("th", F.shiftleft("t", 63 - max(1, slots.bit_length())))
    ranked = running(owned.select("key", "t", "th", "blocks", "quota"), ["key"], "th", out="r")
    return (
        ranked.filter(F.col("r") < F.col("quota"))
        .groupBy("key", (F.col("r") % F.col("blocks")).alias("block")).agg(F.count("*").alias("times"))
    )


def _multiply_mod(t: Column) -> Column:
    """t * STEP mod 2**62 for t < 2**40 without overflow: 20 bits of t at a time."""
    mask = F.lit(2**62 - 1)
    low, high = t.bitwiseAND(F.lit(2**20 - 1)), F.shiftright(t, 20)

    def times(part: Column, factor: int) -> Column:
        # factor = a * 2**31 + b; each product stays below 2**52.
        a, b = factor >> 31, factor & (2**31 - 1)
        top = (part * F.lit(a)).bitwiseAND(F.lit(2**31 - 1))
        return (F.shiftleft(top, 31) + part * F.lit(b)).bitwiseAND(mask)

    return (times(low, STEP) + times(high, (STEP << 20) & (2**62 - 1))).bitwiseAND(mask)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How many words of each document the mix takes, repeats counted.

    Returns id, h (hash of id and text), key, size, source_size, target and taken.
    A null text has no words, and nothing of it is taken. A null source is a source of
    its own, the last. Repeated rows are documents of their own. Other columns are ignored.
    An empty table gives an empty result.
    """
    rows = stage(docs.select(
        F.col(id_col).alias("id"), source_key(source_col).alias("key"),
        word_count(text_col).alias("size"), shuffle_hash(F.col(id_col), F.col(text_col)).alias("h")))
    # Sizes per source: added up per range of the hash first by the partial aggregate.
    sources = stage(targets(rows.groupBy("key").agg(F.sum("size").alias("size"))))
    times = schedule(sources)
    per = sources.select("key", F.col("size").alias("source_size"), "target")
    laid = running(rows, ["key"], "h", ["id", "size"], value="size", out="start")
    laid = stage(laid.join(per, "key"))
    blocks = F.greatest(F.ceil(F.col("source_size") / F.lit(BLOCK)),
                        F.least(F.col("source_size"), F.lit(MIN_BLOCKS))).cast("long")
    # Block b covers words [b * size div n, (b + 1) * size div n) of its source.
    cut = (
        laid.filter("size > 0").select("key", "h", "id", "start", "size", "source_size", blocks.alias("n"))
        .withColumn("first", _block_of(F.col("start")))
        .withColumn("last", _block_of(F.col("start") + F.col("size") - F.lit(1)))
        .withColumn("block", F.explode(F.sequence("first", "last")))
    )
    lo = F.greatest(F.col("start"), _block_start(F.col("block")))
    hi = F.least(F.col("start") + F.col("size"), _block_start(F.col("block") + F.lit(1)))
    taken = (
        cut.withColumn("words", hi - lo).join(times, ["key", "block"])
        .groupBy("key", "start").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    # A place on the source's line is one document's, save that wordless ones share it.
    worded = laid.filter("size > 0").join(taken, ["key", "start"], "left")
    none = laid.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return worded.unionByName(none).select(
        "id", "h", "key", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"),
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _block_start(b: Column) -> Column:
    """floor(b * source_size / n), exactly and without overflow."""
    q, r = F.floor(F.col("source_size") / F.col("n")), F.col("source_size") % F.col("n")
    return b * q + F.floor(b * r / F.col("n")).cast("long")


def _block_of(pos: Column) -> Column:
    """The block that holds a word: a first guess, mended by one."""
    guess = F.floor(pos.cast("double") * F.col("n") / F.col("source_size")).cast("long")
    up = F.when(_block_start(guess + F.lit(1)) <= pos, guess + F.lit(1)).otherwise(guess)
    return F.when(_block_start(up) > pos, up - F.lit(1)).otherwise(up)


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """The mix itself: each document as many times over as it is taken, with all its columns.

    A part of a document that remains is its first words, with the white space between them.
    Rows with equal id and text are taken together.
    """
    mark = shuffle_hash(F.col(id_col), F.col(text_col))
    taken = mix(docs, id_col, text_col, source_col).groupBy("h", "key").agg(
        F.sum("taken").alias("__taken"), F.first("size").alias("__size"), F.count("*").alias("__n")).filter(
        "__taken > 0").withColumnsRenamed({"h": "__h", "key": "__key"})
    taken = stage(taken)
    rows = docs.withColumn("__h", mark).withColumn("__key", source_key(source_col))
    several = rows.join(taken.filter("__n > 1"), ["__h", "__key"]).dropDuplicates(["__h", "__key"])
    rows = rows.join(taken.filter("__n = 1"), ["__h", "__key"]).unionByName(several)
    whole = F.floor(F.col("__taken") / F.col("__size")).cast("int")
    rest = (F.col("__taken") % F.col("__size")).cast("int")
    words = F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("__words", F.explode(F.concat(F.array_repeat(F.col("__size").cast("int"), whole), words)))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(GAP.replace("+", "*") + WORD), F.lit(0))
    part = F.array_join(F.slice(pieces, F.lit(1), F.col("__words")), "")
    return rows.withColumn(text_col, F.when(F.col("__words") < F.col("__size"), part).otherwise(F.col(text_col))).drop(
        "__h", "__key", "__taken", "__size", "__n", "__words")


def op4(docs: DataFrame) -> DataFrame:
    """The registered report."""
    return mix(docs).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
