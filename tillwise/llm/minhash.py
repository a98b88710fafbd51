"""Document fingerprints by one-permutation MinHash with optimal densification.

The shingles of a text are hashed once; the top bits of a hash name its bin, and every
bin keeps its smallest hash. An empty bin borrows from the non-empty bin that comes first
in its own random order, so two texts with equal non-empty bins borrow alike. The lowest
bits of each bin are stored, as hexadecimal digits; likeness is the share of
equal digits, corrected for digits that agree by chance.

Only DataFrame functions are used: hashes stay in arrays of one row, sorted once, so that
each bin's smallest is where the bin begins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import GAP, stage, text_or_empty

BIN_BITS = 7  # 128 bins
DIGIT_BITS = 4  # one hexadecimal digit a bin


def with_fingerprint(df: DataFrame, text: str, out: str, width: int = 5) -> DataFrame:
    """Add the fingerprint of the whole non-null ``text``; without words it is ''.

    A text with fewer than ``width`` words is a single shingle.
    """
    w, s, m, full = "__w", "__s", "__m", "__full"
    bins = 1 << BIN_BITS

    def bin_of(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - BIN_BITS)

    words = F.filter(F.split(F.col(text), GAP), lambda x: x != F.lit(""))
    df = df.withColumn(w, F.transform(words, lambda x: F.xxhash64(x)))
    shingle = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - F.lit(width), F.lit(0))),
        lambda i: F.xxhash64(*[F.get(w, i + F.lit(k)) for k in range(width)]))
    df = df.withColumn(s, F.sort_array(F.when(F.size(w) > 0, shingle).otherwise(F.array().cast("array<long>"))))
    df = df.withColumn(m, F.filter(s, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(s, i - F.lit(1))))))

    def borrow(i: Column) -> Column:
        order = F.transform(m, lambda h: F.struct(F.xxhash64(i, bin_of(h)).alias("o"), h.alias("h")))
        return F.array_min(order)["h"]

    # Non-empty bins one after the other, with gaps filled.
    df = df.withColumn("__at", F.transform(m, lambda h: bin_of(h).cast("int")))
    df = df.withColumn(full, F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(
        F.get(m, (F.array_position("__at", i) - F.lit(1)).cast("int")), borrow(i))))
    # Bits are taken after the bin's number is mixed in, so that bins that hold the same hash, as
    # those of very short texts do, agree by chance each on its own.
    digits = F.transform(full, lambda h, i: F.lower(F.hex(F.xxhash64(h, i).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)))))
    return df.withColumn(out, F.when(F.size(m) > 0, F.array_join(digits, "")).otherwise(F.lit(""))).drop(
        w, s, m, "__at", full)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two fingerprints' shingles, 0 to 1.

    Two texts without words are alike (1); such a text is unlike any other (0).
    """
    chance = 1.0 / (1 << DIGIT_BITS)
    same = F.aggregate(
        F.sequence(F.lit(1), F.lit(1 << BIN_BITS)), F.lit(0),
        lambda n, i: n + (F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1))).cast("int"))
    share = same / F.lit(float(1 << BIN_BITS))
    estimate = F.greatest((share - F.lit(chance)) / F.lit(1 - chance), F.lit(0.0))
    return (F.when(F.col(a) == F.col(b), F.lit(1.0))
            .when((F.col(a) == "") | (F.col(b) == ""), F.lit(0.0)).otherwise(estimate))


def with_next(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Add next_<field> of the row that follows in descending (z, a, t) order; the first follows the last.

    Rows are unique by (z, a, t). They are ordered inside range partitions; only each
    partition's first row is ordered against the others'.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.asc("z"), F.desc("a"), F.asc("t")]
    cut = stage(rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))
    head = F.struct(*fields)
    firsts = cut.groupBy("part").agg(F.min_by(head, F.struct("z", (-F.col("a")).alias("a"), "t")).alias("head"))
    line = Window.orderBy("part")  # one row per partition
    after = firsts.select(
        "part", F.coalesce(F.lead("head").over(line), F.first("head").over(
            line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("head"))
    inside = Window.partitionBy("part").orderBy(*order)
    nxt = F.coalesce(F.lead(head).over(inside), F.col("head"))
    out = cut.join(after, "part").withColumn("__next", nxt)
    return out.select(*rows.columns, *[F.col(f"__next.{f}").alias(f"next_{f}") for f in fields])


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The text with a non-null key (a, z, t): the id, whether it is null, a hash of the text."""
    text = text_or_empty(text_col)
    return docs.select(
        F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("a"),
        F.col(id_col).isNull().cast("int").alias("z"), F.xxhash64(text).alias("t"), text.alias("text"))


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text and likeness to that and to the next text.

    The edited text ends with the first words of the next document in descending id
    instead of its own last third. Null texts count as empty. Null ids come last; ids that
    occur with several texts are ordered by a hash of the text. Repeated rows are one
    document here: each gets the same result. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    key = ["a", "z", "t"]
    prints = with_fingerprint(rows.withColumn("n", F.char_length("text").cast("long")), "text", "fp")
    unique = prints.groupBy(*key).agg(F.first("n").alias("n"), F.first("fp").alias("fp"))
    linked = stage(with_next(unique, ["a", "z", "t", "fp"]))

    third = F.floor(F.col("n") / F.lit(3)).cast("int")
    ahead = linked.select(
        F.col("next_a").alias("a"), F.col("next_z").alias("z"), F.col("next_t").alias("t"),
        F.struct(*key).alias("of"), third.alias("k"))
    texts = rows.select(*key, "text")  # the same in both joins, so that it is shuffled once
    heads = (
        texts.join(ahead, key)
        .select(F.col("of.a").alias("a"), F.col("of.z").alias("z"), F.col("of.t").alias("t"),
                F.substring(F.col("text"), F.lit(1), F.col("k")).alias("head"))
        .groupBy(*key).agg(F.first("head").alias("head"))
    )
    own = linked.select(*key, "n", "fp", "next_fp")
    both = texts.join(own, key).join(heads, key)
    own_id = F.when(F.col("z") == 0, F.col("a")).cast(docs.schema[id_col].dataType).alias("id")
    edited = both.select(
        own_id, "n", "fp", "next_fp",
        F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n") - third).cast("int")), F.col("head")).alias("edited"))
    edited = edited.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    return with_fingerprint(edited, "edited", "edited_fp").select(
        "id", "n", "edited_sha256", "fp", "edited_fp",
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"))


def op2(docs: DataFrame) -> DataFrame:
    """The registered report."""
    return edited_pairs(docs).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_chars"), "edited_sha256",
        F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")
