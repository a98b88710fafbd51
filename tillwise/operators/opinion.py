"""Words that tell good reviews from bad ones, learned from ratings.

A word's weight is the difference of its log-odds among good and bad reviews, drawn towards
its share of all words by an informative Dirichlet prior, so that rare words weigh little;
dividing by the estimated deviation gives a z-score. Words soon after a negation in the
same sentence count as words of their own. Counts are sums per word and add up over parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.operators.text import sentences, words
from tillwise.session import cut_lineage

#: Ratings from GOOD on are good ones, up to BAD bad ones; others count for the prior only.
GOOD, BAD = 4, 2
#: Words that turn the next ones round (fixed values), and how many.
NEGATIONS = ("not", "no", "never", "nor", "cannot", "without", "don", "doesn", "didn", "isn", "wasn", "nicht", "kein", "keine", "pas", "jamais")
REACH = 3
#: Words the prior is worth.
PRIOR = 1000.0
#: Words with a smaller z-score have no say in a review's score.
LEAST_Z = 1.96
#: Bits of the map of words with a say.
SLOTS = 1 << 22


def negated(tokens: Column) -> Column:
    """Words of a sentence; those up to ``REACH`` places after a negation begin with ``not_``."""
    known = F.array(*[F.lit(w) for w in NEGATIONS])

    def mark(w: Column, i: Column) -> Column:
        before = F.slice(tokens, F.greatest(i - F.lit(REACH - 1), F.lit(1)), F.least(i, F.lit(REACH)))
        return F.when(F.arrays_overlap(before, known), F.concat(F.lit("not_"), w)).otherwise(w)

    # Most sentences hold none: one look tells.
    return F.when(F.arrays_overlap(tokens, known), F.transform(tokens, mark)).otherwise(tokens)


def review_words(reviews: DataFrame, text: str, *keep: Column | str) -> DataFrame:
    """One row per word of each review, with the columns in ``keep``; null texts have none."""
    cut = F.flatten(F.transform(F.transform(sentences(text), words), negated))
    return reviews.select(*keep, F.explode(cut).alias("word"))


def _sides(rating: str) -> list[Column]:
    return [F.count("*").alias("uses"), F.count_if(F.col(rating) >= GOOD).alias("positive"),
            F.count_if(F.col(rating) <= BAD).alias("negative")]


def _weighed(counts: DataFrame, prior: float) -> DataFrame:
    """Add log_odds and z to uses, positive, negative and their totals all_uses, all_positive, all_negative."""
    drawn = F.lit(prior) * F.col("uses") / F.col("all_uses")

    def odds(side: str) -> Column:
        n = F.col(side) + drawn
        return F.log(n) - F.log(F.col(f"all_{side}") + F.lit(prior) - n)

    difference = odds("positive") - odds("negative")
    deviation = F.sqrt(F.lit(1.0) / (F.col("positive") + drawn) + F.lit(1.0) / (F.col("negative") + drawn))
    return counts.withColumn("log_odds", difference).withColumn("z", difference / deviation)


def word_log_odds(reviews: DataFrame, text: str = "review_text", rating: str = "rating", prior: float = PRIOR) -> DataFrame:
    """word, uses, positive, negative, log_odds and z of every word."""
    counts = review_words(reviews, text, rating).groupBy("word").agg(*_sides(rating))
    sides = ("uses", "positive", "negative")
    totals = counts.agg(F.struct(*[F.sum(c).alias(c) for c in sides])).scalar()
    return _weighed(counts.withColumns({f"all_{c}": totals[c] for c in sides}), prior).select("word", "uses", "positive", "negative", "log_odds", "z")


def _may_hold(rows: DataFrame, *columns: str) -> Column:
    """Test that every row with the values of a row of ``rows`` passes, and few others while these are fewer than ``SLOTS``.

    A bitmap of hashed slots, of bounded size, so words without a say go before any shuffle.
    """
    slot = F.pmod(F.xxhash64(*columns), F.lit(SLOTS))
    place = F.shiftright(slot, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    bits = rows.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits"))
    every = rows.sparkSession.range(SLOTS // 64).select(F.col("id").alias("place")).join(bits, "place", "left")
    held = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                 lambda x: x["bits"])).scalar()
    return F.get(held, place.cast("int")).bitwiseAND(bit) != 0


def opinion_scores(reviews: DataFrame, key: str = "review_id", text: str = "review_text", rating: str = "rating",
                   folds: int = 3, fold: Column | None = None, prior: float = PRIOR, least: float = LEAST_Z) -> DataFrame:
    """Every review with the mean weight of its telling words, learned from the other folds.

    Returns key, rating, telling (words with a say) and score, 0 without such words. ``fold``
    gives a review's fold from 0 on; by default it is drawn from the key. Counts are taken once
    per (word, fold): what the other folds say is the sum less the own part.
    """
    part = F.pmod(F.xxhash64(F.lit("opinion"), F.col(key)), F.lit(folds)) if fold is None else fold
    rows = reviews.select(key, rating, text, part.cast("int").alias("fold"))
    uses = review_words(rows, text, key, rating, "fold")
    sides = ["uses", "positive", "negative"]
    own = uses.groupBy("word", "fold").agg(*_sides(rating))
    totals = own.groupBy("fold").agg(*[F.sum(c).alias(c) for c in sides])  # one row per fold
    totals = totals.select("fold", *[(F.sum(c).over(Window.partitionBy()) - F.col(c)).alias(f"all_{c}") for c in sides])
    over = Window.partitionBy("word")  # at most a row per fold
    others = own.select("word", "fold", *[(F.sum(c).over(over) - F.col(c)).alias(c) for c in sides]).filter("uses > 0")
    weights = _weighed(others.join(F.broadcast(totals), "fold"), prior).filter(F.abs("z") >= F.lit(least)).select(
        "fold", "word", "log_odds")
    weights = cut_lineage(reviews.sparkSession, weights)
    telling = uses.filter(_may_hold(weights, "fold", "word"))
    per = telling.groupBy(key, "fold", "word").agg(F.count("*").alias("n")).join(weights, ["fold", "word"])
    said = per.groupBy(key).agg(F.sum("n").alias("telling"), (F.sum(F.col("n") * F.col("log_odds")) / F.sum("n")).alias("score"))
    return rows.select(key, rating).join(said, key, "left").select(
        key, rating, F.coalesce("telling", F.lit(0)).alias("telling"), F.coalesce("score", F.lit(0.0)).alias("score"))
