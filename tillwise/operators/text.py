"""Text operators over reviews, tickets and documents.

Predicates and classes come from models trained on labelled rows, sentiment from a
lexicon, search from an inverted index. Everything but model inference is built from
JVM-side functions; whole texts are processed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.semantics import first_per_key, ladder, ratio, rounded_ratio
from tillwise.operators.similarity import similarity_topk
from tillwise.session import cut_lineage
from tillwise.sources.files import cuts

# Words, aspects, patterns and BM25 constants.
LEXICON = {
    "amazing": 1, "awesome": 1, "best": 1, "comfortable": 1, "durable": 1, "excellent": 1, "fantastic": 1, "good": 1,
    "great": 1, "love": 1, "perfect": 1, "recommend": 1, "satisfied": 1, "sturdy": 1, "thank": 1, "wonderful": 1,
    "awful": -1, "bad": -1, "broke": -1, "broken": -1, "cheap": -1, "defective": -1, "delayed": -1,
    "disappointed": -1, "disappointing": -1, "expensive": -1, "frustrated": -1, "poor": -1, "refund": -1,
    "stupid": -1, "terrible": -1, "uncomfortable": -1, "worst": -1, "worthless": -1,
}
ASPECTS = {
    "quality": ["quality", "made", "material", "materials", "construction"],
    "price": ["price", "cost", "value", "money", "expensive", "cheap"],
    "performance": ["performance", "speed", "control", "performs"],
    "durability": ["durable", "durability", "lasted", "broke", "broken"],
    "comfort": ["comfort", "comfortable", "fit", "fits", "uncomfortable"],
}
PROS = ["good", "great", "love", "excellent", "recommend", "perfect"]
CONS = ["bad", "poor", "broke", "broken", "disappointed", "terrible"]
WORD_BREAK = r"[^\p{L}\p{N}]+"
SENTENCE_BREAK = "[.!?\n]+"
AMOUNT = r"[$][0-9][0-9,]*(?:[.][0-9][0-9])?"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}"
CARD = r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"
PHONE = r"[+][0-9]{1,3}(?:[ .-]?[(]?[0-9]{2,4}[)]?){2,5}|[(]?[0-9]{3}[)]?[ .-][0-9]{3}[ .-][0-9]{4}"
# A full stop inside a number ends no sentence.
STATEMENT_BREAK = r"[.!?]+\s+|\n+"
BM25_K1 = 1.2
BM25_B = 0.75
#: Postings of a written range; a task sorts one range, whatever the size of the whole.
RANGE = 1 << 20


def words(text: Column | str) -> Column:
    """Lower-case words of a text, empty ones left out."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), WORD_BREAK), lambda w: F.length(w) > 0)


def sentences(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.transform(F.split(t, SENTENCE_BREAK), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def _holds(part: str, vocabulary: Sequence[str]):
    """Test for structs whose word list ``part`` holds a word of the vocabulary."""
    known = F.array(*[F.lit(w) for w in vocabulary])
    return lambda x: F.arrays_overlap(x[part], known)


# --- trained predicates and classes ---------------------------------------------------

#: Column of counted terms; rows that have it are not cut into terms again.
COUNTED = "__tf"


def _count_stages(text: str, dim: int) -> list:
    """Hashed single words and word pairs, counted."""
    return [
        RegexTokenizer(inputCol=text, outputCol="__words", pattern="\\s+", toLowercase=True),
        NGram(n=2, inputCol="__words", outputCol="__pairs"),
        SQLTransformer(statement="SELECT *, concat(__words, __pairs) AS __terms FROM __THIS__"),
        HashingTF(inputCol="__terms", outputCol=COUNTED, numFeatures=dim),
    ]


def count_terms(df: DataFrame, text: str, dim: int = 1 << 16) -> DataFrame:
    """``df`` with a text's counted terms in its place, written once, for models of the same ``dim`` fitted and applied often."""
    counted = PipelineModel(stages=_count_stages(text, dim)).transform(df)
    return cut_lineage(df.sparkSession, counted.select(*[c for c in df.columns if c != text], COUNTED))


def _term_stages(df: DataFrame, text: str, dim: int) -> list:
    """Counted terms, weighted by inverse document frequency; counts at hand are taken as they are."""
    counts = [] if COUNTED in df.columns else _count_stages(text, dim)
    return [*counts, IDF(inputCol=COUNTED, outputCol="__features", minDocFreq=2)]


def train_text_filter(labelled: DataFrame, text: str, label: str, dim: int = 1 << 16, iterations: int = 30) -> PipelineModel:
    """Yes/no model for a predicate, from rows with a 0/1 label; see :func:`count_terms`."""
    fit = LogisticRegression(featuresCol="__features", labelCol=label, maxIter=iterations, regParam=0.01)
    return Pipeline(stages=[*_term_stages(labelled, text, dim), fit]).fit(labelled.withColumn(label, F.col(label).cast("double")))


def text_flag(df: DataFrame, model: PipelineModel, name: str, threshold: float = 0.5) -> DataFrame:
    """The predicate as a column."""
    out = model.transform(df).withColumn(name, vector_to_array("probability")[1] >= threshold)
    return out.select(*df.columns, name)


def text_filter(df: DataFrame, model: PipelineModel, threshold: float = 0.5) -> DataFrame:
    """Rows the predicate holds for."""
    return text_flag(df, model, "__hit", threshold).filter("__hit").drop("__hit")


def train_text_classes(labelled: DataFrame, text: str, label: str, dim: int = 1 << 16, iterations: int = 30) -> PipelineModel:
    """Model for one of several categories; see :func:`count_terms`."""
    index = StringIndexer(inputCol=label, outputCol="__y", handleInvalid="error").fit(labelled)
    fit = LogisticRegression(featuresCol="__features", labelCol="__y", maxIter=iterations, regParam=0.01)
    terms = Pipeline(stages=[*_term_stages(labelled, text, dim), fit]).fit(index.transform(labelled))
    back = IndexToString(inputCol="prediction", outputCol="__class", labels=index.labels)
    return PipelineModel(stages=[*terms.stages, back])


def text_classify(df: DataFrame, model: PipelineModel, name: str = "category") -> DataFrame:
    out = model.transform(df).withColumn(name, F.col("__class"))
    return out.select(*df.columns, name)


def fit_embedding(df: DataFrame, text: str, dim: int = 256) -> PipelineModel:
    """Word weights for unit vectors of texts; rows and search phrases are embedded by the same model."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="__words", pattern=WORD_BREAK, toLowercase=True),
        HashingTF(inputCol="__words", outputCol="__tf", numFeatures=dim),
        IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__unit"),
    ]
    return Pipeline(stages=stages).fit(df.select(text))


def embed(df: DataFrame, model: PipelineModel, name: str = "embedding") -> DataFrame:
    """Unit vector per text; store the result to search it often."""
    return model.transform(df).withColumn(name, vector_to_array("__unit", "float32")).select(*df.columns, name)


def similar_to_text(df: DataFrame, model: PipelineModel, key: str, phrase: str, k: int = 5,
                    embedded: str | None = None) -> DataFrame:
    """Rows most similar to a phrase; ``embedded`` names a stored embedding column."""
    spark = df.sparkSession
    column = model.stages[0].getInputCol()
    q = embed(spark.createDataFrame([(phrase,)], f"`{column}` string"), model).first()["embedding"]
    rows = df if embedded else embed(df, model)
    return similarity_topk(rows, key, embedded or "embedding", q, k)


# --- sentiment ---------------------------------------------------------------------------

def _label(pos: Column, neg: Column) -> Column:
    return ladder([((pos > 0) & (neg > 0), "mixed"), (pos > 0, "positive"), (neg > 0, "negative")], "neutral")


def sentiment(df: DataFrame, key: str, text: str, lexicon: Mapping[str, int] = LEXICON,
              aspects: Mapping[str, Sequence[str]] = ASPECTS) -> DataFrame:
    """Overall sentiment of each text, and of the sentences that mention each aspect.

    Words are looked up in array functions inside the row, so a long text costs no shuffle.
    """
    good = F.array(*[F.lit(w) for w, s in lexicon.items() if s > 0])
    bad = F.array(*[F.lit(w) for w, s in lexicon.items() if s < 0])

    def hits(tokens: Column, vocabulary: Column) -> Column:
        return F.size(F.filter(tokens, lambda w: F.array_contains(vocabulary, w)))

    tokens = F.transform(sentences(text), words)
    parsed = df.select(key, F.transform(tokens, lambda t: F.struct(
        t.alias("t"), hits(t, good).alias("p"), hits(t, bad).alias("n"))).alias("s"))

    def total(items: Column, part: str) -> Column:
        return F.aggregate(items, F.lit(0), lambda a, x: a + x[part])

    def verdict(items: Column) -> Column:
        return _label(total(items, "p"), total(items, "n"))

    out = [verdict(F.col("s")).alias("overall_sentiment"),
           (total(F.col("s"), "p") - total(F.col("s"), "n")).alias("score")]
    for aspect, keywords in aspects.items():
        about = F.filter("s", _holds("t", keywords))
        out.append(F.when(F.size(about) == 0, "unknown").otherwise(verdict(about)).alias(f"{aspect}_sentiment"))
    return parsed.select(key, *out)


def reviews_with_sentiment(reviews: DataFrame, satisfied: PipelineModel, lexicon: Mapping[str, int] = LEXICON,
                           aspects: Mapping[str, Sequence[str]] = ASPECTS) -> DataFrame:
    """Reviews with a satisfaction flag, a quality flag and a five-step sentiment class."""
    flagged = text_flag(reviews, satisfied, "is_positive")
    mood = sentiment(reviews, "review_id", "review_text", lexicon, {"quality": aspects["quality"]})
    score = F.col("score")
    return flagged.join(mood, "review_id").select(
        *reviews.columns, "is_positive",
        F.col("quality_sentiment").isin("negative", "mixed").alias("mentions_quality_issues"),
        ladder([(score >= 2, "highly_positive"), (score == 1, "positive"), (score == 0, "neutral"),
                (score == -1, "negative")], "highly_negative").alias("sentiment_category"))


# --- search ----------------------------------------------------------------------------------

def term_counts(df: DataFrame, part: str) -> DataFrame:
    """``df`` with a column ``part`` of words replaced by ``length`` and ``terms``, its distinct words with their counts.

    Words are counted inside the row, so no aggregation holds the words of many documents.
    """
    n, s, at = F.size(part), F.col("__sorted"), F.col("__at")
    others = [c for c in df.columns if c != part]
    ordered = df.select(*others, n.cast("long").alias("length"), F.sort_array(part).alias("__sorted"))
    none, size = F.array().cast("array<int>"), F.col("length").cast("int")
    every = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(none)
    runs = ordered.withColumn("__at", F.filter(every, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))))
    ends = F.concat(F.slice(at, F.lit(2), F.greatest(F.size(at), F.lit(1))), F.when(size > 0, F.array(size)).otherwise(none))
    return runs.select(*others, "length", F.zip_with(at, ends, lambda i, j: F.struct(
        F.get(s, i).alias("term"), (j - i).cast("long").alias("tf"))).alias("terms"))


def exploded(counted: DataFrame, key: str) -> DataFrame:
    """(key, length, term, tf) of rows of :func:`term_counts`."""
    # No row is empty here; the plain form would have Spark test that by counting the terms of each row once more.
    return counted.filter(F.col("length") > 0).select(key, "length", F.explode_outer("terms").alias("__t")).select(
        key, "length", "__t.term", "__t.tf")


def postings_of(counted: DataFrame) -> int:
    """How many rows :func:`exploded` gives."""
    return counted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]


def by_term(postings: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` postings dealt to ranges of (term, key) of about ``RANGE`` each."""
    return postings.repartitionByRange(max(1, -(-n // RANGE)), "term", key)


class SearchIndex:
    """Inverted index of (term, document, count) with BM25 ranking.

    ``lengths`` holds the number of words per document. Store the index with
    :meth:`write` when it answers more than one query: a stored index is read by term,
    one that is not stored tokenises the texts again for every query.
    """

    def __init__(self, postings: DataFrame, lengths: DataFrame, documents: DataFrame, key: str,
                 counted: DataFrame | None = None):
        self.postings, self.lengths, self.documents, self.key, self.counted = postings, lengths, documents, key, counted

    @classmethod
    def build(cls, df: DataFrame, key: str, text: Sequence[str] | str) -> SearchIndex:
        """Index one or several text columns; all other columns can be filtered and returned."""
        columns = [text] if isinstance(text, str) else list(text)
        tokens = df.select(key, words(F.concat_ws(" ", *columns)).alias("__words"))
        counted = term_counts(tokens, "__words").withColumn("length", F.col("length").cast("int"))
        # Dealt out first: a document's terms are distinct, so nothing is gained by adding up before the shuffle.
        postings = cls._added(exploded(counted, key).repartition("term", key), key)
        return cls(postings, tokens.select(key, F.size("__words").alias("length")), df, key, counted)

    @staticmethod
    def _added(rows: DataFrame, key: str) -> DataFrame:
        """Rows of one key and length are one document."""
        return rows.groupBy("term", key, "length").agg(F.sum("tf").alias("tf"))

    def write(self, path: str) -> None:
        """Store the postings of a built index ordered by term: a query then reads a few row groups.

        Texts are cut once: the ranges are drawn from a written table of counted terms.
        """
        with cuts(self.counted.sparkSession) as cut:
            counted = cut(self.counted)
            ranged = by_term(exploded(counted, self.key), self.key, postings_of(counted))
            self._added(ranged, self.key).sortWithinPartitions("term", self.key).write.mode("overwrite").parquet(
                f"{path}/postings")
            counted.filter(F.col("length") > 0).groupBy(self.key).agg(F.max("length").alias("length")).write.mode(
                "overwrite").parquet(f"{path}/lengths")

    @classmethod
    def read(cls, df: DataFrame, key: str, path: str) -> SearchIndex:
        spark = df.sparkSession
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/lengths"), df, key)

    def search(self, q: str, columns: Sequence[str], limit: int = 5, where: Column | None = None) -> DataFrame:
        """Best documents for a query, with the chosen columns and the score."""
        terms = query_words(self.postings.sparkSession, q)
        stats = self.documents.agg(F.count("*")).scalar()
        lengths = self.lengths.agg(ratio(F.sum("length"), F.count_if(F.col("length") > 0))).scalar()
        hits = self.postings.filter(F.col("term").isin(*terms))
        found = hits.groupBy("term").agg(F.count("*").alias("df"))
        n, df, tf = stats, F.col("df"), F.col("tf")
        idf = F.log(F.lit(1.0) + (n - df + F.lit(0.5)) / (df + F.lit(0.5)))
        norm = F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("length") / lengths
        part = idf * tf * F.lit(BM25_K1 + 1) / (tf + F.lit(BM25_K1) * norm)
        scored = hits.join(found, "term").groupBy(self.key).agg(F.sum(part).alias("score"))
        docs = self.documents if where is None else self.documents.filter(where)
        picked = list(dict.fromkeys([self.key, *columns]))
        best = docs.select(*picked).join(scored, self.key).withColumn("score", F.round("score", 6))
        return best.orderBy(F.desc("score"), F.asc(self.key)).limit(limit)


def query_words(spark: SparkSession, q: str) -> list[str]:
    """Distinct words of a phrase, cut like the words of a text."""
    return sorted(spark.range(1).select(F.array_distinct(words(F.lit(q)))).first()[0])


# --- digests and extraction ---------------------------------------------------------------------

def review_digest(catalog: DataFrame, reviews: DataFrame, k: int = 5, per_product: int = 3) -> DataFrame:
    """Review count, rating and the most typical sentences of the ``k`` best rated products.

    A sentence is typical when its words occur in many sentences of the same product.
    """
    own = reviews.filter(F.col("review_text").isNotNull())
    rated = own.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"),
        rounded_ratio(F.sum("rating"), F.count("rating"), 2).alias("avg_rating"))
    best = catalog.select("product_id", "product_name", "product_category").join(rated, "product_id").orderBy(
        F.desc("avg_rating"), F.asc("product_id")).limit(k)
    lines = own.join(best.select("product_id"), "product_id", "left_semi").select(
        "product_id", "review_id", F.posexplode(sentences("review_text")).alias("n", "sentence"))
    terms = lines.select("product_id", "review_id", "n",
                         F.explode(F.array_distinct(words("sentence"))).alias("term"))
    weight = terms.groupBy("product_id", "term").agg(F.count("*").alias("uses"))
    scored = terms.join(weight, ["product_id", "term"]).groupBy("product_id", "review_id", "n").agg(
        ratio(F.sum("uses"), F.count("*")).alias("typical"), F.count("*").alias("size")).filter(F.col("size") >= 3)
    top = first_per_key(scored, ["product_id"], [F.desc("typical"), F.asc("review_id"), F.asc("n")],
                        per_product, rank="place")
    text = top.join(lines, ["product_id", "review_id", "n"]).groupBy("product_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "sentence"))),
                                 lambda s: s["sentence"]), ". ").alias("review_summary"))
    return best.join(text, "product_id", "left")


def extract_amounts_dates(df: DataFrame, key: str, text: str) -> DataFrame:
    """Amounts and dates of a text as a JSON array of records.

    A record is an amount with the date named in the same sentence (the last one where
    there are fewer dates than amounts, none where there is no date) and that sentence.
    """
    def found(part: Column, pattern: str) -> Column:
        return F.regexp_extract_all(part, F.lit(f"({pattern})"), F.lit(1))

    def records(part: Column) -> Column:
        dates = found(part, DATE)
        return F.transform(found(part, AMOUNT), lambda a, i: F.struct(
            a.alias("amount"), F.get(dates, F.least(i, F.size(dates) - F.lit(1))).alias("date"),
            F.trim(part).alias("description")))

    t = F.col(text)
    return df.select(
        key, F.size(found(t, AMOUNT)).alias("n_amounts"), F.size(found(t, DATE)).alias("n_dates"),
        F.to_json(F.flatten(F.transform(F.split(t, STATEMENT_BREAK), records))).alias("records"))


def extract_sentences(df: DataFrame, key: str, text: str, cues: Mapping[str, Sequence[str]]) -> DataFrame:
    """Sentences that hold a cue word, one column per kind (such as pros and cons)."""
    parsed = df.select(key, F.transform(sentences(text), lambda s: F.struct(s.alias("s"), words(s).alias("w"))).alias("p"))
    out = []
    for kind, vocabulary in cues.items():
        picked = F.filter("p", _holds("w", vocabulary))
        out.append(F.array_join(F.transform(picked, lambda x: x["s"]), " | ").alias(kind))
    return parsed.select(key, *out)


def redact_pii(text: Column | str) -> Column:
    """Mail addresses, card numbers and telephone numbers replaced by their kind."""
    c = F.col(text) if isinstance(text, str) else text
    for pattern, kind in ((EMAIL, "[EMAIL]"), (CARD, "[CARD]"), (PHONE, "[PHONE]")):
        c = F.regexp_replace(c, pattern, kind)
    return c


def eval_dataset(rows: DataFrame, query: str, truth: str) -> DataFrame:
    """Questions with a ground truth held as a variant."""
    return rows.select(F.col(query).alias("input_query"), F.try_parse_json(F.col(truth)).alias("ground_truth"))
