"""Secret scans: fixed patterns, and a battery of randomness tests on other long tokens.

A token is read as a sequence of symbol values of the smallest encoding that holds all its
symbols: hexadecimal, letters, base 32 or 36 of one case, letters of both cases, base 58
or 64. Under the hypothesis that it is random, three tests give a p-value each:
chi-squared uniformity over eight equal parts of the alphabet, the number of runs above
and below the middle, and the serial correlation of neighbours. Letters stand in the order
of how common they are, so ordinary words fill the first parts and leave the last ones
empty. Fisher's method combines the tests. Over all tokens of the corpus, the hypothesis is
rejected with false-discovery control, p-values weighted by the squared length: short
tokens are words more often, and more evidence is wanted that they are none. Tokens for
which the hypothesis stands are secrets. Below 20 code points the tests can't tell.

Only DataFrame functions are used. Each text's spans stay arrays of its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import stage, text_or_empty

#: Fixed patterns: kind, regular expression, group that counts, its least length.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
#: A run is taken whole, so its least length can stand in the pattern of the other two.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Tokens the tests look at.
LOOSE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")
#: Share of random tokens among those taken for ordinary ones, at most.
FALSE_SHARE = 0.08
#: Letters by how common they are in ordinary text (fixed values).
COMMON = "etaoinshrdlcumwfgypbvkjxqz"
DIGITS = "0123456789"
#: Encodings, smallest first: symbols in the order of their values, and the tokens that fit.
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "letters": COMMON,
    "base32": COMMON + "234567",
    "base36": COMMON + DIGITS,
    "mixed": COMMON + COMMON.upper(),
    "base58": "".join(c for c in COMMON + COMMON.upper() + DIGITS if c not in "0OIl"),
    "base64": COMMON + COMMON.upper() + DIGITS + "+/",
}
FITS = {
    "hex": "^([0-9a-f]+|[0-9A-F]+)$",
    "letters": "^([a-z]+|[A-Z]+)$",
    "base32": "^([a-z2-7]+|[A-Z2-7]+)$",
    "base36": "^([a-z0-9]+|[A-Z0-9]+)$",
    "mixed": "^[A-Za-z]+$",
    "base58": "^[1-9A-HJ-NP-Za-km-z]+$",
}
#: Encodings of one case.
ONE_CASE = ("hex", "letters", "base32", "base36")
SPAN = "array<struct<start:int,stop:int,kind:int>>"


def spans(text: str, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Spans (start, stop, kind) of a pattern's matches, leftmost and without overlap.

    Positions are code points: the lengths of the matches and of what lies between them,
    added up.
    """
    t = F.col(text)
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    size = F.transform(found, F.char_length)
    gap = F.transform(F.split(t, pattern, -1), F.char_length)
    part = F.transform(F.regexp_extract_all(t, F.lit(pattern), F.lit(group)), F.char_length) if group else size
    walk = F.aggregate(
        F.arrays_zip(size.alias("s"), gap.alias("g"), part.alias("p")),
        F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["g"] + F.coalesce(x["s"], F.lit(0))).alias("at"),
            F.when(x["p"] >= F.lit(least), F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + x["g"]).alias("start"), (acc["at"] + x["g"] + x["s"]).alias("stop"),
                F.lit(kind).alias("kind"))))).otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])
    # Most texts have no match: one search tells.
    return F.when(t.rlike(pattern), walk).otherwise(F.array().cast(SPAN))


def upper_tail(z: Column) -> Column:
    """Probability of a standard normal above ``z`` (rational approximation, error below 1e-7)."""
    a = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.2316419) * a)
    # Fixed coefficients of the approximation.
    poly = F.lit(0.0)
    for c in (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = (poly + F.lit(c)) * t
    tail = F.exp(-a * a / F.lit(2.0)) * F.lit(0.3989422804014327) * poly
    return F.when(z >= 0, tail).otherwise(F.lit(1.0) - tail)


def battery(tokens: Column) -> Column:
    """Add ``p``, the combined p-value of randomness, to structs that have start, stop and token."""
    def typed(x: Column) -> Column:
        tok = x["token"]
        kind = F.lit("base64")
        for name, pattern in reversed(FITS.items()):
            kind = F.when(tok.rlike(pattern), F.lit(name)).otherwise(kind)
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), tok.alias("token"), kind.alias("kind"))

    def read(x: Column) -> Column:
        letters = F.lit(ALPHABETS["base64"])
        for name, alphabet in ALPHABETS.items():
            letters = F.when(x["kind"] == name, F.lit(alphabet)).otherwise(letters)
        symbols = F.when(x["kind"].isin(*ONE_CASE), F.lower(x["token"])).otherwise(F.translate(x["token"], "-_", "+/"))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), letters.alias("letters"), symbols.alias("read"))

    def valued(x: Column) -> Column:
        size = F.char_length(x["letters"])
        v = F.transform(F.split(x["read"], ""), lambda ch: F.position(ch, x["letters"]) - F.lit(1))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), size.alias("size"), v.alias("v"),
                        F.size(v).cast("double").alias("n"),
                        F.aggregate(v, F.lit(0.0), lambda s, e: s + e).alias("sum"))

    def measured(x: Column) -> Column:
        v, n = x["v"], x["n"]

        def part(b: Column) -> Column:
            """Squared deviation of a part from what its number of symbols leads to expect."""
            seen = F.size(F.filter(v, lambda e: F.floor(e * F.lit(8) / x["size"]) == b))
            symbols = F.ceil((b + F.lit(1)) * x["size"] / F.lit(8.0)) - F.ceil(b * x["size"] / F.lit(8.0))
            expected = n * symbols / x["size"]
            return (seen - expected) * (seen - expected) / expected

        chi = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(7)), part), F.lit(0.0), lambda s, o: s + o)
        up = F.transform(v, lambda e: (e * F.lit(2) >= x["size"]).cast("int"))
        pairs = F.sequence(F.lit(1), F.size(v) - F.lit(1))
        runs = F.aggregate(pairs, F.lit(1.0), lambda s, i: s + (
            (F.get(v, i) * F.lit(2) >= x["size"]) != (F.get(v, i - F.lit(1)) * F.lit(2) >= x["size"])).cast("double"))
        high = F.aggregate(up, F.lit(0.0), lambda s, e: s + e)
        mean = x["sum"] / n
        spread = F.aggregate(v, F.lit(0.0), lambda s, e: s + (e - mean) * (e - mean))
        serial = F.aggregate(pairs, F.lit(0.0), lambda s, i: s + (F.get(v, i) - mean) * (F.get(v, i - F.lit(1)) - mean))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), n.alias("n"), chi.alias("chi"),
                        runs.alias("runs"), high.alias("high"), spread.alias("spread"), serial.alias("serial"))

    def judged(x: Column) -> Column:
        n, h = x["n"], x["high"]
        low = n - h
        # Wilson and Hilferty's normal form of chi-squared with seven degrees of freedom.
        k = 2.0 / (9 * 7)
        p1 = upper_tail((F.cbrt(x["chi"] / F.lit(7.0)) - F.lit(1 - k)) / F.lit(k ** 0.5))
        mid = F.lit(2.0) * h * low / n + F.lit(1.0)
        var = (mid - F.lit(1.0)) * (mid - F.lit(2.0)) / (n - F.lit(1.0))
        p2 = F.when(var > 0, F.lit(2.0) * upper_tail(F.abs(x["runs"] - mid) / F.sqrt(var))).otherwise(F.lit(0.0))
        p3 = F.when(x["spread"] > 0, F.lit(2.0) * upper_tail(F.abs(
            (x["serial"] / x["spread"] + F.lit(1.0) / n) * F.sqrt(n)))).otherwise(F.lit(0.0))
        half = F.lit(0.0)
        for p in (p1, p2, p3):
            half = half - F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300)))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), n.alias("n"), half.alias("half"))

    def combined(x: Column) -> Column:
        # Fisher: -2 times the sum of logarithms is chi-squared with six degrees of freedom.
        s = x["half"]
        p = F.exp(-s) * (F.lit(1.0) + s + s * s / F.lit(2.0))
        return F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["n"].alias("n"), p.alias("p"))

    out = tokens
    for step in (typed, read, valued, measured, judged, combined):
        out = F.transform(out, step)
    return out


def rejected_below(p: DataFrame, share: float) -> float:
    """Benjamini and Hochberg's threshold over the column ``p``, by counting.

    From the whole share, t goes to share * (number of p <= t) / total until it stands still;
    each step is one aggregate, and no p-value is ordered.
    """
    total = p.count()
    t = share
    while total:
        new = share * p.filter(F.col("p") <= F.lit(t)).count() / total
        if new >= t:
            break
        t = new
    return t


def scan(docs: DataFrame, text_col: str = "text", drop_text: bool = True) -> DataFrame:
    """Add ``__base`` (fixed patterns) and ``__added`` (random tokens) to each row.

    Spans are (start, stop, kind) in code points, by start, then kind; kind is a position
    in ``KINDS``. A null or empty text has no spans. Repeated rows each get their own
    row; all other columns are kept; an empty table gives an empty result.
    """
    rows = docs.withColumn("__text", text_or_empty(text_col))
    base = F.concat(spans("__text", ASSIGN, 0, group=2, least=12), spans("__text", ACCESS, 1), spans("__text", HEX, 2))
    found = rows.withColumn("__base", F.array_sort(base)).withColumn("__loose", spans("__text", LOOSE, 3))
    free = F.filter("__loose", lambda x: ~F.exists(
        "__base", lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"])))
    found = found.withColumn("__free", free)
    tokens = F.transform("__free", lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"),
        F.substring(F.col("__text"), x["start"] + F.lit(1), x["stop"] - x["start"]).alias("token")))
    found = found.withColumn("__tested", battery(tokens)).drop("__text", "__loose", "__free")
    found = stage(found.drop(text_col) if drop_text else found)

    each = found.select(F.explode("__tested").alias("x")).select("x.n", "x.p")
    mean = each.agg(F.avg("n")).first()[0] or 1.0
    def weighted(p: Column, n: Column) -> Column:
        return p * n * n / F.lit(mean * mean)

    t = rejected_below(each.select(weighted(F.col("p"), F.col("n")).alias("p")), FALSE_SHARE)
    random = F.filter("__tested", lambda x: weighted(x["p"], x["n"]) > F.lit(t))
    return found.withColumn("__added", F.transform(random, lambda x: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), F.lit(3).alias("kind")))).drop("__tested")


def _listed(spans_of: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans_of, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"], x["stop"])), ",")


def op9(docs: DataFrame) -> DataFrame:
    """The registered report."""
    def count(kind: int) -> Column:
        return F.size(F.filter("__base", lambda x: x["kind"] == F.lit(kind))).cast("long")

    return scan(docs.select("doc_id", "text")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("__base", "__added"))).alias("spans"))


def mask_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """All documents, with each secret in the text replaced by ``mark``."""
    found = scan(docs, text_col, drop_text=False)
    found = found.withColumn("__spans", F.array_sort(F.concat("__base", "__added")))
    return found.withColumn(text_col, mask(text_col, "__spans", mark)).drop("__base", "__added", "__spans")


def mask(text: str, spans_of: str, mark: str = "[secret]") -> Column:
    """The text with each span replaced by ``mark``; overlapping spans are replaced together."""
    merged = F.aggregate(
        F.col(spans_of), F.array().cast("array<struct<start:int,stop:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, F.when(F.size(acc) > 0, F.size(acc)).otherwise(1))["stop"] >= x["start"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - F.lit(1)), F.array(F.struct(
                F.element_at(acc, F.when(F.size(acc) > 0, F.size(acc)).otherwise(1))["start"].alias("start"),
                F.greatest(F.element_at(acc, F.when(F.size(acc) > 0, F.size(acc)).otherwise(1))["stop"],
                           x["stop"]).alias("stop")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))))
    t = F.col(text)
    masked = F.aggregate(
        merged, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(x["stop"].alias("at"), F.concat(
            acc["out"], F.substring(t, acc["at"] + F.lit(1), x["start"] - acc["at"]), F.lit(mark)).alias("out")),
        lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + F.lit(1), F.char_length(t) - acc["at"])))
    return F.when(F.size(spans_of) > 0, masked).otherwise(t)
