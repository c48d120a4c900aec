"""Secrets in text: fixed patterns, and tokens that look random.

Two character Markov models, one of random strings and one of ordinary identifiers, are
trained from labelled samples. A token is reported if its log-likelihood ratio says random.
Everything runs as column expressions; texts never leave the engine.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Kinds in the order in which they are listed, with patterns; the last is the method's own.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
# Runs of token characters that hold a digit, from their first character on.
TOKEN = r"[A-Za-z+/_=-]*[0-9][A-Za-z0-9+/_=-]*"
# The same for an engine that goes back: a run is looked at from its start only, and once.
_TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z+/_=-]*+[0-9][A-Za-z0-9+/_=-]*+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_TOKEN = 12, 18, 20
# Bits by which each pair of characters must speak for a random string, on average, in thousandths.
THRESHOLD = 900
MASK = "[SECRET]"

# Printable ASCII without the blank.
_FIRST, _LETTERS = 33, 94
SAMPLES = 4_000

# Words that ordinary identifiers are made of.
WORDS = (
    "account action active address admin agent alert amount archive array async author backup balance batch binary "
    "block branch buffer build bundle button cache calendar cancel category channel chapter check client cluster code "
    "column comment commit config connect content context control copy count create current customer daily data date "
    "debug default delete detail device display document domain download driver email empty enable encode engine entry "
    "error event example export factory feature field file filter folder format frame function global group handler "
    "header history image import index input insert instance invoice item job journal kernel key label language layer "
    "layout level library limit line list loader local logger manager map market master memory menu message method "
    "metric model module monitor month name network node note number object office option order output owner package "
    "page parser partner path payment person phone platform policy portal price print process product profile project "
    "public query queue random range record region release remote report request reset result review route sample "
    "schema scope screen search section select sender server service session setting shadow shape share signal simple "
    "single size socket source stage state status stock store stream string style subject summary switch symbol system "
    "table target task team template test text thread time title today toggle total trace track train transfer tree "
    "trigger type update upload user value vector vendor version view volume warning week window worker writer year zone"
).split()


def labelled_samples(spark: SparkSession, many: int = SAMPLES) -> DataFrame:
    """``value`` and ``random``: strings made from digests, and identifiers made from words."""
    numbers = spark.range(1, many + 1)
    words = F.split(F.lit(" ".join(WORDS)), " ")
    one, two, three = (
        F.element_at(words, ((F.col("id") * step + shift) % len(WORDS) + 1).cast("int"))
        for step, shift in ((7919, 11), (104729, 29), (1299709, 53))
    )
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id").cast("string")), 256)
    packed = F.base64(F.unhex(digest))
    random = (
        F.when(F.col("id") % 4 == 0, F.substring(digest, 1, 40))
        .when(F.col("id") % 4 == 1, packed)
        .when(F.col("id") % 4 == 2, F.upper(F.regexp_replace(packed, "[+/=]", "")))
        .otherwise(F.translate(packed, "+/=", "-_"))
    )
    number = (F.col("id") % 90).cast("string")
    ordinary = (
        F.when(F.col("id") % 8 == 0, F.concat_ws("_", one, two, three))
        .when(F.col("id") % 8 == 1, F.concat(one, F.initcap(two), F.initcap(three)))
        .when(F.col("id") % 8 == 2, F.concat_ws("-", one, two, three, number))
        .when(F.col("id") % 8 == 3, F.upper(F.concat_ws("_", one, two, number)))
        .when(F.col("id") % 8 == 4, F.concat(one, two, three))
        .when(F.col("id") % 8 == 5, F.concat_ws("/", one, two, three))
        .when(F.col("id") % 8 == 6, F.concat(one, number, two, F.lit("="), three, number))
        .otherwise(F.concat(F.initcap(one), F.lit("-"), (1950 + F.col("id") % 80).cast("string"), F.lit("-"), number, F.lit("-"), two))
    )
    return numbers.select(random.alias("value"), F.lit(True).alias("random")).union(
        numbers.select(ordinary.alias("value"), F.lit(False).alias("random"))
    )


@dataclass(frozen=True)
class MarkovModel:
    """Thousandths of a bit by which a pair of characters speaks for a random string, by pair."""

    weights: tuple[int, ...]

    def ratio(self, token: Column) -> Column:
        """Sum of the weights of all pairs of neighbours in a token of printable ASCII."""
        table = F.split(F.lit(",".join(map(str, self.weights))), ",").cast("array<int>")
        pairs = F.sequence(F.lit(1), F.length(token) - 1)

        def of(held: Column) -> Column:
            code = lambda at: F.ascii(F.substring(held, at, 1).cast("string")) - F.lit(_FIRST)
            step = lambda total, at: total + F.get(table, code(at) * _LETTERS + code(at + 1))
            return F.aggregate(pairs, F.lit(0).cast("long"), step)

        # bytes have their places, characters of a string are counted from its start every time
        return F.get(F.transform(F.array(token.cast("binary")), of), 0)


def train(samples: DataFrame) -> MarkovModel:
    """The model of labelled samples (``value``, ``random``): one aggregation, 2 x 94 x 94 counts at most.

    Counts are smoothed by one half. Values with other than printable ASCII characters,
    nulls and values of one character teach nothing.
    """
    usable = samples.where(F.col("value").rlike(r"\A[!-~]{2,}\z"))
    at = F.explode(F.sequence(F.lit(1), F.length("value") - 1))
    pairs = usable.select("value", "random", at.alias("at")).select(
        "random",
        (F.ascii(F.col("value").substr(F.col("at"), F.lit(1))) - _FIRST).alias("one"),
        (F.ascii(F.col("value").substr(F.col("at") + 1, F.lit(1))) - _FIRST).alias("two"),
    )
    counts = {(r["random"], r["one"], r["two"]): r["count"] for r in pairs.groupBy("random", "one", "two").count().collect()}
    weights = []
    for one in range(_LETTERS):
        rows = [[counts.get((kind, one, two), 0) + 0.5 for two in range(_LETTERS)] for kind in (True, False)]
        sums = [sum(row) for row in rows]
        weights += [round(1000 * (log2(a / sums[0]) - log2(b / sums[1]))) for a, b in zip(*rows, strict=True)]
    return MarkovModel(tuple(weights))


# -------------------------------------------------------------------- spans


def _found(text: Column, pattern: str, value_group: int = 0) -> Column:
    """All matches, leftmost first and not overlapping: start and end in code points, and a group."""
    pieces, whole, value = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), None
    value = whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    parts = F.arrays_zip(pieces.alias("piece"), whole.alias("whole"), value.alias("value"))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(held: Column, part: Column) -> Column:
        start = held["at"] + F.length(part["piece"])
        end = start + F.length(F.coalesce(part["whole"], F.lit("")))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value")))
        spans = F.when(part["whole"].isNull(), held["spans"]).otherwise(F.concat(held["spans"], one))
        return F.struct(end.alias("at"), spans.alias("spans"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda held: held["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(empty)


def _of_kind(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def scan(docs: DataFrame, model: MarkovModel) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of start, rank, end and kind, sorted by start and kind.

    ``base`` holds what the fixed patterns find, ``spans`` these and the tokens of kind
    ``random`` that overlap none of them. A null text holds nothing, as an empty one.
    Columns of ``docs`` called ``base`` or ``spans`` are replaced.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    assign = F.filter(_found(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= LEAST_ASSIGN)
    access = F.filter(_found(text, ACCESS), lambda s: F.length(s["value"]) >= LEAST_ACCESS)
    tokens = F.filter(
        _found(text, _TOKEN),
        lambda s: (F.length(s["value"]) >= LEAST_TOKEN)
        & (model.ratio(s["value"]) >= F.lit(THRESHOLD).cast("long") * (F.length(s["value"]) - 1)),
    )
    base = F.array_sort(
        F.concat(_of_kind(assign, 0, "assign"), _of_kind(access, 1, "access"), _of_kind(_found(text, HEX), 2, "hex"))
    )
    others = docs.drop("base", "spans")
    marked = others.withColumn("base", base).withColumn("__tokens", _of_kind(tokens, 3, "random"))
    apart = F.filter(
        "__tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    )
    return marked.withColumn("spans", F.array_sort(F.concat("base", apart))).drop("__tokens")


def _listed(spans: str) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def secrets(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the secrets of every document.

    Returns ``doc_id``, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``,
    spans as ``kind:start:end`` in code points, joined by commas; empty lists are empty
    strings. Rows that repeat are scanned alike; an empty table gives an empty one.
    """
    found = scan(docs.select(F.col("doc_id").cast("long"), "text"), train(labelled_samples(docs.sparkSession)))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mask; other columns and null texts as they are."""
    scanned = scan(docs, train(labelled_samples(docs.sparkSession)))
    text = F.col("text").cast("string")

    def step(held: Column, span: Column) -> Column:
        before = F.substr(text, held["at"] + 1, F.greatest(span["start"] - held["at"], F.lit(0)))
        new = F.when(span["start"] >= held["at"], F.concat(held["out"], before, F.lit(MASK))).otherwise(held["out"])
        return F.struct(F.greatest(held["at"], span["end"]).alias("at"), new.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("spans", start, step, lambda held: F.concat(held["out"], F.substr(text, held["at"] + 1)))
    clean = F.when(F.size("spans") > 0, masked).otherwise(text)
    return scanned.withColumn("text", clean).select(*docs.columns)
