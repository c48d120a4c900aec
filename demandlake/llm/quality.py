"""Document quality by gradient-boosted trees over document statistics.

Statistics are taken from whole texts and written once. A bounded sample of labelled rows
reaches the driver, where histogram boosting grows small trees; they are flattened into
arrays, and every batch of rows walks all trees at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import crc_of, draw, per_batch, written

# The most labelled rows of each label that training takes in.
ROWS_PER_LABEL = 8_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
LEAST_ROWS = 8
SHRINK = 1.0

STATISTICS = (
    "words words_log word_length distinct_words top_word repeated_next upper_words sign_ends sign_words "
    "upper digits signs spaces high_bytes bars bangs line_words distinct_lines sentence_words packed stops entropy"
).split()

_WINDOW = 1 << 16


def _classes() -> np.ndarray:
    kinds = np.zeros((256, 6), np.int64)
    for b in range(256):
        c = chr(b)
        kinds[b] = (65 <= b <= 90, 48 <= b <= 57, b < 128 and c.isprintable() and not c.isalnum() and c != " ", b in b" \t\n\r\v\f", b >= 128, 97 <= b <= 122)
    return kinds


_KINDS = _classes()
_SIGNS = b"!\"#$%&'()*+-/:;<=>?@[\\]^_`{|}~"


def statistics(text: bytes | None) -> list[float]:
    """The statistics of one text, in the order of ``STATISTICS``; all zero without words."""
    raw = text or b""
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    counts = Counter(words)
    histogram = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digits, signs, spaces, high, _ = (histogram @ _KINDS / size).tolist()
    share = histogram[histogram > 0] / size
    lines = [line for line in raw.split(b"\n") if line.strip()]
    stops = sum(histogram[b] for b in b".!?")
    packed = sum(len(zlib.compress(raw[i : i + _WINDOW], 1)) for i in range(0, size, _WINDOW))
    ends = sum(1 for w in words if w[-1] in _SIGNS)
    plain = sum(1 for w in words if len(w) > 1 and w[-1] in _SIGNS and w[-2] in _SIGNS)
    return [
        float(n),
        float(np.log2(n)),
        (size - float(spaces) * size) / n,
        len(counts) / n**0.8,
        counts.most_common(1)[0][1] / n,
        sum(map(bytes.__eq__, words[1:], words)) / n,
        sum(1 for w in words if w.isupper() and len(w) > 1) / n,
        ends / n,
        plain / n,
        upper,
        digits,
        signs,
        spaces,
        high,
        float(histogram[ord("|")]) / n,
        float(histogram[ord("!")]) / n,
        n / len(lines),
        len(set(lines)) / len(lines),
        n / (1.0 + float(stops)),
        packed / (size + 64.0),
        float(stops) / n,
        float(-(share * np.log2(share)).sum()),
    ]


# ----------------------------------------------------------------- boosting


@dataclass
class Trees:
    """Trees of one depth, level by level: ``feature`` and ``threshold`` hold ``2**depth - 1`` inner
    nodes a tree, ``leaf`` holds ``2**depth`` values. A value above the threshold goes right."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row."""
        total = np.full(len(rows), self.base)
        trees, inner = self.feature.shape
        if trees:
            at = np.zeros((len(rows), trees), np.int64)
            tree = np.arange(trees)
            for _ in range(int(np.log2(inner + 1))):
                value = np.take_along_axis(rows, self.feature[tree, at], axis=1)
                at = 2 * at + 1 + (value > self.threshold[tree, at])
            total = total + self.leaf[tree, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boost trees on the logistic loss over features cut into ``BINS`` quantile bins.

    Both labels weigh the same in all. Without rows every score is one half; with one
    label only, all scores lean to it.
    """
    inner = (1 << depth) - 1
    if not len(rows):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 0.0)
    share = labels.mean()
    if share in (0.0, 1.0):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), 4.0 if share else -4.0)
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    features = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(features)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.zeros(len(rows))
    chosen, limits, values = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = weight * (labels - chance), weight * chance * (1 - chance)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            best = np.full(nodes, 1e-9)
            split = np.full((nodes, 2), -1)
            for f in range(features):
                cell = (at - first) * BINS + binned[:, f]
                g, h, c = (
                    np.bincount(cell, w, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1) for w in (slope, bend, None)
                )
                gain = g**2 / (h + SHRINK) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + SHRINK) - g[:, -1:] ** 2 / (h[:, -1:] + SHRINK)
                gain[(c < LEAST_ROWS) | (c[:, -1:] - c < LEAST_ROWS)] = -1
                gain[:, len(cuts[f]) :] = -1
                cut = gain.argmax(axis=1)
                better = gain[np.arange(nodes), cut] > best
                best[better] = gain[np.arange(nodes), cut][better]
                split[better] = np.stack([np.full(nodes, f), cut], axis=1)[better]
            for k in np.flatnonzero(split[:, 0] >= 0):
                feature[first + k], threshold[first + k] = split[k, 0], cuts[split[k, 0]][split[k, 1]]
            at = 2 * at + 1 + (rows[np.arange(len(rows)), feature[at]] > threshold[at])
        leaf_of = at - inner
        leaf = RATE * np.bincount(leaf_of, slope, inner + 1) / (np.bincount(leaf_of, bend, inner + 1) + SHRINK)
        margin += leaf[leaf_of]
        chosen.append(feature)
        limits.append(threshold)
        values.append(leaf)
    return Trees(np.array(chosen), np.array(limits), np.array(values), 0.0)


# ----------------------------------------------------------------- operator


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``crc`` of the text and ``stats`` for every row."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text").to_pylist()
            found = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            crc = pa.array([zlib.crc32(t or b"") for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), crc, found], ["doc_id", "crc", "stats"])

        return apply

    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    )
    return per_batch(narrow, make, "doc_id long, crc long, stats array<double>")


def train(stats: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> Trees:
    """Trees learned from ``stats`` joined with ``labels`` (``doc_id``, ``quality``).

    A sample drawn by identifier, ``rows_per_label`` rows of each label at most, reaches
    the driver. Labels that are neither 0 nor 1 and rows without identifier teach
    nothing; a document labelled twice counts twice.
    """
    marked = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if not counts:
        return grow(np.empty((0, len(STATISTICS))), np.empty(0))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 0.9 * rows_per_label / n))])
    drawn = draw(F.col("doc_id"), "quality")
    sample = marked.where(drawn < F.element_at(share, F.col("label"))).withColumn("at", drawn)
    joined = sample.join(stats, "doc_id").select("at", "doc_id", "label", "stats")
    rows = joined.orderBy("at", "doc_id", "label", "stats").limit(2 * rows_per_label).collect()
    data = np.array([r["stats"] for r in rows], float).reshape(-1, len(STATISTICS))
    return grow(data, np.array([r["label"] for r in rows], float))


def scored(stats: DataFrame, trees: Trees) -> DataFrame:
    """All columns of ``stats`` but the statistics, and ``score``."""
    kept = [c for c in stats.columns if c != "stats"]

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            score = trees.score(flat.reshape(-1, len(STATISTICS)))
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(score)], [*kept, "score"])

        return apply

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields if f.name in kept)
    return per_batch(stats, make, f"{fields}, score double")


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """Quality of all documents by trees that never saw a label of the held-out fold.

    Returns ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row,
    and ``crc``, the CRC-32 of the text. The score depends on the whole text alone: a
    null text is scored as an empty one, repeated rows alike. A null identifier is in no
    fold. An empty table gives an empty one; without labels every score is one half.
    """
    stats = written(measured(docs), "statistics")
    fold = F.pmod(crc_of(F.col("doc_id")), F.lit(folds))
    trees = train(stats, labels.where(fold != held))
    return scored(stats, trees).select(
        "doc_id",
        F.coalesce(fold == held, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "crc",
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be good; what it rejects goes."""
    rejected = (
        quality(docs, labels)
        .where("predicted = 0")
        .select(F.col("doc_id").alias("__id"), F.col("crc").alias("__crc"))
        .distinct()
    )
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col("__id")) & (crc == F.col("__crc")), "left_anti")
