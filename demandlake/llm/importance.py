"""Importance resampling: documents drawn as if they came from the distribution of a target collection.

Features are runs of one to three words, hashed into buckets. A bucket's gain is the
logarithm of how much likelier it is in the target than in the documents; a document weighs the
sum over its features, read from one array. Weights with Gumbel noise added are scores, and the
documents with the highest scores are the draw. Which score is the last one drawn is found by
bisection: exact counts of the stored scores above a few thresholds at a time, then of the
identifiers that tie there. No rows are sorted but those drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import Batches, in_batches, written
from demandlake.operators.running import positions

BUCKETS = 10_000
LEAST_WORDS = 20
SHARE = 5
SEED = 42
# Thresholds counted in one job.
_MARKS = 16
_PIECE = 1 << 20
_LAST = (1 << 63) - 1


def _kept(byte: int) -> int:
    letter = chr(byte)
    return byte if byte > 127 or letter.isalnum() else 32


_WORDS = bytes(_kept(b) for b in range(256)).lower()


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time: no list of words is made of a very long text."""
    at = 0
    while at < len(text):
        end, cut = at + _PIECE, at
        # a piece grows until it ends between words
        while cut <= at and end < len(text):
            cut = text[at:end].translate(_WORDS).rfind(b" ") + 1 + at
            end += _PIECE if cut <= at else 0
        end = cut if cut > at else len(text)
        if words := text[at:end].translate(_WORDS).split():
            yield words
        at = end


def features(text: bytes | None) -> Iterator[tuple[int, np.ndarray]]:
    """For each piece of a text its number of words and the CRC-32 of every feature that ends in it.

    A run's checksum goes on from that of the run without its last word.
    """
    last_one: list[int] = []
    last_two: list[int] = []
    for words in _pieces(text or b""):
        more = [b" " + w for w in words]
        one = list(map(crc32, words))
        two = list(map(crc32, more if last_one else more[1:], chain(last_one, one)))
        skip = 0 if last_two else 1 if last_one else 2
        three = list(map(crc32, more[skip:], chain(last_two, two)))
        last_one, last_two = one[-1:], two[-1:]
        yield len(words), np.fromiter(chain(one, two, three), np.int64, len(one) + len(two) + len(three))


def _texts(docs: DataFrame, text_col: str) -> Column:
    return F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; a task sends one number per bucket."""

    def count(batches: Batches) -> Batches:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                for _, found in features(text.as_py()):
                    total += np.bincount(found % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    counted = in_batches(docs.select(_texts(docs, text_col)), count, "bucket long, n long")
    result = np.zeros(buckets, np.int64)
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        result[bucket] = n
    return result


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of a nat by which a feature of each bucket speaks for the target, rounded down."""
    buckets, all_docs, all_target = len(docs), float(docs.sum()), float(target.sum())

    def gain(s: float, t: float) -> int:
        return math.floor(1000 * math.log((t + 1) * (all_docs + buckets) / ((s + 1) * (all_target + buckets))))

    return np.array([gain(s, t) for s, t in zip(docs.astype(float), target.astype(float), strict=True)], np.int64)


def scores(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of every row, written, with a ``number`` of its own.

    A null text has no features and weighs nothing. The noise of a row without an identifier is that
    of an empty one.
    """
    table = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))

    def weigh(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                words = many = weight = 0
                for n, found in features(text.as_py()):
                    words, many, weight = words + n, many + len(found), weight + int(table[found % buckets].sum())
                rows.append((words, many, weight))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _texts(docs, text_col))
    weighed = in_batches(narrow, weigh, "doc_id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = weighed.withColumn("score", F.col("weight") + noise)
    return written(scored.withColumn("number", F.monotonically_increasing_id()), "scored")


def cutoff(rows: DataFrame, column: str, need: int) -> tuple[int, int, int]:
    """The smallest value of a whole-number column such that ``need`` rows have it or less.

    Also the number of rows below it, and of those with it. Bisection: each job counts, over the values
    still in question, the rows up to a few thresholds.
    """
    low, high, below = *rows.agg(F.min(column), F.max(column)).first(), 0
    while low < high:
        marks = sorted({low + (high - low) * i // _MARKS for i in range(_MARKS)})
        within = rows.where(F.col(column).between(low, high))
        counts = within.agg(*[F.count_if(F.col(column) <= m) for m in marks]).first()
        reached = next((i for i, n in enumerate(counts) if below + n >= need), len(marks))
        if reached:
            low, below_next = marks[reached - 1] + 1, below + counts[reached - 1]
        else:
            below_next = below
        high = marks[reached] if reached < len(marks) else high
        below = below_next
    return low, below, rows.where(F.col(column) == low).count()


def up_to(rows: DataFrame, columns: Sequence[str], need: int) -> Column:
    """The condition that holds for the first ``need`` rows in the order of some whole-number columns.

    The last column has to tell rows apart. Later columns only matter among rows that tie in earlier ones.
    """
    chosen, tied, ties = F.lit(False), F.lit(True), rows
    for column in columns:
        value, below, equal = cutoff(ties, column, need)
        chosen = chosen | (tied & (F.col(column) < value))
        tied, need = tied & (F.col(column) == value), need - below
        if need == equal:
            break
        ties = ties.where(F.col(column) == value)
    return chosen | tied


def ranked(scored: DataFrame, share: float = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """``scored`` with the ``rank`` of the highest scores: ``share`` percent of the rows with enough words, rounded down.

    Equal scores go by the smaller identifier, missing ones last, and rows that share both in any order.
    Rows that are not drawn have no rank.
    """
    # score and identifier as numbers that only rise in the order of the draw
    ready = scored.withColumns({"__fall": -F.col("score"), "__id": F.coalesce("doc_id", F.lit(_LAST))})
    able = ready.where(F.col("n_words") >= least_words)
    drawn = int(share * able.count() // 100)
    undrawn = F.lit(None).cast("long").alias("rank")
    if not drawn:
        return scored.select("*", undrawn)
    order = ("__fall", "__id", "number")
    chosen = (F.col("n_words") >= least_words) & up_to(able.select(*order), order, drawn)
    first = positions(ready.where(chosen), [], [F.col(c).asc() for c in order], "rank")
    return first.select(*scored.columns, "rank").unionByName(ready.where(~chosen).select(*scored.columns, undrawn))


def importance(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Every row's ``doc_id``, ``n_features``, ``weight``, ``score`` and, if it is drawn, ``rank``.

    Null and empty texts have no features; a text with fewer words than three has fewer runs. An empty
    target weighs by rarity alone; an empty table gives an empty one. Rows that repeat weigh the same
    and are drawn one by one. Other columns are not looked at.
    """
    return ranked(scores(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is drawn, all columns as they are; repeated identifiers stay together."""
    drawn = ranked(scores(docs, target, seed=seed), share).where(F.col("rank").isNotNull())
    ids = drawn.select(F.col("doc_id").alias("__drawn")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__drawn")), "left_semi")
