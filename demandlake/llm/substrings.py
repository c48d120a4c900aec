"""Removal of passages that repeat across the corpus, found with suffix automata.

A window is ``span`` words. Every window picks the smallest of its word n-grams as anchor,
so equal windows have equal anchors, and the windows that share one form a context.
Anchors that occur once cannot lie in a repeated window. Contexts equal to an earlier one
repeat as a whole; the earliest of contexts that differ but share an anchor are the
reference of one shard: they are put into a suffix automaton in order of document and
position, which tells at each word the longest match with anything before it. Shards are
bounded: contexts of anchors that are frequent, or have too many contexts, are compared
window by window with the earliest occurrence of each window, which is an aggregate.

Shards are routed to the documents' contexts by anchor. Broadcasting automata of the
whole corpus to every document would read the corpus once per shard.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.rows import Batches, draw, in_batches, per_batch, written

SPAN = 20
_GRAM = 6
_NULL = -(1 << 63)
# Documents sampled to learn which anchors are frequent, and in how many of them such an anchor occurs.
SAMPLED = 4_000
FREQUENT = 8
# Occurrences of a frequent anchor are spread over so many groups.
_SALTS = 64
_MOST_FREQUENT = 50_000
# Contexts that an automaton takes; anchors with more that are to be compared are spread as well.
LARGEST = 1024

_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Powers:
    """Powers of an odd number and of its inverse, modulo 2**64."""

    base = 0xD6E8FEB86659FD93

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << n.bit_length()
            back = pow(self.base, -1, 1 << 64)
            self.up, self.down = (np.cumprod(np.array([1] + [x] * size, np.uint64)) for x in (self.base, back))


_powers = _Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xC4CEB9FE1A85EC53)


def contexts(words: list[bytes], span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each context: hash of its anchor, hash of its words, first window, number of windows.

    Contexts are alike if both hashes are, 128 bits together.
    """
    n = len(words)
    if n < span:
        none = np.empty(0, np.int64)
        return none, none, none, none
    hashes = np.frombuffer(array("Q", map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    _powers.reach(n + 1)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * _powers.up[:n])])

    def of_range(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * _powers.down[start])

    gram = min(_GRAM, span)
    at = np.arange(n - gram + 1)
    value = of_range(at, at + gram)
    best, reach, window = at, 1, span - gram + 1
    while reach < window:  # the leftmost smallest of 2, 4, ... up to all n-grams of a window
        shift = min(reach, window - reach)
        left, right = best[:-shift], best[shift:]
        best = np.where(value[left] <= value[right], left, right)
        reach += shift
    first = np.concatenate([[0], np.flatnonzero(best[1:] != best[:-1]) + 1])
    many = np.diff(np.concatenate([first, [len(best)]]))
    anchor = value[best[first]]
    place = (best[first] - first).astype(np.uint64)
    content = of_range(first, first + many + (span - 1))
    content = _mixed(content + place * _STEP)
    return anchor.view(np.int64), content.view(np.int64), first, many


def _packed(first: np.ndarray, many: np.ndarray, crc: int) -> np.ndarray:
    """First window, number of windows and 24 bits of the text's checksum, ordered by the first."""
    return (first.astype(np.int64) << 30) | (many.astype(np.int64) << 24) | crc


def _crc24(text: bytes) -> int:
    return zlib.crc32(text) & 0xFFFFFF


def _narrow(docs: DataFrame) -> DataFrame:
    """Identifier, the same with null as the smallest number, and the text's bytes."""
    key = F.col("doc_id").cast("long")
    return docs.select(
        key.alias("doc_id"),
        F.coalesce(key, F.lit(_NULL)).alias("doc"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


_UNIT = "anchor long, salt int, content long, doc long, pos long"


def _units(docs: DataFrame, span: int, frequent: np.ndarray) -> DataFrame:
    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            parts = []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True):
                anchor, content, first, many = contexts(text.split(), span)
                salt = np.zeros(len(anchor), np.int32)
                if len(frequent) and len(anchor):
                    place = np.minimum(np.searchsorted(frequent, anchor), len(frequent) - 1)
                    salt[frequent[place] == anchor] = 1 + (doc ^ (doc >> 7)) % _SALTS
                crc = _crc24(text)
                parts.append((anchor, salt, content, np.full(len(anchor), doc), _packed(first, many, crc)))
            columns = [pa.array(np.concatenate([p[i] for p in parts])) for i in range(5)]
            return pa.RecordBatch.from_arrays(columns, ["anchor", "salt", "content", "doc", "pos"])

        return apply

    return per_batch(docs.select("doc", "text"), make, _UNIT)


def frequent_anchors(docs: DataFrame, span: int) -> np.ndarray:
    """Anchors found in many documents of a sample; they are only placed differently, not treated differently."""
    total = docs.count()
    sample = docs.where(draw(F.col("doc"), "frequent") < min(1.0, SAMPLED / max(1, total)))
    found = (
        _units(sample, span, np.empty(0, np.int64))
        .groupBy("anchor")
        .count()
        .where(F.col("count") >= FREQUENT)
        .orderBy(F.desc("count"), "anchor")
        .limit(_MOST_FREQUENT)
        .select("anchor")
        .collect()
    )
    return np.sort(np.array([r["anchor"] for r in found], np.int64))


def _sorted_out(units: DataFrame) -> DataFrame:
    """Of units whose anchor occurs again: repeats, and first contexts still to be compared (``open``).

    Every context but the first of its content repeats as a whole. A first one is open if
    its anchor has other contents, or is spread over groups.
    """
    group = Window.partitionBy("anchor", "salt")
    same = Window.partitionBy("anchor", "salt", "content").orderBy("doc", "pos")
    place = F.struct("doc", F.shiftright("pos", 30).alias("first"))
    marked = units.select(
        "*",
        F.row_number().over(same).alias("turn"),
        (F.first(place).over(same) != place).alias("repeat"),
        (F.min("content").over(group) != F.max("content").over(group)).alias("several"),
    )
    is_open = (F.col("turn") == 1) & (F.col("several") | (F.col("salt") > 0))
    return marked.where(F.col("repeat") | is_open).select(
        "anchor", "doc", "pos", (F.col("salt") > 0).alias("spread"), is_open.alias("open")
    )


class SuffixAutomaton:
    """Suffix automaton of a growing sequence of words."""

    def __init__(self) -> None:
        self._next: list[dict] = [{}]
        self._link = [-1]
        self._length = [0]
        self._last = 0

    def add(self, word: object) -> int:
        """Append a word; the length of the longest end of the sequence that occurred before."""
        following, link, length = self._next, self._link, self._length
        new = len(length)
        length.append(length[self._last] + 1)
        following.append({})
        link.append(0)
        at = self._last
        while at >= 0 and word not in following[at]:
            following[at][word] = new
            at = link[at]
        if at >= 0:
            seen = following[at][word]
            if length[at] + 1 == length[seen]:
                link[new] = seen
            else:
                copy = len(length)
                length.append(length[at] + 1)
                following.append(dict(following[seen]))
                link.append(link[seen])
                while at >= 0 and following[at].get(word) == seen:
                    following[at][word] = copy
                    at = link[at]
                link[seen] = link[new] = copy
        self._last = new
        return length[link[new]]


def repeated_spans(shard: list[list[bytes]], span: int) -> list[tuple[int, int, int]]:
    """``(text, start, end)`` of maximal stretches of words that occurred before, texts taken in order."""
    automaton = SuffixAutomaton()
    found: list[tuple[int, int, int]] = []
    for number, words in enumerate(shard):
        for end, word in enumerate(words, 1):
            match = automaton.add(word)
            if match < span:
                continue
            if found and found[-1][0] == number and found[-1][1] == end - match:
                found.pop()  # the same stretch, one word longer
            found.append((number, end - match, end))
        automaton.add(number)  # a separator: no word equals a number
    return found


def _bounded(kept: DataFrame) -> DataFrame:
    """``kept`` with all open contexts of an anchor ``spread`` if they are more than an automaton takes."""
    large = kept.where("open AND NOT spread").groupBy("anchor").count().where(F.col("count") > LARGEST)
    large = large.select("anchor", F.lit(True).alias("large"))
    return kept.join(large, "anchor", "left").withColumn("spread", F.col("spread") | F.coalesce("large", F.lit(False))).drop("large")


def _cut_contexts(docs: DataFrame, wanted: DataFrame, span: int) -> DataFrame:
    """The words of open contexts, keyed by their anchor; of ``spread`` ones a digest of 128 bits for each window."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            keys, owners, starts, texts, spread = [], [], [], [], []
            for doc, text, units in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "units")), strict=True):
                crc, words = _crc24(text), text.split()
                for unit in units:
                    if unit["pos"] & 0xFFFFFF != crc:
                        continue  # another text under the same identifier
                    first, many = unit["pos"] >> 30, unit["pos"] >> 24 & 63
                    pieces = [(i, span) for i in range(first, first + many)] if unit["spread"] else [(first, many + span - 1)]
                    for start, size in pieces:
                        piece = b" ".join(words[start : start + size])
                        keys.append(unit["anchor"])
                        owners.append(doc)
                        starts.append(start << 30 | crc)
                        texts.append(hashlib.blake2b(piece, digest_size=16).digest() if unit["spread"] else piece)
                        spread.append(unit["spread"])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(owners, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(texts, pa.binary()),
                    pa.array(spread, pa.bool_()),
                ],
                ["shard", "doc", "pos", "words", "spread"],
            )

        return apply

    units = wanted.groupBy("doc").agg(F.collect_list(F.struct("anchor", "pos", "spread")).alias("units"))
    return per_batch(
        docs.select("doc", "text").join(units, "doc"), make, "shard long, doc long, pos long, words binary, spread boolean"
    )


def _later_windows(windows: DataFrame, span: int) -> DataFrame:
    """Windows that occur earlier, in order of document and position.

    The earliest of each is an aggregate, combined before the shuffle; it is written, so that
    adaptive execution can split the join at a window that very many documents hold.
    """
    place = F.struct("doc", "pos")
    firsts = windows.groupBy("words").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least < most")
    firsts = written(firsts.select("words", "least"), "firsts")
    later = windows.join(firsts, "words").where(place != F.col("least"))
    return later.select("doc", "pos", (F.shiftright("pos", 30) + F.lit(span)).alias("end"))


def _compared(pieces: DataFrame, span: int) -> DataFrame:
    """Repeats among open contexts, shard by shard in order of document and position. A shard has ``LARGEST`` at most."""

    def run(batches: Batches) -> Batches:
        places: list[tuple[int, int]] = []
        texts: list[list[bytes]] = []
        key = None

        def close() -> list[tuple[int, int, int]]:
            rows = []
            if len(texts) > 1:
                for number, start, end in repeated_spans(texts, span):
                    doc, pos = places[number]
                    rows.append((doc, pos + (start << 30), (pos >> 30) + end))
            places.clear()
            texts.clear()
            return rows

        for batch in batches:
            rows = []
            for shard, doc, pos, words in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc", "pos", "words")), strict=True):
                if shard != key:
                    rows += close()
                    key = shard
                if not places or places[-1] != (doc, pos):
                    places.append((doc, pos))
                    texts.append(words.split(b" "))
            yield _spans(rows)
        yield _spans(close())

    placed = pieces.repartition("shard").sortWithinPartitions("shard", "doc", "pos")
    return in_batches(placed, run, "doc long, pos long, end long")


def _spans(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["doc", "pos", "end"]
    )


def repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc``, ``pos`` and ``end`` of stretches of words that start earlier elsewhere.

    ``pos`` holds the first word in its upper bits and 24 bits of the text's CRC-32 below.
    """
    if not _GRAM <= span <= 48:
        raise ValueError(f"span must be between {_GRAM} and 48 words")
    narrow = _narrow(docs)
    units = _units(narrow, span, frequent_anchors(narrow, span))
    kept = written(_sorted_out(units), "repeats")
    first, crc = F.shiftright("pos", 30), F.col("pos").bitwiseAND(F.lit(0xFFFFFF))
    whole = kept.where("NOT open").select(
        "doc",
        F.shiftleft(first, 30).bitwiseOR(crc).alias("pos"),
        (first + F.shiftright("pos", 24).bitwiseAND(F.lit(63)) + F.lit(span - 1)).alias("end"),
    )
    pieces = written(_cut_contexts(narrow, _bounded(kept).where("open"), span), "pieces")
    compared = _compared(pieces.where("NOT spread").drop("spread"), span)
    return whole.unionByName(compared).unionByName(_later_windows(pieces.where("spread"), span))


def deduplicate(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Each document with its repeated words removed.

    Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (binary, the words left,
    joined by one space) for every row. A word goes if a window of ``span`` words that
    covers it starts earlier too: in a smaller ``doc_id``, or earlier in the same
    document. Rows that share an identifier are one document, so equal rows don't remove
    each other's words. A null identifier counts as the smallest. A null or empty text
    has no words; a text shorter than a window loses none. An empty table gives an
    empty one.
    """
    spans = repeats(docs, span).groupBy("doc").agg(F.collect_list(F.struct("pos", "end")).alias("spans"))

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, removed, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                words = text.split()
                sizes.append(len(words))
                if found:
                    crc = _crc24(text)
                    gone = bytearray(len(words))
                    for unit in found:
                        if unit["pos"] & 0xFFFFFF == crc:
                            start = unit["pos"] >> 30
                            gone[start : unit["end"]] = b"\1" * (unit["end"] - start)
                    words = [w for w, g in zip(words, gone, strict=True) if not g]
                removed.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

        return apply

    joined = _narrow(docs).join(spans, "doc", "left").select("doc_id", "text", "spans")
    return per_batch(joined, make, "doc_id long, n_words long, n_removed long, kept binary")


def kept_digests(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and the SHA-256 of what is kept."""
    return deduplicate(docs, span).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

