"""Benchmark passages in documents, up to a few edits.

Benchmark items are cut into overlapping segments. By the q-gram lemma, a segment of m
characters within k edits of a stretch of text shares at least m + 1 - q - k q of its
q-grams with it, all on neighbouring diagonals. Shared q-grams are counted in overlapping
bands of diagonals, bands that meet the bound are kept, and a banded alignment verifies
them. Texts are compared as lower-case UTF-8 bytes in which everything between letters and
digits is one space.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import per_batch

Q = 8
# Characters of a segment, the least that an item or its last segment must have, and the share of edits allowed.
SEGMENT = 96
SHORTEST = 48
EDITS = 0.1
# Text of the benchmark that one pass over the documents compares with.
SHARD_BYTES = 1 << 20
_TOGETHER = 1 << 20
_BITS = 20
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


# Stands between documents; benchmark texts don't hold it.
_END = 0


def _folding() -> np.ndarray:
    fold = np.full(256, 32, np.uint8)
    for b in range(256):
        if b >= 128 or chr(b).isalnum():
            fold[b] = ord(chr(b).lower()) if b < 128 else b
    fold[_END] = _END
    return fold


_FOLD = _folding()


def normalised(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes, and which bytes of ``data`` they stand for. ``data`` may hold several texts, ended by ``_END``."""
    folded = _FOLD[data]
    blank = folded == 32
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[:1] = True
    return folded[keep], keep


def grams(folded: np.ndarray) -> np.ndarray:
    """All q-grams: eight bytes each, as one number."""
    many = max(0, len(folded) - Q + 1)
    found = np.empty(many, np.uint64)
    for shift in range(min(Q, many)):
        part = folded[shift : shift + (len(folded) - shift) // Q * Q]
        found[shift::Q] = part.view("<u8")
    return found


def _slot(values: np.ndarray) -> np.ndarray:
    return (values * _SPREAD) >> np.uint64(64 - _BITS)


@dataclass
class Index:
    """Segments of a benchmark shard and where each of their q-grams occurs."""

    item: np.ndarray  # item of each segment
    text: np.ndarray  # a row for each segment, filled up with zeros
    turned: np.ndarray  # the same, last letter first
    sizes: np.ndarray
    edits: np.ndarray
    bound: np.ndarray  # shared q-grams that the lemma asks for
    known: np.ndarray  # a bit per hash of a q-gram
    gram: np.ndarray  # distinct q-grams, sorted
    start: np.ndarray  # first occurrence of each, and one more
    segment: np.ndarray
    offset: np.ndarray


def build_index(items: list[bytes]) -> Index | None:
    """The index of a shard; None if no item is long enough to be told from chance."""
    owners, texts = [], []
    for number, raw in enumerate(items):
        folded, _ = normalised(np.frombuffer(raw.replace(b"\0", b" "), np.uint8))
        folded = folded[1:] if len(folded) and folded[0] == 32 else folded
        folded = folded[:-1] if len(folded) and folded[-1] == 32 else folded
        if len(folded) < SHORTEST:
            continue
        starts = list(range(0, max(1, len(folded) - SEGMENT + 1), SEGMENT // 2))
        if starts[-1] + SEGMENT < len(folded):
            starts.append(len(folded) - SEGMENT)
        for s in starts:
            owners.append(number)
            texts.append(folded[s : s + SEGMENT])
    if not texts:
        return None
    sizes = np.array([len(t) for t in texts])
    edits = (EDITS * sizes).astype(np.int64)
    found = [grams(t) for t in texts]
    gram = np.concatenate(found)
    segment = np.repeat(np.arange(len(texts)), [len(g) for g in found])
    offset = np.concatenate([np.arange(len(g)) for g in found])
    order = np.argsort(gram, kind="stable")
    distinct, start = np.unique(gram[order], return_index=True)
    known = np.zeros(1 << _BITS, bool)
    known[_slot(distinct)] = True
    table = np.zeros((2, len(texts), SEGMENT), np.uint8)
    for row, text in enumerate(texts):
        table[0, row, : len(text)], table[1, row, : len(text)] = text, text[::-1]
    return Index(
        np.array(owners), table[0], table[1], sizes, edits, sizes + 1 - Q - edits * Q, known, distinct, np.append(start, len(gram)), segment[order], offset[order]
    )


def candidates(text: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """Segments, and first diagonals of the bands in ``text`` that share enough q-grams with them."""
    none = np.empty(0, np.int64), np.empty(0, np.int64)
    values = grams(text)
    at = np.flatnonzero(index.known[_slot(values)])
    place = np.minimum(np.searchsorted(index.gram, values[at]), len(index.gram) - 1)
    real = index.gram[place] == values[at]
    at, place = at[real], place[real]
    # a match has as many shared q-grams within its own length, whatever they belong to
    least, reach = int(index.bound.min()), int((index.sizes + index.edits).max())
    if len(at) < least:
        return none
    dense = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] <= reach)
    marks = np.bincount(dense, minlength=len(at) + 1) - np.bincount(dense + least, minlength=len(at) + 1)
    inside = np.cumsum(marks[:-1]) > 0
    at, place = at[inside], place[inside]
    if not len(at):
        return none
    many = index.start[place + 1] - index.start[place]
    ends = np.cumsum(many)
    each = np.arange(ends[-1]) - np.repeat(ends - many, many) + np.repeat(index.start[place], many)
    segment = index.segment[each]
    diagonal = np.repeat(at, many) - index.offset[each]
    # bands twice as wide as the drift, every half of their width: any drift lies inside one
    width = int(index.edits.max()) + 1
    half = (diagonal + SEGMENT) // width
    span = int(half.max()) + 2
    band = segment * span + half + 1
    # first by hash: few bands can have as many
    slots = np.concatenate([band, band - 1])
    slots = (_slot(slots.astype(np.uint64))).astype(np.int64)
    full = np.bincount(slots, minlength=1 << _BITS) >= least
    keys = np.concatenate([band[full[slots[: len(band)]]], band[full[slots[len(band) :]]] - 1])
    keys, shared = np.unique(keys, return_counts=True)
    band_segment, band_half = np.divmod(keys, span)
    enough = shared >= index.bound[band_segment]
    return band_segment[enough], (band_half[enough] - 1) * width - SEGMENT


_GUARD = 1  # a byte that occurs in no normalised text


def align(patterns: np.ndarray, sizes: np.ndarray, text: np.ndarray, first: np.ndarray, width: int, edits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each whole pattern against a stretch of ``text``, and where that stretch ends.

    ``patterns`` has a row for each, of which ``sizes`` letters count. The stretch starts on
    one of ``width`` diagonals from ``first`` on; only cells within ``edits`` of these are
    computed, all alignments at once. What takes more edits is reported as more.
    """
    most = int(edits.max())
    cells = width + 2 * most + 1
    step = np.arange(cells, dtype=np.int16)
    low = first - most
    margin = cells + patterns.shape[1] + SEGMENT + 2 * most + 2
    padded = np.concatenate([np.full(margin, _GUARD, np.uint8), text, np.full(margin, _GUARD, np.uint8)])
    place = np.clip(low, -margin, len(text)) [:, None] + margin + step
    beyond = np.int16(most + 1)
    row = np.zeros(place.shape, np.int16)
    cost = np.full(len(first), beyond, np.int16)
    end = np.zeros(len(first), np.int64)
    for i in range(patterns.shape[1]):
        letters = padded[np.minimum(place + i, len(padded) - 1)]
        best = row + (letters != patterns[:, i : i + 1])
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
        # further letters of the text: each costs one, so carry minima to the right
        row = np.minimum(np.minimum.accumulate(best - step, axis=1) + step, beyond).astype(np.int16)
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            at = row[done].argmin(axis=1)
            cost[done], end[done] = row[done, at], low[done] + sizes[done] + at
    return cost, end


def matches(text: np.ndarray, index: Index) -> np.ndarray:
    """Rows of item, start, end and edits for each segment found, as places in the normalised text."""
    segment, first = candidates(text, index)
    if not len(segment):
        return np.empty((0, 4), np.int64)
    sizes, edits = index.sizes[segment], index.edits[segment]
    width = 2 * (int(index.edits.max()) + 1)
    cost, stop = align(index.text[segment], sizes, text, first, width, edits)
    hit = np.flatnonzero((cost <= edits) & (stop <= len(text)))
    if not len(hit):
        return np.empty((0, 4), np.int64)
    segment, sizes, edits, cost, stop = segment[hit], sizes[hit], edits[hit], cost[hit], stop[hit]
    # the same from the end, against the turned text, tells where the stretch begins
    _, back = align(index.turned[segment], sizes, text[::-1], len(text) - stop, 1, edits)
    begin = np.maximum(0, len(text) - back)
    return np.stack([index.item[segment], begin, stop, cost.astype(np.int64)], axis=1)


def leaks_in(texts: list[bytes], index: Index) -> list[tuple[int, int, int, int, int, int]]:
    """``(text, item, start, end, regions, edits)`` in code points: one row for each item that a text holds."""
    rows = []
    group: list[int] = []
    size = 0
    for number, raw in enumerate(texts):
        group.append(number)
        size += len(raw)
        if size >= _TOGETHER or number == len(texts) - 1:
            data = np.frombuffer(b"\0".join([texts[n].replace(b"\0", b" ") for n in group]), np.uint8)
            begins = np.cumsum([0] + [len(texts[n]) + 1 for n in group])
            folded, keep = normalised(data)
            per_item: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            hits = matches(folded, index)
            place = np.flatnonzero(keep) if len(hits) else keep
            for item, start, end, cost in hits.tolist():
                first, last = int(place[start]), int(place[end - 1]) + 1
                owner = int(np.searchsorted(begins, first, side="right")) - 1
                if last <= begins[owner + 1]:  # not across the end of a document
                    per_item.setdefault((owner, item), []).append((first, last, cost))
            for (owner, item), spans in sorted(per_item.items()):
                raw_text, offset = texts[group[owner]], int(begins[owner])
                first, last = (f(s[k] for s in spans) - offset for f, k in ((min, 0), (max, 1)))
                points = [len(raw_text[:p].decode("utf-8", "ignore")) for p in (first, last)]
                rows.append((group[owner], item, *points, len({s[:2] for s in spans}), min(s[2] for s in spans)))
            group, size = [], 0
    return rows


@lru_cache(maxsize=1)
def _indexed(items: tuple[bytes, ...]) -> Index | None:
    return build_index(list(items))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Benchmark items (``item_id``, ``text``) found in documents (``doc_id``, ``text``).

    One row for each document and item: ``doc_id``, ``item_id``, ``start`` and ``end`` (code
    points of the document, from the first region to the last), ``n_regions``, and
    ``edits`` of the closest region. A document without a row is clean. An item is found
    by any of its segments of 96 characters within 9 edits, a shorter item by all of it
    within a tenth; items of less than 48 normalised characters are not searched, since
    they cannot be told from chance. Null and empty texts hold nothing. Null identifiers
    are passed on, and repeated documents or items are reported each. The benchmark is
    read in shards of about a megabyte, one pass over the documents for each.
    """
    size = F.length(F.col("text").cast("string").cast("binary"))
    total = benchmark.agg(F.sum(size).alias("n")).first()["n"] or 0
    shards = -(-total // SHARD_BYTES)
    shard = F.pmod(F.xxhash64("text"), F.lit(max(1, shards)))
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    found = None
    for number in range(max(1, shards)):
        rows = benchmark.where(F.col("text").isNotNull() & (shard == number)).select(F.col("item_id").cast("long"), F.col("text").cast("string")).orderBy("item_id", "text").collect()
        part = _search(narrow, [r["item_id"] for r in rows], tuple(r["text"].encode() for r in rows))
        found = part if found is None else found.unionByName(part)
    return found


def _search(narrow: DataFrame, ids: list[int | None], items: tuple[bytes, ...]) -> DataFrame:
    def make():
        index = _indexed(items)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = leaks_in(batch.column("text").to_pylist(), index) if index else []
            owners = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
            rest = [pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4, 5)]
            return pa.RecordBatch.from_arrays(
                [owners, pa.array([ids[r[1]] for r in rows], pa.int64()), *rest],
                ["doc_id", "item_id", "start", "end", "n_regions", "edits"],
            )

        return apply

    return per_batch(narrow, make, "doc_id long, item_id long, start long, end long, n_regions long, edits long")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item. Rows that share an identifier go together."""
    leaking = find_leaks(docs, benchmark).select(F.col("doc_id").alias("__leaking")).distinct()
    return docs.join(leaking, F.col("doc_id").eqNullSafe(F.col("__leaking")), "left_anti")
