"""Near-duplicate documents by SimHash: fingerprints that differ in few bits are linked.

Pairs are found by pigeonhole blocks. A fingerprint of 64 bits is cut into ``distance + 2``
blocks; two fingerprints within ``distance`` bits agree on two blocks at least, so
joining on every pair of blocks misses none. What shares blocks is verified by its
Hamming distance.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandlake.llm.components import components
from demandlake.llm.rows import Batches, in_batches, per_batch, written

SHINGLE_WORDS = 3
DISTANCE = 3
SEED = 42
# A block shared by more fingerprints than this is refined with further bits.
CROWDED = 2048
_SLAB = 1 << 16


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The unsigned fingerprint of UTF-8 text; 0 without words.

    Bytes above 127 are never lower-cased or split on, so the text needs no decoding.
    """
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    starts = [0, *accumulate(len(w) + 1 for w in found)]
    total = len(found) - words + 1
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for low in range(0, total, _SLAB):
        high = min(total, low + _SLAB)
        hashes = [
            digest(joined[a : b - 1], seed)
            for a, b in zip(starts[low:high], starts[low + words : high + words], strict=True)
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed number, for every row."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [fingerprint(t, words) for t in batch.column("text").to_pylist()]
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), bits], ["doc_id", "bits"])

        return apply

    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    )
    return per_batch(narrow, make, "doc_id long, bits long")


def as_hex(bits: Column) -> Column:
    return F.lpad(F.lower(F.hex(bits)), 16, "0")


# ------------------------------------------------------------------ blocks


def _cut(positions: list[int], parts: int) -> list[list[int]]:
    return [list(map(int, p)) for p in np.array_split(positions, parts)]


def _mask(positions: list[int]) -> int:
    return sum(1 << p for p in positions)


def block_masks(distance: int = DISTANCE) -> list[int]:
    """Masks of two blocks out of ``distance + 2``."""
    blocks = _cut(list(range(64)), distance + 2)
    return [_mask(a) | _mask(b) for a, b in combinations(blocks, 2)]


def finer_masks(mask: int, distance: int = DISTANCE) -> list[int]:
    """The mask widened by one block of the rest, which is cut into ``distance + 1``."""
    rest = [p for p in range(64) if not mask >> p & 1]
    return [mask | _mask(block) for block in _cut(rest, distance + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, masks: Column) -> DataFrame:
    return rows.select("bits", F.explode(masks).alias("mask")).withColumn("shared", F.col("bits").bitwiseAND(F.col("mask")))


def _array(masks: list[int]) -> Column:
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def links(prints: DataFrame, distance: int = DISTANCE, crowded: int = CROWDED) -> DataFrame:
    """Links ``one``, ``two`` that connect all distinct fingerprints within ``distance`` bits.

    ``prints`` holds distinct ``bits``. Not every pair is a row: within a block each
    fingerprint is linked to the one from which it was reached, so a block of n rows
    gives n - 1 links at most and the same components. Blocks with more than ``crowded``
    members are keyed anew by further bits, twice at the most. At a distance of 3, 22 bits
    are then left, so no block can hold more than 2**22 fingerprints of 8 bytes; at larger
    distances blocks are narrower and rest on how fingerprints spread.
    """
    level = block_masks(distance)
    rows = _keyed(prints, _array(level))
    settled = []
    for last in (False, False, True):
        if last:
            settled.append(rows)
            break
        full = rows.groupBy("mask", "shared").count().where(F.col("count") > crowded).select("mask", "shared")
        full = written(full, "crowded")
        if not full.take(1):
            settled.append(rows)
            break
        settled.append(rows.join(full, ["mask", "shared"], "left_anti"))
        finer = {m: finer_masks(m, distance) for m in level}
        wider = F.create_map(*[c for m, f in finer.items() for c in (F.lit(_signed(m)).cast("long"), _array(f))])
        crowd = rows.join(full, ["mask", "shared"], "left_semi")
        rows = _keyed(crowd, F.element_at(wider, F.col("mask")))
        level = sorted({m for f in finer.values() for m in f})
    keyed = settled[0]
    for more in settled[1:]:
        keyed = keyed.unionByName(more)

    def verify(batches: Batches) -> Batches:
        held: list[np.ndarray] = []
        key = None
        for batch in batches:
            mask, shared, bits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "shared", "bits"))
            if not len(bits):
                continue
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (shared[1:] != shared[:-1])) + 1
            if key == (mask[0], shared[0]):
                if not len(cuts):
                    held.append(bits)
                    continue
                held.append(bits[: cuts[0]])
                first = 1
            else:
                first = 0
            bounds = np.concatenate([[0], cuts, [len(bits)]])
            found = [linked_in(np.unique(np.concatenate(held)), distance)] if held else []
            found.append(_linked_runs(bits, bounds[first:-1], distance))
            held, key = [bits[bounds[-2] :]], (mask[-1], shared[-1])
            yield _pairs(found)
        if held:
            yield _pairs([linked_in(np.unique(np.concatenate(held)), distance)])

    placed = keyed.repartition("mask", "shared").sortWithinPartitions("mask", "shared", "bits")
    return in_batches(placed.select("mask", "shared", "bits"), verify, "one long, two long")


def _pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([f[i] for f in found]).astype(np.int64)) for i in (0, 1)], ["one", "two"]
    )


_SHORT = 8


def _linked_runs(bits: np.ndarray, bounds: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs that start at ``bounds`` and end at the next; the last bound only ends one."""
    ones, twos = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    sizes = np.diff(bounds)
    run = np.repeat(np.where(sizes <= _SHORT, np.arange(len(sizes)), -1), sizes)
    inside = bits[bounds[0] : bounds[-1]] if len(bounds) else bits[:0]
    for step in range(1, _SHORT):  # short runs: neighbours at each step, all runs at once
        if len(inside) <= step:
            break
        at = np.flatnonzero((run[step:] == run[:-step]) & (run[step:] >= 0))
        a, b = inside[at], inside[at + step]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= distance
        ones.append(a[near])
        twos.append(b[near])
    for k in np.flatnonzero(sizes > _SHORT):
        a, b = linked_in(bits[bounds[k] : bounds[k + 1]], distance)
        ones.append(a)
        twos.append(b)
    return np.concatenate(ones), np.concatenate(twos)


_TILE = 1 << 18


def _few_pairs(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray] | None:
    """All pairs within ``distance`` bits if they are fewer than the fingerprints, else nothing."""
    ones, twos, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    step = max(1, _TILE // max(1, len(bits)))
    for low in range(0, len(bits), step):
        differ = bits[low : low + step, None] ^ bits[None, low:]
        a, b = np.nonzero(np.triu(np.bitwise_count(differ.view(np.uint64)) <= distance, 1))
        found += len(a)
        if found >= len(bits):
            return None
        ones.append(bits[low + a])
        twos.append(bits[low + b])
    return np.concatenate(ones), np.concatenate(twos)


def linked_in(bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what is connected within ``distance`` bits, fewer than there are fingerprints.

    Where few are near, these are all pairs, found by tiles. Else each fingerprint is compared
    with those not yet reached, which takes few steps where many are near.
    """
    few = _few_pairs(bits, distance)
    if few is not None:
        return few
    rest, ones, twos = bits, [], []
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count((rest ^ at).view(np.uint64)) <= distance
            if near.any():
                reached = rest[near]
                ones.append(np.full(len(reached), at))
                twos.append(reached)
                queue.extend(reached)
                rest = rest[~near]
    empty = np.empty(0, np.int64)
    return np.concatenate([empty, *ones]), np.concatenate([empty, *twos])


# ---------------------------------------------------------------- operator


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    crowded: int = CROWDED,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` for every row.

    The component is the smallest identifier reachable over links, itself included. A
    null or empty text has fingerprint zero and is linked like any other. Rows with a
    null identifier are fingerprinted and connect others; if no row of a component has
    an identifier, its component is null. Repeated rows stay repeated. An empty table
    gives an empty one, and other columns of ``docs`` are not looked at.
    """
    prints = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = written(prints.groupBy("bits").agg(F.min("doc_id").alias("first")), "distinct")
    nodes = components(links(distinct.select("bits"), distance, crowded))
    rooted = distinct.join(nodes.withColumnRenamed("node", "bits"), "bits", "left").withColumn(
        "root", F.coalesce("root", "bits")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("bits", "component_id")
    return prints.join(classes, "bits").select("doc_id", as_hex(F.col("bits")).alias("fingerprint"), "component_id")
