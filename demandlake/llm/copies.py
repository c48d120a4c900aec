"""One document of each group of copies: sets of word shingles with a Jaccard similarity of 0.8.

Documents with equal sets are one node. Candidates are SimHash links, fingerprints that differ in few bits
(``simhash``); every candidate is verified on the whole sets before it links anything, so what a component
holds is connected by verified pairs alone. Fingerprints are a strict bound that many similar sets
don't keep. These are found by the bands of a MinHash signature and by rare shingles: two sets at the threshold
itself miss each other in all bands once in 300,000 times, more similar ones less often.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm import simhash
from demandlake.llm.components import components
from demandlake.llm.rows import per_batch, written

WORDS = 5
SIMILARITY = 0.8
BANDS = 24
ROWS = 4
_SLAB = 1 << 13
_STEP = np.uint64(0x9E3779B97F4A7C15)
_DRAWN = np.random.default_rng(42).integers(0, 1 << 32, (2, BANDS * ROWS, 1), np.uint32)
_FACTORS, _SHIFTS = _DRAWN[0] | np.uint32(1), _DRAWN[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words of UTF-8 text; a shorter text is one run.

    Bytes above 127 are never lower-cased or split on, as in fingerprints.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.frombuffer(array("Q", map(xxhash.xxh3_64_intdigest, found)), np.uint64)
    width = min(words, len(found))
    value = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        value = _mixed(value * _STEP + hashes[i : i + len(value)])
    return np.unique(value)


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band of the signature, none for an empty set."""
    if not len(hashes):
        return np.empty(0, np.int64)
    upper = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(upper), _SLAB):
        least = np.minimum(least, (upper[low : low + _SLAB] * _FACTORS + _SHIFTS).min(axis=1))
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T.astype(np.uint64):
        keys = _mixed(keys * _STEP + row)
    return keys.view(np.int64)


def _content(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes())


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate([np.empty(0, np.uint64), *found]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def _signed(numbers: list[int]) -> pa.Array:
    return pa.array(np.array(numbers, np.uint64).view(np.int64))


def _signatures(narrow: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``bits`` (the fingerprint), ``content`` (hash of the set), ``size`` of the set and ``keys`` of its bands for every row."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            bits, content, sizes, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                bits.append(simhash.fingerprint(text))
                hashes = shingles(text, words)
                content.append(_content(hashes))
                sizes.append(len(hashes))
                keys.append(bands(hashes).view(np.uint64))
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _signed(bits), _signed(content), pa.array(sizes, pa.int64()), _lists(keys)],
                ["doc_id", "bits", "content", "size", "keys"],
            )

        return apply

    return per_batch(narrow, make, "doc_id long, bits long, content long, size long, keys array<long>")


def _sets(narrow: DataFrame, words: int) -> DataFrame:
    """``content`` and the whole ``hashes`` of every row."""

    def make():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [shingles(t, words) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([_signed([_content(h) for h in found]), _lists(found)], ["content", "hashes"])

        return apply

    return per_batch(narrow, make, "content long, hashes array<long>")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` whose sets are as similar as asked for."""
    one = sets.select(F.col("content").alias("one"), F.col("hashes").alias("a"))
    two = sets.select(F.col("content").alias("two"), F.col("hashes").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    either = F.size("a") + F.size("b") - common
    return pairs.join(one, "one").join(two, "two").where(common / either >= similarity).select("one", "two")


def _rooted(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of their ``content``, which is itself where nothing is linked to it."""
    return rows.join(nodes.withColumnRenamed("node", "content"), "content", "left").withColumn("root", F.coalesce("root", "content"))


def _unconnected(rows: DataFrame, key: str) -> DataFrame:
    """The values of ``key`` under which lie sets that are not connected yet."""
    both = rows.groupBy(key).agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return both.where("least < most").select(key)


def _within(one: str, two: str, similarity: float):
    """Whether what two sets have from the places ``one_at`` and ``two_at`` on may suffice for the similarity."""
    left = F.least(F.col(f"{one}_size") - F.col(f"{one}_at"), F.col(f"{two}_size") - F.col(f"{two}_at"))
    needed = (F.col(f"{one}_size") + F.col(f"{two}_size")) * F.lit(similarity / (1 + similarity))
    return left >= needed - 1e-9


def _sized(a: str, b: str, similarity: float):
    """Whether sets of two sizes can be as similar as asked for."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(similarity - 1e-9)


def fingerprint_pairs(distinct: DataFrame, similarity: float) -> DataFrame:
    """Candidates ``one``, ``two`` of the contents in ``distinct``, found by their fingerprints.

    Contents with one fingerprint are paired with the smallest of them, and the smallest of two fingerprints
    that SimHash links with each other.
    """
    leads = distinct.groupBy("bits").agg(F.min(F.struct("content", "size")).alias("lead")).select("bits", "lead.*")
    leads = written(leads, "fingerprints")

    def lead(name: str) -> DataFrame:
        return leads.select(*[F.col(c).alias(f"{name}{more}") for c, more in (("bits", "_bits"), ("content", ""), ("size", "_size"))])

    rows = distinct.select(F.col("bits").alias("one_bits"), F.col("content").alias("two"), F.col("size").alias("two_size"))
    same = rows.join(lead("one"), "one_bits").where(F.col("one") != F.col("two"))
    linked = simhash.links(leads.select("bits")).toDF("one_bits", "two_bits").distinct()
    near = linked.join(lead("one"), "one_bits").join(lead("two"), "two_bits")
    pairs = same.select("one", "two", "one_size", "two_size").unionByName(near.select("one", "two", "one_size", "two_size"))
    return pairs.where(_sized("one_size", "two_size", similarity)).select("one", "two")


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """``content``, ``size``, ``hash`` and ``at``: the places of the shingles by which a similar set is found.

    A set's shingles are ordered by how many of the ``sets`` have them, rarest first. Of two sets that are similar
    enough, the first shingle in common is among the first ``n - ceil(similarity n) + 1`` of either. Those that no
    other set has take their places but are left out.
    """
    each = sets.select("content", F.size("hashes").alias("size"), F.explode("hashes").alias("hash"))
    held = each.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = each.join(held, "hash").groupBy("content", "size").agg(F.sort_array(F.collect_list(F.struct("n", "hash"))).alias("shared"))
    alone = F.col("size") - F.size("shared")
    needed = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - 1e-9) + 1 - alone
    first = shared.select("content", "size", alone.alias("alone"), F.slice("shared", F.lit(1), F.greatest(needed, F.lit(0)).cast("int")).alias("first"))
    return first.select("content", "size", "alone", F.posexplode("first").alias("at", "found")).select(
        "content", "size", F.col("found.hash").alias("hash"), (F.col("alone") + F.col("at")).alias("at")
    )


def _side(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("hash", F.col("content").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("size", "at", "root")])


def verified_links(distinct: DataFrame, narrow: DataFrame, words: int, similarity: float) -> DataFrame | None:
    """``node`` and ``root`` of sets connected by verified candidates; nothing if there is no candidate.

    ``distinct`` holds each content once, with its ``first`` identifier, ``bits``, ``size`` and ``keys``. What
    SimHash links is compared, and members of a bucket with its smallest. Buckets of sets that are then not connected are gone
    through by the rare shingles of their sets: sets that have one of them in common are compared with the one
    that it comes earliest in, and what is still not connected with each other. Pairs that are left
    out are connected already or have too few shingles left to be similar, so components are
    those of all candidates.
    """
    keyed = distinct.select("content", "size", F.explode("keys").alias("key"))
    leads = keyed.groupBy("key").agg(F.min(F.struct("content", "size")).alias("lead"), F.count(F.lit(1)).alias("n"))
    leads = leads.where("n > 1").select("key", F.col("lead.content").alias("one"), F.col("lead.size").alias("one_size"))
    members = written(keyed.join(leads, "key"), "members")
    near = members.where(F.col("content") != F.col("one")).where(_sized("size", "one_size", similarity))
    star = near.select("one", F.col("content").alias("two"))
    star = written(fingerprint_pairs(distinct, similarity).unionByName(star).distinct(), "candidates")
    paired = star.select(F.explode(F.array("one", "two")).alias("content"))
    compared = members.select("content").unionByName(paired).distinct()
    if not compared.take(1):
        return None
    firsts = distinct.join(compared, "content", "left_semi").select(
        F.col("first").alias("__first"), F.col("content").alias("__content")
    )
    texts = narrow.join(firsts.select("__first").distinct(), F.col("doc_id").eqNullSafe(F.col("__first")), "left_semi")
    sets = _sets(texts, words).join(firsts, F.col("content") == F.col("__content"), "left_semi")
    sets = written(sets.dropDuplicates(["content"]), "sets")

    found = written(_verified(star, sets, similarity), "verified")
    nodes = components(found)

    rooted = _rooted(members.select("key", "content"), nodes)
    loose = rooted.join(_unconnected(rooted, "key"), "key", "left_semi").select("content").distinct()
    places = written(prefixes(sets.join(loose, "content", "left_semi"), similarity), "prefixes")

    rooted = _rooted(places, nodes)
    rooted = rooted.join(_unconnected(rooted, "hash"), "hash", "left_semi")
    earliest = F.min(F.struct("at", "content", "size", "root")).alias("lead")
    leads = rooted.groupBy("hash").agg(earliest).select("hash", "lead.*")
    met = _side(leads, "one").join(_side(rooted, "two"), "hash").where(F.col("one_root") != F.col("two_root"))
    met = met.where(_within("one", "two", similarity)).select("one", "two").distinct()
    found = written(found.unionByName(_verified(met, sets, similarity)), "verified")
    nodes = components(found)

    rooted = _rooted(places, nodes)
    rooted = written(rooted.join(_unconnected(rooted, "hash"), "hash", "left_semi"), "rooted")
    rest = _side(rooted, "one").join(_side(rooted, "two"), "hash").where(F.col("one") < F.col("two"))
    rest = rest.where((F.col("one_root") != F.col("two_root")) & _within("one", "two", similarity)).select("one", "two").distinct()
    more = written(_verified(rest, sets, similarity), "verified")
    return components(found.unionByName(more)) if more.take(1) else nodes


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` whose identifier is the smallest of its component.

    Components are connected by pairs of documents whose sets of shingles have a Jaccard similarity of
    ``similarity`` or more; texts without words are alike. Rows that repeat the smallest identifier all
    stay, as do rows without an identifier in components that have none.
    """
    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")
    )
    prints = written(_signatures(narrow, words), "signatures")
    distinct = prints.groupBy("content").agg(
        F.min("doc_id").alias("first"), F.min("bits").alias("bits"), F.min("size").alias("size"), F.min("keys").alias("keys")
    )
    distinct = written(distinct, "distinct")
    nodes = verified_links(distinct, narrow, words, similarity)
    rooted = distinct.select("content", "first", F.col("content").alias("root"))
    if nodes is not None:
        rooted = rooted.drop("root").join(nodes.withColumnRenamed("node", "content"), "content", "left").withColumn(
            "root", F.coalesce("root", "content")
        )
    kept = rooted.groupBy("root").agg(F.min("first").alias("__kept"))
    # A component without identifiers keeps the rows that have none.
    return docs.join(kept.select("__kept").distinct(), F.col(f"`{id_col}`").eqNullSafe(F.col("__kept")), "left_semi")
