"""The prefix trie of conversations, with totals over its subtrees.

Sequences of turns are cut at half their depth: what lies above a cut is a trie of fewer and
shorter sequences, since equal ones become one, what lies below is a forest with a root per cut prefix.
Both are cut on in the same way and in the same round, until every piece is one turn deep; the rounds
number the logarithm of the depth. A cut prefix is named by its root and the content of the block that
leads to it, and contents of blocks are named from those of their halves. The totals of each lower
forest are grafted onto the cut that it hangs from, and go up from cut to cut through the upper tries.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm.rows import Batches, in_batches, written
from demandlake.operators.running import positions
from demandlake.session import work_folder

# Rebuilding: conversations of a family share a beginning of less than so many turns.
FAMILY, SHARED = 5, 9

_NAME = 16
_ROOT = bytes(_NAME)
_NOTHING = hashlib.sha256(b"").hexdigest()
_CUT = "struct<name:binary,depth:long>"
_PROBLEM = f"root binary, start long, conv_id long, len long, many long, live boolean, end binary, chain array<{_CUT}>"
_GRAFT = "name binary, leaves long, saved long"


def _named(*parts: Column) -> Column:
    """128 bits that stand for some bytes."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 2 * _NAME))


def _top_bit(number: Column) -> Column:
    """The highest power of two in a positive number."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(number)) - 1)


def _low_bit(number: Column) -> Column:
    return number.bitwiseAND(-number)


class _Shelves:
    """A table in parts by a number, to which rounds add: the rows that each of the later ones works on."""

    def __init__(self, spark: SparkSession, label: str, schema: str, by: str):
        self.spark, self.by, self.schema = spark, by, f"{schema}, {by} long"
        self.path = work_folder(spark, label)
        self.add(spark.createDataFrame([], self.schema))

    def add(self, df: DataFrame) -> None:
        df.write.mode("append").partitionBy(self.by).parquet(self.path)

    def read(self, number: int | None = None) -> DataFrame:
        stored = self.spark.read.schema(self.schema).parquet(self.path)
        return stored if number is None else stored.where(F.col(self.by) == number)


# -------------------------------------------------------------------- turns


def numbered(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1, ``token`` and ``bytes`` of the turns of every conversation.

    Turns are ordered by ``turn``, null first; turns of one number come in the order of their hashes, so
    that repeated rows stay. A null role or text is empty. Rows without a ``conv_id`` belong to no
    conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary") for c in ("role", "text"))
    size = F.octet_length(role).cast("string").cast("binary")
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn"),
        _named(size, F.lit(":").cast("binary"), role, text).alias("token"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    placed = positions(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("token").asc()], "place")
    return written(placed.drop("turn"), "turns")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin with the first turns of the one that leads their family.

    The conversation ``c`` takes the first ``h`` turns of ``c - c % 5``, all if that has fewer and none if it
    is absent, in place of its own first ``h``; ``h`` is the CRC-32 of its number modulo 9.
    """
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    own = lengths.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("lead"), h.alias("h"))
    leads = lengths.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("lead"), F.col("n").alias("lead_n"))
    taken = F.least("h", F.coalesce("lead_n", F.lit(0)))
    family = written(own.join(leads, "lead", "left").withColumn("taken", taken), "families")
    firsts = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < SHARED)).withColumnRenamed("conv_id", "lead")
    begun = firsts.join(family, "lead").where(F.col("place") <= F.col("h")).select("conv_id", "place", "token", "bytes")
    went_on = (
        turns.join(family, "conv_id")
        .where(F.col("place") > F.col("h"))
        .select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("place"), "token", "bytes")
    )
    length = (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    return written(begun.unionByName(went_on), "rebuilt"), family.select("conv_id", length)


# -------------------------------------------------------------------- trie


def _contents(turns: DataFrame, deepest: int) -> dict[int, DataFrame]:
    """By size, the name of each whole block of 1, 2, 4, ... turns that begins at a multiple of its size."""
    blocks = {1: turns.select("conv_id", (F.col("place") - 1).alias("block"), F.col("token").alias("content"))}
    size = 1
    while 2 * size <= deepest:
        first = F.col("block") % 2 == 0
        halves = blocks[size].groupBy("conv_id", F.call_function("shiftright", F.col("block"), F.lit(1)).alias("block"))
        pairs = halves.agg(F.max(F.when(first, F.col("content"))).alias("a"), F.max(F.when(~first, F.col("content"))).alias("b"))
        size *= 2
        whole = pairs.where(F.col("a").isNotNull() & F.col("b").isNotNull())
        blocks[size] = written(whole.select("conv_id", "block", _named(F.col("a"), F.col("b")).alias("content")), "blocks")
    return blocks


def _cut(turns: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes but the root, and the last node of every conversation that has turns.

    A problem is a piece of the trie: all that lies within some depth below the node ``root`` at depth ``start``.
    Its rows stand for ``many`` conversations, the smallest of them ``conv_id``, that run on for ``len`` turns in it.
    Rows of one conversation that ends in the problem are ``live``; others lead to its bottom, the node ``end``.
    ``chain`` has the cuts that the problem hangs from, the root included.
    """
    spark = turns.sparkSession
    problems = _Shelves(spark, "problems", _PROBLEM, "half")
    cuts = _Shelves(spark, "cuts", "conv_id long, name binary, live boolean, len long", "half")
    root = F.lit(_ROOT)
    origin = F.array(F.struct(root.alias("name"), F.lit(0).cast("long").alias("depth")))
    start = lengths.where("len > 0").select(
        root.alias("root"), F.lit(0).cast("long").alias("start"), "conv_id", "len", F.lit(1).cast("long").alias("many"),
        F.lit(True).alias("live"), F.lit(None).cast("binary").alias("end"), origin.cast(f"array<{_CUT}>").alias("chain"),
        _top_bit(F.col("len")).alias("half"),
    )
    problems.add(start)
    half = problems.read().agg(F.max("half")).first()[0] or 0
    contents = _contents(turns, half)
    while half:
        block = contents[half].withColumnRenamed("conv_id", "__conv")
        here = (F.col("conv_id") == F.col("__conv")) & (F.col("start") / half == F.col("block"))
        cut = problems.read(half).drop("half").join(block, here).withColumn("name", _named(F.col("root"), F.col("content")))
        cut = written(cut.drop("__conv", "block", "content"), "cut")
        rest, below = F.col("len") - half, F.lit(half // 2).cast("long")
        upper = cut.groupBy("root", "start", "name").agg(
            F.min("conv_id").alias("conv_id"), F.sum("many").alias("many"), F.min("chain").alias("chain")
        )
        upper = upper.select(
            "root", "start", "conv_id", F.lit(half).cast("long").alias("len"), "many",
            F.lit(False).alias("live"), F.col("name").alias("end"), "chain", below.alias("half"),
        )
        depth = F.col("start") + half
        hung = F.struct(F.col("name").alias("name"), depth.cast("long").alias("depth"))
        lower = cut.where(rest > 0).select(
            F.col("name").alias("root"), depth.alias("start"), "conv_id", rest.alias("len"), "many",
            "live", "end", F.concat("chain", F.array(hung)).cast(f"array<{_CUT}>").alias("chain"),
            F.least(below, _top_bit(rest)).alias("half"),
        )
        problems.add(upper.unionByName(lower))
        cuts.add(cut.where("live").where(rest == 0).select("conv_id", "name", "live", "len", F.lit(half).cast("long").alias("half")))
        half //= 2
    nodes = problems.read(0).select(
        F.col("end").alias("name"), F.col("root").alias("parent"), (F.col("start") + 1).alias("depth"), "conv_id", "many", "chain"
    )
    return nodes, cuts.read().select("name", "conv_id")


def _grafted(nodes: DataFrame) -> DataFrame:
    """``name``, ``leaves`` and ``saved`` of all that lies below each node, as parts to be added up.

    Every node counts for all cuts that it hangs from, wherever it lies in their forests. A cut at a depth with
    the lowest bit ``low`` ends a trie of that depth, and passes its sum on to the bottoms of the smaller tries in there.
    """
    grafts = _Shelves(nodes.sparkSession, "grafts", _GRAFT, "low")
    parts = nodes.select(F.explode("chain").alias("cut"), "leaves", "saved")
    name = F.col("cut.name").alias("name")
    sums = parts.groupBy(name, _low_bit(F.col("cut.depth")).alias("low")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    grafts.add(sums)
    low = nodes.agg(F.max(_low_bit(F.col("depth")))).first()[0] or 0
    while low > 1:
        held = grafts.read(low).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        tops = nodes.where(_low_bit(F.col("depth")) == low).select("name", "chain")
        inner = low.bit_length() - 1
        passed = held.join(tops, "name").select(F.explode(F.slice("chain", -inner, inner)).alias("cut"), "leaves", "saved")
        grafts.add(passed.select(name, "leaves", "saved", _low_bit(F.col("cut.depth")).alias("low")))
        low //= 2
    return grafts.read().drop("low")


# -------------------------------------------------------------------- ends


def _digested(ends: DataFrame) -> DataFrame:
    """``name`` and the SHA-256 of the comma-joined numbers of the conversations that end in each node.

    Numbers are joined where they lie after sorting, some thousands at a time. A digest has to read them one
    after the other, so those of one node pass through one task, which holds one such piece at a time.
    """

    def join(batches: Batches) -> Batches:
        for batch in batches:
            names, numbers = batch.column("name").to_pylist(), batch.column("conv_id").to_pylist()
            starts = [i for i, n in enumerate(names) if not i or n != names[i - 1]]
            parts = list(zip(starts, [*starts[1:], len(names)], strict=True)) if names else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[a] for a, _ in parts], pa.binary()),
                    pa.array([numbers[a] for a, _ in parts], pa.int64()),
                    pa.array([",".join(map(str, numbers[a:b])) for a, b in parts], pa.string()),
                ],
                ["name", "first", "numbers"],
            )

    def digest(batches: Batches) -> Batches:
        def found() -> Iterator[tuple[bytes, str]]:
            last, state = None, hashlib.sha256()
            for batch in batches:
                for name, numbers in zip(batch.column("name").to_pylist(), batch.column("numbers").to_pylist(), strict=True):
                    if name != last:
                        if last is not None:
                            yield last, state.hexdigest()
                        last, state = name, hashlib.sha256()
                    else:
                        state.update(b",")
                    state.update(numbers.encode())
            if last is not None:
                yield last, state.hexdigest()

        rows: list[tuple[bytes, str]] = []
        for row in found():
            rows.append(row)
            if len(rows) == 10_000:
                yield _pairs(rows)
                rows = []
        yield _pairs(rows)

    ordered = ends.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = in_batches(ordered.select("name", "conv_id"), join, "name binary, first long, numbers string")
    dealt = pieces.repartition("name").sortWithinPartitions("name", "first")
    return in_batches(dealt, digest, "name binary, ends string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n for n, _ in rows], pa.binary()), pa.array([d for _, d in rows], pa.string())], ["name", "ends"]
    )


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row per node of the prefix trie of some sequences, the root included.

    ``turns`` has ``conv_id``, ``place`` from 1 without gaps, ``token`` and ``bytes``; ``lengths`` has every
    ``conv_id`` once, with the number ``len`` of its turns. See ``prefix_trie`` for the columns. No sequences
    have no trie.
    """
    below, last = _cut(turns, lengths)
    sizes = turns.select("conv_id", F.col("place").alias("depth"), "bytes")
    top = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("many")).where("many > 0")
    root = top.select(
        F.lit(_ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        "conv_id", "many", F.array().cast(f"array<{_CUT}>").alias("chain"), F.lit(0).cast("long").alias("bytes"),
    )
    found = below.join(sizes, ["conv_id", "depth"]).unionByName(root)
    children = below.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")).withColumnRenamed("parent", "name")
    nodes = found.join(children, "name", "left").select(
        *found.columns,
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("many") - 1) * F.col("bytes")).alias("saved"),
    )
    nodes = written(nodes, "nodes")
    turnless = lengths.where("len = 0").select(F.lit(_ROOT).alias("name"), "conv_id")
    ends = _digested(last.unionByName(turnless)).select(
        "name", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), "ends"
    )
    totals = _grafted(nodes).withColumn("ends", F.lit(None).cast("string")).unionByName(ends)
    totals = totals.groupBy("name").agg(
        F.sum("leaves").alias("leaves_below"), F.sum("saved").alias("saved_below"), F.max("ends").alias("ends")
    )
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.lit(0)
    return (
        nodes.join(totals, "name", "left")
        .drop("chain")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            F.col("many").alias("n_convs"),
            "n_children",
            (F.col("leaves") + F.coalesce("leaves_below", none)).alias("n_leaves"),
            (F.col("saved") + F.coalesce("saved_below", none)).alias("saved_tokens"),
            F.coalesce("ends", F.lit(_NOTHING)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations.

    Returns ``conv_id``, the smallest member; ``depth``; ``parent_conv_id``, null for the root; ``n_convs``;
    ``n_children``; ``n_leaves`` and ``saved_tokens`` of the subtree; and ``ends_sha256``. A node is known by
    ``conv_id`` and ``depth``: its text is that turn of that conversation. Null turns come first, null
    roles and texts are empty, rows without a ``conv_id`` take no part, repeated rows are turns of their own,
    and an empty table has no trie. Other columns are not looked at.
    """
    return trie(*rebuilt(numbered(conversations)))
