"""The prefix trie of conversations against one made of nested dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from demandlake.llm import trie
from demandlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def remainder(a, b):
    return a - b * int(a / b)


def rebuilt_by_hand(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            joined = f"{len(role.encode())}:{role}{text}".encode()
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(joined).digest()[:16], role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    result = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        result[c] = own.get(c - remainder(c, 5), [])[:h] + turns[h:]
    return result


def trie_by_hand(rows):
    members, last = defaultdict(set), defaultdict(set)
    for c, turns in rebuilt_by_hand(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].add(c)
        last[tuple(turns)].add(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[b] for b in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[b] for b in below)
    return sorted(
        (
            min(convs),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(convs),
            len(children[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(last[node]))).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def nodes_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_trie_of_all_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes_of(QUERIES["op13_trie"](spark, SF)) == trie_by_hand(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_of_odd_conversations(spark, seed):
    """Nulls anywhere, ties, repeated rows, negative numbers, deep and missing leaders, one very common beginning."""
    rng = random.Random(seed)
    rows = []
    for conv in [None, -7, -5, *rng.sample(range(200), 60), 10**15 + 2]:
        common = rng.random() < 0.5
        many = 70 if conv == 0 else rng.choice([1, 2, 3, 4, 8, 9, 15, 16, 17, 33])
        for turn in range(many):
            text = "same" if common else rng.choice(["x", "yä", "", None])
            rows.append((conv, rng.choice([turn, turn, 0, None]) if rng.random() < 0.1 else turn, rng.choice(["user", None]) if rng.random() < 0.05 else "user", text))
    rows += rng.sample(rows, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("len", "root", "place", "half", "n_convs", "ends"):
        df = df.withColumn(name, F.lit("clash"))
    assert nodes_of(trie.prefix_trie(df)) == trie_by_hand(rows)


def test_turnless_conversations_end_in_the_root(spark):
    # no leader, and fewer turns than would be replaced
    rows = [(c, 0, "user", "a") for c in range(1, 40) if c % 5]
    found = nodes_of(trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == trie_by_hand(rows)
    assert found[0][1] == 0 and any(not turns for turns in rebuilt_by_hand(rows).values())
    only = [(c, 0, "user", "a") for c in range(1, 40) if c % 5 and zlib.crc32(str(c).encode()) % 9]
    found = nodes_of(trie.prefix_trie(spark.createDataFrame(only, SCHEMA)))
    assert found == trie_by_hand(only) and len(found) == 1 and found[0][5] == 1


def test_no_conversations_have_no_trie(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).count() == 0
