"""Importance resampling against brute force, bisection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from demandlake.llm import importance
from demandlake.llm.queries import QUERIES
from test_llm import DOCS, ODD

SF = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}


def features_of(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) for r in runs]


def drawn_by_hand(docs, target, share=5, seed=42):
    """doc_id, n_features, weight, score and rank of (doc_id, text) rows."""
    found = [(doc, *features_of(text)) for doc, text in docs]
    s = Counter(f % 10_000 for _, _, feats in found for f in feats)
    t = Counter(f % 10_000 for text in target for f in features_of(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for doc, words, feats in found:
        gains = [math.floor(1000 * math.log((t[f % 10_000] + 1) * (all_s + 10_000) / ((s[f % 10_000] + 1) * (all_t + 10_000)))) for f in feats]
        name = f"{seed}:{'' if doc is None else doc}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc, len(feats), sum(gains), sum(gains) + noise, words))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    places = {id(r): i for i, r in enumerate(able[: math.floor(share * len(able) / 100)], start=1)}
    return sorted(((*r[:4], places.get(id(r))) for r in rows), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_draw_of_all_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = rows_of(QUERIES["op11_importance"](spark, SF))
    assert found == drawn_by_hand(docs, target)
    assert sum(r[4] is not None for r in found) == math.floor(0.05 * sum(features_of(t)[0] >= 20 for _, t in docs))


def test_draw_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    for name in ("score", "weight", "rank", "number", "bucket", "n_words", "__id"):
        docs = docs.withColumn(name, F.lit("clash"))
    target = spark.createDataFrame([(1, "no word here"), (2, None), (None, "")], "item_id long, text string").withColumn("n", F.lit(1))
    found = rows_of(importance.importance(docs, target))
    assert found == drawn_by_hand([r[:2] for r in ODD], ["no word here", None, ""])
    assert importance.importance(docs.limit(0), target).count() == 0
    assert rows_of(importance.importance(docs, target.limit(0))) == drawn_by_hand([r[:2] for r in ODD], [])
    kept = importance.resample(docs, target, share=100)
    assert kept.columns == docs.columns and kept.count() == 1  # one text has twenty words or more


def test_repeated_rows_are_drawn_one_by_one(spark):
    docs = [(i % 7 if i % 3 else None, "one two three " * 8) for i in range(90)]
    found = rows_of(importance.ranked(importance.scores(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([("two three",)], "text string")), share=37))
    want = drawn_by_hand(docs, ["two three"], share=37)
    assert found == want and sum(r[4] is not None for r in found) == 33


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_pieces_of_a_text_make_no_difference(monkeypatch, piece):
    monkeypatch.setattr(importance, "_PIECE", piece)
    for text in ("", "  ", "a", "Ab cd", "x" * 50, "Wort für Wort, 12 plus ÄÖ\x00日本 語 end ", "-- a-b-c d"):
        found = list(importance.features(text.encode()))
        words, want = features_of(text)
        assert sum(n for n, _ in found) == words
        assert Counter(x for _, feats in found for x in feats.tolist()) == Counter(want)


def test_cutoff_like_sorting(spark):
    rng = random.Random(1)
    for spread in (1, 3, 1000, 1 << 62):
        values = [rng.randint(-spread, spread) for _ in range(300)]
        df = spark.createDataFrame([(v,) for v in values], "v long")
        for need in (1, 150, 300):
            value, below, equal = importance.cutoff(df, "v", need)
            assert value == sorted(values)[need - 1]
            assert (below, equal) == (sum(v < value for v in values), values.count(value))
