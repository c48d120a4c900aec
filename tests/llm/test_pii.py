"""Personal data against the plain patterns, and what validators and context make of it."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from demandlake.llm import pii
from demandlake.llm.queries import QUERIES
from test_llm import DOCS, ODD

SF = "/root/testdata/sf0.001"


def luhn_by_hand(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        total += int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4)
    return total % 10 == 0


def base_by_hand(text):
    """(kind, start, end) of the base kinds, by the patterns as they are given."""
    found = [("email", *m.span()) for m in re.finditer(pii.EMAIL, text)]
    found += [("ip", *m.span()) for m in re.finditer(pii.IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(pii.CARD, text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn_by_hand(digits):
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(pii.PHONE, text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return found


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def holds(row, text):
    want = base_by_hand(text or "")
    listed = [s.split(":") for s in row["spans"].split(",") if s]
    listed = [(k, int(a), int(b)) for k, a, b in listed]
    assert [s for s in listed if s[0] in pii.KINDS[: pii.BASE]] == want
    assert row["base_sha256"] == digest(want)
    assert [row[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [sum(s[0] == k for s in want) for k in ("email", "ip", "card", "phone")]
    assert listed == sorted(listed, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
    assert len(row["scores"].split(",")) == max(1, len(listed))


def test_personal_data_of_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op12_pii"](spark, SF).collect()
    assert len(found) == len(texts)
    for row in found:
        holds(row, texts[row["doc_id"]])
    assert sum(len(r["spans"]) > 0 for r in found) > 10


@pytest.mark.parametrize("letters", ["a.@-_ ", "12.. ", "0123456789- ", "+1(). -5", "a1.@+- 4\n"])
def test_base_spans_like_the_plain_patterns(letters):
    rng = random.Random(letters)
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 60)))
        found = [(pii.KINDS[k], a, b) for k, a, b, _ in pii.spans(text) if k < pii.BASE]
        assert found == base_by_hand(text), text


def test_personal_data_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    for name in ("spans", "scores", "n_email", "kind"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = pii.personal_data(docs)
    assert sorted(map(str, (r["doc_id"] for r in found.collect()))) == sorted(str(r[0]) for r in ODD)
    texts = {r[0]: r[1] for r in ODD if r[0] is not None}
    for row in found.where("doc_id is not null").collect():
        holds(row, texts[row["doc_id"]])
    assert pii.personal_data(docs.limit(0)).count() == 0
    masked = pii.redact(docs)
    assert masked.columns == docs.columns
    assert sorted(map(str, masked.select("text").collect())) == sorted(map(str, docs.select("text").collect()))


def test_long_runs_take_linear_time():
    started = time.monotonic()
    for run in ("a" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "1 " * 500_000, "+1" + " " * 1_000_000, "a@" * 500_000, "A1" * 500_000, "@a." * 300_000):
        pii.spans(run)
    assert time.monotonic() - started < 30


def kinds_of(text):
    return [(pii.KINDS[k], text[a:b], s) for k, a, b, s in pii.spans(text)]


def test_validators_and_context():
    assert kinds_of("IBAN DE89370400440532013000.") == [("iban", "DE89370400440532013000", 100)]
    assert kinds_of("send it to GB29 NWBK 6016 1331 9268 19 today") == [("iban", "GB29 NWBK 6016 1331 9268 19", 80)]
    assert kinds_of("IBAN DE89370400440532013001.") == []  # the check fails
    assert kinds_of("sample order DE89370400440532013000.") == []  # words speak against it, none for it
    assert kinds_of("my amex is 378282246310005") == [("payment", "378282246310005", 75)]
    assert kinds_of("number 378282246310005") == []
    assert kinds_of("ssn: 123-45-6789") == [("ssn", "123-45-6789", 70)]
    assert kinds_of("ssn: 666-45-6789") == kinds_of("ssn: 923-45-6789") == kinds_of("123-45-6789") == []
    assert kinds_of("sample card 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111", 80)]
    assert kinds_of("order 4111-1111-1111-1111") == [("card", "4111-1111-1111-1111", 50)]  # base spans stay
    assert kinds_of("mail a.b@c.d or call +49 (30) 1234-567") == [("email", "a.b@c.d", 100), ("phone", "+49 (30) 1234-567", 100)]
    assert kinds_of("discard 378282246310005") == []  # no part of a word is context
    # 16 digits that pass stay a card; what overlaps them is nothing else
    assert [k for k, *_ in kinds_of("bank account 4111111111111111")] == ["card"]


def test_masks():
    assert pii.masked("from a@b.c, IP 10.0.0.1!") == "from [EMAIL], IP [IP]!"
    assert pii.masked("") == "" and pii.masked("nothing") == "nothing"
    assert pii.masked("+378282246310005 amex") == "[PHONE] amex"
    assert pii.masked("1.2.3.4@host.example") == "[EMAIL]"  # the address lies inside
