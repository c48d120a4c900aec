"""Registered queries of the text operators, and the same in SQL where it can be said."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake.llm import (
    ann,
    bpe,
    decontaminate,
    extract,
    importance,
    langid,
    pii,
    quality,
    secrets,
    simhash,
    substrings,
    trie,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from four folds of five."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives and read back."""
    return warc.archived(_table(spark, sf_dir, "pages")).drop("url")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, and where; clean documents have no row."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract.extract(_table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of two folds of three."""
    found = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that repeat earlier ones."""
    return substrings.kept_digests(_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one."""
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of every document, and digests of what the tokens decode to."""
    return bpe.token_digests(_table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in a draw that follows the benchmark."""
    return importance.importance(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_language,
        op3_warc,
        op4_decontaminate,
        op5_extract,
        op6_quality,
        op7_substrings,
        op8_secrets,
        op9_neighbours,
        op10_bpe,
        op11_importance,
        op12_pii,
        op13_trie,
    )
}

_DIGEST = """list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(hex || '0', CAST((5 * i) // 4 AS INTEGER) + 1, 2) AS INTEGER) >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31) + 1, 1)),
    'string_agg', '')"""

_WARC = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
responses AS (SELECT html, max(page_id) AS response FROM payloads GROUP BY html)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, {_DIGEST} AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM payloads p JOIN responses USING (html)
"""

_SUBSTRINGS = f"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
    SELECT doc_id, s, array_to_string(w[s:s + {substrings.SPAN - 1}], ' ') AS k
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substrings.SPAN - 2})) AS s FROM d WHERE len(w) >= {substrings.SPAN})),
repeated AS (
    SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS turn FROM win)
    WHERE turn > 1),
gone AS (
    SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(s, s + {substrings.SPAN})) AS p FROM repeated)),
words AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
    SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS text, count(*) AS n
    FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


def _matched(name: str, pattern: str, group: int, least: int) -> str:
    """CTE of the spans of one pattern: lengths of what lies between matches add up to places."""
    quoted = pattern.replace("'", "''")
    return f"""{name}_parts AS (
    SELECT doc_id, unnest(regexp_split_to_array(text, '{quoted}')) AS piece,
           generate_subscripts(regexp_split_to_array(text, '{quoted}'), 1) AS i,
           regexp_extract_all(text, '{quoted}', 0) AS whole, regexp_extract_all(text, '{quoted}', {group}) AS value
    FROM texts WHERE regexp_matches(text, '{quoted}')),
{name} AS (
    SELECT doc_id, value, stop - length(whole) AS start, stop FROM (
        SELECT doc_id, whole[i] AS whole, value[i] AS value,
               sum(length(piece) + coalesce(length(whole[i]), 0)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
        FROM {name}_parts)
    WHERE length(value) >= {least})"""


def _secrets_sql() -> str:
    n, words = len(secrets.WORDS), ", ".join(f"'{w}'" for w in secrets.WORDS)
    return f"""
WITH vocabulary AS (SELECT [{words}] AS w),
made AS (
    SELECT id, sha256('sample ' || id) AS digest, base64(unhex(sha256('sample ' || id))) AS packed, CAST(id % 90 AS VARCHAR) AS num,
           w[(id * 7919 + 11) % {n} + 1] AS a, w[(id * 104729 + 29) % {n} + 1] AS b, w[(id * 1299709 + 53) % {n} + 1] AS c
    FROM range(1, {secrets.SAMPLES + 1}) AS r(id), vocabulary),
samples AS (
    SELECT true AS random, CASE id % 4 WHEN 0 THEN substr(digest, 1, 40) WHEN 1 THEN packed
        WHEN 2 THEN upper(regexp_replace(packed, '[+/=]', '', 'g')) ELSE replace(translate(packed, '+/', '-_'), '=', '') END AS value FROM made
    UNION ALL
    SELECT false, CASE id % 8 WHEN 0 THEN a || '_' || b || '_' || c
        WHEN 1 THEN a || upper(b[1]) || b[2:] || upper(c[1]) || c[2:]
        WHEN 2 THEN a || '-' || b || '-' || c || '-' || num
        WHEN 3 THEN upper(a || '_' || b || '_' || num)
        WHEN 4 THEN a || b || c
        WHEN 5 THEN a || '/' || b || '/' || c
        WHEN 6 THEN a || num || b || '=' || c || num
        ELSE upper(a[1]) || a[2:] || '-' || (1950 + id % 80) || '-' || num || '-' || b END FROM made),
pairs AS (SELECT random, substr(value, i, 1) AS one, substr(value, i + 1, 1) AS two
    FROM (SELECT random, value, unnest(range(1, length(value))) AS i FROM samples)),
letters AS (SELECT chr(CAST({secrets._FIRST} + i AS INTEGER)) AS x FROM range({secrets._LETTERS}) AS r(i)),
grid AS (
    SELECT p.x AS one, q.x AS two, count(*) FILTER (WHERE random) + 0.5 AS r, count(*) FILTER (WHERE NOT random) + 0.5 AS o
    FROM letters p, letters q LEFT JOIN pairs ON pairs.one = p.x AND pairs.two = q.x GROUP BY 1, 2),
weights AS (
    SELECT one, two, CAST(round(1000 * (log2(r / sum(r) OVER (PARTITION BY one)) - log2(o / sum(o) OVER (PARTITION BY one)))) AS BIGINT) AS weight
    FROM grid),
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_matched("assign_at", secrets.ASSIGN, 2, secrets.LEAST_ASSIGN)},
{_matched("access_at", secrets.ACCESS, 0, secrets.LEAST_ACCESS)},
{_matched("hex_at", secrets.HEX, 0, 0)},
{_matched("token_at", secrets.TOKEN, 0, secrets.LEAST_TOKEN)},
base AS (
    SELECT doc_id, start, stop, 0 AS rank, 'assign' AS kind FROM assign_at
    UNION ALL SELECT doc_id, start, stop, 1, 'access' FROM access_at
    UNION ALL SELECT doc_id, start, stop, 2, 'hex' FROM hex_at),
ratios AS (
    SELECT t.doc_id, t.start, t.stop, t.value, sum(weight) AS ratio
    FROM (SELECT *, unnest(range(1, length(value))) AS i FROM token_at) t
    JOIN weights ON one = substr(value, i, 1) AND two = substr(value, i + 1, 1) GROUP BY ALL),
every AS (
    SELECT * FROM base
    UNION ALL
    SELECT doc_id, start, stop, 3, 'random' FROM ratios r
    WHERE ratio >= {secrets.THRESHOLD} * (length(value) - 1)
      AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.start < r.stop AND r.start < b.stop)),
listed AS (
    SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access,
           count(*) FILTER (WHERE rank = 2) AS n_hex,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
    FROM every GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts t LEFT JOIN listed ON listed.doc_id = t.doc_id
"""


# CRC-32 by table: the table's own rows, and the checksum of a list of bytes in a query that joins it.
_CRC_TABLE = """crc AS (
    SELECT list(c ORDER BY i) AS crc FROM (
        SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i) AS c
        FROM range(256) AS r(i)))"""


def _crc(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text that is not empty."""
    return f"""xor(4294967295, list_reduce(
        list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex(encode({text})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
        lambda c, b: xor(c >> 8, crc[CAST(xor(c, b) & 255 AS INTEGER) + 1]), CAST(4294967295 AS BIGINT)))"""


_IMPORTANCE = f"""
WITH {_CRC_TABLE},
texts AS (
    SELECT true AS target, item_id AS id, text FROM benchmark UNION ALL SELECT false, doc_id, text FROM documents),
words AS (
    SELECT target, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM texts),
runs AS (
    SELECT target, id, array_to_string(w[i:i + k], ' ') AS feature
    FROM (SELECT target, id, w, k, unnest(range(1, CAST(len(w) - k AS BIGINT) + 1)) AS i FROM words, range(3) AS r(k))),
found AS (SELECT feature, {_crc("feature")} % {importance.BUCKETS} AS bucket FROM (SELECT DISTINCT feature FROM runs), crc),
features AS (SELECT target, id, bucket FROM runs JOIN found USING (feature)),
sums AS (SELECT count(*) FILTER (WHERE NOT target) AS all_docs, count(*) FILTER (WHERE target) AS all_target FROM features),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * (all_docs + {importance.BUCKETS}))
                                        / (CAST(s + 1 AS DOUBLE) * (all_target + {importance.BUCKETS})))) AS BIGINT) AS gain
    FROM (SELECT bucket, count(*) FILTER (WHERE NOT target) AS s, count(*) FILTER (WHERE target) AS t FROM features GROUP BY 1), sums),
weights AS (
    SELECT id, count(*) AS n_features, sum(gain) AS weight FROM features JOIN gains USING (bucket) WHERE NOT target GROUP BY 1),
scored AS (
    SELECT d.id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
           CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{importance.SEED}:' || d.id), 1, 8) AS BIGINT) + 0.5)
                                                         / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
    FROM words d LEFT JOIN weights ON weights.id = d.id WHERE NOT target),
places AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_words >= {importance.LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN place <= {importance.SHARE} * n // 100 THEN place END AS rank
FROM scored s LEFT JOIN places ON places.doc_id = s.doc_id
"""


_TRIE = f"""
WITH {_CRC_TABLE},
turns AS (
    SELECT conv_id, token, bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, token) AS place
    FROM (SELECT conv_id, turn, octet_length(encode(text)) AS bytes,
                 substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32) AS token
          FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))),
lengths AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
families AS (
    SELECT l.conv_id, l.lead, h, least(h, coalesce(m.n, 0)) AS taken
    FROM (SELECT conv_id, conv_id - conv_id % {trie.FAMILY} AS lead, {_crc("CAST(conv_id AS VARCHAR)")} % {trie.SHARED} AS h FROM lengths, crc) l
    LEFT JOIN lengths m ON m.conv_id = l.lead),
rebuilt AS (
    SELECT f.conv_id, place, token, bytes FROM families f JOIN turns t ON t.conv_id = f.lead AND place <= h
    UNION ALL SELECT conv_id, taken + place - h, token, bytes FROM families JOIN turns USING (conv_id) WHERE place > h),
paths AS (
    SELECT conv_id, place AS depth, sha256(string_agg(token, ',') OVER (PARTITION BY conv_id ORDER BY place)) AS key, bytes FROM rebuilt
    UNION ALL SELECT conv_id, 0, 'root', 0 FROM lengths),
nodes AS (SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved FROM paths GROUP BY ALL),
parents AS (
    SELECT n.key, o.key AS parent, o.conv_id AS parent_conv_id
    FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 JOIN nodes o ON o.key = p.key),
children AS (SELECT parent AS key, count(*) AS n_children FROM parents GROUP BY 1),
totals AS (
    SELECT p.key, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, sum(saved) AS saved_tokens
    FROM nodes n LEFT JOIN children c ON c.key = n.key JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY 1),
ends AS (
    SELECT key, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) AS convs
    FROM (SELECT conv_id, max_by(key, depth) AS key FROM paths GROUP BY 1) GROUP BY 1)
SELECT n.conv_id, n.depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(convs, '')) AS ends_sha256
FROM nodes n JOIN totals t ON t.key = n.key LEFT JOIN parents p ON p.key = n.key LEFT JOIN children c ON c.key = n.key
     LEFT JOIN ends e ON e.key = n.key
"""


def _pii_sql() -> str:
    digits = "regexp_replace(value, '[^0-9]', '', 'g')"
    luhn = """list_sum(list_transform(range(length(digits)), lambda i:
        CASE WHEN i % 2 = 0 THEN CAST(substr(digits, length(digits) - i, 1) AS INTEGER)
             ELSE CAST(substr('0246813579', CAST(substr(digits, length(digits) - i, 1) AS INTEGER) + 1, 1) AS INTEGER) END)) % 10 = 0"""
    plain = "replace(value, ' ', '')"
    turned = f"substr({plain}, 5) || substr({plain}, 1, 4)"
    # a letter counts ten to thirty-five, and moves what stood before it by two places
    mod_97 = f"""list_reduce(list_transform(range(length({plain})), lambda i: strpos('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({turned}, CAST(i + 1 AS INTEGER), 1)) - 1),
        lambda r, x: (r * CASE WHEN x > 9 THEN 100 ELSE 10 END + x) % 97, CAST(0 AS BIGINT)) = 1"""
    ranks = {kind: i for i, kind in enumerate(pii.KINDS)}
    priors = " ".join(f"WHEN {ranks[k]} THEN {p}" for k, p in pii.PRIORS.items())
    speaks = " ".join(f"WHEN {ranks[k]} THEN regexp_matches(near, '{pii._word(w)}')" for k, w in pii.CONTEXT.items())
    ssn = "value[1:3] NOT IN ('000', '666') AND value < '9' AND value[5:6] <> '00' AND value[8:11] <> '0000'"
    apart = """NOT EXISTS (SELECT 1 FROM {others} o WHERE o.doc_id = s.doc_id AND o.start < s.stop AND s.start < o.stop)"""
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_matched("email_at", pii.EMAIL, 0, 0)},
{_matched("ip_at", pii.IP, 0, 0)},
{_matched("card_at", pii.CARD, 0, 0)},
{_matched("phone_at", pii.PHONE, 0, 0)},
{_matched("iban_at", pii.IBAN, 0, 0)},
{_matched("ssn_at", pii.SSN, 0, 0)},
cards AS (SELECT *, length(digits) AS many FROM (SELECT *, {digits} AS digits FROM card_at) WHERE length(digits) BETWEEN 13 AND 19 AND {luhn}),
proposed AS (
    SELECT doc_id, {ranks["email"]} AS rank, start, stop FROM email_at
    UNION ALL SELECT doc_id, {ranks["ip"]}, start, stop FROM ip_at
        WHERE list_bool_and(list_transform(string_split(value, '.'), lambda p: length(ltrim(p, '0')) < 4 AND CAST('0' || right(p, 3) AS INTEGER) <= 255))
    UNION ALL SELECT doc_id, CASE WHEN many > 15 THEN {ranks["card"]} ELSE {ranks["payment"]} END, start, stop FROM cards
    UNION ALL SELECT doc_id, {ranks["phone"]}, start, stop FROM phone_at WHERE length({digits}) BETWEEN 8 AND 15
    UNION ALL SELECT doc_id, {ranks["iban"]}, start, stop FROM iban_at WHERE {mod_97}
    UNION ALL SELECT doc_id, {ranks["ssn"]}, start, stop FROM ssn_at WHERE {ssn}),
scored AS (
    SELECT doc_id, rank, start, stop, greatest(0, least(100, CASE rank {priors} END
           + CASE WHEN CASE rank {speaks} END THEN {pii.FOR} ELSE 0 END
           - CASE WHEN regexp_matches(near, '{pii._word(pii.COUNTER)}') THEN {pii.AGAINST} ELSE 0 END)) AS score
    FROM (SELECT p.*, translate(substr(text, CAST(greatest(start - {pii.BEFORE}, 0) + 1 AS BIGINT), CAST(least(start, {pii.BEFORE}) AS BIGINT)) || chr(10)
                                || substr(text, CAST(stop + 1 AS BIGINT), {pii.AFTER}),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS near
          FROM proposed p JOIN texts USING (doc_id))),
base AS (SELECT * FROM scored WHERE rank < {pii.BASE}),
with_iban AS (SELECT * FROM base UNION ALL
    SELECT * FROM scored s WHERE rank = {ranks["iban"]} AND score >= {pii.THRESHOLD} AND {apart.format(others="base")}),
with_payment AS (SELECT * FROM with_iban UNION ALL
    SELECT * FROM scored s WHERE rank = {ranks["payment"]} AND score >= {pii.THRESHOLD} AND {apart.format(others="with_iban")}),
every AS (SELECT * FROM with_payment UNION ALL
    SELECT * FROM scored s WHERE rank = {ranks["ssn"]} AND score >= {pii.THRESHOLD} AND {apart.format(others="with_payment")}),
named AS (SELECT *, [{", ".join(f"'{k}'" for k in pii.KINDS)}][rank + 1] || ':' || start || ':' || stop AS span FROM every),
listed AS (
    SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE rank = {ranks[k]}) AS n_{k}" for k in pii.KINDS[: pii.BASE])},
           string_agg(span, ',' ORDER BY rank, start) FILTER (WHERE rank < {pii.BASE}) AS base,
           string_agg(span, ',' ORDER BY rank, start) AS spans, string_agg(CAST(score AS VARCHAR), ',' ORDER BY rank, start) AS scores
    FROM named GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in pii.KINDS[: pii.BASE])},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM texts t LEFT JOIN listed ON listed.doc_id = t.doc_id
"""


ORACLES: dict[str, str] = {
    "op3_warc": _WARC,
    "op7_substrings": _SUBSTRINGS,
    "op8_secrets": _secrets_sql(),
    "op11_importance": _IMPORTANCE,
    "op12_pii": _pii_sql(),
    "op13_trie": _TRIE,
}
