"""Byte-level BPE with the merges done by sentencepiece.

The vocabulary comes as ranks of byte strings. It is written out as a sentencepiece BPE
model: each byte becomes one printable character, each token one piece with its negative
rank as score, and nothing is normalised. Text is cut into pre-tokens, each is encoded on
its own, and identifiers are decoded by the inverse of the byte mapping.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as proto

from demandlake.llm.rows import per_batch

# A worker remembers so many pre-tokens, then starts anew.
_REMEMBERED = 500_000
# Texts are encoded together up to so many characters.
_TOGETHER = 1 << 20


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is visible Latin-1, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(0x100 + hidden.index(b)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def serialise(ranks: dict[bytes, int]) -> bytes:
    """The sentencepiece model of a vocabulary; a token's identifier is its rank.

    Ranks have to be 0, 1, 2 and so on, since a piece's identifier is its place. The
    unknown piece that the format demands stands behind the last and is never produced,
    as every byte has a piece.
    """
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be 0, 1, 2, ... without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte needs a token")
    letters = byte_letters()
    model = proto.ModelProto()
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(ranks) + 1
    model.trainer_spec.unk_id = len(ranks)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.trainer_spec.unk_piece = ""
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        model.pieces.add(piece="".join(letters[b] for b in token), score=-float(rank))
    model.pieces.add(piece="", score=0.0, type=proto.ModelProto.SentencePiece.UNKNOWN)
    return model.SerializeToString()


# Letters, digits and white space of texts that hold nothing beyond them but ASCII signs.
_LATIN, _DIGITS, _SPACES = "A-Za-zÀ-ÖØ-öø-ſ", "0-9", r"\t-\r "
_beyond_latin = re.compile(f"[^\x00-\x1b\x20-\x7f{_LATIN}]").search


def latin_form(pattern: str) -> str | None:
    """The pattern with its classes narrowed to Latin text, for the faster standard module."""
    narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{_LATIN}{_DIGITS}]")
    for wide, chars in ((r"\p{L}", f"[{_LATIN}]"), (r"\p{N}", f"[{_DIGITS}]"), (r"\S", f"[^{_SPACES}]"), (r"\s", f"[{_SPACES}]")):
        narrow = narrow.replace(wide, chars)
    return None if re.search(r"\\[a-zA-Z]", narrow.replace(_SPACES, "")) or "(?i" in narrow else narrow


class ByteBpe(dict):
    """Encodes and decodes whole texts; as a dict, it remembers the packed identifiers of pre-tokens."""

    def __init__(self, model: bytes, pattern: str) -> None:
        super().__init__()
        self._pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._any = regex.compile(pattern).findall
        latin = latin_form(pattern)
        self._plain = re.compile(latin).findall if latin else self._any
        letters = byte_letters()
        self._mapped = dict(enumerate(letters))
        back = {letter: b for b, letter in enumerate(letters)}
        self._bytes = [
            bytes(back[c] for c in self._pieces.id_to_piece(i)) for i in range(self._pieces.get_piece_size() - 1)
        ]
        # a pre-token that is a token stays whole, whether or not merges would lead to it
        self._whole = {token: np.uint32(i).tobytes() for i, token in enumerate(self._bytes)}

    def _learn(self, tokens: set[str]) -> None:
        """Encode all of these at once, which costs a third of single calls."""
        if len(self) + len(tokens) > _REMEMBERED:
            self.clear()
        rest = []
        for token in tokens:
            packed = self._whole.get(token.encode())
            if packed is None:
                rest.append(token)
            else:
                self[token] = packed
        mapped = [token.encode().decode("latin-1").translate(self._mapped) for token in rest]
        for token, ids in zip(rest, self._pieces.encode(mapped, out_type=int, num_threads=1), strict=True):
            self[token] = array("I", ids).tobytes()

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """For each text its identifiers as little-endian unsigned 32-bit numbers."""
        done: list[bytes] = []
        waiting: list[list[str]] = []
        size = 0

        def flush() -> None:
            wanted = set(chain.from_iterable(waiting))
            new = wanted.difference(self)
            if len(self) + len(new) > _REMEMBERED:
                new = wanted
            if new:
                self._learn(new)
            done.extend(b"".join(map(self.__getitem__, tokens)) for tokens in waiting)
            waiting.clear()

        for text in texts:
            waiting.append(self._any(text) if _beyond_latin(text) else self._plain(text))
            size += len(text)
            if size >= _TOGETHER:
                flush()
                size = 0
        flush()
        return done

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self._bytes.__getitem__, np.frombuffer(packed, "<u4").tolist()))


@lru_cache(maxsize=1)
def coder(model: bytes, pattern: str) -> ByteBpe:
    """One coder for all tasks that a worker process runs one after another."""
    return ByteBpe(model, pattern)


def packed_documents(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Every document as tokens.

    ``vocabulary`` is the path of a rank file, read on the driver; its size, a few hundred
    kilobytes, is that of the model each task gets. Returns ``doc_id``, ``lang``, ``source``,
    ``ids`` (array of token identifiers), ``n_tokens``, and ``intact``: whether the
    identifiers decode to the bytes of the text. A null or empty text has no tokens and is
    intact. Rows that repeat are encoded alike; an empty table gives an empty one.
    """
    model = serialise(read_ranks(vocabulary))

    def make():
        bpe = coder(model, pattern)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed = bpe.encode(texts)
            intact = [bpe.decode(p) == t.encode() for p, t in zip(packed, texts, strict=True)]
            sizes = [len(p) // 4 for p in packed]
            ids = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32)),
            )
            kept = [n for n in batch.schema.names if n != "text"]
            return pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], ids, pa.array(sizes, pa.int64()), pa.array(intact, pa.bool_())],
                [*kept, "ids", "n_tokens", "intact"],
            )

        return apply

    kept = ["doc_id", "lang", "source"]
    narrow = docs.select(*kept, F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.select(*kept).schema.fields)
    return per_batch(narrow, make, f"{fields}, ids array<int>, n_tokens long, intact boolean")


def token_digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, and SHA-256 of the identifiers and of the decoded bytes.

    Digests are taken where the tokens are, so the tokens themselves don't travel.
    """
    model = serialise(read_ranks(vocabulary))

    def make():
        bpe = coder(model, pattern)

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, ids, back = [], [], []
            for packed in bpe.encode(t or "" for t in batch.column("text").to_pylist()):
                sizes.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(bpe.decode(packed)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return apply

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return per_batch(narrow, make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
