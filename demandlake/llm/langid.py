"""Language identification with string kernels.

The kernel of two texts counts the letter n-grams of length 1 to 3 that occur in both
(presence, not frequency), divided by the root of the product of their own counts.
Nyström landmarks turn it into a short feature vector, and one ridge regression per
language tells that language from the rest.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlake.llm.rows import crc_of, draw, per_batch

# A long text is scored piece by piece, so a passage in another language counts by its length.
PIECE = 1024
# Upper bounds of the sample: rows of one language, and landmarks of all.
ROWS_PER_LANGUAGE = 500
LANDMARKS = 160
RIDGE = 0.05
UNKNOWN = "und"

_SYMBOLS = 128
_CODES = _SYMBOLS + _SYMBOLS**2 + _SYMBOLS**3
_GROUP = 128


class Grams:
    """Distinct letter n-grams of whole texts, as numbers.

    Letters are lower-cased and mapped to 127 symbols: a-z and the Latin-1 letters have
    one each, letters of other scripts share the rest by code point. What lies between
    letters is one blank.
    """

    def __init__(self) -> None:
        points = np.arange(1 << 16)
        letter = np.array([chr(p).isalpha() for p in points])
        symbol = np.where(letter, 60 + points % 67, 0)
        symbol[97:123] = np.arange(1, 27)
        symbol[0xDF:0x100] = np.where(letter[0xDF:0x100], np.arange(27, 60), 0)
        self._symbol = symbol.astype(np.int32)
        self._slot = np.zeros(_CODES, np.int32)

    def __call__(self, text: str | None) -> list[np.ndarray]:
        """The n-grams of each piece of ``PIECE`` symbols; no piece without a letter."""
        points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
        if len(points) and points.max() >= 1 << 16:
            wide = [60 + p % 67 if chr(p).isalpha() else 0 for p in points[points >= 1 << 16].tolist()]
            row = self._symbol[np.minimum(points, (1 << 16) - 1)]
            row[points >= 1 << 16] = wide
        else:
            row = self._symbol[points]
        row = np.concatenate([[0], row, [0]]).astype(np.int32)
        row = row[np.concatenate([[True], (row[1:] | row[:-1]) != 0])]
        if len(row) < 3:
            return []
        parts = max(1, round(len(row) / PIECE))
        return [self._grams(part) for part in np.array_split(row, parts)]

    def _grams(self, row: np.ndarray) -> np.ndarray:
        pairs = row[:-1] * _SYMBOLS + row[1:]
        triples = pairs[:-1] * _SYMBOLS + row[2:]
        return self._distinct(
            np.concatenate([row[row > 0], pairs + _SYMBOLS, triples + (_SYMBOLS + _SYMBOLS**2)])
        )

    def _distinct(self, codes: np.ndarray) -> np.ndarray:
        order = np.arange(len(codes), dtype=np.int32)
        self._slot[codes] = order
        return codes[self._slot[codes] == order]


@dataclass
class LanguageModel:
    languages: list[str]
    vocabulary: np.ndarray  # codes of the landmarks' n-grams
    landmarks: np.ndarray  # presence, vocabulary x landmarks
    sizes: np.ndarray  # n-grams of each landmark
    weights: np.ndarray  # landmarks x languages

    def kernel(self, rows: list[np.ndarray], lookup: np.ndarray) -> np.ndarray:
        present = np.zeros((len(rows), len(self.vocabulary) + 1), np.float32)
        for i, codes in enumerate(rows):
            present[i, lookup[codes]] = 1
        shared = present[:, :-1] @ self.landmarks.astype(np.float32)
        own = np.array([max(1, len(codes)) for codes in rows], np.float32)
        return shared / np.sqrt(own[:, None] * self.sizes[None, :])

    def lookup(self) -> np.ndarray:
        """The place of each code in the vocabulary; codes outside have the place behind the last."""
        places = np.full(_CODES, len(self.vocabulary), np.int32)
        places[self.vocabulary] = np.arange(len(self.vocabulary))
        return places


def fit(sample: list[tuple[str, np.ndarray]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """A model of labelled rows of n-gram codes. Landmarks are spread evenly over the languages."""
    sample = [(lang, codes) for lang, codes in sample if len(codes)]
    languages = sorted({lang for lang, _ in sample})
    if not sample:
        return LanguageModel([], np.empty(0, np.int32), np.empty((0, 0), bool), np.empty(0), np.empty((0, 0)))
    by_language = {lang: [codes for at, codes in sample if at == lang] for lang in languages}
    each = -(-landmarks // len(languages))
    # long texts hold more n-grams and make better landmarks
    chosen = [c for rows in by_language.values() for c in sorted(rows, key=len, reverse=True)[:each]]
    vocabulary = np.unique(np.concatenate(chosen))
    present = np.zeros((len(vocabulary), len(chosen)), bool)
    for j, codes in enumerate(chosen):
        present[np.searchsorted(vocabulary, codes), j] = True
    sizes = np.array([len(c) for c in chosen], np.float32)
    model = LanguageModel(languages, vocabulary, present, sizes, np.empty((0, 0)))
    lookup = model.lookup()
    values, vectors = np.linalg.eigh(model.kernel(chosen, lookup).astype(np.float64))
    useful = values > values.max() * 1e-6
    root = vectors[:, useful] / np.sqrt(values[useful])
    parts = [model.kernel([c for _, c in sample[i : i + _GROUP]], lookup) for i in range(0, len(sample), _GROUP)]
    features = np.concatenate(parts).astype(np.float64) @ root
    wanted = np.array([[1.0 if lang == at else -1.0 for at in languages] for lang, _ in sample])
    # every language weighs the same, however many rows it has
    weight = np.array([1.0 / len(by_language[lang]) for lang, _ in sample])[:, None]
    gram = features.T @ (features * weight) + ridge / len(sample) * np.eye(features.shape[1])
    model.weights = root @ np.linalg.solve(gram, features.T @ (wanted * weight))
    return model


def one_piece(pieces: list[np.ndarray]) -> np.ndarray:
    """The piece of a sampled text to learn from, drawn by its content."""
    if not pieces:
        return np.empty(0, np.int32)
    return pieces[zlib.crc32(pieces[0].tobytes()) % len(pieces)]


def votes(model: LanguageModel, texts: list[list[np.ndarray]], lookup: np.ndarray) -> np.ndarray:
    """Mean margin of each language over the pieces of each text; minus one without pieces."""
    pieces = [p for t in texts for p in t]
    margins = np.full((len(texts), len(model.languages)), -1.0)
    if pieces:
        each = [model.kernel(pieces[i : i + _GROUP], lookup) @ model.weights for i in range(0, len(pieces), _GROUP)]
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        for lang, column in enumerate(np.clip(np.concatenate(each), -1, 1).T):
            total = np.bincount(owner, column, len(texts))
            some = np.bincount(owner, minlength=len(texts))
            margins[:, lang] = np.where(some > 0, total / np.maximum(some, 1), -1.0)
    return margins


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = ROWS_PER_LANGUAGE,
) -> LanguageModel:
    """A model learned from a sample drawn by identifier, about ``rows_per_language`` rows each.

    Rows without identifier, text or language teach nothing. Only the n-gram numbers of
    the sample reach the driver, at most twice ``rows_per_language`` rows a language.
    """
    labelled = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).dropna()
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return fit([])
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, rows_per_language / n))])
    drawn = draw(F.col("doc_id"), "language")
    sample = labelled.where(drawn < F.element_at(share, F.col("lang"))).withColumn("at", drawn)

    def make():
        grams = Grams()

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            codes = [one_piece(grams(t)).tobytes() for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("at"), pa.array(codes, pa.binary())], ["lang", "at", "codes"]
            )

        return apply

    coded = per_batch(sample.select("lang", "at", "text"), make, "lang string, at double, codes binary")
    rows = coded.orderBy("at", "lang", "codes").limit(2 * rows_per_language * len(counts)).collect()
    return fit([(r["lang"], np.frombuffer(bytes(r["codes"]), np.int32)) for r in rows])


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (0 to 1) for every row, from its whole text alone.

    A null text, a text without a letter, and any text if the model has no language, is
    ``und`` with score 0. Of equal scores the first language by name wins.
    """

    def make():
        grams, lookup = Grams(), model.lookup() if model.languages else None

        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("text")
            names: list[str] = []
            scores: list[float] = []
            for low in range(0, len(texts), _GROUP):
                rows = [grams(t) for t in texts.slice(low, _GROUP).to_pylist()]
                if lookup is None:
                    names += [UNKNOWN] * len(rows)
                    scores += [0.0] * len(rows)
                    continue
                margins = votes(model, rows, lookup)
                best = margins.argmax(axis=1)
                sure = (margins.max(axis=1) + 1) / 2
                for pieces, lang, score in zip(rows, best.tolist(), sure.tolist(), strict=True):
                    names.append(model.languages[lang] if pieces else UNKNOWN)
                    scores.append(score if pieces else 0.0)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

        return apply

    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return per_batch(narrow, make, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """Languages of all documents by a model that never saw the held-out fold.

    Returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score``. A null identifier is in
    no fold: its row is predicted, not held out, and teaches nothing. An empty table gives
    an empty one; rows that repeat are predicted alike.
    """
    fold = F.pmod(crc_of(F.col("doc_id")), F.lit(folds))
    model = train(docs.where(fold != held))
    return predict(docs, model).select(
        "doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
