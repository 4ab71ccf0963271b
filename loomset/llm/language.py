"""Language identification by the nearest of several centroids per language.

A text becomes counts of letter n-grams, hashed into a fixed number of
dimensions, damped, weighted by inverse document frequency and normalised. The
training vectors of each language are clustered (spherical k-means); a text
gets the language of the centroid with the greatest cosine. A text whose cosine
stays below a share of what that language's training texts reach is rejected.

Document frequencies are counted over all training documents. Centroids are
fitted on at most ``fit_per_language`` documents of each language, those with
the smallest hash of their key. The model is of fixed size: dimensions times
centroids times languages. Nothing but these and the fit sample is shuffled.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomset.llm.common import bounded_batches

DIMENSIONS = 8192
UNKNOWN = "und"
#: n-grams from which on a text is held to the whole floor of its language.
FULL_LENGTH = 300

_ORDERS = (1, 2, 3)
_PIECE = 1 << 18


@cache
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter(
        (unicodedata.category(chr(c)).startswith("L") for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1
    )


def gram_counts(text: str | None) -> np.ndarray | None:
    """Hashed counts of the letter n-grams of a whole text; None without any letter.

    Letters are lower-cased; every run of anything else is one word break,
    which n-grams of two and more include.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    counts = np.zeros(DIMENSIONS, np.int64)
    codes = np.where(letter, codes, 0)
    codes = np.concatenate(([0], codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))], [0]))
    for lo in range(0, len(codes), _PIECE):
        piece = codes[lo : lo + _PIECE + max(_ORDERS) - 1].astype(np.uint64)
        for order in _ORDERS:
            n = min(len(piece) - order + 1, _PIECE)
            if n < 1:
                continue
            value = piece[:n]
            for k in range(1, order):
                value = value << np.uint64(21) | piece[k : k + n]
            if order == 1:
                value = value[value != 0]
            hashed = (value + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((hashed >> np.uint64(51)).astype(np.int64), minlength=DIMENSIONS)
    return counts


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows of rows of counts."""
    return _unit(np.log1p(counts).astype(np.float32) * idf)


def cluster(points: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Up to k unit centroids of unit rows: spherical k-means from far-apart starts."""
    chosen = [0]
    near = points @ points[0]
    while len(chosen) < min(k, len(points)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, points @ points[chosen[-1]])
    centroids = points[chosen]
    for _ in range(rounds):
        own = (points @ centroids.T).argmax(axis=1)
        moved = _unit(np.stack([points[own == c].sum(axis=0) for c in np.unique(own)]))
        if moved.shape == centroids.shape and np.allclose(moved, centroids, atol=1e-6):
            break
        centroids = moved
    return centroids


@dataclass
class Model:
    languages: list[str]
    owner: np.ndarray
    centroids: np.ndarray
    idf: np.ndarray
    floor: np.ndarray

    def judge(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine (0 to 1) and whether it is rejected, of each text."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        counts = {i: c for i, t in enumerate(texts) if (c := gram_counts(t)) is not None}
        if counts and self.languages:
            near = vectors(np.stack(list(counts.values())), self.idf) @ self.centroids.T
            for (i, grams), c, cosine in zip(counts.items(), near.argmax(axis=1), near.max(axis=1)):
                owner = self.owner[c]
                # Few n-grams can't come near a centroid of long texts.
                floor = self.floor[owner] * min(1.0, float(grams.sum() / FULL_LENGTH) ** 0.5)
                out[i] = (self.languages[owner], float(np.clip(cosine, 0, 1)), bool(cosine < floor))
        return out


def fit(
    docs: DataFrame,
    training: Column,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    centroids: int = 4,
    fit_per_language: int = 400,
    tolerance: float = 0.3,
) -> Model:
    """A model of the rows for which ``training`` holds and whose language isn't null.

    ``tolerance``: a text is rejected below this share of the cosine that the
    lowest hundredth of the fitted texts of its language reach, and shorter
    texts below less. Languages that have no text with a letter aren't learned. Without any, all texts get ``und``.
    """
    bounded_batches(docs.sparkSession)
    known = docs.filter(training & F.col(lang).isNotNull()).select(
        F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    total, seen = 0, np.zeros(DIMENSIONS, np.int64)
    for row in known.select("text").mapInArrow(_frequencies, "gram int, docs long").groupBy("gram").agg(F.sum("docs")).collect():
        if row[0] < 0:
            total = row[1]
        else:
            seen[row[0]] = row[1]
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + 1
    # A share of each language's hashes that holds enough rows, so that few reach the numbering.
    held = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    shares = [(name, min(1.0, 2 * fit_per_language / n + 20 / n)) for name, n in sorted(held.items())]
    share = F.lit(0.0)
    if shares:
        share = F.element_at(F.create_map(*[F.lit(x) for pair in shares for x in pair]), F.col("lang"))
    by_hash = Window.partitionBy("lang").orderBy("hash", "key")
    picked = (
        known.select("key", "lang", F.pmod(F.xxhash64("key"), F.lit(1 << 40)).alias("hash"))
        .filter(F.col("hash") < share * float(1 << 40))
        .withColumn("nth", F.row_number().over(by_hash)).filter(F.col("nth") <= fit_per_language)
    )
    # At most fit_per_language keys of each language, so that texts need not move.
    sample = known.join(F.broadcast(picked.select("key", "lang")), ["key", "lang"], "left_semi")

    def of_language(name: tuple, batch: pa.Table) -> pa.Table:
        found = [c for t in batch.column("text").to_pylist() if (c := gram_counts(t)) is not None]
        if not found:
            return pa.table({"lang": pa.array([], pa.string()), "floor": pa.array([], pa.float64()), "centroid": pa.array([], pa.list_(pa.float32()))})
        points = vectors(np.stack(found), idf)
        middles = cluster(points, centroids)
        floor = tolerance * float(np.quantile((points @ middles.T).max(axis=1), 0.01))
        return pa.table(
            {
                "lang": pa.array([name[0].as_py()] * len(middles)),
                "floor": pa.array([floor] * len(middles)),
                "centroid": pa.array(list(middles), pa.list_(pa.float32())),
            }
        )

    rows = (
        sample.groupBy("lang").applyInArrow(of_language, "lang string, floor double, centroid array<float>").collect()
    )
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    languages = sorted({r["lang"] for r in rows})
    return Model(
        languages,
        np.array([languages.index(r["lang"]) for r in rows], int),
        np.array([r["centroid"] for r in rows], np.float32).reshape(-1, DIMENSIONS),
        idf,
        np.array([next(r["floor"] for r in rows if r["lang"] == name) for name in languages]),
    )


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a partition have each n-gram; at -1 the number of texts with a letter."""
    total, seen = 0, np.zeros(DIMENSIONS, np.int64)
    for batch in batches:
        for text in batch.column(0):
            counts = gram_counts(text.as_py())
            if counts is not None:
                total += 1
                seen += counts > 0
    grams = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *grams.tolist()], pa.int32()), pa.array([total, *seen[grams].tolist()], pa.int64())],
        names=["gram", "docs"],
    )


def _judged(model, column: pa.Array) -> list[tuple[str, float, bool]]:
    found: list[tuple[str, float, bool]] = []
    for lo in range(0, len(column), 128):
        found += model.value.judge(column.slice(lo, 128).to_pylist())
    return found


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with ``text`` replaced by ``lang_pred``, ``score`` (cosine) and ``rejected``.

    Null texts and texts without a letter get ``und``, 0 and true. Any other
    text names the nearest language, rejected or not.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judged(shared, batch.column(text))
            rest = batch.drop_columns([text])
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, *columns], names=[*rest.schema.names, "lang_pred", "score", "rejected"]
            )

    fields = [f for f in docs.schema.fields if f.name != text]
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*fields, *added]))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that aren't rejected; columns unchanged."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [not rejected for _, _, rejected in _judged(shared, batch.column(batch.schema.get_field_index(text)))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row belongs to the fold that isn't learned from; a null key does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % folds == 0, F.lit(False))
