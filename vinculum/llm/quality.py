"""Quality classifier by compression.

Two zstandard dictionaries are built from labelled good and bad text.  Every text is cut into
pieces of `piece_bytes` and compressed whole with either dictionary; the score is a logistic
function of the normalised size difference (bad - good) / (bad + good) and of the logarithm of
the compressed share good / length, which separates text that only repeats itself.

The logistic function is fitted on cross-fitted features: of `folds` parts of the sample, each
is measured with dictionaries built from the others; the final dictionaries use all parts.

Only labels of rows whose crc32(doc_id as text) mod 5 is not 0 are learned from.  The fit uses
bounded samples (`dictionary_rows` per class, `calibration_rows` in all, the rows with the
smallest hash of their id, each with the smallest text of its doc_id, whole); sizes and scores
are computed over every row and whole text.

Defined results: an empty table gives an empty result; very long texts are measured whole, piece
by piece; repeated rows are scored each for itself; extra columns, whatever their names, pass
through and are no input; null and empty texts are scored like any other text (no pieces but an empty
one); rows without a label are scored all the same; a null doc_id counts as held out; if the
learnable labels lack a class, every score is the smoothed share of label 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vinculum.llm.common import fresh, over_batches, worker


@dataclass(frozen=True)
class Params:
    dictionary_rows: int = 1000
    calibration_rows: int = 6000
    dictionary_bytes: int = 112_640
    piece_bytes: int = 4096
    level: int = 3
    folds: int = 3
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    params: Params
    good: bytes = b""
    bad: bytes = b""
    #: Intercept and one weight per feature, on standardised features.
    weights: tuple[float, ...] = ()
    means: tuple[float, ...] = ()
    scales: tuple[float, ...] = ()
    base_rate: float = 0.5
    counts: dict[int, int] = field(default_factory=dict)


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("long").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _pieces(text: bytes, size: int) -> list[bytes]:
    return [text[i : i + size] for i in range(0, len(text), size)] or [b""]


class Sizes:
    """Compressed sizes of texts under the two dictionaries of a model."""

    def __init__(self, model: Model):
        import zstandard

        self.piece = model.params.piece_bytes
        settings = zstandard.ZstdCompressionParameters.from_level(
            model.params.level, write_content_size=0, write_checksum=0, write_dict_id=0, format=zstandard.FORMAT_ZSTD1_MAGICLESS
        )
        self.pair = []
        for data in (model.good, model.bad):
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(compression_params=settings)
            self.pair.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings))

    def features(self, text: bytes) -> tuple[float, float]:
        good = bad = 0
        for i in range(0, max(1, len(text)), self.piece):
            piece = text[i : i + self.piece]
            good += len(self.pair[0].compress(piece))
            bad += len(self.pair[1].compress(piece))
        return (bad - good) / (bad + good + 16), math.log((good + 4) / (len(text) + 16))


def _dictionary(samples: list[bytes], size: int) -> bytes:
    import zstandard

    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, k=128, d=8, level=3).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself
        return b"".join(samples)[:size]


@worker("quality")
def _sampled(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, folds, texts = [], [], []
        for quality, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            pieces = _pieces((text.as_py() or "").encode(), p.piece_bytes)
            texts += pieces
            labels += [quality] * len(pieces)
            folds += [fold] * len(pieces)
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array(folds, pa.int32()), pa.array(texts, pa.binary())], names=["quality", "fold", "piece"])


@worker("quality")
def _fold_features(batches: Iterator[pa.RecordBatch], models: list[Model]) -> Iterator[pa.RecordBatch]:
    """Features of labelled texts, each under the model of its fold."""
    sizes = [Sizes(m) for m in models]
    for batch in batches:
        found = [sizes[fold].features((text.as_py() or "").encode()) for fold, text in zip(batch.column(1).to_pylist(), batch.column(2))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64())],
            names=["quality", "difference", "share"],
        )


@worker("quality")
def _features(batches: Iterator[pa.RecordBatch], model: Model, names: tuple[str, str] = ("difference", "share")) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, the text, by the two features."""
    sizes = Sizes(model)
    for batch in batches:
        found = [sizes.features(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch.column(batch.num_columns - 1).cast(pa.large_binary())]
        rest = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array([x for x, _ in found], pa.float64()), pa.array([y for _, y in found], pa.float64())],
            names=[*batch.schema.names[:-1], *names],
        )


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    means, scales = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([np.ones(len(x)), (x - means) / scales])
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p) + 1e-9)[:, None]) + 1e-2 * np.eye(len(w)), a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, means, scales


def learn(docs: DataFrame, labels: DataFrame, params: Params = Params()) -> Model:
    """A model from bounded samples of the learnable labels and their documents."""
    p = params
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter("doc_id is not null and quality in (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .withColumn("h", F.xxhash64("doc_id"))
        .withColumn("fold", F.pmod("h", F.lit(p.folds)).cast("int"))
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def chosen(rows: DataFrame, n: int) -> DataFrame:  # at most n rows of three numbers
        return rows.orderBy("h", "doc_id", "quality").limit(n).select("doc_id", "quality", "fold")

    def one_text(rows: DataFrame) -> DataFrame:  # a doc_id that many documents share counts once
        return texts.join(F.broadcast(rows.select("doc_id").distinct()), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))

    for_words = chosen(known.filter("quality = 1"), p.dictionary_rows).unionByName(chosen(known.filter("quality = 0"), p.dictionary_rows))
    pieces = over_batches(one_text(for_words).join(F.broadcast(for_words), "doc_id").select("quality", "fold", "text"), partial(_sampled, p=p), "quality int, fold int, piece binary")
    collected = sorted((r["quality"], r["fold"], bytes(r["piece"])) for r in pieces.collect())
    total = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    rate = (total.get(1, 0) + 1) / (sum(total.values()) + 2)
    plain = Model(p, base_rate=rate, counts=total)

    def built(without: int | None) -> Model | None:
        of = {q: [x for quality, fold, x in collected if quality == q and fold != without and x] for q in (0, 1)}
        if not of[0] or not of[1]:
            return None
        return Model(p, _dictionary(of[1], p.dictionary_bytes), _dictionary(of[0], p.dictionary_bytes), base_rate=rate, counts=total)

    draft, parts = built(None), [built(f) for f in range(p.folds)]
    if draft is None or None in parts:
        return plain
    for_fit = chosen(known, p.calibration_rows)
    sample = one_text(for_fit).join(F.broadcast(for_fit), "doc_id").select("quality", "fold", "text")
    sample = over_batches(sample, partial(_fold_features, models=parts), "quality int, difference double, share double")
    rows = sorted((r["quality"], r["difference"], r["share"]) for r in sample.collect())
    y = np.array([r[0] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return plain
    w, means, scales = _logistic(np.array([r[1:] for r in rows]), y)
    return Model(p, draft.good, draft.bad, tuple(w.tolist()), tuple(means.tolist()), tuple(scales.tolist()), rate, total)


def probability(model: Model, features: list[Column]) -> Column:
    if not model.weights:
        return F.lit(model.base_rate)
    z = F.lit(model.weights[0])
    for w, m, s, x in zip(model.weights[1:], model.means, model.scales, features):
        z = z + F.lit(w) * (x - F.lit(m)) / F.lit(s)
    return 1 / (1 + F.exp(-z))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """`docs` with its quality score (0 to 1) as one more column."""
    if not model.weights:
        return docs.withColumn(name, F.lit(model.base_rate))
    difference, share = fresh(docs, "difference"), fresh(docs, "share")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    rows = docs.select("*", F.col("text").cast("string").alias(fresh(docs, "_text")))
    found = over_batches(rows, partial(_features, model=model, names=(difference, share)), f"{ddl}, `{difference}` double, `{share}` double")
    return found.withColumn(name, probability(model, [F.col(difference), F.col(share)])).drop(difference, share)


def predicted(model: Model, score: Column) -> Column:
    return F.when(score >= model.params.threshold, 1).otherwise(0).cast("int")


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of `docs` from the threshold on, with their columns."""
    name = fresh(docs, "_score")
    return with_score(docs, model, name).filter(predicted(model, F.col(name)) == 1).drop(name)
