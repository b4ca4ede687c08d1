"""Document quality by supervised subword embeddings.

A text is the average of learned vectors of its hashed features: words, pairs of equal
neighbouring words, and byte 3-grams and 4-grams; a softmax over the average gives the class. The
vectors and the output layer are trained together by stochastic gradient descent in numpy
on a bounded sample of labelled texts. Because the output is linear in the average, scoring
needs one number per feature: its vector times the output layer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.shared import rows_where, texts_of, training_sample
from stocklens.llm.shingles import SEPARATOR, word_hashes

BITS = 17
CHUNK = 1 << 18  # bytes hashed at a time


@dataclass(frozen=True)
class QualityModel:
    logits: np.ndarray  # per feature, log-odds of label 1
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            total, n = 0.0, 0
            for ids in features(text):
                total += float(self.logits[ids].sum(dtype=np.float64))
                n += len(ids)
            out[k] = self.bias + (total / n if n else 0.0)
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def features(text: str | None) -> Iterator[np.ndarray]:
    """Feature numbers of a whole text, in pieces that end between words."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    lo = 0
    while lo < len(data):
        hi = min(len(data), lo + CHUNK)
        if hi < len(data):  # cut after a separator where there is one
            cut = np.flatnonzero(SEPARATOR[data[lo:hi]])
            hi = lo + int(cut[-1]) + 1 if len(cut) else hi
        yield _features(data[lo:hi])
        lo = hi


def _features(data: np.ndarray) -> np.ndarray:
    shift = np.uint32(32 - BITS)
    _, words = word_hashes(data)
    short = (words >> np.uint64(32)).astype(np.uint32)
    same = np.flatnonzero(words[1:] == words[:-1])
    parts = [short >> shift, np.full(len(same), 1, np.uint32)]
    wide = data.astype(np.uint32)
    rolled = wide * np.uint32(0x9E3779B1)
    for n in (2, 3, 4):
        if len(wide) < n:
            break
        rolled = (rolled[:-1] ^ (rolled[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA77)
        rolled = rolled + wide[n - 1 :] * np.uint32(0xC2B2AE3D)
        if n > 2:
            mixed = rolled ^ (rolled >> np.uint32(13))
            parts.append((mixed * np.uint32(0x27D4EB2F) + np.uint32(n)) >> shift)
    return np.concatenate(parts)


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    *,
    is_training: Column,
    per_class: int = 2_000,
    dims: int = 4,
    updates: int = 750,
    rate: float = 60.0,
    batch: int = 64,
    seed: int = 3,
) -> QualityModel:
    """Train on at most ``per_class`` labelled training texts of either class.

    The sample is the only data that reaches the driver: per text its distinct features and
    their counts. Classes weigh as in the sample's population: each class as its share of
    all training labels. Without both classes every score is the share of label 1.
    """
    shares = {
        r.quality: r["count"]
        for r in labels.filter(F.col("quality").isin(0, 1) & is_training).groupBy("quality").count().collect()
    }
    if len(shares) < 2:
        p = 0.5 if not shares else (0.999 if 1 in shares else 0.001)
        return QualityModel(np.zeros(1 << BITS, np.float32), float(np.log(p / (1 - p))))
    sample = training_sample(labels, "quality", is_training, per_class)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(batches, "text"):
            ids, shares = [], []
            for text in texts:
                pieces = [np.empty(0, np.uint32), *features(text)]
                own, n = np.unique(np.concatenate(pieces), return_counts=True)
                ids.append(own.astype(np.int32).tobytes())
                shares.append((n / max(n.sum(), 1)).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(batch.schema.get_field_index("label")),
                    pa.array(ids, pa.binary()),
                    pa.array(shares, pa.binary()),
                ],
                names=["doc_id", "label", "ids", "shares"],
            )

    rows = (
        documents.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")
        .mapInArrow(count, "doc_id long, label int, ids binary, shares binary")
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, bytes(r.ids)))
    labels_ = np.array([r.label for r in rows])
    seen = {c: max(1, int((labels_ == c).sum())) for c in (0, 1)}
    total = sum(shares.values())
    weight = np.array([shares[c] / total / seen[c] * len(rows) for c in (0, 1)])[labels_]
    ids = [np.frombuffer(r.ids, np.int32) for r in rows]
    parts = [np.frombuffer(r.shares, np.float32) for r in rows]

    random = np.random.RandomState(seed)
    vectors = random.uniform(-1 / dims, 1 / dims, (dims, 1 << BITS)).astype(np.float32)
    output, bias = np.zeros((dims, 2), np.float32), np.zeros(2, np.float32)
    done = 0
    while done < updates:
        order = random.permutation(len(rows))
        for lo in range(0, len(rows), batch):
            pick = order[lo : lo + batch]
            own = np.concatenate([ids[k] for k in pick])
            share = np.concatenate([parts[k] for k in pick])
            doc = np.repeat(np.arange(len(pick)), [len(ids[k]) for k in pick])
            hidden = np.stack(
                [np.bincount(doc, share * vectors[d][own], len(pick)) for d in range(dims)], 1
            ).astype(np.float32)
            z = hidden @ output + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels_[pick]] -= 1
            slope = p * weight[pick][:, None].astype(np.float32) / len(pick)
            pace = rate * max(0.0, 1 - done / updates)
            back = pace * (slope @ output.T)
            output -= 0.02 * pace * (hidden.T @ slope)
            bias -= 0.02 * pace * slope.sum(0)
            for d in range(dims):
                np.subtract.at(vectors[d], own, back[doc, d] * share)
            done += 1
    return QualityModel((output[:, 1] - output[:, 0]) @ vectors, float(bias[1] - bias[0]))


def quality(
    documents: DataFrame,
    model: QualityModel,
    *,
    threshold: float = 0.3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: doc_id, score of label 1, predicted.

    Null and empty texts have no features and get the score of the bias alone.
    Ids may be null or repeat; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(**shared.value)
        for batch, texts in texts_of(batches, "text"):
            scores = model.scores(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(run, "doc_id long, score double, predicted int")


def of_quality(
    documents: DataFrame, model: QualityModel, *, threshold: float = 0.3, text_column: str = "text"
) -> DataFrame:
    """Rows whose text reaches the threshold, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))
    return rows_where(
        documents, text_column, lambda texts: QualityModel(**shared.value).scores(texts) >= threshold
    )
