"""Toxic passages as maximum-scoring segments over token log-odds.

Tokens are the lower-cased runs of letters and digits. A token's weight is its log-odds
between toxic and clean training texts, with a Dirichlet prior in proportion to its
frequency in all documents, less a drift that makes the expected weight of clean text negative.
A linear scan finds every maximal scoring segment of a text. A segment's score S counts
by its extreme-value statistics: in clean text of n tokens the best score exceeds S with
probability 1 - exp(-K n exp(-lambda S)); lambda solves E[exp(lambda w)] = 1 on clean
tokens and K is fitted to the best scores of clean training texts. The evidence of a text
is the sum of lambda S - ln(K n) over its significant segments, and a logistic
curve fitted on the training texts turns it into a score between 0 and 1.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.llm.shared import rows_where, texts_of, training_sample, written

TOKEN = re.compile(r"[^\W_]+")
Segment = tuple[int, int, float]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]  # tokens that raise the score
    rest: float  # weight of every other token, negative
    rate: float  # lambda
    scale: float  # K
    bias: float
    slope: float

    def segments(self, text: str | None) -> tuple[list[Segment], int]:
        """Maximal scoring segments (first token, last token, score), and the token count."""
        tokens = TOKEN.findall((text or "").lower())
        return maximal_segments(list(map(self.weights.get, tokens)), self.rest), len(tokens)

    def evidence(self, segments: list[Segment], n: int) -> float:
        floor = math.log(max(self.scale * n, 1e-9))
        return sum(max(0.0, self.rate * s - floor) for _, _, s in segments)

    def text_score(self, text: str | None) -> float:
        return self.score(self.evidence(*self.segments(text)))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.bias + self.slope * evidence))))


def maximal_segments(weights: list[float | None], rest: float) -> list[Segment]:
    """All maximal scoring segments of a sequence; None stands for the weight ``rest`` < 0.

    One pass over the tokens with positive weight: each starts as a segment of its own and
    is joined to earlier ones by the rule of prefix sums, in time linear in their number.
    """
    found: list[tuple[int, int, float, float]] = []  # first, last, sum before, sum up to
    for k, (at, w) in enumerate((i, w) for i, w in enumerate(weights) if w is not None):
        before = rest * (at - k) + (found_sum if k else 0.0)
        first, last, low, high = at, at, before, before + w
        found_sum = (found_sum if k else 0.0) + w
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= high:
                break
            first, low = found[j][0], found[j][2]
            del found[j:]
        found.append((first, last, low, high))
    return [(a, b, high - low) for a, b, low, high in found]


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    is_training: Column,
    per_class: int = 12_000,
    max_tokens: int = 50_000,
    prior_share: float = 0.05,
    drift: float = 1.0,
) -> ToxicityModel:
    """Fit the model on at most ``per_class`` labelled training texts of either class.

    That bound also bounds what reaches the driver: ``max_tokens`` weights and one row of
    figures per sampled text. A text counts each of its tokens once, so that a word repeated
    in one text weighs no more than in others. Labels other than 0 and 1 are ignored; without a
    toxic and a clean text every score is the share of toxic ones.
    """
    sample = training_sample(labels, "toxic", is_training, per_class)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    counts = written(
        texts.mapInArrow(_distinct_tokens, "token string, label int")
        .groupBy("token")
        .agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good"))
    )
    bad, good = counts.agg(F.sum("bad"), F.sum("good")).first()
    if not bad or not good:
        share = bad / (bad + good) if bad or good else 0.0
        odds = math.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return ToxicityModel({}, -1.0, 1.0, 1.0, odds, 0.0)
    corpus = written(
        documents.select("text")
        .mapInArrow(_document_counts, "token string, seen long")
        .groupBy("token")
        .agg(F.sum("seen").alias("seen"))
    )
    weight, deviation = _log_odds(bad, good, prior_share, corpus.agg(F.sum("seen")).first()[0])
    strong = (
        counts.join(corpus, "token").select("token", "bad", "good", weight.alias("w"), deviation.alias("sd"))
        .filter((F.col("w") > drift) & (F.col("w") > 3.3 * F.col("sd")))
        .orderBy(F.desc(F.col("w") / F.col("sd")), "token")
        .limit(max_tokens)
        .collect()
    )
    weights = {r.token: r.w - drift for r in strong}
    clean_hits = sum(r.good for r in strong)
    # the weight of all other tokens: what they say together, less the drift
    other = (bad - sum(r.bad for r in strong)) / bad, (good - clean_hits) / good
    rest = min(-0.02, math.log(other[0] / other[1]) - 0.05) if min(other) > 0 else -0.02
    rate = _rate([(w, (r.good + 0.5) / good) for w, r in zip(weights.values(), strong, strict=True)], rest)
    draft = ToxicityModel(weights, rest, rate, 1.0, 0.0, 1.0)
    shared = texts.sparkSession.sparkContext.broadcast(vars(draft))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(**shared.value)
        for batch, values in texts_of(batches, "text"):
            got = [model.segments(t) for t in values]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("label")),
                    pa.array([n for _, n in got], pa.int64()),
                    pa.array([[s for _, _, s in x] for x, _ in got], pa.list_(pa.float64())),
                ],
                names=["label", "n", "scores"],
            )

    rows = texts.mapInArrow(best, "label int, n long, scores array<double>").collect()
    hits = [r for r in rows if r.label == 0 and r.scores]
    tokens = sum(r.n for r in rows if r.label == 0) or 1
    # moment estimate of K: with scores S of clean text, sum exp(lambda S) segments expected as K n
    scale = max(sum(math.exp(min(50.0, rate * min(max(r.scores), 2.0))) for r in hits) / tokens, 1 / tokens)
    fitted = ToxicityModel(weights, rest, rate, scale, 0.0, 1.0)
    x = np.array([fitted.evidence([(0, 0, s) for s in r.scores], r.n) for r in rows])
    y = np.array([r.label for r in rows], float)
    bias, slope = _logistic(x, y)
    return ToxicityModel(weights, rest, rate, scale, bias, slope)


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in texts_of(batches, "text"):
        labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
        for lo in range(0, len(texts), 500):
            tokens, marks = [], []
            for text, label in zip(texts[lo : lo + 500], labels[lo : lo + 500], strict=True):
                own = set(TOKEN.findall((text or "").lower()))
                tokens.extend(own)
                marks.extend([label] * len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.string()), pa.array(marks, pa.int32())], names=["token", "label"]
            )


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, texts that hold it), summed over some texts before the shuffle."""

    def flushed() -> pa.RecordBatch:
        tokens, seen = list(counter), list(counter.values())
        counter.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(tokens, pa.string()), pa.array(seen, pa.int64())], names=["token", "seen"]
        )

    counter: Counter[str] = Counter()
    for _, texts in texts_of(batches, "text"):
        for text in texts:
            counter.update(set(TOKEN.findall((text or "").lower())))
            if len(counter) > 200_000:
                yield flushed()
    yield flushed()


def _log_odds(bad: int, good: int, prior_share: float, all_seen: int) -> tuple[Column, Column]:
    """Log-odds under a Dirichlet prior of the frequencies in all documents, and its deviation.

    ``seen`` of ``all_seen`` is a token's frequency; the prior weighs as much as
    ``prior_share`` of the tokens counted in the sample.
    """
    prior = prior_share * (bad + good)
    expected = F.col("seen") / all_seen * prior
    x, y = F.col("bad") + expected, F.col("good") + expected
    weight = F.log(x / (bad + prior - x)) - F.log(y / (good + prior - y))
    return weight, F.sqrt(1 / x + 1 / y)


def _rate(weighted: list[tuple[float, float]], rest: float) -> float:
    """lambda > 0 with sum of p exp(lambda w) = 1 over the tokens of clean text."""
    left = max(1e-9, 1 - sum(p for _, p in weighted))

    def over(rate: float) -> bool:
        total = left * math.exp(rate * rest)
        return total + sum(p * math.exp(min(500.0, rate * w)) for w, p in weighted) > 1

    low, high = 1e-6, 1.0
    while not over(high) and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if over(mid) else (mid, high)
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton steps with a small ridge, which keeps separable data finite."""
    scale = max(float(x.mean()), 1e-9)
    a = np.stack([np.ones_like(x), x / scale], 1)
    b, ridge = np.zeros(2), np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ b, -50, 50)))
        hess = a.T @ (a * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hess, a.T @ (y - p) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(max(b[1], 0.0) / scale)


def toxicity(
    documents: DataFrame,
    model: ToxicityModel,
    *,
    threshold: float = 0.7,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: doc_id, score, predicted, n_segments, segments.

    segments lists every significant passage as (first token, last token, score).
    Null, empty and token-free texts have no segment and get the lowest score.
    Ids may be null or repeat; other columns are ignored.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ToxicityModel(**shared.value)
        for batch, texts in texts_of(batches, "text"):
            scores, passages = [], []
            for text in texts:
                segments, n = model.segments(text)
                floor = math.log(max(model.scale * n, 1e-9))
                scores.append(model.score(model.evidence(segments, n)))
                passages.append(
                    [dict(zip(("first", "last", "score"), s)) for s in segments if model.rate * s[2] > floor]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array(list(map(len, passages)), pa.int32()),
                    pa.array(passages, pa.list_(passage)),
                ],
                names=["doc_id", "score", "predicted", "n_segments", "segments"],
            )

    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(
        run,
        "doc_id long, score double, predicted int, n_segments int,"
        " segments array<struct<first: int, last: int, score: double>>",
    )


def without_toxic(
    documents: DataFrame, model: ToxicityModel, *, threshold: float = 0.7, text_column: str = "text"
) -> DataFrame:
    """Rows whose text scores below the threshold, with all their columns."""
    shared = documents.sparkSession.sparkContext.broadcast(vars(model))

    def clean(texts: list) -> list[bool]:
        model = ToxicityModel(**shared.value)
        return [model.text_score(t) < threshold for t in texts]

    return rows_where(documents, text_column, clean)
