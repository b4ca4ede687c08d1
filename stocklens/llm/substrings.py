"""Removal of repeated word windows, found through anchors at the positions of a difference cover.

A window is ``span`` consecutive words of one document. A window whose word sequence also
starts anywhere else (the same document included) is repeated, and every word it covers
goes. Hashing every window of every document would key as many rows as there are words.
Instead, anchors are hashed only at positions whose remainder modulo ``period`` lies in a
difference cover D (every remainder is a difference of two members of D): an anchor is the
``span - period + 1`` words from such a position. Two equal windows starting at p and q
hold, at one common offset h < period, the anchors p+h and q+h (their remainders differ by
q - p, which D covers), and these anchors are equal. So only windows that hold a repeated
anchor at some offset below ``period`` can be repeated; those windows alone are hashed
whole and counted, which decides exactly. Anchors only choose where to look, so a 32-bit
anchor hash suffices (a collision costs a few more windows, never a result); windows are
keyed by 96 bits of a 128-bit hash of their 128-bit word hashes.

Spark does the counting: anchors go through one exchange by hash and a sorted stream keeps
those whose hash comes twice or more; windows near a repeated anchor do the same by their
96-bit key. The verdicts reach the texts by joins on a row key, so that each row is judged
by itself, repeated rows and ids too. Tasks see one document at a time; no group is gathered
in one place, though the rows of one hash are streamed by one task.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def difference_cover(period: int) -> tuple[int, ...]:
    """A smallest set D of remainders modulo ``period`` whose differences give every remainder."""
    for size in range(1, period + 1):
        for rest in itertools.combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return cover
    return tuple(range(period))


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _word_bytes(words: list[str]) -> bytes:
    return b"".join(xxhash.xxh3_128_digest(w.encode("utf-8")) for w in words)


def _anchors(span: int, period: int, cover: tuple[int, ...]):
    width = span - period + 1
    members = set(cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rk, pos, kg = [], [], []
            for key, text in zip(keys, texts):
                words = words_of(text)
                if len(words) < span:
                    continue
                b = _word_bytes(words)
                for a in range(len(words) - width + 1):
                    if a % period in members:
                        rk.append(key)
                        pos.append(a)
                        kg.append(xxhash.xxh32_intdigest(b[16 * a : 16 * (a + width)]) - (1 << 31))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rk, pa.int64()), pa.array(pos, pa.int32()), pa.array(kg, pa.int32())], ["rk", "pos", "kg"]
            )

    return run


def _windows(span: int, period: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            keys = batch.column(names.index("rk")).to_pylist()
            texts = batch.column(names.index("text")).to_pylist()
            anchors = batch.column(names.index("anchors")).to_pylist()
            rk, start, w1, w2 = [], [], [], []
            for key, text, found in zip(keys, texts, anchors):
                words = words_of(text)
                last = len(words) - span
                b = _word_bytes(words)
                starts = sorted({p for a in found for p in range(max(0, a - period + 1), min(a, last) + 1)})
                for p in starts:
                    h = xxhash.xxh3_128_intdigest(b[16 * p : 16 * (p + span)])
                    rk.append(key)
                    start.append(p)
                    w1.append(_signed(h >> 64))
                    w2.append((h & 0xFFFFFFFF) - (1 << 31))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rk, pa.int64()), pa.array(start, pa.int32()), pa.array(w1, pa.int64()),
                 pa.array(w2, pa.int32())],
                ["rk", "p", "w1", "w2"],
            )

    return run


def kept_words(words: list[str], starts: list[int], span: int) -> tuple[list[str], int]:
    """The words no window of ``starts`` covers, and how many were covered."""
    covered = [False] * len(words)
    reach = -1
    for p in sorted(starts):
        for i in range(max(p, reach), min(p + span, len(words))):
            covered[i] = True
        reach = max(reach, p + span)
    return [w for w, c in zip(words, covered) if not c], sum(covered)


def _verdicts(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = batch.column(names.index("text")).to_pylist()
            starts = batch.column(names.index("starts")).to_pylist()
            n_words, n_removed, digest = [], [], []
            for text, found in zip(texts, starts):
                words = words_of(text)
                kept, removed = kept_words(words, found or [], span)
                n_words.append(len(words))
                n_removed.append(removed)
                digest.append(hashlib.sha256(" ".join(kept).encode("utf-8")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(names.index("doc_id")), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    return run


def _runs_of_two(keys: list[str]):
    """mapInArrow function over rows sorted by ``keys``: the rows whose key run has two rows or more.

    Streams: besides the batch, only the one row of a run not yet known to repeat is held.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, pending, run_length = None, None, 0
        for batch in batches:
            n = len(batch)
            if n == 0:
                continue
            cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            same = np.zeros(n, bool)
            same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in cols])
            first = tuple(c[0] for c in cols)
            same[0] = last_key is not None and first == last_key
            run_id = np.cumsum(~same)                       # 1, 2, ... ; the first run may continue one
            lengths = np.bincount(run_id)
            total = lengths[run_id].copy()
            if same[0]:
                total[run_id == run_id[0]] += run_length
            keep = total >= 2
            if same[0] and pending is not None and keep[0]:
                yield pending
            pending = None
            end = run_id == run_id[-1]
            if not keep[-1]:                                 # a run of one at the end: wait for the next batch
                pending = batch.slice(n - 1, 1)
                keep &= ~end
            run_length = int(total[-1])
            last_key = tuple(c[-1] for c in cols)
            if keep.any():
                yield batch.filter(pa.array(keep))

    return run


def occurring_twice(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``rows`` whose key occurs in at least two rows: one exchange by key, then a sorted stream.

    A key held by a large share of all rows is streamed by one task without being gathered.
    """
    spread = rows.repartition(*keys).sortWithinPartitions(*keys)
    return spread.mapInArrow(_runs_of_two(keys), rows.schema)


def repeated_windows(documents: DataFrame, span: int = 35, period: int = 21) -> DataFrame:
    """Words of ``documents`` (doc_id, text) left after removing every repeated ``span``-word window.

    Words are maximal runs of characters other than space, tab, newline, vertical tab, form
    feed and carriage return, taken unchanged. One row per input row, repeated rows each
    (two equal rows of at least ``span`` words remove each other's words): doc_id (null
    stays null), n_words, n_removed, kept_sha256 (sha256 of the kept words joined by one
    space, UTF-8). Null and empty texts have no words: 0, 0 and the hash of the empty string.
    Texts shorter than ``span`` words have no window and keep everything. Windows are judged
    on the input, not on what is left. Equal 96-bit window hashes (of 128-bit word hashes)
    count as equal windows. Extra columns of ``documents`` are not carried. ``period`` must not be
    above ``span``.
    """
    if not 0 < period <= span:
        raise ValueError("period must be between 1 and span")
    cover = difference_cover(period)
    docs = documents.select("doc_id", "text").withColumn("rk", F.monotonically_increasing_id())
    anchors = docs.select("rk", "text").mapInArrow(_anchors(span, period, cover), "rk long, pos int, kg int")
    candidates = occurring_twice(anchors, ["kg"]).groupBy("rk").agg(F.collect_set("pos").alias("anchors"))
    windows = docs.join(candidates, "rk").mapInArrow(_windows(span, period), "rk long, p int, w1 long, w2 int")
    starts = (
        occurring_twice(windows, ["w1", "w2"])
        .groupBy("rk").agg(F.sort_array(F.collect_list("p")).alias("starts"))
    )
    return docs.join(starts, "rk", "left").mapInArrow(
        _verdicts(span), "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def brute_force(texts: list[str | None], span: int = 35) -> list[tuple[int, int, str]]:
    """Every window of every text hashed and counted: (n_words, n_removed, kept_sha256) per text."""
    split = [words_of(t) for t in texts]
    seen: dict[tuple, int] = {}
    for words in split:
        for p in range(len(words) - span + 1):
            w = tuple(words[p : p + span])
            seen[w] = seen.get(w, 0) + 1
    out = []
    for words in split:
        starts = [p for p in range(len(words) - span + 1) if seen[tuple(words[p : p + span])] >= 2]
        kept, removed = kept_words(words, starts, span)
        out.append((len(words), removed, hashlib.sha256(" ".join(kept).encode("utf-8")).hexdigest()))
    return out
