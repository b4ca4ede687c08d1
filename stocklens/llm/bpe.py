"""Byte-level BPE encoding by backtracking from longest matches, and decoding.

The bytes of a piece are read as Latin-1 characters, so that one Aho-Corasick pass over the
vocabulary finds every token at every place. From the left the longest token is taken that is
compatible with the one before it: two tokens are compatible when merging their bytes by rank
gives just them, which is kept for each pair once known. Where no token fits, the last one
gives way to a shorter one. The encoding of a prefix is unique, so an end that failed once is never tried
again and the time is linear in the piece. A sequence whose neighbours are all compatible is
the result of the merges.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_CUT = re.compile(r"(?<=\S) (?=\S)")

from stocklens.llm.shared import texts_of

CACHED_CHUNKS = 1_000_000
CACHED_PAIRS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.found = ahocorasick.Automaton()
        for token in ranks:
            if len(token) > 1:  # single bytes match everywhere
                self.found.add_word(token.decode("latin-1"), len(token))
        self.found.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.spines: dict[bytes, tuple[list[int], list[int]]] = {}
        self.chunks: dict[str, bytes] = {}
        ordered = [self.tokens.get(k, b"") for k in range(max(self.tokens, default=0) + 1)]
        self.lengths = np.array([len(t) for t in ordered], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(ordered), np.uint8)

    def spine(self, token: bytes) -> tuple[list[int], list[int]]:
        """The ranks of the parts along a token's left and its right edge, from byte to whole."""
        known = self.spines.get(token)
        if known is None:
            own = self.ranks[token]
            if len(token) == 1:
                known = [own], [own]
            else:  # its last merge: the halves that merging leaves
                parts = [token[i : i + 1] for i in range(len(token))]
                while len(parts) > 2:
                    _, at = min(
                        (self.ranks.get(parts[i] + parts[i + 1], sys.maxsize), i)
                        for i in range(len(parts) - 1)
                    )
                    parts[at : at + 2] = [parts[at] + parts[at + 1]]
                known = [*self.spine(parts[0])[0], own], [*self.spine(parts[1])[1], own]
            self.spines[token] = known
        return known

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both tokens leaves just them.

        Both grow along their facing edges in the order of ranks; they are not if a merge
        across comes first. Of equal ranks the leftmost is merged first.
        """
        left, right = self.spine(self.tokens[a])[1], self.spine(self.tokens[b])[0]
        i = j = 0
        while True:
            grow_left = left[i + 1] if i + 1 < len(left) else sys.maxsize
            grow_right = right[j + 1] if j + 1 < len(right) else sys.maxsize
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], sys.maxsize)
            if across < grow_left and across <= grow_right and across < sys.maxsize:
                return False
            if grow_left == grow_right == sys.maxsize:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def encode_piece(self, data: bytes) -> list[int]:
        ranks, pairs = self.ranks, self.pairs
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        lengths: list[list[int] | None] = [None] * n
        for end, length in self.found.iter(data.decode("latin-1")):
            at = end - length + 1
            if lengths[at] is None:
                lengths[at] = [1, length]
            else:
                lengths[at].append(length)  # rising, as ends rise
        dead = bytearray(n + 1)
        ids: list[int] = []
        back: list[tuple[int, int]] = []
        at, k = 0, -2
        while at < n:
            own = lengths[at] or (1,)
            if k == -2:
                k = len(own) - 1
            while k >= 0:
                end = at + own[k]
                if not dead[end]:
                    token = ranks[data[at:end]]
                    if not ids:
                        break
                    pair = ids[-1] << 32 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= CACHED_PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(ids[-1], token)
                    if fits:
                        break
                k -= 1
            if k >= 0:
                back.append((at, k))
                ids.append(token)
                at, k = end, -2
            else:
                dead[at] = 1
                at, k = back.pop()
                ids.pop()
                k -= 1
        return ids

    def encode_chunk(self, text: str) -> bytes:
        own = array("I")
        for piece in self.split(text):
            own.extend(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
        if sys.byteorder == "big":
            own.byteswap()
        return own.tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers.

        A space with something other than white space on both sides belongs to the piece
        that follows and no piece reaches across it; the text is cut only at such spaces, and
        what follows one is looked up as a whole. Runs of white space are never cut.
        """
        first, *rest = SPACE_CUT.split(text)
        known = self.chunks
        packed = list(map(known.get, rest))
        if None in packed:
            for k, ids in enumerate(packed):
                if ids is None:
                    chunk = rest[k]
                    ids = packed[k] = known.get(chunk) or self.encode_chunk(" " + chunk)
                    if len(chunk) <= 48:
                        if len(known) >= CACHED_CHUNKS:
                            known.clear()
                        known[chunk] = ids
        return self.encode_chunk(first) + b"".join(packed)

    def decode(self, ids: bytes) -> bytes:
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes()


def encoder_of(vocabulary: dict[bytes, int], pattern: str, key: str) -> Encoder:
    """The process's encoder of a vocabulary: later tasks of a worker find its memo filled."""
    kept = vars(sys).setdefault("_stocklens_encoders", {})
    if key not in kept:
        kept[key] = Encoder(vocabulary, pattern)
    return kept[key]


def encoded(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    with_ids: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids).

    The whole text is cut by ``pattern`` and each piece encoded on its own, without special
    tokens; the ids are decoded again. ids_sha256 is of the little-endian unsigned
    32-bit ids, decoded_sha256 of the decoded bytes. Null texts count as empty: no tokens. Ids may be null
    or repeat; other columns are ignored. ``with_ids`` adds the ids as an array.
    The vocabulary is read on the driver and broadcast; its file has a fixed size.
    """
    ranks = read_ranks(ranks_path)
    key = hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    shared = documents.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(shared.value, pattern, key)
        for batch, texts in texts_of(batches, "text"):
            rows: list[list] = [[], [], [], []]
            for text in texts:
                ids = encoder.encode(text or "")
                rows[0].append(len(ids) // 4)
                rows[1].append(hashlib.sha256(ids).hexdigest())
                rows[2].append(hashlib.sha256(encoder.decode(ids)).hexdigest())
                if with_ids:
                    rows[3].append(array("I", ids).tolist())
            columns = [
                batch.column(0),
                pa.array(rows[0], pa.int64()),
                pa.array(rows[1], pa.string()),
                pa.array(rows[2], pa.string()),
            ]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(rows[3], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(
        run,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
        + ", ids array<long>" * with_ids,
    )
