"""Operator 3: byte-level BPE encoding and decoding by corpus-level merge replay.

Each task takes its documents in blocks.  The distinct pre-tokens of a block
that the worker has not met yet are laid end to end, an inverted index maps
every merge to the positions where its pair of tokens stands, and the merges
are replayed in rank order over all words at once; a merge looks only at the
two neighbours of each position it touches.  Documents are then put together
from the encoded words, so each distinct word is merged once per block however
often it occurs, and a worker's memory is bounded by a block and a word cache.

Nothing is shuffled: a document is encoded where it is read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents of one replay block, and words that each of the two generations of
#: a worker's word cache holds; a word met again moves to the younger one.
BLOCK_DOCS = 512
#: Bytes of a block of several documents, so that very long texts come in smaller blocks.
BLOCK_BYTES = 32 << 20
CACHE_WORDS = 300_000


class Replay:
    """Merges of one rank table, replayed over many words together."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        first = [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.first_pairs = np.array(first, dtype=np.int64)
        self.pairs: dict[int, int] = {}
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, left: int, right: int) -> int:
        """Token that the pair makes, or -1."""
        key = left << 24 | right
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            found = self.pairs[key] = self.ranks.get(self.bytes_of[left] + self.bytes_of[right], -1)
        return found

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) word as little-endian unsigned 32-bit integers."""
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.cumsum(lengths + 1) - lengths  # one separator before each word, one at the end
        size = int(lengths.sum()) + len(words) + 1
        tokens = np.full(size, -1, dtype=np.int64)
        inside = np.ones(size, dtype=bool)
        inside[np.append(starts - 1, size - 1)] = False
        tokens[inside] = self.byte_id[flat]
        # the inverted index: merge -> positions, by its left token, ascending
        raw = np.zeros(size, dtype=np.int64)
        raw[inside] = flat
        made = np.where(inside[:-1] & inside[1:], self.first_pairs[raw[:-1], raw[1:]], -1)
        at = np.flatnonzero(made >= 0)
        at = at[np.argsort(made[at], kind="stable")]
        kinds = made[at]
        first = np.flatnonzero(np.diff(kinds, prepend=-1)).tolist()
        places = at.tolist()
        index = {int(kinds[a]): places[a:b] for a, b in pairwise([*first, len(places)])}
        heap = list(index)
        heapq.heapify(heap)
        token = tokens.tolist()
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        merged, known, push = self.merged, self.pairs.get, heapq.heappush
        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            places.sort()
            for k, p in enumerate(places):
                left = token[p]
                q = after[p]
                right = token[q]
                if left < 0 or right < 0 or known(left << 24 | right, -1) != rank and merged(left, right) != rank:
                    continue  # a neighbour has changed since
                token[p], token[q] = rank, -2
                n = after[p] = after[q]
                before[n] = p
                o = before[p]
                lowest = rank
                x = token[o]
                if x >= 0:
                    y = known(x << 24 | rank)
                    x = merged(x, rank) if y is None else y
                if x >= 0:
                    if x in index:
                        index[x].append(o)
                    else:
                        index[x] = [o]
                        push(heap, x)
                    lowest = x
                x = token[n]
                if x >= 0:
                    y = known(rank << 24 | x)
                    x = merged(rank, x) if y is None else y
                if x >= 0:
                    if x in index:
                        index[x].append(p)
                    else:
                        index[x] = [p]
                        push(heap, x)
                    if x < lowest:
                        lowest = x
                if lowest < rank and k + 1 < len(places):  # that merge comes before the rest of these
                    if rank not in index:
                        push(heap, rank)
                    index.setdefault(rank, []).extend(places[k + 1 :])
                    break
        out = np.array(token, dtype=np.int64)
        out = out[out != -2]
        ends = np.flatnonzero(out == -1)
        packed = out.astype("<u4").tobytes()
        return [packed[4 * a + 4 : 4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def learn(self, words: set[str]) -> None:
        """Make sure that the cache holds these words."""
        new = words.difference(self.cache)
        if not new:
            return
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.older, self.cache, new = self.cache, {}, words
        old = self.older
        todo = []
        for word in new:
            if word in old:
                self.cache[word] = old[word]
                continue
            raw = word.encode()
            whole = self.ranks.get(raw)
            if whole is None:
                todo.append((word, raw))
            else:
                self.cache[word] = whole.to_bytes(4, "little")
        if todo:
            self.cache.update(zip([w for w, _ in todo], self.encode_words([r for _, r in todo]), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; one block of documents."""
        split = [self.find(t or "") for t in texts]
        self.learn(set().union(*split))
        of = self.cache.__getitem__
        return [b"".join(map(of, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def replay(path: str, pattern: str) -> Replay:
    """The worker's replay of a rank file, read once per worker process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Replay(ranks, pattern)


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_DOCS) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of at most ``size`` rows and, of several rows, ``BLOCK_BYTES``."""
    for batch in batches:
        todo = [batch.slice(start, size) for start in range(0, batch.num_rows, size)][::-1]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > BLOCK_BYTES:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True
) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns per row of ``docs``: ``id_col``, n_tokens (long), ids (array<int>,
    null when ``with_ids`` is false), ids_sha256 (of the ids as little-endian
    unsigned 32-bit integers) and decoded_sha256 (of the bytes that the ids
    decode to), both lower-case hex.  A null text is encoded as an empty one
    (no ids); repeated rows are encoded each for itself; an empty table gives
    an empty result; other columns of ``docs`` are not read."""
    kind = pa.list_(pa.int32())

    def run(batches):
        coder = replay(path, pattern)
        for block in blocks(batches):
            coded = coder.encode(block.column(1).to_pylist())
            arrays = [np.frombuffer(c, dtype="<i4") if with_ids else None for c in coded]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array(arrays, kind),
                    pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    pa.array([hashlib.sha256(coder.decode(c)).hexdigest() for c in coded]),
                ],
                names=["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(ids: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and decoded (binary) for every row of token ids; null ids: empty."""

    def run(batches):
        coder = replay(path, pattern)
        for block in blocks(batches):
            lists = [np.array(x or [], dtype="<u4").tobytes() for x in block.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array([coder.decode(x) for x in lists], pa.binary())], names=["id", "decoded"]
            )

    rows = ids.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, decoded binary").withColumnRenamed("id", id_col)
