"""Operator 9: best-fit-decreasing packing of token pieces into sequences.

1. Every task tokenises its documents and cuts only those that are longer than
   a sequence; each piece gets its number among the task's pieces of its length.
2. Best-fit decreasing looks at nothing but lengths, so it runs over the counts
   per length: one row for each of at most ``capacity`` lengths, however many
   documents there are.  A segment tree over remaining capacities finds the
   tightest open bin in logarithmic time; pieces of one length that meet bins of
   one remaining capacity are placed in one step (a *run*), which gives the same
   bins as placing them one after another.
3. Every piece finds its run by length and number, and from it its bin and offset.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from baobab.llm.bpe import blocks
from baobab.llm.common import cut

#: Entries that each of the two generations of a worker's cache holds.
CACHE_WORDS = 450_000
#: Documents that are taken apart together.
BLOCK_DOCS = 512
#: Words that go to the tokenizer in one text.
JOINED = 500
#: Python splits at these, the tokenizer does not: such texts go to it whole.
_ODD = re.compile("[\x1c-\x1f]")
#: Where a full stop or comma touches another mark; and what else keeps a text from
#: being lowered and taken apart at once (lower case there depends on more than a character).
_TOUCHING = re.compile(r"[.,](?:[^\w\s]|_)|(?:[^\w\s]|_)[.,]")
_UNSURE = ("..", ",,", ".,", ",.", "Σ", "İ")
#: Marks that stand as one token run behind a word.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[]^_`{|}~"


class Generations:
    """A bounded cache: what has not been met for two generations goes."""

    def __init__(self, size: int = CACHE_WORDS):
        self.size, self.now, self.old = size, {}, {}

    def missing(self, keys: set) -> list:
        """Those of the keys that are in neither generation; the others are in the younger one then."""
        new = keys.difference(self.now)
        if len(self.now) + len(new) > self.size:
            self.old, self.now, new = self.now, {}, keys
        found = {k: self.old[k] for k in new if k in self.old}
        self.now.update(found)
        return [k for k in new if k not in found]


class WordTokens:
    """Token ids of texts, put together from those of their white-space-separated parts.

    The tokenizer's normaliser and pre-tokenizer never join characters across
    white space, so a text's ids are those of its parts in a row.  Full stops and
    commas that touch no other mark are parts of their own, as they are to the
    tokenizer, and the text is lowered at once where that is done character by
    character.  Each distinct part goes to the tokenizer once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = Generations()
        #: Of the parts in the younger generation those with a mark at an end.
        self.outer: set[str] = set()

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word, many words to a call."""
        for start in range(0, len(words), JOINED):
            some = words[start : start + JOINED]
            ids = np.array(self.tokenizer.encode("\n".join(some), add_special_tokens=False).ids, dtype="<u4")
            at = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
            if len(at) == len(some) + 1:
                packed, at = ids.tobytes(), (4 * at).tolist()
                yield from (packed[a:b] for a, b in pairwise(at))
            else:  # something among them is more than one word to the tokenizer
                yield from map(self.direct, some)

    def _learn(self, parts: set[str]) -> None:
        todo, known = self.parts.missing(parts), self.parts.now
        words = [p for p in todo if p.isalpha()]
        known.update(zip(words, self._words(words), strict=True))
        marked = []
        for part in todo:
            if part not in known:
                word = part.rstrip(_MARKS)
                if word.isalpha() and "İ" not in word:
                    marked.append((part, word, part[len(word) :]))
                else:
                    known[part] = self.direct(part)
        if marked:
            some = list({w for _, w, _ in marked})
            of_word = dict(zip(some, self._words(some), strict=True))
            of_mark = {m: self.direct(m) for m in {m for _, _, m in marked}}
            known.update((part, of_word[word] + of_mark[mark]) for part, word, mark in marked)

    def _split(self, texts: list[str]) -> list[list[str]]:
        """Parts of each text, all of them learnt; full stops and commas by themselves where that is sure."""
        split = []
        for t in texts:
            if any(x in t for x in _UNSURE):
                split.append(t.split())
            else:
                split.append(t.lower().replace(".", " . ").replace(",", " , ").split())
        found = set().union(*split)
        self.outer.update(p for p in found.difference(self.parts.now) if not (p[0].isalnum() and p[-1].isalnum()))
        self.outer -= {".", ","}
        again = [k for k, p in enumerate(split) if not self.outer.isdisjoint(p) and _TOUCHING.search(texts[k])]
        for k in again:
            split[k] = texts[k].split()
        self._learn(found.union(*(split[k] for k in again)))
        if len(self.outer) > len(self.parts.now):
            self.outer.intersection_update(self.parts.now)
        return split

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        odd = [bool(_ODD.search(t)) for t in texts]
        split = self._split(["" if o else t for o, t in zip(odd, texts, strict=True)])
        of = self.parts.now.__getitem__
        return [
            self.direct(t) if o else b"".join(map(of, parts)) for o, t, parts in zip(odd, texts, split, strict=True)
        ]


@functools.lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of every tokenised text, each text followed by ``end_id``.

    Columns: the id, piece, start, length, ids_crc32, ids (null unless
    ``with_ids``), task and nth (the piece's number among the pieces of its
    length in that task).  A null text is an empty one: the single ``end_id``."""
    end = np.array([end_id], dtype="<u4").tobytes()
    width = 4 * capacity

    def run(batches):
        tokens = word_tokens(path)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for block in blocks(batches, BLOCK_DOCS):
            ids = block.column(0)
            coded = tokens.encode([t or "" for t in block.column(1).to_pylist()])
            row, piece, start, length, crc, nth, part = [], [], [], [], [], [], []
            for k, code in enumerate(coded):
                code += end
                for at in range(0, len(code), width):
                    x = code[at : at + width]
                    n = len(x) // 4
                    row.append(k)
                    piece.append(at // width)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(x))
                    nth.append(seen[n])
                    part.append(np.frombuffer(x, dtype="<i4") if with_ids else None)
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array(part, pa.list_(pa.int32())),
                    pa.array([task] * len(row), pa.int32()),
                    pa.array(nth, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    schema = (
        f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>, "
        "task int, nth bigint"
    )
    return rows.mapInArrow(run, schema)


class Tightest:
    """Segment tree over remaining capacities 0..size: which of them have open
    bins, and the smallest such that is at least a given one."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.any = [False] * (2 * self.base)

    def set(self, capacity: int, present: bool) -> None:
        k = capacity + self.base
        self.any[k] = present
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def find(self, least: int) -> int:
        """The smallest capacity >= ``least`` with an open bin, or -1."""
        k = least + self.base
        if self.any[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.base:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.base
            k //= 2
        return -1


def best_fit_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts per length.

    Runs (length, first, bin, offset, per_bin): pieces of this length from
    number ``first`` on go to bins from ``bin`` on, ``per_bin`` to each, from
    ``offset`` on.  Bins of one remaining capacity are held as intervals."""
    runs: list[tuple[int, int, int, int, int]] = []
    open_bins: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
    tree, bins = Tightest(capacity), 0

    def put(left: int, first_bin: int, n: int) -> None:
        if n and left:
            open_bins[left].append((first_bin, n))
            tree.set(left, True)

    for length in sorted(counts, reverse=True):
        todo, first = counts[length], 0
        while todo:
            left = tree.find(length)
            if left < 0:  # new bins
                left = capacity
                at, n = bins, -(-todo // (capacity // length))
                bins += n
            else:
                at, n = open_bins[left].pop()
                if not open_bins[left]:
                    tree.set(left, False)
            # the bin just used is the tightest as long as another piece fits
            per_bin = left // length
            full, rest = min(n, todo // per_bin), 0
            if full < n:
                rest = todo - full * per_bin if full * per_bin < todo else 0
            runs.append((length, first, at, capacity - left, per_bin))
            put(left - per_bin * length, at, full)
            if rest:
                put(left - rest * length, at + full, 1)
            put(left, at + full + bool(rest), n - full - bool(rest))
            first += full * per_bin + rest
            todo -= full * per_bin + rest
    return runs


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Per piece: id, piece, start, length, ids_crc32, ids, sequence_id, offset.
    Null texts count as empty (one piece of one token); repeated rows are
    packed each for itself; an empty table gives an empty result; other columns
    are not read.  The pieces are written to the checkpoint folder first, so
    that a task that runs again cannot number them otherwise.

    To the driver come the counts per length (at most ``capacity`` rows);
    broadcast are the runs, whose number depends on ``capacity`` alone."""
    pieces = cut(token_pieces(docs, path, capacity, end_id, id_col, text_col, with_ids))
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    by_length = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(best_fit_runs(by_length, capacity))
    # one row of offsets per (length, task): a window partition holds the tasks of one length
    w = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = per_task.select("length", "task", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    table = np.array(runs or [(0, 0, 0, 0, 1)], dtype=np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def place(batches):
        t = shared.value
        big = np.int64(1) << 48
        keys = t[:, 0] * big + t[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            number = batch.column("number").to_numpy(zero_copy_only=False)
            r = t[np.searchsorted(keys, length * big + number, side="right") - 1]
            n = number - r[:, 1]
            columns = [c for c in batch.schema.names if c != "number"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(r[:, 2] + n // r[:, 4]), pa.array(r[:, 3] + n % r[:, 4] * length)],
                names=[*columns, "sequence_id", "offset"],
            )

    numbered = pieces.join(before, ["length", "task"]).select(
        "id", "piece", "start", "length", "ids_crc32", "ids", (F.col("nth") + F.col("before")).alias("number")
    )
    kept = numbered.drop("number").schema
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id bigint, offset bigint"
    return numbered.mapInArrow(place, schema).withColumnRenamed("id", id_col)
