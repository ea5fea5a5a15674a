"""Operator 1: token counts that follow edits.

A document keeps a segment tree over its pre-tokens: leaves are regions of a few
dozen pre-tokens, every node has the characters and tokens below it.  An edit
descends to the leaf where it starts, re-encodes from the first pre-token that
the edit can reach, goes on until a new pre-token ends where an old one did
beyond the edit, and updates the sums above the touched leaves.  Text outside is
neither split nor encoded again.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm.bpe import Replay, blocks, replay

#: Pre-tokens of a leaf.
REGION = 32


class CountTree:
    """Pre-tokens of one text in leaves, with sums of (characters, tokens) above."""

    def __init__(self, coder: Replay, words: list[str]):
        self.coder = coder
        self.leaves = [words[k : k + REGION] for k in range(0, len(words), REGION)] or [[]]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for k in range(len(self.leaves)):
            self._sum(k)
        for node in range(self.base - 1, 0, -1):
            self._join(node)
        #: Pre-tokens that edits have had split and encoded again.
        self.again = 0

    def _sum(self, leaf: int) -> None:
        words, cache = self.leaves[leaf], self.coder.cache
        self.chars[self.base + leaf] = sum(map(len, words))
        self.tokens[self.base + leaf] = sum(len(cache[w]) for w in words) // 4

    def _join(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, at: int) -> tuple[int, int]:
        """The leaf of the character ``at`` (the last leaf at the text's end) and where it begins."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if at - start >= self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` characters from ``start`` on; both are cut to the text."""
        size = self.chars[1]
        start = min(max(start, 0), size)
        end = min(start + max(length, 0), size)
        shift = len(replacement) - (end - start)
        # a pre-token looks one character beyond its end at most, so the first one
        # that the edit can reach is that of the character start - 2
        reached = max(start - 2, 0)
        first, at = self.leaf_at(reached)
        leaf = self.leaves[first]
        starts = list(accumulate(map(len, leaf), initial=at))
        k = max(min(bisect_right(starts, reached), len(leaf)) - 1, 0)
        at, kept, old, last = starts[k], leaf[:k], leaf[k:], first
        have, margin, met = at + sum(map(len, old)), 8, None
        while met is None:
            while have < min(end + margin, size):
                last += 1
                old = old + self.leaves[last]
                have += self.chars[self.base + last]
            flat = "".join(old)
            window = flat[: start - at] + replacement + flat[end - at :]
            bounds = {p: i for i, p in enumerate(accumulate(map(len, old), initial=at))}
            new, place = [], 0
            for word in [*self.coder.find(window), ""]:
                before = at + place - shift  # where this boundary was
                if before >= end and before in bounds and (have == size or place + 2 <= len(window)):
                    met = bounds[before]
                    break
                new.append(word)
                place += len(word)
            margin *= 4
        self.again += len(new)
        merged = kept + new + old[met:]
        share = max(-(-len(merged) // (last - first + 1)), 1)
        for i in range(last - first + 1):
            self.leaves[first + i] = merged[i * share : (i + 1) * share]
            self.coder.learn(set(self.leaves[first + i]))
            self._sum(first + i)
        low, high = (first + self.base) // 2, (last + self.base) // 2
        while low:
            for node in range(low, high + 1):
                self._join(node)
            low, high = low // 2, high // 2

    def text(self) -> str:
        return "".join("".join(leaf) for leaf in self.leaves)


def count_edits(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits_col: str = "edits",
    with_text: bool = False,
) -> DataFrame:
    """Token counts of every text before and after its edits.

    ``edits_col`` is an array of structs (start int, length int, replacement
    string), applied in order, each to the text that the ones before it left;
    starts and lengths count characters.  Per row: the id, n_tokens, n_edits,
    n_tokens_edited, n_pretokens (before), n_again (pre-tokens that edits had
    encoded again) and, if asked for, edited_text.

    A null text is empty; a null edit list or edit does nothing; null starts and
    lengths are 0, a null replacement is empty; whatever lies beyond the text is
    cut to it.  Repeated rows are counted each for itself; an empty table gives
    an empty result.  The edits of a document are in its row, so nothing is
    shuffled; other columns are not read."""

    def run(batches):
        coder = replay(path, pattern)
        for block in blocks(batches):
            texts, edits = block.column(1).to_pylist(), block.column(2).to_pylist()
            split = [coder.find(t or "") for t in texts]
            coder.learn(set().union(*split))
            rows = []
            for words, todo in zip(split, edits, strict=True):
                coder.learn(set(words))
                tree = CountTree(coder, words)
                before, n = tree.total, 0
                for e in todo or ():
                    if e is not None:
                        tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                        n += 1
                rows.append((before, n, tree.total, len(words), tree.again, tree.text() if with_text else None))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [block.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())],
                names=["id", "n_tokens", "n_edits", "n_tokens_edited", "n_pretokens", "n_again", "edited_text"],
            )

    kind = "array<struct<start:int,length:int,replacement:string>>"
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(edits_col).cast(kind).alias("edits")
    )
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_tokens bigint, n_edits bigint, n_tokens_edited bigint, "
        "n_pretokens bigint, n_again bigint, edited_text string"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def stand_in_edits(text: Column, doc_id: Column) -> Column:
    """Stand-in edit lists: an insertion, a deletion and a replacement at hashed places."""
    size = F.coalesce(F.length(text), F.lit(0))

    def at(seed: int, most: int = 0) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(seed)), size + 1 + most).cast("int")

    def edit(start: Column, length: Column, replacement: Column) -> Column:
        return F.struct(start.alias("start"), length.alias("length"), replacement.alias("replacement"))

    return F.array(
        edit(at(1), F.lit(0), F.concat(F.lit(" inserted "), doc_id.cast("string"))),
        edit(at(2), at(3) % 40, F.lit("")),
        edit(at(4), at(5) % 12, F.lit("it's 100% new")),
    )
