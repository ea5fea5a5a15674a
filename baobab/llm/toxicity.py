"""Operator 10: toxicity by class-conditional Kneser-Ney models.

A word (a lower-cased white-space part without outer punctuation) is scored
character by character under two language models, one of toxic and one of
ordinary labelled documents.  The highest order (``ORDER`` characters, or the
whole beginning of a word when that is shorter) has counts of its class; every
lower order is a Kneser-Ney continuation count that both classes share, so a
rare expression backs off to the same distribution in both and says nothing,
while one that a class has been seen to use, or not to use in a context it
knows well, does.  A document's evidence is the difference of the two log
likelihoods, normalised by length over the whole text, over its windows and
over its words; a logistic fit on labelled rows that the counts have not seen
turns it into a score.

The n-gram counts that score cover every labelled row that may be learnt from;
only the fit of the logistic sees counts without the rows that it is fitted on.
Counts are exact, one entry for each distinct n-gram and context, found by its
64-bit hash.  They grow with the vocabulary of the labelled rows: tables up to a
stated number of entries are broadcast, larger ones stay in Spark, where the
distinct words of the documents are joined to them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm.bpe import blocks
from baobab.llm.common import cut, thinned, words

ORDER = 6
DISCOUNT = 0.9
#: Labels up to this number are broadcast to the texts; more are joined plainly.
BROADCAST_LABELS = 1_000_000
#: Distinct grams and contexts up to which the models are broadcast (about 110 bytes each in a
#: worker); words are joined to larger ones.
BROADCAST_GRAMS = 4_000_000
#: Labelled rows that the logistic fit takes at most.
FIT_ROWS = 20_000
#: Words that each of a worker's two cache generations holds, and that are scored in one go.
#: Most distinct words of a corpus stand in it once, so a larger cache is memory (375 bytes a
#: word) without hits.
CACHE_WORDS, WORDS_AT_ONCE = 60_000, 4_000
#: A word's log likelihood ratio from which on it counts as evidence by itself.
EXCESS = 4.0
#: A document with this score or more is toxic.
REJECT = 0.7
#: Fixed value: the folds; rows of fold 1 are never learnt from.
FOLDS, HELD_OUT = 3, 1
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¡¿«»„“”‚‘’…–—"

FEATURES = ("whole", "window", "word", "excess")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def normalised(word: str) -> str:
    return word.lower().strip(_PUNCTUATION)


class Grams:
    """Hashes of the n-grams of many words at once.

    ``hashes[k]`` has for each character (and word end) the hash of the k
    characters up to it, ``depth`` how many there are from the word's start
    mark on.  Position 0 of each word is the start mark itself."""

    def __init__(self, texts: list[str], order: int = ORDER):
        marked = [f"\x02{t}\x03" for t in texts]
        lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        self.word = np.repeat(np.arange(len(marked)), lengths)
        starts = np.cumsum(lengths) - lengths
        self.depth = np.arange(len(codes)) - starts[self.word] + 1
        self.hashes = [np.zeros(len(codes), dtype=np.uint64)]
        powers = [np.uint64(pow(int(_MIX), k, 1 << 64)) for k in range(order)]
        spread = (codes + np.uint64(1)) * np.uint64(0xFF51AFD7ED558CCD)
        spread ^= spread >> np.uint64(33)
        for k in range(order):
            shifted = np.zeros_like(spread)
            shifted[k:] = spread[: len(spread) - k] if k else spread
            self.hashes.append(self.hashes[-1] + shifted * powers[k])

    def gram(self, k: int, at: np.ndarray) -> np.ndarray:
        return self.hashes[k][at] + np.uint64(k * 0xC2B2AE3D27D4EB4F % (1 << 64))

    def context(self, k: int, at: np.ndarray) -> np.ndarray:
        """Of a gram of k characters: the k-1 before its last."""
        return self.gram(k - 1, at - 1)


COUNTS = ("n_toxic", "n_ordinary", "other_toxic", "other_ordinary")


def gram_counts(counted_words: DataFrame, order: int = ORDER) -> DataFrame:
    """Distinct n-grams of the words with the sums of their ``COUNTS``.

    ``counted_words``: word and ``COUNTS``.  Columns: k, gram, context, suffix
    (hashes as longs), starts (the gram begins a word), and ``COUNTS``."""
    keys = ["k", "gram", "context", "suffix", "starts"]

    def run(batches):
        for block in blocks(batches, 20_000):
            grams = Grams([normalised(w) for w in block.column(0).to_pylist()], order)
            n = [block.column(i + 1).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(len(COUNTS))]
            for k in range(1, order + 1):
                at = np.flatnonzero((grams.depth >= k) & (grams.depth > 1))
                if not len(at):
                    continue
                gram, first, back = np.unique(grams.gram(k, at), return_index=True, return_inverse=True)
                one = at[first]
                sums = [np.bincount(back, weights=x[grams.word[at]], minlength=len(gram)).astype(np.int64) for x in n]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(gram), k, dtype=np.int32)),
                        pa.array(gram.view(np.int64)),
                        pa.array(grams.context(k, one).view(np.int64)),
                        pa.array((grams.gram(k - 1, one)).view(np.int64)),
                        pa.array(grams.depth[one] == k),
                        *map(pa.array, sums),
                    ],
                    names=[*keys, *COUNTS],
                )

    schema = "k int, gram bigint, context bigint, suffix bigint, starts boolean, " + ", ".join(f"{c} bigint" for c in COUNTS)
    parts = counted_words.select("word", *COUNTS).mapInArrow(run, schema)
    return parts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in COUNTS))


#: What a gram's hash leads to: as a gram of the highest order (or one that begins a
#: word) its counts per class, as the context of such the totals and kinds of what
#: follows it; as a lower gram and as the context of one, continuation counts.
PARTS = {
    "top_gram": ("toxic", "ordinary"),
    "top_context": ("total_toxic", "total_ordinary", "kinds_toxic", "kinds_ordinary"),
    "shared_gram": ("shared",),
    "shared_context": ("shared_total", "shared_kinds"),
}
COLUMNS = tuple(c for columns in PARTS.values() for c in columns)


def log_ratio(
    t: dict[str, np.ndarray], depth: np.ndarray, gram: list[np.ndarray], context: list[np.ndarray], discount: float
) -> np.ndarray:
    """log P(toxic) - log P(ordinary) of characters at these depths of their words.

    ``gram[k]``: rows of ``t`` of the k characters up to each; ``context[k]``: of
    the k before it.  ``len(gram) - 1`` is the highest order."""

    def interpolated(n, total, kinds, back):
        safe = np.maximum(total, 1e-9)
        own = np.minimum(np.maximum(n - discount, 0) / safe, 1)
        return np.where(total > 0, own + np.minimum(discount * kinds / safe, 1) * back, back)

    order = len(gram) - 1
    shared = np.full(len(depth), 1 / 256)
    for k in range(1, order):
        there = np.flatnonzero(depth > k)  # below the highest order that this place has
        g, c = gram[k][there], context[k - 1][there]
        counts = t["shared"][g], t["shared_total"][c], t["shared_kinds"][c]
        shared[there] = interpolated(*(x.astype(np.float64) for x in counts), shared[there])
    top = np.minimum(depth, order)
    g, c = np.zeros(len(depth), dtype=np.int32), np.zeros(len(depth), dtype=np.int32)
    for k in range(1, order + 1):
        here = np.flatnonzero(top == k)
        g[here], c[here] = gram[k][here], context[k - 1][here]
    logs = []
    for name in ("toxic", "ordinary"):
        counts = t[name][g], t[f"total_{name}"][c], t[f"kinds_{name}"][c]
        logs.append(np.log(interpolated(*(x.astype(np.float64) for x in counts), shared) + 1e-30))
    return logs[0] - logs[1]


def text_features(n: np.ndarray, s: np.ndarray, long: np.ndarray, window: int = 8) -> np.ndarray:
    """One row of ``FEATURES`` for each text of n words, from the scores ``s`` and
    lengths ``long`` of all words in a row.

    whole: the difference per character over the whole text; window: the
    largest such over windows of ``window`` words; word: the largest of one
    word; excess: what words have beyond ``EXCESS``, added up, as a logarithm.
    A text without words has zeros."""
    out = np.zeros((len(n), len(FEATURES)))
    some = np.flatnonzero(n)
    if not len(some):
        return out
    n = n[some]
    starts = np.cumsum(n) - n
    whole = np.add.reduceat(s, starts) / np.add.reduceat(long, starts)
    best = whole  # of a text shorter than a window
    if len(s) >= window:
        a, b = np.insert(np.cumsum(s), 0, 0), np.insert(np.cumsum(long), 0, 0)
        at = np.full(len(s), -np.inf)
        at[window - 1 :] = (a[window:] - a[:-window]) / (b[window:] - b[:-window])
        inside = np.arange(len(s)) - np.repeat(starts, n)
        at[inside < window - 1] = -np.inf
        best = np.where(n >= window, np.maximum.reduceat(at, starts), whole)
    excess = np.log1p(np.add.reduceat(np.maximum(s - EXCESS, 0), starts))
    out[some] = np.column_stack([whole, best, np.maximum.reduceat(s, starts), excess])
    return out


class Model:
    """The two language models as one table of hashes of grams and contexts.

    ``tables`` has, for each of ``PARTS``, sorted distinct hashes and their columns.
    A gram of k characters that ends at a place is also the context of the one of
    k + 1 at the next place, so each is looked up once, in one open-addressing
    table that a worker builds when it is first asked."""

    def __init__(self, tables: dict[str, np.ndarray], order: int = ORDER, discount: float = DISCOUNT):
        self.t, self.order, self.discount = tables, order, discount
        self.received = False  # a worker's own copy
        self.cache: dict[bytes, float] = {}
        self.older: dict[bytes, float] = {}
        self.slots: np.ndarray | None = None

    def __reduce__(self):
        # most counts are 1: packed, they take a small part of the space on every executor
        packed = {name: (x.dtype.str, zlib.compress(x.tobytes(), 1)) for name, x in self.t.items()}
        return _unpacked, (packed, self.order, self.discount)

    def _index(self) -> None:
        self.keys = np.unique(np.concatenate([self.t[part] for part in PARTS]))
        # one row more, for what is not there
        self.columns = {c: np.zeros(len(self.keys) + 1, dtype=np.float32) for c in COLUMNS}
        for part, columns in PARTS.items():
            rows = np.searchsorted(self.keys, self.t[part])
            for c in columns:
                self.columns[c][rows] = self.t[c]
        self.shift = np.uint64(64 - max(4 * len(self.keys), 16).bit_length())
        self.mask = (1 << (64 - int(self.shift))) - 1
        self.slots = np.full(self.mask + 1, -1, dtype=np.int32)
        todo = np.arange(len(self.keys), dtype=np.int32)
        at = self._home(self.keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]
            lost = self.slots[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & self.mask
        if self.received:
            self.t = {}  # all of it is in the index

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _MIX) >> self.shift).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the table, or its length where a hash is not there."""
        keys = self.keys
        out = np.full(len(hashes), len(keys), dtype=np.int32)
        if not len(keys):
            return out
        todo, at = np.arange(len(hashes)), self._home(hashes)
        while len(todo):
            row = self.slots[at]
            hit = (row >= 0) & (keys[row] == hashes[todo])
            out[todo[hit]] = row[hit]
            more = ~hit & (row >= 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out

    def word_scores(self, texts: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word."""
        if not texts:
            return np.zeros(0)
        if self.slots is None:
            self._index()
        grams = Grams([normalised(w) for w in texts], self.order)
        rows = [np.broadcast_to(self.find(np.zeros(1, dtype=np.uint64)), len(grams.depth))]
        none = len(self.keys)
        there = np.arange(len(grams.depth))
        for k in range(1, self.order + 1):
            if k > 1:  # a gram that is there has both its longest parts there
                last = rows[-1]
                there = there[(grams.depth[there] >= k) & (last[there] != none)]
                there = there[last[there - 1] != none]
            found = np.full(len(grams.depth), none, dtype=np.int32)
            found[there] = self.find(grams.gram(k, there))
            rows.append(found)
        at = np.flatnonzero(grams.depth > 1)
        ratio = log_ratio(self.columns, grams.depth[at], [r[at] for r in rows], [r[at - 1] for r in rows], self.discount)
        return np.bincount(grams.word[at], weights=ratio, minlength=len(texts))

    def learn_words(self, words: set[bytes]) -> None:
        """Make sure that the cache holds these words' scores; one met again moves to the younger generation."""
        new = words.difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.older, self.cache, new = self.cache, {}, words
        old = self.older.keys() & new
        self.cache.update((w, self.older[w]) for w in old)
        todo = list(new - old)
        for start in range(0, len(todo), WORDS_AT_ONCE):
            some = todo[start : start + WORDS_AT_ONCE]
            scores = self.word_scores([w.decode("utf-8", "replace") for w in some])
            self.cache.update(zip(some, scores.tolist(), strict=True))

    def features(self, texts: list[bytes | None]) -> np.ndarray:
        """One row of ``FEATURES`` for each UTF-8 text."""
        split = [(t or b"").split() for t in texts]
        self.learn_words(set().union(*split))
        flat = list(chain.from_iterable(split))
        s = np.fromiter(map(self.cache.__getitem__, flat), dtype=np.float64, count=len(flat))
        long = np.fromiter(map(len, flat), dtype=np.float64, count=len(flat)) + 1
        n = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        return text_features(n, s, long)


def _unpacked(packed: dict[str, tuple[str, bytes]], order: int, discount: float) -> Model:
    tables = {name: np.frombuffer(zlib.decompress(x), dtype=kind) for name, (kind, x) in packed.items()}
    model = Model(tables, order, discount)
    model.received = True
    return model


def logistic(
    x: np.ndarray, y: np.ndarray, counts: np.ndarray | float = 1.0, ridge: float = 1.0, rounds: int = 50
) -> tuple[np.ndarray, float]:
    """Weights and bias of a ridge logistic fit by Newton steps, on standardised
    columns.  ``counts``: how many rows each row stands for."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (counts * p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (counts * (p - y)) + penalty * w
        )
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1] / scale, float(w[-1] - (w[:-1] * mean / scale).sum())


def gram_table(grams: DataFrame, toxic: str, ordinary: str, order: int = ORDER) -> DataFrame:
    """One row for each distinct hash of a gram or context: key and ``COLUMNS``,
    from the grams (see :func:`gram_counts`) that the two counts have met."""
    met = grams.where(F.col(toxic) + F.col(ordinary) > 0)
    highest = met.where((F.col("k") == order) | F.col("starts"))
    # in how many left contexts a shorter gram occurs
    followed = (
        met.where("k > 1")
        .groupBy((F.col("k") - 1).alias("k"), F.col("suffix").alias("gram"))
        .agg(F.count("*").alias("n"))
    )
    lower = cut(met.where(F.col("k") < order).select("k", "gram", "context").join(followed, ["k", "gram"]))
    some = lambda c: (F.col(c) > 0).cast("int")
    parts = (
        (highest, "gram", {"toxic": F.col(toxic), "ordinary": F.col(ordinary)}),
        (highest, "context", {"total_toxic": F.col(toxic), "total_ordinary": F.col(ordinary),
                              "kinds_toxic": some(toxic), "kinds_ordinary": some(ordinary)}),
        (lower, "gram", {"shared": F.col("n")}),
        (lower, "context", {"shared_total": F.col("n"), "shared_kinds": F.lit(1)}),
    )
    rows = None
    for part, key, has in parts:
        values = [has.get(c, F.lit(0)).cast("bigint").alias(c) for c in COLUMNS]
        part = part.select(F.col(key).alias("key"), *values)
        rows = part if rows is None else rows.unionByName(part)
    return rows.groupBy("key").agg(*(F.sum(c).cast("float").alias(c) for c in COLUMNS))


def gathered(table: DataFrame, order: int = ORDER) -> Model:
    """The model of a :func:`gram_table`, on the driver."""
    got = table.toArrow()
    keys = got.column("key").to_numpy().view(np.uint64)
    by_key = np.argsort(keys)
    columns = {c: got.column(c).to_numpy()[by_key] for c in COLUMNS}
    tables = {}
    for part, names in PARTS.items():
        there = np.any([columns[c] > 0 for c in names], axis=0)
        tables[part] = keys[by_key][there]
        tables |= {c: columns[c][there] for c in names}
    return Model(tables, order)


def fit_model(counted_words: DataFrame, order: int = ORDER) -> Model:
    """The model of words with their n_toxic and n_ordinary."""
    none = {c: F.lit(0).cast("long") for c in COUNTS if c not in counted_words.columns}
    grams = cut(gram_counts(counted_words.withColumns(none), order))
    return gathered(gram_table(grams, "n_toxic", "n_ordinary", order), order)


def joined_features(rows: DataFrame, table: DataFrame, order: int = ORDER) -> DataFrame:
    """Columns rid and x (``FEATURES``) of ``rows`` (rid, a unique long, and text),
    with a table of any size: no part of it leaves Spark.

    Each distinct word of the rows is scored once: its grams are joined to the
    table, and its score is joined back to where the word stands."""
    names = list(COLUMNS)
    split = rows.select("rid", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    distinct = cut(split.select("word").distinct().withColumn("w", F.monotonically_increasing_id()))

    def places(batches):
        for block in blocks(batches, 4096):
            grams = Grams([normalised(x) for x in block.column(0).to_pylist()], order)
            ids = block.column(1).to_numpy()
            for k in range(order + 1):  # the empty context stands at every place
                at = np.flatnonzero(grams.depth >= k)
                columns = ids[grams.word[at]], grams.depth[at], np.full(len(at), k, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in columns), pa.array(grams.gram(k, at).view(np.int64))], names=["w", "depth", "k", "key"]
                )

    looked = distinct.select("word", "w").mapInArrow(places, "w bigint, depth bigint, k int, key bigint").join(table, "key", "left")
    found = F.struct("depth", "k", *(F.coalesce(c, F.lit(0.0)).cast("float").alias(c) for c in names))
    of_word = looked.groupBy("w").agg(F.collect_list(found).alias("found"))

    def scores(batches):
        for block in blocks(batches, 1024):
            lists = block.column(1)
            flat = lists.flatten()
            depth, k = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            t = {c: np.append(flat.field(i + 2).to_numpy(zero_copy_only=False), np.float32(0)) for i, c in enumerate(names)}
            word = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            longest = np.zeros(len(lists), dtype=np.int64)
            np.maximum.at(longest, word, depth)
            first = np.cumsum(longest) - longest
            row = [np.full(int(longest.sum()), len(flat), dtype=np.int32) for _ in range(order + 1)]
            for i in range(order + 1):
                here = np.flatnonzero(k == i)
                row[i][first[word[here]] + depth[here] - 1] = here
            place = np.repeat(np.arange(len(lists)), longest)
            depths = np.arange(len(place)) - first[place] + 1
            at = np.flatnonzero(depths > 1)
            ratio = log_ratio(t, depths[at], [r[at] for r in row], [r[at - 1] for r in row], DISCOUNT)
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(np.bincount(place[at], weights=ratio, minlength=len(lists)))], names=["w", "s"]
            )

    scored = cut(distinct.join(of_word.mapInArrow(scores, "w bigint, s double"), "w").select("word", "s"))
    placed = split.join(scored, "word").select("rid", F.struct("pos", "s", (F.octet_length("word") + 1).alias("long")).alias("x"))
    texts = rows.select("rid").join(placed.groupBy("rid").agg(F.sort_array(F.collect_list("x")).alias("found")), "rid", "left")
    texts = texts.withColumn("found", F.coalesce("found", F.array().cast("array<struct<pos:int,s:double,long:int>>")))

    def features(batches):
        for block in blocks(batches):
            lists = block.column(1)
            flat = lists.flatten()
            s, long = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in (1, 2))
            x = text_features(np.diff(lists.offsets.to_numpy()).astype(np.int64), s, long)
            yield pa.RecordBatch.from_arrays([block.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["rid", "x"])

    return texts.select("rid", "found").mapInArrow(features, "rid bigint, x array<double>")


class Scorer:
    """What :func:`learn` gives: the models (on the driver, or a table if that is too large) and the logistic fit."""

    def __init__(self, model: Model | DataFrame | None, weights: np.ndarray, bias: float):
        self.model, self.weights, self.bias = model, weights, bias

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.model is None:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(self.model.features(texts) @ self.weights + self.bias, -500, 500)))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    fit_rows: int = FIT_ROWS,
    broadcast_grams: int = BROADCAST_GRAMS,
) -> Scorer:
    """Learn from the labelled rows outside the held-out fold.

    A word counts once a document, so that a text that repeats itself does not
    outvote the others; at scoring every occurrence is evidence.  The logistic is
    fitted on a quarter of the rows, ``fit_rows // 2`` of each class at most (each
    then stands for as many as its class was thinned by), with language models that
    count the other three quarters; the models that score then count all rows.
    Where the quarter has fewer than 5 rows of a class, all rows are fitted on.
    Models of up to ``broadcast_grams`` distinct grams and contexts are broadcast;
    larger ones stay tables that :func:`scored` joins.

    Rows with a null id, text or label teach nothing; one with several labels
    counts once for each, and so do rows that share an id.  Without rows of both
    classes every score is 0.  Other columns are not read."""
    # folds are cut before the join, so that no held-out text is moved
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col(id_col)) != HELD_OUT))
    known = known.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("y"))
    if known.count() <= BROADCAST_LABELS:
        known = F.broadcast(known)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("id").isNotNull() & (fold(F.col("id")) != HELD_OUT))
    quarter = F.floor(F.crc32(F.col("id").cast("string")) / FOLDS) % 4
    labelled = rows.join(known, "id").withColumn("fits", quarter == 0)
    taught = labelled.where("text is not null")
    toxic, ordinary, other = F.col("y"), 1 - F.col("y"), (~F.col("fits")).cast("int")
    counted = cut(
        taught.select("y", "fits", F.explode(F.array_distinct(words(F.col("text")))).alias("word"))
        .groupBy("word")
        .agg(
            F.sum(toxic).alias("n_toxic"),
            F.sum(ordinary).alias("n_ordinary"),
            F.sum(toxic * other).alias("other_toxic"),
            F.sum(ordinary * other).alias("other_ordinary"),
        )
    )
    n = counted.agg(*(F.sum(c) for c in COUNTS)).first()
    if not n[0] or not n[1]:
        return Scorer(None, np.zeros(len(FEATURES)), 0.0)
    grams = cut(gram_counts(counted))

    def model_of(toxic: str, ordinary: str) -> Model | DataFrame:
        table = cut(gram_table(grams, toxic, ordinary))
        return gathered(table) if table.count() <= broadcast_grams else table

    model = model_of("n_toxic", "n_ordinary")
    # where a class is in the quarter alone, the fit takes the same counts
    others = model_of("other_toxic", "other_ordinary") if n[2] and n[3] else model
    held = {(r["fits"], r["y"]): r["n"] for r in labelled.groupBy("fits", "y").agg(F.count("*").alias("n")).collect()}

    def sample(part: DataFrame, about: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        """At most ``fit_rows // 2`` rows of each class.  They are measured where they are; only numbers are gathered."""
        each = part.withColumn("at", F.xxhash64("id", "text"))
        some = [thinned(each.where(F.col("y") == y), fit_rows // 2, about[y], F.col("at")) for y in (0, 1)]
        x = _features(some[0].unionByName(some[1]).select("text", "y", "at"), others)
        got = [x.where(F.col("y") == y).orderBy("at").limit(fit_rows // 2) for y in (0, 1)]
        got = got[0].unionByName(got[1]).toArrow()
        return np.array(got.column("x").to_pylist()).reshape(-1, len(FEATURES)), got.column("y").to_numpy()

    about = {y: held.get((True, y), 0) for y in (0, 1)}
    if min(about.values()) >= 5:
        x, y = sample(taught.where("fits"), about)
    else:
        about = {y: held.get((True, y), 0) + held.get((False, y), 0) for y in (0, 1)}
        x, y = sample(taught, about)
    stands_for = np.array([max(about[k] / max(int((y == k).sum()), 1), 1.0) for k in (0, 1)])
    weights, bias = logistic(x, y, stands_for[y])
    return Scorer(model, weights, bias)


def _features(rows: DataFrame, model: Model | DataFrame) -> DataFrame:
    """``rows`` (text, y, at) with their features x for their texts."""
    if isinstance(model, DataFrame):
        named = cut(rows.withColumn("rid", F.monotonically_increasing_id()))
        return named.select("rid", "y", "at").join(joined_features(named, model), "rid")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for block in blocks(batches):
            x = shared.value.features(block.column(0).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.tolist(), pa.list_(pa.float64())), block.column(1), block.column(2)], names=["x", "y", "at"]
            )

    return cut(rows.mapInArrow(run, "x array<double>, y int, at bigint"))


def score(text: Column, scorer: Scorer, spark) -> Column:
    """Score from 0 to 1 of a text column, by models that are broadcast; null and empty texts have a score too."""
    if isinstance(scorer.model, DataFrame):
        raise ValueError("models that are too large to be broadcast are joined by scored()")
    shared = spark.sparkContext.broadcast(scorer)

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = []
            for start in range(0, len(texts), 512):
                parts.append(shared.value.scores(texts.slice(start, 512).cast(pa.binary()).to_pylist()))
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return toxicity(text.cast("string"))


def scored(docs: DataFrame, scorer: Scorer, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out`` (see :func:`score`), by models of any size.

    Every row has a score of its own, whatever its id; columns of any other name stay as they are."""
    if not isinstance(scorer.model, DataFrame):
        return docs.withColumn(out, score(F.col(text_col), scorer, docs.sparkSession))
    named = cut(docs.withColumn("__rid", F.monotonically_increasing_id()))
    x = joined_features(named.select(F.col("__rid").alias("rid"), F.col(text_col).cast("string").alias("text")), scorer.model)
    z = F.lit(scorer.bias)
    for k, weight in enumerate(scorer.weights.tolist()):
        z = z + F.get("x", F.lit(k)) * weight
    limited = F.greatest(F.least(-z, F.lit(500.0)), F.lit(-500.0))
    scores = x.select(F.col("rid").alias("__rid"), (1 / (1 + F.exp(limited))).alias(out))
    return named.drop(out).join(scores, "__rid").drop("__rid")
