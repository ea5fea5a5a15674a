"""Operator 2: quality rules by divergence from language references.

A document's histograms of character classes and of its language's common words
are compared to those of the whole language by Jensen-Shannon distance (base 2,
0 to 1).  The references are counted over all documents.  Only DataFrame
expressions run: a document is measured where it is read, and the only rows that
move are word counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from baobab.llm.common import SPACES, cut, words

#: Characters that count as symbols, and the base rules.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Character classes of what is no white space, each taken out of what the ones before
#: it left; then come the rest and the white space.
CLASSES = ("[a-z]+", "[A-Z]+", "[0-9]+", "\\p{L}+", "[.,;:!?'\"()-]+")
#: Repeated windows of a document up to which they are looked up one by one.
FEW = 12
#: Common words of a reference.
COMMON = 24
#: Guards: a document and a reference are compared from so many words on.
GUARD_WORDS, GUARD_REFERENCE_WORDS = 50, 5_000
#: Distances beyond which a document is rejected.
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.30, 0.40
#: References up to this number of languages are broadcast; more are joined plainly.
BROADCAST_LANGUAGES = 1_000


def repeat_words(docs: DataFrame, words_col: str, out: str) -> DataFrame:
    """Adds ``out``: how many words of the array stand in three-word windows that
    occur twice or more, the first occurrence included.

    Nothing more is done where all window hashes are distinct.  Where few of
    them repeat, windows are looked up among those; where many do, hashes are
    sorted with their places, so that equal ones are neighbours.  64-bit hashes
    within one document: a false match has odds of n^2 / 2^65 for n words."""
    w = F.col(words_col)
    n = F.size(w)
    window = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    none = F.array().cast("array<bigint>")
    rows = docs.withColumn("__q_h", F.when(n >= 4, F.slice(window, F.lit(1), n - 2)).otherwise(none))
    distinct = F.size(F.array_distinct("__q_h")) == F.size("__q_h")
    rows = rows.withColumn("__q_o", F.when(~distinct, F.sort_array("__q_h")))
    o = F.col("__q_o")
    again = F.filter(o, lambda x, k: F.when(k > 0, F.get(o, k - 1) == x).otherwise(False))
    rows = rows.withColumn("__q_d", F.array_distinct(again))
    few = F.size("__q_d") <= FEW
    looked_up = F.transform("__q_h", lambda h, i: F.when(F.array_contains("__q_d", h), i))
    pairs = F.sort_array(F.transform("__q_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("__q_s", F.when(~few, pairs))
    s = F.col("__q_s")
    neighbours = F.filter(
        s,
        lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | F.when(k > 0, F.get(s, k - 1)["h"] == x["h"]).otherwise(False),
    )
    places = F.when(few, F.filter(looked_up, lambda i: i.isNotNull())).otherwise(F.transform(neighbours, lambda x: x["i"]))
    covered = F.flatten(F.transform(places, lambda i: F.array(i, i + 1, i + 2)))
    return rows.withColumn(out, F.coalesce(F.when(o.isNotNull(), F.size(F.array_distinct(covered))), F.lit(0))).drop(
        "__q_h", "__q_o", "__q_d", "__q_s"
    )


def class_counts(docs: DataFrame, text: Column, dense: Column, out: str) -> DataFrame:
    """Adds ``out``: code points of each of ``CLASSES``, of the rest and of white
    space, as an array.  ``dense`` is the text without its white space."""
    rows = docs.withColumns({"__q_t0": dense, "__q_size": F.length(text)})
    for k, pattern in enumerate(CLASSES):
        rows = rows.withColumn(f"__q_t{k + 1}", F.regexp_replace(f"__q_t{k}", pattern, ""))
    left = [F.length(f"__q_t{k}") for k in range(len(CLASSES) + 1)]
    counts = [a - b for a, b in zip(left, left[1:], strict=False)] + [left[-1], F.col("__q_size") - left[0]]
    return rows.withColumn(out, F.array(*counts)).drop("__q_size", *(f"__q_t{k}" for k in range(len(CLASSES) + 1)))


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(p, q, lambda x, y: (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2)
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    return F.sqrt(F.greatest(total, F.lit(0.0)))


def references(docs: DataFrame, text_col: str, lang: Column) -> DataFrame:
    """One row per language, over all documents: lang, words, common (its most
    frequent words, lower-case), common_shares (of these and of all others),
    class_shares."""
    rows = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    counted = cut(
        rows.select("lang", F.explode(words(F.lower("text"))).alias("word")).groupBy("lang", "word").agg(
            F.count("*").alias("n")
        )
    )
    totals = counted.groupBy("lang").agg(F.sum("n").alias("words"))
    nth = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = (
        counted.withColumn("nth", nth)
        .where(F.col("nth") <= COMMON)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("nth", "word", "n"))).alias("top"))
    )
    text = F.coalesce("text", F.lit(""))
    dense = text
    for space in SPACES:
        dense = F.replace(dense, F.lit(space), F.lit(""))
    classes = class_counts(rows, text, dense, "c")
    sums = [F.sum(F.get("c", F.lit(k))) for k in range(len(CLASSES) + 2)]
    classes = classes.groupBy("lang").agg(F.array(*sums).alias("c"))
    counts = F.transform("top", lambda x: x["n"].cast("double"))
    rest = F.col("words") - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    every = F.aggregate(F.col("c"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return common.join(totals, "lang").join(classes, "lang").select(
        "lang",
        "words",
        F.transform("top", lambda x: x["word"]).alias("common"),
        F.array_max(F.transform("top", lambda x: F.length(x["word"]))).alias("longest"),
        shares(F.concat(counts, F.array(rest)), F.col("words")).alias("common_shares"),
        shares(F.col("c"), every).alias("class_shares"),
    )


def measure(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", out: str = "quality"
) -> DataFrame:
    """``docs`` with all its columns and a struct ``out`` of n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean),
    class_distance and word_distance (double, null where a guard stops the comparison).

    A null text has no words.  A null language is the empty one.  A
    document under ``GUARD_WORDS`` words, or of a language with under
    ``GUARD_REFERENCE_WORDS``, is judged by the base rules alone.  Repeated rows
    are judged alike; an empty table gives an empty result.  A column of the name
    ``out`` is replaced; names that begin with __q_ are taken."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")
    known = cut(references(docs, text_col, lang)).select(
        *(F.col(c).alias(f"__q_{c}") for c in ("lang", "words", "common", "longest", "common_shares", "class_shares"))
    )
    if known.count() <= BROADCAST_LANGUAGES:
        known = F.broadcast(known)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.withColumn("__q_key", lang).join(known, F.col("__q_key") == F.col("__q_lang"), "left")
    rows = rows.withColumn("__q_w", words(F.col(text_col)))
    rows = repeat_words(rows, "__q_w", "__q_repeats")
    # lower case makes no word shorter in characters: only these can be common
    short = F.filter("__q_w", lambda x: F.length(x) <= F.col("__q_longest"))
    rows = rows.withColumn("__q_joined", F.lower(F.concat(F.lit(" "), F.array_join(short, "  "), F.lit(" "))))
    rows = rows.withColumn("__q_dense", F.array_join("__q_w", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    rows = rows.withColumns(
        {
            "__q_lines": lines,
            "__q_n": F.size("__q_w"),
            "__q_chars": F.length("__q_dense"),
            "__q_symbols": F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")),
        }
    )
    # a word stands between two spaces of its own there: what a replacement takes away counts it
    size = F.octet_length("__q_joined")
    rows = rows.withColumn(
        "__q_counts",
        F.array(
            *(
                (size - F.octet_length(F.replace(F.col("__q_joined"), word))) / F.octet_length(word)
                for word in (
                    F.concat(F.lit(" "), F.coalesce(F.get("__q_common", F.lit(k)), F.lit("")), F.lit(" "))
                    for k in range(COMMON)
                )
            )
        ),
    )
    rows = class_counts(rows.drop("__q_w", "__q_joined"), text, F.col("__q_dense"), "__q_classes")
    counts = F.slice("__q_counts", F.lit(1), F.size("__q_common"))
    rest = F.col("__q_n") - F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    guarded = (F.col("__q_n") >= GUARD_WORDS) & (F.col("__q_words") >= GUARD_REFERENCE_WORDS)
    every = F.aggregate(F.col("__q_classes"), F.lit(0), lambda a, x: a + x)
    rows = rows.withColumns(
        {
            "__q_class_distance": F.when(
                guarded, distance(shares(F.col("__q_classes"), every), F.col("__q_class_shares"))
            ),
            "__q_word_distance": F.when(
                guarded, distance(shares(F.concat(counts, F.array(rest)), F.col("__q_n")), F.col("__q_common_shares"))
            ),
            "__q_failed": (F.col("__q_n") < LEAST_WORDS)
            | (100 * F.col("__q_repeats").cast("long") > MOST_REPEATED_PERCENT * F.col("__q_n").cast("long")),
        }
    )
    far = (F.col("__q_class_distance") > MOST_CLASS_DISTANCE) | (F.col("__q_word_distance") > MOST_WORD_DISTANCE)
    verdict = F.struct(
        F.col("__q_n").cast("long").alias("n_words"),
        F.col("__q_chars").cast("long").alias("word_chars"),
        F.col("__q_symbols").cast("long").alias("n_symbols"),
        (F.size("__q_lines") - F.size(F.array_distinct("__q_lines"))).cast("long").alias("n_dup_lines"),
        F.col("__q_repeats").cast("long").alias("n_repeat_words"),
        F.col("__q_failed").alias("base_failed"),
        (~F.col("__q_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        F.col("__q_class_distance").alias("class_distance"),
        F.col("__q_word_distance").alias("word_distance"),
    )
    # exploding one element keeps a caller's filter on the verdict above it: pushed
    # below, it would be written out with all that the verdict is computed from
    made = rows.withColumn(out, F.explode(F.array(verdict)))
    return made.drop(*(c for c in made.columns if c.startswith("__q_")))


def _sql() -> str:
    """DuckDB SQL for the query's rows, stated row by row: words unnested, windows
    counted, histograms joined."""
    counts, steps = [], []
    for k, pattern in enumerate(CLASSES):
        steps.append(f"regexp_replace(t{k}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g') AS t{k + 1}")
        counts.append(f"length(t{k}) - length(t{k + 1})")
    rest = f"length(t{len(CLASSES)}) - length(regexp_replace(t{len(CLASSES)}, '[^ {chr(92)}x09-{chr(92)}x0D]', '', 'g'))"
    space = f"length(regexp_replace(t0, '[^ {chr(92)}x09-{chr(92)}x0D]', '', 'g'))"
    lateral = "".join(f"\n  CROSS JOIN LATERAL (SELECT {step}) s{k}" for k, step in enumerate(steps))
    return f"""
WITH base AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS t0,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
word AS (SELECT doc_id, lang, unnest(w) AS word, unnest(range(len(w))) AS pos FROM base),
three AS (
  SELECT doc_id, pos, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
twice AS (
  SELECT doc_id, pos FROM (
    SELECT *, count(*) OVER (PARTITION BY doc_id, word, w2, w3) AS n FROM three WHERE w3 IS NOT NULL) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS p FROM twice) GROUP BY doc_id),
line AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t0, chr(10))) AS l FROM base)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
same AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM line GROUP BY doc_id),
spoken AS (SELECT lang, lower(word) AS word, count(*) AS n FROM word GROUP BY ALL),
total AS (SELECT lang, sum(n) AS n FROM spoken GROUP BY lang),
common AS (
  SELECT lang, word, n FROM spoken QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= {COMMON}),
own AS (SELECT doc_id, lang, lower(word) AS word, count(*) AS n FROM word GROUP BY ALL),
said AS (
  SELECT b.doc_id, b.lang, c.word, coalesce(o.n, 0) AS n, c.n AS m
  FROM base b JOIN common c ON c.lang = b.lang LEFT JOIN own o ON o.doc_id = b.doc_id AND o.word = c.word),
both_words AS (
  SELECT doc_id, lang, n, m FROM said
  UNION ALL
  SELECT s.doc_id, s.lang, any_value(len(b.w)) - sum(s.n), any_value(t.n) - sum(s.m)
  FROM said s JOIN base b ON b.doc_id = s.doc_id JOIN total t ON t.lang = s.lang GROUP BY s.doc_id, s.lang),
classed AS (SELECT doc_id, lang, [{", ".join(counts)}, {rest}, {space}] AS c FROM base{lateral}),
class_rows AS (SELECT doc_id, lang, unnest(c) AS n, unnest(range(len(c))) AS k FROM classed),
class_total AS (SELECT lang, k, sum(n) AS m FROM class_rows GROUP BY lang, k),
histogram AS (
  SELECT 'w' AS kind, doc_id, n, m FROM both_words
  UNION ALL SELECT 'c', r.doc_id, r.n, t.m FROM class_rows r JOIN class_total t ON t.lang = r.lang AND t.k = r.k),
share AS (
  SELECT kind, doc_id, n / nullif(sum(n) OVER x, 0) AS p, m / nullif(sum(m) OVER x, 0) AS q
  FROM histogram WINDOW x AS (PARTITION BY kind, doc_id)),
js AS (
  SELECT kind, doc_id, sqrt(greatest(sum(
    CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
    + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS d
  FROM share GROUP BY kind, doc_id),
measured AS (
  SELECT b.doc_id, len(b.w) AS n_words, length(array_to_string(b.w, '')) AS word_chars,
         length(regexp_replace(b.t0, '[^{SYMBOLS}]', '', 'g')) AS n_symbols, coalesce(s.n, 0) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         CASE WHEN len(b.w) >= {GUARD_WORDS} AND t.n >= {GUARD_REFERENCE_WORDS} THEN jc.d END AS class_distance,
         CASE WHEN len(b.w) >= {GUARD_WORDS} AND t.n >= {GUARD_REFERENCE_WORDS} THEN jw.d END AS word_distance
  FROM base b LEFT JOIN same s ON s.doc_id = b.doc_id LEFT JOIN covered c ON c.doc_id = b.doc_id
  LEFT JOIN total t ON t.lang = b.lang
  LEFT JOIN js jc ON jc.doc_id = b.doc_id AND jc.kind = 'c' LEFT JOIN js jw ON jw.doc_id = b.doc_id AND jw.kind = 'w'),
judged AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(class_distance > {MOST_CLASS_DISTANCE} OR word_distance > {MOST_WORD_DISTANCE}, false) AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM judged
"""


SQL = _sql()
