"""Operator 5: line de-duplication by overlapping three-line windows.

Every window of three consecutive lines gets a 128-bit hash.  Windows that occur
more than once in the corpus are found by one aggregation, their later
occurrences by a join, and the lines that those cover, merged per document, go.
Of every removed line with a word one that is equal, but for outer white space,
stays in an earlier place.  Whole texts are moved to their removed lines only if
they can lose any; the others are told by a broadcast table of marks and stay
where they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baobab.llm.common import SPACES, cut

#: Lines of a window.
WINDOW = 3
#: First bits of a hash that name its word of 64 marks: at most 2^19 words, 21 MB when nearly all are set, are broadcast.
MARK_BITS = 19


def pieces(text: Column) -> Column:
    """The lines of a text with their line ends, so that joined they give the text."""
    return F.split(text, "(?<=\n)")


def windows(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """``rows`` (id, tk, text) to one row per window: id, tk, a, b (its hash),
    first and last (positions of its outer lines).  Lines without a word are
    passed over; outer white space does not count.  Fewer lines: no window."""
    lines = F.filter(
        F.transform(pieces(F.col("text")), lambda x, i: F.struct(i.alias("at"), F.btrim(x, F.lit(SPACES)).alias("line"))),
        lambda x: x["line"] != "",
    )
    hashed = F.transform(
        lines,
        lambda x: F.struct(
            x["at"].alias("at"), F.xxhash64(x["line"]).alias("a"), F.xxhash64(F.lit(7919), x["line"]).alias("b")
        ),
    )

    def window(i: Column) -> Column:
        part = [F.get(F.col("lines"), i + k) for k in range(size)]
        return F.struct(
            F.xxhash64(*(p["a"] for p in part)).alias("a"),
            F.xxhash64(F.lit(7919), *(p["b"] for p in part)).alias("b"),
            part[0]["at"].alias("first"),
            part[-1]["at"].alias("last"),
        )

    return (
        rows.select("id", "tk", hashed.alias("lines"))
        .where(F.size("lines") >= size)
        .select("id", "tk", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - size), window)).alias("w"))
        .select("id", "tk", "w.*")
    )


def repeated_lines(rows: DataFrame, size: int = WINDOW) -> DataFrame:
    """Columns id, tk and removed (positions of the lines that go), for the rows that lose any."""
    every = cut(windows(rows, size))
    here = F.struct("id", "tk", "first")
    # a window of a third of all rows is one partial sum per task here, and split by Spark in the join
    firsts = cut(
        every.groupBy("a", "b").agg(F.min(here).alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    later = every.join(firsts, ["a", "b"]).where(~here.eqNullSafe(F.col("origin")))
    return (
        later.select("id", "tk", F.explode(F.sequence("first", "last")).alias("at"))
        .groupBy("id", "tk")
        .agg(F.collect_set("at").alias("removed"))
    )


def parted(rows: DataFrame, keys: DataFrame, key: str, mark_bits: int = MARK_BITS) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose 64-bit hash ``key`` may be one of ``keys``, and all other rows.

    A hash sets one bit of one word; a row whose bit is not set has surely no such
    hash.  The words that a broadcast holds do not grow with the table: of very
    many hashes more rows are in the first part, none of them wrongly in the second."""

    def word(h: Column) -> Column:
        return F.shiftrightunsigned(h, 64 - mark_bits)

    def bit(h: Column) -> Column:
        return h.bitwiseAND(F.lit(63)).cast("int")

    mark = F.call_function("shiftleft", F.lit(1).cast("long"), bit(F.col(key)))
    words = keys.groupBy(word(F.col(key)).alias("__word")).agg(F.bit_or(mark).alias("__marks"))
    marked = rows.join(F.broadcast(words), word(F.col(key)) == F.col("__word"), "left")
    may = F.coalesce(F.getbit("__marks", bit(F.col(key))) == 1, F.lit(False))
    return tuple(marked.where(w).drop("__word", "__marks") for w in (may, ~may))


def dedup_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = WINDOW,
    lines_col: str = "n_lines",
    removed_col: str = "n_removed",
) -> DataFrame:
    """``docs`` with all its columns, the text without the lines that repeat, and
    ``lines_col`` (its lines with a word) and ``removed_col`` (how many went).

    The first occurrence of a window is the one of the smallest id (a null id
    before any other), then of the smallest place; it stays, later ones go, also
    within one document, where two occurrences may overlap.  Lines without a word
    go only inside a removed window.  Rows of one id and one text are one document
    and keep the same lines.  Null and empty texts stay as they are with 0 lines;
    a text may become empty.  An empty table gives an empty result.  Columns of
    ``docs`` with the names of the two counts are replaced; choose other names to
    keep them.  ``docs`` is read three times, so it has the same rows each time."""
    keyed = docs.withColumn("__l_id", F.col(id_col)).withColumn("__l_tk", F.xxhash64(text_col))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tk"), F.col(text_col).alias("text"))
    gone = cut(repeated_lines(rows.where("text is not null"), size)).select(
        F.col("id").alias("__l_id2"), F.col("tk").alias("__l_tk2"), F.col("removed").alias("__l_removed")
    )
    losing, whole = parted(keyed, gone.select(F.col("__l_tk2").alias("__l_tk")), "__l_tk")
    joined = losing.join(
        gone, F.col("__l_id").eqNullSafe(F.col("__l_id2")) & (F.col("__l_tk") == F.col("__l_tk2")), "left"
    ).drop("__l_id2", "__l_tk2")
    nothing = F.lit(None).cast(gone.schema["__l_removed"].dataType)
    joined = joined.union(whole.withColumn("__l_removed", nothing)).withColumn("__l_pieces", pieces(F.col(text_col)))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__l_pieces") - 1), "__l_removed")
    text = F.array_join(F.transform(kept, lambda i: F.get(F.col("__l_pieces"), i)), "")
    n_lines = F.size(F.filter("__l_pieces", lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    return (
        joined.withColumns(
            {
                text_col: F.when(F.col("__l_removed").isNull(), F.col(text_col)).otherwise(text),
                lines_col: F.coalesce(F.when(F.col("__l_pieces").isNotNull(), n_lines), F.lit(0)).cast("long"),
                removed_col: F.when(F.col("__l_removed").isNull(), 0).otherwise(F.size("__l_removed")).cast("long"),
            }
        )
        .drop("__l_id", "__l_tk", "__l_removed", "__l_pieces")
    )


#: DuckDB SQL for the query's rows, on the texts of the windows instead of hashes.
SQL = r"""
WITH piece AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos, len(string_split(text, chr(10))) AS n
  FROM documents WHERE text IS NOT NULL),
line AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS l FROM piece),
word AS (
  SELECT doc_id, pos, l, lead(l, 1) OVER w AS l2, lead(l, 2) OVER w AS l3, lead(pos, 2) OVER w AS upto
  FROM line WHERE l <> '' WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos, upto, row_number() OVER (PARTITION BY l, l2, l3 ORDER BY doc_id, pos) AS nth
  FROM word WHERE l3 IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, upto + 1)) AS pos FROM later WHERE nth > 1),
kept AS (
  SELECT p.doc_id, count(*) FILTER (WHERE g.pos IS NOT NULL) AS n_removed,
         coalesce(string_agg(p.line || CASE WHEN p.pos < p.n - 1 THEN chr(10) ELSE '' END, '' ORDER BY p.pos)
                  FILTER (WHERE g.pos IS NULL), '') AS text
  FROM piece p LEFT JOIN gone g ON g.doc_id = p.doc_id AND g.pos = p.pos GROUP BY p.doc_id),
many AS (SELECT doc_id, count(*) AS n_lines FROM line WHERE l <> '' GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(m.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CASE WHEN d.text IS NULL THEN NULL ELSE k.text END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id LEFT JOIN many m ON m.doc_id = d.doc_id
"""
