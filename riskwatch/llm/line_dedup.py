"""Line dedup over windows of three consecutive lines.

A window's first occurrence in the corpus, by document id and place, stays; the
lines that any later occurrence covers go. Overlapping later occurrences are
merged, so a repeated passage of three lines or more goes whole. The first
occurrence of a line is never covered: every line of the corpus stays somewhere.

Windows are compared by two 64-bit hashes of their lines. Only the first place
of each repeated window is kept for the second pass, so the join that finds later
occurrences reads light rows, and its hot windows can be split.

Defined results: lines are split at line feeds and compared as they are. Texts
of fewer than three lines have no window and stay whole; a null text stays null;
a text whose lines all go is empty. Null document ids come first in order. Rows
with one document id are ordered by a hash of their text; rows that repeat both
share what happens to the first. Windows may overlap themselves: in a line
repeated five times the first line stays. Other columns stay as they are,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import col

WINDOW = 3


def _windows(docs: DataFrame) -> DataFrame:
    lines = docs.select("k", "h", "lines").where(F.size("lines") >= WINDOW)
    # the lines at i, i + 1 and i + 2 side by side; the last two are filled up with nulls and left out
    beside = F.arrays_zip("lines", F.slice("lines", 2, F.size("lines")), F.slice("lines", 3, F.size("lines")))
    found = lines.select("k", "h", F.size("lines").alias("n"), F.posexplode(beside).alias("pos", "w"))
    found = found.where(F.col("pos") <= F.col("n") - WINDOW)
    return found.select(F.xxhash64("w").alias("w1"), F.xxhash64(F.lit(1), "w").alias("w2"),
                        F.struct("k", "h", "pos").alias("at"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row (all columns of ``df`` as they are), text, n_lines, n_removed."""
    text = col(text_col).cast("string")
    docs = df.select(F.struct("*").alias("row"), col(id_col).alias("k"), F.xxhash64(text).alias("h"),
                     F.split(text, "\n").alias("lines"))
    repeated = (_windows(docs).groupBy("w1", "w2").agg(F.min("at").alias("first"), F.count("*").alias("n"))
                .where("n > 1").drop("n"))
    repeated = materialize(repeated, "windows")
    later = _windows(docs).join(repeated, ["w1", "w2"]).where(~F.col("at").eqNullSafe(F.col("first")))
    covered = (later.select("at.*").groupBy("k", "h").agg(F.collect_set("pos").alias("starts"))
               .select(F.col("k").alias("k2"), F.col("h").alias("h2"), "starts"))
    found = docs.join(covered, F.col("k").eqNullSafe(F.col("k2")) & (F.col("h") == F.col("h2")), "left")
    hit = F.flatten(F.transform("starts", lambda x: F.sequence(x, x + (WINDOW - 1))))
    found = found.select("row", "lines", "starts", F.array_distinct(hit).alias("hit"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    found = found.select("row", "lines", "starts", "hit", F.array_except(places, "hit").alias("stay"))
    kept = F.array_join(F.transform("stay", lambda i: F.get("lines", i)), "\n")
    return found.select(
        "row",
        F.when(F.col("starts").isNull(), F.array_join("lines", "\n")).otherwise(kept).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.array_size("hit"), F.lit(0)).cast("long").alias("n_removed"))


ORACLE_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos, len(l) AS n
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), win AS (
    SELECT doc_id, pos, n, line, lead(line) OVER d AS line2, lead(line, 2) OVER d AS line3
    FROM lines WINDOW d AS (PARTITION BY doc_id ORDER BY pos)
), ranked AS (
    SELECT doc_id, pos, row_number() OVER (PARTITION BY line, line2, line3 ORDER BY doc_id, pos) AS r
    FROM win WHERE pos + 2 < n
), covered AS (
    SELECT DISTINCT doc_id, pos + i AS pos FROM ranked, range(3) t(i) WHERE r > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(c.pos) AS n_removed,
       coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (c.pos IS NULL), '') AS text
FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos
GROUP BY l.doc_id
"""
