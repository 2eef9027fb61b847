"""Line dedup: lines that many documents hold are dropped from all but one of them.

A text is split at newlines.  A line's key is the line without white space (space
and 0x09-0x0D) at both ends and with A-Z lower-cased.  Keys of at least
``least_points`` code points that at least ``least_documents`` distinct documents
hold lose all their lines except in the document with the largest id among them.
The other lines stay, as they are and in their order.

All steps are DataFrame functions.  Lines are exploded to two hashes (128 bits), an
id and a position; texts of lines are never shuffled one by one.  Distinct
documents are counted per hash by partial aggregates, the few hashes over the
threshold meet their lines in a merge join, whose hot keys adaptive execution
splits, and each text meets the positions that it loses, from which it is put
together again.

Defined results: null and empty texts are one empty line; a repeated id is one
document, whatever its rows hold, so that lines of the document that keeps them
stay in all its rows; rows with a null id are one document below all others;
columns of any name may be carried; an empty table gives an empty table.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.session import materialize

SPACE = " \t\n\x0b\x0c\r"
LEAST_POINTS = 20
LEAST_DOCUMENTS = 3


def _lower(text: Column) -> Column:
    """A-Z in lower case; where all is ASCII, ``lower`` does the same faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _lines(docs: DataFrame, least_points: int) -> DataFrame:
    """(id, print, pos, h1, h2) of every line whose key is long enough."""
    lines = docs.select("id", "print", F.posexplode("lines").alias("pos", "line"))
    bare = lines.select("id", "print", "pos", F.btrim("line", F.lit(SPACE)).alias("bare"))
    keyed = bare.where(F.length("bare") >= least_points).select("id", "print", "pos", _lower(F.col("bare")).alias("key"))
    return keyed.select("id", "print", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def shared_keys(lines: DataFrame, least_documents: int) -> DataFrame:
    """(h1, h2, keeper) of the keys that at least so many distinct documents hold."""
    counts = lines.groupBy("h1", "h2").agg(F.count_distinct(F.struct("id")).alias("n"), F.max("id").alias("keeper"))
    return counts.where(F.col("n") >= least_documents).select("h1", "h2", "keeper")


def drop_shared_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
                      least_points: int = LEAST_POINTS, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """Per row of ``df``: ``carry`` columns (default: the id), the text without its dropped lines
    (under ``text_col``), ``n_lines`` before dropping and ``n_dropped``."""
    if least_documents < 2:
        raise ValueError("least_documents must be at least 2")
    kept = [c for c in ([id_col] if carry is None else carry) if c not in (text_col, "n_lines", "n_dropped")]
    names = [f"c_{i}" for i in range(len(kept))]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("print"), F.split(text, "\n", -1).alias("lines"),
                     *[F.col(f"`{c}`").alias(n) for c, n in zip(kept, names)])
    lines = _lines(docs, least_points)
    shared = materialize(shared_keys(lines, least_documents), "shared-lines")  # both sides of the join are dealt anew: hot keys can be split
    lost = (lines.join(shared.hint("merge"), ["h1", "h2"]).where(~F.col("id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("id").alias("l_id"), F.col("print").alias("l_print")).agg(F.collect_set("pos").alias("drops")))
    whole = docs.join(lost.hint("merge"), F.col("id").eqNullSafe(F.col("l_id")) & (F.col("print") == F.col("l_print")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    left = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.transform(stay, lambda i: F.get("lines", i)))
    return whole.select(*[F.col(n).alias(c) for c, n in zip(kept, names)], F.array_join(left, "\n").alias(text_col),
                        F.size("lines").cast("long").alias("n_lines"),
                        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"))
