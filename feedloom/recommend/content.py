"""Content recommender on item texts (D4): cosine of TF-IDF vectors, found through an inverted index.

Terms are lower-cased runs of letters and digits.  weight = tf * idf, idf = ln((1 + N) / (1 + df)) + 1 over N
items with terms, by the vector's length, kept in whole units of 1 / SCALE: similarities are exact integers over
SCALE^2, whatever the order of additions.

Items with the same terms share one vector: pairs are looked for between classes of
equal vectors.  Terms are ordered from rare to common.  Of a vector only so many
terms are indexed that what is left, its most common terms, cannot reach the
threshold with any other vector: neither by its length (Cauchy-Schwarz) nor by the largest weights
that its terms have anywhere (maximum score).  Two vectors that reach the threshold share an
indexed term, so nothing is lost; candidates are then scored in full.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.operators.label import LabelPolicy
from feedloom.operators.scalars import combine_one_row
from feedloom.recommend.item_item import liked
from feedloom.recommend.pairs import BLOCK, pairs_sharing, recommend_by_neighbours
from feedloom.session import materialize

SCALE = 10**6
TERM = r"[\p{L}\p{N}]+"


def item_vectors(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (rep, item_id) of every class of items with equal terms, and vectors (rep, term, df, weight).

    ``items`` has item_id and item_text; an id that repeats counts with its smallest text, null ids and texts without terms are left out."""
    texts = items.where(F.col("item_id").isNotNull()).groupBy("item_id").agg(F.min("item_text").alias("text"))
    terms = F.array_sort(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0)))
    worded = texts.select("item_id", terms.alias("terms")).where(F.size("terms") > 0)
    worded = materialize(worded.select("item_id", "terms", F.xxhash64("terms").alias("h1"), F.xxhash64(F.lit(1), "terms").alias("h2")), "terms")
    reps = worded.groupBy("h1", "h2").agg(F.min("item_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    members = materialize(worded.select("item_id", "h1", "h2").join(reps, ["h1", "h2"]).select("rep", "item_id", "copies"), "members")
    own = members.where(F.col("rep") == F.col("item_id")).select("item_id", "copies")
    counts = worded.join(own, "item_id").select(F.col("item_id").alias("rep"), "copies", F.explode("terms").alias("term"))
    counts = materialize(counts.groupBy("rep", "copies", "term").agg(F.count(F.lit(1)).alias("tf")), "counts")
    df = counts.groupBy("term").agg(F.sum("copies").alias("df"))
    n = members.count()
    idf = F.log((F.lit(1.0) + n) / (F.col("df") + 1.0)) + 1.0
    raw = counts.join(df, "term").select("rep", "term", "df", (F.col("tf") * idf).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("rep")))  # a window over one item's terms
    weight = F.floor(F.col("raw") / length * SCALE).cast("bigint")
    return members.select("rep", "item_id"), materialize(raw.select("rep", "term", "df", weight.alias("weight")), "vectors")


def indexed_terms(vectors: DataFrame, threshold: float) -> DataFrame:
    """(term, rep): of every vector, the terms without which it cannot reach ``threshold`` with any other."""
    most = vectors.groupBy("term").agg(F.max("weight").alias("most"))
    common_first = Window.partitionBy("rep").orderBy(F.desc("df"), F.desc("term")).rowsBetween(Window.unboundedPreceding, 0)
    left = vectors.join(most, "term").select("rep", "term", F.sum(F.col("weight") * F.col("weight")).over(common_first).alias("square"),
                                             F.sum(F.col("weight") * F.col("most")).over(common_first).alias("bound"))
    limit = threshold * SCALE * SCALE
    return left.where((F.col("square") >= limit * threshold * (1 - 1e-12)) & (F.col("bound") >= limit * (1 - 1e-12))).select("term", "rep")


def similar_vectors(vectors: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """(i, j, dot), i < j: all pairs of vectors with a product of at least threshold * SCALE^2."""
    candidates = materialize(pairs_sharing(indexed_terms(vectors, threshold), "term", "rep", block).select("i", "j").distinct(), "candidates")
    first = vectors.select(F.col("rep").alias("i"), "term", F.col("weight").alias("a"))
    second = vectors.select(F.col("rep").alias("j"), "term", F.col("weight").alias("b"))
    scored = candidates.join(first, "i").join(second, ["j", "term"]).groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("dot"))
    return scored.where(F.col("dot") >= threshold * SCALE * SCALE)


def content_neighbours(items: DataFrame, neighbours: int = 20, threshold: float = 0.3, block: int = BLOCK) -> DataFrame:
    """(item_id, other_id, similarity, rank): of every item, the ``neighbours`` others with the largest cosine of
    at least ``threshold``, ties by id; exact."""
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    members, vectors = item_vectors(items)
    pairs = materialize(similar_vectors(vectors, threshold, block), "similar")
    square = F.sum(F.col("weight") * F.col("weight"))
    alike = vectors.groupBy("rep").agg(square.alias("dot")).where(F.col("dot") >= threshold * SCALE * SCALE)
    ways = [pairs.select(F.col(a).alias("rep"), F.col(b).alias("other"), "dot") for a, b in (("i", "j"), ("j", "i"))]
    ways.append(alike.select("rep", F.col("rep").alias("other"), "dot"))  # copies of the item itself
    # a class's smallest id is its rep: no list needs more classes, in this order, than it has items
    nearest = Window.partitionBy("rep").orderBy(F.desc("dot"), "other")
    near = ways[0].unionByName(ways[1]).unionByName(ways[2])
    near = near.select("*", F.row_number().over(nearest).alias("nth")).where(F.col("nth") <= neighbours + 1).drop("nth")
    # nor reaches further into a class than its first members by id; one more, as an item may meet itself
    by_id = Window.partitionBy("rep").orderBy("item_id")
    heads = members.select("rep", "item_id", F.row_number().over(by_id).alias("nth")).where(F.col("nth") <= neighbours + 1)
    met = near.join(heads.select(F.col("rep").alias("other"), F.col("item_id").alias("other_id")), "other")
    listed = Window.partitionBy("rep").orderBy(F.desc("dot"), "other_id")
    met = met.select("rep", "other_id", "dot", F.row_number().over(listed).alias("nth")).where(F.col("nth") <= neighbours + 1)
    # one ordered list a class, which each of its members reads without itself
    lists = materialize(met.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("nth", "other_id", "dot"))).alias("list")), "lists")
    others = F.slice(F.filter("list", lambda x: x["other_id"] != F.col("item_id")), 1, neighbours)
    own = members.join(lists, "rep").select("item_id", F.posexplode(others).alias("at", "other"))
    return own.select("item_id", "other.other_id", (F.col("other.dot") / (SCALE * SCALE)).alias("similarity"), (F.col("at") + 1).alias("rank"))


def recommend_by_content(train: DataFrame, items: DataFrame, users: DataFrame, k: int = 10, neighbours: int = 20, threshold: float = 0.3,
                         policy: LabelPolicy = LabelPolicy()) -> DataFrame:
    """(user_id, item_id, rank, score) by the texts of what a user likes; items that nobody has met are
    candidates like all others."""
    likes = materialize(liked(train, policy), "liked")
    near = materialize(content_neighbours(items, neighbours, threshold), "content")
    return recommend_by_neighbours(likes, near, train, users, k)


def index_reach(vectors: DataFrame, threshold: float) -> DataFrame:
    """One row: entries of all vectors and those that the index needs."""
    return combine_one_row(vectors.agg(F.count(F.lit(1)).alias("entries")), indexed_terms(vectors, threshold).agg(F.count(F.lit(1)).alias("indexed")))
