"""Mixing sources to target weights: Sainte-Lague quotas of equal-token blocks, then seeded blocks.

Sizes are words.  The words of a source are laid out shard by shard, the
documents of a shard in a seeded order, and cut into blocks of ``block_words``.
Highest quotients give each source, and within it each shard, an integer quota
of blocks; a seeded permutation says which blocks of the shard are taken once
more than the others.  No block is taken more than ``max_epochs`` times.

Only one row per source reaches the driver (sources are what the caller names
weights for); shards, documents and blocks stay in Spark.  A shard has about
``shard_words`` words, so a hot source is many shards.

Defined results: null text has size 0 and takes 0; a null source is a source of
its own, last in order; an empty table gives an empty result; rows that repeat
an id are documents of their own; columns not asked for are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from feedloom.llm import arrow
from feedloom.llm import text as tx
from feedloom.session import materialize

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 17
MAX_EPOCHS = 2
SHARE = Fraction(3, 2)
SEED = 7
#: Primes above any number of blocks in a shard: multiplying by one permutes the blocks.
_STEPS = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549, 2147483543, 2147483497)


def cycling_weights(sources: list) -> list[int]:
    return [(3, 1, 2)[i % 3] for i in range(len(sources))]


def capped_shares(total: Fraction, sizes: list[int], weights: list[int], most: int = MAX_EPOCHS) -> list[Fraction]:
    """``total`` by weight; none above ``most`` times its size, what is over shared out again."""
    shares = [Fraction(0)] * len(sizes)
    open_ = [i for i in range(len(sizes)) if weights[i] > 0]
    left = Fraction(total)
    while open_:
        per = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if per * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                shares[i] = per * weights[i]
            break
        for i in over:
            shares[i] = Fraction(most * sizes[i])
            left -= shares[i]
        open_ = [i for i in open_ if i not in set(over)]
    return shares


def sainte_lague(seats: int, weights: list[Fraction]) -> list[int]:
    """Seats by the highest quotients weight / (2 s + 1); ties go to the earlier entry.

    All seats with a quotient above a bound that cannot give too many are given
    at once; the few left are compared one by one.
    """
    whole, n = sum(weights), sum(w > 0 for w in weights)
    if not whole or seats <= 0:
        return [0] * len(weights)
    half = Fraction(1, 2)
    sure = max(Fraction(0), seats - Fraction(n, 2)) / whole
    enough = (seats + Fraction(n, 2) + 1) / whole
    given = [int(w * sure + half) if sure else 0 for w in weights]
    more = sorted((-w / (2 * s + 1), i) for i, w in enumerate(weights) for s in range(given[i], int(w * enough + half)))
    for _, i in more[:seats - sum(given)]:
        given[i] += 1
    return given


def _shard_quotas(shards: DataFrame) -> DataFrame:
    """The same apportionment of each source's ``seats`` to its shards, as a DataFrame."""
    own = Window.partitionBy("m_source")
    sure = F.greatest(F.lit(0.0), F.col("seats") - F.col("n") / 2) / F.col("whole")
    enough = (F.col("seats") + F.col("n") / 2 + 1) / F.col("whole")
    bounds = (shards.where("shard_size > 0")
              .withColumn("n", F.count(F.lit(1)).over(own)).withColumn("whole", F.sum("shard_size").over(own))
              .withColumn("given", F.when(sure > 0, F.floor(F.col("shard_size") * sure + 0.5)).otherwise(0).cast("long"))
              .withColumn("until", F.floor(F.col("shard_size") * enough + 0.5).cast("long"))
              .withColumn("left", F.col("seats") - F.sum("given").over(own)))
    asked = (bounds.where("until > given")
             .withColumn("s", F.explode(F.sequence(F.col("given"), F.col("until") - 1)))
             .withColumn("place", F.row_number().over(
                 own.orderBy((F.col("shard_size") / (2 * F.col("s") + 1)).desc(), "m_shard", "s")))
             .where("place <= left").groupBy("m_source", "m_shard").agg(F.count(F.lit(1)).alias("more")))
    return (bounds.join(asked, ["m_source", "m_shard"], "left")
            .select("m_source", "m_shard", "shard_size", (F.col("given") + F.coalesce("more", F.lit(0))).alias("quota")))


def copies(block: np.ndarray, blocks: np.ndarray, quota: np.ndarray, step: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """How often a block is taken: quota // blocks times, and once more if its seeded place is early."""
    place = (block.astype(np.uint64) * step.astype(np.uint64) + shift.astype(np.uint64)) % blocks.astype(np.uint64)
    return quota // blocks + (place.astype(np.int64) < quota % blocks)


def overlaps(batch: pa.RecordBatch, block_words: int):
    """Per document and block that it touches: row, first and last word (in the document), copies."""
    col = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in
           ("size", "m_start", "m_blocks", "m_quota", "m_step", "m_shift")}
    some = np.flatnonzero(col["size"] > 0)
    start = col["m_start"][some]
    low, high = start // block_words, (start + col["size"][some] - 1) // block_words
    counts = high - low + 1
    begin = np.concatenate([[0], np.cumsum(counts)])
    row = np.repeat(some, counts)
    block = np.repeat(low - begin[:-1], counts) + np.arange(begin[-1])
    at = col["m_start"][row]
    first = np.maximum(block * block_words - at, 0)
    last = np.minimum((block + 1) * block_words - at, col["size"][row])
    return row, first, last, copies(block, *(col[n][row] for n in ("m_blocks", "m_quota", "m_step", "m_shift")))


def row_slices(batch: pa.RecordBatch, block_words: int, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that touch at most ``most`` blocks, or one row."""
    ends = np.cumsum(batch.column("size").to_numpy(zero_copy_only=False) // block_words + 2)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def _taken(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_slices(whole, block_words):
                row, first, last, times = overlaps(batch, block_words)
                taken = np.bincount(row, weights=(last - first) * times, minlength=batch.num_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(taken)], [*batch.schema.names, "taken"])
    return run


def placed_documents(df: DataFrame, id_col: str, text_col: str, source_col: str, carry: list[str],
                     weights: Callable[[list], list[int]], share: Fraction, block_words: int, shard_words: int,
                     max_epochs: int, seed: int, store: bool) -> DataFrame:
    """``carry`` columns, size, source_size, target and the place (m_* columns) of every document."""
    spark = df.sparkSession
    word_count = StructField("size", LongType())

    def maker():
        def make(column: pa.Array) -> list[pa.Array]:
            return [pa.array(np.diff(tx.word_spans(*tx.raw(column))[2]).astype(np.int64))]
        return make

    renamed = df.select(*[F.col(f"`{c}`").alias(f"c_{i}") for i, c in enumerate(carry)],
                        F.col(f"`{id_col}`").alias("m_id"), F.col(f"`{source_col}`").cast("string").alias("m_name"),
                        F.col(f"`{text_col}`").alias("m_text"))
    sized = arrow.with_text_columns(renamed, "m_text", [word_count], maker,
                                    [c for c in renamed.columns if c != "m_text"])
    if store:
        sized = materialize(sized, "mix-sizes")
    found = {r["m_name"]: int(r["s"] or 0) for r in sized.groupBy("m_name").agg(F.sum("size").alias("s")).collect()}
    names = sorted((s for s in found if s is not None)) + [None] * (None in found)
    sizes = [found[s] for s in names]
    targets = capped_shares(share * sum(sizes), sizes, weights(names), max_epochs)
    seats = sainte_lague(int(sum(targets) / block_words + Fraction(1, 2)), targets)
    rows = [(i, s, sizes[i], float(targets[i]), seats[i], max(1, -(-sizes[i] // shard_words)))
            for i, s in enumerate(names)]
    sources = spark.createDataFrame(rows, "m_source int, m_name string, source_size long, target double, seats long, m_shards long")
    seeded = F.xxhash64(F.lit(seed), F.col("m_id").cast("string"))
    dealt = (sized.join(sources, sized["m_name"].eqNullSafe(sources["m_name"])).drop("m_name")
             .withColumn("m_shard", F.pmod(seeded, F.col("m_shards"))))
    shards = dealt.groupBy("m_source", "m_shard", "seats").agg(F.sum("size").alias("shard_size"))
    blocks = F.ceil(F.col("shard_size") / block_words).cast("long")
    plan = (_shard_quotas(shards)
            .withColumn("m_blocks", blocks)
            .withColumn("m_quota", F.least(F.col("quota"), max_epochs * F.col("m_blocks")))
            .withColumn("m_pick", F.xxhash64(F.lit(seed), "m_source", "m_shard"))
            .withColumn("m_step", F.element_at(F.array(*map(F.lit, _STEPS)), (F.pmod("m_pick", F.lit(len(_STEPS))) + 1).cast("int")).cast("long"))
            .withColumn("m_shift", F.pmod(F.shiftright("m_pick", 8), F.col("m_blocks")))
            .drop("shard_size", "quota", "m_pick"))
    order = Window.partitionBy("m_source", "m_shard").orderBy(F.xxhash64(F.lit(seed + 1), F.col("m_id").cast("string")), "m_id", "size")
    laid = dealt.withColumn("m_start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    joined = laid.join(plan, ["m_source", "m_shard"], "left")
    filled = {"m_blocks": 1, "m_quota": 0, "m_step": 1, "m_shift": 0}
    return joined.select(*[c for c in renamed.columns if c.startswith("c_")], "size", "source_size", "target", "m_start",
                         *[F.coalesce(c, F.lit(v).cast("long")).alias(c) for c, v in filled.items()])


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Callable[[list], list[int]] = cycling_weights, share: Fraction = SHARE,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED) -> DataFrame:
    """Per document: id, size, source_size, target (its source's) and taken, the words that the mix
    takes of it, repeats counted.  ``share`` is the mix's size against that of all documents."""
    placed = placed_documents(df, id_col, text_col, source_col, [id_col], weights, share, block_words,
                              shard_words, max_epochs, seed, store=True)
    schema = StructType([*placed.schema.fields, StructField("taken", LongType())])
    return placed.mapInArrow(arrow.giving_back(_taken(block_words)), schema).select(
        F.col("c_0").alias(id_col), "size", "source_size", "target", "taken")


def mixed_texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Callable[[list], list[int]] = cycling_weights, share: Fraction = SHARE,
                block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, max_epochs: int = MAX_EPOCHS,
                seed: int = SEED) -> DataFrame:
    """The mix itself, with the columns of ``df``: a row per document and epoch in which any of its
    blocks is taken, its text cut to those blocks (a block keeps its words and the white space after each)."""
    carry = df.columns
    placed = placed_documents(df, id_col, text_col, source_col, carry, weights, share, block_words,
                              shard_words, max_epochs, seed, store=False)
    kept = [f"c_{i}" for i in range(len(carry))]
    at = carry.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = tx.text_array(whole.column(f"c_{at}"))
            for a, b in tx.slices(texts):
                batch = whole.slice(a, b - a)
                data, offsets = tx.raw(texts.slice(a, b - a))
                starts, _, first = tx.word_spans(data, offsets)
                bounds = np.append(starts, len(data))
                row, low, high, times = overlaps(batch, block_words)
                for epoch in range(max_epochs):
                    on = np.flatnonzero(times > epoch)
                    rows = np.unique(row[on])
                    edges = np.searchsorted(row[on], [rows, rows + 1]) if len(rows) else [[], []]
                    out = []
                    for r, x, y in zip(rows, *edges):
                        end, cut = offsets[r + 1], []
                        for k in on[x:y]:
                            cut.append(data[bounds[first[r] + low[k]]:min(bounds[first[r] + high[k]], end)])
                        out.append(np.concatenate(cut).tobytes())
                    part = batch.take(pa.array(rows, pa.int64())).select(kept)
                    text = pa.array(out, pa.binary()).cast(pa.string()).cast(part.schema.field(at).type)
                    yield part.set_column(at, part.schema.field(at), text)

    result = placed.mapInArrow(arrow.giving_back(run), placed.select(*kept).schema)
    return result.select(*[F.col(f"c_{i}").alias(c) for i, c in enumerate(carry)])
