"""N-gram Jaccard join: count-vector R-trees over candidate clusters, exact and without all pairs.

1. *Shared shingles.*  A document links only if enough of its distinct shingles
   occur in another document.  Shingle hashes go packed to buckets (a hash that
   a slice of texts holds several times goes once), buckets answer which are
   shared, and documents that cannot reach the threshold leave.
2. *Classes.*  Equal sets are one class with its least id.
3. *Clusters.*  The shingles of the remaining classes are counted (packed as in
   step 1).  Classes that share one of their rarest shingles (enough that a
   linked pair shares one) are joined by edges; edges of short runs must also
   pass the count-vector bound.  Components of the edges are clusters: linked
   classes always lie in one.
4. *R-tree.*  Within a cluster token hashes fall into groups, group counts are
   the points of a packed R-tree, the sum of coordinate minima with a node's box
   bounds the overlap with all below it, and surviving pairs are verified on the
   sets unless they are connected already.  Clusters of many classes are blocks;
   blocks that turn out to be one component are not compared again.

Result and bounds hold for any size: there is no cap on candidates.  Defined
results: null, empty and word-less texts have an empty set and link with
nothing; fewer words than a shingle are one shingle; a null id gets a null
component; rows that repeat an id are documents that share its node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import arrow
from feedloom.llm import text as tx
from feedloom.llm.components import components
from feedloom.session import materialize

WORDS = 5
PERCENT = 80
BUCKET_ROWS = 1 << 20  # shingles in a bucket, about
SLICE_BYTES = 4 << 20
SLICE_SHINGLES = 1 << 20
SHORT_RUN = 16
BLOCK_CLASSES = 1024
BLOCK_SHINGLES = 1 << 20
FANOUT = 16
_NOBODY = 0xFFFF
_DOC = np.uint64(0x9E3779B97F4A7C15)


# --- sets ------------------------------------------------------------------------

def shingle_sets(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each text, and the first of each text (one more entry).

    A-Z are lower-cased.  A text with fewer words than a shingle has its whole sequence as one.  Words
    are hashed a small slice at a time: what that takes is many times the text."""
    parts = [_shingles(column.slice(a, b - a), words) for a, b in tx.slices(column)]
    sizes = np.concatenate([np.zeros(1, np.int64), *(np.diff(begin) for _, begin in parts)])
    return np.concatenate([np.zeros(0, np.uint64), *(grams for grams, _ in parts)]), np.cumsum(sizes)


def _shingles(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = tx.raw(column)
    data = tx.lower(data)
    starts, ends, first = tx.word_spans(data, offsets)
    hashes = tx.word_hashes(data, starts, ends)
    counts = np.diff(first)
    grams, begin = tx.gram_hashes(hashes, first, words)
    doc = np.repeat(np.arange(len(counts)), np.diff(begin))
    for n in range(1, words):
        short = np.flatnonzero(counts == n)
        if len(short):
            sums = np.zeros(len(short), np.uint64)
            for k in range(n):
                sums = tx.mix(sums * _DOC + hashes[first[short] + k])
            grams, doc = np.concatenate([grams, tx.mix(sums + np.uint64(n))]), np.concatenate([doc, short])
    order = np.lexsort((grams, doc))
    grams, doc = grams[order], doc[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
    grams, doc = grams[new], doc[new]
    return grams, np.searchsorted(doc, np.arange(len(counts) + 1))


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[begin[1:]] - total[begin[:-1]]


# --- 1. shared shingles ------------------------------------------------------------

_ASKED = pa.schema([("bucket", pa.int64()), ("slice", pa.int64()), ("values", pa.binary()), ("docs", pa.binary()),
                    ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("known", pa.binary()), ("prints", pa.binary())])
_ASKED_SQL = "bucket long, slice long, values binary, docs binary, ids array<long>, sizes binary, known binary, prints binary"
_TOLD_SQL = "slice long, docs binary, ids array<long>, sizes binary, known binary, prints binary"
_PROFILE_SQL = "id long, n long, print1 long, print2 long, survives boolean"


def _ask(buckets: int, words: int):
    """Per slice of texts: a row for each bucket, with hashes and the document that asks about each,
    and a row with what is known of the documents (under a bucket number of its own)."""
    def rows(ids: pa.Array, column: pa.Array, number: int) -> Iterator[dict]:
        grams, begin = shingle_sets(column, words)
        doc = np.repeat(np.arange(len(column)), np.diff(begin))
        order = np.argsort(grams, kind="stable")
        sorted_ = grams[order]
        same = sorted_[1:] == sorted_[:-1]
        again = np.zeros(len(grams), bool)  # held by several documents of this slice
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        later = np.zeros(len(grams), bool)
        later[order[1:][same]] = True
        known = np.bincount(doc[again], minlength=len(column))
        asker = np.where(again, _NOBODY, doc)[~later].astype(np.uint16)
        hashes = grams[~later]
        bucket = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        values = (hashes >> np.uint64(32)).astype(np.uint32)
        by = np.lexsort((asker, bucket))
        bucket, values, asker = bucket[by], values[by], asker[by]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        none = dict.fromkeys(_ASKED.names)
        for a, b in zip(cuts, [*cuts[1:], len(bucket)]):
            yield {**none, "bucket": int(bucket[a]), "slice": number, "values": values[a:b].tobytes(),
                   "docs": asker[a:b].tobytes()}
        prints = np.stack([_sums(tx.mix(grams + np.uint64(k)), begin) for k in (1, 2)])
        yield {**none, "bucket": -1 - number, "slice": number, "ids": ids.to_pylist(), "sizes": np.diff(begin).tobytes(),
               "known": known.tobytes(), "prints": prints.tobytes()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            column = tx.text_array(batch.column(1))
            for a, b in tx.slices(column, SLICE_BYTES):
                for x in range(a, b, _NOBODY):
                    y = min(b, x + _NOBODY)
                    yield pa.RecordBatch.from_pylist(list(rows(batch.column(0).slice(x, y - x), column.slice(x, y - x), number)), _ASKED)
                    number += 1
    return run


def _answer(table: pa.Table) -> pa.Table:
    """A bucket: per slice the documents that asked about a hash that is there twice or more."""
    head = table.select(["slice", "docs", "ids", "sizes", "known", "prints"])
    if table["bucket"][0].as_py() < 0:
        return head
    parts = [np.frombuffer(v, np.uint32) for v in table["values"].to_pylist()]
    values = np.concatenate(parts)
    asker = np.frombuffer(b"".join(table["docs"].to_pylist()), np.uint16)
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    shared = np.zeros(len(values), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    shared &= asker != _NOBODY
    cuts = np.cumsum([0, *map(len, parts)])
    docs = [asker[a:b][shared[a:b]].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
    out = head.set_column(1, "docs", pa.array(docs, pa.binary()))
    return out.filter(pa.array([bool(d) for d in docs]))


def _tally(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        sizes, shared = np.frombuffer(head["sizes"], np.int64), np.frombuffer(head["known"], np.int64)
        docs = np.frombuffer(b"".join(r["docs"] for r in rows if r["ids"] is None), np.uint16)
        shared = shared + np.bincount(docs, minlength=len(sizes))
        prints = np.frombuffer(head["prints"], np.uint64).reshape(2, -1).view(np.int64)
        return pa.table({"id": pa.array(head["ids"], pa.int64()), "n": sizes, "print1": prints[0], "print2": prints[1],
                         "survives": (sizes > 0) & (100 * shared >= percent * sizes)})
    return run


def profiles(df: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Per document: id, set size, fingerprint of the set, and whether it can link at all."""
    own = _texts(df, id_col, text_col)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, size // 6 // BUCKET_ROWS)  # some six bytes a word
    asked = own.mapInArrow(arrow.giving_back(_ask(buckets, words)), _ASKED_SQL)
    told = asked.groupBy("bucket").applyInArrow(arrow.giving_back_groups(_answer), _TOLD_SQL)
    return materialize(told.groupBy("slice").applyInArrow(arrow.giving_back_groups(_tally(percent)), _PROFILE_SQL), "shingle-profiles")


# --- 3. clusters -------------------------------------------------------------------

def groups_for(n: int) -> int:
    """Number of token groups of a set: a power of two in proportion to its size, so that the counts of
    unrelated sets differ by more than linked ones may."""
    return 1 << max(5, int(n // 16).bit_length())


def count_vector(hashes: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((hashes >> np.uint64(20)) & np.uint64(groups - 1), minlength=groups)


def fold(vector: np.ndarray, groups: int) -> np.ndarray:
    """The count vector over fewer groups: group numbers are taken modulo a power of two."""
    return vector.reshape(-1, groups).sum(axis=0)


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = tx.text_array(batch.column(1))
            for a, b in tx.slices(column):
                grams, begin = shingle_sets(column.slice(a, b - a), words)
                hashes, vector = [], []
                for x, y in zip(begin[:-1], begin[1:]):
                    hashes.append(grams[x:y].tobytes())
                    vector.append(count_vector(grams[x:y], groups_for(int(y - x))).astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(begin).astype(np.int64)),
                     pa.array(hashes, pa.binary()), pa.array(vector, pa.binary())], ["rep", "n", "hashes", "vector"])
    return run


_COUNTED = pa.schema([("bucket", pa.int64()), ("slice", pa.int64()), ("values", pa.binary()), ("reps", pa.binary()), ("sizes", pa.binary())])
_COUNTED_SQL = "bucket long, slice long, values binary, reps binary, sizes binary"


def _ask_counts(buckets: int):
    """Per slice of sets: a row for each bucket with part of each hash, and one with the sets themselves."""
    def rows(reps: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, number: int) -> list[dict]:
        bucket = ((hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        values, bucket = (hashes[by] >> np.uint64(32)).astype(np.uint32), bucket[by]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        none = dict.fromkeys(_COUNTED.names)
        out = [{**none, "bucket": int(bucket[a]), "slice": number, "values": values[a:b].tobytes()}
               for a, b in zip(cuts, [*cuts[1:], len(bucket)])]
        out.append({**none, "bucket": -1 - number, "slice": number, "values": hashes.tobytes(), "reps": reps.tobytes(), "sizes": sizes.tobytes()})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            reps, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            ends, at = np.cumsum(sizes), 0
            while at < len(reps):
                to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_SHINGLES, "right"))
                to = min(max(to, at + 1), len(reps))
                hashes = np.frombuffer(b"".join(batch.column(2).slice(at, to - at).to_pylist()), np.uint64)
                yield pa.RecordBatch.from_pylist(rows(reps[at:to], sizes[at:to], hashes, number), _COUNTED)
                at, number = to, number + 1
    return run


def _answer_counts(table: pa.Table) -> pa.Table:
    """A bucket: in place of each hash how many classes hold it, up to 255."""
    if table["bucket"][0].as_py() < 0:
        return table
    parts = [np.frombuffer(v, np.uint32) for v in table["values"].to_pylist()]
    _, at, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    held = np.minimum(count, 255).astype(np.uint8)[at]
    cuts = np.cumsum([0, *map(len, parts)])
    return table.set_column(2, "values", pa.array([held[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()))


def _rarest(buckets: int, percent: int):
    """A slice: of each class the rarest shingles, so many that a linked pair shares one of them.  Those that no
    other class holds are among them but join nothing, and are left out."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        head = next(r for r in rows if r["reps"] is not None)
        reps, sizes, hashes = (np.frombuffer(head[c], t) for c, t in (("reps", np.int64), ("sizes", np.int64), ("values", np.uint64)))
        held = np.empty(len(hashes), np.uint8)
        bucket = (hashes & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
        held[np.argsort(bucket, kind="stable")] = np.frombuffer(b"".join(r["values"] for r in rows if r["reps"] is None), np.uint8)
        of = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((hashes, held, of))  # rarest first; of equals by hash: one order for all classes
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(hashes)) - first[of]
        prefix = sizes - -(-percent * sizes // 100) + 1
        take = order[(place < prefix[of]) & (held[order] > 1)]
        return pa.table({"key": hashes[take].view(np.int64), "rep": reps[of[take]], "n": sizes[of[take]]})
    return run


def _edges(percent: int):
    """Over rows (key, rep, n) sorted by key: edges of each run of equal keys.  Short runs give the pairs
    whose sizes allow a link; long ones are chained through their first row, unchecked."""
    def pairs(rep: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i, j = np.triu_indices(len(rep), 1)
        low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        good = (100 * low >= percent * high) & (rep[i] != rep[j])
        return rep[i[good]], rep[j[good]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last run of a batch may go on in the next; its first row stands for a long one
        for batch in _ended(batches):
            out = []
            if batch is not None:
                key, rep, n = (batch.column(i).to_numpy() for i in range(3))
                if held is not None:
                    key, rep, n = (np.concatenate(x) for x in zip(held, (key, rep, n)))
            elif held is not None:
                key, rep, n = held
            else:
                return
            cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                last = b == len(key) and batch is not None
                if last and b - a <= SHORT_RUN:
                    continue
                if b - a > SHORT_RUN:
                    out.append((np.full(b - a - 1, rep[a]), rep[a + 1:b], False))
                elif b - a > 1:
                    out.append((*pairs(rep[a:b], n[a:b]), True))
            if batch is not None:
                a = cuts[-2] if len(cuts) > 1 else 0
                keep = slice(a, len(key)) if len(key) - a <= SHORT_RUN else np.append(np.full(SHORT_RUN, a), len(key) - 1)
                held = key[keep], rep[keep], n[keep]
            if out:
                u, v = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
                check = np.concatenate([np.full(len(x[0]), x[2]) for x in out])
                some = u != v
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(u, v)[some]), pa.array(np.maximum(u, v)[some]), pa.array(check[some])], ["u", "v", "check"])
    return run


def _ended(batches: Iterator) -> Iterator:
    yield from (b for b in batches if b.num_rows)
    yield None


def _bounded(percent: int):
    """Keep checked edges whose count vectors allow a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row in batch.select(["check", "n1", "n2", "vector1", "vector2"]).to_pylist():
                if row["check"]:
                    a, b = np.frombuffer(row["vector1"], np.uint32), np.frombuffer(row["vector2"], np.uint32)
                    groups = min(len(a), len(b))
                    most = int(np.minimum(fold(a, groups), fold(b, groups)).sum())
                    keep.append((100 + percent) * most >= percent * (row["n1"] + row["n2"]))
                else:
                    keep.append(True)
            yield batch.select(["u", "v"]).filter(pa.array(keep))
    return run


# --- 4. R-tree ------------------------------------------------------------------

class CountTree:
    """A packed R-tree over count vectors: per node the greatest counts and the least set size below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.levels = [(points, sizes)]
        while len(self.levels[-1][0]) > 1:
            boxes, least = self.levels[-1]
            cuts = np.arange(0, len(boxes), FANOUT)
            self.levels.append((np.maximum.reduceat(boxes, cuts), np.minimum.reduceat(least, cuts)))

    def reachable(self, point: np.ndarray, size: int, percent: int) -> np.ndarray:
        """Points whose overlap with ``point`` may suffice, by the summed coordinate minima from the root down."""
        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            boxes, least = self.levels[depth]
            most = np.minimum(boxes[at], point).sum(axis=1, dtype=np.int64)
            at = at[((100 + percent) * most >= percent * (least[at] + size)) & (least[at] <= size)]
            if not depth or not len(at):
                return at
            below = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            at = below[below < len(self.levels[depth - 1][0])]
        return at


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def linked_forest(sets: list[np.ndarray], part: np.ndarray, side: np.ndarray, cross: bool, percent: int) -> list[tuple[int, int]]:
    """Links that connect the parts of a block.  ``part`` numbers what is connected already; with
    ``cross`` only rows of different sides are compared."""
    sizes = np.array([len(s) for s in sets], np.int64)
    groups = groups_for(int(np.median(sizes)))
    order = np.argsort([int(s[0]) for s in sets], kind="stable")  # near copies mostly share their least hash
    vectors = np.stack([count_vector(sets[i], groups) for i in order]).astype(np.int32)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    tree = CountTree(vectors, sizes[order])
    part, links = part.copy(), []
    for q in range(len(sets)):
        found = order[tree.reachable(vectors[place[q]], int(sizes[q]), percent)]
        found = found[(100 * sizes[found] >= percent * sizes[q])  # the larger of a pair asks for the smaller
                      & ((sizes[found] < sizes[q]) | ((sizes[found] == sizes[q]) & (found < q)))]
        if cross:
            found = found[side[found] != side[q]]
        while True:
            found = found[part[found] != part[q]]
            if not len(found):
                break
            p, found = found[0], found[1:]
            if (100 + percent) * _overlap(sets[p], sets[q]) >= percent * (sizes[p] + sizes[q]):
                links.append((int(p), int(q)))
                part[part == part[p]] = part[q]
    return links


def _verify(percent: int):
    def run(table: pa.Table) -> pa.Table:
        rep = table["rep"].to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in table["hashes"].to_pylist()]
        _, part = np.unique(table["part"].to_numpy(), return_inverse=True)
        side = table["block"].to_numpy()
        links = linked_forest(sets, part, side, table["first"][0].as_py() != table["second"][0].as_py(), percent)
        u, v = (np.array(x, np.int64) for x in (zip(*links) if links else ((), ())))
        return pa.table({"u": rep[u], "v": rep[v]})
    return run


_TILE = ["cluster", "first", "second", "block", "rep", "part", "hashes"]


def _verified(tiles: DataFrame, percent: int) -> DataFrame:
    return tiles.select(*_TILE).groupBy("cluster", "first", "second").applyInArrow(arrow.giving_back_groups(_verify(percent)), "u long, v long")


def _blocks(weights: DataFrame, keys: list[str]) -> DataFrame:
    """Number of blocks for each group, by its classes and its shingles."""
    return weights.groupBy(*keys).agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_CLASSES),
                                                 F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"),
                                      F.count(F.lit(1)).alias("classes"))


def cluster_links(members: DataFrame, percent: int) -> DataFrame:
    """``members`` (cluster, rep, n, hashes) -> links that connect what is linked.

    Round one: each block, with a few rows of its cluster in all of them.  Round two, only for clusters
    of several blocks: pairs of new blocks, those of one large part being blocks of their own that are
    not compared with each other."""
    narrow = members.select("cluster", "rep", "n")
    count = _blocks(narrow, ["cluster"])
    dealt = members.join(count, "cluster").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    pivot = (F.col("rep") == F.col("cluster")) | (F.pmod(F.xxhash64(F.lit(7), "rep"), F.col("classes")) < 4)
    everywhere = F.when(pivot, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("own"))
    tiles = dealt.select("cluster", "rep", "hashes", F.explode(everywhere).alias("block"))
    one = materialize(_verified(tiles.select("cluster", F.col("block").alias("first"), F.col("block").alias("second"),
                                             "block", "rep", F.col("rep").alias("part"), "hashes"), percent), "jaccard-links")
    large = count.where("blocks > 1").select("cluster")
    if not large.take(1):
        return one
    parts = components(one)
    again = (members.join(large, "cluster").join(parts.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("part", F.coalesce("component", "rep")).drop("component"))
    again = materialize(again, "jaccard-large")
    of_part = _blocks(again.select("cluster", "part", "n"), ["cluster", "part"])
    big = of_part.where(F.col("classes") >= BLOCK_CLASSES // 4).select("cluster", "part", F.col("blocks").alias("k"))
    pooled = again.select("cluster", "part", "n").join(big, ["cluster", "part"], "left_anti")
    pools = _blocks(pooled, ["cluster"]).select("cluster", F.col("blocks").alias("pool"))
    named = (again.join(big, ["cluster", "part"], "left").join(pools, "cluster", "left")
             .withColumn("pure", F.when(F.col("k").isNotNull(), F.col("part")))
             .withColumn("block", F.xxhash64("pure", F.pmod(F.xxhash64("rep"), F.coalesce("k", "pool")))))
    blocks = named.select("cluster", "block", "pure").distinct()
    other = blocks.select("cluster", F.col("block").alias("block2"), F.col("pure").alias("pure2"))
    pairs = blocks.join(other, "cluster").where(
        (F.col("block") <= F.col("block2")) & ~F.coalesce(F.col("pure") == F.col("pure2"), F.lit(False))).select(
        "cluster", F.col("block").alias("first"), F.col("block2").alias("second"))
    sides = pairs.select("cluster", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    two = _verified(named.join(sides, ["cluster", "block"]), percent)
    return one.unionByName(materialize(two, "jaccard-links"))


# --- join -------------------------------------------------------------------------

def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                       percent: int = PERCENT) -> DataFrame:
    """Per document: id, n_shingles and component_id, the least id reachable by links of at least ``percent``."""
    profile = profiles(df, id_col, text_col, words, percent)
    can = profile.where("survives and id is not null")
    prints = ["print1", "print2", "n"]
    classes = materialize(can.groupBy(*prints).agg(F.min("id").alias("rep")), "shingle-classes")
    # both sides grow with the corpus: a merge join at every size
    texts = _texts(df, id_col, text_col).join(classes.select(F.col("rep").alias("id")).hint("merge"), "id", "left_semi")
    sets = materialize(texts.mapInArrow(arrow.giving_back(_sets(words)), "rep long, n long, hashes binary, vector binary").where("n > 0"), "shingle-sets")
    buckets = max(16, (sets.agg(F.sum("n")).first()[0] or 0) // BUCKET_ROWS)
    held = (sets.select("rep", "n", "hashes").mapInArrow(arrow.giving_back(_ask_counts(buckets)), _COUNTED_SQL)
            .groupBy("bucket").applyInArrow(arrow.giving_back_groups(_answer_counts), _COUNTED_SQL))
    keyed = (held.groupBy("slice").applyInArrow(arrow.giving_back_groups(_rarest(buckets, percent)), "key long, rep long, n long")
             .repartition("key").sortWithinPartitions("key", "rep"))
    edges = keyed.mapInArrow(arrow.giving_back(_edges(percent)), "u long, v long, check boolean").groupBy("u", "v").agg(F.min("check").alias("check"))
    points = sets.select("rep", "n", "vector")
    left = points.select(F.col("rep").alias("u"), F.col("n").alias("n1"), F.col("vector").alias("vector1"))
    right = points.select(F.col("rep").alias("v"), F.col("n").alias("n2"), F.col("vector").alias("vector2"))
    possible = edges.join(left, "u").join(right, "v").mapInArrow(arrow.giving_back(_bounded(percent)), "u long, v long")
    clusters = components(possible).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    members = materialize(sets.select("rep", "n", "hashes").join(clusters, "rep"), "jaccard-members")
    parts = components(cluster_links(members, percent)).select(F.col("node").alias("rep"), "component")
    found = classes.join(parts, "rep", "left").select(*prints, F.coalesce("component", "rep").alias("component"))
    return profile.join(found, prints, "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("survives"), F.coalesce("component", "id")).otherwise(F.col("id"))).alias("component_id"))
