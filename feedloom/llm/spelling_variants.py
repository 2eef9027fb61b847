"""Spelling variants: words one edit apart, and the more frequent form each may stand for.

Words are maximal runs of letters (A-Z, a-z, U+00C0-U+00FF), A-Z lower-cased.  A word is
near another if they differ by exactly one inserted, deleted or replaced code point.  A
word's form is its near word with most occurrences (ties: the smallest in code-point
order), where these are at least ``ratio`` times its own; its root is the last form of
that chain, whose length is bounded by the logarithm of the largest count.

Near words are found by a bit-sliced position index: for every (position, letter) a bitset
over a block of words.  A word is read letter by letter against whole blocks at once; one
recurrence keeps the words that agree so far (zero errors), and three, which look a
position ahead or behind, those that agree but for one replaced, one added or one missing
letter.  Blocks are exact: two words one edit apart agree on the first half of the shorter one
or on the rest of it, so a word goes to the blocks of both halves, and blocks that
are too large are split by the halves of what their words do not share, again and again.
A pair that shares both halves is counted in the block of the first.

Defined results: null and empty texts have no words; a null id counts as an empty one where
occurrences are drawn for deletion; repeated rows are counted each; an empty table gives an
empty table.  No group is bounded by the data: after the last split a block has at most as
many words as there are pairs of letters.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import materialize

LETTERS = "[A-Za-zÀ-ÿ]+"
LEAST_POINTS = 6
LEAST_COUNT = 5
RATIO = 5
BLOCK_WORDS = 1 << 14   # beyond it a block is split; more than the pairs of 90 letters
CHUNK_WORDS = 1 << 10   # words of small blocks that are indexed together
CHUNK_BYTES = 64 << 20  # of bitsets
GRID = 1 << 17          # 64-bit words of one state: words read at once times size of a bitset


# --- words ------------------------------------------------------------------

def _lower(run: Column) -> Column:
    return F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(
        F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_points: int = LEAST_POINTS,
                least_count: int = LEAST_COUNT, every: int = 199) -> DataFrame:
    """(word, n): words of enough code points and occurrences.  Where ``every`` divides the checksum of
    ``<id>:<run>``, the run has lost one code point, which that checksum picks."""
    runs = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(LETTERS), F.lit(0))).alias("run"))
    # a run shorter than a word does not become one by losing a letter
    runs = runs.where(F.length("run") >= least_points).select("id", _lower(F.col("run")).alias("run"))
    drawn = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut).otherwise(F.col("run"))
    counts = drawn.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where((F.length("word") >= least_points) & (F.col("n") >= least_count))


# --- blocks ------------------------------------------------------------------
# A block is (size, lo, hi, key): its words have ``size`` or ``size + 1`` code points, agree on the first ``lo`` and the
# last ``hi`` of them (the key), and are looked at for one edit in what lies between.  ``seen`` holds, for every step that
# went to the second half, the first half, on which a pair of this block must not agree.

def _halves(rows: DataFrame) -> DataFrame:
    """Every row in both halves of its block."""
    middle = F.col("size") - F.col("lo") - F.col("hi")
    half = F.floor(middle / 2).cast("int")
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"), F.col("seen").alias("seen"))
    piece = F.substring("word", F.col("lo") + 1, half)
    second = F.struct(F.col("lo").alias("lo"), (F.col("hi") + middle - half).alias("hi"),
                      F.concat("seen", F.array(piece)).alias("seen"))
    to = rows.select("word", "n", "size", F.explode(F.array(first, second)).alias("to")).select("word", "n", "size", "to.*")
    return to.select("*", F.concat_ws(":", "size", "lo", "hi", F.substring("word", F.lit(1), F.col("lo")),
                                      F.substring("word", F.length("word") - F.col("hi") + 1, F.col("hi"))).alias("key"))


def blocks(words: DataFrame, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """Rows (key, word, n, size, lo, hi, seen): every word in its blocks, by times of splitting."""
    nothing = F.array().cast("array<string>")
    size = F.explode(F.array(F.length("word") - 1, F.length("word"))).alias("size")
    rows = words.select("word", "n", size).select("*", F.lit(0).alias("lo"), F.lit(0).alias("hi"), nothing.alias("seen"))
    rows = materialize(_halves(rows), "blocks")
    done = []
    while True:
        large = materialize(rows.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > block_words).select("key"), "large")
        if large.isEmpty():
            return [*done, rows]
        done.append(rows.join(large, "key", "left_anti"))
        split = rows.where("size - lo - hi > 1").join(large, "key", "left_semi")
        done.append(rows.where("size - lo - hi <= 1").join(large, "key", "left_semi"))  # cannot be split, and is bounded
        rows = materialize(_halves(split.drop("key")), "blocks")


# --- the index ----------------------------------------------------------------

class BitSliced:
    """Bitsets over words by (position, letter), and the words one edit from given ones among them."""

    def __init__(self, words: list[str]):
        self.words = len(words)
        self.width = (len(words) + 63) // 64
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), self.length)
        at = np.arange(len(letters)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        self.cells, which = np.unique(at << 21 | letters, return_inverse=True)
        self.bits = np.zeros((len(self.cells) + 1, self.width), np.uint64)  # the last: no word
        np.bitwise_or.at(self.bits, (which, word // 64), np.uint64(1) << (word % 64).astype(np.uint64))

    def range(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A bitset a row, of the words first <= w < last."""
        at = np.arange(self.width) * 64
        ones = np.uint64(0xFFFFFFFFFFFFFFFF)
        low, high = np.clip(first[:, None] - at, 0, 64), np.clip(last[:, None] - at, 0, 64)
        upto = np.where(high >= 64, ones, (np.uint64(1) << np.minimum(high, 63).astype(np.uint64)) - np.uint64(1))
        below = np.where(low >= 64, ones, (np.uint64(1) << np.minimum(low, 63).astype(np.uint64)) - np.uint64(1))
        return upto & ~below

    def _at(self, position: int, letters: np.ndarray) -> np.ndarray:
        if position < 0:
            return np.zeros((len(letters), self.width), np.uint64)
        cell = position << 21 | letters
        k = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        return self.bits[np.where(self.cells[k] == cell, k, len(self.cells))]

    def near(self, letters: np.ndarray, among: np.ndarray) -> np.ndarray:
        """Bitsets of the words of ``among`` that are one edit from words of one length (a row of letters each)."""
        size = letters.shape[1]
        exact = among.copy()
        replaced, added, missing = (np.zeros_like(exact) for _ in range(3))
        for k in range(size):
            here, behind, ahead = (self._at(k + d, letters[:, k]) for d in (0, -1, 1))
            replaced = replaced & here | exact & ~here
            missing = missing & behind | exact      # the letter just read is not in the other word
            added = (added | exact) & ahead         # the other word has one letter more before this one
            exact &= here
        added |= exact                              # or at its end
        of = [self._sized(size + d) for d in (0, 1, -1)]
        return replaced & of[0] | added & of[1] | missing & of[2]

    def _sized(self, size: int) -> np.ndarray:
        out = np.zeros(self.width * 64, np.uint8)
        out[:self.words] = self.length == size
        return np.packbits(out, bitorder="little").view(np.uint64)


def _parts(words: list[str], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of words whose bitsets stay within ``most`` bytes: as many bitsets as letters, at most."""
    at = 0
    while at < len(words):
        to, letters = at, 0
        while to < len(words) and (to == at or (letters + len(words[to])) * (to + 1 - at) // 8 <= most):
            letters += len(words[to])
            to += 1
        yield at, to
        at = to


def near_in_blocks(words: list[str], n: np.ndarray, keys: np.ndarray, size: np.ndarray, seen: list[list[str]]):
    """Of rows ordered by block (``keys``: their numbers): near words in the own block, the largest n of
    them and the place of the smallest such word (-1: none)."""
    count, most, best = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), -1)
    rank = np.argsort(np.argsort(np.array(words, object), kind="stable"), kind="stable")
    pieces: dict[tuple, int] = {}
    depth = max(map(len, seen), default=0)
    codes = np.full((len(words), depth), -1)
    for k, own in enumerate(seen):
        for d, piece in enumerate(own):
            codes[k, d] = pieces.setdefault((d, piece), len(pieces))
    first, last = np.searchsorted(keys, keys, "left"), np.searchsorted(keys, keys, "right")
    length = np.fromiter(map(len, words), np.int64, len(words))
    for a, b in _parts(words, CHUNK_BYTES):
        index = BitSliced(words[a:b])
        touched = np.flatnonzero((first < b) & (last > a))
        for m in np.unique(length[touched]):
            rows = touched[length[touched] == m]
            step = max(1, GRID // index.width)
            for k in range(0, len(rows), step):
                q = rows[k:k + step]
                letters = np.frombuffer("".join([words[i] for i in q.tolist()]).encode("utf-32-le"), np.uint32).astype(np.int64)
                hits = index.near(letters.reshape(len(q), m), index.range(np.clip(first[q], a, b) - a, np.clip(last[q], a, b) - a))
                at, word = np.nonzero(hits)
                if not len(at):
                    continue
                held = np.unpackbits(hits[at, word][:, None].view(np.uint8), axis=1, bitorder="little")
                which, bit = np.nonzero(held)
                x, y = q[at[which]], a + word[which] * 64 + bit
                # the block's words have its size or one letter more: of longer ones, only edits against shorter ones are its own
                fair = (length[x] == size[x]) | (length[y] == size[x])
                fair &= ~((codes[x] == codes[y]) & (codes[x] >= 0)).any(axis=1)
                x, y = x[fair], y[fair]
                np.add.at(count, x, 1)
                order = np.lexsort((rank[y], -n[y], x))
                x, y = x[order], y[order]
                top = np.ones(len(x), bool)
                top[1:] = x[1:] != x[:-1]
                x, y = x[top], y[top]
                better = (best[x] < 0) | (n[y] > most[x]) | (n[y] == most[x]) & (rank[y] < rank[best[x]])
                most[x[better]], best[x[better]] = n[y[better]], y[better]
    return count, most, best


_NEAR = "word string, n_near long, most long, best string"


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their keys; blocks are gathered until there are CHUNK_WORDS words."""
    held: list[tuple] = []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        keys, words, n, size, seen = zip(*rows)
        number = np.unique(np.array(keys, object), return_inverse=True)[1]
        count, most, best = near_in_blocks(list(words), np.array(n, np.int64), number, np.array(size, np.int64), list(seen))
        found = np.flatnonzero(count).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in found], pa.string()), pa.array(count[found], pa.int64()), pa.array(most[found], pa.int64()),
             pa.array([words[best[k]] for k in found], pa.string())], ["word", "n_near", "most", "best"])

    for batch in batches:
        for row in zip(*(batch.column(name).to_pylist() for name in ("key", "word", "n", "size", "seen"))):
            if len(held) >= CHUNK_WORDS and row[0] != held[-1][0]:
                yield out(held)
                held = []
            held.append(row)
    if held:
        yield out(held)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, most, best) of the words that have near ones among ``words`` (word, n)."""
    found = None
    for rows in blocks(words, block_words):
        dealt = rows.select("key", "word", "n", "size", "seen").repartition("key").sortWithinPartitions("key")
        part = dealt.mapInArrow(_search, _NEAR)
        found = part if found is None else found.unionByName(part)
    # a word's near ones in several blocks: most occurrences first, then the smallest
    best = F.min(F.struct((-F.col("most")).alias("most"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.most")).alias("most"), F.col("top.best").alias("best"))


# --- forms and roots -------------------------------------------------------------

def _roots(forms: DataFrame, ratio: int) -> DataFrame:
    """(word, root) of the words that have a form: pointers are doubled until the longest possible chain is spanned."""
    top = forms.agg(F.max("form_n")).first()[0] or 1
    longest = math.log(top, ratio) + 2 if ratio > 1 else math.inf
    now, spanned = forms.select("word", F.col("form").alias("root")), 1
    while spanned < longest:
        now = materialize(now, "roots")
        step = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now, spanned = now.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), 2 * spanned
    return now


def variants(words: DataFrame, ratio: int = RATIO, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per word of ``words`` (word, n; distinct): form, root, n, n_near, form_n.  ``ratio`` is over 1: forms have no cycles."""
    if ratio <= 1:
        raise ValueError("ratio must be over 1")
    words = materialize(words, "words")
    near = words.join(near_words(words, block_words), "word", "left")
    fits = F.col("most") >= ratio * F.col("n")
    near = materialize(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("most")).alias("form_n")), "forms")
    roots = _roots(near.where(F.col("form").isNotNull()), ratio)
    return near.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
