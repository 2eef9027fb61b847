"""Quality rules: base counts and a hashed n-gram likelihood ratio with a fixed threshold.

Two multinomials over hashed word n-grams (one and two words, ``BUCKETS``
cells, smoothed by pseudo-counts) are counted in Spark: one over the trusted target
documents, one over the whole raw corpus.  A document's score is the mean over
its n-grams of log p_target - log p_raw, its own occurrences left out of the raw counts.  Every document at or above the
threshold passes; nothing is sampled.

Defined results: null text counts as empty; a text without words has ratio 0
and fails the base rule; without trusted documents every ratio is 0 (the model
says nothing); equal texts score equally; null or repeated ids are carried as
they come; further columns are ignored or carried.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from feedloom.llm import arrow
from feedloom.llm import text as tx

BUCKETS = 1 << 15
GRAMS = (1, 2)
#: Mean log ratio per n-gram below which a document is unlike the trusted ones.
#: Clean documents lie around 0 (the raw corpus is mostly clean); -0.1 says that
#: a document's n-grams are 10 % less likely under the target, on average.
THRESHOLD = -0.1
PSEUDO = 8.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _again(keys: np.ndarray) -> np.ndarray:
    """Which keys equal an earlier one."""
    order = np.argsort(keys, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    return out


def _lines(data: np.ndarray, offsets: np.ndarray, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text, per text."""
    marks = np.flatnonzero(data == 10)
    begins = np.unique(np.concatenate([offsets[:-1], marks + 1]))
    begins = begins[begins < len(data)]
    if not len(begins):
        return np.zeros(len(offsets) - 1, np.int64)
    ends = np.concatenate([begins[1:], [len(data)]])
    ends = ends - (data[ends - 1] == 10)
    worded = np.searchsorted(starts, ends) > np.searchsorted(starts, begins)
    begins, ends = begins[worded], ends[worded]
    doc = np.searchsorted(offsets, begins, "right") - 1
    key = tx.span_hash(h, begins, ends) ^ tx.mix((ends - begins).astype(np.uint64))
    again = _again(tx.mix(key + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.bincount(doc, weights=again, minlength=len(offsets) - 1).astype(np.int64)


def _repeats(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words in a three-word window that is found twice or more in its text, per text."""
    grams, begin = tx.gram_hashes(words, first, 3)
    docs = len(first) - 1
    if not len(grams):
        return np.zeros(docs, np.int64)
    counts = np.diff(begin)
    doc = np.repeat(np.arange(docs), counts)
    key = tx.mix(grams + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = (np.repeat(first[:-1] - begin[:-1], counts) + np.arange(len(key)))[twice]
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[at + k] = True
    return _sums(covered, first)


def _cells(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-gram cells of a slice, text by text within each n, and the text of each."""
    cells, docs = [], []
    for n in GRAMS:
        grams, begin = tx.gram_hashes(words, first, n)
        cells.append((grams & np.uint64(BUCKETS - 1)).astype(np.int64))
        docs.append(np.repeat(np.arange(len(first) - 1), np.diff(begin)))
    return np.concatenate(cells), np.concatenate(docs)


def _hashed(column: pa.Array):
    data, offsets = tx.raw(column)
    starts, ends, first = tx.word_spans(data, offsets)
    return data, offsets, starts, ends, first, tx.prefix_hash(data)


def gram_counts(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of hashed n-grams over all texts: one vector of fixed length BUCKETS."""
    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            column = tx.text_array(batch.column(0))
            for a, b in tx.slices(column):
                *_, starts, ends, first, h = _hashed(column.slice(a, b - a))
                cells, _ = _cells(tx.span_hash(h, starts, ends), first)
                counts += np.bincount(cells, minlength=BUCKETS)
        yield arrow.vector_parts(counts, 8)

    vectors = df.select(F.col(f"`{text_col}`")).mapInArrow(arrow.giving_back(run), arrow.VECTOR_SCHEMA)
    return arrow.summed_vectors(vectors, BUCKETS)


@dataclass
class Ratios:
    """Counts per cell of the target and of the raw corpus."""

    target: np.ndarray
    raw: np.ndarray

    def of(self, cells: np.ndarray, own: np.ndarray) -> np.ndarray:
        """log p_target - log p_raw of cells, both with PSEUDO counts at the scale of the target, so that a
        cell with little evidence says little; ``own`` occurrences in the document are no evidence on it."""
        if not self.target.sum():
            return np.zeros(len(cells))
        scale = self.target.sum() / self.raw.sum()
        expected = np.maximum(self.raw[cells] - own, 0) * scale
        return np.log((self.target[cells] + PSEUDO) / (expected + PSEUDO))


def quality_rules(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, carry: list[str] | None = None) -> DataFrame:
    """Counts, ratio and verdict for every row of ``df``.

    ``trusted`` holds texts of the trusted target in ``text_col``.  Adds n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_ratio
    and kept to the ``carry`` columns (default: the id).  The model that tasks
    get is two vectors of BUCKETS counts, whatever the corpus size.
    """
    ratios = Ratios(gram_counts(trusted, text_col), gram_counts(df, text_col))

    def maker():
        def make(column: pa.Array) -> list[pa.Array]:
            data, offsets, starts, ends, first, h = _hashed(column)
            words = tx.span_hash(h, starts, ends)
            n_words = np.diff(first)
            chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            in_words = np.concatenate([[0], np.cumsum(chars[ends] - chars[starts])])
            repeats = _repeats(words, first)
            cells, doc = _cells(words, first)
            grams = np.bincount(doc, minlength=len(n_words))
            keys, own = np.unique(doc * BUCKETS + cells, return_counts=True)
            sums = np.bincount(keys // BUCKETS, weights=own * ratios.of(keys % BUCKETS, own), minlength=len(n_words))
            ratio = sums / np.maximum(grams, 1)
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            longs = [n_words, np.diff(in_words[first]), _sums(_SYMBOL[data], offsets),
                     _lines(data, offsets, h, starts), repeats]
            return [*(pa.array(x.astype(np.int64)) for x in longs), pa.array(failed), pa.array(ratio),
                    pa.array(~failed & (ratio >= threshold))]
        return make

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    fields = [*(StructField(n, LongType()) for n in names), StructField("base_failed", BooleanType()),
              StructField("log_ratio", DoubleType()), StructField("kept", BooleanType())]
    return arrow.with_text_columns(df, text_col, fields, maker, [id_col] if carry is None else carry)


def trusted_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that a label marks as good.  Both sides are labels and texts of any number, so
    the join is asked for as a merge join: its plan, and its disk, do not jump with the size."""
    good = labels.where(F.col("quality") == 1).select(F.col(id_col)).hint("merge")
    return docs.join(good, id_col, "left_semi")
