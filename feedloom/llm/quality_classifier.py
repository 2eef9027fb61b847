"""Quality classifier: naive Bayes support vectors over hashed word n-grams.

Features are indicators of hashed words and word pairs.  Class log-count ratios
are counted in Spark over all training documents; the linear hinge-loss model
over the scaled indicators is fitted by dual coordinate descent on at most
``sample_rows`` training documents (lowest seeded hash of their ids, half of
them from each class as far as there are so many).  Tasks get one weight per
cell, whatever the corpus size.

Defined results: null text is empty and scores sigmoid(bias); labels other than
0 and 1, and null ids, train nothing; contradicting labels of one id all count;
without both classes every score is 0.5 and no better model is claimed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from feedloom.llm import arrow
from feedloom.llm import text as tx
from feedloom.session import materialize

CELLS = 1 << 17
SAMPLE_ROWS = 8000  # training documents that the hinge loss sees, at most
SAMPLE_CELLS = 1 << 26  # and their cells, together
SMOOTHING = 1.0
COST = 1.0
PASSES = 12
SHARPNESS = 4.0  # of the logistic curve that turns margins into scores
SEED = 11
_PARTS = 8


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of every text, text by text, and where each text's begin (one more entry)."""
    data, offsets = tx.raw(column)
    starts, ends, first = tx.word_spans(data, offsets)
    words = tx.word_hashes(data, starts, ends)
    docs = len(offsets) - 1
    keys = []
    for n in (1, 2):
        grams, begin = tx.gram_hashes(words, first, n)
        doc = np.repeat(np.arange(docs, dtype=np.uint64), np.diff(begin))
        keys.append(doc * np.uint64(CELLS) + (grams & np.uint64(CELLS - 1)))
    keys = np.unique(np.concatenate(keys))
    begin = np.searchsorted(keys, np.arange(docs + 1, dtype=np.uint64) * np.uint64(CELLS))
    return (keys & np.uint64(CELLS - 1)).astype(np.int32), begin


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: np.ndarray,
                            passes: int = PASSES, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Weights over cells and bias of the L2-regularised hinge loss; a row is its cells, scaled and of unit length."""
    w, bias = np.zeros(len(scale)), 0.0
    values = [scale[r] for r in rows]
    lengths = [np.sqrt((v * v).sum()) or 1.0 for v in values]
    values = [v / n for v, n in zip(values, lengths)]
    square = np.array([(v * v).sum() + 1.0 for v in values])
    alpha = np.zeros(len(rows))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            y = labels[i]
            gradient = y * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w * scale, bias


def _gathered(train: DataFrame) -> DataFrame:
    """One pass over the training texts: per task class counts by cell, and the cells of sampled rows."""
    schema = arrow.VECTOR_SCHEMA + ", label int, cells binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * CELLS, np.int64)
        none = {"part": None, "lot": None, "vector": None}
        for batch in batches:
            column = tx.text_array(batch.column(0))
            label, picked = batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
            for a, b in tx.slices(column):
                cells, begin = features(column.slice(a, b - a))
                of = np.repeat(label[a:b], np.diff(begin)).astype(np.int64)
                counts += np.bincount(of * CELLS + cells, minlength=2 * CELLS)
                own = [{**none, "label": int(label[a + i]), "cells": cells[begin[i]:begin[i + 1]].tobytes()}
                       for i in np.flatnonzero(picked[a:b])]
                if own:
                    yield pa.RecordBatch.from_pylist(own, _ARROW)
        part = arrow.vector_parts(counts, 2 * _PARTS)
        gap = [pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())]
        yield pa.RecordBatch.from_arrays([*part.columns, *gap], schema=_ARROW)

    return train.mapInArrow(run, schema)


_ARROW = pa.schema([("part", pa.int32()), ("lot", pa.int64()), ("vector", pa.binary()), ("label", pa.int32()), ("cells", pa.binary())])


@dataclass
class Model:
    """A margin is sum(weights) / sqrt(sum(squares)) + bias over a text's cells."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float


NO_MODEL = Model(np.zeros(CELLS), np.ones(CELLS), 0.0)


def _sample(rows: DataFrame, most: int) -> list:
    """Rows (label, cells) in seeded order of their cells, at most so many and SAMPLE_CELLS cells: ids that labels or
    documents repeat bring more rows than were drawn, and long texts more cells."""
    seeded = rows.select("label", "cells", F.xxhash64(F.lit(SEED), "cells").alias("place"), (F.octet_length("cells") / 4).cast("long").alias("n"))
    total, last = 0, None
    for r in seeded.select("place", "n").orderBy("place", "n").limit(most).collect():
        total += r["n"]
        if total > SAMPLE_CELLS and last is not None:
            break
        last = r["place"]
    if last is None:
        return []
    return seeded.where(F.col("place") <= last).orderBy("place", "cells", "label").limit(most).orderBy("cells", "label").select("label", "cells").collect()


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the labelled documents: counts over all of them, the hinge loss on a sample of at most ``sample_rows``."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where("label in (0, 1)")
    seeded = known.withColumn("place", F.xxhash64(F.lit(SEED), F.col("id").cast("string")))
    bounds = []
    for label in (0, 1):  # the hash below which the sample of a class lies: at most sample_rows narrow rows sorted out
        lowest = seeded.where(F.col("label") == label).orderBy("place").limit(sample_rows // 2).agg(F.max("place")).first()[0]
        bounds.append(lowest)
    if None in bounds:
        return NO_MODEL
    limit = F.when(F.col("label") == 0, bounds[0]).otherwise(bounds[1])
    picked = seeded.select("id", "label", (F.col("place") <= limit).alias("picked"))
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # both sides grow with the corpus: a merge join at every size
    train = own.join(picked.hint("merge"), "id").select("text", "label", "picked")
    gathered = materialize(_gathered(train), "classifier-features")
    counts = arrow.summed_vectors(gathered.where("part is not null"), 2 * CELLS).reshape(2, CELLS)
    sample = _sample(gathered.where("label is not null").select("label", "cells"), sample_rows)
    if not counts.sum(axis=1).all():
        return NO_MODEL
    bad, good = counts + SMOOTHING
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())
    y = np.array([2 * r["label"] - 1 for r in sample], float)
    share = {v: max((y == v).mean(), 1e-9) for v in (-1.0, 1.0)}
    cost = np.array([COST * 0.5 / share[v] for v in y])
    weights, bias = dual_coordinate_descent([np.frombuffer(r["cells"], np.int32) for r in sample], ratio, y, cost)
    return Model(weights, ratio * ratio, bias)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: the id), score in 0..1 and predicted (1 if score >= 0.5)."""
    def maker():
        def make(column: pa.Array) -> list[pa.Array]:
            cells, begin = features(column)
            doc = np.repeat(np.arange(len(column)), np.diff(begin))
            total = np.bincount(doc, weights=model.weights[cells], minlength=len(column))
            square = np.bincount(doc, weights=model.squares[cells], minlength=len(column))
            margin = total / np.sqrt(np.maximum(square, 1e-12)) + model.bias
            value = 1.0 / (1.0 + np.exp(-np.clip(SHARPNESS * margin, -500, 500)))
            return [pa.array(value), pa.array((value >= 0.5).astype(np.int32))]
        return make

    fields = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    return arrow.with_text_columns(docs, text_col, fields, maker, [id_col] if carry is None else carry)


def held_out(key: Column) -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))
