"""Embedding near-duplicates: PCA-ordered tiled comparison with suffix-norm bounds.

Unit vectors are rotated so that leading dimensions carry most of the variance.
Vectors of one label are dealt into tiles; pairs of tiles whose first
coordinates can be near enough are compared as blocks.  A block adds up leading
dimensions first; what the others can still add is at most the product of the
suffix norms, and a row or pair that cannot reach the threshold any more is
left out.  Survivors are decided by the cosine of the vectors as given, in
double precision.  A block returns a count and a root per row, never its pairs.

Equal vectors of a label are one row with a multiplicity, so groups of copies
cost nothing; a label that holds a third of all rows is many tiles.

Defined results: vectors that are null, empty, zero or hold null, NaN or
infinite components, null labels and null ids link with nothing; vectors of
different lengths do not link; rows that repeat an id count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import arrow
from feedloom.llm.components import components
from feedloom.session import materialize

THRESHOLD = 0.93
TILE_ROWS = 1024
CELLS_PER_UNIT = 32  # of the first coordinate, which lies in -1..1
_SLACK = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles, short ones padded with zeros (dot products stay the same)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.zeros((len(column), width))
    if not len(column):
        return out
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.asarray(column.value_lengths())
    if (sizes == width).all():
        return values.reshape(-1, width)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Axes (columns) by falling variance of the unit vectors; tasks send width x width sums."""
    scale = float(1 << 40)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            unit = _units(_matrix(batch.column(0), width))
            total += unit.T @ unit
        yield arrow.vector_parts(np.round(total.ravel() * scale / (1 << 16)).astype(np.int64), 1)

    sums = arrow.summed_vectors(vectors.select("embedding").mapInArrow(run, arrow.VECTOR_SCHEMA), width * width)
    values, axes = np.linalg.eigh(sums.reshape(width, width).astype(float))
    return axes[:, np.argsort(-values)]


def linked(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> np.ndarray:
    """Which rows of ``a`` and ``b`` have a cosine of at least ``threshold``."""
    ua, ub = _units(a) @ axes, _units(b) @ axes
    width = axes.shape[0]
    rows, cols = np.arange(len(a)), np.arange(len(b))
    part = np.zeros((len(a), len(b)))
    done, step = 0, max(4, width // 8)
    hits = np.zeros((len(a), len(b)), bool)
    while done < width and len(rows) and len(cols):
        to = min(width, done + step)
        part = part + ua[rows, done:to] @ ub[cols, done:to].T
        done, step = to, step * 2
        left_a = np.sqrt(np.maximum((ua[rows, done:] ** 2).sum(axis=1), 0))
        left_b = np.sqrt(np.maximum((ub[cols, done:] ** 2).sum(axis=1), 0))
        alive = part + left_a[:, None] * left_b >= threshold - _SLACK
        keep_r, keep_c = alive.any(axis=1), alive.any(axis=0)
        if done < width and alive.sum() > 0.02 * alive.size:
            rows, cols, part = rows[keep_r], cols[keep_c], part[np.ix_(keep_r, keep_c)]
            continue
        at_r, at_c = np.nonzero(alive)  # few pairs are left: the remaining products one by one
        at_r, at_c = rows[at_r], cols[at_c]
        for k in range(0, len(at_r), 1 << 14):
            x, y = a[at_r[k:k + (1 << 14)]], b[at_c[k:k + (1 << 14)]]
            cosine = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            good = cosine >= threshold
            hits[at_r[k:k + (1 << 14)][good], at_c[k:k + (1 << 14)][good]] = True
        break
    if same:
        np.fill_diagonal(hits, False)
    return hits


def roots(hits: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For linked rows and columns of a block the first row of their component in it, else -1."""
    row_root, col_root = np.full(hits.shape[0], -1), np.full(hits.shape[1], -1)
    for start in np.flatnonzero(hits.any(axis=1)):
        if row_root[start] >= 0:
            continue
        new = np.array([start])
        while len(new):
            row_root[new] = start
            if same:
                new = np.flatnonzero(hits[new].any(axis=0) & (row_root < 0))
                continue
            reached = np.flatnonzero(hits[new].any(axis=0) & (col_root < 0))
            col_root[reached] = start
            new = np.flatnonzero(hits[:, reached].any(axis=1) & (row_root < 0)) if len(reached) else reached
    return row_root, (row_root if same else col_root)


def _compare(axes: np.ndarray, threshold: float):
    width = axes.shape[0]

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        first, second = key[3].as_py(), key[4].as_py()
        tile = table["tile"].to_numpy()
        rep, weight = table["rep"].to_numpy(), table["n"].to_numpy()
        vectors = _matrix(table["embedding"], width)
        a = np.flatnonzero(tile == first)
        b = a if first == second else np.flatnonzero(tile == second)
        hits = linked(vectors[a], vectors[b], axes, threshold, first == second)
        row_root, col_root = roots(hits, first == second)
        out = [(rep[a], hits @ weight[b], row_root)]
        if first != second:
            out.append((rep[b], weight[a] @ hits, col_root))
        ids, links, root = (np.concatenate(x) for x in zip(*out))
        some = root >= 0
        return pa.table({"rep": ids[some], "links": links[some].astype(np.int64), "root": rep[a][root[some]]})

    return run


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, tile_rows: int = TILE_ROWS) -> DataFrame:
    """A row per vector: id, n_links (others linked directly), component_id (least id reachable) and kept."""
    own = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                    F.col(f"`{vector_col}`").cast("array<double>").alias("embedding"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
                        & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0), F.lit(False))
    good = own.where(usable)
    grouped = good.groupBy("label", "embedding").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = materialize(grouped.withColumn("size", F.size("embedding")), "vector-classes")
    width = classes.agg(F.max("size")).first()[0]
    if width is None:
        return _result(own, usable, None, id_col)
    axes = principal_axes(classes, width)
    direction = axes[:, 0]
    reach = int(np.ceil(np.sqrt(max(0.0, 2 - 2 * threshold)) * CELLS_PER_UNIT)) + 1

    def place(batches):
        for batch in batches:
            unit = _units(_matrix(batch.column("embedding"), width))
            cell = np.floor(unit @ direction * CELLS_PER_UNIT).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    schema = "label string, embedding array<double>, rep long, n long, size int, cell int"
    placed = materialize(classes.mapInArrow(place, schema), "vector-cells")
    cells = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("int").alias("tiles"))
    # tiles of a cell are numbered; those of a label are compared when their cells are within reach
    tiles = cells.select("label", "size", "cell", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("k"))
    numbered = tiles.withColumn("tile", (F.col("cell").cast("long") + CELLS_PER_UNIT + 1) * (1 << 32) + F.col("k"))
    other = numbered.select("label", "size", F.col("cell").alias("cell2"), F.col("tile").alias("tile2"))
    pairs = numbered.join(other, ["label", "size"]).where(
        (F.col("tile") <= F.col("tile2")) & (F.col("cell2") - F.col("cell") <= reach)).select(
        "label", "size", F.col("tile").alias("first"), F.col("tile2").alias("second"))
    sides = pairs.select("label", "size", "first", "second", F.explode(
        F.array_distinct(F.array("first", "second"))).alias("tile"))
    dealt = placed.join(cells, ["label", "size", "cell"]).withColumn(
        "tile", (F.col("cell").cast("long") + CELLS_PER_UNIT + 1) * (1 << 32)
        + F.pmod(F.xxhash64("rep"), F.col("tiles"))).drop("tiles", "cell")
    salt = F.pmod(F.xxhash64("first", "second"), F.lit(64)).alias("salt")
    found = (dealt.join(sides, ["label", "size", "tile"]).withColumn("salt", salt)
             .groupBy("label", "size", "salt", "first", "second")
             .applyInArrow(_compare(axes, threshold), "rep long, links long, root long"))
    found = materialize(found, "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    known = (classes.select("label", "embedding", "rep", "n").join(links, "rep", "left")
             .join(parts.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "rep").alias("component_id")))
    return _result(own, usable, known, id_col)


def _result(own: DataFrame, usable, known: DataFrame | None, id_col: str) -> DataFrame:
    alone = own.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if known is not None:
        alone = own.where(usable).join(known, ["label", "embedding"]).select("id", "n_links", "component_id").unionByName(alone)
    return alone.select(F.col("id").alias(id_col), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
