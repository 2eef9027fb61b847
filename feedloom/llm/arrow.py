"""Running vectorised functions over text columns inside Spark tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from feedloom.llm import text as tx

_TEXT = "__feedloom_text"


def with_text_columns(df: DataFrame, text_col: str, fields: list[StructField],
                      maker: Callable[[], Callable[[pa.Array], list[pa.Array]]],
                      carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns (default: all) of ``df`` and new ones made from the text column.

    ``maker()`` runs once per task and returns a function from a slice of texts
    (large_string, no nulls) to one array per field.  A carried column with the
    name of a new one is replaced.  No shuffle; rows keep their order.
    """
    names = {f.name for f in fields}
    kept = [c for c in (df.columns if carry is None else carry) if c not in names]
    own = df.select(F.col(f"`{text_col}`").alias(_TEXT), *[F.col(f"`{c}`") for c in kept])
    schema = StructType([*own.schema.fields[1:], *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = maker()
        for batch in batches:
            column = tx.text_array(batch.column(0))
            rest = batch.select(batch.schema.names[1:])
            for a, b in tx.slices(column):
                made = make(column.slice(a, b - a))
                part = rest.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], [*part.schema.names, *(f.name for f in fields)])

    return own.mapInArrow(giving_back(run), schema)


def summed_vectors(df: DataFrame, size: int) -> np.ndarray:
    """Sum of the int64 vectors in ``df`` (columns part, vector): ``part`` numbers a piece of
    the whole vector of fixed length ``size``.  Added up in Spark; only one vector of the
    fixed length comes to the driver."""
    def add(table: pa.Table) -> pa.Table:
        total = None
        for v in table.column("vector").to_pylist():
            v = np.frombuffer(v, np.int64)
            total = v.copy() if total is None else total + v
        first = table.slice(0, 1)
        return pa.table({"part": first["part"], "lot": pa.array([0], pa.int64()),
                         "vector": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, lot long, vector binary"
    lots = df.select("part", "lot", "vector").groupBy("part", "lot").applyInArrow(add, schema)
    rows = lots.groupBy("part").applyInArrow(add, schema).collect()
    out = np.zeros(size, np.int64)
    step = max((len(r["vector"]) // 8 for r in rows), default=0)
    for r in rows:
        v = np.frombuffer(r["vector"], np.int64)
        out[r["part"] * step:r["part"] * step + len(v)] = v
    return out


def vector_parts(counts: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows for summed_vectors from one task's counts; ``lot`` spreads the tasks over a first level of sums."""
    from pyspark import TaskContext

    lot = TaskContext.get().partitionId() // 256
    return pa.RecordBatch.from_arrays(
        [pa.array(range(parts), pa.int32()), pa.array([lot] * parts, pa.int64()),
         pa.array([v.tobytes() for v in np.split(counts, parts)], pa.binary())], ["part", "lot", "vector"])


VECTOR_SCHEMA = "part int, lot long, vector binary"


def give_back() -> None:
    """Free memory of this worker goes back to the system: Spark keeps workers for later tasks, and
    what arrays of a task have left in the heap would add to theirs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


LARGE_GROUP = 1 << 20  # bytes of a group after which memory is given back: smaller ones leave little


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, after which the worker's free memory goes back."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()
    return task


def giving_back_groups(run: Callable[[pa.Table], pa.Table]):
    """``run`` for applyInArrow, after which the worker's free memory goes back if the group was large."""
    def group(table: pa.Table) -> pa.Table:
        out = run(table)
        if table.nbytes > LARGE_GROUP:
            give_back()
        return out
    return group
