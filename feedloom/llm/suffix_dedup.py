"""Suffix-array dedup: bytes of repeated long strings are removed, all but their first place.

1. *Segments.*  A window is ``length`` bytes.  Its anchor is the place of its least
   hashed gram; a run of windows with one anchor is a segment.  Equal windows have
   equal anchors, so all places of a string lie in segments of one anchor hash.
2. *First places.*  Segments go packed to buckets by anchor hash (of equal segments
   of a slice only the first).  A segment alone with its anchor repeats nothing.  Of
   equal segments all but the first place are repeats altogether.  Where an anchor
   has several different segments their first places are contested.
3. *Suffix order.*  A window reaches far to the left or far to the right of its
   anchor, so equal windows share, besides the anchor, the bytes on that side: contested
   segments are parted there, and the parts dealt to shards by a hash of these bytes.
   A string that many documents hold between differing neighbours so gives many keys,
   and not one shard.  Of equal parts only the first goes on, and a part alone with its
   key not at all.  Each shard sorts the suffixes of the others by external induced sorting
   with disk-backed queues (``induced_sort``); neighbours that share ``length`` bytes are
   one string, and it stays at the first of its places only.
4. *Removal.*  Every document is cut at its repeats.

Places are ordered by (id, start); matches never cross texts, overlaps count, and
strings are judged on the input.  The queues of step 3 are spill files of one
task, in Spark's local folders, gone with the task; all that tasks share goes
through Spark or the shared folder.

Defined results: null text is empty; a null id comes after all others; rows that
repeat an id are places of the same document, and rows that repeat an id and a
text get the same result; texts shorter than ``length`` lose nothing.
"""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm import text as tx
from feedloom.llm.induced_sort import CHUNK, KEPT, Sorter
from feedloom.session import materialize

LENGTH = 100
GRAM = 40
BUCKET_ROWS = 1 << 20  # segments in a bucket, about
SLICE_BYTES = 4 << 20
SHARD_BYTES = 2 << 20  # of suffixes sorted together, about; what is more than fits memory is sorted on disk
LAST_ID = (1 << 63) - 1

#: One segment: anchor hash beyond its bucket, hash of its bytes, windows, start, document in the slice, place of the anchor.
SEGMENT = np.dtype([("anchor", "<u4"), ("content", "<u8"), ("start", "<u4"), ("doc", "<u2"), ("run", "<u2"), ("at", "<u2")])
MOST_WINDOWS = 0xFFFF  # of a segment
NOTE = np.dtype([("start", "<u4"), ("doc", "<u2")])
CONTESTED = np.dtype([("start", "<u4"), ("run", "<u2"), ("doc", "<u2"), ("at", "<u2")])


# --- segments ----------------------------------------------------------------------

def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """First window, number of windows, text, anchor hash, content hash and place of the anchor of every segment."""
    n, width = len(data), length - gram + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64), empty
    h = tx.prefix_hash(data)
    at = np.arange(n - gram + 1)
    hashes = tx.span_hash(h, at, at + gram)
    least = (hashes & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)  # of equal hashes the leftmost
    step = 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    inside = np.arange(len(anchor)) + length <= offsets[1:][doc]
    cut = np.ones(len(anchor), bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
    first = np.flatnonzero(cut & inside)
    last = np.flatnonzero(inside & np.append(cut[1:] | ~inside[1:], True))
    run = last - first + 1
    return first, run, doc[first], hashes[anchor[first]], tx.span_hash(h, first, last + length), anchor[first] - first


def _own(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("id"),
                     F.xxhash64(text).alias("print"), text.alias("text"))


_ASKED = pa.schema([("bucket", pa.int64()), ("slice", pa.int64()), ("rows", pa.binary()), ("ids", pa.binary()), ("prints", pa.binary())])
_ASKED_SQL = "bucket long, slice long, rows binary, ids binary, prints binary"
_TOLD_SQL = "slice long, repeats binary, contested binary, ids binary, prints binary"
_INFO_SQL = "id long, print long, repeats binary, contested binary"


def _earliest(keys: list[np.ndarray], ids: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, id and start; in it, which rows are the first of their keys."""
    order = np.lexsort([start, ids, *keys[::-1]])
    first = np.ones(len(order), bool)
    if len(order):
        first[1:] = False
        for k in keys:
            first[1:] |= k[order[1:]] != k[order[:-1]]
    return order, first


def _ask(buckets: int, length: int, gram: int):
    def rows(ids: np.ndarray, prints: np.ndarray, column: pa.Array, number: int) -> list[dict]:
        data, offsets = tx.raw(column)
        first, run, doc, anchor, content, at = segments(data, offsets, length, gram)
        start = first - offsets[doc]
        order, ahead = _earliest([anchor, content, run], ids[doc], start)
        packed = np.empty(len(order), SEGMENT)
        packed["anchor"], packed["content"] = anchor >> np.uint64(32), content
        packed["start"], packed["doc"], packed["run"], packed["at"] = start, doc, run, at
        again = packed[order[~ahead]]
        # rows that repeat an id and a text have the same places; they are not earlier than each other
        known = np.empty(len(again), NOTE)
        known["start"], known["doc"] = again["start"], again["doc"]
        leader = order[np.maximum.accumulate(np.where(ahead, np.arange(len(order)), 0))][~ahead]
        same_place = (ids[doc[leader]] == ids[again["doc"]]) & (start[leader] == again["start"])
        known, twins = known[~same_place], order[~ahead][same_place]
        keep = np.sort(np.concatenate([order[ahead], twins]))
        bucket = ((anchor[keep] & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        bucket, own = bucket[by], packed[keep[by]]
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        none = dict.fromkeys(_ASKED.names)
        out = [{**none, "bucket": int(bucket[a]), "slice": number, "rows": own[a:b].tobytes(), "ids": ids[np.unique(own["doc"][a:b])].tobytes()}
               for a, b in zip(cuts, [*cuts[1:], len(bucket)])]
        out.append({**none, "bucket": -1 - number, "slice": number, "rows": known.tobytes(),
                    "ids": ids.tobytes(), "prints": prints.tobytes()})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, prints = (batch.column(i).to_numpy() for i in (0, 1))
            column = tx.text_array(batch.column(2))
            for a, b in tx.slices(column, SLICE_BYTES):
                for x in range(a, b, 0xFFFF):
                    y = min(b, x + 0xFFFF)
                    yield pa.RecordBatch.from_pylist(rows(ids[x:y], prints[x:y], column.slice(x, y - x), number), _ASKED)
                    number += 1
    return run


def _answer(buckets: int):
    """A bucket: per slice the segments that repeat an earlier one, and the contested first places."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        slices = table["slice"]
        if bucket < 0:
            return pa.table({"slice": slices, "repeats": table["rows"], "contested": pa.nulls(table.num_rows, pa.binary()),
                             "ids": table["ids"], "prints": table["prints"]})
        parts = [np.frombuffer(r, SEGMENT) for r in table["rows"].to_pylist()]
        seg = np.concatenate(parts)
        ids = np.concatenate([np.frombuffer(i, np.int64)[np.unique(x["doc"], return_inverse=True)[1]]
                              for i, x in zip(table["ids"].to_pylist(), parts)])  # a row names its documents once
        order, first = _earliest([seg["anchor"], seg["content"], seg["run"]], ids, seg["start"])
        leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        at_first = (ids[leader] == ids[order]) & (seg["start"][leader] == seg["start"][order])
        anchors = seg["anchor"][order]
        edge = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
        several = np.repeat(np.add.reduceat(first, edge) > 1, np.diff(np.append(edge, len(order))))
        repeat, contest = np.zeros(len(seg), bool), np.zeros(len(seg), bool)
        repeat[order[~at_first]] = True
        contest[order[at_first & several]] = True
        cuts = np.cumsum([0, *map(len, parts)])
        repeats, contested = [], []
        for a, b in zip(cuts[:-1], cuts[1:]):
            own = seg[a:b]
            x = own[repeat[a:b]]
            note = np.empty(len(x), NOTE)
            note["start"], note["doc"] = x["start"], x["doc"]
            y = own[contest[a:b]]
            rows = np.empty(len(y), CONTESTED)
            for name in CONTESTED.names:
                rows[name] = y[name]
            repeats.append(note.tobytes())
            contested.append(rows.tobytes())
        none = pa.nulls(len(parts), pa.binary())
        return pa.table({"slice": slices, "repeats": pa.array(repeats, pa.binary()), "contested": pa.array(contested, pa.binary()),
                         "ids": none, "prints": none})
    return run


def _noted(table: pa.Table) -> pa.Table:
    """A slice: a row for every document with a repeated or contested segment."""
    rows = table.to_pylist()
    head = next(r for r in rows if r["ids"] is not None)
    ids, prints = np.frombuffer(head["ids"], np.int64), np.frombuffer(head["prints"], np.int64)
    repeats = np.frombuffer(b"".join(r["repeats"] for r in rows), NOTE)
    contested = np.frombuffer(b"".join(r["contested"] or b"" for r in rows), CONTESTED)
    repeats, contested = repeats[np.argsort(repeats["doc"], kind="stable")], contested[np.argsort(contested["doc"], kind="stable")]
    docs = np.union1d(repeats["doc"], contested["doc"]).astype(np.int64)

    def packed(x: np.ndarray) -> list[bytes]:
        low, high = np.searchsorted(x["doc"], docs), np.searchsorted(x["doc"], docs, "right")
        return [x[a:b].tobytes() for a, b in zip(low, high)]

    return pa.table({"id": ids[docs], "print": prints[docs], "repeats": pa.array(packed(repeats), pa.binary()),
                     "contested": pa.array(packed(contested), pa.binary())})


# --- suffix order ------------------------------------------------------------------

def _side(found: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(found, digest_size=8).digest(), "little", signed=True)


def parts_of(text: bytes, start: int, run: int, at: int, length: int, gram: int) -> list[tuple[int, int, bytes]]:
    """A segment's windows in two parts: (key, first window, bytes).

    Windows that reach at least half of what they hold besides the anchor to its left share these bytes and the
    anchor, the others the anchor and more than the other half to its right."""
    half, anchor = (length - gram) // 2, start + at
    left = min(max(at - half + 1, 0), run)
    out = []
    if left:
        out.append((_side(b"l" + text[anchor - half:anchor + gram]), start, text[start:start + left + length - 1]))
    if left < run:
        out.append((_side(b"r" + text[anchor:anchor + length - half + 1]), start + left, text[start + left:start + run + length - 1]))
    return out


def _cut_out(length: int, gram: int):
    """Bytes of contested segments in parts, each with its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = tx.text_array(batch.column("text"))
            for i in range(batch.num_rows):
                rows = np.frombuffer(batch.column("contested")[i].as_py(), CONTESTED)
                if not len(rows):
                    continue
                text = column[i].as_buffer().to_pybytes()
                found = [x for s, r, a in zip(*(rows[n].tolist() for n in ("start", "run", "at"))) for x in parts_of(text, s, r, a, length, gram)]
                key, start, held = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, pa.int64()), pa.array([batch.column("id")[i].as_py()] * len(found), pa.int64()),
                     pa.array([batch.column("print")[i].as_py()] * len(found), pa.int64()), pa.array(start, pa.int64()), pa.array(held, pa.binary())],
                    ["key", "id", "print", "start", "bytes"])
    return run


def spill_folder() -> str:
    """Where Spark lets this task's process keep its spill files."""
    found = (os.environ.get("SPARK_LOCAL_DIRS") or "").split(",")[0]
    return tempfile.mkdtemp(prefix="suffixes-", dir=found if found and os.path.isdir(found) else None)


def repeated_windows(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, data: np.ndarray, length: int, folder: str) -> np.ndarray:
    """For segments that follow each other in ``data``: which of its places begin a string of ``length``
    bytes that also begins at an earlier (id, start)."""
    n = len(sizes)
    total = int(sizes.sum()) + n
    x = np.empty(total, np.int64) if total <= KEPT * 2 else np.memmap(f"{folder}/text", np.int64, "w+", shape=(total,))
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    read = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(n):
        x[begin[k]:begin[k] + sizes[k]] = data[read[k]:read[k + 1]].astype(np.int64) + n
        x[begin[k] + sizes[k]] = k
    out = np.zeros(total, bool)

    def settle(places: np.ndarray, group: np.ndarray) -> None:
        of = np.searchsorted(begin, places, "right") - 1
        start = starts[of] + places - begin[of]
        order, first = _earliest([group], ids[of], start)
        leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        later = (ids[of[leader]] != ids[of[order]]) | (start[leader] != start[order])
        out[places[order[later]]] = True

    held, number = [], 0  # a group of equal strings may go on in the next batch
    for position, shared in Sorter(x, n, f"{folder}/levels").falling(length):
        group = number + np.cumsum(shared < length)
        number = int(group[-1])
        held.append((position.copy(), group))
        if sum(len(p) for p, _ in held) >= CHUNK and held[0][1][0] != number:
            places, groups = (np.concatenate(v) for v in zip(*held))
            done = groups < number
            held = [(places[~done], groups[~done])]
            _settle_groups(settle, places[done], groups[done])
    if held:
        places, groups = (np.concatenate(v) for v in zip(*held))
        _settle_groups(settle, places, groups)
    return np.concatenate([out[begin[k]:begin[k] + sizes[k]] for k in range(n)]) if n else out


def _settle_groups(settle, places: np.ndarray, group: np.ndarray) -> None:
    if len(group):
        same = np.concatenate([[False], group[1:] == group[:-1]])
        same |= np.append(same[1:], False)
        settle(places[same], group[same])


def _contest(key: np.ndarray, content: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of parts: which repeat an earlier equal one altogether, and which are to be sorted."""
    order, first = _earliest([key, content], ids, starts)
    leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    at_first = (ids[leader] == ids[order]) & (starts[leader] == starts[order])
    keys = key[order]
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    several = np.repeat(np.add.reduceat(first, edge) > 1, np.diff(np.append(edge, len(order))))
    again, sort = np.zeros(len(order), bool), np.zeros(len(order), bool)
    again[order[~at_first]] = True
    sort[order[at_first & several]] = True
    return again, sort


def _sort_shards(length: int):
    """All parts of this task's shards -> for each the runs of places that begin a repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = spill_folder()
        try:
            keys, sizes, digests, total = [], [], [], 0
            with open(f"{folder}/all", "wb") as f:
                for batch in batches:
                    keys.append(batch.select(["key", "id", "print", "start"]))
                    sizes.append(np.asarray(pc.binary_length(batch.column("bytes"))).astype(np.int64))
                    for value in batch.column("bytes"):
                        held = value.as_buffer()
                        digests.append(hashlib.blake2b(held, digest_size=8).digest())
                        f.write(held)
                        total += held.size
            if not total:
                return
            sizes = np.concatenate(sizes)
            table = pa.Table.from_batches(keys).combine_chunks()
            key, ids, starts = (table[n].to_numpy() for n in ("key", "id", "start"))
            repeat, sort = _contest(key, np.frombuffer(b"".join(digests), np.int64), ids, starts)
            del digests
            spans = [b""] * len(sizes)
            for k in np.flatnonzero(repeat).tolist():
                spans[k] = np.array([0, sizes[k] - length + 1], "<u4").tobytes()
            chosen = np.flatnonzero(sort)
            if len(chosen):
                begin = np.concatenate([[0], np.cumsum(sizes)])
                whole = np.memmap(f"{folder}/all", np.uint8, "r", shape=(total,))
                with open(f"{folder}/bytes", "wb") as f:
                    for k in chosen.tolist():
                        f.write(whole[begin[k]:begin[k + 1]])
                own = sizes[chosen]
                data = np.memmap(f"{folder}/bytes", np.uint8, "r", shape=(int(own.sum()),))
                found = repeated_windows(ids[chosen], starts[chosen], own, data, length, folder)
                begin = np.concatenate([[0], np.cumsum(own)])
                for n, k in enumerate(chosen.tolist()):
                    part = found[begin[n]:begin[n + 1] - length + 1]
                    spans[k] = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0)).astype("<u4").tobytes()
            for batch in table.drop_columns(["key"]).append_column("spans", pa.array(spans, pa.binary())).to_batches():
                yield batch
        finally:
            shutil.rmtree(folder, ignore_errors=True)
    return run


# --- removal -----------------------------------------------------------------------

FOUND = np.dtype([("begin", "<u4"), ("end", "<u4")])


def removed_runs(size: int, first: np.ndarray, run: np.ndarray, repeats: np.ndarray, spans: list[tuple[int, bytes]], length: int) -> np.ndarray:
    """Rows (begin, end) of maximal runs of bytes of a text that repeats cover."""
    whole = np.isin(first, repeats)
    begins = [first[whole]]
    ends = [first[whole] + run[whole] + length - 1]
    for start, edges in spans:
        edge = np.frombuffer(edges, "<u4").astype(np.int64).reshape(-1, 2)
        begins.append(start + edge[:, 0])
        ends.append(start + edge[:, 1] + length - 1)
    begins, ends = np.concatenate(begins), np.concatenate(ends)
    if not len(begins):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], begins[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    return np.stack([begins[at], reach[np.append(at[1:], len(reach)) - 1]], axis=1)


def _remove(length: int, gram: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = tx.text_array(batch.column("text"))
            repeats, spans = batch.column("repeats"), batch.column("spans")
            rows = []
            for i in range(batch.num_rows):
                text = column[i].as_buffer().to_pybytes()
                kept, cut = text, np.zeros((0, 2), np.int64)
                notes = repeats[i].as_py()
                if notes is not None:
                    starts = np.frombuffer(notes, NOTE)["start"]
                    data = np.frombuffer(text, np.uint8)
                    first, run_, *_ = segments(data, np.array([0, len(data)]), length, gram)
                    found = [(s["start"], s["spans"]) for s in spans[i].as_py() or ()]
                    cut = removed_runs(len(text), first, run_, starts, found, length)
                    edges = [0, *cut.ravel().tolist(), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), kept))
            size, gone, runs, digest, left = zip(*rows)
            made = [batch.column("id"), *(pa.array(v, pa.int64()) for v in (size, gone, runs)), pa.array(digest, pa.string())]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                made.append(pa.array(left, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(made, names)
    return run


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   with_text: bool = False) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of what is
    left; ``with_text`` adds the remaining bytes themselves."""
    gram = min(GRAM, max(1, length // 2))
    if length - gram + 1 > MOST_WINDOWS:
        raise ValueError(f"length may be at most {MOST_WINDOWS + gram - 1}")
    own = _own(df, id_col, text_col)
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, 2 * size // (length - gram + 1) // BUCKET_ROWS)  # a segment every half anchor window
    asked = own.mapInArrow(_ask(buckets, length, gram), _ASKED_SQL)
    told = asked.groupBy("bucket").applyInArrow(_answer(buckets), _TOLD_SQL)
    noted = told.groupBy("slice").applyInArrow(_noted, _INFO_SQL).dropDuplicates(["id", "print"])
    info = materialize(noted, "repeat-notes")
    amount = info.agg(F.sum(F.octet_length("contested"))).first()[0] or 0
    shards = max(1, int(amount / CONTESTED.itemsize * (length + 30)) // SHARD_BYTES)
    # texts and notes both grow with the corpus: merge joins at every size
    contested = info.where(F.octet_length("contested") > 0).select("id", "print", "contested")
    cut = own.join(contested.hint("merge"), ["id", "print"]).mapInArrow(
        _cut_out(length, gram), "key long, id long, print long, start long, bytes binary")
    sorted_ = cut.repartition(shards, "key").mapInArrow(
        _sort_shards(length), "id long, print long, start long, spans binary")
    spans = materialize(sorted_.where(F.octet_length("spans") > 0), "repeat-spans")
    by_doc = spans.groupBy("id", "print").agg(F.collect_set(F.struct("start", "spans")).alias("spans"))
    notes = info.select("id", "print", "repeats").join(by_doc, ["id", "print"], "left").where(
        (F.octet_length("repeats") > 0) | F.col("spans").isNotNull())
    result = own.join(notes.hint("merge"), ["id", "print"], "left").select("id", "text", "repeats", "spans").mapInArrow(
        _remove(length, gram, with_text), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
        + (", kept binary" if with_text else ""))
    shown = F.when(F.col("id") != LAST_ID, F.col("id")).alias(id_col)
    return result.select(shown, *result.columns[1:])
