"""Best-fit packing: a configuration linear program over the length histogram, then rounding.

Documents become token pieces of at most ``capacity`` tokens.  The histogram of
piece lengths has at most ``capacity`` entries, so the program that fills
sequences is solved on the driver at a cost that does not grow with the corpus:
multiplicative weights hold a price per length, a knapsack dynamic program finds
the configurations (multisets of lengths) that are worth most at these prices,
they are used for part of the pieces and their prices fall, until every length is
covered.  Numbers of sequences are rounded down; what that leaves is filled best
fit, whole runs of equal sequences at a time.  Plans from all, some and none of the
configurations are compared, and the one with the fewest sequences counts.  The plan is a table of (length, rank range)
-> sequences; pieces get their rank within their length in Spark and look it up.

Defined results: null and empty texts are one piece (the end token alone); rows
that repeat are packed each; a null id is carried; an empty table packs nothing.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from feedloom.llm import arrow
from feedloom.llm import text as tx
from feedloom.session import materialize

CAPACITY = 4096
END_ID = 1
STEP = 0.5   # of a length's pieces that a round covers at most
RATE = 1.0
GAP = 0.0005  # of the best worth that a configuration may lack
SHARE = 64   # one in so many open lengths gets its configuration in any case
RANK_ROWS = 8192  # pieces of one length that are numbered together, about
MEMO = 1 << 19  # runs of letters or punctuation that a worker remembers
LEARNT = 1 << 14  # runs encoded together
PROBE = 16  # one in so many pieces of the vocabulary is tried on the model alone
SLICE_BYTES = 1 << 20

#: Bytes of ASCII letters, and of punctuation that every Unicode version treats alike.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK[list(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")] = True


def runs_of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all words: bytes, starts, ends, whether it is a run, and the first of each word (one more entry).

    A simple word, one run of letters (A-Z and U+00C0 to U+00FF) and one of punctuation or none, is those runs,
    lower-cased; its ids are theirs.  Any other word stays whole and as it is."""
    low, letter, mark = tx.lower(data), _LETTER[data], _MARK[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    next_ = data[lead + 1]
    lead = lead[(next_ >= 0x80) & (next_ < 0xC0) & (next_ != 0x97) & (next_ != 0xB7)]
    letter[lead] = letter[lead + 1] = True
    capital = lead[data[lead + 1] < 0x9F] + 1
    low[capital] += 0x20
    bad = ~(letter | mark)
    bad[1:] |= mark[:-1] & letter[1:]
    bad[starts] = ~letter[starts]
    total = np.concatenate([np.zeros(1, np.int32), np.cumsum(bad, dtype=np.int32)])
    simple = total[ends] == total[starts]
    whole = np.flatnonzero(~simple)
    at = _places(starts[whole], ends[whole] - starts[whole])
    low[at] = data[at]
    turn = np.flatnonzero(letter[:-1] & mark[1:]) + 1
    word = np.searchsorted(starts, turn, "right") - 1
    turn, word = turn[simple[word]], word[simple[word]]
    parts = np.ones(len(starts), np.int64)
    parts[word] = 2
    first = np.concatenate([[0], np.cumsum(parts)])
    begin, end = np.repeat(starts, parts), np.repeat(ends, parts)
    end[first[word]] = begin[first[word] + 1] = turn
    return low, begin, end, np.repeat(simple, parts), first


def _places(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one after the other."""
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(first - edges[:-1], sizes) + np.arange(edges[-1])


def _spell(text: str, spelled: dict[str, str]) -> str:
    for ch, piece in spelled.items():
        text = text.replace(ch, piece)
    return text


def _spelling(encoder, probe: list[str]) -> dict[str, str] | None:
    """How the tokenizer spells a run's characters for its model, or None if runs so spelled do not get from the
    model alone the ids that the tokenizer gives them, each character and some of ``probe`` tried."""
    if encoder.pre_tokenizer is None:
        return None
    letters = [chr(c) for c in [*range(0x61, 0x7B), *range(0xDF, 0x100)] if c != 0xF7]
    marks = [chr(c) for c in np.flatnonzero(_MARK)]
    spelled = {}
    for ch in letters + marks:
        text = encoder.normalizer.normalize_str(ch) if encoder.normalizer else ch
        piece = "".join(p for p, _ in encoder.pre_tokenizer.pre_tokenize_str(text))
        if piece != ch:
            spelled[ch] = piece
    runs = [*letters, *marks, "".join(letters), *(p for p in probe if p and (set(p) <= set(letters) or set(p) <= set(marks)))]
    for run, e in zip(runs, encoder.encode_batch(runs, add_special_tokens=False)):
        if [t.id for t in encoder.model.tokenize(_spell(run, spelled))] != e.ids:
            return None
    return spelled


class WordIds:
    """Token ids of words, each run of a word encoded once while it is remembered.

    For tokenizers that drop white space and end every run of letters or punctuation in a token
    marked so, the ids of a text are those of its words one after the other, and those of a word are
    those of its runs.  Runs are known by 64-bit hashes; their ids lie in one pool.  When MEMO runs
    are known, those met once are forgotten, and if that is not enough, all but those of the slice at hand."""

    def __init__(self, path: str, word_end: str = "</w>"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith(word_end)]] = True
        self.spelled = _spelling(self.encoder, [p.removesuffix(word_end) for p in sorted(vocabulary)[::PROBE]])
        self.known = np.zeros(0, np.uint64)  # ascending
        self.first = np.zeros(0, np.int64)   # of each known run's ids in the pool
        self.size = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)       # met by a later slice
        self.pool = np.zeros(0, "<u4")

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and where each word's begin (one more entry)."""
        data, starts, ends, simple, word = runs_of_words(data, starts, ends)
        hashes = tx.mix(tx.word_hashes(data, starts, ends) + (ends - starts).astype(np.uint64))
        distinct, which = np.unique(hashes, return_inverse=True)
        at = np.empty(len(distinct), np.int64)
        at[which] = np.arange(len(which))
        place = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.known)
        new[inside] = self.known[place[inside]] != distinct[inside]
        self.again[place[~new]] = True
        if new.any():
            self._learn(distinct[new], *self._ids(data, starts[at[new]], ends[at[new]], simple[at[new]]), place[~new])
            place = np.searchsorted(self.known, distinct)
        sizes = self.size[place][which]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        return self.pool[_places(self.first[place][which], sizes)], edges[word]

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray, used: np.ndarray) -> None:
        if len(self.known) + len(hashes) > MEMO:
            keep = np.flatnonzero(self.again)
            keep = keep if len(keep) <= MEMO // 2 else used
            self.pool = self.pool[_places(self.first[keep], self.size[keep])]
            self.known, self.size = self.known[keep], self.size[keep]
            self.first, self.again = np.cumsum(self.size) - self.size, np.zeros(len(keep), bool)
        at = np.searchsorted(self.known, hashes)
        self.first = np.insert(self.first, at, len(self.pool) + np.cumsum(sizes) - sizes)
        self.size, self.again = np.insert(self.size, at, sizes), np.insert(self.again, at, False)
        self.known, self.pool = np.insert(self.known, at, hashes), np.concatenate([self.pool, ids])

    def _ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, simple: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs and whole words, one after the other, and how many each has."""
        found, sizes = [], np.zeros(len(starts), np.int64)
        runs = np.flatnonzero(simple)
        for k in range(0, len(runs), LEARNT):
            own = runs[k:k + LEARNT]
            ids, sizes[own] = self._run_ids(data, starts[own], ends[own])
            found.append(ids)
        whole = np.flatnonzero(~simple)
        ids, sizes[whole] = self._each(data, starts[whole], ends[whole])
        found = np.concatenate([*found, ids])
        order = np.concatenate([runs, whole])
        first = np.empty(len(starts), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return found[_places(first, sizes)], sizes

    def _run_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = ends - starts + 1
        joined = data[np.minimum(_places(starts, sizes), len(data) - 1)]
        joined[np.cumsum(sizes) - 1] = 0x20
        text = joined[:-1].tobytes().decode("utf-8", "replace")
        if self.spelled is not None and "\ufffd" not in text:
            tokenize = self.encoder.model.tokenize
            found = [[t.id for t in tokenize(run)] for run in _spell(text, self.spelled).split(" ")]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), "<u4", sizes.sum()), sizes
        ids = np.array(self.encoder.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(starts) and cuts[-1] == len(ids):
            return ids, np.diff(cuts, prepend=0)
        return self._each(data, starts, ends)  # a tokenizer that does not mark the ends

    def _each(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist())]
        ids = [np.array(e.ids, "<u4") for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, "<u4"), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))


_encoders: dict[str, WordIds] = {}  # kept by a worker from task to task


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32 (and ``ids``, little-endian 32-bit, if asked for)."""
    end = np.array([end_id], "<u4").tobytes()
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    fields = [own.schema["id"], StructField("piece", IntegerType()), *(StructField(n, LongType()) for n in ("start", "length", "ids_crc32"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _encoders.setdefault(tokenizer_path, None) or WordIds(tokenizer_path)
        _encoders[tokenizer_path] = memo
        for batch in batches:
            column = tx.text_array(batch.column(1))
            for a, b in tx.slices(column, SLICE_BYTES):
                data, offsets = tx.raw(column.slice(a, b - a))
                starts, ends, first = tx.word_spans(data, offsets)
                flat, edges = memo.encode(data, starts, ends)
                flat, bounds = flat.tobytes(), (4 * edges[first]).tolist()
                rows = []
                for i, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
                    ids = flat[low:high] + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        rows.append((a + i, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
                at, piece, start, length, crc, parts = zip(*rows)
                made = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    made.append(pa.array(parts, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(made, names)

    if with_ids:
        fields.append(StructField("ids", BinaryType()))
    return own.mapInArrow(arrow.giving_back(run), StructType(fields)).withColumnRenamed("id", id_col)


def knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack over ascending ``lengths``: worth[c] is the best for capacity c, item[c] the
    length taken last, -1: none."""
    worth = np.zeros(capacity + 1)
    item = np.full(capacity + 1, -1, np.int64)
    falling = np.full(capacity, -np.inf)  # prices by length, the longest first
    falling[capacity - lengths] = prices
    place = np.full(capacity + 1, -1, np.int64)
    place[lengths] = np.arange(len(lengths))
    for c in range(1, capacity + 1):
        tried = worth[:c] + falling[capacity - c:]
        best = int(tried.argmax())  # of equals the longest
        worth[c] = worth[c - 1]
        if tried[best] > worth[c]:
            worth[c], item[c] = tried[best], place[c - best]
    return worth, item


def best_configuration(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``capacity`` long, that is worth most: an unbounded knapsack."""
    _, item = knapsack(lengths, prices, capacity)
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        if item[c] < 0:
            c -= 1
            continue
        length = int(lengths[item[c]])
        found[length] = found.get(length, 0) + 1
        c -= length
    return found


def _configuration(first: int, lengths: np.ndarray, prices: np.ndarray, worth: np.ndarray, item: np.ndarray,
                   may: np.ndarray, capacity: int) -> tuple[dict[int, int], float]:
    """The knapsack's configuration around one length, with no more copies of any than ``may``, and its
    worth.  Where the knapsack's choice is used up, the best of the lengths that are not."""
    found, value, c = {first: 1}, prices[first], capacity - int(lengths[first])
    free = None  # not used up when last looked
    while c > 0:
        k = int(item[c])
        if k < 0:
            c -= 1
            continue
        if may[k] < found.get(k, 0) + 1:
            if free is None:
                free = np.flatnonzero(may >= 1)
            fit = free[:np.searchsorted(lengths[free], c, "right")]
            own = [i for i, n in found.items() if may[i] < n + 1]
            for i in own:
                fit = fit[fit != i]
            if not len(fit):
                break
            k = int(fit[(prices[fit] + worth[c - lengths[fit]]).argmax()])
        found[k] = found.get(k, 0) + 1
        value += prices[k]
        c -= int(lengths[k])
    return found, value


def fractional_plan(histogram: dict[int, int], capacity: int, rounds: int | None = None) -> list[tuple[dict[int, int], float]]:
    """Configurations and numbers of sequences, by multiplicative weights, until every length is covered.

    A length's weight starts at its tokens and falls by exp(-RATE x covered share).  A round solves one
    knapsack and takes from it a configuration around every length, best first, as long as they are worth
    at least 1 - GAP of the best, and for at least one in SHARE of the open lengths; it covers at most STEP
    of the pieces of a length (the last two whole).  Covered lengths leave.  ``rounds`` bounds the rounds."""
    lengths = np.array(sorted(x for x in histogram if x < capacity), np.int64)
    pieces = np.array([histogram[x] for x in lengths], float)
    covered = np.zeros(len(lengths))
    plan: dict[tuple, float] = {}
    done = 0
    while rounds is None or done < rounds:
        open_ = np.flatnonzero(pieces > covered)
        if not len(open_):
            break
        done += 1
        own, left = lengths[open_], (pieces - covered)[open_]
        prices = own * np.exp(-RATE * covered[open_] / pieces[open_])
        worth, item = knapsack(own, prices, capacity)
        may = np.where(left <= 2, left, np.ceil(STEP * left))
        through = prices + worth[capacity - own]
        used, least = 0, -(-len(open_) // SHARE)
        for k in np.lexsort((-own, -through)).tolist():
            if used >= least and through[k] < (1 - GAP) * worth[capacity]:
                break
            if may[k] < 1:
                continue
            found, value = _configuration(k, own, prices, worth, item, may, capacity)
            if used >= least and value < (1 - GAP) * worth[capacity]:
                continue
            at, copies = np.fromiter(found, np.int64), np.fromiter(found.values(), float)
            times = float((may[at] // copies).min())
            may[at] -= times * copies
            covered[open_[at]] += times * copies
            key = tuple(sorted((int(own[i]), n) for i, n in found.items()))
            plan[key] = plan.get(key, 0.0) + times
            used += 1
    return [(dict(key), times) for key, times in plan.items()]


def rounded_plan(histogram: dict[int, int], fractional: list[tuple[dict[int, int], float]],
                 capacity: int) -> list[tuple[dict[int, int], int]]:
    """Whole numbers of sequences that hold every piece: rounded down, then best fit over what is left."""
    left = {x: n for x, n in histogram.items() if n > 0}
    plan = []

    def use(found: dict[int, int], times: int) -> None:
        plan.append((found, times))
        for length, copies in found.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]

    if left.get(capacity):
        use({capacity: 1}, left[capacity])
    for found, times in fractional:
        times = min([int(times), *(left.get(x, 0) // n for x, n in found.items())])
        if times > 0:
            use(found, times)
    order = sorted(left)
    while order:
        found, room = {}, capacity
        k = len(order)
        while k:  # the longest that fits, as often as it fits
            length = order[k - 1]
            copies = min(room // length, left[length])
            if copies:
                found[length] = copies
                room -= copies * length
            k = min(k - 1, bisect_right(order, room))
        use(found, min(left[x] // n for x, n in found.items()))
        order = [x for x in order if x in left]
    return plan


def best_plan(histogram: dict[int, int], capacity: int, rounds: int | None = None) -> list[tuple[dict[int, int], int]]:
    """The rounded plan with the fewest sequences among those that use all of the program's configurations, a part
    of them (the first found are worth most), or none: plain best fit, which is never beaten by the plan."""
    found = fractional_plan(histogram, capacity, rounds)
    plans = [rounded_plan(histogram, found[:len(found) * k // 4], capacity) for k in (4, 3, 2, 1, 0)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def sequences_needed(histogram: dict[int, int], capacity: int) -> int:
    """A lower bound: the tokens over the capacity, and the dual value of prices 1 / (copies that fit)."""
    lengths = np.array(sorted(histogram), np.int64)
    pieces = np.array([histogram[x] for x in lengths], float)
    most = 0.0
    for prices in (lengths.astype(float), 1.0 / (capacity // lengths), np.where(2 * lengths > capacity, 1.0, np.where(3 * lengths > capacity, 0.5, 0.0))):
        worth, _ = knapsack(lengths, prices, capacity)
        if worth[capacity] > 0:
            most = max(most, float(pieces @ prices) / float(worth[capacity]))
    return -int(-(most - 1e-9) // 1)


def slots(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, copies in a sequence, first offset), by length and rank."""
    rows, next_rank, sequence = [], {}, 0
    for found, times in plan:
        offset = 0
        for length in sorted(found, reverse=True):
            rank = next_rank.get(length, 0)
            rows.append((length, rank, sequence, found[length], offset))
            next_rank[length] = rank + found[length] * times
            offset += length * found[length]
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY, rounds: int | None = None) -> DataFrame:
    """``pieces`` (a stored table with a ``length`` column) with sequence_id and offset.

    ``keys`` order pieces of a length; rows equal in all of them may take each other's place."""
    histogram = {int(r["length"]): int(r["n"]) for r in
                 pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    if any(x > capacity or x < 1 for x in histogram):
        raise ValueError(f"piece lengths must lie between 1 and {capacity}")
    table = slots(best_plan(histogram, capacity, rounds))
    lots = max(1, -(-sum(histogram.values()) // RANK_ROWS))
    dealt = pieces.withColumn("p_lot", F.pmod(F.xxhash64(*keys), F.lit(lots)))
    own = Window.partitionBy("length", "p_lot")
    before = Window.partitionBy("length").orderBy("p_lot").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy("length", "p_lot").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("p_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    ranked = (dealt.withColumn("p_rank", F.row_number().over(own.orderBy(*keys)) - 1)
              .join(counts, ["length", "p_lot"]).withColumn("p_rank", F.col("p_rank") + F.col("p_before")))
    ranked = ranked.select(*pieces.columns, F.col("p_rank").cast("long").alias("p_rank"))
    span = 1 + int(max(histogram.values(), default=0))
    place = table[:, 0] * span + table[:, 1]  # at most 4096 x pieces: fits 64 bits up to 2e15 pieces

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("p_rank").to_numpy()
            row = table[np.searchsorted(place, length * span + rank, "right") - 1]
            nth = rank - row[:, 1]
            made = [row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *map(pa.array, made)],
                                             [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return ranked.mapInArrow(arrow.giving_back(run), schema)


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack: a row per piece with its sequence and place there."""
    pieces = token_pieces(df, tokenizer_path, id_col, text_col, capacity, end_id, with_ids)
    return pack(materialize(pieces, "token-pieces"), [id_col, "piece", "ids_crc32"], capacity)
