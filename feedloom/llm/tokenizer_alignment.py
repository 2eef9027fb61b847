"""Cross-tokenizer alignment: how often an id of one tokenizer ends where an id of another does.

Two tokenizers read the same bytes, a space and the text.  Byte offsets where tokens
of both end cut a text into groups; the two tokens that end there are a link.  The
pairs of linked ids are indexed the inverted way: documents are dealt into chunks, and
a posting (chunk, pair) holds, as compressed bitmaps over the chunk's documents, the bit
planes of how often each document holds the pair linked.  OR-merged planes, popcounted,
give the documents of a pair; planes, popcounted and weighted, give its links.  Sums over
postings are the corpus-wide counts of pairs, and the postings, joined with these and dealt
by chunk, return a score to every document.

Both tokenizers are asked only about *units*, stretches of text that begin at a space
after a character that is not white space: no token of either crosses such a place.  A unit
is encoded once while a worker remembers it, many new ones in one call.

Defined results: a null or empty text, and one that a tokenizer does not give back byte
for byte, has no tokens: zeros, and '' as its digest.  Rows that repeat are counted each;
a null id is carried; an empty table gives an empty table.  Postings of a chunk are bounded
by its text (CHUNK_BYTES, or one longer text), those of a pair by the number of chunks.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, ByteType, IntegerType, LongType, StringType, StructField, StructType

from feedloom.llm import text as tx
from feedloom.session import materialize

CHUNK_BYTES = 8 << 20   # text of a chunk, about
CHUNK_ROWS = 1 << 15    # documents of a chunk: their numbers fit 16 bits
SLICE_BYTES, SLICE_ROWS = 2 << 20, 1 << 13
MEMO = 1 << 19          # units that a worker remembers
MEMO_BYTES = 48 << 20   # and the bytes of their group texts

SPACE = 0x20
MARK = "▁".encode()
COMMA, BAR, SEMICOLON = b",|;"


class ByteLevel:
    """A byte-level tokenizer file: ids of a text as it is, and the bytes of every id."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        vocabulary = self.tokenizer.get_vocab()
        self.pieces = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.pieces[i] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class Pieces:
    """A sentencepiece model: ids of a text that begins with the space which the model itself adds."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            self.pieces.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text[1:])


class _Table:
    """Byte strings by number, for taking many at once."""

    def __init__(self, strings: list[bytes]):
        self.pool = np.frombuffer(b"".join(strings), np.uint8)
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))
        self.first = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.pool[_spread(self.first[ids], self.size[ids])]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] of them), first[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _after_text(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character surely other than white space ends before each place ``at`` (3 or more bytes in;
    False: white space, or a character that shares its first bytes with some)."""
    b1, b2, b3 = data[at - 1], data[at - 2], data[at - 3]
    tail = (b1 >= 0x80) & (b1 < 0xC0)
    two = tail & (b2 >= 0xC3) & (b2 < 0xE0)
    three = tail & (b2 >= 0x80) & (b2 < 0xC0) & (b3 >= 0xE2) & (b3 < 0xF0)
    odd = (b3 == 0xE2) & (b2 <= 0x81) | (b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)
    return (b1 > SPACE) & (b1 < 0x7F) | two | three & ~odd


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units begin in texts that each begin with a space, and the first unit of each text (one more entry)."""
    at = np.flatnonzero(data == SPACE)
    at = at[at >= 3]
    inner = at[_after_text(data, at)]
    inner = inner[~np.isin(inner + 1, offsets)]  # a lone space at a text's end is no unit: a model adds none to nothing
    begins = np.zeros(len(data) + 1, bool)
    begins[inner] = begins[offsets[:-1]] = True
    starts = np.flatnonzero(begins)
    return starts, np.searchsorted(starts, offsets)


class Aligner:
    """Groups and links of units, each found once while it is remembered."""

    def __init__(self, first: str, second: str):
        self.a, self.b = ByteLevel(first), Pieces(second)
        if max(len(self.a.pieces), len(self.b.pieces)) > 1 << 16:
            raise ValueError("ids beyond 16 bits")
        self.a_bytes, self.b_bytes = _Table(self.a.pieces), _Table(self.b.pieces)
        self.digits = _Table([str(i).encode() for i in range(max(len(self.a.pieces), len(self.b.pieces)))])
        self.known, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # hashes, ascending, and their slots
        self.texts: list[bytes] = []  # groups of each unit, every one followed by a semicolon
        self.bytes = 0
        self.n_a, self.n_b, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.links, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def _forget(self) -> None:
        """What was met in one slice only goes; all goes where that is not half of it."""
        stays = (self.uses > 1) & (np.fromiter(map(len, self.texts), np.int64, len(self.texts)) < 1 << 10)
        if 2 * stays.sum() > min(MEMO, len(stays)):
            stays[:] = False
        place = np.cumsum(stays) - 1
        held = stays[self.slot]
        self.known, self.slot = self.known[held], place[self.slot[held]]
        size = np.diff(self.first)[stays]
        self.links = self.links[_spread(self.first[:-1][stays], size)]
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.texts = [self.texts[k] for k in np.flatnonzero(stays).tolist()]
        self.bytes = sum(map(len, self.texts))
        self.n_a, self.n_b, self.uses = self.n_a[stays], self.n_b[stays], np.ones(int(stays.sum()), np.int64)

    def slots(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The slot of every unit; n_a is -1 where a tokenizer does not give the unit back."""
        hashes = tx.mix(tx.word_hashes(data, starts, ends) + (ends - starts).astype(np.uint64))
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = ~self._knows(distinct)
        if len(self.known) + new.sum() > MEMO or self.bytes > MEMO_BYTES:
            self._forget()
            new = ~self._knows(distinct)
        if new.any():
            self._learn([data[a:b].tobytes() for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist())])
            known = np.concatenate([self.known, distinct[new]])
            slot = np.concatenate([self.slot, np.arange(len(self.slot), len(known))])
            order = np.argsort(known, kind="stable")
            self.known, self.slot = known[order], slot[order]
        slots = self.slot[np.searchsorted(self.known, distinct)]
        self.uses[slots] += 1
        return slots[which]

    def _knows(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), bool)
        return self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] == hashes

    def _learn(self, words: list[bytes]) -> None:
        plain = np.fromiter((MARK not in w for w in words), bool, len(words))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        plain &= _after_text(np.frombuffer(b"  " + b"".join(words), np.uint8), ends + 2)
        texts: list[bytes] = [b""] * len(words)
        n_a, n_b, n_links = np.full(len(words), -1), np.full(len(words), -1), np.zeros(len(words), np.int64)
        links: list[np.ndarray] = [np.zeros(0, np.int64)] * len(words)

        def take(places: list[int]) -> bool:
            found = self._aligned([words[k] for k in places])
            if found is None:
                return False
            for k, text, a, b, pairs in zip(places, *found):
                texts[k], n_a[k], n_b[k], links[k], n_links[k] = text, a, b, pairs, len(pairs)
            return True

        together = np.flatnonzero(plain).tolist()
        alone = np.flatnonzero(~plain).tolist()
        if together and not take(together):
            alone += together
        for k in alone:
            take([k])
        self.texts += texts
        self.bytes += sum(map(len, texts))
        self.n_a, self.n_b = np.concatenate([self.n_a, n_a]), np.concatenate([self.n_b, n_b])
        self.uses = np.append(self.uses, np.zeros(len(words), np.int64))
        self.links = np.concatenate([self.links, *links])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_links)])

    def _aligned(self, words: list[bytes]):
        """Of units read in one go: group texts, numbers of ids, links (first id << 16 | second); None where
        a tokenizer does not give the bytes back, or not cut at the ends of units."""
        whole = b"".join(words)
        text = whole.decode()
        a, b = np.array(self.a.encode(text), np.int64), np.array(self.b.encode(text), np.int64)
        for ids, table in ((a, self.a_bytes), (b, self.b_bytes)):
            if not len(ids) or table.joined(ids).tobytes() != whole:
                return None
        a_ends, b_ends = np.cumsum(self.a_bytes.size[a]), np.cumsum(self.b_bytes.size[b])
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        if not np.isin(ends, both, assume_unique=True).all():
            return None
        a_to, b_to = np.searchsorted(a_ends, both, "right"), np.searchsorted(b_ends, both, "right")  # ids up to a group's end
        a_at = np.arange(len(a)) + np.concatenate([[0], b_to])[np.searchsorted(both, a_ends)]
        b_at = np.arange(len(b)) + a_to[np.searchsorted(both, b_ends)]
        ids = np.empty(len(a) + len(b), np.int64)
        mark = np.full(len(ids), COMMA, np.uint8)
        ids[a_at], ids[b_at] = a, b
        mark[a_at[a_to - 1]], mark[b_at[b_to - 1]] = BAR, SEMICOLON
        size = self.digits.size[ids] + 1
        to = np.cumsum(size)
        text = np.empty(to[-1], np.uint8)
        text[to - 1] = mark
        text[_spread(to - size, size - 1)] = self.digits.joined(ids)
        group, a_n, b_n = (np.searchsorted(x, ends, "right") for x in (both, a_ends, b_ends))
        cut = [0, *to[a_n + b_n - 1].tolist()]
        raw, links = text.tobytes(), a[a_to - 1] << 16 | b[b_to - 1]
        n = np.concatenate([[0], group])
        return ([raw[x:y] for x, y in zip(cut, cut[1:])], np.diff(a_n, prepend=0).tolist(), np.diff(b_n, prepend=0).tolist(),
                [links[x:y] for x, y in zip(n[:-1].tolist(), n[1:].tolist())])


def postings(pairs: np.ndarray, docs: np.ndarray, rows: int) -> dict[str, pa.Array]:
    """Compressed bit planes of links (pair, document number below ``rows``), ordered by pair.

    A plane is a bitmap of ``rows`` bits, or the 16-bit numbers of its documents where these are shorter."""
    held, times = np.unique(pairs << 16 | docs, return_counts=True)
    pair, doc = held >> 16, held & 0xFFFF
    depth = int(times.max()).bit_length() if len(times) else 0
    bits = [np.flatnonzero(times >> k & 1) for k in range(depth)]
    plane = np.repeat(np.arange(depth), [len(x) for x in bits])
    entry = np.concatenate([np.zeros(0, np.int64), *bits])
    order = np.lexsort((doc[entry], plane, pair[entry]))
    plane, entry = plane[order], entry[order]
    p, d = pair[entry], doc[entry]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (plane[1:] != plane[:-1])
    at = np.flatnonzero(new)                       # first document of each plane
    size = np.diff(np.append(at, len(p)))
    width = (rows + 7) // 8
    dense = 2 * size >= width
    sizes = np.where(dense, width, 2 * size)
    first = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    row, place = np.repeat(np.arange(len(at)), size), np.arange(len(p)) - np.repeat(at, size)
    sparse = ~dense[row]
    data[first[row[sparse]] + 2 * place[sparse]] = d[sparse] & 0xFF
    data[first[row[sparse]] + 2 * place[sparse] + 1] = d[sparse] >> 8
    np.bitwise_or.at(data, first[row[~sparse]] + d[~sparse] // 8, (1 << (d[~sparse] % 8)).astype(np.uint8))
    offsets = np.append(first, len(data)).astype(np.int32)
    binary = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])
    owner = np.ones(len(at), bool)
    owner[1:] = p[at[1:]] != p[at[:-1]]
    lists = pa.array(np.append(np.flatnonzero(owner), len(at)), pa.int32())
    whole, begin = np.unique(pair, return_index=True)
    # popcount of the OR-merged planes: documents; of planes by weight: links
    documents = np.diff(np.append(begin, len(pair)))
    total = np.add.reduceat(times, begin) if len(begin) else np.zeros(0, np.int64)
    return {"pair": pa.array(whole, pa.int64()), "links": pa.array(total, pa.int64()), "documents": pa.array(documents, pa.int64()),
            "planes": pa.ListArray.from_arrays(lists, pa.array(plane[at], pa.int8())), "bits": pa.ListArray.from_arrays(lists, binary)}


def planes_of(planes: pa.ListArray, bits: pa.ListArray, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What ``postings`` has put together, in parts: (number of the posting, document number, times)."""
    own = np.repeat(np.arange(len(bits)), np.diff(np.asarray(bits.offsets)))
    weight = 1 << np.asarray(planes.flatten()).astype(np.int64)
    flat = bits.flatten().cast(pa.large_binary())
    data, offsets = tx.raw(flat)
    size, width = np.diff(offsets), (rows + 7) // 8
    sparse, dense = np.flatnonzero(size < width), np.flatnonzero(size >= width)
    n = size[sparse] // 2
    at = offsets[:-1][sparse].repeat(n) + 2 * _spread(np.zeros(len(n), np.int64), n)
    yield own[sparse].repeat(n), data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8, weight[sparse].repeat(n)
    step = max(1, (1 << 22) // max(8 * width, 1))
    for k in range(0, len(dense), step):
        part = dense[k:k + step]
        grid = np.unpackbits(data[offsets[:-1][part][:, None] + np.arange(width)], axis=1, bitorder="little")
        row, doc = np.nonzero(grid)
        yield own[part][row], doc, weight[part][row]


_DOC = [StructField("n_a", LongType()), StructField("n_b", LongType()), StructField("n_groups", LongType()),
        StructField("groups_sha256", StringType())]
_POSTING = [StructField("pair", LongType()), StructField("links", LongType()), StructField("documents", LongType()),
            StructField("planes", ArrayType(ByteType())), StructField("bits", ArrayType(BinaryType()))]
_aligners: dict[tuple[str, str], Aligner] = {}  # kept by a worker from task to task


@dataclass
class Alignment:
    """What ``align`` found, over written tables.  documents: a row per row of the input, (id, n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256); pairs: (a, b, links, documents) corpus-wide; postings: the index."""

    documents: DataFrame
    pairs: DataFrame
    postings: DataFrame


def _index(df: DataFrame, id_col: str, text_col: str, first: str, second: str) -> DataFrame:
    """Rows of documents (doc_no not null) and postings, by chunk; one written table."""
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    key = own.schema["id"]
    head = [StructField("chunk", LongType()), StructField("doc_no", IntegerType()), StructField("id", key.dataType)]
    schema = StructType([*head, *_DOC, *_POSTING])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        aligner = _aligners.get((first, second)) or _aligners.setdefault((first, second), Aligner(first, second))
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        kinds = None

        def record(n: int, columns: dict) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([columns[f.name] if f.name in columns else pa.nulls(n, kinds[f.name]) for f in schema], schema.names)

        def out() -> Iterator[pa.RecordBatch]:
            ids = pa.concat_arrays([x[0] for x in held])
            n_a, n_b, n_links = (np.concatenate([x[k] for x in held]) for k in (1, 2, 3))
            digests = [s for x in held for s in x[4]]
            links = np.concatenate([x[5] for x in held])
            n = len(ids)
            yield record(n, {"chunk": pa.array([chunk] * n, pa.int64()), "doc_no": pa.array(range(n), pa.int32()), "id": ids,
                             "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_links), "groups_sha256": pa.array(digests, pa.string())})
            found = postings(links, np.repeat(np.arange(n), n_links), n)
            for k in range(0, len(found["pair"]), 1 << 16):
                part = {name: column.slice(k, 1 << 16) for name, column in found.items()}
                rows = len(part["pair"])
                yield record(rows, part | {"chunk": pa.array([chunk] * rows, pa.int64())})

        for batch in batches:
            if kinds is None:
                kinds = {"chunk": pa.int64(), "doc_no": pa.int32(), "id": batch.schema.field(0).type, "n_a": pa.int64(), "n_b": pa.int64(),
                         "n_groups": pa.int64(), "groups_sha256": pa.string(), "pair": pa.int64(), "links": pa.int64(), "documents": pa.int64(),
                         "planes": pa.list_(pa.int8()), "bits": pa.list_(pa.binary())}
            column = tx.text_array(batch.column(1))
            for x, y in ((a, min(a + SLICE_ROWS, z)) for w, z in tx.slices(column, SLICE_BYTES) for a in range(w, z, SLICE_ROWS)):
                part = column.slice(x, y - x)
                held.append((batch.column(0).slice(x, y - x), *_slice(aligner, part)))
                size += tx.raw(part)[1][-1]
                if size >= CHUNK_BYTES or sum(len(h[0]) for h in held) > CHUNK_ROWS - SLICE_ROWS:
                    yield from out()
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield from out()

    return materialize(own.mapInArrow(run, schema), "alignment")


def _slice(aligner: Aligner, column: pa.Array):
    """Of texts: n_a, n_b, n_links, digests, and all links in their order."""
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), column, pa.scalar(" ", pa.large_string()))
    data, offsets = tx.raw(spaced)
    starts, first = units(data, offsets)
    slots = aligner.slots(data, starts, np.append(starts[1:], len(data)))
    own = np.repeat(np.arange(len(column)), np.diff(first))
    bad = np.zeros(len(column), bool)
    bad[own[aligner.n_a[slots] < 0]] = True
    good = ~bad[own]
    slots, own = slots[good], own[good]
    n_a, n_b = (np.bincount(own, x[slots], len(column)).astype(np.int64) for x in (aligner.n_a, aligner.n_b))
    size = np.diff(aligner.first)[slots]
    n_links = np.bincount(own, size, len(column)).astype(np.int64)
    links = aligner.links[_spread(aligner.first[:-1][slots], size)]
    edges, texts, places = np.searchsorted(own, np.arange(len(column) + 1)).tolist(), aligner.texts, slots.tolist()
    digests = [hashlib.sha256(b"".join(map(texts.__getitem__, places[x:y]))[:-1]).hexdigest() if y > x else "" for x, y in zip(edges, edges[1:])]
    return n_a, n_b, n_links, digests, links


def _scored(key: StructField):
    schema = StructType([key, *_DOC[:3], StructField("n_links", LongType()), StructField("n_best", LongType()),
                         StructField("count_sum", LongType()), _DOC[3]])

    def run(docs: pa.Table, held: pa.Table) -> pa.Table:
        rows = docs.num_rows
        links, best, total = (np.zeros(rows, np.int64) for _ in range(3))
        for batch in held.combine_chunks().to_batches():
            count, top = (np.asarray(batch.column(n)).astype(np.int64) for n in ("count", "top"))
            for posting, doc, times in planes_of(batch.column("planes"), batch.column("bits"), rows):
                np.add.at(links, doc, times)
                np.add.at(best, doc, times * top[posting])
                np.add.at(total, doc, times * count[posting])
        at = np.asarray(docs.column("doc_no").combine_chunks())
        return docs.select(["id", "n_a", "n_b", "n_groups"]).append_column("n_links", pa.array(links[at])).append_column(
            "n_best", pa.array(best[at])).append_column("count_sum", pa.array(total[at])).append_column(
            "groups_sha256", docs.column("groups_sha256"))

    return run, schema


def align(df: DataFrame, first: str, second: str, id_col: str = "doc_id", text_col: str = "text") -> Alignment:
    """Align the byte-level tokenizer file ``first`` and the sentencepiece model ``second`` over all texts of ``df``."""
    index = _index(df, id_col, text_col, first, second)
    docs, held = index.where(F.col("doc_no").isNotNull()), index.where(F.col("pair").isNotNull())
    counts = held.groupBy("pair").agg(F.sum("links").alias("count"), F.sum("documents").alias("documents"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(0xFFFF))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    scores = counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("top"))
    returned = (held.select(F.col("chunk").alias("to"), "pair", "planes", "bits").join(scores.hint("merge"), "pair")
                .select("to", "count", "top", "planes", "bits"))
    run, schema = _scored(index.schema["id"])
    own = docs.select("chunk", "doc_no", "id", "n_a", "n_b", "n_groups", "groups_sha256")
    out = own.groupBy("chunk").cogroup(returned.groupBy("to")).applyInArrow(run, schema)
    pairs = counts.select(F.shiftright("pair", 16).cast("int").alias("a"), F.col("b").cast("int").alias("b"), F.col("count").alias("links"), "documents")
    return Alignment(out.select(F.col("id").alias(id_col), *schema.names[1:]), pairs, held.select("chunk", *[f.name for f in _POSTING]))
