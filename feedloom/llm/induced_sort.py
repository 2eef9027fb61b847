"""External induced sorting of the suffixes of a text, with common-prefix lengths.

The text lies in a file, integers with a sentinel of its own after every
segment; all larger structures are files too.  Suffixes pass through queues
that live on disk: one per range of first characters, first in first out, which
is their order (whatever induces into a range does so in ascending, or on the
way back descending, order).  S* suffixes are sorted by their S*-substrings
first, these get names, and the string of names is sorted by the same procedure
until all names differ.  On the last way up and down every suffix tuple carries
the length of the prefix that it shares with the one before it, up to ``depth``:
one more than the least of those that passed since the last push to its queue.

Work is done in numpy batches.  A batch is a range of characters as far as it
does not induce into itself; a range of one character goes on in rounds.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np

from feedloom.llm.text import mix, powers

CHUNK = 1 << 17       # suffixes handled at once
RANGE = 1 << 13       # suffixes in a range of several characters, about
HELD = 1 << 21        # queued tuples in memory; beyond it they go to disk
KEPT = 1 << 21        # rows of any other array in memory; beyond it it is a file


class File:
    """A growing array of int64 rows; beyond KEPT rows it is on disk, until ``drop``."""

    def __init__(self, path: str, width: int = 2):
        self.path, self.width, self.rows = path, width, 0
        self.parts: list[np.ndarray] = []
        self.out = None

    def add(self, rows: np.ndarray) -> None:
        self.rows += len(rows)
        self.parts.append(np.array(rows, np.int64))
        if self.out is None and self.rows > KEPT:
            self.out = open(self.path, "wb")
        if self.out is not None:
            for part in self.parts:
                part.tofile(self.out)
            self.parts.clear()

    def done(self) -> np.ndarray:
        if self.out is not None:
            self.out.close()
            return np.memmap(self.path, np.int64, "r", shape=(self.rows, self.width))
        self.parts = [np.concatenate(self.parts)] if self.parts else [np.zeros((0, self.width), np.int64)]
        return self.parts[0]

    def drop(self) -> None:
        self.parts.clear()
        if self.out is not None:
            self.out.close()
            os.remove(self.path)


class Queue:
    """A priority queue on disk over ranges of characters: rows (character, position, prefix length)."""

    def __init__(self, folder: str, starts: np.ndarray):
        self.folder, self.starts = folder, starts
        self.buffers: dict[int, list[np.ndarray]] = {}
        self.read: dict[int, int] = {}
        self.written: dict[int, int] = {}
        self.held = 0
        os.makedirs(folder)

    def push(self, rows: np.ndarray) -> None:
        if not len(rows):
            return
        of = np.searchsorted(self.starts, rows[:, 0], "right") - 1
        order = np.argsort(of, kind="stable")
        rows, of = rows[order], of[order]
        cuts = np.flatnonzero(np.diff(of, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(of)]):
            self.buffers.setdefault(int(of[a]), []).append(rows[a:b])
        self.held += len(rows)
        if self.held > HELD:
            for r, parts in self.buffers.items():
                with open(f"{self.folder}/{r}", "ab") as f:
                    for part in parts:
                        part.tofile(f)
                        self.written[r] = self.written.get(r, 0) + len(part)
            self.buffers.clear()
            self.held = 0

    def take(self, r: int, most: int | None = None) -> np.ndarray:
        """The oldest rows of a range, at most so many (None: all)."""
        out, got = [], 0
        at, end = self.read.get(r, 0), self.written.get(r, 0)
        if at < end:
            n = end - at if most is None else min(most, end - at)
            out.append(np.fromfile(f"{self.folder}/{r}", np.int64, 3 * n, offset=24 * at).reshape(-1, 3))
            self.read[r] = at + n
            got = n
        if r in self.buffers and (most is None or got < most) and self.read.get(r, 0) == end:
            rows = np.concatenate(self.buffers.pop(r))
            n = len(rows) if most is None else min(most - got, len(rows))
            out.append(rows[:n])
            self.held -= n
            if n < len(rows):
                self.buffers[r] = [rows[n:]]
        return np.concatenate(out) if out else np.zeros((0, 3), np.int64)

    def drop(self, r: int | None = None) -> None:
        """Forget a range that is done with, or all."""
        for x in [r] if r is not None else list(self.written):
            if self.written.pop(x, None) is not None:
                os.remove(f"{self.folder}/{x}")


class Least:
    """Least prefix length that has passed since the last push to each character."""

    def __init__(self, low: int, characters: int, depth: int):
        self.low, self.depth = low, depth
        self.since = np.full(characters, -1, np.int64)

    def passed(self, lengths: np.ndarray, at: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """``lengths`` pass; at places ``at`` suffixes are pushed to ``chars``: the lengths they get."""
        got = np.zeros(len(at), np.int64)
        own = chars - self.low
        order = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[order], prepend=-1))
        least = int(lengths.min())
        after = np.minimum(self.since, least)
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            places = at[order[a:b]]
            c = own[order[a]]
            found = np.minimum.reduceat(lengths, np.concatenate([[0], places[:-1] + 1]))
            # the first part runs from the begin; the others from after a place, all up to the next one
            ends = np.concatenate([places[1:] + 1, [len(lengths)]])
            if len(places) > 1:
                found[-1] = lengths[places[-2] + 1:places[-1] + 1].min()
            else:
                found[0] = lengths[:places[0] + 1].min()
            found[0] = min(found[0], self.since[c])
            got[order[a:b]] = np.minimum(found + 1, self.depth)
            rest = lengths[places[-1] + 1:ends[-1]]
            after[c] = rest.min() if len(rest) else self.depth
        self.since = after
        return got


class Sorter:
    """One level: sorts the suffixes of ``x``, whose values below ``sentinels`` are unique segment ends."""

    def __init__(self, x: np.ndarray, sentinels: int, folder: str):
        self.x, self.sentinels, self.folder, self.n = x, sentinels, folder, len(x)
        os.makedirs(folder, exist_ok=True)
        self.small = np.zeros(self.n, bool) if self.n <= 8 * KEPT else np.memmap(f"{folder}/types", bool, "w+", shape=(self.n,))
        next_value, next_type = -1, True
        for end in range(self.n, 0, -CHUNK):
            begin = max(0, end - CHUNK)
            block = np.asarray(x[begin:end], np.int64)
            later = np.append(block[1:], next_value)
            is_s = block < later
            same = block == later
            if end == self.n:
                is_s[-1], same[-1] = True, False  # the last sentinel
            elif same[-1]:
                is_s[-1], same[-1] = next_type, False
            decided = np.where(same, len(block), np.arange(len(block)))
            decided = np.minimum.accumulate(decided[::-1])[::-1]
            is_s = is_s[decided]
            self.small[begin:end] = is_s
            next_value, next_type = int(block[0]), bool(is_s[0])
        self.highest = int(max(x[a:a + CHUNK].max() for a in range(0, self.n, CHUNK)))
        counts = np.zeros(self.highest + 1, np.int64)
        for a in range(0, self.n, CHUNK):
            counts += np.bincount(x[a:a + CHUNK], minlength=self.highest + 1)
        self.counts = counts
        passes = 0

        def scratch(name: str) -> str:
            nonlocal passes
            passes += 1
            return f"{folder}/{name}{passes}"

        self.scratch = scratch

    def stars(self) -> np.ndarray:
        out = File(self.scratch("stars"), 1)
        before = True
        for a in range(0, self.n, CHUNK):
            s = np.asarray(self.small[a:a + CHUNK])
            found = np.flatnonzero(s & ~np.append(before, s[:-1]))
            before = s[-1]
            out.add(found[:, None] + a)
        return out.done()[:, 0]

    def ranges(self, alone: bool) -> np.ndarray:
        """First characters of the ranges: as many characters as have RANGE suffixes; with ``alone``
        every character above the sentinels for itself."""
        above = self.sentinels if alone else self.highest + 1
        total = np.cumsum(self.counts[:above])
        starts = np.flatnonzero(np.diff(total // RANGE, prepend=-1)) if above else np.zeros(0, np.int64)
        heavy = np.flatnonzero(self.counts[:above] > RANGE)
        starts = np.union1d(starts, np.concatenate([heavy, heavy[heavy + 1 < above] + 1]))
        return np.union1d(starts, np.arange(above, self.highest + 1)) if alone else starts

    def prefix(self, p: int, q: int, depth: int) -> int:
        a, b = np.asarray(self.x[p:p + depth]), np.asarray(self.x[q:q + depth])
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def induce(self, seeds: np.ndarray, lengths: np.ndarray | None, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """From S* suffixes in order (``lengths``: the prefix each shares with the one before) all suffixes
        but the sentinels, in descending order: positions, and the prefix shared with the one before."""
        starts = self.ranges(lengths is not None)
        ends = np.append(starts[1:], self.highest + 1)
        measure = lengths is not None
        heavy = ends - starts == 1
        out, offsets = File(self.scratch("up")), [0]
        queue = Queue(self.scratch("queue"), starts)
        least = Least(self.sentinels, self.highest + 1 - self.sentinels, depth) if measure else None
        seed_at = np.concatenate([[0], np.cumsum(np.add.reduceat(
            np.bincount(self.x[seeds], minlength=self.highest + 1), starts))]) if len(seeds) else np.zeros(len(starts) + 1, np.int64)
        last = -1

        def up(rows: np.ndarray) -> None:
            """Suffixes pass in ascending order; L suffixes before them are pushed."""
            nonlocal last
            position = rows[:, 1]
            pred = position - 1
            ok = (pred >= 0)
            ok[ok] = ~self.small[pred[ok]]
            at = np.flatnonzero(ok)
            chars = self.x[pred[at]].astype(np.int64)
            got = least.passed(rows[:, 2], at, chars) if measure else np.zeros(len(at), np.int64)
            queue.push(np.stack([chars, pred[at], got], axis=1))
            last = int(position[-1])

        for r in range(len(starts)):
            a, b = int(seed_at[r]), int(seed_at[r + 1])
            if heavy[r]:
                seen = False
                while len(rows := queue.take(r, CHUNK)):
                    out.add(rows[:, 1:])
                    up(rows)
                    seen = True
                for k in range(a, b, CHUNK):
                    own = np.asarray(seeds[k:min(b, k + CHUNK)])
                    rows = np.stack([np.full(len(own), starts[r]), own, lengths[k:k + len(own)] if measure else np.zeros_like(own)], axis=1)
                    if measure and seen and k == a:
                        rows[0, 2] = self.prefix(last, int(own[0]), depth)
                    up(rows)
            else:
                own = np.asarray(seeds[a:b])
                waiting = np.stack([2 * self.x[own].astype(np.int64) + 1, own, np.zeros_like(own)], axis=1)
                while True:
                    new = queue.take(r)
                    if len(new):
                        new[:, 0] *= 2
                        waiting = np.concatenate([waiting, new])
                    if not len(waiting):
                        break
                    waiting = waiting[np.argsort(waiting[:, 0], kind="stable")]
                    pred = waiting[:, 1] - 1
                    ok = pred >= 0
                    ok[ok] = ~self.small[pred[ok]]
                    chars = self.x[pred[ok]]
                    inside = chars[chars < ends[r]]
                    cut = int(np.searchsorted(waiting[:, 0], 2 * int(inside.min()), "right")) if len(inside) else len(waiting)
                    rows, waiting = waiting[:cut], waiting[cut:]
                    out.add(rows[rows[:, 0] % 2 == 0, 1:])
                    up(rows)
            queue.drop(r)
            offsets.append(out.rows)
        rising = out.done()

        queue = Queue(self.scratch("queue"), starts)
        least = Least(self.sentinels, self.highest + 1 - self.sentinels, depth) if measure else None

        def down(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            nonlocal last
            position = rows[:, 1]
            pred = position - 1
            ok = pred >= 0
            ok[ok] = self.small[pred[ok]]
            ok[ok] = self.x[pred[ok]] >= self.sentinels
            at = np.flatnonzero(ok)
            chars = self.x[pred[at]].astype(np.int64)
            got = least.passed(rows[:, 2], at, chars) if measure else np.zeros(len(at), np.int64)
            queue.push(np.stack([chars, pred[at], got], axis=1))
            last = int(position[-1])
            return position, rows[:, 2]

        for r in range(len(starts) - 1, -1, -1):
            if ends[r] <= self.sentinels:
                break
            a, b = offsets[r], offsets[r + 1]
            if heavy[r]:
                seen = False
                while len(rows := queue.take(r, CHUNK)):
                    yield down(rows)
                    seen = True
                for end in range(b, a, -CHUNK):
                    begin = max(a, end - CHUNK)
                    block = np.asarray(rising[begin:end])[::-1]
                    # falling, a suffix shares with the one before it what that one shared with it rising
                    shared = np.append(0, block[:-1, 1])
                    if measure:
                        if end < b:
                            shared[0] = int(rising[end, 1])
                        elif seen:
                            shared[0] = self.prefix(last, int(block[0, 0]), depth)
                    yield down(np.stack([np.full(len(block), starts[r]), block[:, 0], shared], axis=1))
            else:
                block = np.asarray(rising[a:b])[::-1]
                waiting = np.stack([2 * self.x[block[:, 0]].astype(np.int64), block[:, 0], np.zeros(len(block), np.int64)], axis=1)
                while True:
                    new = queue.take(r)
                    if len(new):
                        new[:, 0] = 2 * new[:, 0] + 1
                        waiting = np.concatenate([waiting, new])
                    if not len(waiting):
                        break
                    waiting = waiting[np.argsort(-waiting[:, 0], kind="stable")]
                    pred = waiting[:, 1] - 1
                    ok = pred >= 0
                    ok[ok] = self.small[pred[ok]]
                    chars = self.x[pred[ok]]
                    inside = chars[(chars >= max(starts[r], self.sentinels))]
                    cut = int(np.searchsorted(-waiting[:, 0], -(2 * int(inside.max()) + 1), "right")) if len(inside) else len(waiting)
                    rows, waiting = waiting[:cut], waiting[cut:]
                    yield down(rows)
            queue.drop(r)
        out.drop()

    def names(self, stars: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """S* positions by their S*-substrings, the name of each, and how many (the first) are sentinels:
        one that follows another sentinel is no S*.

        A name is the place of the first of its equals.  Character by character, with its type, the
        substrings that are still alike are put in order among themselves."""
        length = np.diff(np.append(stars, self.n - 1)) + 1
        chars = np.asarray(self.x[stars], np.int64)
        place = np.searchsorted(np.sort(chars), chars)
        alike = np.flatnonzero((np.bincount(place, minlength=len(stars) + 1)[place] > 1) & (length > 1))
        step = 1
        while len(alike):
            at = stars[alike] + step
            key = 2 * np.asarray(self.x[at], np.int64) + self.small[at]
            order = np.lexsort((key, place[alike]))
            alike, key = alike[order], key[order]
            group = place[alike]
            edge = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
            first = np.flatnonzero(edge)
            begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            size = np.diff(np.append(first, len(alike)))
            before = np.repeat(first, size) - np.repeat(begin, np.diff(np.append(begin, len(alike))))
            place[alike] = group + before
            step += 1
            alike = alike[(np.repeat(size, size) > 1) & (length[alike] > step)]
        order = np.argsort(place, kind="stable")
        ranked = place[order]
        name = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]])) if len(order) else order
        return stars[order], name, int((chars < self.sentinels).sum())

    def sorted_stars(self) -> np.ndarray:
        stars = self.stars()
        ordered, name, sentinels = self.names(stars)
        if not len(stars) or name[-1] == len(stars) - 1:
            return ordered
        reduced = np.empty(len(stars), np.int64)
        reduced[np.searchsorted(stars, ordered)] = name
        below = Sorter(reduced, sentinels, f"{self.folder}/below")
        falling = np.concatenate([p for p, _ in below.induce(below.sorted_stars(), None, 0)] or [np.zeros(0, np.int64)])
        ends = np.flatnonzero(reduced < sentinels)
        ends = ends[np.argsort(reduced[ends])]
        return stars[np.concatenate([ends, falling[::-1]])]

    def prefixes(self, seeds: np.ndarray, depth: int) -> np.ndarray:
        """Prefix that each of the S* suffixes shares with the one before it, counted in the text in steps of
        powers of two: equal spans have equal sums of hashed characters times powers of an odd number."""
        shared = np.zeros(len(seeds), np.int64)
        if len(seeds) < 2:
            return shared
        sums = np.zeros(self.n + 1, np.uint64)
        down = np.empty(self.n + 1, np.uint64)
        scale = np.ones(1, np.uint64)
        for a in range(0, self.n, CHUNK):
            block = np.asarray(self.x[a:a + CHUNK]).astype(np.uint64)
            up, back = powers(len(block))
            sums[a + 1:a + 1 + len(block)] = sums[a] + np.cumsum(mix(block + np.uint64(1)) * up[:-1] * scale)
            down[a:a + len(block)] = back[:-1] * (down[a - 1:a] * back[1:2] if a else scale)
            scale = scale * up[-1:]
        first, second = seeds[1:].copy(), seeds[:-1].copy()
        step = 1 << (depth - 1).bit_length()
        found = np.zeros(len(first), np.int64)
        while step:
            ok = (np.maximum(first, second) + step <= self.n) & (found + step <= depth)
            i, j = first[ok], second[ok]
            ok[ok] = (sums[i + step] - sums[i]) * down[i] == (sums[j + step] - sums[j]) * down[j]
            first[ok] += step
            second[ok] += step
            found[ok] += step
            step >>= 1
        shared[1:] = found
        return shared

    def falling(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes but the sentinels in descending order, with the prefix (up to ``depth``) that each
        shares with the one before it."""
        seeds = self.sorted_stars()
        shared = self.prefixes(seeds, depth)
        yield from self.induce(seeds, shared, depth)
