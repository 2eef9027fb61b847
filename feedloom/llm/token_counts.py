"""Token counts: greedy word-piece lengths by a linear longest-match automaton.

A trie of the vocabulary gets failure links, and with each link the number of
pieces that following it completes.  A word is read once, left to right; the
number of its pieces is the sum of those counts, and no piece is ever built.
A word that begins with no piece that begins words begins with the lone
word-start piece, and a character that no piece covers is its UTF-8 bytes, a
piece each.  Only where the vocabulary lacks these is a word that it cannot
cover one unknown token.

Words are maximal runs other than space and 0x09-0x0D.  Defined results: null
and empty texts have no tokens; repeated rows are counted each; a null id is
carried.  The vocabulary (a fixed-size table) goes to tasks as a broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField

from feedloom.llm import arrow
from feedloom.llm import text as tx

WORD_START = "▁"
MEMO = 1 << 17  # words remembered per task; beyond it the memory starts anew
_UNKNOWN = 1 << 40


def _byte_pieces(ch: str) -> int:
    return len(ch.encode("utf-8", "replace"))


class LongestMatch:
    """The automaton over two tries: pieces that begin words, and pieces that continue them.

    With ``lone`` there is a piece that only marks a word's begin, with ``by_bytes`` a piece for every byte."""

    def __init__(self, begin: list[str], inside: list[str], lone: bool = False, by_bytes: bool = False):
        self.next: list[dict[str, int]] = [{}, {}]  # node 0: a word's begin; node 1: within a word
        self.by_bytes = by_bytes
        ends = [False, False]
        for root, pieces in ((0, begin), (1, inside)):
            for piece in pieces:
                node = root
                for ch in piece:
                    to = self.next[node].get(ch)
                    if to is None:
                        to = self.next[node][ch] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    node = to
                ends[node] |= node > 1
        self.fail: list[int] = [-1] * len(self.next)
        self.popped: list[int] = [0] * len(self.next)
        if lone or by_bytes:  # no piece begins the word: its mark alone, then as within a word
            self.fail[0], self.popped[0] = 1, 1 if lone else len(WORD_START.encode())
        level = [0, 1]
        while level:  # nodes nearer to a root come first: their links are known
            below = []
            for node in level:
                for ch, child in self.next[node].items():
                    below.append(child)
                    if ends[child]:
                        self.fail[child], self.popped[child] = 1, 1
                        continue
                    count, at = self.popped[node], self.fail[node]
                    while at >= 0 and ch not in self.next[at]:
                        count += self.popped[at]
                        at = self.fail[at]
                    if at >= 0:
                        self.fail[child], self.popped[child] = self.next[at][ch], count
                    elif by_bytes:  # no piece begins with the character
                        self.fail[child], self.popped[child] = 1, count + _byte_pieces(ch)
            level = below

    def pieces(self, word: str) -> int:
        """Number of greedy longest-match pieces; 0 if the vocabulary cannot cover the word."""
        node, count = 0, 0
        step, fail, popped = self.next, self.fail, self.popped
        for ch in word:
            to = step[node].get(ch)
            while to is None:
                if fail[node] < 0:
                    if node == 1 and self.by_bytes:
                        count += _byte_pieces(ch)
                        to = 1
                        break
                    return 0
                count += popped[node]
                node = fail[node]
                to = step[node].get(ch)
            node = to
        while node != 1:
            if fail[node] < 0:
                return 0
            count += popped[node]
            node = fail[node]
        return count


class _Memo(dict):
    """Words seen by this task: pieces, and unknown words in the high bits."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        n = self[word] = self.automaton.pieces(word.decode("utf-8", "replace")) or 1 + _UNKNOWN
        return n


def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _pieces(model) -> list[str]:
    ids = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return [model.id_to_piece(i) for i in ids]


def sentencepiece_vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Pieces that begin words and pieces that continue them, from a sentencepiece model file: without
    the lone word-start piece and the byte pieces, so that words are left uncovered."""
    pieces = _pieces(_model(path))
    return ([p[1:] for p in pieces if p.startswith(WORD_START) and len(p) > 1],
            [p for p in pieces if not p.startswith(WORD_START)])


def whole_vocabulary(path: str) -> tuple[list[str], list[str], bool, bool]:
    """All pieces of a sentencepiece model file: those that begin words, those that continue them (all: a
    word may hold the word-start character), and whether the lone word-start and all byte pieces are there."""
    model = _model(path)
    pieces = _pieces(model)
    return ([p[1:] for p in pieces if p.startswith(WORD_START) and len(p) > 1], pieces, WORD_START in pieces,
            sum(model.is_byte(i) for i in range(model.vocab_size())) == 256)


def token_counts(df: DataFrame, vocabulary: tuple, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_tokens (an unknown word is one) and n_unknown.

    ``vocabulary`` is what ``LongestMatch`` takes: two lists of pieces, lone word-start, byte pieces."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def maker():
        memo = _Memo(LongestMatch(*shared.value))

        def make(column: pa.Array) -> list[pa.Array]:
            words = [t.as_buffer().to_pybytes().split() for t in column]  # splits at the same six bytes
            sums = [sum(map(memo.__getitem__, w)) for w in words]
            return [pa.array([len(w) for w in words], pa.int64()),
                    pa.array([s & (_UNKNOWN - 1) for s in sums], pa.int64()),
                    pa.array([s >> 40 for s in sums], pa.int64())]
        return make

    fields = [StructField(n, LongType()) for n in ("n_words", "n_tokens", "n_unknown")]
    return arrow.with_text_columns(df, text_col, fields, maker, [id_col])
