"""Greedy word-piece counts by a linear longest-match automaton.

The vocabulary is a trie with two roots, one for the start of a word and one
for its continuation. Each node has a failure link to the node that is reached
when the longest pieces of what was read so far are popped, and the number of
those pieces. A word is then counted in one pass over its characters; no piece
is ever built.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import key_text, python_stage

VOCABULARY = "piece_bpe_32k.model"
#: a word is a run of letters, digits and underscores, or one other mark
_WORDS = re.compile(r"\w+|[^\w\s]")
_NONE = -1


def vocabulary(path: str) -> tuple[list[str], list[str]]:
    """Word-initial and continuation pieces of a SentencePiece model: pieces
    with the word mark start a word, the others continue one. Control,
    unknown and byte pieces are no text."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    first, rest = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
            continue
        piece = sp.id_to_piece(i)
        if piece.startswith("▁"):
            if "▁" not in piece[1:] and len(piece) > 1:
                first.append(piece[1:])
        elif "▁" not in piece:
            rest.append(piece)
    return first, rest


class Automaton:
    """``count(word)``: greedy longest-match pieces, or None where some part
    of the word is in no piece."""

    def __init__(self, first: list[str], rest: list[str]):
        self.child: list[dict[str, int]] = [{}, {}]  # 0: start of a word, 1: continuation
        piece = [False, False]
        for root, words in ((0, first), (1, rest)):
            for w in words:
                node = root
                for c in w:
                    to = self.child[node].get(c)
                    if to is None:
                        to = len(self.child)
                        self.child[node][c] = to
                        self.child.append({})
                        piece.append(False)
                    node = to
                piece[node] = True
        n = len(self.child)
        self.fail, self.popped = [_NONE] * n, [0] * n
        level = [0, 1]
        while level:  # by depth: a link always leads to a shallower remainder
            deeper = []
            for u in level:
                for c, v in self.child[u].items():
                    deeper.append(v)
                    if piece[v]:
                        self.fail[v], self.popped[v] = 1, 1
                        continue
                    node, popped = self.fail[u], self.popped[u]
                    while node != _NONE and c not in self.child[node]:
                        popped += self.popped[node]
                        node = self.fail[node]
                    if node != _NONE:
                        self.fail[v], self.popped[v] = self.child[node][c], popped
            level = deeper

    def count(self, word: str) -> int | None:
        child, fail, popped = self.child, self.fail, self.popped
        node = total = 0
        for c in word:
            while (to := child[node].get(c)) is None:
                total += popped[node]
                node = fail[node]
                if node == _NONE:
                    return None
            node = to
        while node > 1:
            total += popped[node]
            node = fail[node]
            if node == _NONE:
                return None
        return total


class Counter:
    """Word and token counts of whole texts, with a bounded word cache."""

    def __init__(self, path: str, cache: int = 300_000):
        self.count = Automaton(*vocabulary(path)).count
        self.limit = cache
        self.known: dict[str, int] = {}

    def _word(self, word: str) -> int:
        n = self.count(word)
        n = -1 if n is None else n  # unknown words count as one token
        if len(self.known) < self.limit and len(word) <= 64:
            self.known[word] = n
        return n

    def totals(self, text: str) -> tuple[int, int, int]:
        """Words, tokens and unknown words."""
        get, miss = self.known.get, self._word
        words = tokens = unknown = 0
        for m in range(0, len(text), 1 << 20) if len(text) > 1 << 21 else (None,):
            # a very long text goes block by block, cut where a word ends
            found = _WORDS.findall(text) if m is None else _WORDS.findall(_block(text, m))
            counts = [miss(w) if (n := get(w)) is None else n for w in found]
            bad = counts.count(-1)
            words += len(counts)
            tokens += sum(counts) + 2 * bad
            unknown += bad
        return words, tokens, unknown


def _block(text: str, at: int) -> str:
    """The words that begin in ``text[at:at + 2**20]``, whole."""
    size = 1 << 20

    def edge(i: int) -> int:
        while 0 < i < len(text) and _inside(text[i - 1]) and _inside(text[i]):
            i += 1
        return min(i, len(text))

    return text[edge(at):edge(at + size)]


def _inside(c: str) -> bool:
    return c.isalnum() or c == "_" or re.match(r"\w", c) is not None


_LOADED: dict[str, Counter] = {}


def loaded(name: str) -> Counter:
    if name not in _LOADED:
        import public_tokenizers

        _LOADED[name] = Counter(public_tokenizers.path(name))
    return _LOADED[name]


def token_counts(docs: DataFrame, vocabulary_name: str = VOCABULARY, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown`` per row.

    Defined cases: NULL, empty and blank texts have no words and tokens; a
    word outside the vocabulary counts as one (unknown) token; repeated rows
    get equal counts; ids may be NULL; an empty table gives an empty result;
    other columns are ignored.
    """
    source = key_text(docs, id_col, text_col)
    python_stage(docs.sparkSession)
    schema = T.StructType([source.schema["doc_id"], *[T.StructField(c, T.LongType())
                                                      for c in ("n_words", "n_tokens", "n_unknown")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = loaded(vocabulary_name).totals
        for batch in batches:
            got = [totals(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([g[i] for g in got], pa.int64()) for i in range(3)]], schema.names)

    return source.mapInArrow(run, schema)


def op6_token_counts(docs: DataFrame) -> DataFrame:
    """Word-piece counts of every whole text: :func:`token_counts`."""
    return token_counts(docs)
