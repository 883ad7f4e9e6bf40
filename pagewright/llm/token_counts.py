"""Token counts of a unigram model, by dynamic programming over a trie.

A text is cut into pre-tokens at blanks, each with the word mark in front. The
pieces of a vocabulary file are a unigram model (log-probability by Zipf's law
from the rank), and a pre-token's tokens are its most probable split; of
equally probable ones, that with the fewest tokens. The distinct pre-tokens of
a slice of texts are inserted in a trie, all of them a letter at a time, and
the best score and count of every prefix are computed once, when its node is
made; pre-tokens that share a prefix share its node. The count of a whole
pre-token is that of the node it ends at.

An automaton over the pieces names those that end at a letter, so a node looks
at no others. A letter that is no piece is its UTF-8 bytes. The trie belongs to
one executor process and is dropped between insertions when it has more than
``NODES`` nodes; counts don't depend on it.
"""

from __future__ import annotations

import math
import re
from collections import deque
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import arrow_schema, no_clash, slices, table

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
NODES = 500_000
NODE = np.dtype([("score", np.float64), ("tokens", np.int64), ("state", np.int64)])
#: Pre-tokens that are inserted at a time.
WORDS = 1 << 14
#: Longer pre-tokens are scored by the same steps, but not kept in the trie.
LONGEST_KEPT = 64
#: How much less probable a byte is than the rarest piece.
BYTE_PENALTY = 10.0

_WORD = re.compile("[^\\x20\\x09-\\x0D]+")
#: The bytes of UTF-8 that no match of ``_WORD`` has.
_BLANK = np.array([not _WORD.match(chr(b)) for b in range(256)])


@lru_cache(maxsize=1)
def pieces(vocabulary: str) -> dict[str, float]:
    """Log-probability of each piece of a sentencepiece file; special and byte pieces left out."""
    import public_tokenizers
    import sentencepiece

    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
             if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = math.log(sum(1 / r for r in range(1, len(names) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(names, 1)}


class Automaton:
    """Reads letters (code points) and knows the pieces that end with the last one read.

    State 0 is the first; ``pieces[state]`` are ``(length, score)`` of those pieces.
    """

    def __init__(self, scores: dict[str, float]):
        self.goto: dict[int, int] = {}  # state and letter to the state after it
        last, edges = [""], []
        for piece in scores:
            state = 0
            for n, letter in enumerate(map(ord, piece), 1):
                after = self.goto.setdefault(state << 21 | letter, len(last))
                if after == len(last):
                    last.append(piece[:n])
                    edges.append((n, state, letter, after))
                state = after
        self.shorter = [0] * len(last)  # the state of the longest shorter ending
        self.pieces: list[tuple] = [()] * len(last)
        for n, state, letter, after in sorted(edges):
            if state:
                self.shorter[after] = self.read(self.shorter[state], letter)
            own = scores.get(last[after])
            self.pieces[after] = (() if own is None else ((n, own),)) + self.pieces[self.shorter[after]]
        # the same as arrays; the first piece is none
        self.keys, self.after = np.array([*sorted(self.goto.items()), (1 << 62, 0)], np.int64).T.copy()
        self.shorters = np.array(self.shorter)
        self.begin = np.cumsum([1, *map(len, self.pieces)])
        self.length = np.array([0, *(n for ps in self.pieces for n, _ in ps)])
        self.score = np.array([0.0, *(s for ps in self.pieces for _, s in ps)])

    def read(self, state: int, letter: int) -> int:
        """The state after one more letter."""
        after = self.goto.get(state << 21 | letter)
        while after is None and state:
            state = self.shorter[state]
            after = self.goto.get(state << 21 | letter)
        return after or 0

    def read_each(self, states: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The state after one more letter, of each state."""
        out, left = np.zeros(len(states), np.int64), np.arange(len(states))
        while len(left):
            key = states << 21 | letters[left]
            at = np.searchsorted(self.keys, key)
            known = self.keys[at] == key
            out[left[known]] = self.after[at[known]]
            more = ~known & (states > 0)
            left, states = left[more], self.shorters[states[more]]
        return out


class Trie:
    """Nodes are numbers; ``best[node]`` is the best score, fewest tokens and automaton's state of its prefix."""

    def __init__(self, scores: dict[str, float]):
        self.automaton = Automaton(scores)
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.clear()

    def clear(self):
        self.best, self.nodes = np.zeros(1 << 10, NODE), 1
        # for each depth, the node above and the letter, in order, and the node that they lead to
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def _step(self, letters: np.ndarray, paths: np.ndarray) -> np.ndarray:
        """``best`` of prefixes one letter longer than those whose nodes, from the root down, are the ``paths``."""
        size = letters.astype(np.int64)
        size = 1 + (size >= 0x80) + (size >= 0x800) + (size >= 0x10000)
        out = np.empty(len(letters), NODE)
        out["state"] = self.automaton.read_each(self.best["state"][paths[:, -1]], letters)
        # the ways to each prefix: the bytes of its last letter, then the pieces that end there
        begin = self.automaton.begin[out["state"]]
        ways = self.automaton.begin[out["state"] + 1] - begin + 1
        first = np.cumsum(ways) - ways
        row = np.repeat(np.arange(len(ways)), ways)
        piece = np.arange(len(row)) + (begin - 1 - first)[row]
        length, score = self.automaton.length[piece], self.automaton.score[piece]
        length[first], score[first] = 1, size * self.byte
        before = paths[row, paths.shape[1] - length]
        score += self.best["score"][before]
        tokens = self.best["tokens"][before] + 1
        tokens[first] += size - 1
        out["score"] = np.maximum.reduceat(score, first)
        tokens[score < out["score"][row]] = np.iinfo(np.int64).max
        out["tokens"] = np.minimum.reduceat(tokens, first)
        return out

    def _insert(self, letters: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Tokens of sorted pre-tokens; their prefixes get nodes, a depth at a time, where they have none."""
        rows, paths = np.arange(len(size)), np.zeros((len(size), size.max(initial=0) + 1), np.int64)
        for depth in range(paths.shape[1] - 1):
            rows = rows[size[rows] > depth]
            key = paths[rows, depth] << 21 | letters[begin[rows] + depth]
            other = np.append(True, key[1:] != key[:-1])  # equal prefixes are neighbours
            one, key = rows[other], key[other]
            if depth == len(self.levels):
                self.levels.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            keys, below = self.levels[depth]
            at = np.searchsorted(keys, key)
            new = np.append(keys, -1)[at] != key
            node = np.append(below, 0)[at]
            if new.any():
                node[new] = self._add(self._step(letters[begin[one[new]] + depth], paths[one[new], :depth + 1]))
                keys, below = np.append(keys, key[new]), np.append(below, node[new])
                order = np.argsort(keys, kind="stable")
                self.levels[depth] = keys[order], below[order]
            paths[rows, depth + 1] = node[np.cumsum(other) - 1]
        return self.best["tokens"][paths[np.arange(len(size)), size]]

    def _add(self, best: np.ndarray) -> np.ndarray:
        nodes = np.arange(self.nodes, self.nodes + len(best))
        self.nodes += len(best)
        if self.nodes > len(self.best):
            self.best = np.append(self.best, np.zeros(self.nodes, NODE))
        self.best[nodes] = best
        return nodes

    def _alone(self, word: str) -> int:
        best, state = deque([(0.0, 0)], max(1, self.longest)), 0  # only the last ``longest`` prefixes matter
        for letter in word:
            n = len(letter.encode())
            score, tokens = best[-1][0] + n * self.byte, best[-1][1] + n
            state = self.automaton.read(state, ord(letter))
            for length, s in self.automaton.pieces[state]:
                before, k = best[-length]
                s += before
                if s > score or s == score and k + 1 < tokens:
                    score, tokens = s, k + 1
            best.append((score, tokens))
        return best[-1][1]

    def counts(self, words: pa.LargeStringArray) -> np.ndarray:
        """Tokens of distinct pre-tokens."""
        out, order = np.zeros(len(words), np.int64), pc.sort_indices(words).to_numpy()
        for i in range(0, len(order), WORDS):
            if self.nodes > NODES:
                self.clear()
            part = words.take(pa.array(order[i:i + WORDS]))
            ends, data = buffers(part)
            letters = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
            if len(letters) < len(data):
                ends = np.append(0, np.cumsum(data & 0xC0 != 0x80))[ends]
            begin, size = ends[:-1], np.diff(ends)
            long = size > LONGEST_KEPT
            out[order[i:i + WORDS][~long]] = self._insert(letters, begin[~long], size[~long])
            for j in np.flatnonzero(long):
                out[order[i + j]] = self._alone(part[j].as_py())
        return out

    def count(self, word: str) -> int:
        return int(self.counts(pa.array([word], pa.large_string()))[0])


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts of a large Arrow column without nulls begin and the last one ends, and their bytes."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return ends - ends[0], np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]


def pretokens(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The matches of ``_WORD`` in all texts, and how many of them stand before each text and after the last."""
    ends, data = buffers(pc.fill_null(texts.cast(pa.large_binary()), b""))
    visible = ~_BLANK[data]
    apart = np.ones(len(data) + 1, bool)  # no word goes on from the letter before this place
    apart[1:-1] = ~visible[:-1]
    apart[ends] = True
    begin = np.flatnonzero(visible & apart[:-1])
    apart[:-1] |= ~visible
    size = np.flatnonzero(visible & apart[1:]) + 1 - begin
    places = np.append(0, np.cumsum(size))
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(places), pa.py_buffer(data[visible]))
    return words.dictionary_encode(), np.searchsorted(begin, ends)


@lru_cache(maxsize=1)
def trie(vocabulary: str) -> Trie:
    return Trie(pieces(vocabulary))


def token_counts(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``keep``, ``n_pretokens`` and ``n_tokens`` of each row's ``text``; null and empty texts have none of either.

    Repeated rows come back repeated. Columns outside ``keep`` are ignored; one
    in ``keep`` that has a result's name is an error.
    """
    no_clash(keep, ("n_pretokens", "n_tokens"))
    full = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_pretokens", T.LongType()),
                                                          T.StructField("n_tokens", T.LongType())])
    arrow = arrow_schema(full)

    def run(batches):
        counts = trie(vocabulary).counts
        for b in slices(batches):
            words, rows = pretokens(b.column(b.schema.get_field_index("text")))
            marked = pc.binary_join_element_wise(pa.scalar(MARK, pa.large_string()), words.dictionary,
                                                 pa.scalar("", pa.large_string()))
            tokens = np.append(0, np.cumsum(counts(marked)[words.indices.to_numpy()]))[rows]
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in keep]
                                             + [pa.array(np.diff(rows), pa.int64()), pa.array(np.diff(tokens), pa.int64())],
                                             schema=arrow)

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, full)


def op3_token_counts(spark, sf_dir):
    """Query: pre-tokens and unigram tokens of every document."""
    return token_counts(table(spark, sf_dir, "documents"), ["doc_id"])
