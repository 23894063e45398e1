"""Token counts of a unigram vocabulary, by dynamic programming shared in a trie.

Distinct pre-tokens (white-space words with a word mark in front) are inserted in a trie. The best score of a
prefix depends on the prefix alone, so every trie node is scored once, from the nodes above it, for all
pre-tokens below; the number of tokens is stored where a pre-token ends.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewharf.llm.text import WHITE, Texts, mix, powers, slices

MARK = "▁"
UNKNOWN = -20.0
MEMORY = 1 << 19
LONG = 256  # bytes; a longer word shares no prefix worth a trie, as in texts without spaces
STEP = 1 << 16


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram_scores(path: str) -> dict[bytes, float]:
    """Pieces of a sentencepiece file with log probabilities of a Zipf law over their order.

    Control, unknown and byte pieces are left out. The file is read on the driver; its size is the vocabulary's.
    """
    import sentencepiece

    if not os.path.isfile(path):
        raise FileNotFoundError(path)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = sum(1 / (rank + 2.7) for rank in range(len(names)))
    return {name.encode(): -math.log((rank + 2.7) * total) for rank, name in enumerate(names)}


class Vocabulary:
    """Pieces by the hash of their bytes. Single bytes without a piece count as one unknown token each."""

    def __init__(self, scores: dict[bytes, float]):
        scores = dict(scores)
        for value in range(256):
            scores.setdefault(bytes([value]), UNKNOWN)
        self.longest = max(map(len, scores))
        self.lengths = sorted({len(p) for p in scores})
        self.mark = np.frombuffer(MARK.encode(), np.uint8)
        self.tables = {}
        for n in self.lengths:
            pieces = [p for p in scores if len(p) == n]
            data = np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), n).astype(np.uint64) + np.uint64(1)
            h = mix((data * powers(n)).sum(axis=1, dtype=np.uint64))
            order = np.argsort(h)
            self.tables[n] = h[order], np.array([scores[p] for p in pieces])[order]

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of the best segmentation of each word of ``data``; ties go to the longer last piece."""
        out = np.zeros(len(start), np.int64)
        long = end - start > LONG
        out[~long] = self.shared(data, start[~long], end[~long])
        for i in np.flatnonzero(long):
            out[i] = self.forward(np.concatenate((self.mark, data[start[i] : end[i]])))
        return out

    def _pieces(self, word: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where a piece begins from ``first`` to ``last`` (excluded), its length and score, by place."""
        values = word[first : last + self.longest - 1].astype(np.uint64) + np.uint64(1)
        sums, power, found = np.zeros(last - first, np.uint64), powers(self.longest), []
        for n in range(1, min(self.longest, len(values)) + 1):
            fit = min(last - first, len(values) - n + 1)
            sums[:fit] += values[n - 1 : n - 1 + fit] * power[n - 1]
            if n in self.tables:
                known, score = self.tables[n]
                h = mix(sums[:fit])
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = np.flatnonzero(known[place] == h)
                found.append((hit, np.full(len(hit), n), score[place[hit]]))
        at, n, score = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(at, kind="stable")
        return at[order] + first, n[order], score[order]

    def forward(self, word: np.ndarray) -> int:
        """Tokens of one word, byte by byte, in time and memory in proportion to its length and the longest piece's."""
        size = self.longest + 1  # no piece reaches further, so scores are kept in a ring
        best, tokens, here = [-math.inf] * size, [0] * size, 0
        best[0] = 0.0
        for base in range(0, len(word), STEP):
            for i, n, score in zip(*(x.tolist() for x in self._pieces(word, base, min(base + STEP, len(word))))):
                if i > here:
                    best[here % size] = -math.inf
                    here = i
                value, to = best[i % size] + score, (i + n) % size
                if value > best[to]:  # of equal values the first stays, which has the longer piece
                    best[to], tokens[to] = value, tokens[i % size] + 1
        return tokens[len(word) % size]

    def shared(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The counts of many words through a trie.

        Level by level through the trie: a node of depth d is a distinct prefix of d bytes, kept as the hash
        of those bytes, with the place of one word below it and the node above.
        """
        m = len(self.mark)
        length = (end - start + m).astype(np.int64)
        at = np.zeros(int(length.max()) if len(length) else 0, np.int64)
        result = np.zeros(len(start), np.int64)
        words = np.arange(len(start))
        parent = np.zeros(len(start), np.int64)
        keys = np.zeros(len(start), np.uint64)
        best = [np.zeros(1)]
        tokens = [np.zeros(1, np.int64)]
        above: list[np.ndarray] = []
        window = np.zeros((len(start), 0), np.uint8)
        power = powers(self.longest)
        for depth in range(1, len(at) + 1):
            live = length[words] >= depth
            words, parent, keys, window = words[live], parent[live], keys[live], window[live]
            byte = np.full(len(words), self.mark[depth - 1]) if depth <= m else data[start[words] + depth - 1 - m]
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + byte.astype(np.uint64) + np.uint64(1))
            window = np.concatenate((window[:, -(self.longest - 1) :] if self.longest > 1 else window[:, :0], byte[:, None]), axis=1)
            _, one, node = np.unique(keys, return_index=True, return_inverse=True)
            above.append(parent[one])
            top = np.full(len(one), -np.inf)
            used = np.zeros(len(one), np.int64)
            recent = window[one].astype(np.uint64) + np.uint64(1)
            back = np.arange(len(one))
            for n in range(1, min(depth, self.longest) + 1):
                back = above[depth - n][back]
                if n not in self.tables:
                    continue
                known, score = self.tables[n]
                h = mix((recent[:, recent.shape[1] - n :] * power[:n]).sum(axis=1, dtype=np.uint64))
                place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                hit = known[place] == h
                value = np.where(hit, best[depth - n][back] + score[place], -np.inf)
                better = value >= top
                better &= hit
                top = np.where(better, value, top)
                used = np.where(better, tokens[depth - n][back] + 1, used)
            best.append(top)
            tokens.append(used)
            parent = node
            ends = length[words] == depth
            result[words[ends]] = used[node[ends]]
        return result


def count_tokens(docs: DataFrame, *keys: str | Column, vocabulary: str | dict[bytes, float] | None = None) -> DataFrame:
    """``keys``, ``n_words`` and ``n_tokens`` of every row of ``docs``.

    ``vocabulary`` is the path of a sentencepiece file or a dict of pieces and log probabilities. Distinct
    words are inserted in a trie for each slice of texts; a task remembers the counts of words it has met, a
    bounded number of them. Words of over ``LONG`` bytes are scored on their own, as each level of a trie costs some time. Null and blank texts have no words and no tokens.
    """
    scores = vocabulary if isinstance(vocabulary, dict) else unigram_scores(vocabulary or default_vocabulary())
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(scores))
    inner = docs.select(*keys, "text") if "text" not in keys else docs.select(*keys)
    outer = [f for f in inner.schema.fields if f.name != "text" or "text" in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outer) + ", n_words long, n_tokens long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        known, stored = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for part in slices(batches):
            texts = Texts.of(part.column("text"))
            words = texts.words(WHITE)
            h, which, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
            n = np.zeros(len(h), np.int64)
            place = np.minimum(np.searchsorted(known, h), max(len(known) - 1, 0))
            met = known[place] == h if len(known) else np.zeros(len(h), bool)
            n[met] = stored[place[met]]
            fresh = which[~met]
            n[~met] = book.count(texts.data, words.start[fresh], words.end[fresh])
            if len(known) + len(fresh) > MEMORY:
                known, stored = h, n
            else:
                known, stored = np.concatenate((known, h[~met])), np.concatenate((stored, n[~met]))
                order = np.argsort(known)
                known, stored = known[order], stored[order]
            total = np.bincount(words.owner, n[back], len(texts)).astype(np.int64) if len(words) else np.zeros(len(texts), np.int64)
            columns = {f.name: part.column(f.name) for f in outer}
            yield pa.RecordBatch.from_pydict(columns | {"n_words": pa.array(words.counts), "n_tokens": pa.array(total)})

    return inner.mapInArrow(counted, ddl)
