"""Benchmark decontamination by a generalised suffix automaton of the test items.

The words of all items form one automaton: its states are the classes of word sequences that end at the same places of
the items. Reading a document, the automaton keeps the longest suffix of what has been read that occurs in an item. A
match of ``window`` words or more ends at every word where the kept length reaches ``window``; those words, and the
``window - 1`` before them, are hit. Items shorter than ``window`` count as a whole. Which items a window belongs to
is noted at the state that reading the window leads to.

Most words of a corpus cannot be part of a match, and numpy finds them before the automaton is asked: a match of
several words is made of neighbouring word pairs that some item holds. Only runs of such pairs that are long enough
are read; the state before such a run is the empty match, so nothing is missed.

The automaton is broadcast. Its size is bounded: items go into automata of at most ``AUTOMATON_WORDS`` words each (an
item longer than that has an automaton of its own windows, cut with an overlap of ``window - 1`` words), and each document is read
against one after the other. Benchmarks of any size work, in passes over a batch in memory.

Defined cases: null and empty texts have no words and are clean; null items and items without words never match;
items of the same id count once; rows of ``docs`` are answered one by one, so repeated rows come back repeated; a null
``item_id`` is left out of the ids; an empty table of items or documents gives clean rows or none; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.tokens import PUNCTUATION, Words, pieces

WINDOW = 10
AUTOMATON_WORDS = 500_000


class Automaton:
    """Of some word sequences, which are lists of small numbers; ``ends`` has the items of each window by state and length."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int) -> None:
        self.window = window
        words = np.concatenate([w for _, w in items]) if items else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(words)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(item, np.searchsorted(self.vocabulary, w).tolist()) for item, w in items if len(w)]
        for _, sequence in sequences:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self.ends: dict[tuple[int, int], set] = {}
        pairs = set()
        for item, sequence in sequences:
            size = min(window, len(sequence))
            state, length = 0, 0
            for word in sequence:
                state, length = self.step(state, length, word)
                while length > size and self.length[self.link[state]] >= size:
                    state = self.link[state]
                    length = self.length[state]
                if length >= size:
                    self.ends.setdefault((state, size), set()).add(item)
            pairs.update(zip(sequence, sequence[1:]))
        self.sizes = sorted({size for _, size in self.ends}, reverse=True)
        base = np.uint64(len(self.vocabulary) + 1)
        both = np.array(sorted(pairs), dtype=np.uint64).reshape(-1, 2)
        self.pairs = both[:, 0] * base + both[:, 1]

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            return q if length[q] == length[last] + 1 else self._split(last, word, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest match that ends with ``word``, as its state and length."""
        nxt = self.next
        while state and word not in nxt[state]:
            state = self.link[state]
            length = self.length[state]
        if word in nxt[state]:
            return nxt[state][word], length + 1
        return 0, 0

    def runs(self, words: Words) -> Iterator[tuple[int, int, np.ndarray]]:
        """Stretches of words (first, end, their numbers) that may hold a match, in order, each within one text."""
        if not self.sizes or not len(words.hash):
            return
        at = np.minimum(np.searchsorted(self.vocabulary, words.hash), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words.hash
        at = at.astype(np.uint64)
        paired = np.zeros(len(at) + 1, dtype=bool)  # paired[i]: word i - 1 and word i are neighbours in an item
        if len(self.pairs):
            code = at[:-1] * np.uint64(len(self.vocabulary) + 1) + at[1:]
            slot = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            paired[1:-1] = (self.pairs[slot] == code) & known[:-1] & known[1:]
        paired[words.first[:-1]] = False
        # A run is a word and all those tied to it; of unknown words each is a run that is too short or unknown.
        start = np.flatnonzero(~paired[:-1])
        end = np.append(start[1:], len(at))
        good = (end - start >= self.sizes[-1]) & known[start]
        for a, b in zip(start[good].tolist(), end[good].tolist()):
            yield a, b, at[a:b]

    def read(self, numbers: list[int]) -> Iterator[tuple[int, int, set]]:
        """(position, length, items) of each window that ends there."""
        state, length = 0, 0
        for i, word in enumerate(numbers):
            state, length = self.step(state, length, word)
            if length < self.sizes[-1]:
                continue
            suffix = state
            for size in self.sizes:
                if size > length:
                    continue
                while self.length[self.link[suffix]] >= size:
                    suffix = self.link[suffix]
                items = self.ends.get((suffix, size))
                if items:
                    yield i, size, items


def automata(items: DataFrame, window: int = WINDOW) -> list[Automaton]:
    """Built on the driver from the items as they stream in; at most one automaton's items are held as text."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    out, held, size = [], [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        words = Words(pa.array([row["text"]], pa.string()), PUNCTUATION).hash
        step = AUTOMATON_WORDS - window + 1
        for part in [words[a : a + AUTOMATON_WORDS] for a in range(0, max(1, len(words) - window + 1), step)]:
            if size + len(part) > AUTOMATON_WORDS:
                out.append(Automaton(held, window))
                held, size = [], 0
            held.append((row["item_id"], part))
            size += len(part)
    return [*out, Automaton(held, window)] if held else out


def _hits(batches: Iterator[pa.RecordBatch], built: list[Automaton]) -> Iterator[pa.RecordBatch]:
    """Per text: number of words, number of hit words, ids of the items found, and the byte spans of the hits."""
    for batch in pieces(batches):
        words = Words(batch.column(1), PUNCTUATION)
        hit = np.zeros(len(words.hash) + 1, dtype=np.int32)
        found: dict[int, set] = {}
        for automaton in built:
            for a, _, numbers in automaton.runs(words):
                doc = None
                for i, size, items in automaton.read(numbers.tolist()):
                    if doc is None:
                        doc = int(np.searchsorted(words.first, a, side="right")) - 1
                    hit[a + i - size + 1] += 1
                    hit[a + i + 1] -= 1
                    found.setdefault(doc, set()).update(items)
        hit = (np.cumsum(hit) > 0)[:-1]
        total = np.concatenate(([0], np.cumsum(hit)))
        first = words.first
        ids, spans, offsets = [], [], None
        for doc in range(batch.num_rows):
            if doc not in found:
                ids.append([])
                spans.append([])
                continue
            ids.append(sorted(x for x in found[doc] if x is not None))
            if offsets is None:
                lengths = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(1).cast(pa.large_binary())])
                offsets = np.concatenate(([0], np.cumsum(lengths + 1)))
            mark = np.concatenate(([False], hit[first[doc] : first[doc + 1]], [False]))
            edge = np.flatnonzero(mark[1:] != mark[:-1])
            begin, end = words.start[first[doc] + edge[0::2]], words.end[first[doc] + edge[1::2] - 1]
            spans.append([x for pair in zip((begin - offsets[doc]).tolist(), (end - offsets[doc]).tolist()) for x in pair])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(np.diff(first)), pa.array(total[first[1:]] - total[first[:-1]]),
                pa.array([len(found.get(d, ())) for d in range(batch.num_rows)], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]), pa.array(spans, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "spans"],
        )


def benchmark_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (start, end, start, ... of hit bytes) per row."""
    built = docs.sparkSession.sparkContext.broadcast(automata(items, window))
    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<long>"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = texts.mapInArrow(lambda it: _hits(it, built.value), schema)
    return found.withColumn("contaminated", F.col("n_hit") > 0)


def remove_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, most_length: int = 50, most_share: float = 0.5) -> DataFrame:
    """``docs`` without the passages of test items, other columns as they are and ``n_chars`` counted anew.

    A document is dropped whole if a passage is longer than ``most_length`` words or the passages hold more than
    ``most_share`` of its words; else the passages are cut out and the text around them stays as it is.
    """
    built = docs.sparkSession.sparkContext.broadcast(automata(items, window))
    names = docs.columns

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            numbers = pa.array(np.arange(batch.num_rows))
            pair = pa.RecordBatch.from_arrays([numbers, texts], ["doc_id", "text"])
            hits = pa.Table.from_batches(list(_hits([pair], built.value))).to_pylist()
            out, keep = texts.to_pylist(), np.ones(batch.num_rows, dtype=bool)
            for h in hits:
                if not h["n_hit"]:
                    continue
                data, spans = out[h["doc_id"]].encode(), list(zip(h["spans"][0::2], h["spans"][1::2]))
                longest = max(len(Words(pa.array([data[a:b]], pa.binary()), PUNCTUATION).hash) for a, b in spans)
                keep[h["doc_id"]] = longest <= most_length and h["n_hit"] <= most_share * h["n_words"]
                rest, last = [], 0
                for a, b in spans:
                    rest.append(data[last:a])
                    last = b
                out[h["doc_id"]] = (b"".join(rest) + data[last:]).decode()
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).filter(pa.array(keep))

    out = docs.select(*[F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in names]).mapInArrow(
        cleaned, docs.schema
    )
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
