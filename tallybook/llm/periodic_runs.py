"""Runs of repeating words: maximal stretches of words with a period, found on tiles of every scale.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) of at least
``max(least_words, 2 * q)`` words that no neighbouring word extends keeping period q.

1. Each document is exploded into tiles, octave by octave: octave k is for periods 2**k .. 2**(k+1) - 1 and has a
   boundary before every 2**k-th word; a tile is ``tile_words`` words' worth of boundaries, and overlaps its
   neighbours by what a boundary may look to both sides. Any run of a period of octave k reaches from some boundary m
   over m + q, so each of its tiles sees it on its own.
2. A tile is solved by the Z-functions of its boundaries: for each period q the number of words that agree from m and
   from m + q on, and the number that agree before them. If both together reach q, the words around are a fragment of
   period q. The Z values of all tiles of a batch of documents are taken at once in numpy, by comparing hashes of blocks
   of 2**j words, longest first; where neither the block of 2**(k-1) words behind m nor the one before it recurs q words
   later, the two values can't reach q, and that is all that is looked at. Values stop at 2**(k+2) - 1, what lies beyond
   is in the next boundaries. Within a tile fragments of the same run are put together, and fragments whose period is no
   smallest one (a divisor of it is a period, too) go.
3. Fragments are shuffled by document and period and stitched: those of one run overlap by q words or more, those of
   two runs by fewer.

Words are compared by 64-bit hashes of blocks, mixed at each doubling; results are exact up to their collisions.
Memory in a task is a batch of documents (a few MB of text, or one longer document) times the logarithm of its longest.
Only documents with fragments carry their text to the shuffle, where words are dropped that a run repeats.

Defined cases: a null or blank text has no words and no runs; the hash of no words is that of the empty string; repeated
rows and doc_ids come back repeated, each row on its own; other columns are ignored; a null doc_id stays null, and its
words as they are. Texts are taken whole, whatever their length.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.tables import stored
from tallybook.llm.tokens import Words, mix, pieces

LEAST_WORDS = 12
TILE_WORDS = 4096

#: Words end at blank and at the controls 9 to 13; letters keep their case. Byte 0 is a word byte, so it is moved aside.
_BLANKS = np.arange(256, dtype=np.uint8)
_BLANKS[0] = 0xFF
_BLANKS[[0x20, *range(0x09, 0x0E)]] = 0
_CHAIN = np.uint64(0x2545F4914F6CDD1D)
_MARK = np.uint64(0xA0761D6478BD642F)

Alter = Callable[[int | None, int], tuple[int, int] | None]


def echoed(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) where the contract has words of a document repeated from word a on with period p, else None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _source(n: int, altered: tuple[int, int] | None) -> np.ndarray:
    """For each word of a document, the number of the original word it is."""
    at = np.arange(n)
    if altered:
        a, p = altered
        at[a:] = a + (at[a:] - a) % p
    return at


class _Tiles:
    """All tiles of some documents laid end to end, with a word that equals no other before, between and behind them."""

    def __init__(self, docs: list[np.ndarray], tile_words: int) -> None:
        self.n = np.array([len(d) for d in docs], dtype=np.int64)
        self.first = np.cumsum(np.concatenate(([0], self.n[:-1]))) + np.arange(1, len(docs) + 1)
        words = np.empty(int(self.n.sum()) + len(docs) + 1, dtype=np.uint64)
        limits = np.concatenate(([0], self.first + self.n))
        inside = np.ones(len(words), dtype=bool)
        inside[limits] = False
        words[inside] = np.concatenate(docs) if docs else words[:0]
        words[limits] = mix(limits.astype(np.uint64) + _MARK)
        self.blocks = [words]  # blocks[j][i]: hash of the 2**j words from i on
        self.tile_words = tile_words

    def block(self, level: int) -> np.ndarray:
        while len(self.blocks) <= level:
            below, step = self.blocks[-1], 1 << (len(self.blocks) - 1)
            behind = np.zeros_like(below)
            behind[:-step] = below[step:]
            self.blocks.append(mix(below * _CHAIN + behind))
        return self.blocks[level]

    def z(self, a: np.ndarray, b: np.ndarray, top: int, back: bool) -> np.ndarray:
        """How many words agree from a and b on (or before them), at most 2**(top + 1) - 1; a < b."""
        out = np.zeros(len(a), dtype=np.int64)
        for level in range(top, -1, -1):
            hashes, size = self.block(level), 1 << level
            x, y = (a - out - size, b - out - size) if back else (a + out, b + out)
            fits = (x >= 0) if back else (y < len(hashes))
            same = fits & (hashes[np.where(fits, x, 0)] == hashes[np.where(fits, y, 0)])
            out += same * size
        return out

    def octave(self, k: int) -> tuple[np.ndarray, ...] | None:
        """Fragments (document, tile, period, start, end), words numbered within the document; None beyond the last octave."""
        size, half = 1 << k, 1 << max(k - 1, 0)
        some = np.flatnonzero(self.n >= 2 * size)
        if not len(some):
            return None
        count = self.n[some] - size  # every word from the second boundary on is q words behind exactly one boundary
        doc = np.repeat(some, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + size
        m = (at // size - 1) * size
        base, block = self.first[doc], self.block(max(k - 1, 0))
        right = block[base + at] == block[base + m]
        left = block[base + at - half] == block[np.maximum(base + m - half, 0)]
        seen = np.flatnonzero(right | left)
        doc, m, q, base = doc[seen], m[seen], at[seen] - m[seen], base[seen]
        top = max(k + 1, 3)
        ahead = self.z(base + m, base + m + q, top, back=False)
        before = self.z(base + m, base + m + q, top, back=True)
        good = ahead + before >= q
        doc, m, q, before, ahead = doc[good], m[good], q[good], before[good], ahead[good]
        tile = m // max(self.tile_words, size)
        start, end = m - before, m + q + ahead
        order = np.lexsort((start, q, tile, doc))
        doc, tile, q, start, end = doc[order], tile[order], q[order], start[order], end[order]
        fresh = np.ones(len(doc), dtype=bool)
        fresh[1:] = (doc[1:] != doc[:-1]) | (tile[1:] != tile[:-1]) | (q[1:] != q[:-1]) | (start[1:] > end[:-1] - q[1:])
        begin = np.flatnonzero(fresh)
        last = np.append(begin[1:], len(doc))[: len(begin)] - 1
        doc, tile, q, start, end = doc[begin], tile[begin], q[begin], start[begin], end[last]
        keep = self._smallest(self.first[doc] + start, q)
        return doc[keep], tile[keep], q[keep], start[keep], end[keep]

    def _smallest(self, start: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the q words from start on are no power of fewer words, so that q is the smallest period."""
        alone = np.ones(len(q), dtype=bool)
        rest, prime = q.copy(), 2
        while len(rest) and (rest > 1).any():
            prime = prime if prime * prime <= rest.max() else 0
            divisor = np.where(rest % prime == 0, prime, 1) if prime else rest
            hit = np.flatnonzero(divisor > 1)
            if len(hit):
                step = q[hit] // divisor[hit]
                alone[hit] &= ~self._same(start[hit], start[hit] + step, q[hit] - step)
            if not prime:
                break
            while (more := rest % prime == 0).any():
                rest = np.where(more, rest // prime, rest)
            prime += 1 if prime == 2 else 2
        return alone

    def _same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether ``length`` words from a and from b on agree, by two overlapping blocks."""
        level = np.frexp(length.astype(np.float64))[1] - 1
        out = np.zeros(len(a), dtype=bool)
        for j in np.unique(level).tolist():
            i, block = np.flatnonzero(level == j), self.block(j)
            tail = length[i] - (1 << j)
            out[i] = (block[a[i]] == block[b[i]]) & (block[a[i] + tail] == block[b[i] + tail])
        return out


def _fragments(docs: list[np.ndarray], tile_words: int, least_words: int) -> list[list[dict]]:
    """For each document the fragments of its tiles; shorter ones than ``least_words`` are whole runs, and go."""
    tiles, found, k = _Tiles(docs, tile_words), [[] for _ in docs], 0
    while (some := tiles.octave(k)) is not None:
        doc, _, q, start, end = some
        long = end - start >= np.minimum(least_words, 1 << (max(k + 1, 3) + 1))
        for d, period, a, b in zip(*(x[long].tolist() for x in (doc, q, start, end))):
            found[d].append({"period": period, "start": a, "end": b})
        k += 1
    return found


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()  # at blank and the controls 9 to 13


def fragments(docs: DataFrame, alter: Alter = echoed, least_words: int = LEAST_WORDS, tile_words: int = TILE_WORDS) -> DataFrame:
    """row, doc_id, n_words, collapsed_sha256 (of all words), fragments, and the text where there are any; still without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids, texts = batch.column(1).to_pylist(), batch.column(2)
            words = Words(texts, _BLANKS)
            raw = texts.cast(pa.large_binary()).to_pylist()
            hashes, plain = [], []
            for i, doc_id in enumerate(ids):
                h = words.hash[words.first[i] : words.first[i + 1]]
                altered, split = alter(doc_id, len(h)), _split(raw[i])
                if altered:
                    at = _source(len(h), altered)
                    h, split = h[at], [split[j] for j in at.tolist()]
                hashes.append(h)
                plain.append(_digest(split))
            found = _fragments(hashes, tile_words, least_words)
            kept = pa.array([t if f else None for t, f in zip(raw, found)], pa.large_binary()).cast(pa.binary())
            columns = [batch.column(0), batch.column(1), pa.array([len(h) for h in hashes], pa.int64()), pa.array(plain), pa.array(found, _FRAGMENTS), kept]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_words", "collapsed_sha256", "fragments", "text"])

    schema = "row long, doc_id long, n_words long, collapsed_sha256 string, fragments array<struct<period:long,start:long,end:long>>, text binary"
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(run, schema)


_FRAGMENTS = pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))


def stitched(found: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """row, start, length, period of every run, from the fragments of all tiles."""
    each = found.select("row", F.inline("fragments"))
    by = Window.partitionBy("row", "period").orderBy("start", "end")
    reached = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reached.isNull() | (F.col("start") > reached - F.col("period"))).cast("int")
    island = each.select("*", fresh.alias("fresh")).select("row", "period", "start", "end", F.sum("fresh").over(by).alias("island"))
    whole = island.groupBy("row", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    return whole.where(length >= F.greatest(F.lit(least_words), 2 * F.col("period"))).select("row", "start", length.alias("length"), "period")


def _collapse(alter: Alter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            digests = []
            for doc_id, text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                words = _split(text)
                depth = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    depth[r["start"] + r["period"]] += 1
                    depth[r["start"] + r["length"]] -= 1
                at = _source(len(words), alter(doc_id, len(words)))[np.cumsum(depth)[:-1] == 0]
                digests.append(_digest([words[j] for j in at.tolist()]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], ["row", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, alter: Alter = echoed, least_words: int = LEAST_WORDS, tile_words: int = TILE_WORDS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_runs, the longest run (start, length, period, exponent_milli), runs_sha256,
    collapsed_sha256, and as more columns n_words and runs (all of them, by start and period)."""
    found = stored(fragments(docs, alter, least_words, tile_words), "runs-fragments")
    some = found.where(F.size("fragments") > 0)
    run = F.struct("start", "period", "length")
    runs = stitched(some, least_words).groupBy("row").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    joined = stored(some.select("row", "doc_id", "text").join(runs, "row"), "runs-texts")
    collapsed = joined.select("row", "doc_id", "text", "runs").mapInArrow(_collapse(alter), "row long, collapsed string")
    done = collapsed.join(joined.select("row", "runs"), "row")
    return _described(found.drop("text", "fragments").join(done, "row", "left"))


def _described(rows: DataFrame) -> DataFrame:
    runs = F.coalesce("runs", F.expr("cast(array() as array<struct<start:bigint,period:bigint,length:bigint>>)"))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = rows.select("doc_id", "n_words", runs.alias("runs"), F.coalesce("collapsed", "collapsed_sha256").alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select("*", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        "collapsed_sha256",
        "n_words",
        F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period"))).alias("runs"),
    )
