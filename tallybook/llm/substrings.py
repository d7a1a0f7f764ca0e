"""Repeated substrings by a sorted array of suffixes, merged from front-coded runs.

A byte goes if a string of ``length`` bytes that covers it starts anywhere else. Sorting every suffix of the corpus is
not needed for that. A start is a position with ``length`` bytes of its document ahead. Its anchor is the position with the least hash
of eight bytes among the next ``_REACH`` positions (leftmost if equal), so equal strings have their anchors at equal places.

1. Anchors whose next ``length - _REACH + 1`` bytes, their key, occur once (by a hash, so never too few pass) settle all their
   starts: none is repeated. Most of a corpus ends here. Of each other anchor one record is kept: a digest of its key and the bytes
   that its starts need before and behind the key. The texts are not needed again until bytes are cut out of them.
2. The records are sorted as suffixes: digest, number of bytes before the anchor, these, and those behind the key. The key itself is
   the same for all suffixes of a digest, so it never travels. If a neighbour shares the whole suffix, every start
   of the anchor is repeated; otherwise the starts are in doubt.
3. Of digests that are in doubt, one anchor of each distinct suffix goes on: an anchor with a copy is settled, and its copies
   would bring the same starts. Every start of these is sorted in the same form, which is ``_REACH - 1`` bytes and the digest.
   A start is repeated if a neighbour in sorted order shares all of it. Starts in a row leave as one.

Sorting is a distributed merge sort. Every task sorts its suffixes into runs, one for each range of digests, and front-codes
each run: the length of the prefix shared with the one before, and the
rest. Runs are exchanged in blocks. The receiving task merges them with a loser tree that keeps, for each player, the
prefix it shares with the last winner: players with different lengths are compared by these alone, others from that
length on. So no byte of a known prefix is compared again, and the merge yields the neighbours' common prefixes for free.
Equal suffixes are one entry with a count already in their run, so a group of any number of copies is a few entries.

Matches lie within documents, and copies of a document count like any other repeat. Which copy is kept is not asked: all
covered bytes go, from every place. Rows are told apart, and keys and digests compared, by hashes of 64 and 128 bits. Defined cases: null is empty; texts shorter than ``length`` bytes are kept whole; overlaps with itself count;
repeated rows are separate documents (so their bytes repeat), and a null doc_id is one like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.group import GroupedData

from tallybook.llm.tables import discard, stored
from tallybook.llm.tokens import joined, pieces, prefix_hash, span_hash

LENGTH = 400
_REACH = 160
_GRAM = 8
_BLOCK = 1 << 17
#: Ranges of a merge: at least so many, and one for each so many suffixes.
_RANGES, _RANGE_SUFFIXES = 48, 50_000
#: Records that a task takes at a time, and suffixes that it sorts at a time.
_RUN_RECORDS, _RUN_SUFFIXES = 50_000, 200_000
#: A digest with more records has ranges of its own.
_HOT_RECORDS = 20_000
#: Rows that a merge holds before it hands them on.
_MOST_ROWS = 100_000


def _anchors(texts: pa.Array, length: int) -> tuple[np.ndarray, ...]:
    """All texts as bytes, where each begins, and for each anchor: its position, its first and last start, its text."""
    data, offsets = joined(texts)
    # The eight bytes from each position on; the last positions of the buffer are no starts.
    grams = np.ndarray((max(0, len(data) - _GRAM + 1),), dtype="<u8", buffer=data.data, strides=(1,))
    anchors, firsts, lasts, own = [], [], [], []
    for doc, (begin, end) in enumerate(zip(offsets[:-1].tolist(), (offsets[1:] - 1).tolist())):
        starts = end - begin - length + 1
        if starts <= 0:
            continue
        n = starts + _REACH - 1  # length is more than _REACH + _GRAM, so all grams lie within the text
        # The hash above, the position below: the least is the leftmost of the least hashes.
        bits = np.uint64(n.bit_length())
        least = grams[begin : begin + n] * np.uint64(0x9E3779B97F4A7C15)
        least ^= least >> np.uint64(29)
        least *= np.uint64(0xBF58476D1CE4E5B9)
        least >>= bits
        least <<= bits
        least |= np.arange(n, dtype=np.uint64)
        span = 1
        while span < _REACH:
            step = min(span, _REACH - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        edge = np.flatnonzero(at[1:] != at[:-1])
        first = np.concatenate(([0], edge + 1))
        anchors.append(at[first] + begin)
        firsts.append(first + begin)
        lasts.append(np.concatenate((edge, [starts - 1])) + begin)
        own.append(np.full(len(first), doc))
    none = [np.zeros(0, np.int64)]
    return data, offsets, *(np.concatenate(none + x) for x in (anchors, firsts, lasts, own))


def _keys(data: np.ndarray, anchor: np.ndarray, length: int) -> np.ndarray:
    return span_hash(prefix_hash(data), anchor, anchor + length - _REACH + 1).view(np.int64)


_RECORD = "row long, start long, before int, span int, digest binary, around binary"
_DIGEST = 16
#: Bytes of a sorted suffix besides those of the text: the digest, and how many bytes lie before the anchor.
_HEAD = _DIGEST + 1


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """row, found (start and reach of strings that are repeated, in bytes) of each row of ``docs`` (row, text) with any."""
    if length < 2 * _REACH:
        raise ValueError(f"length must be at least {2 * _REACH}")
    texts = docs.select(F.col("row"), F.col("text").cast("string").alias("text"))
    key_bytes = length - _REACH + 1

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, _, anchor, _, _, own = _anchors(batch.column(1), length)
            key = _keys(data, anchor, length)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own)), pa.array(key)], ["row", "key"])

    def recorded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            data, offsets, anchor, first, last, own = _anchors(batch.column(1), length)
            key = _keys(data, anchor, length)
            bounds = np.searchsorted(own, np.arange(batch.num_rows + 1))
            wanted = batch.column(2)
            take = [bounds[i] + np.flatnonzero(np.isin(key[bounds[i] : bounds[i + 1]], wanted[i].values.to_numpy())) for i in range(batch.num_rows)]
            take = np.concatenate([np.zeros(0, np.int64), *take])
            at, a, b, own = anchor[take], first[take], last[take], own[take]
            raw = data.tobytes()
            spans = list(zip(at.tolist(), a.tolist(), b.tolist()))
            digests = [hashlib.blake2b(raw[m : m + key_bytes], digest_size=_DIGEST).digest() for m, _, _ in spans]
            around = [raw[i:m] + raw[m + key_bytes : j + length] for m, i, j in spans]
            columns = [batch.column(0).take(pa.array(own)), pa.array(a - offsets[own]), pa.array((at - a).astype(np.int32)), pa.array((b - a).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.binary()), pa.array(around, pa.binary())], ["row", "start", "before", "span", "digest", "around"])

    keys = texts.mapInArrow(hashed, "row long, key long")
    twice = stored(keys.groupBy("key").count().where("count > 1").select("key"), "suffix-keys")
    rows = keys.join(twice, "key").groupBy("row").agg(F.collect_set("key").alias("keys"))
    records = stored(texts.join(rows, "row").mapInArrow(recorded, _RECORD), "suffix-records")
    discard(twice)

    ranges = _Ranges.of(records)
    first = stored(_anchors_matched(_sorted_runs(records, _whole, ranges), ranges), "suffix-first")
    discard(records)
    starts = first.where("match >= size").select("row", "start", (F.col("size") - _HEAD + key_bytes).alias("reach"))
    doubtful = first.where("around IS NOT NULL").select("row", "start", "before", "span", "digest", "around")
    each = _sorted_runs(doubtful, _each, _Ranges.of(doubtful, F.sum(F.col("span") + 1)))
    found = starts.union(_starts_repeated(each, length))
    return found.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "reach"))).alias("found"))


@dataclass
class _Ranges:
    """Which range a suffix is sorted in, by its digest; digests are spread evenly, so no sample is needed.

    A digest with very many records has ranges of its own, by the number of bytes before the anchor: equal suffixes agree in that.
    """

    count: int
    hot: dict[bytes, tuple[int, int]]  # digest: its first range, and how many it has

    @staticmethod
    def of(records: DataFrame, suffixes: Column | None = None) -> _Ranges:
        total = records.agg(F.count(F.lit(1)) if suffixes is None else suffixes).first()[0] or 0
        count, hot = max(_RANGES, total // _RANGE_SUFFIXES), {}
        for r in records.groupBy("digest").count().where(F.col("count") > _HOT_RECORDS).orderBy("digest").collect():
            own = min(_REACH, 1 + r["count"] // _HOT_RECORDS)
            hot[bytes(r["digest"])] = (count + sum(n for _, n in hot.values()), own)
        return _Ranges(count, hot)

    def parts(self, suffixes: np.ndarray) -> np.ndarray:
        """Of suffixes that are rows of bytes."""
        high = suffixes[:, :4].astype(np.uint64) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], dtype=np.uint64)
        out = ((high * np.uint64(self.count)) >> np.uint64(32)).astype(np.int64)
        for digest, (first, own) in self.hot.items():
            same = np.flatnonzero((suffixes[:, :_DIGEST] == np.frombuffer(digest, np.uint8)).all(axis=1))
            out[same] = first + suffixes[same, _DIGEST].astype(np.int64) * own // _REACH
        return out


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts around the anchors end to end and where each begins, the digests as rows, and the bytes before each anchor."""
    around = batch.column(5).cast(pa.large_binary())
    ends = np.frombuffer(around.buffers()[1], dtype=np.int64)[around.offset : around.offset + len(around) + 1]
    data = np.frombuffer(around.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    digests = np.frombuffer(b"".join(batch.column(4).to_pylist()), dtype=np.uint8).reshape(-1, _DIGEST)
    return data, ends - ends[0], digests, batch.column(2).to_numpy()


def _matrix(data: np.ndarray, at: np.ndarray, digests: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Suffixes as rows: the digest, the number of bytes before the anchor, and the ``_REACH - 1`` bytes at each place."""
    out = np.empty((len(at), _HEAD + _REACH - 1), dtype=np.uint8)
    out[:, :_DIGEST] = digests
    out[:, _DIGEST] = before
    out[:, _HEAD:] = np.lib.stride_tricks.sliding_window_view(data, _REACH - 1)[at]
    return out


def _whole(batch: pa.RecordBatch) -> Iterator[tuple]:
    """One suffix a record: rows of their first bytes, what follows these, row and start of each."""
    data, begin, digests, before = _flat(batch)
    raw, wide = data.tobytes(), _REACH - 1
    tails = [raw[a + wide : b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]
    yield _matrix(data, begin[:-1], digests, before), tails, batch.column(0).to_numpy(), batch.column(1).to_numpy()


def _each(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Every start of a record: the one k places on has before - k bytes before its anchor, and as many more behind the key."""
    data, begin, digests, before = _flat(batch)
    row, start, count = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).to_numpy().astype(np.int64) + 1
    bounds = np.concatenate(([0], np.cumsum(count)))
    for a in range(0, int(bounds[-1]), _RUN_SUFFIXES):
        n = np.arange(a, min(a + _RUN_SUFFIXES, int(bounds[-1])))
        own = np.searchsorted(bounds, n, side="right") - 1
        k = n - bounds[own]
        yield _matrix(data, begin[own] + k, digests[own], before[own] - k), None, row[own], start[own] + k


def _sorted_runs(records: DataFrame, suffixes, ranges: _Ranges) -> GroupedData:
    """Blocks of the sorted runs that tasks make of the suffixes of their records, grouped by range."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted front-coded runs; a run is some records' suffixes within one range, in numbered blocks."""
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 32
        for batch in _gathered(batches):
            for matrix, tails, row, start in suffixes(batch):
                yield from _blocks(run, ranges.parts(matrix), matrix, tails, row, start)
                run += 1

    names = ["part", "run", "block", "lcp", "rest", "sizes", "counts", "rows", "starts"]
    schema = "part int, run long, block int, lcp binary, rest binary, sizes binary, counts binary, rows binary, starts binary"
    return records.mapInArrow(runs, schema).select(*names).groupBy("part")


def _distinct(blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list, bytes]]:
    """The distinct suffixes of a range, merged: size, the most of it that a suffix elsewhere shares, rows and starts, itself."""
    by_run: dict[int, list] = {}
    for table in blocks:
        for r in table.to_pylist():
            by_run.setdefault(r["run"], []).append(r)
    players = [_Run(sorted(v, key=lambda r: r["block"])) for v in by_run.values()]
    # The held suffix is complete once its right neighbour is known.
    held, held_size, held_best, held_suffix = [], 0, 0, b""

    def complete(shared: int) -> tuple[int, int, list, bytes]:
        alone = len(held) == 1 and len(held[0][0]) == 1
        return held_size, max(held_best, shared) if alone else held_size, held, held_suffix

    for shared, size, rows, starts, suffix in _merge(players):
        if held and shared == held_size == size:
            held.append((rows, starts))
            continue
        if held:
            yield complete(shared)
        held, held_size, held_best, held_suffix = [(rows, starts)], size, shared if held else 0, suffix
    if held:
        yield complete(0)


_MATCHED = "row long, start long, size long, match long, before int, span int, digest binary, around binary"


def _anchors_matched(runs: GroupedData, ranges: _Ranges) -> DataFrame:
    """row, start, size, match of each anchor; its record, too, if it is the first of its suffix and the digest is in doubt."""
    hot = set(ranges.hot)

    def merged(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, starts, counts, sizes, matches, records = [], [], [], [], [], []
        pending, digest, since, doubt = 0, b"", 0, False

        def flush() -> pa.RecordBatch:
            each = np.repeat(np.arange(len(counts)), counts)
            record: list[bytes | None] = [None] * len(each)
            for at, r in zip((np.cumsum(counts) - counts).tolist(), records):
                record[at] = r
            columns = [
                pa.array(np.concatenate(rows)), pa.array(np.concatenate(starts)), pa.array(np.array(sizes, np.int64)[each]), pa.array(np.array(matches, np.int64)[each]),
                pa.array([r and r[_DIGEST] for r in record], pa.int32()), pa.array([r and len(r) - _HEAD - _REACH + 1 for r in record], pa.int32()),
                pa.array([r and r[:_DIGEST] for r in record], pa.binary()), pa.array([r and r[_HEAD:] for r in record], pa.binary()),
            ]
            for x in (rows, starts, counts, sizes, matches, records):
                x.clear()
            return pa.RecordBatch.from_arrays(columns, ["row", "start", "size", "match", "before", "span", "digest", "around"])

        for size, match, held, suffix in _distinct(blocks):
            if suffix[:_DIGEST] != digest:
                if not doubt:
                    records[since:] = [None] * (len(records) - since)
                if pending > _MOST_ROWS:
                    yield flush()
                    pending = 0
                # Other ranges hold suffixes of a hot digest, too, so whether all are settled is not known here.
                digest, since = suffix[:_DIGEST], len(records)
                doubt = digest in hot
            elif doubt and pending > _MOST_ROWS and digest in hot:
                yield flush()
                pending = since = 0
            doubt = doubt or match < size
            records.append(suffix)
            for r, s in held:
                rows.append(r)
                starts.append(s)
                pending += len(r)
            counts.append(sum(len(r) for r, _ in held))
            sizes.append(size)
            matches.append(match)
        if not doubt:
            records[since:] = [None] * (len(records) - since)
        if rows:
            yield flush()

    return runs.applyInArrow(merged, _MATCHED)


def _starts_repeated(runs: GroupedData, length: int) -> DataFrame:
    """row, start, reach of the starts that stand twice; those of a row that follow one another are one."""

    def merged(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, starts, pending = [], [], 0

        def flush() -> pa.RecordBatch:
            row, start = np.concatenate(rows), np.concatenate(starts)
            order = np.lexsort((start, row))
            row, start = row[order], start[order]
            first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (start[1:] > start[:-1] + 1))))
            last = np.append(first[1:], len(row)) - 1
            rows.clear()
            starts.clear()
            return pa.RecordBatch.from_arrays([pa.array(row[first]), pa.array(start[first]), pa.array(length + start[last] - start[first])], ["row", "start", "reach"])

        for size, match, held, _ in _distinct(blocks):
            if match < size:
                continue
            for r, s in held:
                rows.append(r)
                starts.append(s)
                pending += len(r)
            if pending > _MOST_ROWS:
                yield flush()
                pending = 0
        if rows:
            yield flush()

    return runs.applyInArrow(merged, "row long, start long, reach long")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about ``_RUN_RECORDS`` records, so that runs are long."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= _RUN_RECORDS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _blocks(run: int, parts: np.ndarray, matrix: np.ndarray, tails: list[bytes] | None, row: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The suffixes of each range in order, front-coded: what each shares with the one before, the rest, and how often it is there."""
    if not len(matrix):
        return
    width = matrix.shape[1]
    keys = np.ascontiguousarray(matrix).view(f"S{width}").ravel()  # all of one width, so zeros at the end do not matter
    if tails is None:
        order = np.lexsort((keys, parts))
    else:
        tail = np.array([t.ljust(_REACH, b"\0") for t in tails], dtype=f"S{_REACH}")
        size = np.array([len(t) for t in tails])
        order = np.lexsort((size, tail, keys, parts))
    matrix, parts, row, start = matrix[order], parts[order], row[order], start[order]
    tails = None if tails is None else [tails[i] for i in order.tolist()]
    edges = np.flatnonzero(np.concatenate(([True], parts[1:] != parts[:-1], [True])))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield from _coded(run, int(parts[a]), matrix[a:b], None if tails is None else tails[a:b], row[a:b], start[a:b])


def _coded(run: int, part: int, matrix: np.ndarray, tails: list[bytes] | None, row: np.ndarray, start: np.ndarray) -> Iterator[pa.RecordBatch]:
    width = matrix.shape[1]
    unlike = matrix[1:] != matrix[:-1]
    differs = unlike.any(axis=1)
    shared = np.concatenate(([0], np.where(differs, unlike.argmax(axis=1), width)))
    fresh = np.concatenate(([True], differs))
    if tails is not None:
        for i in np.flatnonzero(~fresh).tolist():
            shared[i] += common_prefix(tails[i - 1], tails[i], 0)
            fresh[i] = tails[i - 1] != tails[i]
    first = np.flatnonzero(fresh)
    count = np.diff(np.append(first, len(matrix)))
    shared = shared[first]
    sizes = np.full(len(first), width) if tails is None else width + np.array([len(tails[i]) for i in first.tolist()])
    block = np.cumsum(sizes - shared + 24) // _BLOCK
    cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1], [True])))
    names = ["part", "run", "block", "lcp", "rest", "sizes", "counts", "rows", "starts"]
    for number, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
        some = matrix[first[a:b]]
        if tails is None:
            rest = some[np.arange(width) >= shared[a:b, None]].tobytes()
        else:
            rest = b"".join((m.tobytes() + tails[i])[n:] for m, i, n in zip(some, first[a:b].tolist(), shared[a:b].tolist()))
        rows = slice(first[a], first[b] if b < len(first) else len(matrix))
        fields = (shared[a:b].astype(np.int32), None, sizes[a:b].astype(np.int32), count[a:b].astype(np.int32), row[rows].astype(np.int64), start[rows].astype(np.int64))
        binary = [pa.array([rest if f is None else f.tobytes()], pa.binary()) for f in fields]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([run]), pa.array([number], pa.int32()), *binary], names)


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """How many bytes both begin with, given that the first ``known`` are the same."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    low, high = known, n
    step = 8
    while low + step < high and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Run:
    """A front-coded run: steps through its suffixes, each with the prefix it shares with the one before."""

    def __init__(self, blocks: list[dict]) -> None:
        self.entries = self._read(blocks)
        self.suffix, self.rows, self.starts = b"", None, None

    def _read(self, blocks: list[dict]) -> Iterator[tuple]:
        suffix = b""
        for b in blocks:
            lcp, sizes, counts = (np.frombuffer(b[x], np.int32).tolist() for x in ("lcp", "sizes", "counts"))
            rows, starts, rest = np.frombuffer(b["rows"], np.int64), np.frombuffer(b["starts"], np.int64), b["rest"]
            at = used = 0
            for shared, size, count in zip(lcp, sizes, counts):
                suffix = suffix[:shared] + rest[at : at + size - shared]
                at += size - shared
                yield shared, suffix, rows[used : used + count], starts[used : used + count]
                used += count

    def step(self) -> int:
        """The prefix shared with the suffix before; -1 at the end."""
        for shared, self.suffix, self.rows, self.starts in self.entries:
            return shared
        return -1


def _merge(players: list[_Run]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, bytes]]:
    """All suffixes in order: the prefix shared with the one before, size, rows, starts, and the suffix.

    ``tree[node]`` is the loser of the match played there, ``share[player]`` the prefix that a loser shares with the
    suffix that beat it, which is also what it shares with the last winner on its way up. A longer shared prefix with the last winner
    means the smaller suffix; only equal lengths need a look at bytes, and only behind that length.
    """
    k = len(players)
    if not k:
        return
    share = [p.step() for p in players]
    share = [0 if s >= 0 else -1 for s in share]
    tree = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; sets what the loser shares with the winner."""
        if share[a] < 0:
            return b, a
        if share[b] < 0:
            return a, b
        if share[a] != share[b]:
            # The one with less in common with the last winner loses, and shares as little with the new one.
            return (a, b) if share[a] > share[b] else (b, a)
        x, y = players[a].suffix, players[b].suffix
        common = common_prefix(x, y, share[a])
        if x[common : common + 1] <= y[common : common + 1]:
            share[b] = common
            return a, b
        share[a] = common
        return b, a

    winners = list(range(k))
    nodes = [0] * k + winners
    for node in range(k - 1, 0, -1):
        nodes[node], tree[node] = play(nodes[2 * node], nodes[2 * node + 1])
    winner = nodes[1] if k > 1 else 0
    while share[winner] >= 0:
        p = players[winner]
        yield share[winner], len(p.suffix), p.rows, p.starts, p.suffix
        share[winner] = p.step()
        node = (winner + k) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text (doc_id, text, found), some texts at a time."""
    for batch in pieces(batches):
        text = batch.column(1).cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
        data = memoryview(text.buffers()[2] or b"")
        n_bytes = np.diff(ends)
        # Places in all texts end to end, each text with a gap behind it, so that no two texts' strings touch.
        shift = np.cumsum(n_bytes + 1) - n_bytes - 1
        found = batch.column(2)
        own = np.repeat(np.arange(len(found)), found.value_lengths().fill_null(0).to_numpy())
        start, reach = (x.to_numpy(zero_copy_only=False) for x in found.flatten().flatten())
        begin = start + shift[own]
        upto = np.maximum.accumulate(begin + reach)
        fresh, last = np.ones((2, len(begin)), dtype=bool)
        fresh[1:] = last[:-1] = begin[1:] > upto[:-1]
        own, a, b = own[fresh], start[fresh], upto[last] - shift[own[fresh]]
        first = np.searchsorted(own, np.arange(len(found) + 1))
        kept = []
        places = list(zip((a + ends[own]).tolist(), (b + ends[own]).tolist()))
        for i, (at, end) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            digest = hashlib.sha256()
            for x, y in places[first[i] : first[i + 1]]:
                digest.update(data[at:x])
                at = y
            digest.update(data[at:end])
            kept.append(digest.hexdigest())
        removed = np.concatenate(([0], np.cumsum(b - a)))[first]
        spans = pa.ListArray.from_arrays(pa.array(2 * first, pa.int32()), pa.array(np.stack((a, b), axis=1).ravel()))
        columns = [batch.column(0), pa.array(n_bytes), pa.array(np.diff(removed)), pa.array(np.diff(first)), pa.array(kept, pa.string()), spans]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end, ... in bytes) for each row of ``docs``."""
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Named by their content, which every evaluation of the plan finds again. Equal rows share a name and an answer; each
    # still brings its own suffixes, so they count as repeats of one another.
    numbered = numbered.withColumn("row", F.xxhash64("doc_id", "text"))
    found = repeated_spans(numbered, length)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    return numbered.join(found, "row", "left").select("doc_id", "text", "found").mapInArrow(_cut, schema)
