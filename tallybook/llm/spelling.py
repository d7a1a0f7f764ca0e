"""Spelling variants: words one edit apart, found by scans of sorted lists that reuse rows of the edit matrix.

1. Words are counted over all documents; those of at least ``least_length`` code points and ``least_count`` occurrences
   are the vocabulary.
2. Two words one edit apart, the shorter of s code points, agree before and behind the edit. So the s places are cut into
   ``PIECES`` gaps, and words that agree outside a gap meet under one key; a word of length s or s + 1 has a key for each
   gap. The edit matrix of two such words needs only what stands in their gaps: common ends never change it.
   Keys with more than ``most`` words have their gap halved, until it is one place: then a key can hold no more than the
   letters allow (64 + 52 for words of length s, its square for those one longer), however large the vocabulary.
3. Each key's words are sorted by their gaps, and each word of length s scans the list: rows of the edit matrix, a band of
   three cells, are kept for the common prefix of adjacent entries (LCP); once a row holds nothing below two, the whole range of
   entries that share this prefix is skipped. Lists come sorted out of Spark's shuffle, so a task holds one key at a time.
4. The form of a word is its near word of most occurrences (ties: smallest in code-point order) if it has ``ratio`` times its
   own; its root is the last form of the chain. Occurrences grow by ``ratio`` in each step, so doubling the steps
   known ends after about log2(log10(n)) joins.

Defined cases: null and empty texts, and empty tables, have no words; a null doc_id deletes no letter; repeated rows
count repeatedly; other columns are ignored. Letters beyond A-Z keep their case. Texts and words are of any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.tables import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
PIECES = 4
MOST = 256

_LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FAR = 9  # any number beyond one edit


def dropped_letter(doc_id: Column, run: Column) -> Column:
    """The run, without one of its letters where the contract has a document misspell it."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % 31 == 0, shorter).otherwise(run)


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n over whole texts. Shorter runs can't become words and are not even extracted."""
    run = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{_LETTERS}]{{{least_length},}}"), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    words = runs.select(dropped_letter(F.col("doc_id"), F.col("run")).alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _keyed(words: DataFrame) -> DataFrame:
    """word, n, short (whether it is of the shorter length), key and gap, from word, n, size, a, b: places a to b of ``size`` are open."""
    behind = F.col("size") - F.col("b")
    gap = F.substring("word", F.col("a") + 1, F.length("word") - F.col("a") - behind)
    ends = F.concat_ws(" ", "size", "a", F.substring("word", F.lit(1), F.col("a")), F.expr("right(word, size - b)"))
    return words.select("*", (F.length("word") == F.col("size")).alias("short"), ends.alias("key"), gap.alias("gap"))


def _opened(words: DataFrame, least_length: int) -> DataFrame:
    """Each word with all its gaps, once as the shorter and once as the longer of a pair."""
    place = lambda i: F.floor(F.col("size") * i / PIECES).cast("int")
    gaps = F.explode(F.array(*(F.struct(place(i).alias("a"), place(i + 1).alias("b")) for i in range(PIECES))))
    sizes = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("size"))
    return sizes.where(F.col("size") >= least_length).select("*", gaps.alias("gap")).select("word", "n", "size", "gap.a", "gap.b").where("a < b")


def _halved(words: DataFrame) -> DataFrame:
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    two = F.explode(F.array(F.struct(F.col("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b"))))
    return words.select("word", "n", "size", two.alias("gap")).select("word", "n", "size", "gap.a", "gap.b")


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def one_edit_apart(gaps: list[str], short: list[bool]) -> Iterator[tuple[int, int]]:
    """(i, j) for each short entry i of the sorted list and each entry j one edit from it."""
    shared = [0] + [_common(a, b) for a, b in zip(gaps, gaps[1:])]
    total = len(gaps)
    for i, x in enumerate(gaps):
        if not short[i]:
            continue
        m = len(x)
        rows = [(_FAR, 0, 1)]  # rows[d]: edits from the first d letters of an entry to d - 1, d and d + 1 letters of x
        j = 0
        while j < total:
            y = gaps[j]
            del rows[shared[j] + 1 :]
            d = len(rows) - 1
            low, same, high = rows[d]
            size = len(y)
            while d < size and (low < 2 or same < 2 or high < 2):
                c = y[d]
                one = same + 1
                if d and low + (x[d - 1] != c) < one:
                    one = low + (x[d - 1] != c)
                two = three = _FAR
                if d < m:
                    two = min(same + (x[d] != c), one + 1, high + 1)
                    if d + 1 < m:
                        three = min(high + (x[d + 1] != c), two + 1)
                low, same, high = one, two, three
                d += 1
                rows.append((low, same, high))
            if low >= 2 and same >= 2 and high >= 2:
                j += 1
                while j < total and shared[j] >= d:  # all that share the d letters are as far
                    j += 1
                continue
            if (same if size == m else low) == 1:
                yield i, j
            j += 1


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs, both ways, of the lists in batches sorted by key and gap; a list may go over many batches."""

    def solved(table: pa.Table) -> pa.RecordBatch:
        key = table["key"].combine_chunks()
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        begin = np.append(np.flatnonzero(fresh), len(key))
        gap, short = table["gap"].to_pylist(), table["short"].to_pylist()
        left, right = [], []
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            if b - a > 1 and True in short[a:b]:
                for i, j in one_edit_apart(gap[a:b], short[a:b]):
                    left.append(a + i)
                    right.append(a + j)
                    if not short[a + j]:  # two short entries meet once from each side
                        left.append(a + j)
                        right.append(a + i)
        one, two = table.take(pa.array(left, pa.int64())), table.take(pa.array(right, pa.int64()))
        columns = [one["word"], two["word"], two["n"]]
        return pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in columns], ["word", "near", "near_n"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(batch.schema.get_field_index("key"))
        last = key[batch.num_rows - 1]
        cut = pc.index(key, last).as_py()  # from here on the list may go on in the next batch
        if held and cut == 0 and held[0].column("key")[0].equals(last):
            held.append(batch)
            continue
        if held or cut:
            yield solved(pa.Table.from_batches([*held, batch.slice(0, cut)]))
        held = [batch.slice(cut)]
    if held:
        yield solved(pa.Table.from_batches(held))


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH, most: int = MOST) -> DataFrame:
    """word, near, near_n for all pairs one edit apart, both ways; pairs may repeat. ``words`` has word and n."""
    found, opened = None, _keyed(_opened(words, least_length))
    while True:
        large = stored(opened.groupBy("key", "a", "b").count().where((F.col("count") > most) & (F.col("b") - F.col("a") > 1)).select("key"), "spelling-keys")
        more = not large.isEmpty()
        lists = opened.join(large, "key", "left_anti") if more else opened
        lists = lists.select("key", "gap", "word", "n", "short").repartition("key").sortWithinPartitions("key", "gap")
        pairs = lists.mapInArrow(_near, "word string, near string, near_n long")
        found = pairs if found is None else found.union(pairs)
        if not more:
            return found
        opened = _keyed(_halved(stored(opened.join(large, "key", "left_semi").select("word", "n", "size", "a", "b"), "spelling-lists")))


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary of ``docs`` (doc_id, text)."""
    words = stored(vocabulary(docs, least_length, least_count), "spelling-words")
    # A word has at most some thousand near words: one letter more, less or other at each place.
    near = near_words(words, least_length, most).groupBy("word").agg(F.collect_set(F.struct((-F.col("near_n")).alias("less"), "near")).alias("near"))
    best = F.array_min("near")
    joined = words.join(near, "word", "left").select("word", "n", F.coalesce(F.size("near"), F.lit(0)).cast("long").alias("n_near"), best["near"].alias("near"), (-best["less"]).alias("near_n"))
    enough = F.col("near_n") >= ratio * F.col("n")
    formed = stored(joined.select("word", "n", "n_near", F.when(enough, F.col("near")).alias("form"), F.when(enough, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(formed.where("form is not null").select("word", F.col("form").alias("root")), formed, ratio)
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(step: DataFrame, formed: DataFrame, ratio: int) -> DataFrame:
    """word, root: the steps known are doubled until no chain can be longer."""
    top = formed.agg(F.max("form_n")).first()[0] or 1
    longest = 1 + int(math.log(top, ratio))
    for _ in range(max(longest - 1, 0).bit_length()):
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(step.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return step
