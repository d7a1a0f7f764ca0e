"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is its set of word shingles. Two documents link when their sets have a Jaccard similarity of at least
``percent`` / 100. Shingles have one global order, rare ones first: by the logarithm of a counter that all documents
feed (a hash table of fixed size, so counts are upper bounds and the order is only a matter of speed), then by hash. The
table must be large beside the shingles and its logarithm fine: where all counters are about as full, the order is by hash,
prefixes hold common shingles, and the pairs to be tried grow much faster than the documents.
If two sets link, the prefixes of ``n - ceil(t n) + l`` shingles of both share at least ``l`` shingles. Every document
takes the ``l`` for which its estimated cost is least: reading the postings of its prefix, plus verifying the
candidates, of which there are at most (postings read) / l. A pair needs ``min`` of both ``l`` before it is verified.

Large groups of near copies would make all pairs. Only components are asked for, so links are looked for in two ways:

* stars: in each posting list every document meets a few pivots of the list. This is linear in the postings and joins
  a group of near copies into one component;
  The first pivot of a list is the document in the middle of its near copies, the one whose prefix is most common;
* the rest: each pair of a posting list whose documents still lie in different components meets, unless it has been
  verified. Star rounds go on as long as they at least halve this rest, then all of it is verified. No pair is dropped. In
  lists of more than ``LONG_LIST`` documents no pairs are formed; what is left there is joined anew, with exact counts
  (``_in_crowd``), where near copies that can't link drop out by themselves.

Equal sets are one class before all this. Sets are compared in full (64-bit hashes of shingles).

Defined cases: null, empty and blank texts have no shingle and stay alone; with fewer words than a shingle the whole
sequence is the one shingle; rows that share a ``doc_id`` are one document for the links; a null ``doc_id`` comes back
with component null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallybook.llm.tables import components, discard, merged, pack, stored, unused
from tallybook.llm.tokens import BLANKS, Words, pieces, shingles

SHINGLE_WORDS = 3
PERCENT = 90
LONGEST_MATCH = 8
#: Cost of verifying a candidate, counted in postings read.
VERIFY_COST = 64
_COUNTER_BITS = 22
#: Steps of the order for each doubling of a counter; all steps of a 32-bit counter fit in a byte.
_STEPS = 7
#: Bits of the filter that spares most documents the last pass; it lets too many pass, never too few.
_FILTER_BITS = 1 << 23
_PIVOTS = 4
#: In lists longer than this pairs are not formed; their documents are joined by prefixes in an exact order.
LONG_LIST = 512


def ngram_components(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    first = stored(
        texts.mapInArrow(lambda it: _sets(it, words), "doc_id long, n long, key binary, counters binary"), "ngram-sets"
    )
    members = stored(first.where("counters IS NULL").drop("counters"), "ngram-members")
    classes = members.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"))
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(_ranks(first))
    discard(first)

    prefixes = texts.where("doc_id IS NOT NULL").mapInArrow(
        lambda it: _prefixes(it, ranks.value, words, percent), "doc_id long, n long, key binary, tokens array<long>"
    )
    prefixes = stored(
        prefixes.join(classes, (prefixes.key == classes.key) & (prefixes.doc_id == classes.rep), "left_semi")
        .select("doc_id", "n", "tokens").distinct(),
        "ngram-prefixes",
    )
    chosen = stored(_chosen(prefixes, percent), "ngram-chosen")
    links = _links(texts, chosen, words, percent)
    discard(prefixes, chosen)
    # Rows of one class share its rep; rows that share a doc_id are tied by an edge between their classes.
    rows = members.join(classes, "key", "left")
    tied = rows.where("rep IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
    groups = components(links.select("a", "b").union(tied))
    return (
        members.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    )


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    counters = np.zeros(1 << _COUNTER_BITS, dtype=np.uint32)
    for batch in pieces(batches):
        values, begin = shingles(Words(batch.column(1), BLANKS), words)
        slots, found = np.unique(_slots(values), return_counts=True)
        counters[slots] += found.astype(np.uint32)
        n = np.diff(begin)
        keys = [hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() for a, b in zip(begin[:-1], begin[1:])]
        yield _arrow(batch.column(0), pa.array(n), pa.array(keys, pa.binary()), pa.nulls(len(n), pa.binary()))
    none = pa.nulls(1, pa.int64())
    yield _arrow(none, none, pa.nulls(1, pa.binary()), pa.array([pack(counters)], pa.binary()))


def _slots(shingled: np.ndarray) -> np.ndarray:
    return (shingled >> np.uint64(64 - _COUNTER_BITS)).astype(np.int64)


def _arrow(*columns: pa.Array) -> pa.RecordBatch:
    names = ("doc_id", "n", "key", "counters")
    return pa.RecordBatch.from_arrays(list(columns), names[: len(columns)])


def _ranks(first: DataFrame) -> np.ndarray:
    """Logarithm of each counter, over all documents, in steps that fit a byte."""

    def steps(total: np.ndarray) -> bytes:
        return (_STEPS * np.log2(total.astype(np.float32) + 1)).astype(np.uint8).tobytes()

    ranks = merged(first.where("counters IS NOT NULL").select("counters"), np.uint32, np.add, packed=True, last=steps)
    return np.zeros(1 << _COUNTER_BITS, dtype=np.uint8) if ranks is None else ranks


def _prefixes(batches: Iterator[pa.RecordBatch], ranks: np.ndarray, words: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        values, begin = shingles(Words(batch.column(1), BLANKS), words)
        rank = ranks[_slots(values)]
        n, tokens, keys = np.diff(begin), [], []
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
            size = b - a
            keys.append(hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest())
            take = min(size, size - (percent * size + 99) // 100 + LONGEST_MATCH)
            order = np.argsort(rank[a:b], kind="stable")[:take]  # values ascend, so ties are in order of hash
            tokens.append(values[a:b][order].view(np.int64))
        columns = [batch.column(0), pa.array(n), pa.array(keys, pa.binary()), pa.array(tokens, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "key", "tokens"])


def _chosen(prefixes: DataFrame, percent: int) -> DataFrame:
    """doc_id, n, need (shared prefix shingles asked for), tokens (those of the prefix that another document has, too), places (where
    in the order of all its shingles each stands)."""
    postings = prefixes.select("doc_id", "n", F.posexplode("tokens").alias("pos", "token"))
    # Counted where they are dealt to, so the postings move once and no list of tokens moves beside them.
    shared = postings.withColumn("f", F.count(F.lit(1)).over(W.partitionBy("token"))).where("f > 1")
    least = F.col("n") - F.floor((percent * F.col("n") + 99) / 100)
    read = [F.sum(F.when(F.col("pos") < least + m, F.col("f") - 1).otherwise(0)) for m in range(1, LONGEST_MATCH + 1)]
    cost = [
        F.struct((r * (1 + VERIFY_COST / m)).alias("cost"), F.lit(m).alias("need"))
        for m, r in enumerate(read, 1)
    ]
    # A document whose whole prefix is common is in the middle of its near copies; these have shingles of their own.
    middle = F.sum(F.log2("f")) / F.least("n", least + LONGEST_MATCH)
    kept = shared.groupBy("doc_id", "n").agg(
        F.array_min(F.array(*cost))["need"].alias("need"), F.collect_list(F.struct("pos", "token")).alias("found"),
        middle.alias("middle"),
    )
    need = F.least("need", F.floor((percent * F.col("n") + 99) / 100)).cast("int")
    within = F.filter("found", lambda x: x["pos"] < least + F.col("need"))
    return kept.withColumn("need", need).select("doc_id", "n", "need", "middle", within["token"].alias("tokens"), within["pos"].alias("places"))


def _links(texts: DataFrame, chosen: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links (a, b) that hold every component together."""
    seen, groups = None, None
    rest, turn = None, 0
    fetched: list[DataFrame] = []

    def sets_for(docs: DataFrame) -> DataFrame:
        """Sets of these documents, and of others; each is fetched once."""
        needed = docs
        for sets in fetched:
            needed = needed.join(sets.select("doc_id"), "doc_id", "left_anti")
        needed = stored(needed, "ngram-needed")
        fetched.append(stored(_sets_of(texts, needed, words), "ngram-candidates"))
        discard(needed)
        return reduce(DataFrame.union, fetched)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs not yet seen, joined to all that are; only sets of documents in a pair are ever fetched."""
        pairs = stored(pairs if seen is None else pairs.join(seen, ["a", "b"], "left_anti"), "ngram-pairs")
        found = _verified(pairs, sets_for(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()), percent)
        now = stored(found if seen is None else seen.union(found), "ngram-verified")
        discard(pairs, seen)
        return now

    while True:
        now = chosen if groups is None else chosen.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        now = now.withColumn("component", F.coalesce("component", "doc_id") if groups is not None else F.col("doc_id"))
        now = now.select(F.explode(F.arrays_zip("tokens", "places")).alias("x"), "doc_id", "n", "need", "middle", "component")
        now = now.select(F.col("x.tokens").alias("token"), F.col("x.places").alias("pos"), "doc_id", "n", "need", "middle", "component")
        mixed = None
        if turn:
            mixed = stored(_mixed(now), "ngram-mixed")
            left = mixed.agg(F.sum("pairs")).first()[0] or 0
            if not left:
                break
            if rest is not None and left > rest / 2 or left <= 2 * mixed.count():
                short, crowd = _by_length(mixed)
                crowd = stored(crowd, "ngram-crowd")
                seen = verified(_across(short, crowd, percent))
                if not crowd.isEmpty():
                    seen = verified(_in_crowd(crowd, sets_for(crowd.select("doc_id")), percent))
                discard(mixed, crowd)
                break
            rest, now = left, mixed
        seen = verified(_stars(now, chosen, turn, percent))
        discard(mixed)
        groups = stored(components(seen.where("links").select("a", "b")), "ngram-groups")
        turn += 1
    discard(*fetched)
    return seen.where("links")


def _sizes_fit(n: Column | str, m: Column | str, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def _stars(lists: DataFrame, chosen: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of each document with its list's pivot, if they share enough of their prefixes."""
    seed = F.pmod(F.col("token"), F.lit(_PIVOTS)) + turn * _PIVOTS
    first = F.lit(0.0) if turn else -F.col("middle")
    by = F.struct(first.alias("first"), F.xxhash64("doc_id", seed).alias("by"), F.col("doc_id").alias("p"), F.col("component").alias("pc"), F.col("need").alias("pneed"))
    met = lists.select("doc_id", "need", "component", F.min(by).over(W.partitionBy("token")).alias("v")).select("doc_id", "need", "component", "v.p", "v.pc", "v.pneed")
    met = met.where("component <> pc").groupBy(F.least("doc_id", "p").alias("a"), F.greatest("doc_id", "p").alias("b"))
    # What two documents share is dealt to some pivots; pairs that meet too rarely for that wait for the rest.
    pairs = met.agg(F.count(F.lit(1)).alias("lists"), F.min(F.least("need", "pneed")).alias("asked")).where(F.col("lists") * _PIVOTS >= F.col("asked"))
    return _sharing_enough(pairs.select("a", "b"), chosen, percent)


def _sharing_enough(pairs: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    one = chosen.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("need").alias("la"), F.col("tokens").alias("ta"))
    two = chosen.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("need").alias("lb"), F.col("tokens").alias("tb"))
    return (
        pairs.join(one, "a").join(two, "b").where(_sizes_fit("na", "nb", percent))
        .where(F.size(F.array_intersect("ta", "tb")) >= F.least("la", "lb")).select("a", "b")
    )


def _mixed(lists: DataFrame) -> DataFrame:
    """Postings of lists that span several components, with the list's largest component and the pairs it takes."""
    by, first, last = W.partitionBy("token"), F.min("component"), F.max("component")
    mixed = lists.select("*", F.count(F.lit(1)).over(by).alias("all"), first.over(by).alias("first"), last.over(by).alias("last")).where("first <> last")
    mixed = mixed.withColumn("size", F.count(F.lit(1)).over(W.partitionBy("token", "component")))
    mixed = mixed.withColumn("main", F.max(F.struct("size", "component")).over(by)["component"])
    pairs = F.when(F.col("component") == F.col("main"), 0).otherwise(F.col("all"))
    return mixed.withColumn("pairs", pairs.cast("long")).drop("all", "first", "last", "size")


def _by_length(mixed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of lists of at most ``LONG_LIST`` documents; and the documents (doc_id, n, component) of longer lists, with the
    number of these that hold each (elsewhere)."""
    long = mixed.groupBy("token").agg(F.count(F.lit(1)).alias("postings")).where(F.col("postings") > LONG_LIST).select("token")
    crowd = mixed.join(long, "token", "left_semi").groupBy("doc_id", "n", "component").agg(F.count(F.lit(1)).alias("elsewhere"))
    return mixed.join(long, "token", "left_anti"), crowd


def _across(mixed: DataFrame, crowd: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents that meet in lists, lie in different components and may share enough of their prefixes.

    Two sets that link share at least ``common`` shingles, so either has at most ``n - common`` before its first shared one, and
    the ``l``-th shared one, for every ``l``, stands below ``n - common + l`` in both. Only such meetings are formed and counted.
    """
    columns = ("doc_id", "n", "need", "pos", "component")
    left = mixed.where("component <> main").select("token", *[F.col(c).alias(f"{c}1") for c in columns])
    right = mixed.select("token", "main", *[F.col(c).alias(f"{c}2") for c in columns])
    met = left.join(right, "token").where("component1 <> component2 AND (component2 = main OR doc_id1 < doc_id2)")
    common = F.floor((F.lit(percent) * (F.col("n1") + F.col("n2")) + 99 + percent) / (100 + percent))
    behind = common - F.least("need1", "need2")
    met = met.where(_sizes_fit("n1", "n2", percent)).where((F.col("pos1") < F.col("n1") - behind) & (F.col("pos2") < F.col("n2") - behind))
    met = met.groupBy(F.least("doc_id1", "doc_id2").alias("a"), F.greatest("doc_id1", "doc_id2").alias("b"))
    met = met.agg(F.count(F.lit(1)).alias("shared"), F.min(F.least("need1", "need2")).alias("asked"))
    for side in ("a", "b"):
        met = met.join(crowd.select(F.col("doc_id").alias(side), F.col("elsewhere").alias(f"more_{side}")), side, "left")
    more = F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
    return met.where(F.col("shared") + more >= F.col("asked")).select("a", "b")


def _in_crowd(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of the crowd's documents, in different components, that may link: by prefixes in an exact order.

    Within the crowd shingles are counted exactly and ordered by rarity, so shingles that one document has alone come
    first. Two documents that link share a shingle among the first ``n - ceil(t n) + 1`` of both; if the first shared one stands at
    ``pos``, they share at most ``n - pos``, which bounds the other's size. Near copies with more shingles of their own than
    a link allows are out by themselves, however many they are. Pairs meet by shingle and size class.
    """
    tokens = sets.join(crowd, "doc_id").select("doc_id", "shingles").mapInArrow(_exploded, "doc_id long, token long")
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    shared = tokens.join(counts, "token").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("f", "token"))).alias("shared"))
    ranked = crowd.join(shared, "doc_id").withColumn("alone", F.col("n") - F.size("shared"))
    least = F.ceil(F.lit(percent) * F.col("n") / 100)
    postings = ranked.select("doc_id", "n", "component", "alone", F.posexplode(F.slice("shared", F.lit(1), F.greatest(F.lit(0), F.col("n") - least + 1 - F.col("alone")).cast("int"))).alias("at", "x"))
    most = F.floor((F.col("n") - F.col("alone") - F.col("at")) * (100 + percent) / percent) - F.col("n")
    postings = stored(postings.select("doc_id", "n", "component", F.col("x.token").alias("token"), most.alias("most")), "ngram-postings")

    def size_class(n: Column) -> Column:
        return F.floor(F.log(n) / math.log(100 / max(min(percent, 99), 1))).cast("int")

    small = postings.where("most >= n").select("token", F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("component").alias("ca"), F.col("most").alias("ma"), size_class(F.col("n")).alias("class"))
    top = F.least("n", "most")
    large = postings.where(top >= least).select("token", F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("component").alias("cb"), top.alias("mb"), F.explode(F.sequence(size_class(least), size_class(top))).alias("class"))
    met = small.join(large, ["token", "class"]).where("ca <> cb AND na <= mb AND nb <= ma AND (na < nb OR a < b)")
    return met.where(_sizes_fit("na", "nb", percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, shingled in zip(batch.column(0), batch.column(1)):
            values = np.frombuffer(shingled.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), doc_id.as_py())), pa.array(values)], ["doc_id", "token"])


def _sets_of(texts: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """doc_id and shingles of the needed documents, by another pass over the texts."""
    spark = texts.sparkSession
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_FILTER_BITS))

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(_FILTER_BITS // 8, dtype=np.uint8)
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False)
            np.bitwise_or.at(table, at >> 3, (1 << (at & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary())], ["counters"])

    table = merged(needed.select(slot).mapInArrow(marked, "counters binary"), np.uint8, np.bitwise_or)
    table = np.zeros(_FILTER_BITS // 8, dtype=np.uint8) if table is None else table
    passing = spark.sparkContext.broadcast(table)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array((passing.value[at >> 3] >> (at & 7) & 1).astype(bool)))
            for piece in pieces([batch]):
                values, begin = shingles(Words(piece.column(1), BLANKS), words)
                sets = [values[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])

    return (
        texts.where("doc_id IS NOT NULL").withColumn("bit", slot).mapInArrow(kept, "doc_id long, shingles binary")
        .join(needed, "doc_id", "left_semi").distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, links: whether the whole sets are similar enough."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = np.concatenate((one, two))
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                links.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(links, pa.bool_())], ["a", "b", "links"])

    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    found = pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(compared, "a long, b long, links boolean")
    return found.groupBy("a", "b").agg(F.max("links").alias("links"))


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the smallest ``doc_id``. Documents without words or id are all kept.

    Of rows that share the smallest id and are the same document, one stays (the one with the least text).
    """
    groups = ngram_components(docs, words, percent)
    gone, again, turn = (unused(docs, name) for name in ("gone", "again", "turn"))
    # Ids are stored before texts are joined to them: Spark knows the size of either list then, and moves the texts once, or
    # not at all, instead of once for each of the two joins.
    dropped = groups.where("n_shingles > 0 AND component_id <> doc_id").select(F.col("doc_id").alias(gone)).distinct()
    dropped = stored(dropped, "ngram-dropped")
    is_gone = F.col("doc_id").cast("long") == F.col(gone)
    kept = docs.join(dropped, is_gone, "left_anti")
    spare = kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(again))
    spare = stored(spare, "ngram-spare")
    single = kept.join(spare, F.col("doc_id") == F.col(again), "left_anti")
    repeated = docs.join(spare, F.col("doc_id") == F.col(again), "left_semi").join(dropped, is_gone, "left_anti")
    place = F.row_number().over(W.partitionBy("doc_id").orderBy("text")).alias(turn)
    first = repeated.select("*", place).where(F.col(turn) == 1).drop(turn)
    return single.unionByName(first)
