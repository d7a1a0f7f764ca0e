"""Crowds of near copies, interactions of words, odd pages, long key runs, and columns whose names clash."""

import hashlib
import random
import time
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import mixing, ngram_join, page_text, secrets, substrings, tables, toxicity


def shingled(text, size):
    words = text.split()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def classes(sets, percent):
    head = {i: i for i in sets}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                head[max(top(a), top(b))] = min(top(a), top(b))
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("long_list", [1, 12, ngram_join.LONG_LIST])
@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_a_crowd_of_near_copies(spark, monkeypatch, long_list, size, percent):
    """Copies of one text with few to many changes, so links are just present or just missing."""
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(400)}" for _ in range(110)]
    rows = []
    for i in range(140):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 2, 3, 4, 6])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(30)}"
        rows.append((i, " ".join(words[: rnd.choice([110, 110, 104, 100])])))
    rows += [(200 + i, f"one two three common words {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.ngram_components(docs, size, percent).collect()}
    want = classes({i: shingled(t, size) for i, t in rows}, percent)
    assert got == want and len(set(want.values())) > 45


def test_clashing_names(spark):
    rows = [(1, "a b c d e f g", "s", 1, 2.5, True, "x", 9), (1, "a b c d e f g", "s", 1, 2.5, True, "x", 9), (2, "other words of a text", None, 2, 0.5, False, "y", 9), (None, None, "s", 3, 9.0, None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, turn int, toxicity double, gone boolean, copy string, again int")
    kept = ngram_join.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2]
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    mild = toxicity.without_toxic(docs, labels)
    assert mild.columns == docs.columns and {r.toxicity for r in mild.collect()} <= {2.5, 0.5, 9.0}
    mixed = mixing.mixed(docs)
    assert mixed.columns == [*docs.columns, "_copy"] and {r.copy for r in mixed.collect()} <= {"x", "y", None}


@pytest.mark.parametrize("rule", [lambda insult, group: insult and group, lambda insult, group: insult != group])
def test_words_that_matter_only_together(rule):
    """Insults that are toxic only beside a group's name, or only without it: no sum of weights for single words can tell the second."""

    def made(rng, n):
        terms, doc, target = [], [], []
        for i in range(n):
            words = set(rng.integers(10, 3000, 60).tolist())
            insult, group = (rng.random(2) < 0.5).tolist()
            words |= ({1} if insult else set()) | ({2} if group else set())
            terms.append(sorted(words))
            doc.append(np.full(len(words), i, np.int32))
            target.append(float(rule(insult, group)))
        return np.array(target), np.concatenate(terms).astype(np.int32), np.concatenate(doc)

    rng = np.random.default_rng(0)
    machine = toxicity.learn(*made(rng, 3000))
    target, terms, doc = made(rng, 1500)
    begin = np.searchsorted(doc, np.arange(len(target) + 1))
    assert ((machine.scores(terms, begin) >= 0.5) == (target > 0)).mean() > 0.95
    machine.factor[:] = 0
    linear = ((machine.scores(terms, begin) >= 0.5) == (target > 0)).mean()
    assert linear < 0.9


@pytest.mark.parametrize("page,texts", [
    ("<html><head><title>T</title><meta charset=u><p>First</p><div>Second</div>", ["First", "Second"]),
    ("<head><title>x</title>Hello <b>you</b>", ["Hello you"]),
    ("<HEAD><STYLE>p{}</STYLE><noscript><link rel=x></noscript></HEAD><BODY><P>In</BODY>", ["In"]),
    ("<body><noscript><img src=x><p>Rest of the page</p></body>", ["Rest of the page"]),
    ("<noscript><p>no</p></noscript><p>yes</p><svg><text>no</text></svg><p>too</p>", ["yes", "too"]),
    ('<p class="x>lost text</p><p title="a > b">kept</p>', ["lost text", "kept"]),
    ("<p>it's <a href='x'>fine</a> \"so\"</p><p data-x='1>2'>ok</p><p class=a'b>odd</p>", ['it\'s fine "so"', "ok", "odd"]),
    ("<p>ends in a <b", ["ends in a"]),
    ("", []),
])
def test_odd_pages(page, texts):
    assert [text for _, text, _ in page_text.blocks(page)] == texts


def test_pages_of_open_tags_take_linear_time():
    start = time.perf_counter()
    for page in ("<p '" * 20_000, '<p a="' * 20_000, "<p>" * 50_000, "<noscript>" * 20_000, "<head>" * 300 + "x" * 200_000):
        page_text.blocks(page)
    assert time.perf_counter() - start < 10


def test_names_are_told_in_linear_time():
    start = time.perf_counter()
    assert not secrets.is_name("12345_" * 20_000 + "aBc")
    assert secrets.is_name("some_long-Name2/PART_77") and secrets.is_name("end_") and not secrets.is_name("_a") and not secrets.is_name("x9Kq2")
    assert time.perf_counter() - start < 1


def test_many_copies_of_one_passage(spark):
    """One passage in very many documents, with other words around it and overlaps with itself."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(450))
    texts = [f"{rnd.random()}" * rnd.randint(1, 4) + passage + f"{rnd.random()}" for _ in range(3000)] + [passage[:399], passage[20:430], "ab" * 400]
    texts += ["".join(rnd.choice("klmnop") for _ in range(500))]
    rows = [*enumerate(texts), (3003, texts[3003]), (None, texts[3003][:450])]  # a row that stands twice, and part of it
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    answer = substrings.deduplicated(docs).collect()
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in answer}
    assert len(answer) == len(rows) and got[3003] == (500, 1) and got[None] == (450, 1)
    common = {i: got[i] for i in range(3000)}
    assert all(n == 1 and 450 <= removed <= 470 for removed, n in common.values())
    assert got[3000] == (0, 0) and got[3001] == (410, 1) and got[3002] == (800, 1)


def test_copies_of_a_suffix_are_sorted_once(spark, monkeypatch):
    """Copies of a text bring the same starts, so one of them goes on beside a text that ends otherwise; also in hot ranges."""
    rnd = random.Random(11)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(900))
    ends = ["".join(rnd.choice("klmnop") for _ in range(600)) for _ in range(4)]
    texts = [passage + ends[0]] * 300 + [passage[:700] + ends[1], passage[200:] + ends[2], ends[3]]
    raw = [t.encode() for t in texts]
    seen = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    want = {}
    for n, b in enumerate(raw):
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = True
        want[n] = (int(gone.sum()), hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    kept = {}
    monkeypatch.setattr(substrings, "stored", lambda df, name: kept.setdefault((hot, name), tables.stored(df, name)))
    for hot in (substrings._HOT_RECORDS, 20):
        monkeypatch.setattr(substrings, "_HOT_RECORDS", hot)
        got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substrings.deduplicated(docs).collect()}
        assert got == want
        on = kept[hot, "suffix-first"].where("around IS NOT NULL")
        assert 0 < on.count() == on.select("digest", "before", "around").distinct().count() < 100


def test_cutting_many_strings_out_takes_little_memory():
    """As many texts as Spark hands over at once, each with a lot of overlapping and touching strings, some with none."""
    rnd = random.Random(7)
    texts = [None if n % 50 == 0 else "é" + "abcdefg" * rnd.randint(60, 200) for n in range(6_000)]
    found = [None if n % 7 == 0 else sorted((rnd.randrange(len(t) - 60), rnd.randint(20, 60)) for _ in range(30)) if t else [] for n, t in enumerate(texts)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("reach", pa.int64())]))
    dicts = [None if f is None else [{"start": a, "reach": n} for a, n in f] for f in found]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6_000)), pa.array(texts, pa.string()), pa.array(dicts, kind)], ["doc_id", "text", "found"])
    del dicts
    tracemalloc.start()
    rows = pa.Table.from_batches(substrings._cut(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000  # lists of Python objects took several times as much
    for text, spans, row in zip(texts, found, rows.to_pylist()):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for a, n in spans or ():
            gone[a : a + n] = b"\1" * n
        edges = [i for i in range(len(data) + 1) if (gone[i - 1] if i else 0) != (gone[i] if i < len(data) else 0)]
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], row["spans"]) == (len(data), sum(gone), len(edges) // 2, edges)
        assert row["kept_sha256"] == hashlib.sha256(bytes(c for c, g in zip(data, gone) if not g)).hexdigest()


def test_mix_joins_once_a_plan(spark, monkeypatch):
    """Each broadcast join takes memory of the driver, so a plan has one at most and few plans have any."""
    joins = []

    def counted(df, name):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return tables.stored(df, name)

    monkeypatch.setattr(mixing, "stored", counted)
    docs = spark.createDataFrame([(n, "w " * (1 + n % 37), ["a", "a", "b", None][n % 4]) for n in range(400)], "doc_id long, text string, source string")
    mixing.rates(docs)
    assert max(joins) == 1 and sum(joins) < 20


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert ngram_join.ngram_components(docs).collect() == [] and substrings.deduplicated(docs).collect() == []
    assert toxicity.toxicity(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect() == []
    assert mixing.mix(docs).collect() == []
    assert page_text.main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_driver_gets_one_array_of_many(spark, monkeypatch):
    """Each array that passes through the driver takes several times its size there."""
    sizes = []
    collect = type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: sizes.append(len(rows := collect(self))) or rows)
    rows = [(np.full(1000, n, dtype=np.int64).tobytes(),) for n in range(12)]
    total = tables.merged(spark.createDataFrame(rows, "counters binary").repartition(6), np.int64, np.add)
    assert sizes == [1] and (total == sum(range(12))).all()
    assert tables.merged(spark.createDataFrame([], "counters binary"), np.int64, np.add) is None


def test_labelled_terms_reach_the_driver_without_an_object_a_row():
    rnd = random.Random(3)
    own = [np.array(sorted(rnd.sample(range(1000), rnd.randint(0, 300))), dtype=np.int32) for _ in range(4_000)]
    kind = pa.schema([("terms", pa.binary()), ("toxic", pa.int32())])
    whole = pa.Table.from_arrays([pa.array([x.tobytes() for x in own], pa.binary()), pa.array([n % 3 == 0 for n in range(4_000)]).cast(pa.int32())], schema=kind)
    rows = pa.concat_tables([whole.slice(0, 1500), whole.slice(1500, 0), whole.slice(1500)])
    tracemalloc.start()
    target, term, doc = toxicity._flat(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert target.tolist() == [float(n % 3 == 0) for n in range(4_000)] and (term == np.concatenate(own)).all()
    assert (doc == np.repeat(np.arange(4_000), [len(x) for x in own])).all() and peak < 4 * term.nbytes
    assert [len(x) for x in toxicity._flat(whole.slice(0, 0))] == [0, 0, 0]


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        names.add(found.next().getName())
    return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """A driver that is seldom short of memory would keep those of all jobs."""
    before = shuffle_files(spark)
    rows = spark.range(50_000).withColumn("k", F.col("id") % 999)
    table = tables.stored(rows.join(rows.groupBy("k").agg(F.max("id").alias("top")).hint("merge"), "k").distinct(), "test-files")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before and table.count() == 50_000


def test_texts_move_once_to_lose_their_copies(spark, monkeypatch):
    """Neither list of ids is small enough to be sent whole, or only the empty one is."""
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{text} x{i % 90}" if i % 3 else f"own{i} " * 9) for i in range(900)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1100")
    try:
        kept = ngram_join.one_of_each(tables.stored(docs, "test-docs"), 5, 80)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        moved = [x for x in plan.split("\n") if "Exchange hashpartitioning(doc_id" in x]
        assert kept.count() == 301 and len(moved) <= 1 + plan.count("Window [")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_postings_move_once(spark):
    prefixes = spark.createDataFrame([(i, 40, [i % 7, 100 + i, 1000 + i % 3]) for i in range(60)], "doc_id long, n long, tokens array<long>")
    chosen = ngram_join._chosen(prefixes, 90)
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    got = {r.doc_id: set(r.tokens) for r in chosen.collect()}
    assert got == {i: {i % 7, 1000 + i % 3} for i in range(60)}


def test_rare_shingles_lead_where_many_documents_fill_the_counters(spark):
    """Two million words found once, and a thousand that six documents share, each with a hundred of its own."""
    rows = [(i, " ".join(f"{i}u{j}" for j in range(100_000))) for i in range(20)]
    shared = " ".join(f"common{j}" for j in range(1000))
    rows += [(100 + i, shared + "".join(f" {i}own{j}" for j in range(100))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    first = tables.stored(docs.mapInArrow(lambda it: ngram_join._sets(it, 1), "doc_id long, n long, key binary, counters binary"), "test-sets")
    ranks = ngram_join._ranks(first)
    batch = pa.RecordBatch.from_pydict({"doc_id": [100 + i for i in range(6)], "text": [t for _, t in rows[20:]]})
    (found,) = ngram_join._prefixes(iter([batch]), ranks, 1, 90)
    prefixes = [set(x) for x in found.column(3).to_pylist()]
    common = set.intersection(*(set(ngram_join.shingles(ngram_join.Words(pa.array([t]), ngram_join.BLANKS), 1)[0].view(np.int64).tolist()) for _, t in rows[20:]))
    assert len(common) == 1000 and all(len(x) == 118 and len(x & common) < 40 for x in prefixes)


def test_pairs_that_meet_too_late_are_not_formed(spark):
    """Of a hundred shingles each, two sets that link at 90 percent share 95, so the first shared one has five before it at most."""
    columns = "token long, pos int, doc_id long, n long, need int, middle double, component long, main long, pairs long"
    lists = [(1, [(1, 5), (2, 5)]), (2, [(3, 5), (4, 6)]), (3, [(5, 6), (6, 0)]), (4, [(7, 6), (8, 6)]), (5, [(7, 0), (8, 0)]), (6, [(9, 3), (10, 3)])]
    need = {7: 2, 8: 3, 9: 2, 10: 2}
    rows = [(token, pos, doc, 100, need.get(doc, 1), 0.0, doc, -1, 2) for token, found in lists for doc, pos in found]
    crowd = spark.createDataFrame([(9, 100, 9, 1), (10, 100, 10, 4)], "doc_id long, n long, component long, elsewhere long")
    pairs = ngram_join._across(spark.createDataFrame(rows, columns), crowd, 90).collect()
    assert {(r.a, r.b) for r in pairs} == {(1, 2), (7, 8), (9, 10)}
