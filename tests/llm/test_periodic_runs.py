"""Runs of repeating words against brute force, on tiles of many sizes, and the cases of the docstring."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tallybook.llm import periodic_runs as op

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MILLI = "exponent_milli"


def runs_of(words, least=12):
    """(start, length, period) of every run, by trying every period at every word."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q) and j > i:
                part = words[i : i + length]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, least=12):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = runs_of(words, least)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def answer(df):
    columns = ("doc_id", "n_runs", "start", "length", "period", MILLI, "runs_sha256", "collapsed_sha256")
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def random_text(rnd):
    n = rnd.choice([0, 1, 11, 12, 40, 90, 200])
    words = [rnd.choice("ab") if rnd.random() < 0.1 else f"w{rnd.randrange(rnd.choice([2, 60]))}" for _ in range(n)]
    for _ in range(rnd.choice([0, 1, 2])):
        if n > 20:
            s, p, length = rnd.randrange(n - 10), rnd.randint(1, 25), rnd.randint(4, 90)
            for i in range(s + p, min(n, s + length)):
                words[i] = words[i - p]
    return "".join(w + rnd.choice([" ", "\n", " \t"]) for w in words)


@pytest.mark.parametrize("least", [2, 12, 30])
def test_tiles_of_any_size_give_the_same_runs(least):
    rnd = random.Random(least)
    for _ in range(60):
        docs = [WORD.findall(random_text(rnd)) for _ in range(rnd.randint(1, 4))]
        docs.append([f"{bin(i).count('1') % 2}" for i in range(300)])  # Thue-Morse: squares everywhere, no cubes
        hashes = [op.mix(np.array([zlib.crc32(w.encode()) for w in d], dtype=np.uint64) + np.uint64(9)) for d in docs]
        for tile_words in (1, 8, 64, 4096):
            for words, found in zip(docs, op._fragments(hashes, tile_words, least)):
                joined = {}
                for f in sorted(found, key=lambda f: (f["period"], f["start"])):
                    spans = joined.setdefault(f["period"], [])
                    if spans and f["start"] <= spans[-1][1] - f["period"]:
                        spans[-1][1] = max(spans[-1][1], f["end"])
                    else:
                        spans.append([f["start"], f["end"]])
                got = sorted(((a, b - a, q) for q, spans in joined.items() for a, b in spans if b - a >= max(least, 2 * q)), key=lambda r: (r[0], r[2]))
                assert got == runs_of(words, least)


@pytest.mark.parametrize("tile_words", [16, op.TILE_WORDS])
def test_against_brute_force(spark, tile_words):
    rnd = random.Random(7)
    rows = [(i, random_text(rnd)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "a " * 12), (504, "a " * 11), (505, "x y " * 6), (None, "b c " * 9), (506, "\x00 " * 13), (3, rows[3][1]), (3, rows[3][1])]
    rows.append((507, " ".join(f"v{i % 977}" for i in range(5000))))  # one long run
    rows.append((508, "z " * 3000))
    docs = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], "doc_id long, text string, start int, runs int, row string")
    got = answer(op.periodic_runs(docs.repartition(5), tile_words=tile_words))
    assert got == sorted((expected(i, t) for i, t in rows), key=repr)


def test_empty_table(spark):
    assert op.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
