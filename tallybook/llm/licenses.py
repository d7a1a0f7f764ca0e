"""Licence scan in DataFrame operations: sparse TF-IDF cosine to templates, then inheritance from the nearest directory.

A file's statements are its lines that hold a licence cue; of a file that is named as a licence file the whole text is
one more statement. Statements and templates are sparse vectors of their words, ``tf * ln(1 + (1 + N) / (1 + df))``, where
``df`` counts the statements of all files that hold the word, and ``N`` all statements. A statement is compared with the templates
through a join on words, and takes the best template at a cosine of ``least`` or more. A file takes the best of its statements.

A file without a licence of its own inherits: every directory knows the licence of its licence file (the best, then the
first path), and each directory looks itself and its ancestors up by path joins, the nearest first. Directories are
resolved once each, not for each file.

Equal statements are compared once, however many files hold them, so a line that a third of all files share is one row
of the comparison. Defined cases: null, empty and long texts are all read whole (null has no statement); a null path lies in no
directory and inherits nothing; ties go to the template that sorts first; repeated rows are answered one by one; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.llm.tables import stored

LEAST = 0.5

# Short public licence notices, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
)
CUE = r"(?i)licen[sc]e|copyright|spdx|public domain|redistribution|(?:^|\W)(?:mit|gpl|bsd|cc by)(?:\W|$)"
NAMED = r"(?i)^(?:un)?licen[sc]e|^copying|^notice"


def scan(files: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, path, license, score, origin (own, inherited or none), from_path for each row of ``files`` (doc_id, path, text)."""
    path = F.col("path").cast("string")
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.transform(F.split(text, "\n"), F.trim), lambda x: x.rlike(CUE))
    whole = F.when(name.rlike(NAMED), F.array(F.trim(text))).otherwise(F.array().cast("array<string>"))
    rows = files.select(
        F.col("doc_id"), path.alias("path"), F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("folder"), name.rlike(NAMED).alias("named"),
        F.filter(F.array_distinct(F.concat(lines, whole)), lambda x: x != "").alias("statements"),
    )
    # A statement travels once with its text; everywhere else its digest stands for it.
    rows = stored(rows.withColumn("keys", F.transform("statements", lambda x: F.unhex(F.md5(x)))), "license-statements")
    best = stored(_matches(rows, least), "license-matches")
    own = _owned(rows, best)
    return _inherited(stored(own, "license-own"))


def _terms(text: Column) -> Column:
    return F.filter(F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}.]+"), lambda x: F.trim(x, F.lit("."))), lambda x: x != "")


def _matches(rows: DataFrame, least: float) -> DataFrame:
    """key, license, score of each distinct statement that is near enough to a template."""
    spark = rows.sparkSession
    said = rows.select(F.explode(F.arrays_zip("keys", "statements")).alias("s")).select("s.keys", "s.statements").toDF("key", "statement")
    held = said.groupBy("key").agg(F.count(F.lit(1)).alias("files"), F.first("statement").alias("statement"))
    # Still partitioned by the digest, so counting the words of a statement needs no exchange.
    words = held.select("key", "files", F.explode(_terms(F.col("statement"))).alias("term")).groupBy("key", "files", "term").agg(F.count(F.lit(1)).alias("tf"))
    words = stored(words, "license-terms")
    total = said.agg(F.count(F.lit(1)).alias("total"))
    idf = (
        words.groupBy("term").agg(F.sum("files").alias("df")).crossJoin(F.broadcast(total))  # one row
        .select("term", F.log((1 + F.col("total")) / (1 + F.col("df")) + 1).alias("idf"))
    )
    unseen = total.select(F.log(F.col("total") + 2).alias("unseen"))
    templates = spark.createDataFrame(list(TEMPLATES), "license string, notice string")
    templates = templates.select("license", F.explode(_terms(F.col("notice"))).alias("term")).groupBy("license", "term").agg(F.count(F.lit(1)).alias("tf"))
    templates = templates.join(idf, "term", "left").crossJoin(F.broadcast(unseen))  # one row
    templates = templates.select("license", "term", (F.col("tf") * F.coalesce("idf", "unseen", F.lit(1.0))).alias("tw"))
    templates = templates.withColumn("tn", F.sqrt(F.sum(F.col("tw") * F.col("tw")).over(W.partitionBy("license"))))
    weighted = words.join(idf, "term").select("key", "term", (F.col("tf") * F.col("idf")).alias("sw"))
    norms = weighted.groupBy("key").agg(F.sqrt(F.sum(F.col("sw") * F.col("sw"))).alias("sn"))
    # The templates are a fixed list of a few hundred words.
    dots = weighted.join(F.broadcast(templates), "term").groupBy("key", "license").agg(F.sum(F.col("sw") * F.col("tw")).alias("dot"), F.max("tn").alias("tn"))
    scores = dots.join(norms, "key").withColumn("score", F.round(F.col("dot") / (F.col("tn") * F.col("sn")), 9)).where(F.col("score") >= least)
    pick = F.min(F.struct((-F.col("score")).alias("down"), F.col("license")))
    return scores.groupBy("key").agg(pick.alias("v")).select("key", "v.license", (-F.col("v.down")).alias("score"))


def _owned(rows: DataFrame, best: DataFrame) -> DataFrame:
    """The rows with their own licence and score, null for none."""
    numbered = rows.withColumn("row", F.xxhash64("doc_id", "path", "keys"))
    pairs = numbered.select("row", F.explode("keys").alias("key")).distinct().join(best, "key")
    pick = F.min(F.struct((-F.col("score")).alias("down"), F.col("license")))
    found = pairs.groupBy("row").agg(pick.alias("v")).select("row", F.col("v.license").alias("license"), (-F.col("v.down")).alias("score"))
    return numbered.join(found, "row", "left").select("doc_id", "path", "folder", "named", "license", "score")


def _inherited(own: DataFrame) -> DataFrame:
    pick = F.min(F.struct((-F.col("score")).alias("down"), F.col("path"), F.col("license")))
    licensed = own.where("named AND license IS NOT NULL AND path IS NOT NULL").groupBy("folder").agg(pick.alias("v"))
    licensed = licensed.select(F.col("folder").alias("ancestor"), F.col("v.license").alias("their_license"), (-F.col("v.down")).alias("their_score"), F.col("v.path").alias("their_path"))
    parts = F.split("folder", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("ancestor")))
    folders = own.where("path IS NOT NULL").select("folder").distinct()
    above = folders.select("folder", F.explode(ancestors).alias("a")).select("folder", "a.depth", "a.ancestor").distinct().join(licensed, "ancestor")
    nearest = above.groupBy("folder").agg(F.max_by(F.struct("their_license", "their_score", "their_path"), "depth").alias("near"))
    out = own.join(nearest, "folder", "left")
    takes = F.col("license").isNull() & F.col("path").isNotNull() & F.col("near").isNotNull()
    return out.select(
        "doc_id", "path", F.when(takes, F.col("near.their_license")).otherwise(F.col("license")).alias("license"),
        F.when(takes, F.col("near.their_score")).otherwise(F.col("score")).alias("score"),
        F.when(F.col("license").isNotNull(), "own").when(takes, "inherited").otherwise("none").alias("origin"),
        F.when(F.col("license").isNotNull(), F.col("path")).when(takes, F.col("near.their_path")).alias("from_path"),
    )


def with_paths(docs: DataFrame) -> DataFrame:
    """doc_id, path, text of ``documents``, which has no paths: a document lies in the folder ``source/lang``.

    The first document with a licence cue is the LICENSE of each such folder, and the first of each source that of ``source``.
    """
    cue = docs.where(F.col("text").rlike(CUE) & F.col("source").isNotNull())
    first = cue.groupBy("source", "lang").agg(F.min("doc_id").alias("first"))
    sources = first.groupBy("source").agg(F.min("first").alias("top"))
    named = first.join(sources, "source").select("source", "lang", F.col("first"), F.col("top"))
    lang = F.coalesce(F.col("d.lang"), F.lit("none"))
    joined = docs.alias("d").join(named.alias("n"), F.col("d.source").eqNullSafe(F.col("n.source")) & F.col("d.lang").eqNullSafe(F.col("n.lang")), "left")
    path = (
        F.when(F.col("d.doc_id") == F.col("n.top"), F.concat(F.col("d.source"), F.lit("/LICENSE")))
        .when(F.col("d.doc_id") == F.col("n.first"), F.concat_ws("/", F.col("d.source"), lang, F.lit("LICENSE")))
        .otherwise(F.concat(F.col("d.source"), F.lit("/"), lang, F.lit("/"), F.col("d.doc_id").cast("string")))
    )
    return joined.select(F.col("d.doc_id").alias("doc_id"), path.alias("path"), F.col("d.text").alias("text"))
