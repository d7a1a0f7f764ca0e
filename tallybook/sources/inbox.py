"""Statement files in an inbox of one folder for each profile, read once for each content.

Work on a batch of files:

1. fingerprint every file (``file_contents``) and drop contents already in the registry;
2. read the lines of all files with one scan, and bring the fields of each to their roles (``read_statements``);
3. tag with profile, file and fingerprint.

Only file names and sizes of one batch reach the driver; a stream bounds them with ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import csv
import posixpath
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.operators.canonicalize import canonical_rows, canonicalize, role_columns
from tallybook.schemas import BRONZE, ROLE_ALIASES

_LINE_DIGEST_PARTS = 4


def describe_files(files: DataFrame) -> DataFrame:
    """path, uri (as readers report it for a row) and length of binaryFile rows; contents are not read."""
    return files.select("path", F.col("_metadata.file_path").alias("uri"), "length")


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """The CSV files under the paths."""
    return describe_files(
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(list(paths))
    )


def _literal(path: str) -> str:
    """Path with glob characters escaped, so that ``statement[1].csv`` names itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def line_digests(lines: DataFrame, by: str, *more: Column) -> DataFrame:
    """Fingerprint of the lines of each ``by``, whatever their order: count and sums over pieces of SHA-256s.

    Sums split and merge freely, so one file of any size is fingerprinted by as many tasks as it has splits
    and only sums are shuffled. Two files with equal lines in another order count as equal content; they
    hold the same transactions. ``more`` are further named aggregates, taken in the same pass.
    """
    digest = F.sha2(F.col("value").cast("binary"), 256)
    pieces = [
        F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")
        for i in range(_LINE_DIGEST_PARTS)
    ]
    sums = [F.sum(p).alias(f"s{i}") for i, p in enumerate(pieces)]
    text = F.concat_ws("-", "n", *[f"s{i}" for i in range(_LINE_DIGEST_PARTS)])
    return (
        lines.groupBy(by).agg(F.count("*").alias("n"), *sums, *more)
        .withColumn("sha256", F.sha2(text, 256)).drop("n", *[f"s{i}" for i in range(_LINE_DIGEST_PARTS)])
    )


def file_contents(spark: SparkSession, files: list[Row]) -> DataFrame:
    """profile_id, file, path, uri, length, sha256, header line, and whether records run over lines, of files with path, uri and length.

    One pass over the lines of all files, whatever their size. The header is the first line that is not blank, as
    written, however far down it stands; it is NULL for a file of blank lines. A file without any line is left out.
    """
    files = list({f.uri: f for f in files}.values())  # a path named twice would be read twice
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text([_literal(f.path) for f in files]).select(
        F.col("_metadata.file_path").alias("uri"), "value", place.alias("place")
    )
    # Lines of one block are numbered in their order, and rows without a place are passed over by the minimum.
    header = F.min_by("value", F.when(F.col("value").rlike(r"[^\s\x{FEFF}]"), F.col("place"))).alias("header")
    named = [
        (posixpath.basename(posixpath.dirname(f.path)), posixpath.basename(f.path), f.path, f.uri, f.length)
        for f in files
    ]
    listing = spark.createDataFrame(
        named, "profile_id string, file string, path string, uri string, length long"
    )
    # A line with an odd number of quotes opens a field that goes on in the next line.
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # As a set, since Spark then keeps a buffer for each file. With a maximum all lines would be sorted by file, for the header's sake.
    broken = F.array_contains(F.collect_set(quotes % 2 == 1), True).alias("broken_lines")
    return listing.join(line_digests(lines, "uri", header, broken), "uri")


def first_of_each_content(files: DataFrame) -> DataFrame:
    """One file for each content of a profile, the first by name and path. Copies are cut before they are shuffled."""
    order = Window.partitionBy("profile_id", "sha256").orderBy("file", *[c for c in ("path",) if c in files.columns])
    return files.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def new_contents(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Files whose content the registry does not know for their profile, one for each content."""
    known = registry.select("profile_id", "sha256")
    return first_of_each_content(files).join(known, ["profile_id", "sha256"], "left_anti")


def header_names(line: str) -> list[str]:
    """Column names of a header line, as Spark's CSV reader gives them: names that occur again get their position."""
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    uses = Counter(n.lower() for n in names)
    return [f"{n}{i}" if n and uses[n.lower()] > 1 else n or f"_c{i}" for i, n in enumerate(names)]


#: Roles of a statement's columns, with the type of a table that says in which field of a file each stands.
_ROLES = tuple(ROLE_ALIASES)
_FIELDS = T.StructType([
    T.StructField("uri", T.StringType()),
    T.StructField("header", T.StringType()),
    *[T.StructField(f"at_{role}", T.IntegerType()) for role in _ROLES],
])


def read_statements(spark: SparkSession, files: list[Row]) -> DataFrame | None:
    """Bronze rows (without ingest_batch) of files from ``file_contents``; None if no file holds a table.

    One text scan for all files of the batch, whatever their layouts: a table of the files says which field of a line holds which
    role, so a batch of two hundred layouts is one small plan. Files with a quoted field that runs over several lines go to the
    CSV reader, one scan for each layout of these. Text keeps account numbers and codes as written.
    """
    tables = [f for f in files if f.header]
    if not tables:
        return None
    plain = [f for f in tables if not f.broken_lines]
    scans = [_by_lines(spark, plain)] if plain else []
    scans += _by_layout(spark, [f for f in tables if f.broken_lines])
    # A name and a hash for each file of the batch: bounded by the batch, so small enough for every task.
    tags = spark.createDataFrame(
        [(f.uri, f.file, f.sha256, f.profile_id) for f in files],
        "__uri string, source_file string, source_sha256 string, profile_id string",
    )
    tagged = reduce(DataFrame.unionByName, scans).join(F.broadcast(tags), "__uri")
    return tagged.select(*[c for c in BRONZE.names if c != "ingest_batch"])


def _by_lines(spark: SparkSession, files: list[Row]) -> DataFrame:
    """A record for each line that is neither blank nor its file's header."""
    places, width = [], 1
    for f in files:
        names = header_names(f.header)
        roles = role_columns(names)
        places.append((f.uri, f.header, *[names.index(roles[r]) if r in roles else None for r in _ROLES]))
        width = max(width, len(names))
    lines = spark.read.text([_literal(f.path) for f in files]).select(F.col("_metadata.file_path").alias("uri"), "value")
    # One row for each file of the batch.
    placed = lines.filter(F.trim("value") != "").join(F.broadcast(spark.createDataFrame(places, _FIELDS)), "uri").filter("value <> header")
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"mode": "PERMISSIVE"})
    cells = placed.select("uri", *[f"at_{r}" for r in _ROLES], fields.alias("f"))
    cells = cells.withColumn("cells", F.array(*[F.col(f"f.c{i}") for i in range(width)]))
    texts = cells.select(F.col("uri").alias("__uri"), F.col("at_amount").isNotNull().alias("__one_amount"), *[F.get("cells", F.col(f"at_{r}")).alias(r) for r in _ROLES])
    return canonical_rows(texts, F.col("__one_amount"), ("__uri",))


def _by_layout(spark: SparkSession, files: list[Row]) -> list[DataFrame]:
    layouts: dict[str, list[Row]] = {}
    for f in files:
        layouts.setdefault(f.header, []).append(f)
    scans = []
    for members in layouts.values():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header_names(members[0].header)])
        reader = spark.read.schema(schema).option("header", True).option("multiLine", True)
        rows = reader.csv([_literal(m.path) for m in members])
        scans.append(canonicalize(rows.withColumn("__uri", F.col("_metadata.file_path")), keep=("__uri",), with_unread=True))
    return scans
