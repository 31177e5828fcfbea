"""Very many tiny JSON-lines files consolidated into few well-sized ones, each readable record exactly once.

Files are assigned to a fixed number of output groups by balanced longest-first scheduling: the largest next, to the group
with the least load, kept in a heap. What is scheduled are cells: a file of at least a CELLS-th of a group is a cell of its
own, smaller ones share cells by hash, CELLS a group. So the heap holds at most 2 x CELLS entries a group, however many
files there are, and the same rule holds for any number. Lines are parsed where the files are read; only their digests are
shuffled to find repeats. Then each file's body moves once, together with the numbers of its lines that are left out, to the
task of its group, which streams the group through pyarrow into one file of a folder of this run. The manifest is verified,
files that it doesn't name (of lost or repeated tasks) are deleted, and it is published by one rename.

Lines end with a line feed, with or without a carriage return; a byte-order mark before the first line belongs to no
record. A line is `broken` unless it is one complete JSON object; it is a `repeat` if it parses to the same fields and
values as an earlier line of any file, by file_id, then line number. Numbers are equal by value (1.0 and 1, -94.980 and
-94.98), texts by their characters after unescaping; the order of fields and white space don't count.

Defined cases: null and empty bodies have no lines; blank lines are numbered but are no records; NaN and Infinity are not
JSON; of a field given twice in one object the last counts; an empty table gives an empty manifest; a file that is
given twice is written once, and its lines are reported each time; files without id are named by a negative number made
from their body. Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roomweave.functions.skew import skew_left_join
from roomweave.session import durable

#: Cells of small files a group.
CELLS = 32
#: Up to so many cells are sent to all tasks; more are joined by a shuffle.
SENT_CELLS = 200_000
TARGET_BYTES = 128 << 20
RECORD_SCHEMA = pa.schema([("file_id", pa.int64()), ("line_no", pa.int32()), ("record", pa.string())])


# -- lines -------------------------------------------------------------------------------------------------------------


def lines_of(body: str | None) -> Iterator[tuple[int, str]]:
    """(line number from 1, text) of each line that is not blank."""
    if not body:
        return
    for n, line in enumerate(body.removeprefix("﻿").split("\n"), 1):
        line = line.removesuffix("\r")
        if line.strip():
            yield n, line


class _Number(str):
    """A number by its value, which no text is equal to."""


def _number(text: str) -> str:
    mantissa, _, power = text.lower().partition("e")
    whole, _, part = mantissa.removeprefix("-").partition(".")
    digits = (whole + part).lstrip("0")
    kept = digits.rstrip("0")
    exponent = int(power or 0) - len(part) + len(digits) - len(kept)
    return _Number(f"{'-' * mantissa.startswith('-')}{kept}e{exponent}" if kept else "0")


def _refuse(text: str) -> None:
    raise ValueError(f"{text} is not JSON")


def _plain(x: object) -> object:
    if isinstance(x, _Number):
        return {"#": str(x)}  # written as an object of its own kind: real objects are written as lists of pairs
    if isinstance(x, dict):
        return [[k, _plain(v)] for k, v in sorted(x.items())]
    if isinstance(x, list):
        return {"[": [_plain(v) for v in x]}
    return x


_DECODER = json.JSONDecoder(parse_float=_number, parse_int=_number, parse_constant=_refuse)


def digest(line: str) -> str | None:
    """128 bits that name the record on this line by its fields and values; None if it is not one complete JSON object."""
    try:
        record = _DECODER.decode(line)
        if not isinstance(record, dict):
            return None
        return hashlib.blake2b(json.dumps(_plain(record), separators=(",", ":")).encode(), digest_size=16).hexdigest()
    except (ValueError, RecursionError, ArithmeticError):
        return None


# -- schedule ----------------------------------------------------------------------------------------------------------


def longest_first(sizes: list[tuple], groups: int) -> list[tuple]:
    """(*name, group) for (*name, size): largest first, each to the least-loaded group; ties go by name."""
    heap = [(0, g) for g in range(groups)]
    out = []
    for *name, size in sorted(sizes, key=lambda x: (-x[-1], x[:-1])):
        load, g = heapq.heappop(heap)
        out.append((*name, g))
        heapq.heappush(heap, (load + size, g))
    return out


def schedule(files: DataFrame, target_bytes: int = TARGET_BYTES) -> tuple[DataFrame, int]:
    """((file_id, body, out_group), number of groups) for files (file_id, body); sizes are taken from the bodies themselves."""
    named = F.coalesce(F.col("file_id").cast("bigint"), -1 - F.pmod(F.xxhash64("body"), F.lit(1 << 62)))
    bodies = files.select(named.alias("file_id"), "body")
    size = F.coalesce(F.octet_length("body"), F.lit(0)).cast("bigint")
    total = bodies.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    groups = max(1, -(-total // target_bytes))
    own = size * CELLS >= target_bytes
    of_cell = [own.alias("own"), F.when(own, F.col("file_id")).otherwise(F.pmod(F.xxhash64("file_id"), F.lit(groups * CELLS))).alias("id")]

    def assign(cells: pd.DataFrame) -> pd.DataFrame:
        made = longest_first(list(zip(cells["own"].tolist(), cells["id"].tolist(), cells["size"].tolist(), strict=True)), groups)
        return pd.DataFrame(made, columns=["own", "id", "out_group"])

    cells = bodies.select(*of_cell, size.alias("size")).groupBy("own", "id").agg(F.sum("size").alias("size"))  # at most 2 x CELLS a group
    plan = durable(cells.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(assign, "own boolean, id bigint, out_group int"))
    plan = F.broadcast(plan) if 2 * CELLS * groups <= SENT_CELLS else plan
    placed = bodies.select("file_id", "body", *of_cell).join(plan, ["own", "id"])
    return placed.select("file_id", "body", "out_group"), groups


# -- records -----------------------------------------------------------------------------------------------------------


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        files, numbers, names, groups = [], [], [], []
        for file, body, group in zip(*(batch.column(c).to_pylist() for c in ("file_id", "body", "out_group")), strict=True):
            for n, line in lines_of(body):
                files.append(file)
                numbers.append(n)
                names.append(digest(line))
                groups.append(group)
        yield pa.record_batch([pa.array(files, pa.int64()), pa.array(numbers, pa.int32()), pa.array(names, pa.string()), pa.array(groups, pa.int32())], ["file_id", "line_no", "digest", "out_group"])


def parsed_lines(placed: DataFrame) -> DataFrame:
    """(file_id, line_no, digest, out_group) of every line that is not blank; digest is null for broken lines."""
    return placed.select("file_id", "body", "out_group").mapInArrow(_parse, "file_id bigint, line_no int, digest string, out_group int")


def line_fates(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """(file_id, line_no, fate): `broken` and `repeat` lines, and `keep` for those that the output holds."""
    return _fates(schedule(files, target_bytes)[0]).drop("out_group", "digest")


def _fates(placed: DataFrame) -> DataFrame:
    lines = durable(parsed_lines(placed))
    place = F.struct("file_id", "line_no")
    several = durable(lines.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("digest", "first"))
    fate = F.when(F.col("digest").isNull(), "broken").when(F.col("first").isNotNull() & (F.col("first") != place), "repeat").otherwise("keep")
    return skew_left_join(lines, several, "digest").select("file_id", "line_no", "out_group", "digest", fate.alias("fate"))


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


# -- output ------------------------------------------------------------------------------------------------------------


def compact(spark: SparkSession, files: DataFrame, out_dir: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Write every readable record exactly once into `out_dir` and return its manifest.

    Manifest: (path, out_group, files, records, bytes). A lost or repeated task leaves at most an unlisted file behind,
    which is deleted: the manifest names the files of the tasks that counted, is checked against the number of records to
    be kept and, on the executors, against each file's own footer, and appears under its final name only by the last
    rename. A folder that has a manifest already is refused; a run that fails takes its files away.
    """
    uri = _uri(out_dir)
    fs, root = pafs.FileSystem.from_uri(uri)
    if fs.get_file_info(f"{root}/_manifest").type != pafs.FileType.NotFound:
        raise FileExistsError(f"{out_dir} has a manifest already")
    folder = f"data-{uuid.uuid4().hex}"
    fs.create_dir(f"{root}/{folder}", recursive=True)
    try:
        return _compact(spark, files, uri, fs, root, folder, target_bytes)
    except BaseException:
        fs.delete_dir(f"{root}/{folder}")
        raise


def _compact(spark: SparkSession, files: DataFrame, uri: str, fs: pafs.FileSystem, root: str, folder: str, target_bytes: int) -> DataFrame:
    placed, groups = schedule(files, target_bytes)
    fates = durable(_fates(placed))
    expected = fates.where(F.col("fate") == "keep").select("digest").distinct().count()
    # Each file's lines that are left out come right before its body: one exchange, no join.
    left_out = fates.where(F.col("fate") != "keep").groupBy("out_group", "file_id").agg(F.collect_list("line_no").alias("left_out"))  # at most the lines of one tiny file
    lists = left_out.select("out_group", "file_id", F.lit(0).alias("part"), F.lit(None).cast("string").alias("body"), "left_out")
    bodies = placed.select("out_group", "file_id", F.lit(1).alias("part"), "body", F.lit(None).cast("array<int>").alias("left_out"))
    moved = lists.unionByName(bodies).repartitionById(groups, "out_group").sortWithinPartitions("file_id", "part", "body")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink, group, name, n_files, n_records = None, None, f"group-{uuid.uuid4().hex}.parquet", 0, 0
        own = pafs.FileSystem.from_uri(uri)[0]
        skip: tuple = ("", set())
        last: tuple = ("", None)
        for batch in batches:
            rows = []
            for g, file, part, body, lines in zip(*(batch.column(c).to_pylist() for c in ("out_group", "file_id", "part", "body", "left_out")), strict=True):
                if part == 0:
                    skip = file, set(lines)
                    continue
                if (file, body) == last:
                    continue
                last = file, body
                kept = [(file, n, line) for n, line in lines_of(body) if not (file == skip[0] and n in skip[1])]
                group, n_files = g, n_files + bool(kept)
                rows += kept
            if rows:
                if sink is None:
                    sink = pq.ParquetWriter(f"{root}/{folder}/{name}", RECORD_SCHEMA, filesystem=own, compression="zstd")
                n_records += len(rows)
                sink.write_table(pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), RECORD_SCHEMA, strict=True)], schema=RECORD_SCHEMA))
        if sink:
            sink.close()
            size = own.get_file_info(f"{root}/{folder}/{name}").size
            yield pa.record_batch([pa.array([f"{folder}/{name}"]), pa.array([group], pa.int32()), pa.array([n_files], pa.int64()), pa.array([n_records], pa.int64()), pa.array([size], pa.int64())], ["path", "out_group", "files", "records", "bytes"])

    manifest = durable(moved.mapInArrow(write, "path string, out_group int, files bigint, records bigint, bytes bigint"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pafs.FileSystem.from_uri(uri)[0]
        for batch in batches:
            wrong = [p for p, n in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True) if pq.ParquetFile(own.open_input_file(f"{root}/{p}")).metadata.num_rows != n]
            yield pa.record_batch([pa.array(wrong, pa.string())], ["path"])

    wrong = manifest.select("path", "records").mapInArrow(differ, "path string").first()
    if wrong:
        raise RuntimeError(f"{wrong.path} doesn't hold the records that its task counted")
    made = manifest.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
    if made != expected:
        raise RuntimeError(f"{made} records were written instead of {expected}")
    listed = {r.path for r in manifest.select("path").toLocalIterator()}  # one a group
    for info in fs.get_file_info(pafs.FileSelector(f"{root}/{folder}")):
        if f"{folder}/{info.base_name}" not in listed:
            fs.delete_file(info.path)
    manifest.write.mode("overwrite").parquet(f"{uri}/_manifest.tmp")
    fs.move(f"{root}/_manifest.tmp", f"{root}/_manifest")
    return manifest


def read_compacted(spark: SparkSession, out_dir: str) -> DataFrame:
    """The records of a published manifest; rows of files that it doesn't name are left out."""
    uri = _uri(out_dir)
    manifest = spark.read.parquet(f"{uri}/_manifest")
    one = manifest.select("path").first()
    if one is None:
        return spark.createDataFrame([], "file_id bigint, line_no int, record string")
    folder = one.path.split("/")[0]
    records = spark.read.schema("file_id bigint, line_no int, record string").parquet(f"{uri}/{folder}").select("*", F.concat(F.lit(f"{folder}/"), F.col("_metadata.file_name")).alias("_path"))
    return records.join(manifest.select(F.col("path").alias("_path")), "_path", "left_semi").drop("_path")
