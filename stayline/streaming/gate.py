"""File gate.

Every landed file gets one verdict row (key, status, reason):

* SKIPPED  - the file does not belong to a tracked table;
* REJECTED - could not be read; empty file / no header; missing required
  columns (listed, sorted; the check is case-sensitive); or a header with
  nothing after it;
* ACCEPTED - otherwise ("<n> columns, sample OK").

Keys under ``quarantine/`` never get a row. A key is the file's path below
the landing root; its table key is the first path component, so both a
single ``encounters.csv`` object and a ``encounters.csv/`` directory of
part files belong to the tracked table ``encounters.csv``.

The root may be a plain path or a URI of any file system Spark reads. Files
are listed by the binaryFile source with its content column pruned. Where
Arrow knows the file system, tasks read each file just up to the line after
its first CSV record (a record may hold quoted line breaks and be of any
length). Elsewhere Spark's text reader supplies the lines: right for every
file system, but it reads whole files. Zero-length files are not listed by
Spark file sources, so tracked tables are checked against an expected-table
list to report a table with no readable file.
"""

from __future__ import annotations

import re
from itertools import islice

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.schemas import REQUIRED_COLUMNS

QUARANTINE = "quarantine/"
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
VERDICT_COLUMNS = ["key", "status", "reason"]
HEAD_SCHEMA = "path string, header array<string>, has_data boolean, error string"
#: file systems Arrow opens, by Hadoop scheme
ARROW_SCHEMES = {"": "file", "file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs"}
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):(//[^/]*)?"


def _required_map() -> F.Column:
    items = []
    for k, cols in REQUIRED_COLUMNS.items():
        items += [F.lit(k), F.array(*[F.lit(c) for c in sorted(cols)])]
    return F.create_map(*items)


def _rel_key(path: F.Column, root: str) -> F.Column:
    """Path below the root; scheme and authority of both are left out."""
    base = re.sub(r"^/+", "/", re.sub(SCHEME, "", root)).rstrip("/") + "/"
    rel = F.regexp_replace(F.regexp_replace(path, SCHEME, ""), r"^/+", "/")
    if base.startswith("/"):
        return F.when(F.startswith(rel, F.lit(base)), F.substring(rel, len(base) + 1, 1 << 30)).otherwise(rel)
    # a relative root: the path below it follows its only or first mention
    return F.when(F.contains(rel, F.lit("/" + base)), F.substring_index(rel, "/" + base, -1)).otherwise(rel)


def listing(spark: SparkSession, root: str, stream: bool = False, times: bool = False,
            max_files: int | None = None) -> DataFrame:
    """Every file below ``root`` as (path, length), with ``times`` also
    modificationTime; file content is not read (binaryFile prunes the content
    column)."""
    r = spark.readStream.schema(BINARY_FILE_SCHEMA) if stream else spark.read
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return (r.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length", *(["modificationTime"] if times else [])))


def _arrow_reader():
    """Made here so that it is shipped to the workers by value: they need no
    copy of this package."""
    schemes, pattern = ARROW_SCHEMES, SCHEME

    def read_heads(batches):
        import csv
        import io
        import re
        import sys
        from urllib.parse import quote

        import pandas as pd
        import pyarrow.fs as pafs

        csv.field_size_limit(sys.maxsize)
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    m = re.match(pattern, path)
                    scheme = schemes[m[1] if m else ""]
                    rest = path[m.end():] if m else path
                    host = (m[2] or "//") if m else "//"
                    fs, p = pafs.FileSystem.from_uri(f"{scheme}:{host}{quote(rest)}")
                    with fs.open_input_stream(p, compression=None) as f:
                        text = io.TextIOWrapper(f, encoding="utf-8-sig", errors="replace", newline="")
                        header = next(csv.reader(text), [])
                        more = next(text, None) is not None
                    out.append((path, header, more, None))
                except Exception as e:  # noqa: BLE001  the verdict of this file, not of the job
                    out.append((path, None, False, f"{type(e).__name__}: {e}"[:300]))
            yield pd.DataFrame(out, columns=["path", "header", "has_data", "error"])
    return read_heads


def _line_reader():
    """Heads from lines in file order (path, value): the first CSV record and
    whether a line follows."""
    def read_heads(batches):
        import csv
        import sys

        import pandas as pd

        csv.field_size_limit(sys.maxsize)
        path, lines, quotes, closed, done = None, [], 0, False, True

        def row():
            return (path, next(csv.reader(lines), []), closed and done, None)

        for pdf in batches:
            out = []
            for p, value in zip(pdf["path"], pdf["value"]):
                if p != path:
                    if path is not None:
                        out.append(row())
                    path, lines, quotes, closed, done = p, [], 0, False, False
                    value = value.removeprefix("﻿")
                if done:
                    continue
                if closed:
                    done = True
                    continue
                lines.append(value + "\n")
                quotes += value.count('"')
                closed = quotes % 2 == 0
            if out:
                yield pd.DataFrame(out, columns=["path", "header", "has_data", "error"])
        if path is not None:
            yield pd.DataFrame([row()], columns=["path", "header", "has_data", "error"])
    return read_heads


def _scheme(root: str) -> str:
    m = re.match(SCHEME, root)
    return m[1] if m else ""


def _line_heads(lines: DataFrame) -> DataFrame:
    """Heads from text lines with their file; every file's first split starts
    at 0 and lies in one task, in order."""
    return (lines.where("_metadata.file_block_start = 0")
            .select(F.url_decode("_metadata.file_path").alias("path"), "value").mapInPandas(_line_reader(), HEAD_SCHEMA))


def _named_heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Heads of the named files by Spark's text reader, written once. Files the
    reader fails on are found by halving and get its error."""
    try:
        heads = materialize(_line_heads(spark.read.text([_glob_literal(p) for p in paths])))
    except Exception as e:  # noqa: BLE001  the verdict of a file, not of the job
        if len(paths) == 1:
            error = f"{type(e).__name__}: {e}".split("\n")[0][:300]
            return spark.createDataFrame([(paths[0], None, False, error)], HEAD_SCHEMA)
        half = len(paths) // 2
        return _named_heads(spark, paths[:half]).unionByName(_named_heads(spark, paths[half:]))
    named = spark.createDataFrame([(p,) for p in paths], "path string")
    empty = named.select("path", F.regexp_replace(F.regexp_replace("path", SCHEME, ""), "^/+", "/").alias("p")).join(
        heads.select(F.regexp_replace(F.regexp_replace("path", SCHEME, ""), "^/+", "/").alias("p")), "p", "left_anti")
    return heads.unionByName(empty.select("path", F.array().cast("array<string>").alias("header"),
                                          F.lit(False).alias("has_data"), F.lit(None).cast("string").alias("error")))


def _by_lines(files: DataFrame, slice_files: int = 1000) -> DataFrame | None:
    """Heads of the listed files by Spark's text reader, in slices of names."""
    out, names = None, (r["path"] for r in files.select("path").toLocalIterator())
    while paths := list(islice(names, slice_files)):
        part = _named_heads(files.sparkSession, paths)
        out = part if out is None else out.unionByName(part)
    return out


def file_heads(files: DataFrame, root: str, named: bool = False) -> DataFrame:
    """Per file: key (path below ``root``), header fields, whether a line
    follows the header, and why the file could not be read. Work is spread
    over tasks by the listing's partitions.

    Where Arrow knows the file system, it reads the heads; on object stores and
    HDFS, files it cannot open (it does not see Hadoop's credentials) are tried
    again with Spark's text reader. Elsewhere the text reader reads all of
    ``root``, or just the listed files (``named``: a stream's batch)."""
    scheme = _scheme(root)
    if scheme in ARROW_SCHEMES:
        heads = files.select("path").mapInPandas(_arrow_reader(), HEAD_SCHEMA)
        if ARROW_SCHEMES[scheme] != "file":
            heads = materialize(heads)
            again = _by_lines(heads.where("error is not null"))
            if again is not None:
                heads = heads.where("error is null").unionByName(again)
    elif named:
        heads = _by_lines(files)
        if heads is None:
            heads = files.sparkSession.createDataFrame([], HEAD_SCHEMA)
    else:
        heads = _line_heads(files.sparkSession.read.option("recursiveFileLookup", "true").text(root))
    return heads.select(_rel_key(F.col("path"), root).alias("key"), "header", "has_data", "error")


def verdicts(heads: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """The decision ladder over per-file heads (key, header, has_data, error)."""
    h = heads.filter(~F.startswith(F.col("key"), F.lit(QUARANTINE)))
    h = h.withColumn("table_key", F.split(F.col("key"), "/").getItem(0))
    required = _required_map()[F.col("table_key")]
    missing = F.array_sort(F.array_except(required, F.col("header")))
    ladder = [
        (required.isNull(), "SKIPPED", F.lit("not a tracked file")),
        (F.col("error").isNotNull(), "REJECTED", F.concat(F.lit("could not read: "), F.col("error"))),
        (F.col("header").isNull() | (F.size("header") == 0), "REJECTED", F.lit("empty file, no header")),
        (F.size(missing) > 0, "REJECTED",
         F.concat(F.lit("missing columns: ["), F.array_join(missing, ", "), F.lit("]"))),
        (~F.col("has_data"), "REJECTED", F.lit("header present but no data rows")),
        (F.lit(True), "ACCEPTED", F.concat(F.size("header").cast("string"), F.lit(" columns, sample OK"))),
    ]
    verdict = F.coalesce(*[F.when(c, F.struct(F.lit(s).alias("status"), r.alias("reason"))) for c, s, r in ladder])
    out = h.select("key", "table_key", verdict.alias("v")).select("key", "table_key", "v.status", "v.reason")
    if expected is not None:
        out = out.unionByName(missing_tables(out, expected))
    return out.select(*VERDICT_COLUMNS)


def missing_tables(results: DataFrame, expected: list[str]) -> DataFrame:
    """A REJECTED row for every expected table that has no row in ``results``
    (verdicts of a batch, or the audit of a stream so far)."""
    spark = results.sparkSession
    exp = spark.createDataFrame([(k,) for k in expected], "table_key string")
    seen = results.select(F.split("key", "/").getItem(0).alias("table_key")).distinct()
    return exp.join(seen, "table_key", "left_anti").select(
        F.col("table_key").alias("key"), "table_key",
        F.lit("REJECTED").alias("status"), F.lit("empty file, no header").alias("reason"))


def gate_batch(spark: SparkSession, root: str, expected: list[str] | None = None) -> DataFrame:
    """Q13 over everything currently under ``root``."""
    return verdicts(file_heads(listing(spark, root), root), expected)


def _remover(root: str):
    def remove(batches):
        import re
        from urllib.parse import quote

        import pandas as pd
        import pyarrow.fs as pafs

        for pdf in batches:
            for key in pdf["key"]:
                m = re.match(SCHEME, root)
                rest = (root[m.end():] if m else root).rstrip("/") + "/" + key
                scheme = ARROW_SCHEMES[m[1] if m else ""]
                fs, p = pafs.FileSystem.from_uri(f"{scheme}:{(m[2] or '//') if m else '//'}{quote(rest)}")
                if fs.get_file_info(p).type != pafs.FileType.NotFound:
                    fs.delete_file(p)
            yield pd.DataFrame({"key": pdf["key"]})
    return remove


def _hadoop_remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete through Spark's own file systems, for those Arrow lacks."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, False)


MANIFEST_SCHEMA = "key string, length bigint, landed timestamp"


def _manifest(spark: SparkSession, dest: str) -> DataFrame:
    """Files whose copy is complete (key, length, time of landing)."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{dest.rstrip('/')}/_manifest")
    except AnalysisException:  # nothing was ever quarantined there
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def quarantine(spark: SparkSession, root: str, results: DataFrame, dest: str, remove: bool = False,
               slice_files: int = 1000) -> DataFrame:
    """K2: move rejected files out of the landing area, in two committed phases.

    1. Copy: the lines of the rejected files go to ``dest`` (partitioned
       by the file key, with the reason); after that one manifest row per file
       (key, length, time of landing) commits the copy.
    2. With ``remove``, files that have a manifest row are deleted from
       landing. Without, they stay and :func:`accepted_paths` leaves them out
       downstream.

    Only the rejected files are read, in slices of ``slice_files`` names, so
    the driver never holds them all. Restartable at any point: an uncommitted
    copy is made again over the same partitions, a committed one is only
    removed; a new file under an old name is copied anew. Returns the lines
    (value, reason, key)."""
    rej = results.filter(F.col("status") == "REJECTED").select("key", "reason").dropDuplicates(["key"])
    base, dest = root.rstrip("/"), dest.rstrip("/")
    files = listing(spark, root, times=True).select(_rel_key(F.col("path"), root).alias("key"), "length",
                                                    F.col("modificationTime").alias("landed"))
    # rejected keys that are files (an absent table has none)
    held = materialize(files.join(rej, "key"))
    todo = materialize(held.join(_manifest(spark, dest), ["key", "length", "landed"], "left_anti"))
    names = (r["key"] for r in todo.select("key").toLocalIterator())
    while keys := list(islice(names, slice_files)):
        part = spark.createDataFrame([(k,) for k in keys], "key string")
        lines = spark.read.text([_glob_literal(f"{base}/{k}") for k in keys]).select(
            _rel_key(F.url_decode("_metadata.file_path"), root).alias("key"), "value")
        (lines.join(rej.join(part, "key", "left_semi"), "key").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("key").parquet(dest))
        (todo.join(part, "key", "left_semi").select("key", "length", "landed")
         .write.mode("append").parquet(f"{dest}/_manifest"))
    if remove:
        gone = held.join(_manifest(spark, dest), ["key", "length", "landed"], "left_semi").select("key").distinct()
        if _scheme(root) in ARROW_SCHEMES:
            gone.mapInPandas(_remover(root), "key string").write.format("noop").mode("overwrite").save()
        else:
            names = (r["key"] for r in gone.toLocalIterator())
            while keys := list(islice(names, slice_files)):
                _hadoop_remove(spark, [f"{base}/{k}" for k in keys])
    return quarantined(spark, dest)


def quarantined(spark: SparkSession, dest: str) -> DataFrame:
    try:
        return spark.read.schema("value string, reason string, key string").parquet(dest)
    except AnalysisException:  # nothing was ever quarantined there
        return spark.createDataFrame([], "value string, reason string, key string")


def _glob_literal(path: str) -> str:
    """A path whose glob signs stand for themselves."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def accepted_paths(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == "ACCEPTED").select("key")


def gate_stream(spark: SparkSession, root: str, audit: str, checkpoint: str,
                available_now: bool = True, interval: str = "1 minute", max_files: int = 10_000,
                expected: list[str] | None = None, wait_seconds: int = 3600):
    """Validate files as they arrive. The listing is a Structured Streaming
    file source (each new file once, tracked in the checkpoint, at most
    ``max_files`` a batch). Each batch's verdicts replace the partition of its
    batch id in the audit dataset, so a batch that is replayed after a failure
    leaves the same rows, and the heads are read as in :func:`gate_batch`: on
    every file system Spark reads.

    ``available_now`` runs what has landed and stops; otherwise the query keeps
    running on ``interval`` and is returned. With ``expected`` tables a running
    gate also starts :func:`arrivals`, whose rows join the same audit, and both
    queries are returned."""
    def judge(batch: DataFrame, no: int) -> None:
        _commit(verdicts(file_heads(batch, root, named=True)), audit, "gate", no)

    files = listing(spark, root, stream=True, max_files=max_files)
    w = files.writeStream.foreachBatch(judge).option("checkpointLocation", checkpoint)
    if available_now:
        w.trigger(availableNow=True).start().awaitTermination()
        return None
    gate = w.trigger(processingTime=interval).start()
    if expected is None:
        return gate
    return gate, arrivals(spark, root, audit, f"{checkpoint.rstrip('/')}-arrivals", expected, wait_seconds, interval)


def _commit(rows: DataFrame, audit: str, source: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{audit.rstrip('/')}/source={source}/batch={batch}")


def _arrival_step(wait_ms: int):
    """One table's state (arrived, reported): reported missing once when its
    timer ends, cleared once when it lands after that."""
    def step(key, batches, state):
        import pandas as pd

        landed = any((~pdf["seed"]).any() for pdf in batches)
        arrived, reported = state.get if state.exists else (False, False)
        said = None
        if state.hasTimedOut:
            if not arrived and not reported:
                said, reported = ("REJECTED", "empty file, no header"), True
            state.update((arrived, reported))
        elif landed or arrived:
            if reported:
                said = ("ARRIVED", "landed after it was reported missing")
            state.update((True, False))
        else:
            state.update((False, reported))
            if not reported:
                state.setTimeoutDuration(wait_ms)
        rows = [(key[0], *said)] if said else []
        yield pd.DataFrame(rows, columns=VERDICT_COLUMNS)
    return step


def arrivals(spark: SparkSession, root: str, audit: str, checkpoint: str, expected: list[str],
             wait_seconds: int, interval: str = "1 minute"):
    """S12 on a stream: every expected table has a timer from the start of the
    stream. A table without a file when it ends gets one REJECTED row; if it
    lands later, one ARRIVED row clears it. State and timers are Spark's
    (``applyInPandasWithState``); the expected tables enter as a second stream,
    read once from a seed file beside the checkpoint. The running query is
    returned; its rows go to the audit by batch id."""
    seeds = f"{checkpoint.rstrip('/')}-expected"
    spark.createDataFrame([(k,) for k in expected], "table_key string").coalesce(1).write.mode("ignore").parquet(seeds)
    seed = spark.readStream.schema("table_key string").parquet(seeds).select("table_key", F.lit(True).alias("seed"))
    key = _rel_key(F.col("path"), root)
    landed = listing(spark, root, stream=True).where(~F.startswith(key, F.lit(QUARANTINE))).select(
        F.split(key, "/").getItem(0).alias("table_key"), F.lit(False).alias("seed"))
    landed = landed.where(F.col("table_key").isin(list(expected)))
    said = seed.unionByName(landed).groupBy("table_key").applyInPandasWithState(
        _arrival_step(wait_seconds * 1000), "key string, status string, reason string",
        "arrived boolean, reported boolean", "append", "ProcessingTimeTimeout")
    return (said.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, no: _commit(batch, audit, "arrivals", no))
            .trigger(processingTime=interval).start())
