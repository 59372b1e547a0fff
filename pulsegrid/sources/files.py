"""File sources: landing JSON-Lines, layer tables, smartwatch CSV.

All reads use explicit schemas (no inference pass over the data), push
filters into the scan, and split files across tasks.
"""

from __future__ import annotations

import functools
import json
import threading
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid import schemas as S
from pulsegrid.operators.clean import unnest_envelope

# --- fixed values: cell texts a pandas CSV read treats as missing (its default na_values)
PANDAS_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def na_tokens_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Text cells spelling a missing value become null, as in a pandas CSV read."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*PANDAS_NA_TOKENS), F.col(f"`{c}`")) for c in cols})
LANDING_GLOB = "*.{json,jsonl}"
PARTITION_COLS = ["year", "month", "day", "hour", "minute"]


@functools.lru_cache(maxsize=2)
def _classes(sc) -> tuple:
    """Hadoop's Path and FileUtil, and Scala's Predef: each lookup by name is several calls."""
    fs = sc._jvm.org.apache.hadoop.fs
    return fs.Path, fs.FileUtil, sc._jvm.scala.Predef


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, Hadoop path) of a path."""
    sc = spark.sparkContext
    p = _classes(sc)[0](path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def side_by_side(fn, items: Iterable) -> list:
    """fn of each item, in order; many items share a few threads."""
    items = list(items)
    if len(items) < 32:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(fn, items))


_LIST_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_listing = {"readers": 0, "before": None, "lock": threading.Lock()}


@contextmanager
def few_list_tasks(spark: SparkSession) -> Iterator[None]:
    """Readers made inside list their folders in at most four tasks a core.
    Spark's own limit is a task for each folder, up to 10,000 of them, and
    starting these takes far longer than what each does. Threads may overlap:
    the last one to leave puts the session's value back."""
    with _listing["lock"]:
        if not _listing["readers"]:
            _listing["before"] = spark.conf.get(_LIST_TASKS)
            spark.conf.set(_LIST_TASKS, str(min(int(_listing["before"]), 4 * spark.sparkContext.defaultParallelism)))
        _listing["readers"] += 1
    try:
        yield
    finally:
        with _listing["lock"]:
            _listing["readers"] -= 1
            if not _listing["readers"]:
                spark.conf.set(_LIST_TASKS, _listing["before"])


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder (e.g. one table partition) if it exists."""
    fs, p = file_system(spark, path)
    return bool(fs.delete(p, True))


def delete_tree(spark: SparkSession, path: str) -> bool:
    """Remove a folder with many others below it: those two levels down go side
    by side, or if these are few, those below them (unless they are too many to
    ask for one by one)."""
    found = glob_paths(spark, f"{literal(path)}/*/*")
    for level in range(3, 8):
        if not found or len(found) >= 16:
            break
        deeper = glob_paths(spark, literal(path) + "/*" * level)
        if not deeper or len(deeper) > 1000:
            break
        found = deeper
    with ThreadPoolExecutor(16) as pool:
        list(pool.map(lambda p: delete_path(spark, p), found))
    return delete_path(spark, path)


def touch_path(spark: SparkSession, path: str) -> None:
    """Create an empty marker file."""
    fs, p = file_system(spark, path)
    fs.create(p, True).close()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a Hadoop pattern, in one call however many they are."""
    _, util, predef = _classes(spark.sparkContext)
    fs, p = file_system(spark, pattern)
    found = fs.globStatus(p)
    text = predef.genericWrapArray(util.stat2Paths(found)).mkString("\n") if found is not None else ""
    return text.split("\n") if text else []


def literal(path: str) -> str:
    """A path as a pattern that matches only itself."""
    return "".join(f"\\{c}" if c in "[]{}*?,\\" else c for c in path)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders under ``path`` that hold data files (metadata only)."""
    def holds_data(name: str) -> bool:
        fs, p = file_system(spark, f"{path}/{name}")
        it = fs.listFiles(p, True)
        while it.hasNext():
            if not it.next().getPath().getName().startswith(("_", ".")):
                return True
        return False

    names = child_folders(spark, path)
    return [n for n, yes in zip(names, side_by_side(holds_data, names), strict=True) if yes]


# --- fixed values: characters that Spark writes as %XX in partition folder names
_ESCAPED = set('"#%\'*/:=?\\\x7f{[]^')


def partition_folder(column: str, value: str) -> str:
    """Folder name of a partition value, as Spark writes it."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED or ord(c) < 32 else c for c in value)


def _folder_value(name: str) -> str:
    return unquote(name.split("=", 1)[1])


COMPACTED = "_compacted"  # folder beside the tables of a layer that holds their merged run folders
LIVE = "_runs.json"  # names the runs that a merged folder replaces; written last


def _children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what is visible directly under ``path``."""
    fs, p = file_system(spark, path)
    try:
        found = fs.listStatus(p) if fs.exists(p) else []
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return []
        raise
    named = [(s.getPath().getName(), bool(s.isDirectory())) for s in found]
    return [(n, d) for n, d in named if not n.startswith(("_", ".")) and ".tmp-" not in n]


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly under ``path`` (none if missing)."""
    return [n for n, is_folder in _children(spark, path) if is_folder]


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files directly under ``path`` (none if missing)."""
    return sorted(n for n, is_folder in _children(spark, path) if not is_folder)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file; a target that exists already is an error."""
    (fs, a), b = file_system(spark, source), _classes(spark.sparkContext)[0](target)
    fs.mkdirs(b.getParent())
    if fs.exists(b) or not fs.rename(a, b):
        raise OSError(f"cannot move {source} to {target}")


def compacted_folder(table: str, date: str) -> str:
    """Folder of the merged run folders of one batch date of a table."""
    layer, entity = table.rsplit("/", 1)
    return f"{layer}/{COMPACTED}/{entity}/{partition_folder('etl_batch_date', date)}"


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a small file, null if it does not exist."""
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears whole or not at all."""
    (fs, final), part = file_system(spark, path), _classes(spark.sparkContext)[0](f"{path}.tmp-{uuid.uuid4().hex[:8]}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(part, final):
        raise OSError(f"cannot write {path}")


@dataclass
class DateFolders:
    """Where the rows of one batch date of a table lie. ``runs``: its run
    folders that hold live rows; ``merged``: the runs inside the merged folder
    ``version`` (which replaces their own folders, if those still exist);
    ``dead``: run folders that it replaced, and other merged folders."""
    date: str
    table: str
    runs: list[str]
    version: str | None
    merged: list[str]
    dead: list[str]
    plain: bool

    def paths(self, only: set[str] | None = None) -> list[str]:
        """Folders to scan besides the merged one."""
        folder = f"{self.table}/{partition_folder('etl_batch_date', self.date)}"
        if self.plain:
            return [folder]
        return [f"{folder}/{partition_folder('etl_run_id', r)}" for r in self.runs if only is None or r in only]


def date_folders(spark: SparkSession, table: str, date: str) -> DateFolders | None:
    """Folders of one batch date, listed under that date only; null if it has
    none. Rows that lie directly in the date's folder make it ``plain``."""
    folder, home = f"{table}/{partition_folder('etl_batch_date', date)}", compacted_folder(table, date)
    runs = [n for n in child_folders(spark, folder) if n.startswith("etl_run_id=")]
    versions = [n for n in child_folders(spark, home) if n.startswith("v=")]
    notes = {v: note for v in versions if (note := read_small(spark, f"{home}/{v}/{LIVE}")) is not None}
    return _date_folders(table, date, runs, versions, notes, bool(runs) or path_exists(spark, folder))


def _date_folders(table: str, date: str, run_names: list[str], versions: list[str], notes: dict[str, str],
                  there: bool) -> DateFolders | None:
    """What the names of a date's run folders and merged folders, the texts of
    the latter's notes and whether the date's folder exists say."""
    folder, home = f"{table}/{partition_folder('etl_batch_date', date)}", compacted_folder(table, date)
    runs = {_folder_value(n): n for n in run_names}
    newest = max(notes, default=None)  # the last one replaces those before it
    version, merged = (f"{home}/{newest}", json.loads(notes[newest])) if newest else (None, [])
    if not runs and version is None and not there:
        return None
    dead = [f"{folder}/{runs[r]}" for r in runs if r in set(merged)]
    dead += [f"{home}/{v}" for v in sorted(versions) if f"{home}/{v}" != version]
    return DateFolders(date, table, sorted(r for r in runs if r not in set(merged)), version, merged, dead,
                       plain=not runs and there)


LIST_DATES = 500  # dates whose folders one pattern names


def folders_of(spark: SparkSession, table: str, dates: list[str]) -> list[DateFolders]:
    """:func:`date_folders` of those dates that have any. Many dates are listed
    by patterns that name them: a few calls, whatever their number, and no other
    date's folder is entered."""
    if len(dates) < 4:
        found = [date_folders(spark, table, d) for d in dates]
    else:
        dates, (layer, entity) = sorted(set(dates)), table.rsplit("/", 1)
        compacted = f"{layer}/{COMPACTED}/{entity}"
        merged = path_exists(spark, compacted)
        found = []
        for i in range(0, len(dates), LIST_DATES):
            found += _list_dates(spark, table, dates[i:i + LIST_DATES], compacted if merged else None)
    return [f for f in found if f]


def _list_dates(spark: SparkSession, table: str, dates: list[str], compacted: str | None) -> list[DateFolders | None]:
    names = {partition_folder("etl_batch_date", d): d for d in dates}

    def under(root: str, below: str = "", some: Iterable[str] = names) -> dict[str, list[str]]:
        """Per date, the last part of what matches below its folder. Alternatives
        that hold a slash are looked up one by one: the table's other folders
        are neither listed nor compared with the names."""
        at = below.count("/")
        home, last = root.rsplit("/", 1)
        one_of = "{" + ",".join(f"{literal(last)}/{literal(n)}" for n in some) + "}"
        out: dict[str, list[str]] = {}
        for p in glob_paths(spark, f"{literal(home)}/{one_of}{below}"):
            parts = p.split("/")
            out.setdefault(parts[-1 - at], []).append(parts[-at] if at else "")
        return out

    runs = under(table, "/etl_run_id=*")
    bare = [n for n in names if n not in runs]
    there = {*runs, *(under(table, "", bare) if bare else ())}
    versions = under(compacted, "/v=*") if compacted else {}
    noted = [(n, v) for n, vs in under(compacted, f"/v=*/{LIVE}").items() for v in vs] if versions else []
    texts = side_by_side(lambda x: read_small(spark, f"{compacted}/{x[0]}/{x[1]}/{LIVE}"), noted)
    notes: dict[str, dict[str, str]] = {}
    for (n, v), text in zip(noted, texts, strict=True):
        if text is not None:
            notes.setdefault(n, {})[v] = text
    return [_date_folders(table, d, [r for r in runs.get(n, []) if ".tmp-" not in r], versions.get(n, []), notes.get(n, {}), n in there)
            for n, d in names.items()]


def run_folders(spark: SparkSession, table: str, dates: list[str]) -> dict[str, set[str]]:
    """Run ids that have rows in each batch date of a table, in folders of
    their own or merged. Only the dates' own folders are listed."""
    return {d: set() for d in dates} | {f.date: {*f.runs, *f.merged} for f in folders_of(spark, table, dates)}


def parse_landing(lines: DataFrame, keep: list[str], value: str = "value") -> DataFrame:
    """JSON text lines -> typed columns, one row per non-blank line.

    Only a line that is no JSON object, or an envelope whose message was none,
    is malformed: its text is in ``bad_line`` (null otherwise) and its fields
    are null. A field of the wrong type is null and kept in ``extra_fields``."""
    as_map = "map<string,string>"
    df = (lines.filter(F.trim(value) != "").select(F.col(value).alias("_line"), *keep)
          .withColumn("_top", F.from_json("_line", as_map)))
    df = df.withColumn("_payload", F.from_json(F.col("_top")["value"], as_map))
    broken = F.col("_top").isNull() | (F.col("_top")["value"].isNotNull() & F.col("_payload").isNull())
    cols = unnest_envelope(F.col("_top"), F.col("_payload"))
    return df.select(*[F.when(~broken, c).alias(n) for n, c in cols.items()], *keep,
                     F.when(broken, F.col("_line")).alias("bad_line"))


def landing_lines(spark: SparkSession, path: str, glob: str = LANDING_GLOB) -> DataFrame:
    """Text lines of the landing files under ``path`` with their file."""
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def read_landing(spark: SparkSession, path: str, quarantine: bool = False,
                 glob: str = LANDING_GLOB):
    """Landing JSON-Lines under ``path`` (any depth), both event kinds and
    both line shapes (bare event / Kafka envelope) in one frame (S01, P03).

    Lines are scanned as text (files split across tasks). Malformed lines do
    not fail the scan (S02): with ``quarantine`` the result is ``(good, bad)``
    where ``bad`` holds the raw text and its file.
    """
    df = parse_landing(landing_lines(spark, path, glob), ["source_file"])
    good = df.filter(F.col("bad_line").isNull()).drop("bad_line")
    if not quarantine:
        return good
    return good, df.filter(F.col("bad_line").isNotNull()).select(F.col("bad_line").alias("raw_line"), "source_file")


def _landing_tree(spark: SparkSession, base: str, only: dict[str, str]) -> list[str] | None:
    """Folders of a landing tree that hold the given times, each listed by one
    task; null if the tree is to be read as a whole (a stream's log says which
    of its files count)."""
    if path_exists(spark, f"{base}/_spark_metadata"):
        return None
    levels = [literal(partition_folder(c, only[c])) if c in only else f"{c}=*" for c in PARTITION_COLS[:-1]]
    return glob_paths(spark, "/".join([literal(base), *levels]))


def read_landing_partitions(spark: SparkSession, base: str, quarantine: bool = False, only: dict[str, str] | None = None):
    """Hive-partitioned landing tree `year=/month=/day=/hour=/minute=` (S11),
    with ``quarantine`` as :func:`read_landing`.

    Partition columns are zero-padded text (as written) so equality filters
    on them prune directories before any file is opened. A filter alone comes
    after the whole tree was listed: with ``only`` (partition column -> value)
    no other folder is listed either."""
    only = only or {}
    schema = T.StructType([T.StructField("value", T.StringType())]
                          + [T.StructField(c, T.StringType()) for c in PARTITION_COLS])
    folders = _landing_tree(spark, base, only)
    if folders is None or not folders and not only:
        lines = spark.read.schema(schema).option("basePath", base).text(base)
    elif folders:
        lines = spark.read.schema(schema).option("basePath", base).text([literal(f) for f in folders])
    else:
        lines = spark.createDataFrame([], schema)
    for c, value in only.items():
        lines = lines.filter(F.col(c) == value)
    df = parse_landing(lines, PARTITION_COLS)
    good = df.filter(F.col("bad_line").isNull()).drop("bad_line")
    if not quarantine:
        return good
    return good, df.filter(F.col("bad_line").isNotNull()).select(F.col("bad_line").alias("raw_line"), *PARTITION_COLS)


TEXT_PARTITIONS = ("etl_batch_date", "etl_run_id")


def _text_partitions(schema: T.StructType) -> T.StructType:
    """Partition values are text, whatever they look like."""
    return T.StructType([T.StructField(f.name, T.StringType()) if f.name in TEXT_PARTITIONS else f for f in schema.fields])


def scan(spark: SparkSession, table: str, paths: list[str], schema: T.StructType | None, skip_unreadable: bool) -> DataFrame:
    """Parquet files under the given folders of a table: nothing else is listed."""
    def reader():
        r = spark.read.option("basePath", table)
        # the schema then comes from all readable files, not from one that may be broken
        return r.option("ignoreCorruptFiles", "true").option("mergeSchema", "true") if skip_unreadable else r

    if schema is None:
        try:
            with few_list_tasks(spark):
                schema = reader().parquet(*paths).schema
        except AnalysisException as e:
            if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # folders without data files
                raise
            return spark.createDataFrame([], T.StructType([]))
    schema = _text_partitions(schema)
    with few_list_tasks(spark):
        rows = reader().schema(schema).parquet(*paths)
    return rows.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def batch_dates(spark: SparkSession, table: str) -> list[str]:
    """All batch dates of a table that have a folder, oldest first."""
    layer, entity = table.rsplit("/", 1)
    names = {*child_folders(spark, table), *child_folders(spark, f"{layer}/{COMPACTED}/{entity}")}
    return sorted(_folder_value(n) for n in names if n.startswith("etl_batch_date="))


def read_layer(spark: SparkSession, base: str, layer: str, entity: str, batch_date: str | list[str] | None = None,
               schema: T.StructType | None = None, skip_unreadable: bool = False, runs: set[str] | None = None) -> DataFrame:
    """One layer table (S05), or one or several of its batch dates (S06), and of
    these the rows of some ``runs`` only.

    With ``batch_date`` only the folders of these dates are listed, however
    many others there are. A missing table or date, or one without files, gives
    an empty frame (with the columns of ``schema``, else those of the table's
    newest date). Run folders that a merged folder replaced are not read (see
    ``plans.compaction``).

    An unreadable file fails the read. With ``skip_unreadable`` (for serving,
    never inside the ETL) such files are left out; :func:`unreadable_files`
    tells which."""
    table = f"{base}/{layer}/{entity}"
    compacted = f"{base}/{layer}/{COMPACTED}/{entity}"
    if batch_date is None and runs is None and not path_exists(spark, compacted):
        if not path_exists(spark, table):
            return spark.createDataFrame([], schema or T.StructType([]))
        return scan(spark, table, [table], schema, skip_unreadable)
    dates = batch_dates(spark, table) if batch_date is None else [batch_date] if isinstance(batch_date, str) else list(batch_date)
    found = folders_of(spark, table, dates)
    paths = [p for f in found for p in f.paths(runs)]
    versions = [f.version for f in found if f.version and (runs is None or runs & set(f.merged))]
    if schema is None and not paths and not versions:
        newest = folders_of(spark, table, batch_dates(spark, table)[-1:])
        schema = (read_layer(spark, base, layer, entity, newest[0].date, skip_unreadable=skip_unreadable).schema
                  if newest and newest[0].date not in dates else T.StructType([]))
    parts = []
    if paths:
        parts.append(scan(spark, table, paths, schema, skip_unreadable))
    if versions:
        like = schema or (parts[0].schema if parts and parts[0].columns else None)
        merged = scan(spark, compacted, versions, like, skip_unreadable).drop("v")
        parts.append(merged if runs is None else merged.filter(F.col("etl_run_id").isin(sorted(runs))))
    parts = [p for p in parts if p.columns]
    if not parts:
        return spark.createDataFrame([], _text_partitions(schema) if schema else T.StructType([]))
    df = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    # of several dates the folders are the filter
    return df.filter(F.col("etl_batch_date") == dates[0]) if batch_date is not None and len(dates) == 1 else df


MANIFEST = "_manifest"  # table of the files that runs and compactions wrote (sinks.manifest)
MANIFEST_SCHEMA = "path string, n_rows long, n_bytes long"


def suspect_files(spark: SparkSession, base: str, layer: str, entity: str) -> DataFrame:
    """Stored data files of a table, merged ones included, that are not as the
    manifest lists them: never recorded, or of another size. ``path`` (as
    ``_metadata.file_path`` gives it), ``n_bytes`` and ``recorded_rows`` (null if
    never recorded). No data file is opened."""
    tables = [p for p in (f"{base}/{layer}/{entity}", f"{base}/{layer}/{COMPACTED}/{entity}") if path_exists(spark, p)]
    if not tables:
        return spark.createDataFrame([], "path string, n_bytes long, recorded_rows long")
    m = F.col("_metadata")
    with few_list_tasks(spark):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(tables)
    files = files.select(m["file_path"].alias("path"), m["file_size"].alias("n_bytes"))
    if not path_exists(spark, f"{base}/{MANIFEST}"):
        return files.withColumn("recorded_rows", F.lit(None).cast("bigint"))
    known = (spark.read.schema(MANIFEST_SCHEMA).parquet(f"{base}/{MANIFEST}")
             .groupBy("path").agg(F.collect_set("n_bytes").alias("sizes"), F.max("n_rows").alias("recorded_rows")))
    return (files.join(known, "path", "left")
            .where(~F.coalesce(F.array_contains("sizes", F.col("n_bytes")), F.lit(False)))
            .select("path", "n_bytes", "recorded_rows"))


def unreadable_files(spark: SparkSession, base: str, layer: str, entity: str) -> DataFrame:
    """Broken data files of a table, those that ``skip_unreadable`` leaves out:
    ``path``, ``n_bytes`` and ``recorded_rows`` (the rows lost with it, null if
    the manifest has no such file).

    A file whose size the manifest lists is sound and is not opened (a change
    that keeps the size is not seen). Of the others a file with rows is sound, and
    one without is empty if it begins and ends as a Parquet file does."""
    suspects = suspect_files(spark, base, layer, entity)
    paths = [r["path"] for r in suspects.select("path").collect()]  # names only
    if not paths:
        return suspects
    paths = [unquote(p) for p in paths]
    m = F.col("_metadata")
    read = (spark.read.schema("_none int").option("ignoreCorruptFiles", "true").parquet(*paths)
            .select(m["file_path"].alias("path")).distinct())
    marks = spark.read.format("binaryFile").load(paths).select(m["file_path"].alias("path"), "content")
    magic = F.lit("PAR1").cast("binary")
    empty = marks.where((F.octet_length("content") >= 12) & (F.substring("content", 1, 4) == magic)
                        & (F.substring("content", -4, 4) == magic)).select("path")
    return suspects.join(read, "path", "left_anti").join(empty, "path", "left_anti")


def available_dates(spark: SparkSession, base: str, layer: str, entity: str) -> DataFrame:
    """Batch dates present in a layer table, newest first (S07), from its
    partition folders: no file is opened."""
    dates = [_folder_value(f) for f in list_folders(spark, f"{base}/{layer}/{entity}") if f.startswith("etl_batch_date=")]
    return spark.createDataFrame([(d,) for d in sorted(dates, reverse=True)], "etl_batch_date string").coalesce(1)


def read_smartwatch_csv(spark: SparkSession, path: str, pandas_na: bool = True) -> DataFrame:
    """Headered smartwatch CSV, every column as text (S08). Empty cells and,
    with ``pandas_na``, the texts pandas reads as missing (`nan`, `NA`, ...)
    are null; padding inside cells is kept for the cleaning step."""
    df = (spark.read.option("header", "true").schema(S.SMARTWATCH_SCHEMA)
          .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
          .csv(path))
    return na_tokens_to_null(df) if pandas_na else df
