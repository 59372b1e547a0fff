"""Activity-recognition sensor files: raw readings and ARFF feature files.

Both are read with Spark's text source, so files are split across tasks;
parsing is built-in string functions (split, element access), no Python.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.scalars import activity_name, strip_trailing_semicolons, to_number
from pulsegrid.sources.files import few_list_tasks

RAW_FIELDS = 6


def parse_sensor_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """`subject,activity,timestamp_ns,x,y,z;` lines -> typed rows.

    Lines with more than six fields are dropped (a bad line), shorter ones
    are padded with nulls, blank lines are skipped, the trailing `;` is
    stripped so the last axis is a number.
    """
    line = strip_trailing_semicolons(F.col(line_col))
    arr = F.split(line, ",")
    other = [c for c in df.columns if c != line_col]
    base = df.filter(F.trim(F.col(line_col)) != "").select(*other, arr.alias("_f"))
    base = base.filter(F.size("_f") <= RAW_FIELDS)

    def f(i):
        return F.try_element_at(F.col("_f"), F.lit(i))

    return base.select(
        *other,
        to_number(f(1)).cast("long").alias("subject_id"),
        F.trim(f(2)).alias("activity_code"),
        to_number(f(3)).cast("long").alias("timestamp"),
        to_number(f(4)).alias("x"),
        to_number(f(5)).alias("y"),
        to_number(f(6)).alias("z"),
    ).withColumn("activity_name", activity_name("activity_code"))


def source_name() -> Column:
    """Name of a scanned file; a file written under a `file=<name>` partition
    folder has that name."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    folder = F.element_at(parts, -2)
    return F.when(folder.startswith("file="), F.substr(folder, F.lit(6))).otherwise(F.element_at(parts, -1))


def read_sensor_raw(spark: SparkSession, path: str, sensor_type: str, device_type: str, glob: str | None = None) -> DataFrame:
    """Raw sensor files `data_*_{device}.txt` (or ``glob``) under ``path``."""
    with few_list_tasks(spark):
        files = spark.read.option("pathGlobFilter", glob or f"data_*_{device_type}.txt").option("recursiveFileLookup", "true").text(path)
    lines = files.select(F.col("value").alias("line"), source_name().alias("source_file"))
    return (parse_sensor_lines(lines)
            .withColumns({"sensor_type": F.lit(sensor_type), "device_type": F.lit(device_type)}))


def _feature_lines(spark: SparkSession, paths: list[str], glob: str | None) -> DataFrame:
    r = spark.read.option("recursiveFileLookup", "true")
    with few_list_tasks(spark):
        files = (r.option("pathGlobFilter", glob) if glob else r).text(paths)
    return (files
            .select(F.col("value").alias("line"), F.trim("value").alias("t"), F.col("_metadata.file_path").alias("file"),
                    source_name().alias("name"), F.col("_metadata.file_block_start").alias("blk"),
                    F.monotonically_increasing_id().alias("mid")))


def _may_be_row() -> Column:
    """A line that may be a row: not blank, no comment, no declaration."""
    return (F.col("t") != "") & ~F.col("line").startswith("%") & ~F.col("t").startswith("@")


def feature_headers(lines: DataFrame) -> DataFrame:
    """(file, names, regular) of each file that declares attributes and data,
    from one pass whose shuffle holds a few rows per task and file: the declared
    names, and whether all rows stand after `@data` and all declarations before
    it. Lines keep their in-file order through (block start, increasing id)."""
    pos, t = F.struct("blk", "mid"), F.col("t")
    attribute = F.struct("blk", "mid", F.regexp_replace(F.element_at(F.split("t", r"\s+"), 2), '^"+|"+$', "").alias("attr"))
    g = lines.groupBy("file").agg(
        F.min(F.when(t == "@data", pos)).alias("data"), F.min(F.when(_may_be_row(), pos)).alias("first_row"),
        F.max(F.when(t.startswith("@"), pos)).alias("last_mark"),
        F.sort_array(F.collect_list(F.when(t.startswith("@attribute"), attribute))).alias("a"))
    declared = F.filter("a", lambda x: F.struct(x["blk"], x["mid"]) < F.struct(F.col("data.blk"), F.col("data.mid")))
    regular = (F.col("last_mark") == F.col("data")) & F.coalesce(F.col("first_row") > F.col("data"), F.lit(True))
    return (g.where("data is not null")
            .select("file", F.transform(declared, lambda x: x["attr"]).alias("names"), regular.alias("regular"), "data")
            .where(F.size("names") > 0))


def _as_path(uri: str) -> str:
    """A file's reported path as one that a reader takes literally."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in unquote(uri))


def _positional(rows: DataFrame, names: list[str], columns: list[str]) -> DataFrame:
    """Rows of files that declare ``names``: each wanted column by its place."""
    cells = rows.select("name", F.split("t", ",").alias("cells")).where(F.size("cells") == len(names))
    place = {n: i for i, n in enumerate(names)}
    return cells.select(*[(F.col("cells")[place[c]] if c in place else F.lit(None).cast("string")).alias(c) for c in columns],
                        F.col("name").alias("source_file"))


def read_sensor_features(spark: SparkSession, path: str, sensor_type: str, device_type: str,
                         columns: list[str] | None = None,
                         glob: str | None = None) -> DataFrame:
    """ARFF feature files `data_*_{device}.arff` (or ``glob``) -> one column per
    declared attribute (S10).

    Each file declares its attributes (`@attribute "NAME" type`) before
    `@data`; rows after it that are blank, comments (`%`) or of the wrong
    width are dropped. Headers are read first, when this is called, and files
    grouped by the names they declare; the lines of a group are then split and
    taken by position in a narrow plan: no line is shuffled or joined. A file
    with rows before `@data` or `@` lines after it is the exception: only its
    lines meet their header in a join. ``columns`` fixes the output columns;
    else they are those of the first file, then all others by name.
    """
    glob = glob or f"data_*_{device_type}.arff"
    lines = _feature_lines(spark, [path], glob)
    headers = feature_headers(lines)
    # one row per distinct header; a file's path is there once, as in Spark's own listing
    groups = headers.groupBy("names", "regular").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    groups = sorted(groups, key=lambda g: g["files"][0])
    if columns is None:
        declared = [list(g["names"]) for g in groups]
        columns = list(dict.fromkeys(declared[0])) if declared else []
        columns += sorted({n for names in declared for n in names} - set(columns))
    parts = []
    alone = len(groups) == 1 and len(groups[0]["files"]) == len(lines.inputFiles())
    for g in groups:
        own = lines if alone else _feature_lines(spark, [_as_path(f) for f in g["files"]], None)
        if g["regular"]:
            parts.append(_positional(own.where(_may_be_row()), list(g["names"]), columns))
        else:
            header = feature_headers(own).select(F.col("file").alias("_file"), F.col("data").alias("_data"))
            rows = own.join(header, own["file"] == header["_file"]).where(F.struct("blk", "mid") > F.col("_data"))
            rows = rows.where((F.col("t") != "") & ~F.col("line").startswith("%"))
            parts.append(_positional(rows, list(g["names"]), columns))
    if not parts:
        parts = [_positional(lines.limit(0), [], columns)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    out = out.withColumns({"sensor_type": F.lit(sensor_type), "device_type": F.lit(device_type)})
    if "ACTIVITY" in columns:
        out = out.withColumn("activity_name", activity_name("ACTIVITY"))
    return out
