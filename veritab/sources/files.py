"""Readers, writers and session settings.

Inputs are read with an explicit schema: inference costs an extra pass over the
data, and it changes column types from file to file (a money column of whole
numbers comes back as ``int``), which breaks the display formats downstream.
"""

from __future__ import annotations

import csv
import logging
import os
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


MALFORMED = "_malformed"   # names of a row's columns whose cell could not be read
RECORD = "_record"         # the text of such a row's record
WIDTH = "(width)"          # listed among them: the record has not as many cells as the header
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
MAX_HEADERS = 64           # different headers of one read at most: each is a scan of its own

# How the lossless form writes cells: quotes are doubled, blanks kept, an empty text is ``""``,
# null is nothing. Only a table of one column, whose empty lines a reader would skip, quotes
# every cell and writes null as a backslash and N.
_END = "\u0001"
_NULL = "\\N"
_WRITE = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
          "nullValue": "", "emptyValue": '""'}
# On reading, an unquoted empty cell becomes a text that no cell can hold, and that is null: so
# it is told from the quoted one.
_READ = {"quote": '"', "escape": '"', "nullValue": "\u0000null", "emptyValue": ""}
_PLAIN = {"quote": '"'}


def escape_text(c: Column) -> Column:
    r"""A text on one line: a backslash is doubled; line feed, carriage return and the controls 0
    and 1 become ``\n``, ``\r``, ``\0`` and ``\1``. Files stay splittable at every line break."""
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "\\0"), ("\1", "\\1")):
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape_text(c: Column) -> Column:
    """The inverse. Written texts do not hold control 1: it stands for a backslash on the way."""
    for written, plain in (("\\\\", "\1"), ("\\n", "\n"), ("\\r", "\r"), ("\\0", "\0"), ("\\1", "\\")):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return F.translate(c, "\1\\", "\\\1")


def _integer(text: Column, kind: T.DataType) -> Column:
    """A whole number that may be written as ``3.0`` or ``1e2``; no digit of it is rounded away. The
    patterns come first: a failing cast costs more than all of them."""
    digits = text.rlike(r"^\s*[+-]?[0-9]+\s*$")
    point = text.rlike(r"^\s*[+-]?[0-9]+\.0*\s*$")
    power = text.rlike(r"^\s*[+-]?[0-9]{1,19}(\.[0-9]{0,9})?[eE][+-]?[0-9]\s*$")
    number = text.try_cast(T.DecimalType(38, 18))   # holds all digits of such a text
    return (F.when(digits, text.try_cast(kind))
            .when(point, F.substring_index(text, ".", 1).try_cast(kind))
            .when(power, F.when(number == F.floor(number), number.try_cast(kind))))


def _cell(text: Column, kind: T.DataType) -> Column:
    """A text cell as ``kind``. Null where it is not a value of that type."""
    if isinstance(kind, T.StringType):
        return text
    return _integer(text, kind) if isinstance(kind, _INTEGERS) else text.try_cast(kind)


def parse_cells(raw: DataFrame, schema: T.StructType, malformed: bool = False,
                broken: str | None = None, record: str | None = None) -> DataFrame:
    """Text columns to the types of ``schema``, by name; each cell is parsed once.

    With ``malformed`` a column of that name lists, per row, the columns whose cell held a text
    that is no value of its type (such a cell is null in its own column), and first ``WIDTH`` where
    the boolean column ``broken`` says so. A ``record`` column is kept as ``RECORD`` for the rows
    that list anything."""
    if not malformed:
        return raw.select([_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])
    more = [c for c in (broken, record) if c]
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    both = raw.select([_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields]
                      + [F.col(f"`{f.name}`").isNotNull().alias(f"_has_{k}") for k, f in enumerate(typed)] + more)
    lost = [F.when(F.col(broken), F.lit(WIDTH))] if broken else []
    lost += [F.when(F.col(f"_has_{k}") & F.col(f"`{f.name}`").isNull(), F.lit(f.name)) for k, f in enumerate(typed)]
    listed = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    out = both.withColumn(MALFORMED, listed)
    kept = [F.col(f"`{f.name}`") for f in schema.fields] + [F.col(MALFORMED)]
    if record:
        kept.append(F.when(F.size(MALFORMED) > 0, F.col(record)).alias(RECORD))
    return out.select(kept)


def first_lines(spark: SparkSession, path) -> list[tuple[str, str]]:
    """``(file, its first line that is not blank)`` of every file under ``path`` (one or a list).

    Every file is a task of its own, whole, and the task ends at that line: the rest is
    not read. What comes back is as long as the list of files that any read keeps."""
    def first(batches):
        for batch in batches:
            for value, name in zip(batch.column("value").to_pylist(), batch.column("name")):
                if value and value.strip():
                    yield batch.slice(0, 0).from_pylist([{"value": value, "name": name.as_py()}],
                                                        schema=batch.schema)
                    return

    whole = {"spark.sql.files.maxPartitionBytes": str(2 ** 50), "spark.sql.files.openCostInBytes": str(2 ** 50)}
    before = {k: spark.conf.get(k) for k in whole}
    for k, v in whole.items():
        spark.conf.set(k, v)
    try:
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("name"))
        return sorted((r["name"], r["value"]) for r in
                      lines.mapInArrow(first, "value string, name string").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def _names(line: str, lossless: bool) -> list[str]:
    quoting = {"doublequote": True} if lossless else {"doublequote": False, "escapechar": "\\"}
    return next(csv.reader([line.removeprefix("\ufeff")], **quoting))


def _by_header(spark: SparkSession, path, lossless: bool, mixed: bool) -> list[tuple[str, list[str], list[str]]]:
    """``(line, names, files)`` for every different header line under ``path``."""
    groups: dict[str, list[str]] = {}
    for name, line in first_lines(spark, path):
        groups.setdefault(line, []).append(unquote(name))
    found = [(line, _names(line, lossless), files) for line, files in groups.items()]
    if len({tuple(names) for _, names, _ in found}) > (MAX_HEADERS if mixed else 1):
        raise ValueError(f"the files of {path} have {len(found)} different headers, such as "
                         + " and ".join(repr(line) for line, _, _ in found[:2]))
    return found


def _require(path, names: Sequence[str], schema: T.StructType) -> None:
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")


def _records(spark: SparkSession, line: str, names: list[str], files: list[str], options: dict) -> DataFrame:
    """The records of files with one header: a text column for each name, ``_broken`` and ``_text``.

    A record is tokenised together with one more cell at its end. That cell comes out in the
    place after the header's last if, and only if, the record has as many cells as the
    header and its quotes are closed: in a short record it stands too early, in a long one
    another cell has its place, and a quote left open swallows it."""
    end, broken = F.col(f"cells._{len(names)}"), F.col("_broken")
    cells = ", ".join(f"_{k} STRING" for k in range(len(names) + 1))
    lines = (spark.read.text(files).where((F.trim("value") != "") & (F.col("value") != F.lit(line)))
             .select("value", F.from_csv(F.concat("value", F.lit("," + _END)), cells, options).alias("cells"))
             .select("value", "cells", (~end.eqNullSafe(F.lit(_END))).alias("_broken")))
    first = {name: k for k, name in reversed(list(enumerate(names)))}
    cut = lambda c: F.nullif(F.regexp_replace(c, f",?{_END}$", F.lit("")), F.lit(""))
    return lines.select(*[F.when(broken, cut(F.col(f"cells._{k}"))).otherwise(F.col(f"cells._{k}")).alias(name)
                          for name, k in first.items()], "_broken", F.col("value").alias("_text"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False, malformed: bool = False, lossless: bool = False,
             mixed_headers: bool = False, records: bool = False) -> DataFrame:
    """Read CSV with a header row.

    ``path`` may be one file, a directory or a glob. With ``schema`` the columns are
    found in the header by name, in any order; a missing one is a ``ValueError``. Every
    file's own header is compared with the first one's when it is read: a file with
    its columns in another order fails the read instead of loading into the wrong ones.
    With ``mixed_headers`` the files' first lines are read before, and the files of each different
    header are a scan of their own, in which columns are found by name.
    Spark's column pruning still parses only the columns a query uses. ``infer=True``
    (without a schema) falls back to schema inference, at the cost of one extra pass.

    ``lossless`` reads what ``write_csv`` writes, cell by cell as it was. Without it quotes are
    escaped by a backslash and empty texts are null, as in Spark's own reading.

    ``malformed`` adds the column of that name (see ``parse_cells``): records are read whole, as
    lines, so that those with too few or too many cells or an open quote are seen as well; a
    record equal to its file's header line is taken for a header. ``records`` adds their text."""
    options = _READ if lossless else {}
    if schema is None:
        return spark.read.options(header=True, **options).option("inferSchema", infer).csv(path)
    if malformed or mixed_headers:
        parts = [_read_group(spark, path, schema, group, options, malformed, records)
                 for group in _by_header(spark, path, lossless, mixed_headers)]
        if not parts:   # no file has a line
            parts = [parse_cells(spark.createDataFrame([], _texts(schema.names)), schema, malformed)]
        return reduce(DataFrame.unionByName, parts)
    header = spark.read.options(header=True, **options).csv(path).columns
    _require(path, header, schema)
    return parse_cells(_cells(spark, path, header, options), schema)


def _texts(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _one_column(options: dict, names: Sequence[str]) -> dict:
    return options | {"nullValue": _NULL} if options and len(names) == 1 else options


def _decoded(raw: DataFrame, options: dict) -> DataFrame:
    if not options:
        return raw
    return raw.withColumns({f"`{n}`" if "." in n else n: unescape_text(F.col(f"`{n}`"))
                            for n in raw.columns if n not in ("_broken", "_text")})


def _cells(spark: SparkSession, path, header: Sequence[str], options: dict) -> DataFrame:
    """The text cells of files with that header, parsed only where a query uses them."""
    return _decoded(spark.read.options(header=True, **_one_column(options, header)).schema(_texts(header))
                    .option("enforceSchema", False).csv(path), options)


def _read_group(spark, path, schema, group, options, malformed, records) -> DataFrame:
    line, names, files = group
    _require(path, names, schema)
    if not malformed:
        return parse_cells(_cells(spark, files, names, options), schema)
    raw = _decoded(_records(spark, line, names, files, _one_column(options, names) or _PLAIN), options)
    return parse_cells(raw, schema, True, "_broken", "_text" if records else None)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               malformed: bool = False, mixed_headers: bool = False) -> DataFrame:
    """Read Parquet, or CSV when ``path`` ends in ``.csv``; the schema applies to both.
    ``malformed`` adds that column to a CSV table (Parquet has no such cells)."""
    if path.lower().endswith(".csv"):
        return read_csv(spark, path, schema, infer=schema is None,
                        malformed=malformed and schema is not None, mixed_headers=mixed_headers)
    df = spark.read.parquet(path)
    if schema is not None:
        df = df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """Write ``df`` as a CSV folder with a header line, without loss: ``read_csv(.., lossless=True)``
    returns every text as it was. Quotes are doubled; blanks at both ends are kept; an empty text
    is ``""`` and null is nothing; a line break is written as ``\\n`` or ``\\r`` and a backslash doubled,
    so that every record is one line and files can be read in parts.

    Parallel by default: every partition writes its own part file. ``single_file``
    adds one shuffle into a single partition, so the plan above it keeps its full
    width (``coalesce(1)`` would pull the whole last stage into one task); the
    write itself is then one task, so it is meant for small results (a top-N,
    per-group totals), not for row-level outputs.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cells = [escape_text(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns]
    options = dict(_WRITE)
    if len(df.columns) == 1:
        options |= {"nullValue": _NULL, "quoteAll": True}
    out = df.select(cells)
    out = out.repartition(1) if single_file else out
    out.write.mode(mode).options(header=True, **options).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read
    it back: for inputs that are expensive to derive and read more than once.
    The lineage is cut at a durable copy, so a lost executor costs a re-read of
    that copy, not a recomputation of the joins behind it."""
    return materialize_at(df, shared_dir(df.sparkSession, name))


def materialize_at(df: DataFrame, path: str) -> DataFrame:
    """As ``materialize``, at a place the caller chose (and may remove)."""
    write_parquet(df, path)
    return df.sparkSession.read.parquet(path)


# Settings the original job set on its session; AQE re-sizes shuffles at run time,
# so the shuffle width is left to the caller / cluster defaults.
SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100MB",
}


def configure(spark: SparkSession, overrides: dict[str, str] | None = None) -> SparkSession:
    """Apply the job's SQL settings to an existing session (the caller owns it)."""
    for key, value in {**SESSION_SETTINGS, **(overrides or {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Only a local-mode session without it
    (tests, a laptop) gets a folder of its own; on a cluster a machine-local
    folder would be invisible to the executors, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            sc = spark.sparkContext
        except Exception:  # noqa: BLE001 - a remote (Connect) session has none
            sc = None
        base = sc.getCheckpointDir() if sc is not None else None
        if not base:
            if sc is None or not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="veritab-"))
            base = sc.getCheckpointDir()
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


def _hadoop_path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def make_dir(spark: SparkSession, path: str) -> None:
    """Make a folder on the file system it lies on; one that is there stays."""
    fs, target = _hadoop_path(spark, path)
    fs.mkdirs(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop_path(spark, path)
    return fs.exists(target)


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lies on."""
    fs, target = _hadoop_path(spark, path)
    fs.delete(target, True)
