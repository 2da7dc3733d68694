"""Scans and sinks.

CSV files are read with a declared schema when one is given: every column is
first read as text, null tokens are mapped to null, then each column is
converted with a ``try_cast`` so a bad value becomes null instead of failing
the job (Spark 4 runs with ANSI on). Ragged rows are padded with nulls
(PERMISSIVE mode).
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Mapping
from urllib.parse import unquote
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaspark.sources.records import multiline_files, read_records, text_lines

DEFAULT_NULL_TOKENS = ("", "N/A")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads (S3)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _list_files(spark: SparkSession, folder: str, suffix: str) -> list[str]:
    """Paths of the folder's files with the suffix; a listing, no job."""
    if not exists(spark, folder):
        raise FileNotFoundError(f"{folder} does not exist")
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().toString() for f in found if f.getPath().getName().endswith(suffix))


def _stem(path: str) -> str:
    name = os.path.basename(path.rstrip("/"))
    for suf in (".csv", ".parquet"):
        if name.endswith(suf):
            return name[: -len(suf)]
    return name


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_tokens: Iterable[str] = DEFAULT_NULL_TOKENS,
             missing_ok: bool = False, order_column: str | None = None,
             multi_line: bool | None = None) -> DataFrame:
    """Read one CSV file or folder.

    Records may hold quoted line breaks: ``multi_line`` says whether they do;
    None looks for lines with an odd number of quotes first (one scan of the
    text that ends at the first one).

    With ``schema``: text read, null tokens -> null, ``try_cast`` to the
    declared type. Without: every column stays a string (no inference pass).
    A missing file gives an empty typed frame when ``missing_ok``.
    ``order_column`` adds the row's place in the source, taken at the scan: file,
    start of the file block, and the running number of the task that reads the
    block. It orders rows as they stand in the file, however the file is split.
    """
    if not exists(spark, path):
        if missing_ok and schema is not None:
            return empty_frame(spark, schema)
        raise FileNotFoundError(f"{path} does not exist")
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("escape", '"').option("multiLine", False))
    if multi_line is None:
        multi_line = bool(text_lines(spark, path).where("odd = 1").limit(1).count())
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
             F.monotonically_increasing_id().alias("row")]
    if multi_line:
        # names come from the head of a file; records are put together by read_records
        names = ([f.name for f in schema] if schema is not None
                 else [c.rstrip("\r") for c in reader.option("multiLine", True).csv(path).columns])
        raw = read_records(spark, path, names)
        place = [F.col(f"__{c}").alias(c) for c in ("file", "block", "row")]
    elif schema is not None:
        text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])
        raw = reader.schema(text_schema).csv(path)
    else:
        raw = reader.csv(path)
    tokens = list(null_tokens)
    cols = []
    for f in (schema.fields if schema is not None else
              [T.StructField(c, T.StringType()) for c in raw.columns if not (multi_line and c.startswith("__"))]):
        c = F.col(f"`{f.name}`")
        c = F.when(F.trim(c).isin(tokens), F.lit(None)).otherwise(c)
        if not isinstance(f.dataType, T.StringType):
            c = coerce(c, f.dataType)
        cols.append(c.alias(f.name))
    if order_column:
        cols.append(F.struct(*place).alias(order_column))
    return raw.select(*cols)


# Shapes of text that a parser is tried on. Anything else is null without a
# call: a failed ANSI cast raises (and try_cast catches) an exception per row,
# which dominates on columns of 'N/A'.
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_INFINITE = r"^\s*[+-]?(?i:inf|infinity)\s*$"

# Date forms tried in this order: shape, pattern (None: the native cast of the
# text before any time of day). An all-number date is read month first, then day first.
DATE_FORMS = (
    (r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([ T].*)?$", None),
    (r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", "yyyy/M/d"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy"),
    (r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "d/M/yyyy"),
    (r"^[A-Za-z]{4,9} [0-9]{1,2}, [0-9]{4}$", "MMMM d, yyyy"),
    (r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "MMM d, yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{4,9} [0-9]{4}$", "d MMMM yyyy"),
    (r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"),
)


def parse_number(c, data_type) -> "F.Column":
    """Coerced numeric parse: null unless the text is a number of ``data_type``.

    The one parser of this engine. A type suffix ("12d") and "nan" are not
    numbers; an infinity is one for floating types; for whole types "4.0" is 4
    and "4.5" is null.
    """
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    if kind in ("int", "integer", "bigint", "long", "smallint", "short", "tinyint", "byte"):
        d = F.when(c.rlike(_NUMBER), c.try_cast("double"))
        whole = F.when((d == F.floor(d)) & (F.abs(d) < 9.0e18), d.try_cast("bigint").try_cast(kind))
        return F.when(c.rlike(_WHOLE), F.trim(c).try_cast(kind)).otherwise(whole)
    number = F.when(c.rlike(_NUMBER), F.trim(c).try_cast(data_type))
    if kind in ("double", "float"):
        sign = F.when(F.trim(c).startswith("-"), -1.0).otherwise(1.0)
        return F.when(c.rlike(_INFINITE), (sign * F.lit(float("inf"))).cast(kind)).otherwise(number)
    return number


def parse_date(c, forms=DATE_FORMS) -> "F.Column":
    """Coerced date parse: the first of ``forms`` that the text has and that gives a date, else null."""
    t = F.trim(c)
    tries = []
    for shape, pattern in forms:
        if pattern is None:
            value = F.regexp_extract(t, r"^([^ T]*)", 1).try_cast("date")
        else:
            value = F.try_to_date(F.initcap(t), pattern)
        tries.append(F.when(t.rlike(shape), value))
    return F.coalesce(*tries)


# Date forms of a column read as a whole; a time of day is a form of its own. A
# column whose first value can be month first is read month first.
COLUMN_DATE_FORMS = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    # May is its own short form: whole month names have three letters and more
    *[(shape.replace("{4,9}", "{3,9}"), pattern) for shape, pattern in DATE_FORMS[1:]],
)


def first_date_form(c, forms=COLUMN_DATE_FORMS) -> "F.Column":
    """Number of the first form that the text has and that gives a date, else -1; null for null."""
    t = F.trim(c)
    tries = [F.when(t.rlike(shape) & F.try_to_date(F.initcap(t) if "'" not in pattern else t, pattern).isNotNull(), n)
             for n, (shape, pattern) in enumerate(forms)]
    return F.when(c.isNotNull(), F.coalesce(*tries, F.lit(-1)))


def parse_date_as(c, form, forms=COLUMN_DATE_FORMS) -> "F.Column":
    """Strict parse with the form of number ``form``: another form is null. Form -1 is read value by value."""
    t = F.trim(c)
    out = F.when(form == -1, parse_date(c))
    for n, (shape, pattern) in enumerate(forms):
        value = F.try_to_date(F.initcap(t) if "'" not in pattern else t, pattern)
        out = out.when((form == n) & t.rlike(shape), value)
    return out


def coerce(c, data_type: T.DataType):
    """Coerced parse: a value that does not parse becomes null."""
    if isinstance(data_type, T.DateType):
        return parse_date(c)
    if isinstance(data_type, T.TimestampType):
        return F.try_to_timestamp(c)
    if isinstance(data_type, T.BooleanType):
        return F.lower(F.trim(c)).isin("true", "yes", "1")
    if isinstance(data_type, T.NumericType):
        return parse_number(c, data_type)
    return c.try_cast(data_type)


def _decoded(path: str) -> str:
    """A path without its scheme and escapes, for comparing what Spark and the store report."""
    return unquote(re.sub(r"^[a-z0-9]+:/+", "/", path))


def read_catalog(spark: SparkSession, folder: str,
                 schemas: dict[str, T.StructType] | None = None,
                 fmt: str = "csv", order_column: str | None = None) -> dict[str, DataFrame]:
    """``{file stem: DataFrame}`` for every file of a folder.

    A missing folder is an error, as in the batch pipeline being rebuilt.
    ``order_column`` as in ``read_csv``.
    """
    schemas = schemas or {}
    suffix = ".csv" if fmt == "csv" else ".parquet"
    out = {}
    paths = _list_files(spark, folder, suffix)
    # one look at all files for records over several lines
    spanning = multiline_files(spark, paths) if fmt == "csv" and paths else []
    for path in paths:
        stem = _stem(path)
        if fmt == "csv":
            there = any(_decoded(f).startswith(_decoded(path)) for f in spanning)
            out[stem] = read_csv(spark, path, schemas.get(stem), order_column=order_column, multi_line=there)
        else:
            out[stem] = spark.read.parquet(path)
    return out


class Catalog(Mapping):
    """Tables of several source folders by name, in two levels: ``group.table``.

    Equal names in two groups stay apart. A bare table name finds the one table
    of that name and is an error when there are several.
    """

    def __init__(self, spark: SparkSession, groups: Mapping[str, Mapping[str, DataFrame]]):
        self.spark = spark
        self._frames = {f"{g}.{t}": df for g, tables in groups.items() for t, df in tables.items()}

    @classmethod
    def read(cls, spark: SparkSession, root: str, groups: Iterable[str], schemas: dict[str, T.StructType] | None = None,
             order_column: str | None = None) -> "Catalog":
        """One group per sub-folder of ``root``."""
        root = root.rstrip("/")
        return cls(spark, {g: read_catalog(spark, f"{root}/{g}", schemas, order_column=order_column) for g in groups})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        found = [k for k in self._frames if k.split(".", 1)[1] == name]
        if len(found) > 1:
            raise ValueError(f"{name} is in several groups: {sorted(found)}")
        if not found:
            raise KeyError(name)
        return self._frames[found[0]]

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def sql(self, text: str, **params) -> DataFrame:
        """A query in which {group.table} stands for a table; nothing is registered in the session."""
        names = sorted(set(re.findall(r"\{([^{}]+)\}", text)) - set(params))
        for i, name in enumerate(names):
            text = text.replace("{" + name + "}", f"{{catalog_{i}}}")
        return self.spark.sql(text, **params, **{f"catalog_{i}": self[n] for i, n in enumerate(names)})

    def register(self, prefix: str = "") -> list[str]:
        """Temporary views ``<prefix><group>__<table>`` of this session, so plain SQL finds the tables by name."""
        views = []
        for name, df in self._frames.items():
            views.append(prefix + re.sub(r"[^0-9A-Za-z_]", "_", name.replace(".", "__", 1)))
            if len(set(views)) < len(views):
                raise ValueError(f"two tables would be the view {views[-1]}")
            df.createOrReplaceTempView(views[-1])
        return views


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Empty typed table, the fallback when a source is absent."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, want: dict[str, T.DataType], defaults: dict | None = None) -> DataFrame:
    """Schema conformance (S9): keep the wanted columns in order, add the
    missing ones as typed nulls (or a default literal)."""
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for name, dtype in want.items():
        if name in have:
            cols.append(F.col(f"`{name}`").cast(dtype).alias(name) if dtype is not None
                        else F.col(f"`{name}`"))
        else:
            lit = F.lit(defaults.get(name))
            cols.append((lit.cast(dtype) if dtype is not None else lit).alias(name))
    return df.select(*cols)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, table: str | None = None) -> int:
    """Replace a table (S6) and report the rows written.

    The row count comes from ``DataFrame.observe`` during the write itself, so
    no second pass over the data is needed.
    """
    from pyspark.sql import Observation

    obs = Observation(f"rows_{abs(hash(path)) % 10**8}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        w.option("path", path).saveAsTable(table)
    else:
        w.save(path)
    return int(obs.get["rows"])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> int:
    """CSV sink with a header and no index.

    Each task writes its own part. ``single_file`` is the caller's word that the
    table is small (a report): its rows then pass through one task.
    """
    if single_file:
        df = df.coalesce(1)
    from pyspark.sql import Observation

    obs = Observation(f"csv_{abs(hash(path)) % 10**8}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
        .option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return int(obs.get["rows"])
