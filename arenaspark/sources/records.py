"""CSV records that hold quoted line breaks (S1, S3), read in parallel and in file order.

Spark's own multi-line reader reads a file in one task. Here files are split
into blocks of lines as for any text. A line break is inside a record when the
quotes before it are odd in number: counts per block give each block's starting
parity, lines count on from there, and only the lines of records that span
lines are put together. A record may reach over block edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, file, block, row, odd): lines with their place in the source and whether they hold an odd number of quotes."""
    raw = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return raw.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), (quotes % 2).alias("odd"))


def multiline_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files in which some line holds an odd number of quotes: only these can have records over several lines."""
    return [r.file for r in text_lines(spark, path).where("odd = 1").select("file").distinct().collect()]


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(record, file, block, row, first): one row per record, with the place of its first line;
    ``first`` marks each file's first record (its header). Empty lines between records are skipped."""
    lines = text_lines(spark, path)
    in_block = Window.partitionBy("file", "block").orderBy("row")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    up_to = in_block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per block: parity at its start
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.sum("odd").alias("quotes"))
    opening = blocks.select("file", "block", (F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2).alias("opening"))
    placed = lines.join(opening, ["file", "block"])
    starts = (F.col("opening") + F.coalesce(F.sum("odd").over(before), F.lit(0))) % 2 == 0
    placed = placed.withColumns({"starts": starts, "nth": F.row_number().over(in_block)})
    own = F.max(F.when(F.col("starts"), F.col("row"))).over(up_to)
    placed = placed.withColumns({"start_row": own, "first": F.col("starts") & (F.col("nth") == 1) & (F.col("block") == 0)})

    single = placed.where("starts and odd = 0 and trim(both '\r' from line) <> ''").select(
        F.rtrim(F.col("line"), F.lit("\r")).alias("record"), "file", "block", "row", "first")
    part = placed.where("not starts or odd = 1")
    # lines before a block's first start belong to the last record begun in an earlier block
    last = (placed.groupBy("file", "block").agg(F.max(F.when(F.col("starts"), F.struct("block", "row"))).alias("last"))
            .select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("carried")))
    part = part.join(last, ["file", "block"]).withColumn(
        "of", F.when(F.col("start_row").isNotNull(), F.struct("block", F.col("start_row").alias("row"))).otherwise(F.col("carried")))
    whole = part.groupBy("file", "of").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "line"))).alias("lines"), F.max("first").alias("first"))
    joined = whole.select(F.rtrim(F.array_join("lines.line", "\n"), F.lit("\r")).alias("record"), "file",
                          F.col("of.block").alias("block"), F.col("of.row").alias("row"), "first")
    return single.unionByName(joined)


def read_records(spark: SparkSession, path: str | list[str], columns: list[str]) -> DataFrame:
    """The ``columns`` of every record as text, and file, block and row of its first line. Headers are left out, short records padded."""
    ddl = ", ".join(f"`c{i}` string" for i in range(len(columns)))
    parsed = F.from_csv("record", ddl, {"escape": QUOTE, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    rows = records(spark, path).where("not first").select(parsed.alias("v"), "file", "block", "row")
    return rows.select(*[F.col(f"v.c{i}").alias(c) for i, c in enumerate(columns)],
                       *[F.col(c).alias(f"__{c}") for c in ("file", "block", "row")])

