"""Delimited text tables: scan, parse report and sink.

Every file's own header line says which column stands where, so files of one
folder may order their columns differently or lack some. Text is read
with an all-string schema (no inference pass) one field wider than the
longest header, which makes the reader hand over the raw text of all shorter
records; their fields are counted outside quotes. The default CSV
missing-value tokens become null with one ``isin``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.session import stored

CORRUPT = "_corrupt_record"
STRETCH_BITS = 12  # 4,096 lines of a split are one stretch
MAX_LINES = 10_000  # lines of a record; more are taken for a quote that is never closed


def na_to_null(c: Column, tokens=fixed.NA_TOKENS) -> Column:
    """Missing-value tokens of a default CSV reader become null."""
    return F.when(~c.isin(*tokens), c)


def field_count(raw: Column, delimiter: str = ",", quote: str | None = '"') -> Column:
    """How many fields a record has; delimiters within a quoted field do not count."""
    sep = re.escape(delimiter)
    if quote:
        q = re.escape(quote)
        raw = F.regexp_replace(raw, f"(^|{sep}){q}[^{q}]*+(?:{q}{q}[^{q}]*+)*{q}(?={sep}|$)", "$1")
    return F.size(F.split(raw, sep, -1))


def header_lines(spark: SparkSession, path: str, delimiter: str = ",", quote: str | None = '"') -> DataFrame:
    """``(file, names)``, the column names in each file's first line."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("n"))
    # the set makes Spark hash by file: least texts alone would be found by sorting all lines of a file's first split
    first = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "n").alias("line"), F.collect_set(F.lit(True)).alias("seen"))
    first = first.where(F.size("seen") > 0)
    sep, line = re.escape(delimiter), F.regexp_replace("line", "^\ufeff|\r$", "")
    if not quote:
        return first.select("file", F.split(line, sep, -1).alias("names"))
    q = re.escape(quote)
    parts = F.split(line, f"{sep}(?=(?:[^{q}]*{q}[^{q}]*{q})*[^{q}]*$)", -1)
    bare = F.transform(parts, lambda x: F.replace(F.regexp_replace(x, f"^{q}|{q}$", ""), F.lit(quote * 2), F.lit(quote)))
    return first.select("file", bare.alias("names"))


def column_catalogue(headers: DataFrame) -> DataFrame:
    """``(file, ordinal, raw_name)`` of each file's columns."""
    return headers.select("file", F.posexplode("names").alias("ordinal", "raw_name"))


def read_records(spark: SparkSession, path, quote: str = '"', max_lines: int = MAX_LINES) -> DataFrame:
    """``(file, record_no, record, closed)``: records whose quoted fields may hold line breaks, whatever splits the files have.

    A line opens a record if an even number of quotes stands before it in its file. Quotes are summed over
    stretches of lines, the sums of a file's stretches are added up in order, and each line takes its parity
    from both, so a file is never one task and most records never leave their stretch. Lines of a record that spans
    some are put together with line feeds between them. A quote that is never closed would swallow the rest of its
    file: past ``max_lines`` each line is a record of its own, with ``closed`` false. RFC 4180 knows
    no lone quote in a field without quotes; here it counts as one that opens.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("n"))
    q = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    lines = lines.withColumns({"q": (q / len(quote)).cast("int") % 2, "stretch": F.shiftright("n", STRETCH_BITS)})
    so_far = Window.partitionBy("file", "at", "stretch").orderBy("n")
    lines = lines.withColumn("odd", (F.sum("q").over(so_far) - F.col("q")) % 2)
    lines = lines.withColumns({f"opens{k}": F.sum((F.col("odd") == k).cast("long")).over(so_far) for k in (0, 1)})
    sums = lines.groupBy("file", "at", "stretch").agg(
        F.sum("q").alias("qs"), F.max("opens0").alias("all0"), F.max("opens1").alias("all1"))
    order = Window.partitionBy("file").orderBy("at", "stretch")
    sums = sums.withColumn("before", (F.sum("qs").over(order) - F.col("qs")) % 2)
    opened = F.when(F.col("before") == 0, F.col("all0")).otherwise(F.col("all1"))
    sums = stored(sums.select(F.col("file").alias("f"), F.col("at").alias("a"), F.col("stretch").alias("s"), "before",
                              (F.sum(opened).over(order) - opened).alias("records_before")))
    here = F.when(F.col("before") == 0, F.col("opens0")).otherwise(F.col("opens1"))
    placed = lines.join(sums, (F.col("file") == F.col("f")) & (F.col("at") == F.col("a")) & (F.col("stretch") == F.col("s"))).select(
        "file", (F.col("records_before") + here - 1).alias("record_no"), F.struct("at", "n", "line").alias("l"),
        ((F.col("odd") + F.col("before")) % 2 == 1).alias("inside"), "q")
    whole = placed.where("NOT inside AND q = 0").select("file", "record_no", "l.line", F.lit(True).alias("closed"))
    parts = placed.where("inside OR q = 1")
    counts = parts.groupBy(F.col("file").alias("f"), F.col("record_no").alias("r")).agg(
        F.count("*").alias("lines"), (F.sum("q") % 2 == 0).alias("closed"))
    parts = parts.join(counts, (F.col("file") == F.col("f")) & (F.col("record_no") == F.col("r")))
    fits = F.col("lines") <= max_lines
    joined = parts.where(fits).groupBy("file", "record_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("line"), F.first("closed").alias("closed"))
    alone = parts.where(~fits).select("file", "record_no", "l.line", F.lit(False).alias("closed"))
    out = whole.unionByName(joined).unionByName(alone)
    return out.select("file", "record_no", F.regexp_replace("line", "\r$", "").alias("record"), "closed")


def read_text_table(spark: SparkSession, path, columns: list[str] | None = None, delimiter: str = ",",
                    header: bool = True, quote: str | None = '"', na_tokens=fixed.NA_TOKENS,
                    multi_line: bool = False) -> DataFrame:
    """S1 + S2: all-string scan with ``file``, the named columns, and each record's ``_fields`` of ``_expected``.

    With a header, values are matched to ``columns`` (default: every name in any file, in order of name)
    by the header of their own file; a column that a file lacks is null there. Without, ``columns`` are
    the fields in order. No row is lost: short records are padded with nulls, fields beyond the
    header are cut, and both carry their raw text in ``_corrupt_record``. A quote within a quoted field is doubled.
    ``multi_line`` lets a quoted field hold line breaks; files are still read in splits.
    """
    if header:
        heads = stored(header_lines(spark, path, delimiter, quote))
        width = heads.agg(F.max(F.size("names"))).first()[0] or 1
        if columns is None:  # a schema must be known before rows are read
            columns = [r["c"] for r in heads.select(F.explode("names").alias("c")).distinct().orderBy("c").collect()]
    else:
        width = len(columns)
    slots = [f"_p{i}" for i in range(width + 1)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*slots, CORRUPT]])
    quoting = {"quote": "\u0000"} if quote is None else {"quote": quote, "escape": quote}
    if multi_line and quote:
        records = read_records(spark, path, quote).where("record <> ''")
        if header:
            records = records.where("record_no > 0")
        # one field more than any header, so that nothing is said to be malformed: fields are counted below
        fields = F.from_csv("record", T.StructType(schema.fields[:-1]).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                            {"sep": delimiter, "mode": "PERMISSIVE", "maxCharsPerColumn": "-1", **quoting})
        df = records.select("file", F.array(*(fields[c] for c in slots)).alias("_v"), F.col("record").alias(CORRUPT), "closed")
        counted = F.when(F.col("closed"), field_count(F.col(CORRUPT), delimiter, quote)).otherwise(width + 1)
        df = df.select("file", "_v", CORRUPT, counted.alias("_fields"))
    else:
        r = (
            spark.read.schema(schema)
            .option("header", header)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("sep", delimiter)
            .option("encoding", "UTF-8")
            .option("recursiveFileLookup", "true")
            .option("columnPruning", "false")  # a pruned reader does not see that a record is short
            .options(**quoting)
        )
        # a record without raw text fills every slot; said of the slots, as the reader refuses to read raw text alone
        filled = F.greatest(F.size(F.array_compact(F.array(*slots))), F.lit(width + 1))
        df = r.csv(path).select(F.col("_metadata.file_path").alias("file"), F.array(*slots).alias("_v"), F.col(CORRUPT),
                                F.coalesce(field_count(F.col(CORRUPT), delimiter, quote), filled).alias("_fields"))
    raw = F.col(CORRUPT)
    if header:
        df = df.join(heads.withColumnRenamed("file", "_head_of"), F.col("file") == F.col("_head_of"), "left")
        expected, place = F.size("names"), lambda i, c: F.array_position("names", c) - 1
    else:
        expected, place = F.lit(width), lambda i, c: F.lit(i)
    value = lambda i, c: F.when(place(i, c) >= 0, F.get("_v", place(i, c).cast("int")))
    cols = [(na_to_null(value(i, c), na_tokens) if na_tokens else value(i, c)).alias(c) for i, c in enumerate(columns)]
    return df.select("file", *cols, "_fields", expected.alias("_expected"), F.when(F.col("_fields") != expected, raw).alias(CORRUPT))


def parse_report(df: DataFrame, columns: list[str], keys=("file",)) -> DataFrame:
    """S2 + V4 + A2: rows, short rows (padded), long rows (rejected by a strict reader), empty rows, per file."""
    empty = F.coalesce(*[F.col(f"`{c}`") for c in columns]).isNull()
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_fields") < F.col("_expected")).alias("short_rows"),
        F.count_if(F.col("_fields") > F.col("_expected")).alias("long_rows"),
        F.count_if(empty).alias("empty_rows"),
    )
    return agg.select(*keys, "rows", "short_rows", "long_rows", "empty_rows",
                      (F.col("long_rows") == 0).alias("parseable"), (F.col("short_rows") + F.col("long_rows") == 0)
                      .alias("equal_field_counts"))


def utf8_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, passed)``, whether every line of a file is UTF-8 (a broken sequence cannot span a line break)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.bool_and(F.is_valid_utf8("value")).alias("passed"))


def write_csv(df: DataFrame, path: str, line_ending: str = "unix", na: str = "", partition_by=None) -> None:
    """Header, UTF-8, no index, LF or CRLF, missing values written as ``na``.

    Fields with a delimiter, quote or line break are quoted, quotes in them doubled; white space stays.
    """
    out = df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(na)).alias(c) for c in df.columns])
    w = (
        out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
        .option("lineSep", "\r\n" if line_ending == "windows" else "\n").option("emptyValue", "").option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_json_report(df: DataFrame, path: str, partition_by=None) -> None:
    """Nested report rows as JSON lines (Parquet stays the primary form)."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).json(path)
