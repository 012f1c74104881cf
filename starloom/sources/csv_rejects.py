"""SC9: CSV tables with a reject channel.

Lines that do not fit the declared schema neither become rows of nulls nor end the load: they go to a typed reject table with the table,
the line and the reason. The manifest written beside the tables holds the row count and an order-free fingerprint of each table's lines, so
a load can tell lost, doubled and altered lines before it uses them, whatever the files' order and number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.csv_dataset import CSV_OPTIONS

REJECTS = "table string, line string, reason string"
_LINE = "_corrupt_line"
_FROM_CSV = {**CSV_OPTIONS, "header": "false"}


def _schema(ddl: str | T.StructType) -> T.StructType:
    return ddl if isinstance(ddl, T.StructType) else T.StructType.fromDDL(ddl)


def read_checked(spark: SparkSession, folder: str, name: str, ddl: str | T.StructType,
                 header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that fit ``ddl``, rejects). A line is rejected for its number of columns, for the first column whose value is not of its type, or
    for the first NOT NULL column that is empty."""
    schema = _schema(ddl)
    # Lines are parsed whole: the CSV source would parse the asked columns only and then miss what is wrong with a line.
    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema, T.StructField(_LINE, T.StringType())])
    lines = spark.read.text(f"{folder.rstrip('/')}/{name}").where(F.col("value") != "")
    if header:
        lines = lines.where(F.col("value") != ",".join(f.name for f in schema))
    read = lines.select(F.from_csv("value", held, {**_FROM_CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE}).alias("_r"), "value").select("_r.*", "value")
    empty = F.lit(None).cast("string")
    for f in reversed(schema.fields):
        if not f.nullable:
            empty = F.when(F.col(f.name).isNull(), F.lit(f"{f.name}: empty")).otherwise(empty)
    good = read.where(F.col(_LINE).isNull() & empty.isNull()).select(*[f.name for f in schema])
    reason = F.when(F.col(_LINE).isNotNull(), _fault(F.col(_LINE), schema)).otherwise(empty)
    bad = read.where(F.col(_LINE).isNotNull() | empty.isNotNull())
    return good, bad.select(F.lit(name).alias("table"), F.col("value").alias("line"), reason.alias("reason"))


def _fault(line: Column, schema: T.StructType) -> Column:
    """Why a line does not fit: read again as text, a column too many or too few, or a value that its type does not take."""
    n = len(schema)
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(n + 1)])
    told = F.from_csv(line, texts.simpleString()[7:-1].replace(":", " "), _FROM_CSV)
    # A quoted separator is no separator: quoted fields are taken out before they are counted.
    columns = F.size(F.split(F.regexp_replace(line, '"(?:[^"\\\\]|\\\\.)*"', ""), ",", -1))
    out = F.lit("malformed")
    for i, f in reversed(list(enumerate(schema.fields))):
        if not isinstance(f.dataType, T.StringType):
            value = told[f"c{i}"]
            kind = f.dataType.simpleString()
            fits = F.from_csv(value, f"v {kind}", _FROM_CSV)["v"]
            out = F.when(value.isNotNull() & (value != "") & fits.isNull(), F.lit(f"{f.name}: not a {kind}")).otherwise(out)
    return F.when(columns != n, F.concat(columns.cast("string"), F.lit(f" columns instead of {n}"))).otherwise(out)


def line_fingerprint(lines: DataFrame) -> DataFrame:
    """One row: the number of lines and two sums of hash halves that do not depend on their order or files."""
    h = F.xxhash64("value")
    return lines.agg(F.count(F.lit(1)).cast("long").alias("rows"), F.coalesce(F.sum(h.bitwiseAND(0xFFFFFFFF)), F.lit(0)).cast("long").alias("low"),
                     F.coalesce(F.sum(F.shiftrightunsigned(h, 32)), F.lit(0)).cast("long").alias("high"))


def _lines(spark: SparkSession, folder: str, name: str, header: str) -> DataFrame:
    return spark.read.text(f"{folder.rstrip('/')}/{name}").where(F.col("value") != header)


def write_checked(tables: dict[str, DataFrame], folder: str) -> None:
    """Write each table as CSV, then ``_checksums`` with what is on storage: header, rows and fingerprint of each table."""
    manifest = None
    for name, df in tables.items():
        df.write.mode("overwrite").options(**CSV_OPTIONS).csv(f"{folder}/{name}")
        header = ",".join(df.columns)
        row = line_fingerprint(_lines(df.sparkSession, folder, name, header)).select(F.lit(name).alias("table"), F.lit(header).alias("header"), "*")
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/_checksums")


def check_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """table, rows in the manifest, rows found, and whether lines are as they were written."""
    told = spark.read.schema("table string, header string, rows long, low long, high long").json(f"{folder}/_checksums")
    out = None
    for r in told.collect():        # one row a table
        found = line_fingerprint(_lines(spark, folder, r.table, r.header))
        row = found.select(F.lit(r.table).alias("table"), F.lit(r.rows).cast("long").alias("rows_written"), F.col("rows").alias("rows_found"),
                           ((F.col("rows") == r.rows) & (F.col("low") == r.low) & (F.col("high") == r.high)).alias("unchanged"))
        out = row if out is None else out.unionByName(row)
    return out


def load_table(spark: SparkSession, folder: str, name: str, ddl: str | T.StructType) -> tuple[DataFrame, DataFrame]:
    """``read_checked`` after the manifest: a table whose lines are not as they were written is refused."""
    state = {r.table: r for r in check_manifest(spark, folder).collect()}
    if name not in state:
        raise ValueError(f"{name} is not in the manifest of {folder}")
    if not state[name].unchanged:
        raise ValueError(f"{name}: {state[name].rows_found} lines do not match the manifest's {state[name].rows_written}")
    return read_checked(spark, folder, name, ddl)
