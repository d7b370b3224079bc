"""Nightly sales exports in three dialects, ledgers and masters."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyleaf import schemas
from tallyleaf.session import cut_lineage

# Which till generation a store runs, by the store token of the file name.
SEMICOLON_STORES = ("S06", "S07", "S08", "S09")
EPOCH_STORES = ("S10", "S11", "S12")


def _day_first_ts(raw: Column) -> Column:
    parsed = F.try_to_timestamp(raw, F.lit("dd-MM-yyyy HH:mm:ss"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"), raw)


def _epoch_ts(raw: Column) -> Column:
    seconds = F.trim(raw).try_cast("bigint")
    # Arithmetic on a zoneless timestamp gives UTC in any session time zone.
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    return F.coalesce(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), raw)


def _store_of(file_name: Column) -> Column:
    return F.split(file_name, "_")[1]


def _read(reader, paths, schema, sep):
    reader = reader.schema(schema).option("header", True).option("sep", sep).option("encoding", "UTF-8")
    return reader.csv(paths).withColumn("file_name", F.col("_metadata.file_name"))


def _typed(lines: DataFrame, ts: Column) -> DataFrame:
    return lines.select(
        F.trim("bill_no").alias("bill_no"),
        F.trim("line_no").cast("int").alias("line_no"),
        F.trim("product_code").alias("product_code"),
        F.trim("qty").cast(schemas.QTY).alias("qty"),
        F.trim("unit_price").cast(schemas.MONEY).alias("unit_price"),
        F.trim("line_type").alias("line_type"),
        ts.alias("ts"),
        "file_name",
    )


def read_comma(spark: SparkSession, paths, reader=None) -> DataFrame:
    """Comma separated, ISO timestamps."""
    return _typed(_read(reader or spark.read, paths, schemas.COMMA_EXPORT, ","), F.trim("ts"))


def read_semicolon(spark: SparkSession, paths, reader=None) -> DataFrame:
    """Semicolon separated, renamed columns, day-first timestamps."""
    lines = _read(reader or spark.read, paths, schemas.SEMICOLON_EXPORT, ";").withColumnsRenamed(schemas.SEMICOLON_NAMES)
    return _typed(lines, _day_first_ts(F.trim("ts")))


def read_epoch(spark: SparkSession, paths, reader=None) -> DataFrame:
    """Comma separated with a byte order mark, other column order, epoch seconds."""
    return _typed(_read(reader or spark.read, paths, schemas.EPOCH_EXPORT, ","), _epoch_ts(F.col("ts")))


def read_parquet_days(spark: SparkSession, paths) -> DataFrame:
    """Days exported as Parquet, with the columns of the comma dialect."""
    lines = spark.read.parquet(paths).withColumn("file_name", F.col("_metadata.file_name"))
    return _typed(lines, F.trim(F.col("ts").cast("string")))


def _matches(spark, pattern) -> bool:
    """Whether any file fits a glob pattern, asked of whatever store the path names."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return len(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []) > 0


def _dialects(read):
    """The lines of each dialect, from a function that applies a dialect's reader; each takes the files of its stores alone."""
    store = _store_of(F.col("file_name"))
    return [
        read(read_comma).where(~store.isin(*SEMICOLON_STORES, *EPOCH_STORES)),
        read(read_semicolon).where(store.isin(*SEMICOLON_STORES)),
        read(read_epoch).where(store.isin(*EPOCH_STORES)),
    ]


def stream_exports(spark: SparkSession, folder: str, files_per_batch=1000) -> DataFrame:
    """The CSV exports that arrive in a folder, as one stream of raw lines: a source per dialect, joined by name.

    Each line carries its file name, so a re-send is known whenever it comes. All sources see the same files in the same
    order, so they arrive in a batch together.
    """

    def read(dialect):
        reader = spark.readStream.option("pathGlobFilter", "SALES_*.csv").option("maxFilesPerTrigger", files_per_batch)
        return dialect(spark, folder, reader)

    return reduce(DataFrame.unionByName, _dialects(read))


def read_exports(spark: SparkSession, folder: str, formats=("csv", "parquet")) -> DataFrame:
    """All exports of a folder as one set of raw lines.

    The dialect follows from the store token of the file name; a token outside the lists means the comma
    dialect. The conditions are on file metadata, so a branch opens only its own files. A format without files is left
    out; a folder without any export is an error.
    """
    frames = []
    every_csv, every_parquet = f"{folder}/SALES_*.csv", f"{folder}/SALES_*.parquet"
    if "csv" in formats and _matches(spark, every_csv):
        frames += _dialects(lambda read: read(spark, every_csv))
    if "parquet" in formats and _matches(spark, every_parquet):
        frames.append(read_parquet_days(spark, every_parquet))
    if not frames:
        raise ValueError(f"no sales exports in {folder}")
    return reduce(DataFrame.unionByName, frames)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Signed-off monthly revenue."""
    return spark.read.schema(schemas.LEDGER).option("header", True).csv(path)


def read_master(spark: SparkSession, name: str, location: str, jdbc_options=None) -> DataFrame:
    """A master table, over JDBC in production or from Parquet under ``location``."""
    if jdbc_options is not None:
        return spark.read.jdbc(url=location, table=name, properties=jdbc_options)
    return spark.read.schema(schemas.MASTERS[name]).parquet(f"{location}/{name}")


def read_sql_inserts(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The rows of a table out of the INSERT statements of SQL text, by the column names of each statement or else by position.

    The text is read line by line in splits, and a statement may go on over any number of lines and splits. Strings may
    hold line ends, commas, brackets and doubled quotes, and comments may hold quotes. What a line is depends on those before it
    (whether it begins inside a string, which statement it goes on with); each split finds that out under both
    assumptions and a summary of one row per split settles them.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = cut_lineage(lines.withColumn("at", F.monotonically_increasing_id()))
    records = _records(lines)
    body = F.regexp_replace("text", r"(?s)('[^']*+')|--[^\n]*", "$1")
    records = records.withColumn("text", F.trim(body))
    opens = F.regexp_extract("text", _INSERT, 1)
    columns = F.regexp_extract("text", _INSERT, 2)
    ends = F.endswith("text", F.lit(";"))
    none = F.struct(F.lit("").alias("name"), F.lit("").alias("columns"))
    named = F.struct(F.lower(opens).alias("name"), F.lower(columns).alias("columns"))
    is_open = opens != ""
    # Behind a record: no statement if it ends one, the one it opens, or whatever went before.
    left = F.when(ends, none).when(is_open, named)
    carried = _carried(records.withColumn("left", left), "left")
    statement = F.when(is_open, named).otherwise(F.coalesce("before", none))
    own = carried.withColumn("statement", statement).where(F.col("statement.name") == name.lower())
    values = F.regexp_replace("text", "(?s)" + _INSERT, "")
    listed = own.select("statement", F.explode(F.regexp_extract_all(values, F.lit(_TUPLE), F.lit(1))).alias("row"))
    fields = spark.createDataFrame([], schema).schema
    given = F.split(F.regexp_replace("statement.columns", r'[\s"`]', ""), ",")
    cells = F.regexp_extract_all("row", F.lit(_FIELD), F.lit(1))
    rows = listed.select(given.alias("given"), (F.col("statement.columns") == "").alias("by_place"), F.transform(cells, _cell).alias("cells"))

    def field(no, f):
        place = F.when(F.col("by_place"), F.lit(no + 1)).otherwise(F.array_position("given", f.name.lower()).cast("int"))
        return F.when(place > 0, F.get("cells", place - 1)).cast(f.dataType).alias(f.name)

    return rows.select(*[field(no, f) for no, f in enumerate(fields)])


# A statement's table and columns; a bracketed row; the fields of a row, strings whole.
_INSERT = r"""(?i)^\s*insert\s+into\s+(?:\w+\.)?["`]?(\w+)["`]?\s*(?:\(([^)]*)\))?\s*values\b"""
_TUPLE = r"\(((?:[^'()]++|'[^']*+')*+)\)"
_FIELD = r"\G((?:[^',]++|'[^']*+')*+)(?:,|$)"
_STRING = r"(?s)^[^']*'(.*)'[^']*$"


def _cell(raw):
    """A field's text: a string without its quotes and type name, null as null, everything else as it stands."""
    text = F.trim(F.regexp_replace(raw, r"^\s+|\s+$", ""))
    quoted = F.replace(F.regexp_extract(text, _STRING, 1), F.lit("''"), F.lit("'"))
    return F.when(F.contains(text, F.lit("'")), quoted).when(F.lower(text) != "null", text)


def _records(lines):
    """(file, block, at, text): lines put together so that none begins inside a string.

    A line maps "begins inside a string" to "the next one does": it settles it, leaves it or turns it round. So a line's
    state is that of the last one that settled it, turned round as often as since then.
    """
    rest = r"'[^']*+'|--.*"
    if_out = F.contains(F.regexp_replace("value", rest, ""), F.lit("'"))
    if_in = F.contains(F.regexp_replace(F.concat(F.lit("'"), "value"), rest, ""), F.lit("'"))
    known = lines.withColumns({"if_out": if_out, "if_in": if_in})
    within = Window.partitionBy("file", "block").orderBy("at")
    turns = F.when(F.col("if_out") & ~F.col("if_in"), 1).otherwise(0)
    upto = F.sum(turns).over(within) % 2 == 1
    known = known.withColumn("turned", upto)
    settled = F.when(F.col("if_out") == F.col("if_in"), F.col("if_in") != F.col("turned"))
    known = known.withColumn("settled", F.last(settled, True).over(within))
    # Behind each split, given the state it begins in: settled (true or false), else turned round or not.
    ends = known.groupBy("file", "block").agg(F.max_by(F.struct("settled", "turned"), "at").alias("end"))
    splits = Window.partitionBy("file").orderBy("block")
    turned = F.sum(F.col("end.turned").cast("int")).over(splits) % 2 == 1
    ends = ends.withColumn("turned_by", turned)
    anchor = F.when(F.col("end.settled").isNotNull(), (F.col("end.settled") != F.col("end.turned")) != F.col("turned_by"))
    ends = ends.withColumn("after", F.coalesce(F.last(anchor, True).over(splits), F.lit(False)) != F.col("turned_by"))
    begins = ends.select("file", "block", F.coalesce(F.lag("after").over(splits), F.lit(False)).alias("first"))
    placed = known.join(begins, ["file", "block"])
    state = F.coalesce(F.col("settled"), F.col("first")) != F.col("turned")
    inside = F.coalesce(F.lag(state).over(within), F.col("first"))
    placed = placed.withColumn("inside", inside).withColumn("left", F.when(~F.col("inside"), F.struct("block", "at")))
    owned = _carried(placed.select("file", "block", "at", "value", "left"), "left")
    owned = owned.withColumn("own", F.coalesce("left", "before"))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "value")))
    joined = owned.groupBy("file", F.col("own.block").alias("block"), F.col("own.at").alias("at")).agg(parts.alias("parts"))
    return joined.select("file", "block", "at", F.array_join("parts.value", "\n").alias("text"))


def _carried(rows, name):
    """``rows`` with ``before``: the last value of a column that is not null among the rows before, in the order of the file."""
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = F.when(F.col(name).isNotNull(), F.struct(F.col("at"), F.col(name).alias("v")))
    last = rows.withColumn("v", own).groupBy("file", "block").agg(F.max_by("v", "v.at").alias("v"))
    # One row per split.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("file", "block", F.last("v.v", True).over(earlier).alias("handed"))
    found = rows.withColumn("before", F.last(name, True).over(within)).join(handed, ["file", "block"])
    return found.withColumn("before", F.coalesce("before", "handed")).drop("handed")


def convert_masters(spark: SparkSession, source: str, target: str, fmt="csv") -> None:
    """One-off load of the four masters into Parquet with declared schemas: from CSV extracts in a folder, or from one SQL text."""
    for name, schema in schemas.MASTERS.items():
        if fmt == "sql":
            rows = read_sql_inserts(spark, source, name, schema)
        else:
            rows = spark.read.schema(schema).option("header", True).csv(f"{source}/{name}.csv")
        rows.write.mode("overwrite").parquet(f"{target}/{name}")
