"""CSV files to typed tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwise.functions.text import na_to_null, number_to_string
from cartwise.schemas import ENTITIES, Entity, entity_for, shared_prefixes
from cartwise.session import materialise


def table_name(file_name: str) -> str:
    """Table a file feeds: the name without ``.csv`` and without ``_dataset``."""
    return file_name.removesuffix(".csv").replace("_dataset", "")


def list_csv(spark: SparkSession, folder: str) -> dict[str, str]:
    """File name -> path of every ``*.csv`` file (or part folder) in ``folder``."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/*.csv")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return {s.getPath().getName(): s.getPath().toString() for s in fs.globStatus(pattern) or []}


def strip_header(df: DataFrame) -> DataFrame:
    """Strip blanks around column names; values stay as they are."""
    return df.toDF(*[name.strip() for name in df.columns])


def nulls_from_tokens(df: DataFrame) -> DataFrame:
    """Turn missing-value tokens into nulls in every text column."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])


def cast_to(df: DataFrame, schema: T.StructType, rejects: Observation | None = None) -> DataFrame:
    """Cast text columns to the declared types; a value that does not parse gives null.

    Columns outside the schema are kept. Whole numbers written with decimals
    (``40.0``) are accepted for integer columns, fractions (``40.7``) are not. With ``rejects``, the values that
    did not parse are counted per column while the table is written; no extra pass
    is needed.
    """
    declared = _converted(df, schema)

    def typed(name: str) -> Column:
        dtype, column = declared.get(name), F.col(name)
        if dtype is None:
            return column
        if isinstance(dtype, (T.IntegerType, T.LongType)):
            number = column.try_cast("double")
            return F.coalesce(column.try_cast(dtype), F.when(number == F.floor(number), number).try_cast(dtype)).alias(name)
        return column.try_cast(dtype).alias(name)

    if rejects is not None and declared:
        df = df.observe(rejects, *[F.count_if(F.col(c).isNotNull() & typed(c).isNull()).alias(c) for c in declared])
    return df.select(*[typed(c) for c in df.columns])


def cast_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column, how many present values do not parse as the declared type (one pass)."""
    columns = list(_converted(df, schema))
    typed = cast_to(df.select(*columns, *[F.col(c).alias(f"{c}__raw") for c in columns]), schema)
    counts = typed.agg(*[F.count_if(F.col(f"{c}__raw").isNotNull() & F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "rejected")


def _converted(df: DataFrame, schema: T.StructType) -> dict[str, T.DataType]:
    """The columns that do not stay text, with their types."""
    return {f.name: f.dataType for f in schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)}


def read_raw(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Every column as text, header stripped, missing-value tokens null."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multiline)
    if not multiline:
        return nulls_from_tokens(strip_header(reader.csv(path)))
    schema = reader.csv(path).schema  # reads the header alone
    parsed = F.from_csv("record", _ddl(schema), CSV_OPTIONS)
    rows = csv_records(spark, path).where("NOT header").select(parsed.alias("row"))
    return nulls_from_tokens(strip_header(rows.select("row.*")))


CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
#: What stands inside quotes, and whole fields with the comma behind them; possessive, since neither can end elsewhere.
_QUOTED = r'(?:[^"]++|"")*+'
_FIELDS = rf'(?:[^",][^,]*+,|,|"{_QUOTED}"[^,]*+,)*+'


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record, header``: the records of a CSV whose quoted fields hold line breaks, read by many tasks.

    Every line is a map from the state it is entered in (outside or inside quotes) to the one it leaves. A split of a
    file composes the maps of its lines, and the composed maps of the splits before it say how it is entered; only
    then is a line known to begin a record or to go on with one. Only records of several lines are put
    together in a shuffle. A line ends with a line feed, with or without a carriage return, and a quoted line break is a line
    feed in the record; empty lines are skipped; a quote that never closes takes the rest of its file. A record is held whole by one task.
    """
    place = {"file": F.col("_metadata.file_path"), "split": F.col("_metadata.file_block_start")}
    lines = spark.read.option("lineSep", "\n").text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), *[c.alias(n) for n, c in place.items()], F.monotonically_increasing_id().alias("at"))
    from_outside = F.col("value").rlike(rf'^{_FIELDS}"{_QUOTED}$').cast("int")
    from_inside = F.col("value").rlike(rf'^{_QUOTED}(?:$|"[^,]*+,{_FIELDS}"{_QUOTED}$)').cast("int")
    # A line that has no quote keeps the state; one map in four turns it, the others set it.
    lines = lines.withColumns({"o": from_outside, "i": from_inside})
    lines = lines.withColumns({"turns": ((F.col("o") == 1) & (F.col("i") == 0)).cast("int"), "sets": F.when(F.col("o") == F.col("i"), F.col("o"))})
    in_split = W.partitionBy("file", "split").orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)
    lines = lines.withColumn("turned", F.sum("turns").over(in_split) % 2)
    # The last line that sets the state, less the turns up to it; the turns since then follow from those up to here.
    lines = lines.withColumn("set", F.last(F.col("sets").bitwiseXOR(F.col("turned").cast("int")), ignorenulls=True).over(in_split))
    split = lines.groupBy("file", "split").agg(F.max_by("turned", "at").alias("turned"), F.max_by(F.struct("set"), "at").alias("set"))
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, W.currentRow)
    # One row for each split of a file.
    split = split.withColumn("turns", F.sum("turned").over(upto) % 2)
    exits = F.col("set.set").bitwiseXOR(F.col("turned").cast("int")).bitwiseXOR(F.col("turns").cast("int"))
    entered = F.coalesce(F.last(exits, ignorenulls=True).over(before), F.lit(0))
    split = split.withColumn("entered", entered.bitwiseXOR(F.coalesce(F.sum("turned").over(before) % 2, F.lit(0)).cast("int")))
    split = materialise(split.select("file", "split", "entered"), "csv-splits")
    lines = lines.join(split, ["file", "split"])
    leaves = F.coalesce(F.col("set"), F.col("entered")).bitwiseXOR(F.col("turned").cast("int"))
    lines = lines.withColumn("leaves", leaves)
    step = W.partitionBy("file", "split").orderBy("at")
    lines = lines.withColumn("enters", F.coalesce(F.lag("leaves").over(step), F.col("entered")))
    lines = lines.withColumn("first", (F.col("enters") == 0).cast("int"))
    lines = lines.withColumn("number", F.sum("first").over(in_split)).select("value", "file", "split", "at", "first", "leaves", "number")
    lines = materialise(lines, "csv-lines")
    whole = lines.where("first = 1 AND leaves = 0").select("file", "split", "number", F.col("value").alias("record"))
    # Lines before a split's first record go on with the last record of the nearest split before that has one.
    counts = lines.groupBy("file", "split").agg(F.max("number").alias("records"))
    owner = F.last(F.when(F.col("records") > 0, F.struct(F.col("split").alias("s"), F.col("records").alias("r"))), ignorenulls=True).over(before)
    owners = materialise(counts.withColumn("owner", owner).select("file", "split", "owner"), "csv-owners")
    parts = lines.where("first = 0 OR leaves = 1").join(owners, ["file", "split"])
    of = F.when(F.col("number") > 0, F.struct(F.col("split").alias("s"), F.col("number").alias("r"))).otherwise(F.col("owner"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "at", "value"))), lambda p: p.value), "\n")
    parts = parts.groupBy("file", of.alias("of")).agg(joined.alias("record"))
    records = whole.unionByName(parts.select("file", F.col("of.s").alias("split"), F.col("of.r").alias("number"), "record"))
    records = records.where("record <> ''")
    return records.select("record", (F.struct("split", "number") == F.struct(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("header"))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema.fields)


def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type text columns by their values, missing ones aside: whole numbers, numbers, truth values, else text.

    A column without any value stays text. One pass reads the columns; hand in a written table.
    """
    if not columns:
        return df
    # Every number starts so. A cast that fails is a raised and caught error, so only values of the right form are cast.
    number = r"(?s)^[\x00-\x20]*[+-]?[0-9.iInN]"
    kinds = {"bigint": r"^\s*[+-]?\d+\s*$", "double": number, "boolean": r"(?i)^\s*(true|false)\s*$"}

    def misfit(c: str, kind: str, pattern: str) -> Column:
        column = F.col(f"`{c}`")
        return F.count_if(column.isNotNull() & F.when(column.rlike(pattern), column.try_cast(kind)).isNull())

    checks = [misfit(c, k, p).alias(f"{i} {k}") for i, c in enumerate(columns) for k, p in kinds.items()]
    counts = df.agg(*checks, *[F.count(f"`{c}`").alias(f"{i} n") for i, c in enumerate(columns)]).first()
    found = {}
    for i, c in enumerate(columns):
        fitting = [k for k in kinds if counts[f"{i} n"] and not counts[f"{i} {k}"]]
        if fitting:
            found[c] = fitting[0]
    return df.select(*[F.col(f"`{c}`").try_cast(found[c]).alias(c) if c in found else F.col(f"`{c}`") for c in df.columns])


def read_tables(spark: SparkSession, paths: list[str], entity: Entity | None, rejects: Observation | None = None) -> DataFrame:
    """The CSV files of one table as one typed table.

    Declared columns get their declared types, so codes such as zip prefixes stay text with
    their leading zeros. The types of all others are inferred once missing-value tokens are null.
    """
    parts = [read_raw(spark, p, entity is None or entity.multiline) for p in paths]
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    declared = set(entity.schema.names) if entity else set()
    free = [c for c in raw.columns if c not in declared]
    typed = infer_types(materialise(raw, "csv"), free) if free else raw
    if entity is None:
        return typed
    typed = cast_to(typed, entity.schema, rejects)
    # A whole number kept as text has no decimals, however the file writes it.
    plain = {c: F.coalesce(number_to_string(F.col(c).try_cast("double")), F.col(c)) for c in entity.counts if c in typed.columns}
    return typed.withColumns(plain) if plain else typed


@dataclass(frozen=True)
class Source:
    """A table to be: its name, the declared table it stands for, and its files."""

    name: str
    entity: Entity | None
    paths: tuple[str, ...]


def sources(spark: SparkSession, folder: str, file_name: str | None = None) -> list[Source]:
    """The tables of a folder's CSV files, or of one file of it; every file belongs to exactly one.

    Files of one declared table are its parts; every other file is a table of its own, named after it.
    A named file that is missing is reported and skipped.
    """
    files = list_csv(spark, folder)
    prefixes = shared_prefixes([table_name(f) for f in files])
    if file_name is not None and file_name not in files:
        print(f"{file_name}: not found in {folder}, skipped")
        return []
    grouped: dict[tuple[str, bool], list[str]] = {}
    for name, path in sorted(files.items()):
        if file_name in (None, name):
            entity = entity_for(table_name(name), prefixes)
            grouped.setdefault((entity.name if entity else table_name(name), entity is not None), []).append(path)
    return [Source(name, ENTITIES[name] if known else None, tuple(paths)) for (name, known), paths in grouped.items()]


def read_folder(
    spark: SparkSession, folder: str, file_name: str | None = None, rejects: dict[str, Observation] | None = None
) -> dict[str, DataFrame]:
    """Table name -> table for every CSV in ``folder``, or for one file of it (see :func:`sources`).

    ``rejects`` is filled with one observation per table that has casts; it holds the counts once the table was
    written.
    """
    result = {}
    for source in sources(spark, folder, file_name):
        observation = Observation() if rejects is not None else None
        result[source.name] = read_tables(spark, list(source.paths), source.entity, observation)
        if rejects is not None and source.entity and _converted(result[source.name], source.entity.schema):
            rejects[source.name] = observation
    return result
