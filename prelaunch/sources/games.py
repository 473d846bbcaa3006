"""CSV catalogue scan (SRC1) typed by column name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prelaunch.functions.scalars import quoted
from prelaunch.sources.tables import require_path

# Types of the catalogue columns the library reads. Dates and list columns
# stay text here and are decoded by prelaunch.functions. Other columns of
# the file (the prepared table has about 50) pass through as strings.
GAMES_SCHEMA = T.StructType([
    T.StructField("game_id", T.LongType()),
    T.StructField("release_date", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("estimated_owners", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("required_age", T.DoubleType()),
    T.StructField("dlc_count", T.DoubleType()),
    T.StructField("achievements", T.DoubleType()),
    T.StructField("windows", T.BooleanType()),
    T.StructField("mac", T.BooleanType()),
    T.StructField("linux", T.BooleanType()),
    T.StructField("supported_languages", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("developers", T.StringType()),
    T.StructField("short_description", T.StringType()),
    T.StructField("detailed_features", T.StringType()),
    T.StructField("success", T.IntegerType()),
])


def _typed(c: str, kind: T.DataType) -> Column:
    """Text cast to ``kind``; unparsable text becomes null.

    Integers are read through double, so ``1.0`` and ``1e5`` count (as
    data-frame libraries write integer columns with gaps) where the value
    is integral; plain digits are cast directly, which keeps 64 bits exact.
    """
    col = F.col(quoted(c))
    if not isinstance(kind, (T.IntegerType, T.LongType)):
        return col.try_cast(kind)
    wide = col.try_cast("double")
    return F.coalesce(col.try_cast(kind), F.when(wide == F.floor(wide), wide.try_cast(kind)))


def _to_type(df: DataFrame, schema: T.StructType) -> dict[str, T.DataType]:
    known = {f.name: f.dataType for f in schema.fields}
    return {c: known[c] for c in df.columns if c in known and df.schema[c].dataType != known[c]}


def type_columns(df: DataFrame, schema: T.StructType = GAMES_SCHEMA) -> DataFrame:
    """Cast the known columns by name; unparsable values become null (see :func:`unparsable_counts`)."""
    cast = _to_type(df, schema)
    return df.select(*[_typed(c, cast[c]).alias(c) if c in cast else F.col(quoted(c)) for c in df.columns])


def unparsable_counts(raw: DataFrame, schema: T.StructType = GAMES_SCHEMA) -> DataFrame:
    """(column_name, n_unparsable): non-empty text values that the typed column loses. One scan."""
    cast = {c: k for c, k in _to_type(raw, schema).items() if not isinstance(k, T.StringType)}
    if not cast:
        return raw.sparkSession.createDataFrame([], "column_name string, n_unparsable long")
    lost = [F.count_if((F.length(F.trim(F.col(quoted(c)))) > 0) & _typed(c, k).isNull()).alias(f"n{i}") for i, (c, k) in enumerate(cast.items())]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_unparsable")) for i, c in enumerate(cast)]))
    return raw.agg(*lost).select(rows.alias("r")).select("r.*")


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns of a header CSV as text.

    ``multi_line`` accepts line breaks inside quotes, but a file is then one
    task; leave it off for files without them, so that they are split.
    """
    return (spark.read.option("header", True).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").csv(require_path(path)))


def read_games(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Read a header CSV of games (SRC1).

    Every column is read as text and the known ones (``schema``, by default
    the catalogue's) are cast by name, so files with extra or reordered
    columns work and no inference pass over the data is made.
    """
    return type_columns(read_raw(spark, path, multi_line), schema or GAMES_SCHEMA)
