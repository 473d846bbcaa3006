"""Category -> slot dictionaries as tables: fitted, joined in and saved without passing through the driver (ENC1, ENC3, ENC5).

The distinct values of a column, or of the elements of a list column, are sorted by ranges; a value's slot is its place in
its range plus the number of values in the ranges before. Values keep their type, so doubles, dates and decimals are matched by
value, not by their text. Encoding joins the table in: a broadcast while its known number of rows is small, else a shuffled join
whose hot values adaptive execution splits. List columns are encoded once per distinct list. The result is one sparse vector.
The driver learns the number of values and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prelaunch.functions.scalars import quoted
from prelaunch.plans.joins import BROADCAST_MAX_BYTES
from prelaunch.session import checkpoint_dir

ROW_BYTES = 128              # of a dictionary in memory, for the broadcast check


def distinct_values(df: DataFrame, cols: list[str]) -> dict[str, DataFrame]:
    """Per data type the distinct values of the columns of that type, checkpointed: (at, value), ``at`` the column's place in
    ``cols``. One scan and one exchange for all columns of a type: pairs of column and value fold before they move."""
    checkpoint_dir(df.sparkSession)
    kinds: dict[str, list[int]] = {}
    for i, c in enumerate(cols):
        kinds.setdefault(df.schema[c].dataType.simpleString(), []).append(i)
    out = {}
    for kind, at in kinds.items():
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.col(quoted(cols[i])).alias("value")) for i in at]))
        out[kind] = df.select(pairs.alias("p")).select("p.at", "p.value").distinct().checkpoint()
    return out


@dataclass
class Dictionary:
    """``table``: (value, slot), slots 0 .. size - 1 in the order of the values, a null value last."""
    table: DataFrame
    size: int


def fit_dictionary(values: DataFrame) -> Dictionary:
    """The dictionary of a one-column DataFrame. Repeated values fold into one before they move; an empty table has no slots."""
    checkpoint_dir(values.sparkSession)
    order = F.col("value").asc_nulls_last()
    ranges = values.toDF("value").distinct().repartitionByRange(order).sortWithinPartitions(order).checkpoint()
    at = ranges.withColumn("__id", F.monotonically_increasing_id())
    at = at.select("value", F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND((1 << 33) - 1).alias("__at"))
    # one row per range
    counts = at.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    table = at.join(offsets, "__part").select("value", (F.col("__at") + F.col("__before")).alias("slot")).checkpoint()
    return Dictionary(table, table.count())


def sparse_vector(size: int, slots: Column, values: Column) -> Column:
    """An ML vector of ``size`` from sorted slots and their values, by Spark's own JSON reader of the vector type."""
    parts = F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"), slots.alias("indices"), values.alias("values"))
    kind = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), kind)["v"]


class _EncoderWriter(MLWriter):
    def __init__(self, stage: DictionaryEncoder):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter(self.stage).saveImpl(path)
        self.stage.table.write.parquet(f"{path}/dictionary")


class _EncoderReader(MLReader):
    def load(self, path: str) -> DictionaryEncoder:
        stage = DefaultParamsReader(DictionaryEncoder).load(path)
        stage.table = self.sparkSession.read.parquet(f"{path}/dictionary")
        return stage


class DictionaryEncoder(Transformer, MLWritable, MLReadable):
    """Adds ``outputCol``, a sparse 0/1 vector of the slots of ``inputCol``: a value, or with ``multi`` a list of values. Values
    that the dictionary lacks have no slot; ``dropFirst`` leaves out slot 0. A pipeline stage that saves its table with the model."""

    inputCol = Param(Params._dummy(), "inputCol", "value or list column", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", typeConverter=TypeConverters.toString)
    size = Param(Params._dummy(), "size", "values of the dictionary", typeConverter=TypeConverters.toInt)
    multi = Param(Params._dummy(), "multi", "whether the input is a list", typeConverter=TypeConverters.toBoolean)
    dropFirst = Param(Params._dummy(), "dropFirst", "whether slot 0 is left out", typeConverter=TypeConverters.toBoolean)

    def __init__(self, table: DataFrame | None = None, **values):
        super().__init__()
        self.table = table
        self._setDefault(multi=False, dropFirst=False)
        self._set(**values)

    @property
    def width(self) -> int:
        """Length of the vector: at least one slot, so that an assembler has something to take."""
        return max(1, self.getOrDefault("size") - int(self.getOrDefault("dropFirst")))

    def names(self, prefix: str) -> DataFrame:
        """(slot, name) of the vector's slots; a null is called ``nan``."""
        drop = int(self.getOrDefault("dropFirst"))
        text = F.coalesce(F.replace(F.col("value").cast("string"), F.lit(" "), F.lit("_")), F.lit("nan"))
        return self.table.where(F.col("slot") >= drop).select((F.col("slot") - drop).alias("slot"), F.concat(F.lit(prefix), text).alias("name"))

    def _slots(self) -> DataFrame:
        drop = int(self.getOrDefault("dropFirst"))
        kept = self.table.where(F.col("slot") >= drop).select(F.col("value").alias("__value"), (F.col("slot") - drop).cast("int").alias("__slot"))
        return F.broadcast(kept) if self.getOrDefault("size") * ROW_BYTES <= BROADCAST_MAX_BYTES else kept

    def _transform(self, df: DataFrame) -> DataFrame:
        items = F.col(quoted(self.getOrDefault("inputCol")))
        if self.getOrDefault("multi"):
            lists = df.select(items.alias("__items")).where(F.size("__items") > 0).distinct()
            each = lists.select("__items", F.explode(F.array_distinct("__items")).alias("__element"))
            found = (each.join(self._slots(), F.col("__element") == F.col("__value"))
                     .groupBy("__items").agg(F.sort_array(F.collect_list("__slot")).alias("__slots")))
            joined, slots = df.join(found, items.eqNullSafe(F.col("__items")), "left"), F.coalesce("__slots", F.array().cast("array<int>"))
        else:
            joined = df.join(self._slots(), items.eqNullSafe(F.col("__value")), "left")
            slots = F.when(F.col("__slot").isNull(), F.array().cast("array<int>")).otherwise(F.array("__slot"))
        vector = sparse_vector(self.width, slots, F.transform(slots, lambda _: F.lit(1.0)))
        keep = [F.col(quoted(c)) for c in df.columns]
        return joined.select(*keep, vector.alias(self.getOrDefault("outputCol")))

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()


def fit_value_encoder(train: DataFrame, column: str, output: str, drop_first: bool = True) -> DictionaryEncoder:
    """One-hot encoder of a scalar column: sorted values, a null its own value and last, unseen values all zeros."""
    found = fit_dictionary(train.select(F.col(quoted(column))))
    return DictionaryEncoder(found.table, inputCol=column, outputCol=output, size=found.size, dropFirst=drop_first)


def fit_list_encoder(train: DataFrame, column: str, output: str) -> DictionaryEncoder:
    """Multi-hot encoder of an array column over its distinct non-null elements."""
    elements = train.select(F.explode(F.col(quoted(column))).alias("value")).where("value is not null")
    found = fit_dictionary(elements)
    return DictionaryEncoder(found.table, inputCol=column, outputCol=output, size=found.size, multi=True)
