"""Encoders and splits (ENC2-ENC5, SPL2-SPL4).

Fitted encoders are Spark ML stages that carry the learned constants
(means, deviations, category lists), so they run as native projections and
persist inside a standard ``PipelineModel``. What a fit brings back is
bounded by the number of columns: categories are listed on the driver up to
``INLINE`` a column, beyond that they stay a table (see ``dictionary``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer, VectorAssembler, VectorSizeHint
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prelaunch.functions.scalars import hash_uniform, quoted, unique_names
from prelaunch.operators.dictionary import DictionaryEncoder, distinct_values, fit_dictionary
from prelaunch.plans.joins import broadcast_if_few
from prelaunch.session import checkpoint_dir


INLINE = 256                 # categories of a column that a projection carries as constants


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class FittedStage:
    """A fitted projection: its Spark ML stages, their output columns, and the names of the vector slots. An encoder's names
    are a table: ``blocks`` holds, in slot order, lists of names and (width, table of (slot, name))."""
    stages: list
    outputs: list[str]
    blocks: list = field(default_factory=list)

    @property
    def stage(self) -> PipelineModel:
        return PipelineModel(stages=self.stages)

    @property
    def names(self) -> list[str]:
        """All names on the driver, for outputs that are one column a name."""
        out: list[str] = []
        for b in self.blocks:
            out += b if isinstance(b, list) else [r["name"] for r in b[1].orderBy("slot").collect()]
        return out


def fit_standard_scaler(train: DataFrame, cols: list[str], prefix: str = "num__") -> FittedStage:
    """(x - mean) / population std fitted on ``train``; zero std -> 1 (ENC2).

    Nulls in the input stay null; fill them before scaling.
    """
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(quoted(c)).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = train.agg(*aggs).first() if cols else None
    exprs, outs = [], []
    for i, c in enumerate(cols):
        m = row[f"m{i}"] or 0.0
        s = row[f"s{i}"]
        s = 1.0 if s is None or s == 0 or math.isnan(s) else s
        out = f"{prefix}{c}"
        exprs.append(f"(CAST({quoted(c)} AS DOUBLE) - {m!r}D) / {s!r}D AS {quoted(out)}")
        outs.append(out)
    stmt = "SELECT *" + "".join(", " + e for e in exprs) + " FROM __THIS__"
    return FittedStage([SQLTransformer(statement=stmt)], outs, [list(cols)])


def fit_categories(train: DataFrame, cols: list[str], inline: int | None = INLINE) -> list[list[str | None] | DataFrame]:
    """Per column its sorted distinct values, a null last: as texts (Spark's own cast, which tells any two values of one type
    apart) where there are at most ``inline``, else as a one-column table. With ``inline=None`` always as texts."""
    found: list = [[] for _ in cols]
    for values in distinct_values(train, cols).values():
        sizes = {r["at"]: r["n"] for r in values.groupBy("at").agg(F.count(F.lit(1)).alias("n")).collect()}
        small = [i for i, n in sizes.items() if inline is None or n <= inline]
        listed = values.where(F.col("at").isin(small)).orderBy("at", F.col("value").asc_nulls_last())
        for r in listed.select("at", F.col("value").cast("string").alias("text")).collect():
            found[r["at"]].append(r["text"])
        for i in sizes.keys() - set(small):
            found[i] = values.where(F.col("at") == i).select("value")
    return found


def _names(column: str, texts: list[str | None]) -> list[str]:
    """Slot names; texts that differ only in blanks keep names of their own."""
    out: dict[str, None] = {}
    for t in texts:
        base = name = f"{column}_{'nan' if t is None else t.replace(' ', '_')}"
        n = 1
        while name in out:
            n += 1
            name = f"{base}_{n}"
        out[name] = None
    return list(out)


def fit_one_hot(train: DataFrame, cols: list[str], prefix: str = "cat__", output: str = "columns", inline: int = INLINE) -> FittedStage:
    """Sorted-category one-hot, first category dropped, unseen -> zeros (ENC3).

    A null seen in training is its own category, ordered last. Categories are matched by value, whatever their type.
    ``output="columns"`` adds a 0/1 column per category, all of which the driver names;
    ``output="vector"`` one sparse vector per input column, for any number of categories: a column of more than ``inline`` keeps
    them in a table that is joined in and saved with the model.
    """
    exprs, outs, blocks, stages = [], [], [], []
    for i, (c, cats) in enumerate(zip(cols, fit_categories(train, cols, inline if output == "vector" else None))):
        if output != "vector":
            kind = train.schema[c].dataType.simpleString()
            for t, name in zip(cats[1:], _names(c, cats[1:])):
                exprs.append((f"{quoted(c)} IS NULL" if t is None else f"{quoted(c)} <=> CAST({_lit(t)} AS {kind})", name))
            continue
        vec = f"{prefix}{i}_vec"
        outs.append(vec)
        if isinstance(cats, DataFrame):
            table = fit_dictionary(cats)
            encoder = DictionaryEncoder(table.table, inputCol=c, outputCol=vec, size=table.size, dropFirst=True)
            stages += [encoder, VectorSizeHint(inputCol=vec, size=encoder.width, handleInvalid="optimistic")]
            blocks.append((encoder.width, encoder.names(f"{c}_")))
            continue
        # the kept categories are the vocabulary of a one-word "text"
        items = f"__{prefix}{i}_item"
        as_text = f"coalesce(CAST({quoted(c)} AS STRING), '{NULL_CATEGORY}')"
        words = [NULL_CATEGORY if t is None else t for t in cats[1:]]
        stages.append(SQLTransformer(statement=f"SELECT *, array({as_text}) AS {quoted(items)} FROM __THIS__"))
        stages.append(CountVectorizerModel.from_vocabulary(words or ["\u0001unused"], inputCol=items, outputCol=vec, binary=True))
        blocks.append(_names(c, cats[1:]) or [f"{c}_unused"])
    if output != "vector":
        aliases = unique_names([n for _, n in exprs], prefix)
        stmt = "SELECT *" + "".join(f", CAST({cond} AS DOUBLE) AS {quoted(aliases[n])}" for cond, n in exprs) + " FROM __THIS__"
        stages, outs, blocks = [SQLTransformer(statement=stmt)], list(aliases.values()), [[n for _, n in exprs]]
    return FittedStage(stages, outs, blocks)


NULL_CATEGORY = "\u0001null"


def assembler(numeric: FittedStage, categorical: FittedStage, output: str = "features", vectors: list[str] | None = None) -> VectorAssembler:
    """Numeric block, categorical block, then vector columns into one vector (ENC4)."""
    return VectorAssembler(inputCols=numeric.outputs + categorical.outputs + list(vectors or []), outputCol=output,
                           handleInvalid="keep")


def feature_names(numeric: FittedStage, categorical: FittedStage, vectors: dict[str, list[str]] | None = None) -> list[str]:
    """Names of the assembled slots, in vector order (ENC5)."""
    return numeric.names + categorical.names + [n for names in (vectors or {}).values() for n in names]


def feature_name_table(spark: SparkSession, numeric: FittedStage, categorical: FittedStage, vectors: dict | None = None) -> DataFrame:
    """(slot, name) of the assembled vector as a table: names of large encoders never come to the driver (ENC5). ``vectors``
    holds, per vector column, its names or (width, table of (slot, name))."""
    listed, tables, first = [], [], 0
    for block in [*numeric.blocks, *categorical.blocks, *(vectors or {}).values()]:
        if isinstance(block, list):
            listed += [(first + i, n) for i, n in enumerate(block)]
            first += len(block)
        else:
            tables.append(block[1].select((F.col("slot") + first).cast("int").alias("slot"), "name"))
            first += block[0]
    out = spark.createDataFrame(listed, "slot int, name string")
    for t in tables:
        out = out.unionByName(t)
    return out


EDGE_ROWS = 1 << 17          # rows of a class that one window task may rank


def stratified_split(df: DataFrame, label: str, key: str, test_fraction: float = 0.3,
                     seed: str = "42", n_buckets: int = 4096, edge_rows: int = EDGE_ROWS) -> DataFrame:
    """Exact stratified random split: adds ``split`` in {train, test} (SPL2, WIN3).

    Rows are ordered per class by a hash uniform of (key, seed) — the same
    result for any partitioning — and the first round(test_fraction * n_c)
    of each class go to test. Each class's cut is searched by histograms: counts over ``n_buckets`` (a power of two) parts of the
    interval that holds the cut show in which part it lies, and that part is cut again until it holds at most ``edge_rows`` rows.
    The first histogram is one scan; later ones read only the rows of the parts that hold a cut. Those last rows alone are
    ranked with a window; every other row is decided by its uniform. No global sort; the driver sees one number a round.
    """
    if n_buckets < 2 or n_buckets & (n_buckets - 1):
        raise ValueError("n_buckets must be a power of two")
    checkpoint_dir(df.sparkSession)
    d = df.withColumn("__u", hash_uniform(key, seed))
    rows = d.select(F.col(quoted(label)).alias("__class"), "__u")
    # per class the interval [lo, lo + width) that holds its cut, and r, the rows of it that go to test
    found = _narrowed(rows.withColumns({"lo": F.lit(0.0), "width": F.lit(1.0), "r": F.lit(None).cast("long")}), n_buckets, test_fraction)
    while (most := found.agg(F.max("n")).first()[0] or 0) > edge_rows:
        rows = _in_interval(rows, found).checkpoint()
        narrower = _narrowed(rows, n_buckets, test_fraction)
        if (narrower.agg(F.max("n")).first()[0] or 0) == most and narrower.agg(F.max("width")).first()[0] < 2.0 ** -40:
            break                # repeated keys share one uniform: nothing left to cut by
        rows, found = rows.select("__class", "__u"), narrower
    cuts = found.select(F.struct("lo", (F.col("lo") + F.col("width")).alias("hi"), "r").alias("cut"), "__class")
    d = d.join(broadcast_if_few(cuts), F.col(quoted(label)).eqNullSafe(F.col("__class")))
    keep = [F.col(quoted(c)) for c in df.columns]
    edge = (F.col("__u") >= F.col("cut.lo")) & (F.col("__u") < F.col("cut.hi"))
    plain = d.where(~edge).select(*keep, F.when(F.expr("__u < cut.lo"), "test").otherwise("train").alias("split"))
    w = Window.partitionBy(quoted(label)).orderBy("__u", quoted(key))
    ranked = d.where(edge).select(*keep, F.when(F.row_number().over(w) <= F.col("cut.r"), "test").otherwise("train").alias("split"))
    return plain.unionByName(ranked)


def _in_interval(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows (__class, __u) inside their class's interval, with it."""
    cuts = broadcast_if_few(found.select(F.col("__class").alias("__of"), "lo", "width", "r"))
    return rows.join(cuts, F.col("__class").eqNullSafe(F.col("__of")) & (F.col("__u") >= F.col("lo")) & (F.col("__u") < F.col("lo") + F.col("width"))).drop("__of")


def _narrowed(rows: DataFrame, parts: int, fraction: float) -> DataFrame:
    """(__class, lo, width, r, n): per class the part of the interval in which its cut lies, checkpointed. All numbers are
    multiples of a power of two, so intervals are exact. Without ``r`` the cut is at ``fraction`` of the class."""
    part = F.floor((F.col("__u") - F.col("lo")) / F.col("width") * parts)
    counts = rows.groupBy("__class", "lo", "width", "r", part.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("__class")
    upto = F.sum("n").over(whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0))
    goal = F.coalesce("r", F.floor(F.lit(fraction) * F.sum("n").over(whole) + 0.5))
    placed = counts.select("__class", "lo", "width", "b", "n", upto.alias("c"), goal.alias("k")).where("c >= k")
    width = F.col("width") / parts
    cut = F.struct("b", (F.col("lo") + F.col("b") * width).alias("lo"), width.alias("width"), (F.col("k") - F.col("c") + F.col("n")).alias("r"), "n")
    return placed.groupBy("__class").agg(F.min(cut).alias("cut")).select("__class", "cut.lo", "cut.width", "cut.r", "cut.n").checkpoint()


def balanced_weights(train: DataFrame, label: str) -> dict:
    """n / (k * n_c) per class, from one grouped count (SPL3)."""
    rows = train.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    n = sum(r["count"] for r in rows)
    k = len(rows)
    return {r[label]: n / (k * r["count"]) for r in rows}


def positive_weight(train: DataFrame, label: str) -> float:
    """n_negative / n_positive on the training rows (SPL4)."""
    r = train.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1")).first()
    return r["n0"] / r["n1"] if r["n1"] else 1.0


def weight_column(label: str, weights: dict) -> F.Column:
    """Per-row weight from a class -> weight table (classes are few)."""
    expr = None
    for cls, w in weights.items():
        cond = F.col(label) == F.lit(cls)
        expr = F.when(cond, F.lit(float(w))) if expr is None else expr.when(cond, F.lit(float(w)))
    return expr.otherwise(F.lit(1.0)) if expr is not None else F.lit(1.0)
