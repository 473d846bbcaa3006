"""Multi-valued tag columns: class counts, top tags, multi-hot (AGG18-19, TOP2-3, SET1-2, JOI2, ENC1).

Tag statistics explode the decoded lists and aggregate per tag with
conditional counts: one partially aggregated shuffle whose groups are the
distinct tags, so a tag present on a third of all rows costs one partial
row per task. The multi-hot encoder lists a small tag vocabulary on the
driver and keeps a large one as a table.
"""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel, VectorSizeHint
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prelaunch.functions import lists as L
from prelaunch.functions.scalars import quoted, unique_names
from prelaunch.operators.dictionary import DictionaryEncoder, fit_dictionary
from prelaunch.operators.encode import INLINE
from prelaunch.session import checkpoint_dir


def exploded_tags(df: DataFrame, col: str = "genres", target: str = "success",
                  exclude: list[str] = L.NON_GENRE_TAGS) -> DataFrame:
    """(tag, y): one row per cleaned tag instance."""
    return df.select(F.explode(L.clean_tags(col, exclude)).alias("tag"), F.col(target).alias("y"))


def tag_class_counts(df: DataFrame, col: str = "genres", target: str = "success",
                     exclude: list[str] = L.NON_GENRE_TAGS,
                     null_target: str = "successful") -> DataFrame:
    """Per tag: instances on unsuccessful and successful rows (JOI2).

    Both classes come from one conditional aggregate, so a tag seen in
    only one class gets 0 for the other (the aligned outer join of the
    two class counts). ``null_target='successful'`` counts rows without a
    target as successful, as the reference's else-branch does; ``'drop'``
    ignores them.
    """
    t = exploded_tags(df, col, target, exclude)
    if null_target == "drop":
        t = t.where(F.col("y").isNotNull())
    y = F.col("y")
    return t.groupBy("tag").agg(
        F.count_if(y == 0).alias("unsuccessful"),
        F.count_if(y.isNull() | (y != 0)).alias("successful"))


def tag_stats(df: DataFrame, col: str = "genres", target: str = "success",
              exclude: list[str] = L.NON_GENRE_TAGS, null_target: str = "successful") -> DataFrame:
    """Per tag: class counts, total and success rate in percent (AGG18)."""
    c = tag_class_counts(df, col, target, exclude, null_target)
    total = F.col("unsuccessful") + F.col("successful")
    return c.select("tag", "unsuccessful", "successful", total.alias("total"),
                    F.when(total > 0, F.col("successful") / total * 100).otherwise(0.0).alias("success_rate"))


def top_tags(stats: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent tags, rank 1..k by total then tag (TOP2)."""
    order = [F.desc("total"), F.asc("tag")]
    return stats.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_tags_by_rate(stats: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent tags re-ranked by success rate (TOP3)."""
    top = top_tags(stats, k).drop("rank")
    order = [F.desc("success_rate"), F.asc("tag")]
    return top.withColumn("rate_rank", F.row_number().over(Window.orderBy(*order)))


def tag_totals(df: DataFrame, col: str = "genres", target: str = "success",
               exclude: list[str] = L.NON_GENRE_TAGS) -> DataFrame:
    """Distinct tags and tag instances per class (AGG19)."""
    c = tag_class_counts(df, col, target, exclude)
    return c.agg(F.count(F.lit(1)).alias("n_tags"), F.coalesce(F.sum("unsuccessful"), F.lit(0)).alias("unsuccessful_instances"),
                 F.coalesce(F.sum("successful"), F.lit(0)).alias("successful_instances"))


def tag_bag_union(df: DataFrame, col: str = "genres", exclude: list[str] = L.NON_GENRE_TAGS) -> DataFrame:
    """Instances per tag over both classes: the sum of the two bags (SET1)."""
    return (df.select(F.explode(L.clean_tags(col, exclude)).alias("tag"))
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n")))


class MultiHot:
    """Sorted-vocabulary multi-hot encoder of a list-text column (ENC1).

    ``fit`` runs one distributed distinct over the decoded elements. ``transform`` adds one 0/1 column per tag, all of which the
    driver names: a form for small vocabularies. ``vector`` gives one sparse binary vector of any width; beyond ``INLINE`` tags
    the vocabulary stays a table that is joined in, and the driver learns only its size. Which form is the caller's choice.
    """

    def __init__(self, col: str, prefix: str):
        self.col, self.prefix = col, prefix
        self.found: DataFrame | None = None
        self.size = 0
        self._tags: list[str] | None = None
        self._encoder: DictionaryEncoder | None = None

    def fit(self, df: DataFrame) -> "MultiHot":
        checkpoint_dir(df.sparkSession)
        self.found = (df.select(F.explode(L.decode_list(quoted(self.col))).alias("value")).where(F.col("value").isNotNull())
                      .distinct().checkpoint())
        self.size = self.found.count()
        self._tags = self._encoder = None
        return self

    @property
    def tags(self) -> list[str]:
        """The sorted tags, on the driver."""
        if self._tags is None:
            self._tags = [r["value"] for r in self.found.orderBy("value").collect()]
        return self._tags

    @property
    def names(self) -> dict[str, str]:
        """Tag -> column name; tags that differ only in blanks, dots or case keep columns of their own."""
        return unique_names(self.tags, self.prefix)

    @property
    def columns(self) -> list[str]:
        return list(self.names.values())

    def transform(self, df: DataFrame) -> DataFrame:
        tmp = "__multi_hot_items"
        names = self.names
        return (df.withColumn(tmp, L.decode_list(quoted(self.col)))
                .withColumns({names[t]: F.array_contains(tmp, t).cast("int") for t in self.tags}).drop(tmp))

    def encoder(self, items: str, output: str) -> DictionaryEncoder:
        """The dictionary as a pipeline stage over a list column."""
        if self._encoder is None:
            table = fit_dictionary(self.found)
            self._encoder = DictionaryEncoder(table.table, inputCol=items, outputCol=output, size=table.size, multi=True)
        return self._encoder.copy({self._encoder.inputCol: items, self._encoder.outputCol: output})

    def slot_names(self) -> list[str] | tuple[int, DataFrame]:
        """Names of the vector's slots: a list, or beyond ``INLINE`` tags (width, table of (slot, name))."""
        if self.size <= INLINE:
            return self.columns or [f"{self.prefix}unused"]
        encoder = self.encoder("items", "vector")
        return encoder.width, encoder.names(self.prefix)

    def vector(self, df: DataFrame, output: str) -> DataFrame:
        tmp = f"__{output}_items"
        listed = df.withColumn(tmp, F.filter(L.decode_list(quoted(self.col)), lambda x: x.isNotNull()))
        if self.size <= INLINE:
            cv = CountVectorizerModel.from_vocabulary(self.tags or ["\u0000"], inputCol=tmp, outputCol=output, binary=True)
            return cv.transform(listed).drop(tmp)
        encoder = self.encoder(tmp, output)
        hint = VectorSizeHint(inputCol=output, size=encoder.width, handleInvalid="optimistic")
        return hint.transform(encoder.transform(listed)).drop(tmp)
