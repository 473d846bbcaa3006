"""TF-IDF text features (TXT1-TXT9, TOP6, JOI6).

Fit: tokens are a column expression; stop words, 1..n-grams and counts per
term are taken on whole Arrow batches of documents, and one partially
aggregated group-by merges the batches' counts; the vocabulary (at most
``max_features`` terms) is the only thing collected.

Transform: a ``CountVectorizerModel`` with the fitted vocabulary counts
terms inside each row, an ``ElementwiseProduct`` applies the smoothed IDF
``ln((1 + n) / (1 + df)) + 1`` and a ``Normalizer`` scales rows to unit L2
norm (zero rows stay zero). No shuffle, no Python per row; the stages are
plain Spark ML transformers and persist inside a ``PipelineModel``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prelaunch.functions import text as TX
from prelaunch.functions.scalars import text_concat, unique_names


BATCH_DOCS = 1 << 16         # documents, and
BATCH_TOKENS = 1 << 23       # tokens of a batch that are counted at once; numbers of grams fit a long by that
BATCH_TERMS = 1 << 17        # rows of a batch of counts


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the session's cores when the input has fewer files than cores: a file of one row group is one
    task, however long. Inputs of many files stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def default_stop_words() -> list[str]:
    """Spark's own English stop-word list (loaded from the JVM)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def description_text(df: DataFrame, short: str = "short_description",
                     detailed: str = "detailed_features") -> F.Column:
    """short + ' ' + detailed when both columns exist, else short (SCA14)."""
    if detailed in df.columns:
        return text_concat(short, detailed)
    return F.coalesce(F.col(short), F.lit(""))


class Tfidf:
    """Bag-of-n-grams TF-IDF with document-frequency bounds (TXT1-TXT9).

    ``min_df``/``max_df`` are document counts when int, fractions of the
    document count when float. The vocabulary keeps the ``max_features``
    terms of highest corpus frequency (ties by term) and is ordered by term.
    """

    def __init__(self, max_features: int | None = 50, min_df: int | float = 10,
                 max_df: int | float = 0.7, stop_words: list[str] | None = None,
                 ngram_max: int = 2, prefix: str = "tfidf_"):
        self.max_features, self.min_df, self.max_df = max_features, min_df, max_df
        self.stop_words = default_stop_words() if stop_words is None else list(stop_words)
        self.ngram_max, self.prefix = ngram_max, prefix
        self.vocabulary: list[str] = []
        self.idf: list[float] = []
        self.n_docs = 0

    # -- expressions
    def terms(self, text: F.Column) -> F.Column:
        """Tokens, minus stop words, plus adjacent pairs as one expression that cuts the text once (TXT1-TXT3)."""
        toks = TX.remove_stop_words(TX.tokens(text), self.stop_words)
        return TX.with_ngrams(toks, self.ngram_max)

    def with_terms(self, df: DataFrame, text: F.Column, out: str) -> DataFrame:
        """Add the term array ``out`` (TXT1-TXT3): up to pairs by one expression, longer n-grams by Spark ML stages."""
        if self.ngram_max <= 2:
            return df.withColumn(out, self.terms(text))
        tok, kept = f"{out}__tok", f"{out}__kept"
        d = df.withColumn(tok, TX.tokens(text))
        d = StopWordsRemover(inputCol=tok, outputCol=kept, stopWords=self.stop_words,
                             caseSensitive=True).transform(d)
        grams = [F.col(kept)]
        for n in range(2, self.ngram_max + 1):
            d = NGram(n=n, inputCol=kept, outputCol=f"{out}__g{n}").transform(d)
            grams.append(F.col(f"{out}__g{n}"))
        d = d.withColumn(out, F.concat(*grams) if len(grams) > 1 else grams[0])
        return d.drop(tok, kept, *[f"{out}__g{n}" for n in range(2, self.ngram_max + 1)])

    # -- fit
    def term_stats(self, df: DataFrame, text: F.Column, key: str | None = None) -> DataFrame:
        """(term, df, tf): documents containing the term and its total count (TXT4).

        One shuffle: a batch of documents is reduced to one row per distinct
        term before Spark sums the batches, with map-side combine, so the
        exchange carries one partial row per (task, term) instead of one
        per (document, term). No document key is needed.
        """
        counts = spread(df).select(TX.tokens(text).alias("tokens")).mapInArrow(self._counter(), "term string, d long, n long")
        return counts.groupBy("term").agg(F.sum("d").cast("bigint").alias("df"), F.sum("n").cast("bigint").alias("tf"))

    def _counter(self):
        """A function over Arrow batches of token lists that gives (term, documents, occurrences), once per batch and term.

        Tokens and grams are numbered; a gram is the number of its first words times the tokens' count plus the number of its
        last, so text is only made of distinct ones.
        """
        stop_words, ngram_max, most_docs, most_tokens, most_terms = self.stop_words, self.ngram_max, BATCH_DOCS, BATCH_TOKENS, BATCH_TERMS

        def parts(lists):
            if len(lists) < 2 or (len(lists) <= most_docs and len(lists.flatten()) <= most_tokens):
                yield lists
                return
            half = len(lists) // 2
            yield from parts(lists[:half])
            yield from parts(lists[half:])

        def tally(gram, doc, n_docs):
            """The distinct grams, ascending, the documents with them and their occurrences."""
            marks = np.sort(gram * n_docs + doc)
            by_doc = np.flatnonzero(np.diff(marks, prepend=-1))
            owner = marks[by_doc] // n_docs
            by_gram = np.flatnonzero(np.diff(owner, prepend=-1))
            return owner[by_gram], np.diff(by_gram, append=len(owner)), np.diff(by_doc[by_gram], append=len(marks))

        def counts(batches):
            stop = pa.array(stop_words, pa.string())
            for lists in (part for batch in batches for part in parts(batch.column(0))):
                tokens, doc = lists.flatten(), pc.list_parent_indices(lists)
                kept = pc.invert(pc.is_in(tokens, value_set=stop))
                coded = tokens.filter(kept).dictionary_encode()
                doc = doc.filter(kept).to_numpy().astype(np.int64)
                code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
                at, gram, names = np.arange(len(code)), code, words
                for n in range(1, ngram_max + 1):
                    if n > 1:
                        inside = at + n - 1 < len(code)
                        inside[inside] = doc[at[inside]] == doc[at[inside] + n - 1]
                        at, gram = at[inside], gram[inside] * len(words) + code[at[inside] + n - 1]
                    found, d, times = tally(gram, doc[at], len(lists))
                    if n > 1:
                        names = pc.binary_join_element_wise(names.take(pa.array(found // max(1, len(words)))), words.take(pa.array(found % max(1, len(words)))), " ")
                    out = pa.RecordBatch.from_arrays([names, pa.array(d, pa.int64()), pa.array(times, pa.int64())], ["term", "d", "n"])
                    for first in range(0, len(out), most_terms):
                        yield out.slice(first, most_terms)
                    if 1 < n < ngram_max:
                        gram = np.searchsorted(found, gram)

        return counts

    def vocabulary_frame(self, stats: DataFrame, n_docs: int) -> DataFrame:
        """Terms within the df bounds, top ``max_features`` by tf (TXT5, TOP6)."""
        lo = self.min_df if isinstance(self.min_df, int) else self.min_df * n_docs
        hi = self.max_df if isinstance(self.max_df, int) else self.max_df * n_docs
        if hi < lo:
            raise ValueError("max_df corresponds to fewer documents than min_df")
        kept = stats.where((F.col("df") >= lo) & (F.col("df") <= hi))
        if self.max_features:
            kept = kept.orderBy(F.desc("tf"), F.asc("term")).limit(self.max_features)
        idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
        return kept.select("term", "df", "tf", idf.alias("idf"))

    def fit(self, df: DataFrame, text: F.Column, key: str | None = None) -> "Tfidf":
        """Learn vocabulary and IDF from ``df`` (TXT9: fit on any frame)."""
        self.n_docs = df.count()
        vocab = self.vocabulary_frame(self.term_stats(df, text, key), self.n_docs)
        rows = vocab.orderBy("term").collect()
        self.vocabulary = [r.term for r in rows]
        self.idf = [float(r.idf) for r in rows]
        return self

    # -- transform
    @property
    def columns(self) -> list[str]:
        return list(unique_names(self.vocabulary, self.prefix).values())

    def model(self, terms_col: str, output: str) -> PipelineModel:
        """The fitted Spark ML stages: counts -> IDF weights -> L2 rows."""
        cv = CountVectorizerModel.from_vocabulary(self.vocabulary or ["\u0000"], inputCol=terms_col,
                                                  outputCol=f"{output}__tf")
        idf = self.idf or [0.0]
        ew = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol=f"{output}__tf",
                                outputCol=f"{output}__raw")
        nm = Normalizer(p=2.0, inputCol=f"{output}__raw", outputCol=output)
        return PipelineModel(stages=[cv, ew, nm])

    def transform_vector(self, df: DataFrame, text: F.Column, output: str = "tfidf") -> DataFrame:
        """Add the sparse TF-IDF vector column ``output`` (TXT6, TXT7)."""
        tmp = f"{output}__terms"
        out = self.model(tmp, output).transform(self.with_terms(df, text, tmp))
        return out.drop(tmp, f"{output}__tf", f"{output}__raw")

    def transform_wide(self, df: DataFrame, text: F.Column) -> DataFrame:
        """One ``tfidf_<term>`` column per vocabulary term, 0 when absent (TXT8, JOI6)."""
        v = self.transform_vector(df, text, "__tfidf")
        arr = vector_to_array("__tfidf")
        return v.withColumn("__arr", arr).withColumns(
            {c: F.col("__arr")[i] for i, c in enumerate(self.columns)}).drop("__tfidf", "__arr")

    def transform_long(self, df: DataFrame, text: F.Column, key: str) -> DataFrame:
        """(key, term, tfidf) for the non-zero weights."""
        v = self.transform_vector(spread(df), text, "__tfidf")
        vocab = F.array(*[F.lit(t) for t in self.vocabulary]) if self.vocabulary else F.array().cast("array<string>")
        ex = v.select(key, F.posexplode(vector_to_array("__tfidf")).alias("i", "w")).where(F.col("w") != 0)
        return ex.select(key, F.element_at(vocab, F.col("i") + 1).alias("term"), F.col("w").alias("tfidf"))
