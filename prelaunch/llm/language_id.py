"""Language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary are the alphabet; every language has a probability for each piece. The
probability of a word under a language is the sum, over all ways to cut it into pieces, of the product of their
probabilities; a forward algorithm computes it for all words of a batch and all languages in step. A text's score is
the sum over its words (lower-cased letter runs, each with a word-start mark) plus a prior, and languages are compared
by their posterior.

Learning is expectation-maximisation: expected piece counts over all segmentations (forward-backward), summed by Spark
per (language, piece), normalised with add-``SMOOTH``. It starts from a fixed rank-based distribution, the same for all
languages. It reads a sample of at most about ``fit_rows`` training rows, chosen by a hash of ``doc_id``.

Scale: fitting moves at most vocabulary x languages sums per task; scoring scans the texts once (``mapInArrow``, no
shuffle) with a model of vocabulary x languages numbers as broadcast.

Edge cases: a text that is null or has no letters gets ``und`` with score 0. Without any training row everything is
``und``. Rows with a null ``doc_id`` are predicted but never learned from (``held_out`` is true). Letter runs above
``MAX_RUN`` letters are scored in stretches of that length. Repeated rows are predicted alike. Ties go to the language
that sorts first. Only ``doc_id``, ``text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.words import _powers, mix, row_slices, small_batches, span_hash, spans, utf8

FIT_ROWS = 8_000
ROUNDS = 3
SMOOTH = 0.02
UNKNOWN = 1e-7               # probability of a character that is no piece
MAX_RUN = 32
MAX_WORDS = 1 << 18          # scored words that are kept from slice to slice
UND = "und"


@dataclass
class LanguageModel:
    langs: list[str]
    pieces: list[str]        # the word-start mark is a space
    prob: np.ndarray         # pieces x languages
    prior: np.ndarray        # log prior of each language


def vocabulary(model_file: str) -> list[str]:
    """Lower-case letter pieces of a sentencepiece file, in rank order; the word-start mark becomes a space."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found = dict.fromkeys(sp.id_to_piece(i).replace("▁", " ").lower() for i in range(sp.get_piece_size()))
    return [p for p in found if p.strip() and (p[1:] if p[0] == " " else p).isalpha() and len(p) <= 16]


def letter_words(col) -> pa.Array:
    """Lower-cased text with everything but letters turned into spaces."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), "")), r"[^\p{L}]+", " ")


class Pieces:
    """Numbers of substrings in the vocabulary, by hash."""

    def __init__(self, pieces: list[str]):
        codes, starts, ends = [], [], []
        n = 0
        for p in pieces:
            starts.append(n)
            codes += map(ord, p)
            n += len(p)
            ends.append(n)
        self.longest = max(map(len, pieces), default=1)
        h = self.hash(self.sums(np.array(codes, np.uint64)), np.array(starts, np.int64), np.array(ends, np.int64))
        self.order = np.argsort(h)
        self.keys = h[self.order]
        self.maybe = np.zeros(1 << 20, bool)                          # quick refusal of most substrings
        self.maybe[self.keys >> np.uint64(44)] = True

    @staticmethod
    def sums(codes: np.ndarray) -> np.ndarray:
        pw, _ = _powers(len(codes) + 1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(mix(codes + np.uint64(0x51ED270B)) * pw[: len(codes)], out=total[1:])
        return total

    @staticmethod
    def hash(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, inv = _powers(len(total))
        return mix((total[ends] - total[starts]) * inv[starts])

    def find(self, total, starts, length) -> tuple[np.ndarray, np.ndarray]:
        """Which substrings are pieces, and their numbers."""
        h = self.hash(total, starts, starts + length)
        some = np.flatnonzero(self.maybe[h >> np.uint64(44)])
        at = np.minimum(np.searchsorted(self.keys, h[some]), len(self.keys) - 1)
        ok = self.keys[at] == h[some]
        return some[ok], self.order[at[ok]]


def runs_by_length(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words (with their mark) cut into stretches, grouped by length: yields (word, start, length)."""
    length = ends - starts
    n = -(-length // (MAX_RUN + 1))
    word = np.repeat(np.arange(len(starts)), n)
    first = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(n, out=first[1:])
    s = starts[word] + (np.arange(first[-1]) - first[word]) * (MAX_RUN + 1)
    size = np.minimum(ends[word] - s, MAX_RUN + 1)
    for k in np.unique(size).tolist():
        this = size == k
        yield word[this], s[this], k


def forward(pieces: Pieces, prob: np.ndarray, total: np.ndarray, starts: np.ndarray, length: int):
    """Forward sums of all stretches (positions x stretches x languages) and the piece occurrences found."""
    alpha = np.zeros((length + 1, len(starts), prob.shape[1]))
    alpha[0] = 1
    seen = []
    for i in range(1, length + 1):
        for l in range(1, min(i, pieces.longest) + 1):
            rows, ids = pieces.find(total, starts + (i - l), l)
            if len(rows):
                alpha[i, rows] += alpha[i - l, rows] * prob[ids]
                seen.append((i, l, rows, ids))
            if l == 1 and len(rows) < len(starts):
                odd = np.ones(len(starts), bool)
                odd[rows] = False
                alpha[i, odd] += alpha[i - 1, odd] * UNKNOWN
    return alpha, seen


def expected_counts(pieces: Pieces, prob, total, starts, length, weight, out) -> None:
    """Adds the expected number of uses of every piece (pieces x languages), weighted by each stretch's counts."""
    alpha, seen = forward(pieces, prob, total, starts, length)
    beta = np.zeros_like(alpha)
    beta[length] = 1
    single = {i: rows for i, l, rows, _ in seen if l == 1}
    by_end: dict[int, list] = {}
    for i, l, rows, ids in seen:
        by_end.setdefault(i, []).append((l, rows, ids))
    scale = weight / np.maximum(alpha[length], 1e-300)
    for i in range(length, 0, -1):
        for l, rows, ids in by_end.get(i, []):
            use = prob[ids] * beta[i, rows]
            count = alpha[i - l, rows] * use * scale[rows]
            for c in range(prob.shape[1]):
                out[:, c] += np.bincount(ids, count[:, c], minlength=len(out))
            beta[i - l, rows] += use
        odd = np.ones(len(starts), bool)
        odd[single.get(i, np.zeros(0, int))] = False
        beta[i - 1, odd] += beta[i, odd] * UNKNOWN


class Words:
    """Distinct words of one slice: hashes, and their characters with a space before each."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = np.where(data == 32, 0, data)
        s, e, rows = spans(low, off)
        h = span_hash(low, s, e)
        self.hashes, some, self.back = np.unique(h, return_index=True, return_inverse=True)
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(rows))
        self.data, self.s, self.e = data, s[some], e[some]

    def characters(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of the chosen distinct words, each after a space; starts (the spaces) and ends."""
        s, n = self.s[which], (self.e - self.s)[which] + 1
        at = np.zeros(len(n) + 1, np.int64)
        np.cumsum(n, out=at[1:])
        take = np.repeat(s - at[:-1] - 1, n) + np.arange(at[-1])
        flat = self.data[np.maximum(take, 0)].copy()
        flat[at[:-1]] = 32
        codes = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = np.flatnonzero(codes == 32)
        return codes.astype(np.uint64), starts, np.append(starts[1:], len(codes))


def fit(docs: DataFrame, vocabulary_file: str, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS) -> LanguageModel:
    """Learns from the ``text`` and ``lang`` of ``docs`` (every row given is a training row)."""
    pieces = vocabulary(vocabulary_file)
    rows = docs.where("text is not null and lang is not null and doc_id is not null")
    per_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(per_lang)
    n = sum(per_lang.values())
    prior = np.log(np.array([(per_lang[x] + 1) / (n + len(langs)) for x in langs])) if langs else np.zeros(0)
    prob = np.repeat((1.0 / (np.arange(len(pieces)) + 10.0))[:, None], max(1, len(langs)), 1)
    prob /= prob.sum(0)
    if not langs:
        return LanguageModel([], pieces, prob[:, :0], prior)
    share = min(1.0, fit_rows / n)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).select("text", "lang")
    for _ in range(rounds):
        prob = _round(chosen, langs, pieces, prob)
    return LanguageModel(langs, pieces, prob, prior)


def _round(rows: DataFrame, langs: list[str], pieces: list[str], prob: np.ndarray) -> np.ndarray:
    """One E-step over the rows and the M-step."""
    shared = rows.sparkSession.sparkContext.broadcast((langs, pieces, prob))

    def run(batches):
        langs, names, prob = shared.value
        known, number = Pieces(names), {x: i for i, x in enumerate(langs)}
        out = np.zeros(prob.shape)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for first, last, texts in row_slices(batch.column("text")):
                w = Words(*utf8(letter_words(texts)))
                if not len(w.hashes):
                    continue
                count = np.zeros((len(w.hashes), len(langs)))
                np.add.at(count, (w.back, lang[first:last][w.row]), 1)
                codes, s, e = w.characters(np.arange(len(w.hashes)))
                total = Pieces.sums(codes)
                for word, starts, length in runs_by_length(codes, s, e):
                    for x in range(0, len(starts), 8_000):
                        expected_counts(known, prob, total, starts[x: x + 8_000], length, count[word[x: x + 8_000]], out)
        i, j = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(out[i, j])],
                                         ["piece", "lang", "uses"])

    sums = (small_batches(rows).mapInArrow(run, "piece int, lang int, uses double").groupBy("piece", "lang")
            .agg(F.sum("uses").alias("uses")).toArrow())             # at most pieces x languages rows
    new = np.full(prob.shape, SMOOTH)
    np.add.at(new, (sums["piece"].to_numpy(), sums["lang"].to_numpy()), sums["uses"].to_numpy())
    return new / new.sum(0)


class Scorer:
    """Log posterior of each language for texts."""

    def __init__(self, model: LanguageModel):
        self.model, self.pieces = model, Pieces(model.pieces)
        self.words = np.zeros(0, np.uint64)
        self.known = np.zeros((0, len(model.langs)))

    def _word_scores(self, w: Words) -> np.ndarray:
        out = np.zeros((len(w.hashes), len(self.model.langs)))
        at = np.searchsorted(self.words, w.hashes)
        have = np.zeros(len(w.hashes), bool)
        inside = at < len(self.words)
        have[inside] = self.words[at[inside]] == w.hashes[inside]
        out[have] = self.known[at[have]]
        new = np.flatnonzero(~have)
        for x in range(0, len(new), 8_000):
            part = new[x: x + 8_000]
            codes, s, e = w.characters(part)
            total = Pieces.sums(codes)
            for word, starts, length in runs_by_length(codes, s, e):
                alpha, _ = forward(self.pieces, self.model.prob, total, starts, length)
                np.add.at(out, part[word], np.log(np.maximum(alpha[length], 1e-300)))
        if len(self.words) + len(new) > MAX_WORDS:
            self.words, self.known = w.hashes, out
        elif len(new):
            self.words = np.insert(self.words, at[new], w.hashes[new])
            self.known = np.insert(self.known, at[new], out[new], axis=0)
        return out

    def posteriors(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(has letters, posterior of each language) of a string column."""
        n = len(texts)
        some, logp = np.zeros(n, bool), np.tile(self.model.prior, (n, 1))
        for first, last, part in row_slices(texts):
            w = Words(*utf8(letter_words(part)))
            if len(w.hashes):
                scores = self._word_scores(w)[w.back]
                some[first + np.unique(w.row)] = True
                for c in range(scores.shape[1]):
                    logp[first:last, c] += np.bincount(w.row, scores[:, c], minlength=last - first)
        logp -= logp.max(1, keepdims=True) if logp.size else 0
        p = np.exp(logp)
        return some, p / p.sum(1, keepdims=True)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """All columns of ``docs`` with w_lang (``und`` without letters) and w_score (posterior of w_lang, 0 for ``und``)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.pieces, model.prob, model.prior))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", w_lang string, w_score double"

    def run(batches):
        model = LanguageModel(*shared.value)
        scorer = Scorer(model)
        for batch in batches:
            n = batch.num_rows
            if model.langs:
                some, p = scorer.posteriors(batch.column("text"))
                best = p.argmax(1)
                lang = [model.langs[b] if s else UND for b, s in zip(best.tolist(), some.tolist())]
                score = np.where(some, p[np.arange(n), best], 0.0)
            else:
                lang, score = [UND] * n, np.zeros(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             [*batch.schema.names, "w_lang", "w_score"])

    return small_batches(docs).mapInArrow(run, schema)


def held_out() -> F.Column:
    """The contract's fold: crc32 of the id as text, modulo 5, is 0; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), default_vocabulary())
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), F.col("w_lang").alias("lang_pred"), F.col("w_score").alias("score")))


def brute_force_word(word: str, prob: dict[str, float]) -> float:
    """Reference for tests: the sum over all segmentations of a marked word, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for l in range(1, len(word) + 1):
        if word[:l] in prob:
            total += prob[word[:l]] * brute_force_word(word[l:], prob)
    if word[0] not in prob:
        total += UNKNOWN * brute_force_word(word[1:], prob)
    return total
