"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are all windows of ``width`` consecutive words of the benchmark items (an item of fewer words is one shorter
window). Patterns of one length form a table: every block of two words (one, for one-word patterns) that occurs in a
pattern allows a shift, any other block shifts the search past itself, so most text positions are never looked at.
Where the shift is zero, the block's hash selects the patterns that end with it; a hash of the whole window filters
them, and comparison of the words themselves confirms an occurrence.

Scale: documents are only scanned (no shuffle); the search runs inside ``mapInArrow`` over word hashes. Patterns are
broadcast in blocks of at most ``block_bytes`` of benchmark text, so a benchmark of any size works with bounded memory. The
documents go through the first block's search; each further block reads the texts again and leaves one row for a text that
holds some of its windows, so nothing but such rows is ever written.

Edge cases: a null or empty text has no words (0 words, 0 hits, not contaminated). Very long texts are searched whole, in slices of
rows; ties do not arise (spans and item ids are sets). Empty tables give no rows. Items without words, or with a
null id, are left out; equal ids count once. Repeated rows are judged one by one. An empty benchmark hits nothing. Only
``doc_id`` and ``text`` (``item_id`` and ``text``) are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint
from prelaunch.llm.words import FOLD, row_slices, shingle_hashes, small_batches, span_hash, spans, utf8, word_hashes

WIDTH = 13
SHARE = 20          # contaminated: share * hit words >= words
BLOCK_BYTES = 4 << 20

_SEPARATORS = bytes(int(b) or 32 for b in FOLD)
SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items array<string>, spans array<struct<first:int,last:int>>")


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_SEPARATORS).split()


class PatternTable:
    """Wu-Manber tables of patterns that all have ``size`` words."""

    def __init__(self, size: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.size, self.block = size, min(2, size)
        self.patterns = list(patterns)
        self.items = [patterns[p] for p in self.patterns]
        joined = b" ".join(b" ".join(p) for p in self.patterns)
        data = np.frombuffer(joined, np.uint8)
        words, _, _, _ = word_hashes(data, np.array([0, len(data)]))
        words = words.reshape(len(self.patterns), size)
        blocks = block_hashes(words, self.block)                     # patterns x (size - block + 1)
        last = blocks.shape[1] - 1
        keys = blocks.ravel()
        shift = np.tile(last - np.arange(last + 1), len(words))
        order = np.lexsort((shift, keys))
        keys, shift = keys[order], shift[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        self.keys, self.shift = keys[first], shift[first]            # smallest shift of each block
        whole, _ = shingle_hashes(words.ravel(), np.arange(0, len(words) * size + 1, size), size)
        order = np.lexsort((whole, blocks[:, last]))
        self.tails, self.wholes, self.which = blocks[order, last], whole[order], order
        self.skip = last + 1                                         # shift past a block that no pattern has

    def find(self, h: np.ndarray, rows: np.ndarray, same) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every occurrence in rows of word hashes; ``same(at, pattern)`` compares words."""
        m, b = self.size, self.block
        # Long rows are searched in stretches of window starts, all stretches in step.
        lo, hi = [], []
        for s, e in zip(rows[:-1], rows[1:]):
            if e - s >= m:
                cut = np.arange(s, e - m + 1, 512)
                lo.append(cut)
                hi.append(np.append(cut[1:], e - m + 1))
        if not lo:
            return
        at, stop = np.concatenate(lo), np.concatenate(hi)
        found = []
        while len(at):
            end = at + m - b
            blk = h[end] if b == 1 else pair_hash(h[end], h[end + 1])
            i = np.minimum(np.searchsorted(self.keys, blk), len(self.keys) - 1)
            step = np.where(self.keys[i] == blk, self.shift[i], self.skip)
            hit = step == 0
            if hit.any():
                found.append(at[hit])
            at = at + np.maximum(step, 1)
            live = at < stop
            at, stop = at[live], stop[live]
        if not found:
            return
        at = np.sort(np.concatenate(found))
        tail = h[at + m - b] if b == 1 else pair_hash(h[at + m - 2], h[at + m - 1])
        whole = np.empty(len(at), np.uint64)
        for x in range(0, len(at), 1 << 16):                         # hash of each candidate window
            part = at[x: x + (1 << 16)]
            flat = h[(part[:, None] + np.arange(m)).ravel()]
            whole[x: x + len(part)], _ = shingle_hashes(flat, np.arange(0, len(flat) + 1, m), m)
        lo, hi = np.searchsorted(self.tails, tail), np.searchsorted(self.tails, tail, "right")
        for p, w, i, j in zip(at.tolist(), whole, lo, hi):
            k = i + np.searchsorted(self.wholes[i:j], w)
            while k < j and self.wholes[k] == w:
                if same(p, self.patterns[self.which[k]]):
                    yield p, int(self.which[k])
                k += 1


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * np.uint64(0x9FB21C651E98DF25) + b


def block_hashes(words: np.ndarray, b: int) -> np.ndarray:
    return words if b == 1 else pair_hash(words[:, :-1], words[:, 1:])


def compile_tables(items: list[tuple[str, str]], width: int) -> list[PatternTable]:
    """One table for each pattern length of (item id, text) pairs."""
    by_size: dict[int, dict] = defaultdict(lambda: defaultdict(list))
    for item, text in items:
        w = folded_words((text or "").encode())
        for i in range(max(1, len(w) - width + 1) if w else 0):
            p = tuple(w[i: i + width])
            ids = by_size[len(p)][p]
            if item not in ids:
                ids.append(item)
    return [PatternTable(n, p) for n, p in sorted(by_size.items())]


def search_batch(texts, tables: list[PatternTable]) -> list[tuple[int, set[str], list[tuple[int, int]]]]:
    """Per text: number of words, items that occur, merged [first, last) spans of hit words."""
    out = []
    for _, _, part in row_slices(texts):
        data, rows_off = utf8(part)
        low = FOLD[data]
        starts, ends, rows = spans(low, rows_off)
        h = span_hash(low, starts, ends)
        raw = low.tobytes()

        def same(at: int, pattern) -> bool:
            return all(raw[starts[at + j]: ends[at + j]] == w for j, w in enumerate(pattern))

        items: dict[int, set] = defaultdict(set)
        hits: dict[int, list] = defaultdict(list)
        for t in tables:
            for at, p in t.find(h, rows, same):
                row = int(np.searchsorted(rows, at, "right")) - 1
                items[row].update(t.items[p])
                hits[row].append((at - int(rows[row]), at - int(rows[row]) + t.size))
        for r in range(len(rows) - 1):
            out.append((int(rows[r + 1] - rows[r]), items.get(r, set()), merge_spans(hits.get(r, []))))
    return out


def merge_spans(found) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for s, e in sorted(set(found)):
        if merged and s <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]))
        else:
            merged.append((s, e))
    return merged


def item_blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items (item, text) in blocks whose text stays near ``block_bytes`` each, dealt by a hash of the id."""
    total = items.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    n = max(1, -(-total * 5 // (4 * block_bytes)))
    return [items] if n == 1 else [items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i) for i in range(n)]


def find_windows(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text; ``keep`` names further columns to carry) with n_words, items (sorted ids whose windows
    occur) and spans (merged [first, last) ranges of hit words)."""
    spark = docs.sparkSession
    items = (benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
             .select(F.col("item_id").cast("string").alias("item"), "text").distinct())
    carried = list(dict.fromkeys(["doc_id", "text", *(keep or [])]))
    blocks = item_blocks(items, block_bytes)
    if len(blocks) > 1:
        blocks = item_blocks(shared_checkpoint(items), block_bytes)
    # A block holds at most about block_bytes of text, whatever the benchmark's size.
    pairs = [(r["item"], r["text"]) for r in blocks[0].toLocalIterator()]
    if len(blocks) == 1:
        return _search(spark, docs.select(*carried), pairs, width)
    # The documents are carried through the first block's search only; further ones read the texts and leave a row per text
    # that holds some of their windows, under a hash of the text.
    keyed = docs.select(*carried, *_text_keys())
    out = _search(spark, keyed, pairs, width)
    more = None
    for block in blocks[1:]:
        pairs = [(r["item"], r["text"]) for r in block.toLocalIterator()]
        got = _search(spark, docs.select("text", *_text_keys()), pairs, width).where(F.size("w_items") > 0)
        got = shared_checkpoint(got.groupBy("w_k1", "w_k2").agg(F.first("w_items").alias("i"), F.first("w_spans").alias("s")))
        more = got if more is None else more.unionByName(got)
    more = more.groupBy("w_k1", "w_k2").agg(F.flatten(F.collect_list("i")).alias("w_i"), F.flatten(F.collect_list("s")).alias("w_s"))
    joined = out.join(more, ["w_k1", "w_k2"], "left")
    found = F.array_sort(F.array_distinct(F.concat("w_items", "w_i")))
    return joined.select(*carried, "w_words", F.when(F.col("w_i").isNull(), F.col("w_items")).otherwise(found).alias("w_items"),
                         F.when(F.col("w_i").isNull(), F.col("w_spans")).otherwise(_merged(F.array_sort(F.concat("w_spans", "w_s")))).alias("w_spans"))


def _text_keys() -> list[Column]:
    return [F.xxhash64("text").alias("w_k1"), F.xxhash64(F.lit("second"), "text").alias("w_k2")]


def _merged(spans: Column) -> Column:
    """Sorted [first, last) ranges with those that touch made one."""
    def add(done, s):
        last = F.element_at(done, -1)
        touch = F.struct(last["first"].alias("first"), F.greatest(last["last"], s["last"]).alias("last"))
        return F.when(F.size(done) == 0, F.array(s)).when(last["last"] >= s["first"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(touch))).otherwise(
            F.concat(done, F.array(s)))

    return F.aggregate(spans, F.array().cast("array<struct<first:int,last:int>>"), add)


def _search(spark: SparkSession, docs: DataFrame, pairs: list[tuple[str, str]], width: int) -> DataFrame:
    """``docs`` with w_words, w_items and w_spans of the windows of ``pairs``."""
    shared = spark.sparkContext.broadcast(pairs)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    schema += ", w_words long, w_items array<string>, w_spans array<struct<first:int,last:int>>"
    carried = docs.columns

    def run(batches):
        tables = compile_tables(shared.value, width)
        for batch in batches:
            found = search_batch(batch.column("text"), tables)
            cols = [batch.column(c) for c in carried]
            cols += [pa.array([n for n, _, _ in found], pa.int64()),
                     pa.array([sorted(s) for _, s, _ in found], pa.list_(pa.string())),
                     pa.array([[{"first": a, "last": b} for a, b in sp] for _, _, sp in found],
                              pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]
            yield pa.RecordBatch.from_arrays(cols, [*carried, "w_words", "w_items", "w_spans"])

    return small_batches(docs).mapInArrow(run, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, share: int = SHARE,
                  block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Judged documents: doc_id (and ``keep``), n_words, n_hit, n_items, items, spans, contaminated
    (n_hit > 0 and share * n_hit >= n_words)."""
    found = find_windows(docs, benchmark, width, block_bytes, keep)
    hit = F.aggregate("w_spans", F.lit(0).cast("long"), lambda a, s: a + (s["last"] - s["first"]))
    return (found.withColumn("w_hit", hit)
            .select("doc_id", *[c for c in keep or [] if c != "doc_id"], F.col("w_words").alias("n_words"),
                    F.col("w_hit").alias("n_hit"), F.size("w_items").cast("long").alias("n_items"),
                    F.col("w_items").alias("items"), F.col("w_spans").alias("spans"),
                    ((F.col("w_hit") > 0) & (F.col("w_hit") * share >= F.col("w_words"))).alias("contaminated")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest of :func:`decontaminate` over documents and benchmark."""
    judged = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def brute_force(texts: list[str | None], items: list[tuple], width: int = WIDTH) -> list[tuple[int, int, str, bool]]:
    """Reference for tests: (n_words, n_hit, sha256 of ids, contaminated) of each text by plain comparison."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {i: i + 32 for i in range(65, 91)}
    split = lambda t: word.findall((t or "").translate(lower))
    windows = []
    for item, text in items:
        w = split(text)
        if item is not None and w:
            windows += [(str(item), w[i: i + width]) for i in range(max(1, len(w) - width + 1))]
    out = []
    for text in texts:
        w, hit, ids = split(text), set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if w[i: i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    ids.add(item)
        out.append((len(w), len(hit), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


ORACLE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(len(w), {WIDTH}) AS n,
             array_to_string(w[k : k + least(len(w), {WIDTH}) - 1], ' ') AS win
      FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - {WIDTH} + 1))) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT rid, k, n, array_to_string(w[k : k + n - 1], ' ') AS win
      FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hits AS (SELECT rid, k, g.n, item_id FROM g JOIN p ON g.win = p.win AND g.n = p.n),
pos AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(generate_series(k, k + n - 1)) AS x FROM hits) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN ids USING (rid)
"""
