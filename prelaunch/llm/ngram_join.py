"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of word shingles (``k`` consecutive words; a text of fewer words, but not none, is one shingle). Texts
with the same shingle set form a class; classes whose Jaccard similarity is at least ``threshold`` are linked.

1. Each text gets a 128-bit class key (a hash of its shingle set) and ``bands * rows`` MinHash values. Copies fold
   into their class by a map-side combined aggregate.
2. Classes that agree on all rows of some band are candidates. Candidate groups are the connected components of the
   band buckets (star edges to the smallest class of a bucket, never all pairs).
3. Each candidate group is dealt, once, to a task with its signatures and shingles. A group above ``block_shingles``
   or ``block_classes`` is split into blocks and every pair of blocks becomes a task of its own, so no task holds an
   unbounded group, and links inside a task are index pairs, at most ``block_classes`` squared or so.
4. Inside a task, pairs that share a band are compared a few MinHash values at a time. After each step a pair is
   dropped when the posterior probability (uniform prior) that its similarity reaches the threshold falls below
   ``tolerance``. What is left is verified exactly on the shingle sets.
5. A task returns, for each class, its number of links and the smallest class it is linked with inside the task;
   components of those star edges give the class ids. Pairs are never emitted.

A pair at similarity s is missed by the bands with probability (1 - s**rows)**bands: 4e-7 at 0.8 with the defaults, less
above. Pruning adds at most about ``tolerance``.

Edge cases: a text that is null, empty or without words has no shingles and is linked with nothing (its class id is its
own doc_id, 0 links). Repeated rows are copies of one class. A null ``doc_id`` takes part like any other; the class id
is the smallest non-null ``doc_id``. An empty table gives an empty result. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import components, shared_checkpoint
from prelaunch.llm.words import distinct_per_row, mix, row_slices, shingle_hashes, small_batches, utf8, word_hashes

K = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 4
STEP = 16                    # MinHash values compared between two prunings
TOLERANCE = 1e-6
BLOCK_SHINGLES = 1 << 17
BLOCK_CLASSES = 1 << 11


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
    return r[:n] | np.uint64(1), r[n:]


def shingle_sets(texts, k: int):
    """Per slice of a string column: first and last row, sorted distinct shingle hashes, row offsets."""
    for first, last, part in row_slices(texts):
        h, _, _, rows = word_hashes(*utf8(part))
        yield first, last, *distinct_per_row(*shingle_hashes(h, rows, k))


def class_keys(h: np.ndarray, off: np.ndarray) -> list[bytes | None]:
    """A 128-bit key of each row's shingle set; None for an empty set."""
    out: list[bytes | None] = [None] * (len(off) - 1)
    some = np.flatnonzero(np.diff(off))
    if len(some):
        n = np.diff(off)[some].astype(np.uint64)
        a = mix(np.add.reduceat(mix(h ^ np.uint64(0x1B873593CC9E2D51)), off[some]) + n)
        b = mix(np.add.reduceat(mix(h + np.uint64(0x85EBCA77C2B2AE63)), off[some]) ^ n)
        raw = np.stack([a, b], 1).astype(">u8").tobytes()
        for j, i in enumerate(some.tolist()):
            out[i] = raw[16 * j: 16 * j + 16]
    return out


def signatures(h: np.ndarray, off: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values (uint32) of each non-empty row's shingle set."""
    some = np.flatnonzero(np.diff(off))
    a, b = _seeds(n)
    sig = np.empty((len(some), n), np.uint32)
    if len(some):
        at = off[some]
        for j in range(n):
            x = h * a[j] + b[j]
            sig[:, j] = np.minimum.reduceat((x >> np.uint64(32)).astype(np.uint32), at)
    return sig


def with_class_key(docs: DataFrame, k: int = K) -> DataFrame:
    """All columns of ``docs`` and ``w_class`` (binary, null without words)."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", w_class binary"

    def run(batches):
        for batch in batches:
            keys: list = []
            for _, _, h, off in shingle_sets(batch.column("text"), k):
                keys += class_keys(h, off)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], [*batch.schema.names, "w_class"])

    return small_batches(docs).mapInArrow(run, schema)


def _classes(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """One row per text: doc_id, class key, MinHash values, number of shingles."""

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, last, h, off in shingle_sets(batch.column("text"), k):
                sig = signatures(h, off, bands * rows)
                full = np.diff(off) > 0
                at = np.cumsum(full) - 1
                raw = sig.astype("<u4").tobytes()
                w = 4 * bands * rows
                sigs = [raw[w * at[i]: w * at[i] + w] if full[i] else None for i in range(len(full))]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, last - first), pa.array(class_keys(h, off), pa.binary()), pa.array(sigs, pa.binary()),
                     pa.array(np.diff(off), pa.int64())], ["doc_id", "w_class", "w_sig", "w_n"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, w_class binary, w_sig binary, w_n long")


def _band_keys(sig: DataFrame, bands: int, rows: int) -> DataFrame:
    """(class, bucket): a hash of each band's rows, one row a band."""
    w = 4 * rows
    return sig.select("w_class", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("w_sig"), b * w + 1, F.lit(w))))).alias("bucket"))


def needed_matches(step: int, n: int, threshold: float, tolerance: float) -> list[int]:
    """needed[j]: fewest equal values among the first (j + 1) * step with which
    P(similarity >= threshold | matches) >= tolerance under a uniform prior (a beta posterior, summed exactly)."""
    needed = []
    for total in range(step, n + 1, step):
        m = 0
        while m <= total:
            # 1 - I_t(m + 1, total - m + 1): at most m successes in total + 1 trials of probability t
            p = sum(comb(total + 1, i) * threshold ** i * (1 - threshold) ** (total + 1 - i) for i in range(m + 1))
            if p >= tolerance:
                break
            m += 1
        needed.append(m)
    return needed


def link_blocks(sig_a, sh_a, off_a, sig_b, sh_b, off_b, same: bool, bands: int, rows: int, step: int,
                threshold: float, needed: list[int], count=None) -> tuple[np.ndarray, np.ndarray]:
    """Links between two blocks as index pairs (``same``: one block with itself, every pair once)."""
    na, nb = len(sig_a), len(sig_b)
    left, right = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    if not na or not nb:
        return left[0], right[0]
    size_a, size_b = np.diff(off_a), np.diff(off_b)
    # shingles numbered inside the task, so that membership is a table lookup
    values, code = np.unique(np.concatenate([sh_a, sh_b]), return_inverse=True)
    code_a, code_b = code[: len(sh_a)], code[len(sh_a):]
    flag = np.zeros(len(values), np.int32)
    for i in range(na):
        js = np.arange(i + 1 if same else 0, nb)
        # the sizes alone bound the similarity
        sa = size_a[i]
        js = js[np.minimum(size_b[js], sa) >= threshold * np.maximum(size_b[js], sa) - 1e-9]
        if not len(js):
            continue
        equal = sig_b[js] == sig_a[i]
        shared = equal.reshape(len(js), bands, rows).all(2).any(1)
        js, equal = js[shared], equal[shared]
        matches = np.zeros(len(js), np.int64)
        for s, least in enumerate(needed):
            matches += equal[:, s * step: (s + 1) * step].sum(1)
            keep = matches >= least
            js, equal, matches = js[keep], equal[keep], matches[keep]
        if not len(js):
            continue
        if count is not None:
            count.append(len(js))
        own = code_a[off_a[i]: off_a[i + 1]]
        flag[own] = 1
        if 4 * len(js) > nb:
            both = np.add.reduceat(flag[code_b], off_b[:-1])[js]
        else:
            n = size_b[js]
            at = np.zeros(len(js), np.int64)
            np.cumsum(n[:-1], out=at[1:])
            flat = np.repeat(off_b[js] - at, n) + np.arange(n.sum())
            both = np.add.reduceat(flag[code_b[flat]], at)
        flag[own] = 0
        linked = js[both >= threshold * (sa + size_b[js] - both) - 1e-9]
        left.append(np.full(len(linked), i, np.int32))
        right.append(linked.astype(np.int32))
    return np.concatenate(left), np.concatenate(right)


def smallest_linked(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node of its component; links are index pairs."""
    lab = np.arange(n)
    while True:
        new = lab.copy()
        np.minimum.at(new, left, lab[right])
        np.minimum.at(new, right, lab[left])
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def similarity_classes(docs: DataFrame, k: int = K, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                       tolerance: float = TOLERANCE, step: int = STEP,
                       block_shingles: int = BLOCK_SHINGLES, block_classes: int = BLOCK_CLASSES) -> tuple[DataFrame, DataFrame]:
    """(texts, classes): ``texts`` has a row per document (doc_id, w_class), ``classes`` a row per class that is linked
    with another (w_class, w_root, n_links)."""
    if (bands * rows) % step:
        raise ValueError("step must divide bands * rows")
    texts = shared_checkpoint(_classes(docs, k, bands, rows))
    classes = shared_checkpoint(texts.where("w_class is not null").groupBy("w_class")
                                .agg(F.first("w_sig").alias("w_sig"), F.first("w_n").alias("w_n")))

    keys = _band_keys(classes, bands, rows)
    stars = keys.groupBy("bucket").agg(F.min("w_class").alias("least"), F.count("*").alias("n")).where("n > 1")
    edges = keys.join(stars, "bucket").select(F.col("w_class").alias("u"), F.col("least").alias("v"))
    groups = components(edges).select(F.col("node").alias("w_class"), F.col("root").alias("w_group"))
    groups = shared_checkpoint(classes.join(groups, "w_class"))

    # every pair of a group's blocks is a task; most groups are one block
    sizes = (groups.groupBy("w_group").agg(F.sum("w_n").alias("total"), F.count("*").alias("n"))
             .select("w_group", F.ceil(F.greatest(F.col("total") / block_shingles, F.col("n") / block_classes)).cast("int").alias("blocks")))
    dealt = groups.join(sizes, "w_group")
    own = F.pmod(F.xxhash64("w_class"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).select(
        "w_class", "w_group", "w_sig", "own",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("w_class", "w_group", "w_sig", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    # the shingles come from one text of each candidate class
    source = (texts.where("w_class is not null").groupBy("w_class").agg(F.min("doc_id").alias("doc_id"))
              .join(groups.select("w_class"), "w_class", "left_semi"))
    payload = _shingles_of(docs, source, k)
    work = dealt.join(payload, "w_class").select("w_group", "low", "high", "own", "w_class", "w_sig", "w_sh")
    needed = needed_matches(step, bands * rows, threshold, tolerance)

    def run(table: pa.Table) -> pa.Table:
        return link_task(table, bands, rows, step, threshold, needed)

    found = shared_checkpoint(work.groupBy("w_group", "low", "high").applyInArrow(run, "w_class binary, n_links long, w_to binary"))
    counts = found.groupBy("w_class").agg(F.sum("n_links").alias("n_links")).where("n_links > 0")
    roots = components(found.where("n_links > 0").select(F.col("w_class").alias("u"), F.col("w_to").alias("v")))
    return texts, counts.join(roots.select(F.col("node").alias("w_class"), F.col("root").alias("w_root")), "w_class")


def _shingles_of(docs: DataFrame, source: DataFrame, k: int) -> DataFrame:
    """(w_class, w_sh) for each class of ``source``: the shingle set as binary, computed from the texts again."""

    def run(batches):
        for batch in batches:
            for _, _, h, off in shingle_sets(batch.column("text"), k):
                raw = h.astype("<u8").tobytes()
                sh = [raw[8 * off[i]: 8 * off[i + 1]] for i in range(len(off) - 1)]
                yield pa.RecordBatch.from_arrays([pa.array(class_keys(h, off), pa.binary()), pa.array(sh, pa.large_binary()).cast(pa.binary())],
                                                 ["w_class", "w_sh"])

    ids = source.select(F.col("doc_id").alias("w_doc"), F.col("w_class").alias("w_key")).distinct()
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("w_doc")), "left_semi").select("text")
    sets = small_batches(texts).mapInArrow(run, "w_class binary, w_sh binary")
    return sets.join(source.select("w_class"), "w_class", "left_semi").groupBy("w_class").agg(F.first("w_sh").alias("w_sh"))


def link_task(table: pa.Table, bands: int, rows: int, step: int, threshold: float, needed: list[int]) -> pa.Table:
    """Links of one task (one block, or two): (class, links found here, smallest class linked inside the task)."""
    table = table.sort_by([("own", "ascending"), ("w_class", "ascending")])
    key = table.column("w_class").to_pylist()
    own = table.column("own").to_numpy()
    sig = np.frombuffer(b"".join(table.column("w_sig").to_pylist()), "<u4").reshape(len(key), bands * rows)
    raw = table.column("w_sh").to_pylist()
    off = np.zeros(len(key) + 1, np.int64)
    np.cumsum([len(x) // 8 for x in raw], out=off[1:])
    sh = np.frombuffer(b"".join(raw), "<u8")
    n = len(key)
    left = right = np.zeros(0, np.int32)
    cut = int(np.searchsorted(own, own[0], "right")) if n else 0
    if cut == n and table.column("low")[0].as_py() != table.column("high")[0].as_py():
        pass                                  # two blocks, of which one is empty
    elif cut == n:
        left, right = link_blocks(sig, sh, off, sig, sh, off, True, bands, rows, step, threshold, needed)
    else:
        left, right = link_blocks(sig[:cut], sh[: off[cut]], off[: cut + 1], sig[cut:], sh[off[cut]:],
                                  off[cut:] - off[cut], False, bands, rows, step, threshold, needed)
        right = right + np.int32(cut)
    root = smallest_linked(n, left, right)
    links = np.bincount(left, minlength=n) + np.bincount(right, minlength=n)
    some = links > 0
    # the smallest name of each local component
    least: dict[int, bytes] = {}
    for i in np.flatnonzero(some).tolist():
        r = int(root[i])
        if r not in least or key[i] < least[r]:
            least[r] = key[i]
    return pa.table({"w_class": pa.array([key[i] for i in np.flatnonzero(some).tolist()], pa.binary()), "n_links": pa.array(links[some], pa.int64()),
                     "w_to": pa.array([least[int(r)] for r in root[some]], pa.binary())})


def ngram_join(docs: DataFrame, k: int = K, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """A row per document: doc_id, class_id (smallest doc_id among all texts connected with it), n_copies (documents with
    the same shingle set), n_links (different texts, as classes, at or above the threshold)."""
    texts, linked = similarity_classes(docs, k, threshold, **settings)
    classes = (texts.where("w_class is not null").groupBy("w_class")
               .agg(F.min("doc_id").alias("w_least"), F.count("*").alias("n_copies"))
               .join(linked, "w_class", "left")
               .select("w_class", "w_least", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                       F.coalesce("w_root", "w_class").alias("w_root")))
    classes = shared_checkpoint(classes)
    least = classes.groupBy("w_root").agg(F.min("w_least").alias("class_id"))
    classes = shared_checkpoint(classes.join(least, "w_root").select("w_class", "class_id", "n_copies", "n_links"))
    alone = F.col("class_id").isNull() & F.col("w_class").isNull()
    return (texts.join(classes, "w_class", "left")
            .select("doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def keep_representatives(docs: DataFrame, k: int = K, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one document: the row with the smallest ``doc_id`` (null
    last, then the smallest class key; of equal rows one). Texts without words all stay, but equal rows fold there too."""
    texts, linked = similarity_classes(docs, k, threshold, **settings)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "w_class"))
    firsts = texts.where("w_class is not null").groupBy("w_class").agg(best.alias("best"))
    kept = (firsts.join(linked.select("w_class", "w_root"), "w_class", "left")
            .groupBy(F.coalesce("w_root", "w_class").alias("w_root")).agg(F.min("best").alias("best"))
            .select(F.col("best.doc_id").alias("w_doc"), F.col("best.w_class").alias("w_key")))
    kept = shared_checkpoint(kept)
    keyed = with_class_key(docs, k)
    same = F.col("w_class").eqNullSafe(F.col("w_key")) & F.col("doc_id").eqNullSafe(F.col("w_doc"))
    chosen = keyed.where("w_class is not null").join(kept, (F.col("w_class") == F.col("w_key")) & same, "left_semi")
    chosen = chosen.dropDuplicates(["w_class", "doc_id"])
    return chosen.drop("w_class").unionByName(keyed.where("w_class is null").drop("w_class").distinct())


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`ngram_join` over all documents."""
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def brute_force(texts: list[tuple], k: int = K, threshold: float = THRESHOLD) -> dict:
    """Reference for tests: doc_id -> (class_id, n_copies, n_links) by comparing all pairs."""
    from prelaunch.llm.decontaminate import folded_words
    sets = []
    for i, t in texts:
        w = folded_words((t or "").encode())
        sets.append((i, frozenset(tuple(w[j: j + k]) for j in range(max(1, len(w) - k + 1))) if w else None))
    members: dict = {}
    for i, s in sets:
        if s is not None:
            members.setdefault(s, []).append(i)
    keys = list(members)
    parent = list(range(len(keys)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(keys)
    for a in range(len(keys)):
        for b in range(a + 1, len(keys)):
            n = len(keys[a] & keys[b])
            if n and n >= threshold * (len(keys[a]) + len(keys[b]) - n) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least: dict = {}
    for a in range(len(keys)):
        least[top(a)] = min([least.get(top(a), members[keys[a]][0]), *members[keys[a]]])
    out = {}
    for i, s in sets:
        a = keys.index(s) if s is not None else None
        out[i] = (i, 1, 0) if s is None else (least[top(a)], len(members[s]), links[a])
    return out
