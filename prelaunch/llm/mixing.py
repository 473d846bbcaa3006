"""Mixing sources to target weights by Poisson replication.

Every source has a target share of the mixture's text. Its repetition rate is what brings the expected amount of its
text (characters) to share x budget, where the budget is the whole input's text unless one is given. Each document is
repeated k times, k drawn by inverting a Poisson distribution with that mean at a uniform number hashed from seed and
document, so any partitioning and any retry draw the same. Rates above ``PART`` are drawn as sums of equal parts, whose
smaller exponentials stay exact. Copies are exploded and shuffled globally: sorted by a hash of seed, document and copy.

Scale: masses are one aggregate per source (a hot source is one row a task); rates come back as literals, their number
being that of the sources, checked against ``MAX_SOURCES`` (a join on source beyond it). Drawing is row-local in JVM
expressions. Only the copies that are drawn are shuffled, by ranges of the shuffle key, which no source or document can skew.

Edge cases: a null ``source`` is a source of its own; without given weights all sources weigh the same. Texts that
are null or empty count no mass but are drawn at their source's rate; a source without any mass has rate 0. A null
``doc_id`` is drawn by its text's hash. Rows that repeat a ``doc_id`` are drawn alike, and ties of the shuffle key order by
copy. An empty table gives an empty result. Further columns stay as they are.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prelaunch.llm.components import shared_checkpoint

SEED = 17
PART = 16.0
MAX_SOURCES = 5_000
NO_SOURCE = "\u0000none"


def _document(seed: int) -> Column:
    return F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.md5(F.coalesce("text", F.lit(""))))))


def hash_uniform(text: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of md5."""
    return F.conv(F.substr(F.md5(text), F.lit(1), F.lit(13)), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The smallest k with P(X <= k) > u for a Poisson variable of the given mean (at most ``PART``)."""
    steps = F.sequence(F.lit(1), F.lit(100))
    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("term"), F.exp(-mean).alias("total"))

    def step(a, i):
        term = a["term"] * mean / i
        return F.when(a["total"] > u, a).otherwise(F.struct((a["k"] + 1).alias("k"), term.alias("term"), (a["total"] + term).alias("total")))

    return F.aggregate(steps, start, step, lambda a: a["k"])


def repetitions(mean: Column, document: Column) -> Column:
    """Poisson count of the document: a sum over ceil(mean / PART) equal parts, each from its own uniform."""
    parts = F.greatest(F.ceil(mean / PART).cast("int"), F.lit(1))
    draws = F.transform(F.sequence(F.lit(0), parts - 1), lambda j: poisson_inverse(
        hash_uniform(F.concat(document, F.lit("#"), j.cast("string"))), mean / parts))
    return F.when(mean > 0, F.aggregate(draws, F.lit(0), lambda a, k: a + k)).otherwise(0)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, budget: float | None = None) -> DataFrame:
    """(w_source, mass, rate) of every source. ``weights`` default to equal ones; a source left out weighs 0."""
    mass = F.coalesce(F.sum(F.length("text")), F.lit(0))
    masses = shared_checkpoint(docs.groupBy(F.coalesce("source", F.lit(NO_SOURCE)).alias("w_source")).agg(mass.alias("mass")))
    n, total = masses.agg(F.count("*"), F.sum("mass")).first()
    goal = float(total or 0) if budget is None else float(budget)
    if weights is None:
        share = F.lit(goal) / F.lit(float(max(n, 1)))
    else:
        named = {NO_SOURCE if k is None else k: float(v) for k, v in weights.items()}
        all_of = sum(named.values()) or 1.0
        share = F.lit(0.0)
        for k, v in named.items():
            share = F.when(F.col("w_source") == k, F.lit(goal * (v / all_of))).otherwise(share)
    return masses.select("w_source", "mass", F.when(F.col("mass") > 0, share / F.col("mass").cast("double")).otherwise(0.0).alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """The mixture: all columns of ``docs``, copy (from 0) and shuffle_key, in shuffled order."""
    rates = source_rates(docs, weights, budget)
    n = rates.count()
    source = F.coalesce("source", F.lit(NO_SOURCE))
    if n <= MAX_SOURCES:
        known = {r["w_source"]: r["rate"] for r in rates.collect()}
        table = F.create_map(*[F.lit(x) for kv in known.items() for x in kv]) if known else None
        rated = docs.withColumn("w_rate", F.element_at(table, source) if known else F.lit(0.0))
    else:
        rated = docs.withColumn("w_source", source).join(rates.select("w_source", F.col("rate").alias("w_rate")), "w_source").drop("w_source")
    drawn = rated.withColumn("w_copies", repetitions(F.col("w_rate"), _document(seed))).where("w_copies > 0")
    copies = drawn.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(0), F.col("w_copies") - 1)).alias("w_copy"))
    key = F.xxhash64(F.lit(seed), _document(seed), "w_copy")
    taken = {c.lower() for c in docs.columns}
    shuffled = copies.withColumn("w_key", key).repartitionByRange("w_key", "w_copy").sortWithinPartitions("w_key", "w_copy")
    names = [n if n not in taken else f"mix_{n}" for n in ("copy", "shuffle_key")]
    return shuffled.withColumnsRenamed({"w_copy": names[0], "w_key": names[1]})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The equal-weight mixture of all documents: doc_id, source, copy, text, in shuffled order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "source", "copy", "text")


def brute_force(rows: list[tuple], seed: int = SEED) -> list[tuple]:
    """Reference for tests: (doc_id, copy) of (doc_id, text, source) rows with equal weights."""
    import hashlib
    mass: dict = {}
    for _, text, source in rows:
        mass[source] = mass.get(source, 0) + len(text or "")
    out = []
    for i, text, source in rows:
        rate = sum(mass.values()) / len(mass) / mass[source] if mass[source] else 0.0
        name = f"{seed}:" + (str(i) if i is not None else "t" + hashlib.md5((text or "").encode()).hexdigest())
        parts, n = max(1, -int(-rate // PART)), 0
        for j in range(parts if rate else 0):
            u = int(hashlib.md5(f"{name}#{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
            term = total = exp(-rate / parts)
            k = 0
            while total <= u and k < 100:
                k += 1
                term = term * (rate / parts) / k
                total += term
            n += k
        out += [(i, c) for c in range(n)]
    return out


ORACLE_SQL = f"""
WITH m AS (SELECT source, sum(length(coalesce(text, ''))) AS mass FROM documents GROUP BY source),
t AS (SELECT sum(mass)::DOUBLE / count(*) AS share FROM m),
r AS (SELECT source, CASE WHEN mass > 0 THEN share / mass::DOUBLE ELSE 0 END AS rate,
             greatest(ceil(CASE WHEN mass > 0 THEN share / mass::DOUBLE ELSE 0 END / {PART}), 1)::INTEGER AS parts FROM m, t),
c AS (SELECT source, k, sum(term) OVER (PARTITION BY source ORDER BY k) AS total
      FROM (SELECT source, k, exp(-(rate / parts) + k * ln(rate / parts) - lgamma(k + 1)) AS term
            FROM r, generate_series(0, 100) AS g(k) WHERE rate > 0)),
d AS (SELECT row_number() OVER () AS rid, * FROM documents),
u AS (SELECT rid, d.source, ('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 't' || md5(coalesce(text, ''))) || '#' || j), 1, 13))::BIGINT
             / {float(1 << 52)} AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source AND rate > 0, generate_series(0, 1000) AS g(j) WHERE j < parts),
n AS (SELECT rid, sum(k) AS n FROM (SELECT u.rid, j_k.k FROM u, LATERAL (SELECT min(k) AS k FROM c WHERE c.source IS NOT DISTINCT FROM u.source AND total > u.u) AS j_k)
      GROUP BY rid)
SELECT doc_id, source, CAST(g.c AS INTEGER) AS copy, text FROM d JOIN n USING (rid), generate_series(0, 1000) AS g(c) WHERE g.c < n.n
"""
