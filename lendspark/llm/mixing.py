"""Mixing sources to target weights by soft membership, with DataFrame and SQL functions only.

A labelled table (doc_id, domain) trains a naive Bayes classifier over discretised features of whole texts
(length, line length, word length, shares of symbols, digits and capitals, repeated lines, language), so that
every document has a posterior over domains: mixed documents count in part for each. Document rates r >= 0
then minimise

    1/2 * sum over domains (expected share of tokens - target)^2 / share before + MU/2 * sum of token shares * (r - 1)^2

(so a small domain counts by its relative gap, and a unit step never overshoots) by projected gradient: every step is one aggregate over (posterior, tokens) that returns as many numbers as
there are domains, and the next rates are an expression of these. A rate r becomes floor(r) copies and one
more where a hash of the document lies below the remainder, so the expectation is exact and a retry repeats it.

Defined cases. NULL text counts as empty, with no tokens: its rate follows the same rule. NULL labels are
left out; several domains for one id: the largest by name. Domains without a label are not learned; a target
for such a domain is refused. No labels or no tokens: all rates are 1. Rows that repeat an id
are taken equally often by ``mixed``: as the one with most copies, if their texts differ.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.llm.frames import stored

MU = 0.01
STEPS = 60
ENOUGH = 1e-6
#: Domains at most: each is a column and a number on the driver.
MAX_DOMAINS = 64


def _share(pattern_free: Column, whole: Column) -> Column:
    return F.coalesce((whole - pattern_free) / F.greatest(whole, F.lit(1)), F.lit(0.0))


def _grade(value: Column, edges: list[float]) -> Column:
    """How many of the edges the value reaches."""
    return reduce(lambda a, e: a + (value >= e).cast("int"), edges, F.lit(0))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, tokens, f0, f1, ...): tokens are words between spaces and line ends; features are small integers."""
    text, lang = F.coalesce("text", F.lit("")), F.coalesce(F.col("lang").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), lang.alias("lang"))
    lines = F.split("text", "\n", -1)
    base = base.select(
        "doc_id", "lang", F.length("text").alias("n"), F.size(lines).alias("n_lines"), F.size(F.array_distinct(lines)).alias("n_distinct"),
        _without(F.col("text"), " \n\t").alias("no_space"), _without(F.col("text"), "0123456789").alias("no_digit"),
        _without(F.col("text"), "#$%&*|@!?/\\=_<>{}[]~^+").alias("no_symbol"), _without(F.col("text"), ".,;:").alias("no_stop"),
        _without(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("no_capital"),
    )
    n = F.col("n")
    words = F.when(n > 0, n - F.col("no_space") + 1).otherwise(0)
    fine = [0.0005, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2]
    grades = [
        _grade(n, [1, 50, 100, 200, 400, 800, 1600, 3200, 6400, 12800, 25600]),
        _grade(n / F.greatest(F.col("n_lines"), F.lit(1)), [10, 30, 60, 120, 240, 480, 960]),
        _grade(F.col("no_space") / F.greatest(words, F.lit(1)), [2, 3, 4, 5, 6, 7, 8, 10]),
        _grade(_share(F.col("no_digit"), n), fine),
        _grade(_share(F.col("no_symbol"), n), fine),
        _grade(_share(F.col("no_stop"), n), fine),
        _grade(_share(F.col("no_capital"), n), fine),
        _grade(1 - F.col("n_distinct") / F.col("n_lines"), [0.01, 0.05, 0.1, 0.3, 0.6]),
        F.pmod(F.xxhash64("lang"), F.lit(64)).cast("int"),
    ]
    return base.select("doc_id", words.cast("long").alias("tokens"), *[g.alias(f"f{i}") for i, g in enumerate(grades)])


def posteriors(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, list[str]]:
    """((doc_id, tokens, posterior array) of every row, domains). ``labels`` has doc_id and domain."""
    rows = stored(features(docs), "mixing-features")
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("domain").cast("string").alias("domain"))
        .where("doc_id IS NOT NULL AND domain IS NOT NULL").groupBy("doc_id").agg(F.max("domain").alias("domain"))
    )
    names = [c for c in rows.columns if c.startswith("f")]
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(names)]))
    counts = stored(
        rows.join(known, "doc_id").select("domain", cells.alias("c")).groupBy("domain", "c.i", "c.v").agg(F.count(F.lit(1)).alias("n")), "mixing-counts"
    )
    domains = sorted(r["domain"] for r in counts.select("domain").distinct().collect())
    if len(domains) > MAX_DOMAINS:
        raise ValueError(f"{len(domains)} domains; at most {MAX_DOMAINS}")
    if not domains:
        return rows.select("doc_id", "tokens", F.array().cast("array<double>").alias("posterior")), []
    # At most 64 grades x features x domains numbers: literals of the plan.
    table = {(r["domain"], r["i"], r["v"]): r["n"] for r in counts.collect()}
    total = {d: sum(n for (e, i, _), n in table.items() if e == d and i == 0) for d in domains}
    logs = []
    for d in domains:
        score = F.log(F.lit(total[d] / sum(total.values())))
        for i, c in enumerate(names):
            values = F.create_map(*[F.lit(x) for v in range(65) for x in (v, float(_log_share(table, total, d, i, v)))])
            score = score + F.coalesce(values[F.col(c)], F.lit(float(_log_share(table, total, d, i, -1))))
        logs.append(score)
    scored = rows.select("doc_id", "tokens", F.array(*logs).alias("logs"))
    raised = scored.select("doc_id", "tokens", F.expr("transform(logs, x -> exp(x - array_max(logs)))").alias("p"))
    share = F.expr("transform(p, x -> x / aggregate(p, 0D, (a, y) -> a + y))")
    return raised.select("doc_id", "tokens", share.alias("posterior")), domains


def _log_share(table: dict, total: dict, domain: str, feature: int, value: int) -> float:
    return log((table.get((domain, feature, value), 0) + 0.5) / (total[domain] + 0.5 * 65))


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], mu: float = MU, steps: int = STEPS) -> DataFrame:
    """(doc_id, tokens, posterior, rate) of every row of ``docs`` (doc_id, text, lang); targets are shares of all tokens."""
    soft, domains = posteriors(docs, labels)
    if unknown := set(targets) - set(domains) if domains else set():
        raise ValueError(f"no label for {sorted(unknown)}")
    soft = stored(soft, "mixing-posteriors")
    total = soft.agg(F.sum("tokens")).first()[0] or 0
    if not domains or not total:
        return soft.withColumn("rate", F.lit(1.0))
    scale = sum(targets.values())
    aim = [targets.get(d, 0.0) / scale for d in domains]
    # The rates after any number of steps are one expression of the posterior and of the gaps so far: no table of their own.
    rate, last, share = F.lit(1.0), None, None
    for _ in range(steps):
        sums = [F.sum(F.col("tokens") * F.col("rate") * F.col("posterior")[k]).alias(f"s{k}") for k in range(len(domains))]
        now = soft.withColumn("rate", rate).agg(*sums).first()
        held = [float(now[k]) / total for k in range(len(domains))]
        share = share or [max(h, 1e-9) for h in held]  # before any step
        gap = [(h - a) / s for h, a, s in zip(held, aim, share, strict=True)]
        if last and max(abs(a - b) for a, b in zip(gap, last, strict=True)) < ENOUGH:
            break
        rate, last = _next(rate, gap, mu), gap
    return soft.withColumn("rate", rate)


def _next(rate: Column, gap: list[float], mu: float) -> Column:
    """max(0, r - step * (posterior . gap + mu (r - 1))), with r written once so that the chain of steps stays short."""
    step = 1.0 / (1.0 + mu)
    along = reduce(lambda a, b: a + b, [F.col("posterior")[k] * F.lit(step * g) for k, g in enumerate(gap)])
    return F.greatest(F.lit(0.0), rate * F.lit(1 - step * mu) + F.lit(step * mu) - along)


def copies(rate: Column, seed: str = "mixing") -> Column:
    """floor(rate), and one more with the probability of the remainder, by a hash of the document id."""
    coin = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (coin < rate - F.floor(rate)).cast("int")).cast("int")


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """Rows of ``docs`` as often as their rates say; the columns stay."""
    r = rates(docs, labels, targets).groupBy("doc_id").agg(F.max(copies(F.col("rate"))).alias("copies"))
    whole = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    joined = whole.join(r.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")))
    often = joined.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("k"))
    return often.select("row.*")
