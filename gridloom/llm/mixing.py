"""Mixing sources to target weights by soft membership, DataFrame and SQL functions only.

A table of labelled documents names the domain of some.  A multinomial naive Bayes classifier over
hashed words, fitted on a bounded sample of it, gives every document a posterior over domains:
its soft membership.  Only buckets whose count in some domain is far from its share of all words
carry weights; the many rare words would else outweigh the few that tell domains apart.  A document with rate r, n tokens and membership p adds r n p(k) expected
tokens to domain k.  Rates are nonnegative and minimise the squared distance of the domains' totals
from the targets, by projected gradient steps from rate one.

The squares are weighed by the inverse of the totals' curvature at rate one and rates by their
tokens, so a step of size one is safe and a document's rate only depends on its membership.
Domains can be kept whole: their likely documents have a rate of at least one.  A
step reads the documents once and moves one total per domain; nothing else reaches the driver.
Words are exploded inside the task that reads them and added up there, so one row per document is
shuffled.  The table of word weights that is broadcast has ``BUCKETS`` rows.
"""

from __future__ import annotations

import functools
import logging
import math
import operator
from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused, written

_log = logging.getLogger(__name__)

BUCKETS = 1 << 16
#: Labelled documents of each domain that the classifier is fitted on, about.
TRAIN_ROWS = 2000
SMOOTHING = 0.5
#: A bucket tells domains apart if a count is so many standard deviations from chance, and it or what chance would give is this large.
DEVIATION, LEAST_COUNT = 8.0, 5
#: Words that count in full; the evidence of longer texts is that of so many average words.
EVIDENCE = 200
#: Gradient steps at most, steps between two written tables, and the relative misfit that ends them.
STEPS, CUT, MISFIT = 60, 6, 1e-6

# The production targets: shares of all tokens for the domains of :func:`domains`.
TARGETS = {"clean": 0.90, "poor": 0.08, "toxic": 0.02}


def domains(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from the quality table, each pair once; rows without an id or any label are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.coalesce("quality", "toxic").isNotNull(), "clean")
    return labels.select("doc_id", domain.alias("domain")).where("doc_id IS NOT NULL AND domain IS NOT NULL").distinct()


def _words(docs: DataFrame, *keep: str) -> DataFrame:
    """A row per word with its bucket; a text without words keeps one row with a null bucket."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[ \t\r\n]+"), lambda w: w != "")
    word = F.explode_outer(words)
    return docs.select(*keep, word.alias("w")).select(*keep, F.when(F.col("w").isNotNull(), F.pmod(F.xxhash64("w"), F.lit(BUCKETS))).alias("bucket"))


def _weights(docs: DataFrame, labelled: DataFrame) -> tuple[list[str], DataFrame | None, list[float]]:
    """Domains, the table ``(bucket, w0, w1, ...)`` of the buckets that tell them apart, and log priors.

    A document that the labels name several times for one domain counts once.
    """
    labelled = labelled.select("doc_id", "domain").distinct()
    sizes = {r["domain"]: r["n"] for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}  # a row for each domain
    names = sorted(sizes)
    if not names:
        return [], None, []
    share = F.create_map(*(F.lit(x) for d in names for x in (d, min(1.0, TRAIN_ROWS / sizes[d]))))
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) < share[F.col("domain")] * (1 << 30))
    # The sample holds about TRAIN_ROWS distinct ids of each domain, so it may be sent to every task.
    some = docs.join(F.broadcast(sample.select("doc_id", "domain")), "doc_id")
    counts = [F.coalesce(F.sum(F.when(F.col("domain") == d, 1)), F.lit(0)).alias(f"c{k}") for k, d in enumerate(names)]
    table = written(_words(some, "domain").where("bucket IS NOT NULL").groupBy("bucket").agg(*counts), "word-counts")
    totals = table.agg(*(F.coalesce(F.sum(f"c{k}"), F.lit(0)).alias(f"c{k}") for k in range(len(names)))).first()

    n = [totals[k] for k in range(len(names))]
    share = sum((F.col(f"c{k}") for k in range(len(names))), F.lit(0)) / float(max(1, sum(n)))
    chance = [share * float(size) for size in n]
    # A little is added so that rounding alone is no deviation.
    far = [F.abs(F.col(f"c{k}") - e) > F.sqrt(e * (1 - size / max(1, sum(n)))) * DEVIATION + 1e-6 for k, (e, size) in enumerate(zip(chance, n, strict=True))]
    large = [F.greatest(F.col(f"c{k}").cast("double"), e) >= LEAST_COUNT for k, e in enumerate(chance)]
    telling = table.where(functools.reduce(operator.or_, (a & b for a, b in zip(far, large, strict=True))))
    weights = telling.select("bucket", *(F.ln((F.col(f"c{k}") + SMOOTHING) / (n[k] + SMOOTHING * BUCKETS) / share).alias(f"w{k}") for k in range(len(names))))
    every = sum(sizes.values())
    return names, weights, [math.log(sizes[d] / every) for d in names]


def memberships(docs: DataFrame, labelled: DataFrame) -> tuple[list[str], DataFrame]:
    """Domains, and a written table ``(doc_id, uid, n_tokens, p0, p1, ...)`` with a row for every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names, weights, prior = _weights(docs, labelled)
    words = _words(docs.withColumn("uid", F.monotonically_increasing_id()), "doc_id", "uid")
    if weights is None:
        return [], written(words.groupBy("doc_id", "uid").agg(F.count("bucket").alias("n_tokens")), "memberships")
    joined = words.join(F.broadcast(weights), "bucket", "left")  # BUCKETS rows at most
    sums = [F.sum(F.coalesce(f"w{k}", F.lit(0.0))).alias(f"s{k}") for k in range(len(names))]
    found = joined.groupBy("doc_id", "uid").agg(F.count("bucket").alias("n_tokens"), *sums)
    temper = F.when(F.col("n_tokens") > EVIDENCE, F.lit(float(EVIDENCE)) / F.col("n_tokens")).otherwise(1.0)
    found = found.select("doc_id", "uid", "n_tokens", *((F.col(f"s{k}") * temper + prior[k]).alias(f"s{k}") for k in range(len(names))))
    top = F.greatest(*(F.col(f"s{k}") for k in range(len(names))), F.lit(-1e300)) if len(names) > 1 else F.col("s0")
    found = found.select("doc_id", "uid", "n_tokens", *(F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in range(len(names))))
    total = sum((F.col(f"e{k}") for k in range(len(names))), F.lit(0.0))
    return names, written(found.select("doc_id", "uid", "n_tokens", *((F.col(f"e{k}") / total).alias(f"p{k}") for k in range(len(names)))), "memberships")


def _inverse(matrix: list[list[float]]) -> list[list[float]]:
    """Inverse of a small symmetric matrix, its diagonal raised a little so that it has one."""
    m = len(matrix)
    lift = 1e-9 * max(1e-12, sum(matrix[k][k] for k in range(m)))
    a = [[matrix[i][j] + lift * (i == j) for j in range(m)] + [float(i == j) for j in range(m)] for i in range(m)]
    for c in range(m):
        pivot = max(range(c, m), key=lambda r: abs(a[r][c]))
        a[c], a[pivot] = a[pivot], a[c]
        a[c] = [x / a[c][c] for x in a[c]]
        for r in range(m):
            if r != c:
                a[r] = [x - a[r][c] * y for x, y in zip(a[r], a[c], strict=True)]
    return [row[m:] for row in a]


def _likeliest(names: list[str]) -> Column:
    """The likeliest domain, of equal ones the first by name."""
    top: Column = F.lit(None).cast("string")
    if names:
        best = F.greatest(*(F.col(f"p{k}") for k in range(len(names)))) if len(names) > 1 else F.col("p0")
        for k in reversed(range(len(names))):
            top = F.when(F.col(f"p{k}") == best, F.lit(names[k])).otherwise(top)
    return top


def rates(members: DataFrame, names: list[str], targets: dict[str, float], budget: float = 1.0, keep: Collection[str] = ()) -> DataFrame:
    """``members`` with a column ``rate``.

    ``targets``: shares of the mix for domains, scaled to sum to one; a domain not named gets
    none.  ``budget``: size of the mix as a share of all tokens.  No domain known, no token, or no
    target for any known domain: every rate is one.  ``keep``: a document whose likeliest domain is
    one of these has a rate of one or more; if that puts the targets out of reach, the totals come
    as near to them as it allows.
    """
    m, wanted = len(names), [targets.get(d, 0.0) for d in names]
    now, p = members.withColumn("rate", F.lit(1.0)), [F.col(f"p{k}") for k in range(m)]
    if not m or not sum(wanted):
        return now
    n = F.col("n_tokens").cast("double")
    sums = now.agg(*(F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(m) for j in range(i, m)), F.sum(n).alias("n")).first()
    if not sums["n"]:
        return now
    metric = _inverse([[sums[f"g{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)])
    goal = [budget * sums["n"] * w / sum(wanted) for w in wanted]
    least = F.when(_likeliest(names).isin(*keep), 1.0).otherwise(0.0) if keep else F.lit(0.0)
    before = None
    for step in range(1, STEPS + 1):
        totals = now.agg(*(F.sum(F.col("rate") * n * p[k]).alias(f"t{k}") for k in range(m))).first()
        miss = [totals[k] - goal[k] for k in range(m)]
        move = [sum(metric[i][j] * miss[j] for j in range(m)) for i in range(m)]
        if max(map(abs, miss)) <= MISFIT * sum(goal) or max(map(abs, move)) < 1e-9:
            break
        if before and max(abs(totals[k] - before[k]) for k in range(m)) <= MISFIT * sum(goal):
            break  # the bounds hold the totals where they are
        before = totals
        down = sum((F.lit(move[k]) * p[k] for k in range(m)), F.lit(0.0))
        now = now.withColumn("rate", F.greatest(least, F.col("rate") - down))
        if step % CUT == 0:
            now = written(now, "rates")
    else:
        _log.warning("mixing stopped after %d steps; totals miss the targets by %s of %s tokens", STEPS, [round(x) for x in miss], [round(x) for x in goal])
    return now


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, budget: float = 1.0, keep: Collection[str] = ()) -> DataFrame:
    """``(doc_id, uid, n_tokens, domain, rate)`` of every row; ``uid`` tells rows that repeat an id apart.

    Tokens are words between white space.  A null or empty text has none; its membership is the
    prior and its rate counts for nothing.  ``domain`` is the likeliest one, of equal ones the
    first by name; null if no row is labelled.  Labels of one domain alone, or of no document with
    words, tell nothing: every membership is the prior and every rate is equal.  Other columns are ignored.  No rows: no rows.
    """
    names, members = memberships(docs, labelled)
    found = rates(members, names, targets or TARGETS, budget, keep)
    return found.select("doc_id", "uid", "n_tokens", _likeliest(names).alias("domain"), "rate", *(F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(names)))


def resample(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as their rate says, all columns as they are.

    A rate is met in expectation: its whole part gives sure copies, and a hash of the id decides
    on one more.  Rows that repeat an id take that id's mean rate, rows without an id stay once.
    """
    key, rate, times, turn = (unused(docs, name) for name in ("mix_id", "mix_rate", "mix_times", "mix_turn"))
    chance = F.pmod(F.xxhash64(key, F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    often = mixed.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.avg("rate").alias(rate))
    often = often.select(key, (F.floor(rate) + F.when(chance < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("int").alias(times)).where(F.col(times) > 0)
    chosen = docs.join(often, F.col("doc_id").cast("long") == F.col(key)).drop(key)
    repeated = chosen.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(turn, times)
    return repeated.unionByName(docs.where("doc_id IS NULL"))
