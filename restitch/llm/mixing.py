"""Problem 9: sources mixed to target shares of all tokens.

Poisson replication.  The mean repetition of a source follows from its target share and
its tokens; every document draws its number of copies by inverting the Poisson
distribution of that mean, cut at the source's cap, at a number in [0, 1) that is a
hash of its id and the seed.  So the draw needs no state, survives any re-execution,
and never depends on the partitioning.  The copies are exploded and shuffled globally
by the hash of id and copy.

The size of the mix is the largest at which no source needs more than its cap.  As the
hashed numbers are fixed, the tokens that a mean yields are known before any copy is
made: tokens per source and bucket of the number, at most BUCKETS rows per target source,
are summed with map-side combine, and the mean of each source is solved against them, so
that the actual shares meet the targets up to one bucket.

Defined results: documents without tokens, without a source or of a source without a
target share are not used; a target source without tokens has actual share 0 and the
others keep their proportions; a null cap counts as 1, a null or negative share as 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from restitch.llm.tokens import encode
from restitch.session import written

SEED = 20_040_101
BUCKETS = 1024


def unit(*cols: Column | str, seed: int = SEED) -> Column:
    """A number in [0, 1) that is a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def copies(u: float, mean: float, cap: int) -> int:
    """Inverse of the Poisson distribution at u, cut at cap."""
    return sum(u >= t for t in thresholds(mean, cap))


def thresholds(mean: float, cap: int) -> list[float]:
    """A document with number u gets as many copies as thresholds are at most u."""
    if mean <= 0:
        return [2.0] * cap
    if math.isinf(mean):
        return [0.0] * cap
    out, total = [], 0.0
    for k in range(cap):  # logarithms, as the first terms of a large mean vanish otherwise
        total += math.exp(k * math.log(mean) - mean - math.lgamma(k + 1))
        out.append(min(total, 1.0))
    return out


def solve(buckets: list[tuple[float, int]], cap: int, goal: float) -> float:
    """The mean at which the bucketed tokens, repeated, come to ``goal``; infinite when every document needs its cap."""
    total = sum(n for _, n in buckets)
    if goal <= 0 or total == 0:
        return 0.0
    if goal >= total * cap * (1 - 1e-9):
        return math.inf

    def got(mean: float) -> float:
        ts = thresholds(mean, cap)
        return sum(n * sum(u >= t for t in ts) for u, n in buckets)

    lo, hi = 0.0, 1.0
    while got(hi) < goal:  # ends, as the goal is less than every document at its cap
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if got(mid) < goal else (lo, mid)
    return hi if abs(got(hi) - goal) <= abs(got(lo) - goal) else lo


class Mix:
    def __init__(self, documents: DataFrame, targets: DataFrame, seed: int = SEED, **tokenizer: object) -> None:
        self.seed = seed
        self.targets = {
            r["source"]: (max(0.0, r["target_share"] or 0.0), max(0, 1 if r["max_repeats"] is None else r["max_repeats"]))
            for r in targets.where("source is not null").select("source", "target_share", "max_repeats").collect()  # one row per source, a configuration
        }
        # only documents of a source with a target are tokenised
        wanted = documents.where(F.col("doc_id").isNotNull() & F.col("source").isin(list(self.targets) or [""]))
        sized = encode(wanted, counts_only=True, keep=("source",), **tokenizer)
        self.sized = written(sized.where("n_tokens > 0").withColumn("u", unit("doc_id", seed=seed)))
        rows = (
            self.sized.groupBy("source", F.floor(F.col("u") * BUCKETS).cast("int").alias("b")).agg(F.sum("n_tokens").alias("n")).collect()
        )
        by: dict[str, list[tuple[float, int]]] = {s: [] for s in self.targets}
        for r in rows:
            by[r["source"]].append(((r["b"] + 0.5) / BUCKETS, r["n"]))
        self.tokens = {s: sum(n for _, n in v) for s, v in by.items()}
        #: A mean moves the tokens of a source by whole buckets, one copy at a time: this is the most that a share can miss by.
        self.coarsest = {s: max((n for _, n in v), default=0) for s, v in by.items()}
        usable = [s for s, (share, cap) in self.targets.items() if share > 0 and cap > 0 and self.tokens[s] > 0]
        self.size = min((self.tokens[s] * self.targets[s][1] / self.targets[s][0] for s in usable), default=0.0)
        self.means = {s: solve(by[s], self.targets[s][1], self.size * self.targets[s][0]) if s in usable else 0.0 for s in self.targets}

    def drawn(self) -> DataFrame:
        """(doc_id, source, n_tokens, n_copies) of every document that is used."""
        spark = self.sized.sparkSession
        table = spark.createDataFrame(
            [(s, thresholds(self.means[s], cap)) for s, (_, cap) in self.targets.items()], "source string, ts array<double>"
        )  # one row per target source
        return (
            self.sized.join(F.broadcast(table), "source")
            .withColumn("n_copies", F.size(F.filter("ts", lambda t: F.col("u") >= t)))
            .where("n_copies > 0").select("doc_id", "source", "n_tokens", "n_copies")
        )

    def mixed(self) -> DataFrame:
        """(doc_id, source, copy, n_tokens, shuffle_key), one row per copy, in the order of the key."""
        return (
            self.drawn().withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
            .withColumn("shuffle_key", F.xxhash64(F.lit(self.seed + 1), "doc_id", "copy"))
            .select("doc_id", "source", "copy", "n_tokens", "shuffle_key").orderBy("shuffle_key", "doc_id", "copy")
        )

    def shares(self) -> DataFrame:
        """(source, target_share, max_repeats, tokens, mean_repeats, docs_used, most_copies, mixed_tokens, actual_share, deviation, bound) per target source.

        deviation is what the actual share misses the target by, the targets scaled to the sources that have
        tokens; bound the most it may: all sources off by their coarsest bucket, and rounding inside a bucket.
        """
        spark = self.sized.sparkSession
        usable = sum(share for s, (share, _) in self.targets.items() if self.means[s] > 0) or 1.0
        bound = min(1.0, 2 * sum(self.coarsest[s] * max(1, self.targets[s][1]) for s in self.targets if self.means[s] > 0) / self.size) if self.size else 0.0
        known = spark.createDataFrame(
            [
                (s, share, cap, self.tokens[s], self.size * share / self.tokens[s] if self.tokens[s] else 0.0, share / usable if self.means[s] > 0 else 0.0, bound)
                for s, (share, cap) in self.targets.items()
            ],
            "source string, target_share double, max_repeats int, tokens bigint, mean_repeats double, scaled double, bound double",
        )
        used = self.drawn().groupBy("source").agg(
            F.count(F.lit(1)).alias("docs_used"), F.max("n_copies").alias("most_copies"), F.sum(F.col("n_copies") * F.col("n_tokens")).alias("mixed_tokens")
        )
        total = used.agg(F.sum("mixed_tokens").alias("all_tokens"))
        return (
            known.join(used, "source", "left").join(F.broadcast(total))  # one row
            .select(
                "source", "target_share", "max_repeats", "tokens", "mean_repeats", F.coalesce("docs_used", F.lit(0)).alias("docs_used"),
                F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
                F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)).alias("actual_share"),
                (F.coalesce(F.col("mixed_tokens") / F.col("all_tokens"), F.lit(0.0)) - F.col("scaled")).alias("deviation"), "bound",
            )
        )
