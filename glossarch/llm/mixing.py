"""Problem 8: a mixture of sources by target shares, with a cap on repetition.

Shares are filled like vessels: a source that would need more than its cap is held at it and the excess goes to the
others in proportion, until nothing exceeds. A source's epochs are then whole repetitions of every document plus a
seeded part of them: documents in the order of a hash, up to the tokens that are missing; the one that goes beyond is taken where that is nearer to the
goal. The order is never materialised: running sums over a histogram of hash slices give the slice at which to stop, those over the finer slices of that one refine it,
and the few documents of the last are taken one by one. All of it stays in tables; the driver has the sources' allotments alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossarch.plans.scratch import written

#: slices of each of the two histograms, and the most sources
SLICES, SOURCES = 1 << 12, 100_000


@dataclass
class Allotment:
    source: str
    target_share: float
    max_repeats: int
    available: int
    tokens: float = 0.0

    @property
    def epochs(self) -> float:
        return self.tokens / self.available if self.available else 0.0


def fill(sources: list[Allotment], total: float) -> list[Allotment]:
    """Sets ``tokens`` of each source: ``total`` by target share, none above ``available * max_repeats``.

    If all sources together cannot give ``total``, each with a positive share gives what it can.
    """
    free = [s for s in sources if s.available > 0 and s.target_share > 0 and s.max_repeats > 0]
    left = float(total)
    for s in sources:
        s.tokens = 0.0
    while free and left > 0:
        shares = sum(s.target_share for s in free)
        full = [s for s in free if left * s.target_share / shares >= s.available * s.max_repeats]
        if not full:
            for s in free:
                s.tokens = left * s.target_share / shares
            break
        for s in full:
            s.tokens = float(s.available * s.max_repeats)
        left -= sum(s.tokens for s in full)
        free = [s for s in free if s not in full]
    return sources


def _weights(weights: DataFrame) -> dict[str, tuple[float, int]]:
    """One row per source: of contradicting rows that of the greatest share. Null, negative or NaN shares are 0, null caps are 1."""
    share = F.when((F.col("target_share") > 0) & ~F.isnan("target_share"), F.col("target_share")).otherwise(0.0)
    rows = weights.filter("source is not null").select("source", share.alias("s"), F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)).alias("m"))
    best = rows.groupBy("source").agg(F.max(F.struct("s", "m")).alias("b")).limit(SOURCES + 1).collect()
    if len(best) > SOURCES:
        raise ValueError(f"more than {SOURCES} sources")
    return {r["source"]: (r["b"]["s"], r["b"]["m"]) for r in best}


def _reached(sums: DataFrame, order: str) -> DataFrame:
    """``source``, the slice in which the tokens a source misses (``left``) are passed, and what is missing before it."""
    total = F.sum("n").over(Window.partitionBy("source").orderBy(order))
    rows = sums.withColumn("total", total).filter((F.col("total") - F.col("n") <= F.col("left")) & (F.col("left") < F.col("total")))
    return rows.select("source", F.col(order).alias(f"edge_{order}"), (F.col("left") - F.col("total") + F.col("n")).alias("left"))


def mixture(counted: DataFrame, weights: DataFrame, total: float | None = None, seed: int = 0) -> tuple[DataFrame, list[Allotment]]:
    """The mixture as ``key, source, tokens, repeats`` (documents that occur at least once) and the allotments.

    ``counted`` has ``key, source, tokens``; rows with null source, without tokens or with a source that has no weight take no
    part. ``total`` is the wanted size, by default that of all documents taking part. ``weights`` (one row per source, at most ``SOURCES``) is
    collected. What a source reaches differs from its plan by at most half of the tokens of one of its documents.
    """
    known, spark = _weights(weights), counted.sparkSession
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("key")), F.lit(SLICES * SLICES))
    rows = counted.filter("source is not null and tokens > 0").select("key", "source", "tokens", place.alias("h"))
    used = spark.createDataFrame([(s,) for s, (w, m) in known.items() if w > 0 and m > 0], "source string")
    rows = rows.join(F.broadcast(used), "source", "left_semi")
    rows = written(rows.select("key", "source", "tokens", F.floor(F.col("h") / SLICES).cast("int").alias("coarse"), (F.col("h") % SLICES).cast("int").alias("fine")), "counted")
    have = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    plan = [Allotment(s, w, m, have.get(s, 0)) for s, (w, m) in sorted(known.items())]
    fill(plan, float(sum(have.values()) if total is None else total))

    # whole repetitions, and the tokens still missing after these
    whole = {s.source: int(s.epochs + 1e-9) for s in plan if s.tokens > 0}
    table = spark.createDataFrame([(s.source, whole[s.source], max(0.0, s.tokens - whole[s.source] * s.available)) for s in plan if s.tokens > 0], "source string, whole int, left double")
    goal = F.broadcast(table.select("source", "left"))
    # at most one row for each source and slice
    coarse = F.broadcast(_reached(rows.groupBy("source", "coarse").agg(F.sum("tokens").alias("n")).join(goal, "source"), "coarse"))
    within = rows.join(coarse, "source").filter("coarse = edge_coarse")
    fine = F.broadcast(_reached(within.groupBy("source", "fine", "left").agg(F.sum("tokens").alias("n")), "fine"))
    last = within.drop("left").join(fine, "source").filter("fine = edge_fine")
    # of a slice of a slice, one document after the other
    total_so = F.sum("tokens").over(Window.partitionBy("source").orderBy(F.xxhash64("key"), "key").rowsBetween(Window.unboundedPreceding, 0))
    last = last.withColumn("total", total_so).withColumn("over", F.col("total") - F.col("left"))
    chosen = last.filter((F.col("over") <= 0) | ((F.col("over") < F.col("tokens")) & (2 * F.col("over") < F.col("tokens"))))
    chosen = chosen.select("source", "key", F.lit(True).alias("chosen"))

    edges = coarse.select("source", "edge_coarse").join(fine.select("source", "edge_fine"), "source", "left")
    out = rows.join(F.broadcast(table.select("source", "whole")), "source").join(F.broadcast(edges), "source", "left").join(chosen, ["source", "key"], "left")
    before = (F.col("coarse") < F.col("edge_coarse")) | ((F.col("coarse") == F.col("edge_coarse")) & (F.col("fine") < F.col("edge_fine")))
    once_more = F.coalesce(before, F.lit(False)) | F.coalesce("chosen", F.lit(False))
    out = out.select("key", "source", "tokens", (F.col("whole") + once_more.cast("int")).alias("repeats"))
    return out.filter("repeats > 0"), plan


def shares(mixed: DataFrame, plan: list[Allotment]) -> DataFrame:
    """``source, target_share, max_repeats, available_tokens, planned_tokens, tokens, share, epochs, most_repeats`` for every source with a weight."""
    spark = mixed.sparkSession
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.max("repeats").alias("most"))
    total = got.agg(F.sum("tokens").alias("total"))
    rows = spark.createDataFrame(
        [(s.source, s.target_share, s.max_repeats, s.available, s.tokens) for s in plan],
        "source string, target_share double, max_repeats int, available_tokens bigint, planned_tokens double",
    )
    # one row beside at most one row per source
    both = rows.join(got, "source", "left").withColumn("one", F.lit(1)).join(F.broadcast(total.withColumn("one", F.lit(1))), "one", "left")
    tokens = F.coalesce("tokens", F.lit(0)).cast("bigint")
    return both.select(
        "source",
        "target_share",
        "max_repeats",
        "available_tokens",
        F.round("planned_tokens", 3).alias("planned_tokens"),
        tokens.alias("tokens"),
        F.round(F.when(F.col("total") > 0, tokens / F.col("total")).otherwise(0.0), 6).alias("share"),
        F.round(F.when(F.col("available_tokens") > 0, tokens / F.col("available_tokens")).otherwise(0.0), 6).alias("epochs"),
        F.coalesce("most", F.lit(0)).alias("most_repeats"),
    )
