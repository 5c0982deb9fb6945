"""PageRank with a fixed number of rounds, for one or many reset probabilities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, planned_shuffles, release_unused
from .rank_blocks import RankBlocks

# From so many edges on a job has fewer rounds: their messages lie on disk until it ends.
LARGE_EDGES = 1 << 26


def pagerank_sweep(
    edges: DataFrame,
    reset_probs: list[float],
    max_iters: list[int],
    vertices: DataFrame | None = None,
    rounds_per_job: int | None = None,
    parallel: bool = True,
) -> DataFrame:
    """``id, reset_prob, max_iter, pagerank`` for the whole parameter grid.

    Each reset probability is one column of the same state, so the sweep costs
    one run of ``max(max_iters)`` rounds: per round one shuffle of summed
    contributions, 8 bytes for each pair of a block of sources and a destination (see
    ``rank_blocks``). Ranks start at 1 and the result is scaled so that they sum to the
    number of vertices.  Parallel edges count, or with ``parallel=False`` are one.  ``rounds_per_job``
    rounds (5, or 2 where a round's messages are large) form one job, at
    whose end the ranks are checkpointed and what the rounds shuffled is let go; a round reads the one before once, so nothing is computed twice.
    """
    names = [f"r{i}" for i in range(len(reset_probs))]
    probs, last = [float(p) for p in reset_probs], max(max_iters)
    laid_out = RankBlocks(edges, vertices, parallel=parallel)
    rounds_per_job = rounds_per_job or (5 if laid_out.edges < LARGE_EDGES else 2)
    arrived, snapshots = None, {}
    with planned_shuffles(edges.sparkSession):
        for i in range(last + 1):
            if i:
                arrived = laid_out.send(arrived, probs)
            if i in max_iters or (i and i % rounds_per_job == 0):
                ranks = laid_out.ranks(arrived, probs)
                if i < last:
                    arrived = ranks = cut_lineage(ranks)
                if i in max_iters:
                    snapshots[i] = cut_lineage(laid_out.named(ranks, names))
                ranks = None
                release_unused(edges.sparkSession)
    frames = []
    for i, snapshot in snapshots.items():
        totals = snapshot.agg(F.count("*").alias("n"), *[F.sum(n).alias(n) for n in names]).first()
        grid = F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("reset_prob"),
                    (F.col(n) * F.lit(totals["n"] / totals[n] if totals["n"] else 1.0)).alias("pagerank"),
                )
                for n, p in zip(names, reset_probs)
            ]
        )
        frames.append(
            snapshot.select("id", F.lit(i).alias("max_iter"), F.explode(grid).alias("g")).select(
                "id", "g.reset_prob", "max_iter", "g.pagerank"
            )
        )
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    laid_out.release()
    return result


def pagerank(
    edges: DataFrame,
    reset_prob: float = 0.7,
    max_iter: int = 20,
    vertices: DataFrame | None = None,
    parallel: bool = True,
) -> DataFrame:
    """``id, pagerank`` after ``max_iter`` rounds."""
    swept = pagerank_sweep(edges, [reset_prob], [max_iter], vertices, parallel=parallel)
    return swept.select("id", "pagerank")


def top_ranked(ranks: DataFrame, k: int = 10, rank: str = "pagerank") -> DataFrame:
    """The k highest ranks, ties broken by id."""
    return ranks.orderBy(F.desc(rank), "id").limit(k)
