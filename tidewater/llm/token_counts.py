"""Exact token counts for every context limit from one length histogram.

Documents aggregate by encoded length; suffix sums over the histogram answer,
for a limit of L tokens: how many documents are longer, all tokens, tokens
left when every document is cut at L, and the quantile L stands for.  The
histogram has one row per distinct length, and its suffix sums go through
blocks of lengths, so neither step needs one task for all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import sentencepiece
from .common import materialise

BLOCK = 512  # lengths whose suffix sums one window works out


def length_histogram(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """n_tokens, n_docs: one row per distinct encoded length; null text has length 0."""
    return (sentencepiece.token_lengths(docs, model_path)
            .groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")))


def answers(histogram: DataFrame) -> DataFrame:
    """One row per distinct length L: n_tokens (L), n_docs with that length,
    docs_at_least, tokens_at_least (tokens of those), truncated_tokens (all
    tokens when every document is cut at L), docs_within and share_within (the
    quantile L is).  An empty histogram gives none.
    """
    rows = materialise(histogram.withColumns({"_block": F.expr(f"n_tokens div {BLOCK}"), "_t": F.col("n_tokens") * F.col("n_docs")}), "length-histogram")
    blocks = rows.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum("_t").alias("_bt"))
    after = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)  # one row per BLOCK lengths
    beyond = blocks.select("_block", F.coalesce(F.sum("_d").over(after), F.lit(0)).alias("_after_d"),
                           F.coalesce(F.sum("_bt").over(after), F.lit(0)).alias("_after_t"),
                           F.sum("_d").over(Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"))
    from_here = Window.partitionBy("_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.join(beyond, "_block").withColumns({
        "docs_at_least": F.col("_after_d") + F.sum("n_docs").over(from_here),
        "tokens_at_least": F.col("_after_t") + F.sum("_t").over(from_here)})
    total = rows.agg(F.coalesce(F.sum("_t"), F.lit(0))).first()[0]
    within = F.col("_all") - F.col("docs_at_least") + F.col("n_docs")
    return out.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        (F.lit(total) - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_tokens"),
        within.alias("docs_within"), (within / F.col("_all")).alias("share_within"))


def truncated_total(histogram: DataFrame, limit: int) -> int:
    """Tokens of all documents when each is cut at ``limit``."""
    return histogram.agg(F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0))).first()[0]


def quantile(table: DataFrame, q: float) -> int | None:
    """Smallest length that a share ``q`` of the documents does not exceed."""
    return table.where(F.col("share_within") >= q).agg(F.min("n_tokens")).first()[0]
