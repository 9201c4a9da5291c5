"""Mixing to target weights by iterative proportional fitting.

Documents are summed to cells of (source, lang, topic) once; the token weights
of the cells are then raked to one marginal after the other until all targets
hold. A cell's sampling probability is its raked weight per token, scaled so
that the expected token shares of the sample are exactly the raked ones: the
largest probability is one and no document is taken twice. Each document is
drawn by a hash of its id, so a rerun draws the same documents.

Only cells are iterated on, and they stay in Spark: there are as many as
combinations that occur, whatever the number of documents. Every sweep is
written before the next, which keeps the lineage short.

Defined cases: a null source, language or topic is the value ""; a null, empty or
blank text has no tokens, adds no weight, and is kept with its cell's
probability (0 in a cell without any token); rows of one id share their draw; a
value without a target share gets weight 0; targets of values that do not occur
are spread over the others; an empty table gives an empty table. Texts of any
length are only counted. Other columns are not read.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.common import landed

log = logging.getLogger(__name__)

DIMENSIONS = ("source", "lang", "topic")
SEED = 6
#: Default targets: natural token shares to this power, which lifts small values.
TEMPER = 0.7
TOLERANCE = 1e-6
MAX_SWEEPS = 60


def n_tokens(text: Column) -> Column:
    """Words of a text, apart at x20 and x09-x0D."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def form(text: Column) -> Column:
    """A topic for texts that bring none: the form of writing."""
    words = n_tokens(text)
    bars = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))), F.lit(0))
    return (
        F.when(words == 0, "blank")
        .when(bars * 10 > words, "table")
        .when(words < 150, "note")
        .when(words < 600, "article")
        .otherwise("report")
    )


def measured(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens) of each row."""
    topic = form(F.col("text")) if topic is None else topic
    blank = lambda c: F.coalesce(c, F.lit(""))
    return docs.select(
        "doc_id",
        blank(F.col("source")).alias("source"),
        blank(F.col("lang")).alias("lang"),
        blank(topic).alias("topic"),
        n_tokens(F.col("text")).alias("n_tokens"),
    )


def cells_of(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens"))


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """(value, share): a marginal's natural token shares to a power."""
    sums = cells.groupBy(F.col(dimension).alias("value")).agg(F.sum("tokens").cast("double").alias("t"))
    return sums.select("value", F.pow("t", F.lit(power)).alias("share"))


def _scaled(cells: DataFrame, dimension: str, target: DataFrame) -> DataFrame:
    """Cells with the weights of one marginal brought to its target shares of one."""
    sums = cells.groupBy(dimension).agg(F.sum("weight").alias("have"))
    wanted = target.select(F.col("value").alias(dimension), F.col("share").cast("double").alias("want"))
    factors = sums.where("have > 0").join(wanted, dimension).select(dimension, (F.col("want") / F.col("have")).alias("factor"))
    return cells.join(factors, dimension, "left").withColumn(
        "weight", F.col("weight") * F.coalesce("factor", F.lit(0.0))
    ).drop("factor")


def _normalised(cells: DataFrame, dimension: str, target: DataFrame) -> DataFrame:
    """The target's positive shares among the values that have tokens, summing to one."""
    present = cells.where("tokens > 0").select(F.col(dimension).alias("value")).distinct()
    shares = target.where("share > 0").join(present, "value", "left_semi")
    (total,) = shares.agg(F.sum("share")).first()
    return shares.select("value", (F.col("share") / F.lit(total)).alias("share"))


def raked(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` plus their raked ``weight`` and whether the raking ``converged``; weights sum to one.

    Ends when a whole sweep changes no weight by more than TOLERANCE, or after
    MAX_SWEEPS, as with targets that contradict each other; ``converged`` is then
    false and a warning is logged.
    """
    cells = landed(cells, "cells")
    targets = {d: landed(_normalised(cells, d, t), f"target-{d}") for d, t in targets.items()}
    current = cells.withColumn("weight", F.col("tokens").cast("double")).withColumn("before", F.lit(0.0))
    for _ in range(MAX_SWEEPS):
        current = current.withColumn("before", F.col("weight"))
        for dimension, target in targets.items():
            current = _scaled(current, dimension, target)
        current = landed(current.select(*DIMENSIONS, "tokens", "weight", "before"), "raked")
        (moved,) = current.agg(F.max(F.abs(F.col("weight") - F.col("before")))).first()
        if moved is None or moved <= TOLERANCE:
            return current.drop("before").withColumn("converged", F.lit(True))
    log.warning("raking has not converged: the last of %d sweeps moved a weight by %.1e", MAX_SWEEPS, moved)
    return current.drop("before").withColumn("converged", F.lit(False))


def probabilities(weighted: DataFrame) -> DataFrame:
    """Cells plus ``probability``: weight per token, scaled to at most one."""
    rate = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    (top,) = weighted.agg(F.max(rate)).first()
    return weighted.withColumn("probability", rate / F.lit(top or 1.0))


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) from the document's id."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(SEED)), 11) / F.lit(float(1 << 53))


def planned(rows: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """Cells of ``rows`` (as from ``measured``) with weight and probability."""
    cells = landed(cells_of(rows), "mix")
    if targets is None:
        targets = {d: tempered(cells, d) for d in DIMENSIONS}
    return landed(probabilities(raked(cells, targets)), "probabilities")


def mixed(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``rows`` (as from ``measured``) with ``weight``, ``probability``, ``converged`` and ``sampled``."""
    # Cells are few; whether they are sent along or shuffled is left to their size at run time.
    found = rows.join(cells.select(*DIMENSIONS, "weight", "probability", "converged"), list(DIMENSIONS))
    return found.withColumn("sampled", draw(F.col("doc_id")) < F.col("probability"))
