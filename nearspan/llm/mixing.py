"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix by weight. A source that would be read more than ``max_epochs`` times is
held at that, and what it leaves is shared again among the others by weight until none is above. Sorted by
cap / weight, the sources held at their cap are a prefix, so the repeated sharing has a closed form: one window
over the aggregated sources. Inside a source every document is taken ``whole`` times, and the fraction that is
left goes to documents in the order of a seeded digest; the last of them is taken in part, so that each source
meets its rounded target exactly. The order is cut by a digest prefix: sums per prefix come first, so no source
is ever sorted in one task.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; an empty table gives
no rows; a source without words has target 0; repeated rows are rows of their own (equal rows may only swap their
equal results); a null doc_id sorts by the digest of the word null. Only named columns are used, extra columns
are ignored by :func:`plan_mix` and kept by :func:`mixture`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearspan.session import cut_lineage

WEIGHTS, SHARE, MAX_EPOCHS, SEED = (5, 2, 1), 1.5, 2, "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"
PREFIX = 3


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = totals.select(
        "source", "source_size", F.row_number().over(by_name).alias("rank"),
        (F.col("source_size") * max_epochs).alias("cap"))
    ranked = ranked.withColumn("weight", F.element_at(cycle, (F.col("rank") - 1) % len(weights) + 1))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        / F.sum("weight").over(after)
    filled = ranked.withColumn("level", level)
    held = F.col("cap") < F.col("level") * F.col("weight")
    final = F.max(F.when(~held, F.col("level"))).over(whole)
    return filled.select("source", "source_size", F.when(held, F.col("cap").cast("double"))
                         .otherwise(final * F.col("weight")).alias("target"))


def plan_mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
             seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of documents."""
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    sized = cut_lineage(docs.select(
        "doc_id", "source", name.alias("part"), F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0))
        .cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
        .alias("key")).withColumn("cut", F.substring("key", 1, PREFIX)), "sizes")
    cuts = sized.groupBy("part", "cut").agg(F.sum("size").alias("cut_size"), F.first("source").alias("source"))
    totals = cuts.groupBy("part", "source").agg(F.sum("cut_size").alias("source_size"))
    goal = targets(totals.drop("part"), weights, share, max_epochs)
    goal = goal.withColumn("part", name).drop("source")
    quota = F.floor(F.col("target") + 0.5).cast("long")
    times = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("long")
    running = Window.partitionBy("part").orderBy("cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (cuts.select("part", "cut", F.coalesce(F.sum("cut_size").over(running), F.lit(0)).alias("cut_before"))
            .join(goal, "part")
            .select("part", "cut", "cut_before", "source_size", "target", times.alias("times"),
                    (quota - times * F.col("source_size")).alias("extra")))
    inside = Window.partitionBy("part", "cut").orderBy("key", F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("extra") - F.col("cut_before") - F.coalesce(F.sum("size").over(inside), F.lit(0))
    taken = F.col("times") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), left))
    return (sized.join(cuts, ["part", "cut"])
            .select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")))


def mixture(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per reading of a document, with ``reading`` (1, 2, ..) and ``words`` (how many words of it are read).

    For documents whose ids are unique and not null.
    """
    reads = plan.filter("taken > 0").select(F.col("doc_id").alias("__id"), F.explode(F.expr(
        "transform(sequence(0, cast((taken - 1) div size as int)), "
        "i -> struct(i + 1 as reading, least(size, taken - i * size) as words))")).alias("__read"))
    return docs.join(reads, docs.doc_id == F.col("__id")).select(*[docs[c] for c in docs.columns], "__read.*")


SQL = f"""WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, {MAX_EPOCHS} * source_size AS cap, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight FROM r),
l AS (SELECT *, ({SHARE} * (SELECT sum(source_size) FROM s)
        - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, rank)),
t AS (SELECT source, source_size, CASE WHEN cap < level * weight THEN CAST(cap AS DOUBLE)
        ELSE weight * (SELECT max(level) FROM l WHERE NOT cap < level * weight) END AS target FROM l),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM t),
c AS (SELECT d.*, source_size, target, quota,
        CASE WHEN source_size > 0 THEN quota // source_size ELSE 0 END AS times,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, size DESC
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST(times * size
  + greatest(0, least(size, quota - times * source_size - before)) AS BIGINT) AS taken FROM c"""
