"""Mixing sources to target weights: repetition rates per source, hash-seeded copies per document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fairwait.llm.common import WORD, staged, table
from fairwait.operators.ranks import with_position
from fairwait.session import shared_root

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST = 2
SEED = 17


def coin(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on nothing but ``key`` and ``seed``: 52 bits of a digest."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most: int = MOST,
) -> DataFrame:
    """One row per source of ``sizes`` (source, size): source, source_size, target.

    Sources take the weights in turn, in code point order, NULL last. The targets share
    ``share_percent`` of all sizes by weight. A target stops at ``most`` times its source's
    size, and the excess is shared again by weight among the others until none is above.
    All targets of open sources follow from one number, the level per unit of weight, so a
    round of sharing is one sum over the sources and only that row reaches the driver.
    """
    shared_root(sizes.sparkSession)
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_position(totals.orderBy(F.col("source").asc_nulls_last()))
    turn = F.pmod(F.col("_position"), F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("long")
    sources = staged(placed.select("source", "source_size", weight.alias("weight")), "sources")

    whole = sources.agg(F.sum("source_size")).first()[0] or 0
    level, closed = 0.0, -1
    while True:
        shut = F.col("weight") * F.lit(level) > most * F.col("source_size")
        row = sources.agg(
            F.count_if(shut).alias("n"),
            F.sum(F.when(shut, F.col("source_size") * most).otherwise(0)).alias("spent"),
            F.sum(F.when(shut, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if row.n == closed or not row.open:
            break
        closed, level = row.n, (whole * share_percent / 100.0 - row.spent) / row.open
    target = F.least(F.col("weight") * F.lit(level), (most * F.col("source_size")).cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def copies_of(rate: Column, key: Column, seed: int = SEED) -> Column:
    """floor(rate), and one more with a probability equal to the fraction."""
    return (F.floor(rate) + (coin(key, seed) < rate - F.floor(rate)).cast("long")).cast("int")


def sized(docs: DataFrame) -> Column:
    return F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")


def mix(docs: DataFrame, seed: int = SEED, **limits) -> DataFrame:
    """``docs`` (doc_id, text, source, any others) with ``_size``, ``_source_size``, ``_target``
    and ``_copies``, the number of times the mix takes the document.

    * The size is the number of words; NULL or empty text has size 0.
    * NULL is a source of its own. A source without words has target 0 and is not taken.
    * The coin depends on doc_id and seed alone: reruns agree, rows that repeat an id share
      it. NULL ids share one coin.
    * An empty table gives an empty table. Other columns are kept as they are; the four
      names with an underscore are reserved.

    One pass reads source and text for the totals, pre-aggregated before the shuffle; the
    second emits. Sources join by value, NULL with NULL; the table of sources is broadcast
    only where its written size is below the session's threshold, and a source that holds
    a third of all rows is otherwise split by the skew join.
    """
    sizes = docs.select("source", sized(docs).alias("size"))
    targets = source_targets(sizes, **limits).select(
        F.col("source").alias("_source"),
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
    )
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    return (
        docs.withColumn("_size", sized(docs))
        .join(targets, F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .withColumn("_copies", copies_of(rate, F.col("doc_id"), seed))
    )


def take(docs: DataFrame, seed: int = SEED, **limits) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns unchanged."""
    mixed = mix(docs, seed, **limits).where("_copies > 0")
    return mixed.select(
        *[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    ).drop("_copy")


def op4_mix_sources(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


# The level where sharing settles, found by walking the sources in the order they fill up.
OP4_SQL = r"""
with sized as (
  select doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size
  from documents),
totals as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
turns as (
  select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from totals),
walked as (
  select *,
    coalesce(sum(2 * source_size) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as spent,
    sum(weight) over (order by source_size / weight, source nulls last
      rows between current row and unbounded following) as open,
    sum(source_size) over () as whole
  from turns),
levels as (
  select *, (cast(whole as bigint) * 150 / 100.0::double - cast(spent as bigint)) / cast(open as bigint) as level
  from walked),
settled as (
  select arg_max(level, open) as level from levels where not weight * level > 2 * source_size),
targets as (
  select source, source_size,
    least(weight * (select level from settled), cast(2 * source_size as double)) as target
  from turns),
rated as (
  select doc_id, size, source_size, target,
    case when source_size > 0 then target / source_size else 0 end as rate,
    cast('0x' || substr(md5(doc_id || ':17'), 1, 13) as bigint) / 4503599627370496.0::double as coin
  from sized join targets on sized.source is not distinct from targets.source)
select doc_id, size, source_size, target,
  size * (cast(floor(rate) as bigint) + case when coin < rate - floor(rate) then 1 else 0 end) as taken
from rated
"""
