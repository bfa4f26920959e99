"""Mixing sources to target weights, with DataFrame operations only.

Each source's words are counted, and targets set by weight up to a cap. A source's repetition
rate is its target over its words. A document is taken floor(rate) times, and once more with the
remaining probability, drawn from a hash of its id: reruns agree, and no order matters. The hash
has a seed, and every source uses the one of SEEDS seeds whose draws come nearest to its target:
with few documents, or a few very long ones, one seed alone can miss it by far.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from llm.tables import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # of the sources in order, repeating
SHARE = 1.5  # of all words that the mix takes
MOST = 2  # times a source's words
SEEDS = 32  # a multiple of 8


def size() -> Column:
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def draws() -> Column:
    """SEEDS numbers in [0, 1) from the document's id, or from its text if it has none."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.coalesce("text", F.lit(""))))
    digests = F.array(*(F.sha2(F.concat(F.lit(f"mix {k} "), own), 256) for k in range(SEEDS // 8)))
    number = lambda digest, k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") / float(1 << 32)
    return F.flatten(F.transform(digests, lambda digest: F.array(*(number(digest, k) for k in range(8)))))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources stand by code point, null last, and weigh WEIGHTS in turn. Targets share SHARE of all
    words by weight, but stop at MOST times a source's words; the excess goes to the others by
    weight. So each target is the smaller of its cap and of its weight times one common level.
    The windows run over one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (turn % len(WEIGHTS) + 1).cast("int"))
    by_fill = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    so_far, after = by_fill.rowsBetween(Window.unboundedPreceding, 0), by_fill.rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    filled = (
        sizes.select("source", "source_size", weight.alias("weight"), (MOST * F.col("source_size")).alias("cap"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", SHARE * F.sum("source_size").over(whole))
        .withColumn("capped", F.sum("cap").over(so_far))
        .withColumn("open", F.coalesce(F.sum("weight").over(after), F.lit(0)))
        .withColumn("full", F.col("capped") + F.col("ratio") * F.col("open") <= F.col("budget"))
    )
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    share = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    return filled.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("cap").cast("double"), (F.col("budget") - held) * F.col("weight") / share))
        .alias("target"),
    )


def _plan(docs: DataFrame) -> DataFrame:
    """(source, source_size, target, rate, seed) of every source: the seed whose draws come nearest to the target.

    Sizes and draws are written, so that texts are read for them once.
    """
    sized = store(docs.select("source", size().alias("size"), draws().alias("draws")), "sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rates = store(targets(sums).withColumn("rate", rate), "rates")
    part = F.col("rate") - F.floor("rate")
    once_more = [F.sum(F.when(F.get("draws", F.lit(k)) < part, F.col("size")).otherwise(0)) for k in range(SEEDS)]
    of = rates.select(F.col("source").alias("of"), "rate")
    tried = sized.join(of, F.col("source").eqNullSafe(F.col("of"))).groupBy("source").agg(F.array(*once_more).alias("more"))
    tried = tried.select(F.col("source").alias("of"), "more")
    off = F.transform("more", lambda more: F.abs(F.floor("rate") * F.col("source_size") + more - F.col("target")))
    near = rates.join(tried, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    return store(near.withColumn("seed", F.array_position(off, F.array_min(off)) - 1).drop("more"), "plan")


def mix(docs: DataFrame) -> DataFrame:
    """The rows of docs (doc_id, text, source, ...) as a struct ``row``, with size, source_size, target and copies.

    A null or empty text has size 0, and a source without words a rate of 0. Rows that repeat an
    id draw alike. A null source is a source; a table without rows gives none. Other columns keep
    any name, inside the struct. The plan of sources is a written table, so Spark broadcasts it only
    if it sees that it is small, and else splits hot sources.
    """
    sized = docs.select(F.struct("*").alias("row"), "source", size().alias("size"), draws().alias("draws"))
    plan = _plan(docs).withColumnRenamed("source", "of")
    drawn = F.get("draws", F.col("seed").cast("int"))
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "size", "source_size", "target",
        (F.floor("rate") + (drawn < F.col("rate") - F.floor("rate")).cast("int")).cast("long").alias("copies"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows themselves, each as often as the mix takes it."""
    times = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.filter("copies > 0").select("row", F.explode(times).alias("time")).select("row.*")


SQL = rf"""
with sizes as materialized (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size,
           coalesce(doc_id::varchar, 'text ' || coalesce(text, '')) as own
    from documents),
drawn as materialized (
    select *, list_transform(range({SEEDS}), lambda k:
                  ('0x' || substr(sha256('mix ' || (k // 8) || ' ' || own), (k % 8) * 8 + 1, 8))::bigint / {1 << 32}::double) as draws
    from sizes),
sources as (
    select source, sum(size)::bigint as source_size,
           [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight
    from sizes group by source),
filled as (
    select *, {MOST} * source_size as cap, {MOST} * source_size / weight as ratio,
           {SHARE}::double * (sum(source_size) over ())::bigint as budget
    from sources),
steps as (
    select *, (sum(cap) over seen)::bigint + ratio * coalesce((sum(weight) over later)::bigint, 0) <= budget as is_full
    from filled
    window seen as (order by ratio, source nulls last rows unbounded preceding),
           later as (order by ratio, source nulls last rows between 1 following and unbounded following)),
levels as (
    select coalesce(sum(cap) filter (is_full), 0)::bigint as held, (sum(weight) filter (not is_full))::bigint as open from steps),
targets as (
    select source, source_size,
           case when is_full then cap::double else least(cap::double, (budget - held) * weight / open) end as target
    from steps, levels),
rates as materialized (
    select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from targets),
tried as (
    select d.source, k, sum(case when draws[k + 1] < rate - floor(rate) then size else 0 end)::bigint as more
    from drawn d join rates r on d.source is not distinct from r.source, range({SEEDS}) seeds(k) group by all),
chosen as (
    select r.*, t.k as seed from rates r join tried t on r.source is not distinct from t.source
    qualify row_number() over (partition by r.source order by abs(floor(rate) * source_size + more - target), k) = 1)
select doc_id, size, source_size, target,
       (floor(rate) + (draws[seed + 1] < rate - floor(rate))::int)::bigint * size as taken
from drawn d join chosen c on d.source is not distinct from c.source
"""
