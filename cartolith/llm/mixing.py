"""Mixing sources to target weights (operator 4): entropy balancing, DataFrame functions only.

Document rates r minimise the relative entropy to one copy each, sum of r log r - r + 1 over all documents, under one token
constraint per source, sum of size * r = target, and r <= ``max_repeat``.  At the optimum r = min(max_repeat, exp(lambda * x)),
where lambda is the multiplier of the source and x the size over the source's mean: an exponential tilt by size.  The dual
is convex in lambda.  Each Newton step is one aggregation of gradient and Hessian over the documents, which are
pre-aggregated without loss to counts by (source, size); steps that leave the bracket of the root or do not halve the
gap are replaced by its middle.  Terms are summed as decimals, so that reruns agree whatever the order of rows.

Rates become whole copies in two steps.  Each size of a source gets a whole number of copies, by carrying fractions on from
smaller sizes; what the source then lacks or has too much is made good by ``MENDS`` rounds over its sizes, largest
fitting first.  The copies of a size are dealt out evenly over its documents: number k gets those between (k - 1) and k
times copies / documents.  Sizes of many documents are dealt out over cells of a few hundred by a hash of doc_id, each
starting at another phase, so neither a hot source nor a hot size is a hot task; the windows over the sizes of a source are
bounded by the words of its longest document.  Sources are numbered in ranges, in parallel.

Null texts have size 0 and take no words, a null source is a source of its own and comes last, repeated rows are documents of
their own (equal ones fall into one cell), an empty table gives an empty result; columns of docs that are named like
those added are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Written, table

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of a cell, on average.
CELL = 200
#: Steps of the dual at most, relative gap that ends them, decimals of lambda and of rates.
STEPS, GAP, LAMBDA_DIGITS, RATE_DIGITS = 200, 1e-12, 7, 9
#: Rounds that bring the words of a source to its target.
MENDS = 4
#: Fractional part of the golden ratio: phases of cells.
GOLDEN = 0.618033989
ADDED = ("size", "source_size", "target", "rate", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """Adds idx, the place by code point, null last: ranges are numbered side by side, then laid end to end."""
    ranged = sources.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id())
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    s = Written(ranged.withColumn("at", F.row_number().over(within)), "mix-ranges").df
    parts = s.groupBy("part").agg(F.count("*").alias("n"))  # as many rows as partitions
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return s.join(F.broadcast(before.select("part", "before")), "part").withColumn("idx", (F.col("before") + F.col("at") - 1).cast("long")).drop("part", "before", "at")


def targets(sources: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """(source, source_size, ..) -> also idx, target: min(cap, level * weight).  Each round fixes the sources above their cap."""
    s = numbered(sources)
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (F.col("idx") % len(weights) + 1).cast("int")).cast("long"))
    s = Written(s.withColumn("cap", F.col("source_size") * max_repeat), "mix-weights").df
    level, before = 0.0, -1
    over = lambda: F.col("cap") / F.col("w") < F.lit(level)
    while True:
        r = s.agg(F.sum("source_size").alias("total"), F.sum(F.when(over(), F.col("cap"))).alias("fixed"), F.sum(F.when(over(), 0).otherwise(F.col("w"))).alias("w"), F.count_if(over()).alias("n")).first()
        if r["n"] == before or not r["w"]:
            break
        level, before = (r["total"] - (r["fixed"] or 0)) / r["w"], r["n"]
    return s.withColumn("target", F.when(over(), F.col("cap").cast("double")).otherwise(F.lit(level) * F.col("w"))).drop("w", "cap")


def multipliers(sizes: DataFrame, sources: DataFrame, max_repeat: int) -> DataFrame:
    """sizes (idx, size, n), sources (idx, source_size, target, n_docs, least) -> idx, lambda; null where all rates are at the cap."""
    most, ratio = math.log(max_repeat), F.col("target") / F.col("source_size")
    x = F.col("size") * F.col("n_docs") / F.col("source_size").cast("double")
    low = F.col("least") * F.col("n_docs") / F.col("source_size").cast("double")  # x of the smallest document
    now = sources.where("source_size > 0 and target > 0").select(
        "idx", "source_size", "target", "n_docs", F.lit(0.0).alias("lam"), F.lit(float("inf")).alias("gap"),
        F.when(ratio < 1, F.log(ratio) / low).otherwise(0.0).alias("lo"), F.when(ratio > 1, most / low).otherwise(0.0).alias("hi"),
        (ratio >= max_repeat).alias("full"), (ratio >= max_repeat).alias("done"),
    )
    now = Written(now, "mix-dual")
    for _ in range(STEPS):
        if not now.df.where("not done").limit(1).count():
            break
        state = now.sized()
        at = F.col("lam") * x
        rate = F.when(at >= most, F.lit(float(max_repeat))).otherwise(F.exp(at))
        d = sizes.where("size > 0").join(state.where("not done").select("idx", "lam", "n_docs", "source_size"), "idx")
        exact = lambda c: F.sum(c.cast("decimal(38,12)")).cast("double")
        sums = d.groupBy("idx").agg(
            exact(F.col("n") * F.col("size") * rate).alias("g"), exact(F.when(at < most, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("h")
        )
        s = state.withColumnRenamed("idx", "i").join(sums, F.col("i") == F.col("idx"), "left").drop("idx").withColumnRenamed("i", "idx")
        off = F.col("g") - F.col("target")
        s = s.withColumns({"lo": F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))})
        step = F.col("lam") - off / F.col("h")
        fine = (F.abs(off) <= F.col("gap") * 0.5) & (F.col("h") > 0) & (step > F.col("lo")) & (step < F.col("hi"))
        ends = (F.abs(off) <= GAP * F.col("target")) | (F.col("hi") - F.col("lo") <= 1e-13 * F.greatest(F.abs("lam"), F.lit(1.0)))
        s = s.withColumn("ends", F.col("done") | F.coalesce(ends, F.lit(False)))
        s = s.withColumn("next", F.when(F.col("ends"), F.col("lam")).when(fine, step).otherwise((F.col("lo") + F.col("hi")) / 2))
        then = Written(s.select("idx", "source_size", "target", "n_docs", F.col("next").alias("lam"), F.abs(off).alias("gap"), "lo", "hi", "full", F.col("ends").alias("done")), "mix-dual")
        now.drop()
        now = then
    if now.df.where("not done").limit(1).count():
        raise RuntimeError(f"the dual has not met its gap in {STEPS} steps")
    return now.df.select("idx", F.when(~F.col("full"), F.round("lam", LAMBDA_DIGITS)).alias("lambda"))


def rates(docs: DataFrame, weights: tuple[int, ...], max_repeat: int) -> DataFrame:
    """docs with size -> source, size: source_size, target, rate, n (documents), dealt (copies of all of them), cells."""
    count = Written(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts").df
    own = F.when(F.col("size") > 0, F.col("n"))
    src = count.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.coalesce(F.sum(own), F.lit(0)).alias("n_docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    src = Written(targets(src, weights, max_repeat), "mix-sources")
    s = src.sized().withColumnRenamed("source", "its")
    sizes = Written(count.join(s.select("its", "idx"), F.col("source").eqNullSafe(F.col("its"))).select("source", "idx", "size", "n"), "mix-sizes").df
    lam = Written(multipliers(sizes, src.df, max_repeat), "mix-lambda").sized()
    x = sizes.join(src.sized().drop("source"), "idx").join(lam.withColumnRenamed("idx", "i"), F.col("i") == F.col("idx"), "left")
    tilt = F.least(F.round(F.exp(F.col("lambda") * (F.col("size") * F.col("n_docs") / F.col("source_size").cast("double"))), RATE_DIGITS), F.lit(float(max_repeat)))
    rate = F.when(F.col("i").isNull() | (F.col("size") == 0), 0.0).when(F.col("lambda").isNull(), float(max_repeat)).otherwise(tilt)
    x = x.withColumn("rate", rate).withColumn("part", F.col("n") * (F.col("rate") - F.floor("rate")).cast(f"decimal(10,{RATE_DIGITS})"))
    upto = lambda value, order, last: F.coalesce(F.sum(value).over(Window.partitionBy("idx").orderBy(order).rowsBetween(Window.unboundedPreceding, last)), F.lit(0))
    x = x.withColumn("copies", F.col("n") * F.floor("rate") + F.floor(upto("part", "size", 0) + F.lit(0.5).cast("decimal(2,1)")) - F.floor(upto("part", "size", -1) + F.lit(0.5).cast("decimal(2,1)")))
    for _ in range(MENDS):
        off = F.round(F.col("target") - F.sum(F.col("copies") * F.col("size")).over(Window.partitionBy("idx"))).cast("long")
        x = x.withColumn("off", off)
        room = F.when(F.col("off") > 0, F.col("n") * max_repeat - F.col("copies")).otherwise(F.col("copies"))
        x = x.withColumn("room", F.when((F.col("size") > 0) & (F.col("size") <= F.abs("off")), room).otherwise(0))
        left = F.abs("off") - upto(F.col("room") * F.col("size"), F.desc("size"), -1)
        more = F.when(F.col("room") > 0, F.greatest(F.least(F.floor(left / F.col("size")), F.col("room")), F.lit(0))).otherwise(0)
        x = x.withColumn("copies", F.col("copies") + F.signum("off").cast("long") * more)
    return x.select("source", "size", "source_size", "target", "rate", "n", F.col("copies").cast("long").alias("dealt"), F.ceil(F.col("n") / CELL).alias("cells"))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """Columns of docs and size, source_size, target, rate, copies, taken: one row per row of docs."""
    d = docs.drop(*ADDED).withColumn("size", word_count(F.col("text")))
    by = Written(rates(d.select("source", "size"), weights, max_repeat), "mix-plan").sized()
    by = by.select(*(F.col(k).alias(f"__{k}") for k in by.columns))
    x = d.join(by, d["source"].eqNullSafe(by["__source"]) & (d["size"] == by["__size"]))
    digest = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")
    x = x.withColumns({"__cell": digest % F.col("__cells"), "__th": F.xxhash64("text")})  # rows of one doc_id go by their text
    k = F.row_number().over(Window.partitionBy("__source", "__size", "__cell").orderBy("doc_id", "__th")).cast("long")
    turn = F.col("__cell") * GOLDEN
    x = x.withColumns({"__k": k, "__phase": F.floor((turn - F.floor(turn)) * F.col("__n"))})
    upto = lambda k: F.floor((k * F.col("__dealt") + F.col("__phase")) / F.col("__n"))
    copies = (upto(F.col("__k")) - upto(F.col("__k") - 1)).cast("long")
    return x.select(
        *docs.drop(*ADDED).columns, "size", F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), F.col("__rate").alias("rate"),
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


#: The same optimum by bisection of the dual's gradient, which needs no derivative.
OP4_SQL = rf"""
with recursive base as (select doc_id, source, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size, count(*) filter (where size > 0) as n_docs, min(size) filter (where size > 0) as least from base group by source),
i as (select *, row_number() over (order by source nulls last) - 1 as idx from s),
w as (select *, (idx % 3 + 1)::double as w, source_size::double * 3 as cap from i),
r as (select *, cap / w as ratio, sum(source_size::double) over () as total, sum(w) over () as all_w from w),
l as (select *, (total - coalesce(sum(cap) over a, 0)) / (all_w - coalesce(sum(w) over a, 0)) as level from r
      window a as (order by ratio, idx rows between unbounded preceding and 1 preceding)),
f as (select *, ratio < level as capped, max(case when ratio >= level then level end) over () as fill from l),
t as (select source, source_size, idx, n_docs, least, case when capped then cap else fill * w end as target from f),
h as (select t.*, size, count(*) as n from base join t on base.source is not distinct from t.source group by all),
it(step, idx, lo, hi) as (
  select 0, idx, case when target < source_size then ln(target / source_size) / (least * n_docs / source_size::double) else 0.0 end,
    case when target > source_size then ln(3) / (least * n_docs / source_size::double) else 0.0 end
  from t where source_size > 0 and target > 0 and target < 3.0 * source_size
  union all
  select step + 1, idx, case when g < target then (lo + hi) / 2 else lo end, case when g < target then hi else (lo + hi) / 2 end from (
    select step, idx, lo, hi, target, sum(n * size * case when (lo + hi) / 2 * (size * n_docs / source_size::double) >= ln(3) then 3.0 else exp((lo + hi) / 2 * (size * n_docs / source_size::double)) end) as g
    from it join h using (idx) where step < 100 and size > 0 group by step, idx, lo, hi, target)),
m as (select idx, round((lo + hi) / 2, {LAMBDA_DIGITS}) as lam from it where step = 100),
q as (select h.*, case when size = 0 or target <= 0 then 0.0 when lam is null then 3.0 else least(round(exp(lam * (size * n_docs / source_size::double)), {RATE_DIGITS}), 3.0) end as rate from h left join m using (idx)),
p as (select *, n * (rate - floor(rate))::decimal(10,{RATE_DIGITS}) as part, ceil(n / {CELL}.0)::bigint as cells from q),
c0 as (select *, (n * floor(rate) + floor(sum(part) over (partition by idx order by size rows unbounded preceding) + 0.5)
  - floor(coalesce(sum(part) over (partition by idx order by size rows between unbounded preceding and 1 preceding), 0) + 0.5))::bigint as copies from p),
"""
for _k in range(MENDS):
    OP4_SQL += f"""o{_k} as (select *, round(target - sum(copies * size) over (partition by idx))::bigint as off from c{_k}),
r{_k} as (select *, case when size = 0 or size > abs(off) then 0 when off > 0 then n * 3 - copies else copies end as room from o{_k}),
l{_k} as (select *, abs(off) - coalesce(sum(room * size) over (partition by idx order by size desc rows between unbounded preceding and 1 preceding), 0) as open from r{_k}),
c{_k + 1} as (select * exclude (copies, off, room, open), (copies + sign(off) * case when room > 0 then greatest(least(floor(open / size), room), 0) else 0 end)::bigint as copies from l{_k}),
"""
OP4_SQL += rf"""d as (select b.doc_id, c.*, ('0x' || md5(coalesce(b.doc_id::varchar, ''))[1:8])::bigint % cells as cell from base b join c{MENDS} c on b.source is not distinct from c.source and b.size = c.size),
k as (select *, row_number() over (partition by idx, size, cell order by doc_id nulls first) as k, floor((cell * {GOLDEN} - floor(cell * {GOLDEN})) * n)::bigint as phase from d)
select doc_id, size, source_size, round(target, 6) as target, (((k * copies + phase) // n - ((k - 1) * copies + phase) // n) * size)::bigint as taken
from k"""
