"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import running, space_words, table


@dataclass(frozen=True)
class MixParams:
    """weights: of the sources in code-point order, repeating, null last.

    blocks: equal-token blocks that the whole mix is dealt in (16 a source at
    least), fine: blocks of its own that a source gets where those would be too
    large for it, shards: output shards that get integer quotas of them, repeats:
    most times that a source is taken.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    blocks: int = 4096
    fine: int = 64
    shards: int = 16
    repeats: int = 3
    seed: str = "mix"
    bucket_docs: int = 4096


def _seeded(params: MixParams, *parts: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(params.seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))


def targets(sized: DataFrame, params: MixParams) -> DataFrame:
    """Per source: total size, weight and target, by filling water up to the caps.

    A source is full where ``repeats`` times its size is below its share of what
    fuller sources leave; one row per source is sorted, no document.
    """
    per = sized.groupBy("_k").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy("_k")
    picks = F.array(*[F.lit(w) for w in params.weights])
    per = per.withColumn("_rank", F.row_number().over(order)).withColumn("_w", F.get(picks, (F.col("_rank") - 1) % len(params.weights)).cast("long"))
    per = per.withColumn("_cap", params.repeats * F.col("source_size"))
    full_first = Window.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = full_first.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.withColumn(
        "_level",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        / (F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(before), F.lit(0))),
    )
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), "_rank", "_level"))
    per = per.withColumn("_level", F.min(fits).over(every)["_level"])
    return per.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w")))


def quotas(per: DataFrame, n_sources: int, total: int, params: MixParams) -> DataFrame:
    """Blocks that each source gives to each shard: seats go to the highest target / (2 k - 1).

    A source has ``_nb`` blocks of its own text and at most ``repeats`` times as
    many seats. Seat r goes to shard (r - 1) mod shards, so that each shard's
    quotas are whole and near its share. A source that is full, or whose size
    or target is below ``fine`` blocks, is dealt apart: the smaller of both is
    cut in ``fine`` blocks (of a word at least), and its target, rounded to
    these, is its quota, ``repeats`` times all its blocks where it is full; the
    others share the seats that are left. Rows: twice the number of seats, and
    at most ``fine`` times (the largest weight or ``repeats``) and a few per
    source, whatever the corpus.
    """
    seats = max(params.blocks, 16 * n_sources)
    size = max(total, 1) / seats
    per = per.withColumn("_nb", F.when(F.col("source_size") == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(F.col("source_size") / size + 0.5))).cast("long"))
    full = F.col("target") >= params.repeats * F.col("source_size")
    apart = F.col("_nb").isNotNull() & (F.col("_nb") > 0) & (full | (F.least(F.col("source_size").cast("double"), F.col("target")) < params.fine * size))
    per = per.withColumn("_apart", apart)
    cut = F.greatest(F.lit(1.0), F.least(F.col("source_size").cast("double"), F.col("target")) / params.fine)
    own = per.where("_apart").withColumn("_nb", F.greatest(F.lit(1), F.floor(F.col("source_size") / cut)).cast("long"))
    due = F.when(full, params.repeats * F.col("_nb")).otherwise(F.floor(F.col("target") * F.col("_nb") / F.col("source_size") + 0.5)).cast("long")
    own = own.withColumn("_due", F.least(due, params.repeats * F.col("_nb")))
    taken = per.agg(F.sum(F.when(F.col("_apart"), F.col("target")).otherwise(0.0))).first()[0] or 0.0
    seats = max(0, seats - int(taken / size + 0.5))
    per = per.where(~F.col("_apart"))
    most = F.least(params.repeats * F.col("_nb"), (2 * F.floor(F.col("target") / size) + 5).cast("long"))
    votes = per.where(F.col("_nb") > 0).select("_k", "_rank", "source_size", "_nb", "target", F.explode(F.sequence(F.lit(1).cast("long"), most)).alias("_seat"))
    awarded = votes.withColumn("_award", F.row_number().over(Window.orderBy(F.desc(F.col("target") / (2 * F.col("_seat") - 1)), "_rank", "_seat"))).where(F.col("_award") <= seats)
    shard = (F.col("_award") - 1) % params.shards
    own = own.where("_due > 0").select("_k", "source_size", "_nb", F.explode(F.sequence(F.lit(1).cast("long"), "_due")).alias("_seat"), (F.col("_rank") - 1).alias("_from"))
    own = own.select("_k", "source_size", "_nb", ((F.col("_from") + F.col("_seat")) % params.shards).alias("shard"))
    return awarded.select("_k", "source_size", "_nb", shard.alias("shard")).unionByName(own).groupBy("_k", "source_size", "_nb", "shard").agg(F.count("*").alias("quota"))


def block_plan(quota: DataFrame, params: MixParams) -> DataFrame:
    """Seeded choice of blocks: how often each block of a source is drawn, for which shards, and where it starts.

    Round after round a source's blocks are drawn in the order of a seeded hash
    until its quota is met; the draws fill the shards' quotas one after another.
    """
    each = F.sort_array(F.collect_list(F.struct("shard", "quota")))
    have = quota.groupBy("_k", "source_size", "_nb").agg(F.sum("quota").alias("_quota"), each.alias("_each"))
    blocks = have.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
    place = F.row_number().over(Window.partitionBy("_k").orderBy(_seeded(params, F.col("_k"), F.col("_block")), "_block")) - 1
    whole = F.floor(F.col("_quota") / F.col("_nb"))
    rest = F.col("_quota") % F.col("_nb")
    blocks = blocks.withColumn("_place", place).withColumn("times", (whole + F.when(F.col("_place") < rest, 1).otherwise(0)).cast("long"))
    # draw number t of a source goes to the first shard whose quota, added to those before, is above t
    full = lambda t: F.aggregate("_each", F.struct(t.cast("long").alias("left"), F.lit(None).cast("long").alias("s")), lambda a, x: F.struct((a["left"] - x["quota"]).alias("left"), F.coalesce(a["s"], F.when(a["left"] < x["quota"], x["shard"].cast("long"))).alias("s")), lambda a: a["s"])
    draws = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), F.lit(params.repeats).cast("long")), lambda r: r < F.col("times")), lambda r: full(F.col("_place") + r * F.col("_nb")))
    blocks = blocks.withColumn("_shards", F.array_join(draws, ","))
    edge = lambda b: F.expr(f"({b} * source_size) div _nb")
    blocks = blocks.withColumn("_lo", edge("_block")).withColumn("_len", edge("(_block + 1)") - F.col("_lo"))
    run = Window.partitionBy("_k").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn("_before", F.coalesce(F.sum(F.col("times") * F.col("_len")).over(run), F.lit(0).cast("long"))).select("_k", "_block", "_lo", "times", "_before", "_nb", "_shards")


def mix(docs: DataFrame, params: MixParams = MixParams(), keep: tuple[str, ...] = ("doc_id", "source")) -> DataFrame:
    """Columns ``keep`` of ``docs`` with size, source_size, target, taken and shards.

    Size counts words apart from white space (null and empty texts: 0, and
    nothing is taken of them). Documents of a source lie in the order of a
    seeded hash of doc_id on a line of words; a document takes what the drawn
    blocks cover of it, so it never exceeds ``repeats`` times its size. Running
    positions are summed per (source, hash bucket) first, buckets growing in
    number with the documents, so no source is sorted in one task. Null ids
    share one place in the order; equal ids lie side by side in any order of
    their sizes, smallest first. shards names the output shards, comma-joined,
    that draw the block of a document's first word; empty if none does. Extra
    columns named like results are replaced.
    """
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string")))
    names = [c for c in keep if c not in ("size", "source_size", "target", "taken", "shards")]
    order = ("_h", "size", *[c for c in names if c != "source"])
    sized = docs.select(*names, key.alias("_k"), F.size(space_words(F.col("text"))).cast("long").alias("size"), _seeded(params, F.col("doc_id")).alias("_h"))
    sized = table(sized, "mix-sizes")
    n, total, n_sources = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.count_distinct("_k")).first()
    per = targets(sized, params)
    plan = table(block_plan(quotas(per, n_sources, total, params), params), "mix-blocks")
    most = 2 * params.blocks + (34 + params.fine * max(params.repeats, *params.weights)) * n_sources
    small = F.broadcast(plan) if most <= 200_000 else plan  # its rows are at most so many

    digits = 1
    while 16**digits * params.bucket_docs < n:
        digits += 1
    sized = sized.withColumn("_b", F.conv(F.substring("_h", 1, digits), 16, 10).cast("long"))
    bases = running(sized.groupBy("_k", "_b").agg(F.sum("size").alias("_sum")), ["_k"], "_b", "_sum", "_base").drop("_sum")
    bases = bases.join(per.select("_k", "source_size", "target"), "_k")
    inside = Window.partitionBy("_k", "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    line = sized.join(bases, ["_k", "_b"]).withColumn("_at", F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0).cast("long")))

    nb = plan.groupBy("_k").agg(F.max("_nb").alias("_n"))
    line = line.join(nb, "_k", "left").withColumn("_end", F.col("_at") + F.col("size"))
    line = line.withColumn("_first", F.expr("case when size > 0 then ((_at + 1) * _n - 1) div source_size end")).withColumn("_last", F.expr("case when size > 0 then (_end * _n - 1) div source_size end"))
    for side, block, point in (("a", "_first", "_at"), ("z", "_last", "_end")):
        edge = small.select("_k", F.col("_block").alias(block), (F.col("_before") - F.col("times") * F.col("_lo")).alias("_c"), F.col("times").alias("_t"), *(["_shards"] if side == "a" else []))
        line = line.join(edge, ["_k", block], "left").withColumn(f"_{side}", F.col("_c") + F.col("_t") * F.col(point)).drop("_c", "_t")
    taken = F.coalesce(F.col("_z") - F.col("_a"), F.lit(0)).cast("long")
    lead = [c for c in names if c == "doc_id"]
    return line.select(*lead, "size", "source_size", "target", taken.alias("taken"), *[c for c in names if c not in lead], F.coalesce("_shards", F.lit("")).alias("shards"))


#: DuckDB SQL of :func:`mix` with its default parameters, where no source is dealt apart; {docs} is a relation with doc_id, source, text.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM {docs}),
s AS (SELECT k, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY k) AS r FROM d GROUP BY k),
w AS (SELECT *, [1, 2, 3][(r - 1) % 3 + 1] AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(cap) OVER f, 0)::BIGINT) / ((sum(w) OVER ())::BIGINT - coalesce(sum(w) OVER f, 0)::BIGINT) AS level
  FROM w WINDOW f AS (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, least(cap::DOUBLE, w * (SELECT level FROM l WHERE level * w <= cap ORDER BY cap / w, r LIMIT 1)) AS target FROM l),
n AS (SELECT greatest(4096, 16 * count(*)) AS seats, greatest(sum(source_size), 1)::BIGINT / greatest(4096, 16 * count(*)) AS bs FROM t),
b AS (SELECT t.*, seats, bs, CASE WHEN source_size = 0 THEN 0 ELSE greatest(1, floor(source_size / bs + 0.5))::BIGINT END AS nb FROM t, n),
v AS (SELECT *, unnest(generate_series(1, least(3 * nb, 2 * floor(target / bs)::BIGINT + 5))) AS seat FROM b WHERE nb > 0),
a AS (SELECT *, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, r, seat) AS award FROM v),
e AS (SELECT k, (award - 1) % 16 AS shard, count(*) AS quota FROM a WHERE award <= seats GROUP BY ALL),
u AS (SELECT k, shard, quota, sum(quota) OVER (PARTITION BY k ORDER BY shard) AS upto FROM e),
q AS (SELECT k, source_size, nb, count(*) AS quota FROM a WHERE award <= seats GROUP BY ALL),
c AS (SELECT *, unnest(generate_series(0, nb - 1)) AS block FROM q),
z AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY md5('mix|' || k || '|' || block), block) - 1 AS place FROM c),
p AS (SELECT *, quota // nb + CASE WHEN place < quota % nb THEN 1 ELSE 0 END AS times, block * source_size // nb AS lo, (block + 1) * source_size // nb AS hi FROM z),
y AS (SELECT k, block, place + nb * unnest(range(times::BIGINT)) AS draw FROM p),
g AS (SELECT y.k, y.block, string_agg(u.shard::VARCHAR, ',' ORDER BY y.draw) AS shards FROM y JOIN u ON u.k = y.k AND y.draw < u.upto AND y.draw >= u.upto - u.quota GROUP BY ALL),
o AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY k ORDER BY h, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM d)
SELECT o.doc_id, any_value(o.source) AS source, o.size::BIGINT AS size, any_value(t.source_size)::BIGINT AS source_size, any_value(t.target)::DOUBLE AS target,
  coalesce(sum(p.times * (least(o.at + o.size, p.hi) - greatest(o.at, p.lo))), 0)::BIGINT AS taken, coalesce(any_value(g.shards) FILTER (p.lo <= o.at), '') AS shards
FROM o JOIN t ON o.k = t.k LEFT JOIN p ON p.k = o.k AND p.lo < o.at + o.size AND p.hi > o.at AND o.size > 0 LEFT JOIN g ON g.k = p.k AND g.block = p.block
GROUP BY o.doc_id, o.k, o.size, o.at
"""
