"""Balanced label propagation of linked documents over shards.

Equal texts are linked with each other. A class of equal texts is held as
counts per shard, so propagation never expands its links: round by round the
members of a class move to the shard that most of them are in already, as far
as that shard has room. Documents without links fill the shards to counts at
most one apart, and classes that no shard has room for are split over few.
"""

from __future__ import annotations

import sys
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, running, salted_join, table


@dataclass(frozen=True)
class ShardParams:
    """shards: how many; rounds: after so many rounds of propagation, and each time
    as many again, those still needed are reported; most_rounds: a safety stop,
    reported too; heavy_share: a class
    of more than this share of all rows is salted, so there are at most
    1 / heavy_share of them; bucket_rows: rows that a task ranks at once.
    """

    shards: int = 40
    rounds: int = 5
    most_rounds: int = 1000
    heavy_share: float = 1e-4
    bucket_rows: int = 4096


#: Order of rows that doesn't depend on how they are dealt out: hash of id and text, id, and at last the place in the table.
ORDER = ("_h", "_id", "_row")


def ranked(rows: DataFrame, groups: list[str], n: int, name: str, bucket_rows: int) -> DataFrame:
    """Add ``name``, the place of each row in its group in a fixed random order, from 0 without gaps.

    Groups may be of any size: rows are first counted per hash bucket, buckets
    growing in number with ``n``, and only ranked inside one. Rows without an id
    are spread by their place in the table.
    """
    buckets = max(1, n // bucket_rows)
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_h", F.when(F.col("_id").isNull(), F.col("_row")), F.lit(3)), F.lit(buckets)))
    base = running(rows.groupBy(*groups, "_b").agg(F.count("*").alias("_n")), groups, "_b", "_n", "_base").drop("_n")
    inside = F.row_number().over(Window.partitionBy(*groups, "_b").orderBy(*ORDER)) - 1
    return rows.join(base, [*groups, "_b"]).withColumn(name, (F.col("_base") + inside).cast("long")).drop("_b", "_base")


def _lookup(values: list[int], at: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)) for v in values]).cast("array<bigint>"), at)


def _loads(state: DataFrame, shards: int) -> list[int]:
    """Linked documents in each shard; as many numbers as there are shards."""
    got = {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def propagate(state: DataFrame, quota: list[int], params: ShardParams) -> DataFrame:
    """Rounds over ``state`` (digest, shard, n), until none moves anything: classes move to their fullest shard that has room.

    A class moves as a whole to where it fits; one larger than any room moves in
    part, from smaller parts to a larger one only. So each round brings classes
    closer together, and rounds end.
    """
    shards = params.shards
    for k in range(params.most_rounds):
        load = _loads(state, shards)
        room = [max(0, q - n) for q, n in zip(quota, load, strict=True)]
        # at most one part per shard
        parts = F.collect_list(F.struct("n", F.xxhash64("digest", "shard").alias("h"), "shard"))
        aims = state.groupBy("digest").agg(parts.alias("_p"), F.sum("n").alias("size")).where(F.size("_p") > 1)
        whole = F.array_max(F.filter("_p", lambda x: _lookup(room, x["shard"]) >= F.col("size") - x["n"]))
        part = F.when(F.col("size") > max(room), F.array_max(F.filter("_p", lambda x: _lookup(room, x["shard"]) > 0)))
        # a class that no shard has room for has no aim and stays
        aims = aims.withColumn("_t", F.coalesce(whole, part)).withColumn("_whole", whole.isNotNull()).where(F.col("_t").isNotNull())
        smaller = F.aggregate(F.filter("_p", lambda x: x["n"] <= F.col("_t.n")), F.lit(0).cast("long"), lambda s, x: s + x["n"])
        want = F.when(F.col("_whole"), F.col("size")).otherwise(smaller) - F.col("_t.n")
        aims = aims.select("digest", F.col("_t.shard").alias("aim"), want.alias("want"), "size", "_whole").where("want > 0")
        # sums of wishes per (shard, bucket) first, so that no shard's classes are sorted in one task
        aims = aims.withColumn("_b", F.pmod(F.xxhash64("digest", F.lit(5)), F.lit(max(1, sum(load) // (2 * params.bucket_rows)))))
        base = running(aims.groupBy("aim", "_b").agg(F.sum("want").alias("_s")), ["aim"], "_b", "_s", "_base").drop("_s")
        before = F.coalesce(F.sum("want").over(Window.partitionBy("aim", "_b").orderBy("size", "digest").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        left = _lookup(room, F.col("aim")) - F.col("_base") - before
        moves = F.when(left >= F.col("want"), F.col("want")).when(~F.col("_whole"), F.greatest(F.lit(0).cast("long"), left)).otherwise(0)
        moves = aims.join(base, ["aim", "_b"]).select("digest", "aim", moves.alias("go")).where("go > 0")
        gone = state.join(moves, "digest", "left")
        stays = F.col("aim").isNull() | (F.col("shard") == F.col("aim"))
        smaller_first = Window.partitionBy("digest").orderBy(stays, "n", "shard").rowsBetween(Window.unboundedPreceding, -1)
        taken = F.least(F.col("n"), F.greatest(F.lit(0).cast("long"), F.col("go") - F.coalesce(F.sum("n").over(smaller_first), F.lit(0))))
        after = F.when(F.col("aim").isNull(), F.col("n")).when(F.col("shard") == F.col("aim"), F.col("n") + F.col("go")).otherwise(F.col("n") - taken)
        following = table(gone.select("digest", "shard", after.cast("long").alias("n"), F.coalesce(F.col("go"), F.lit(0)).alias("_go")), "shard-state")
        moved = following.where("_go > 0").limit(1).count()
        discard(state)
        state = following.where("n > 0").select("digest", "shard", "n")
        state._tidemark_path = following._tidemark_path
        if not moved:
            return state
        if (k + 1) % params.rounds == 0:
            print(f"sharding: classes still move after {k + 1} rounds", file=sys.stderr)
    warnings.warn(f"sharding: stopped after {params.most_rounds} rounds with classes still moving", stacklevel=2)
    return state


def _spread(state: DataFrame, quota: list[int]) -> DataFrame:
    """Classes larger than a shard, of which there are fewer than shards, get whole shards and one for the rest.

    Each takes the free shards that hold most of it, so it is split over as few as can be.
    """
    large = state.groupBy("digest").agg(F.sum("n").alias("size")).where(F.col("size") > max(quota))
    rows = state.join(F.broadcast(large), "digest").select("digest", "shard", "n", "size").collect()
    if not rows:
        return state
    have: dict[str, dict[int, int]] = {}
    for r in rows:
        have.setdefault(r.digest, {})[r.shard] = r.n
    sizes = {r.digest: r.size for r in rows}
    room, placed = list(quota), []
    for digest in sorted(have, key=lambda d: (-sizes[d], d)):
        left = sizes[digest]
        for s in sorted(range(len(quota)), key=lambda s: (-(room[s] == quota[s]), -have[digest].get(s, 0), s)):
            take = min(left, room[s])
            if take > 0:
                placed.append((digest, s, take))
                room[s], left = room[s] - take, left - take
    fresh = state.sparkSession.createDataFrame(placed, "digest string, shard long, n long")
    rest = state.join(F.broadcast(large), "digest", "left_anti").select("digest", F.col("shard").cast("long").alias("shard"), "n")
    return table(rest.unionByName(fresh), "shard-state")


def _relieved(state: DataFrame, quota: list[int], load: list[int], total: int, params: ShardParams) -> DataFrame:
    """What is beyond a shard's quota goes where there is room; only happens where nearly all documents are linked."""
    rows = state.withColumn("_b", F.pmod(F.xxhash64("digest", F.lit(9)), F.lit(max(1, total // params.bucket_rows))))
    base = running(rows.groupBy("shard", "_b").agg(F.sum("n").alias("_s")), ["shard"], "_b", "_s", "_base").drop("_s")
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard", "_b").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.join(base, ["shard", "_b"]).withColumn("_to", F.col("_base") + before + F.col("n"))
    over = F.least(F.col("n"), F.greatest(F.lit(0).cast("long"), F.col("_to") - _lookup(quota, F.col("shard"))))
    rows = rows.select("digest", "shard", (F.col("n") - over).alias("n"), over.alias("over"), F.greatest(F.col("_to") - F.col("n"), _lookup(quota, F.col("shard"))).alias("_from"))
    excess = [max(0, n - q) for n, q in zip(load, quota, strict=True)]
    starts = [sum(excess[:s]) for s in range(len(quota))]
    begin = _lookup(starts, F.col("shard")) + F.col("_from") - _lookup(quota, F.col("shard"))
    room = [max(0, q - n) for n, q in zip(load, quota, strict=True)]
    edges = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(sum(room[:s])).cast("long").alias("a"), F.lit(sum(room[: s + 1])).cast("long").alias("z")) for s in range(len(room))])
    spill = rows.where("over > 0").select("digest", begin.alias("a"), (begin + F.col("over")).alias("z"))
    spill = spill.select("digest", "a", "z", F.explode(edges).alias("e")).select("digest", F.col("e.s").alias("shard"), (F.least("z", "e.z") - F.greatest("a", "e.a")).cast("long").alias("n")).where("n > 0")
    return rows.where("n > 0").select("digest", "shard", "n").union(spill.select("digest", F.col("shard").cast("long"), "n")).groupBy("digest", "shard").agg(F.sum("n").alias("n"))


def assign(docs: DataFrame, params: ShardParams = ShardParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with size, text_crc32, law, shard, slot, grown_shard, copies and copies_here.

    Law ``rows``: shards differ by one row at most. Null texts are no bytes:
    size 16, crc32 0 and no links. Equal ids or repeated rows are rows like
    others, whose equal texts are linked. copies counts the documents of a text
    and copies_here those in the same shard; :func:`cut_links` sums them up.
    Where a document goes follows from ids and texts, however the table is
    dealt out; only rows without an id, or equal in id and text, may change
    places. Columns of ``docs`` named like results are replaced.
    """
    shards = params.shards
    names = [c for c in keep if c not in ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "copies", "copies_here")]
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    digest, crc = F.md5(F.col("text").cast("binary")), F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long"))
    rows = docs.select(*names, size.alias("size"), crc.alias("text_crc32"), digest.alias("digest"), F.xxhash64("doc_id", digest, F.lit(1)).alias("_h"), F.col("doc_id").cast("string").alias("_id"), F.monotonically_increasing_id().alias("_row"))
    rows = table(rows, "shard-rows")
    n = rows.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]

    start = F.pmod(F.xxhash64("_h", F.when(F.col("_id").isNull(), F.col("_row"))), F.lit(shards))
    per = rows.where(F.col("digest").isNotNull()).groupBy("digest", start.alias("shard")).agg(F.count("*").alias("n"))
    sizes = per.groupBy("digest").agg(F.sum("n").alias("size"), F.sum(F.lit(1)).alias("_k")).where("size > 1").select("digest")
    state = propagate(_spread(table(per.join(sizes, "digest", "left_semi"), "shard-state"), quota), quota, params)
    load = _loads(state, shards)
    if any(k > q for k, q in zip(load, quota, strict=True)):
        state = table(_relieved(state, quota, load, n, params), "shard-state")
        load = _loads(state, shards)

    parts = F.sort_array(F.collect_list(F.struct("shard", "n")))
    places = table(state.groupBy("digest").agg(parts.alias("parts"), F.sum("n").alias("weight")), "shard-classes")
    many = max(1000, int(n * params.heavy_share))
    heavy = F.broadcast(places.where(F.col("weight") > many).select("digest", "weight"))  # 1 / heavy_share rows at most
    picked = rows.join(heavy, "digest", "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("long"))).withColumn("_pick", F.xxhash64("_row"))
    light = places.withColumn("weight", F.when(F.col("weight") > many, F.col("weight")).otherwise(0))
    placed = table(salted_join(picked, light, "digest", "weight", many, "left").drop("weight", "_pick"), "shard-placed")

    whole = placed.where(F.size("parts") == 1).withColumn("shard", F.col("parts")[0]["shard"])
    split = ranked(placed.where(F.size("parts") > 1), ["digest"], n, "_r", params.bucket_rows)
    step = lambda s, x: F.struct(
        F.when((s["left"] >= 0) & (s["left"] < x["n"]), x["shard"]).otherwise(s["shard"]).alias("shard"),
        (s["left"] - x["n"]).alias("left"),
    )
    begin = F.struct(F.lit(-1).cast("long").alias("shard"), F.col("_r").alias("left"))
    split = split.withColumn("shard", F.aggregate("parts", begin, step)["shard"]).drop("_r")
    linked = whole.unionByName(split)
    copies = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    here = F.aggregate("parts", F.lit(0).cast("long"), lambda a, x: a + F.when(x["shard"] == F.col("shard"), x["n"]).otherwise(0))
    linked = linked.withColumns({"copies": copies, "copies_here": here}).drop("parts")
    linked = ranked(linked, ["shard"], n, "slot", params.bucket_rows)

    room = [q - k for q, k in zip(quota, load, strict=True)]
    ends = [sum(room[: s + 1]) for s in range(shards)]
    single = ranked(placed.where(F.col("parts").isNull()).drop("parts"), [], n, "_p", params.bucket_rows)
    bounds = F.array(*[F.lit(e) for e in ends]).cast("array<bigint>")
    single = single.withColumn("shard", F.size(F.filter(bounds, lambda e: e <= F.col("_p"))).cast("long"))
    single = single.withColumn("slot", F.col("_p") - _lookup([e - r for e, r in zip(ends, room, strict=True)], F.col("shard")) + _lookup(load, F.col("shard"))).drop("_p")
    one = F.lit(1).cast("long")
    out = linked.unionByName(single.withColumns({"copies": one, "copies_here": one}))
    return out.select(*names, "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"), "copies", "copies_here")


def cut_links(assigned: DataFrame) -> DataFrame:
    """One row: links of a star over each group of equal texts, and how many of them lead to another shard."""
    groups, parts = F.sum(1 / F.col("copies")), F.sum(1 / F.col("copies_here"))
    whole = lambda c: F.coalesce(F.round(c), F.lit(0)).cast("long")
    return assigned.agg(whole(F.count("*") - groups).alias("links"), whole(parts - groups).alias("cut"))
