"""Near-duplicate documents by BagMinHash.

The weight of a shingle is its number of occurrences. Each shingle owns Poisson
processes over the dyadic weight intervals [0,1), [1,2), [2,4), ...; a text
keeps, in each of m registers, the earliest point whose weight lies below the
shingle's, so two registers agree with the probability of the weighted Jaccard
similarity. Registers are banded, texts that share a band are verified by exact
multiset overlap, and verified links are closed to classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bytewords as bw
from tidemark.llm.common import bound_batches, discard, map_append, split_join, table

U = np.uint64


@dataclass(frozen=True)
class NearDupParams:
    """shingle: words of a shingle; similarity: least weighted Jaccard of a link;
    bands x rows: registers, so that a pair at 0.8 shares a band with chance 0.99995;
    heavy_share: texts and classes of more than this share of all rows, of which
    there are at most 1 / heavy_share, are looked up by broadcast.
    """

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 25
    rows: int = 5
    heavy_share: float = 1e-4


def hashed_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and the number of words before each text.

    Words are runs of ASCII letters, digits and non-ASCII characters, in lower case for A-Z.
    """
    data = bw.lower_table()[data]
    starts, ends, before = bw.spans(bw.byte_class("alnum")[data], offsets)
    return bw.word_hashes(data, starts, ends), before


def shingles(h: np.ndarray, before: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the text of each; fewer words than ``size``, but not none, are one shingle."""
    words = np.diff(before)
    n = np.where(words == 0, 0, np.maximum(words - size + 1, 1))
    doc = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + before[doc]
    left = before[doc + 1] - at
    out = np.zeros(len(doc), U)
    padded = np.concatenate([h, np.zeros(size, U)])
    for k in range(size):
        out = (out + np.where(left > k, padded[at + k], U(0x5851F42D4C957F2D))) * U(0xD1342543DE82EF95)
        out ^= out >> U(32)
    return bw.mix(out), doc


def text_keys(h: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digest of each text's sequence of words."""
    words = np.diff(before)
    place = (np.arange(len(h)) - np.repeat(before[:-1], words)).astype(U)
    out = []
    for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        total = np.zeros(len(h) + 1, U)
        np.cumsum(bw.mix(h ^ bw.mix(place + U(k))), out=total[1:])
        out.append(bw.mix(total[before[1:]] - total[before[:-1]] + words.astype(U)))
    return out[0], out[1]


def signatures(s: np.ndarray, doc: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Registers of each text, as float32 arrival times: array (n_docs, m); infinite for texts without shingles."""
    registers = np.full(n_docs * m, np.inf)
    if not len(s):
        return registers.reshape(n_docs, m).astype(np.float32)
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    weight = np.diff(np.append(first, len(s)))
    s, doc = s[first], doc[first]
    total = np.bincount(doc, weight, n_docs)
    # one process for each dyadic interval below the weight: [0,1), then [2^(b-1), 2^b)
    levels = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64), 0) + 1
    entry = np.repeat(np.arange(len(s)), levels)
    level = np.arange(len(entry)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    size = np.where(level > 0, low, 1.0)
    seed = bw.mix(s[entry] + level.astype(U) * U(0xA0761D6478BD642F))
    room = (weight[entry] - low) / size
    rate, owner = m * size, doc[entry]

    limit = (np.log(m) + 4) / np.maximum(total, 1)
    todo = total > 0
    while todo.any():
        live = np.flatnonzero(todo[owner])
        time, k, width = np.zeros(len(live)), 0, 1
        while len(live):
            steps = np.arange(k, k + width, dtype=U) * U(0xE7037ED1A0B428DB)
            bits = bw.mix(seed[live][:, None] + steps)
            gap = -np.log(((bits >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate[live][:, None]
            times = np.cumsum(gap, 1) + time[:, None]
            ok = times <= limit[owner[live]][:, None]
            more = bw.mix(bits ^ U(0x8EBC6AF09C88C6E3))
            inside = ((more >> U(32)).astype(np.float64) * 2.0**-32) < room[live][:, None]
            r, c = np.nonzero(ok & inside)
            spot = owner[live][r] * m + (more[r, c] & U(0xFFFFFFFF)).astype(np.int64) % m
            np.minimum.at(registers, spot, times[r, c])
            still = np.flatnonzero(ok[:, -1])
            live, time, k, width = live[still], times[still, -1], k + width, min(width * 2, 256)
        empty = np.isinf(registers.reshape(n_docs, m)).any(1)
        todo &= empty
        limit = np.where(todo, limit * 2, limit)
    return registers.reshape(n_docs, m).astype(np.float32)


def band_hashes(registers: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash for each band of each text."""
    v = registers.view(np.uint32).astype(U).reshape(len(registers), bands, rows)
    out = np.broadcast_to(bw.mix(np.arange(1, bands + 1, dtype=U) * U(0x9E3779B97F4A7C15)), v.shape[:2]).copy()
    for k in range(rows):
        out = bw.mix((out ^ v[:, :, k]) * U(0xD6E8FEB86659FD93))
    return out


def _sign(column: pa.Array, params: NearDupParams) -> tuple[pa.Array, pa.Array]:
    """Key (16 bytes, null without words) and band hashes of each text."""
    raw, offsets = bw.buffers(column)
    keys, signed = [], []
    for _, _, data, at in bw.chunks(raw, offsets):
        for i in range(0, len(at) - 1, 2000):
            to = at[i : i + 2001]
            h, before = hashed_words(data[to[0] : to[-1]], to - to[0])
            s, doc = shingles(h, before, params.shingle)
            n = len(to) - 1
            pair = np.stack(text_keys(h, before), 1)
            some = np.diff(before) > 0
            keys += [k.tobytes() if ok else None for k, ok in zip(pair, some.tolist(), strict=True)]
            signed.append(band_hashes(signatures(s, doc, n, params.bands * params.rows), params.bands, params.rows))
    flat = np.concatenate(signed).view(np.int64).ravel() if signed else np.zeros(0, np.int64)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * params.bands), pa.array(flat))
    return pa.array(keys, pa.binary()), lists


def _text_key(column: pa.Array) -> pa.Array:
    raw, offsets = bw.buffers(column)
    keys: list[bytes | None] = []
    for _, _, data, at in bw.chunks(raw, offsets):
        h, before = hashed_words(data, at)
        keys += [k.tobytes() if ok else None for k, ok in zip(np.stack(text_keys(h, before), 1), (np.diff(before) > 0).tolist(), strict=True)]
    return pa.array(keys, pa.binary())


def with_key(docs: DataFrame) -> DataFrame:
    """Add ``_key``, the digest of a text's words; null where it has none."""
    at = docs.columns.index("text")
    return map_append(docs, lambda batch: [_text_key(batch.column(at))], [T.StructField("_key", T.BinaryType())])


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(_key, text) of texts with words, the first of each key in an Arrow batch, so that copies seldom leave a task."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _text_key(batch.column(0))
            first: dict[bytes, int] = {}
            for i, k in enumerate(keys.to_pylist()):
                if k is not None:
                    first.setdefault(k, i)
            at = pa.array(list(first.values()), pa.int64())
            yield pa.RecordBatch.from_arrays([keys.take(at), batch.column(0).take(at)], names=["_key", "text"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "_key binary, text string")


def overlap(a: pa.Array, b: pa.Array, size: int) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts."""
    n = len(a)
    sides = []
    for column in (a, b):
        raw, offsets = bw.buffers(column)
        parts = []
        for at, _, data, to in bw.chunks(raw, offsets):
            s, doc = shingles(*hashed_words(data, to), size)
            parts.append((bw.mix(s ^ bw.mix((doc + at).astype(U) + U(77))), doc + at))
        sides.append(tuple(np.concatenate(x) if parts else np.zeros(0, np.int64) for x in (zip(*parts, strict=True) if parts else ((), ()))))
    (sa, da), (sb, db) = sides
    found, which = np.unique(np.concatenate([sa, sb]), return_inverse=True)
    pair = np.zeros(len(found), np.int64)
    pair[which] = np.concatenate([da, db])
    ca, cb = np.bincount(which[: len(sa)], minlength=len(found)), np.bincount(which[len(sa) :], minlength=len(found))
    low = np.bincount(pair, np.minimum(ca, cb), n)
    high = np.bincount(pair, np.maximum(ca, cb), n)
    return low / np.maximum(high, 1)


def verified(pairs: DataFrame, texts: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs (a, b) of keys whose texts are similar enough, with the similarity ``sim``."""
    bound_batches(pairs.sparkSession)
    left = pairs.join(texts.select(F.col("_key").alias("a"), F.col("text").alias("_ta")), "a")
    both = left.join(texts.select(F.col("_key").alias("b"), F.col("text").alias("_tb")), "b").select("a", "b", "_ta", "_tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sim = pa.array(overlap(batch.column(2), batch.column(3), params.shingle))
            ok = pc.greater_equal(sim, params.similarity)
            yield pa.RecordBatch.from_arrays([x.filter(ok) for x in (batch.column(0), batch.column(1), sim)], names=["a", "b", "sim"])

    return both.mapInArrow(run, "a binary, b binary, sim double")


def elements(texts: DataFrame, params: NearDupParams) -> DataFrame:
    """(_key, e): each occurrence of each shingle, the second one apart from the first and so on."""
    bound_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = bw.buffers(batch.column(1))
            for at, _, data, to in bw.chunks(raw, offsets):
                s, doc = shingles(*hashed_words(data, to), params.shingle)
                order = np.lexsort((s, doc))
                s, doc = s[order], doc[order]
                new = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (doc[1:] != doc[:-1]))) if len(s) else np.zeros(0, np.int64)
                nth = np.arange(len(s)) - np.repeat(new, np.diff(np.append(new, len(s))))
                e = bw.mix(s + nth.astype(U) * U(0x9E3779B97F4A7C15)).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + at)), pa.array(e)], names=["_key", "e"])

    return texts.select("_key", "text").mapInArrow(run, "_key binary, e long")


def possible(members: DataFrame, texts: DataFrame, params: NearDupParams) -> DataFrame:
    """Pairs (a, b) of ``members`` (_key, c, odd) that may still be links between components.

    One side is ``odd``. A link needs a common element among the rarest
    n - ceil(t n) + 1 of each text's n, at places that leave room for the
    overlap that the similarity t asks for; so nothing is lost, and texts whose
    rarest shingles are their own meet nobody.
    """
    t = params.similarity
    each = elements(texts.join(members.select("_key"), "_key", "left_semi"), params)
    each = table(each, "elements")
    rare = each.groupBy("e").agg(F.count("*").alias("df")).where("df > 1")
    # an element of one text is rarer than all others and meets nobody: only the number of these matters
    sizes = each.groupBy("_key").agg(F.count("*").alias("size"))
    met = each.join(rare, "e").groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("_e"))
    prefix = members.join(met, "_key").join(sizes, "_key")
    own = F.col("size") - F.size("_e")
    length = F.col("size") - F.ceil(F.col("size") * t - 1e-9) + 1 - own
    prefix = prefix.select("_key", "c", "odd", "size", own.alias("own"), F.posexplode(F.slice("_e", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))).alias("at", "x"))
    prefix = table(prefix.select("_key", "c", "odd", "size", (F.col("own") + F.col("at")).alias("at"), F.col("x.e").alias("e")), "prefixes")
    x, y = prefix.where("odd").alias("x"), prefix.alias("y")
    room = 1 + F.least(F.col("x.size") - F.col("x.at") - 1, F.col("y.size") - F.col("y.at") - 1)
    apart = (F.col("x.c") != F.col("y.c")) & (~F.col("y.odd") | (F.col("x._key") < F.col("y._key")))
    pairs = x.join(y, (F.col("x.e") == F.col("y.e")) & apart & (room >= (F.col("x.size") + F.col("y.size")) * (t / (1 + t)) - 1e-9))
    return pairs.select(F.least("x._key", "y._key").alias("a"), F.greatest("x._key", "y._key").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(v, c): each linked node and the least node of its component.

    Least labels spread along edges and are then looked up once more through
    themselves, so the rounds grow with the logarithm of a component's width.
    """
    both = table(edges.select(F.col("a").alias("v"), F.col("b").alias("o")).union(edges.select("b", "a")).distinct(), "links")
    labels = table(both.groupBy("v").agg(F.min("o").alias("_m")).select("v", F.least("v", "_m").alias("c")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("o"), F.col("c").alias("_c")), "o").groupBy("v").agg(F.min("_c").alias("_m"))
        step = labels.join(near, "v").select("v", "c", F.least("c", "_m").alias("_n"))
        jump = step.join(labels.select(F.col("v").alias("_n"), F.col("c").alias("_j")), "_n", "left")
        done = table(jump.select("v", F.least("_n", F.coalesce("_j", "_n")).alias("c"), (F.least("_n", F.coalesce("_j", "_n")) != F.col("c")).alias("moved")), "labels")
        discard(labels)
        labels = done
        if not labels.where("moved").limit(1).count():
            discard(both)
            return labels.select("v", "c")


def _mixed(members: DataFrame, label: DataFrame) -> DataFrame:
    """band, _key, its component c and the largest one of the band, of bands that hold several."""
    placed = members.join(label.withColumnRenamed("v", "_key"), "_key", "left").select("band", "_key", F.coalesce("c", "_key").alias("c"))
    per = placed.groupBy("band", "c").agg(F.count("*").alias("n")).groupBy("band").agg(F.max(F.struct("n", "c"))["c"].alias("main"), F.count("*").alias("parts"))
    return placed.join(per.where("parts > 1").select("band", "main"), "band")


def classes(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """doc_id, class_id and class_size of each row, with ``_key`` and the class's own key ``_class``.

    Texts of equal words are one node, whatever their number. In each band the
    nodes are first linked to the least of them only. Where that leaves several
    components in a band, nodes outside its largest are compared with the node
    of the largest that is nearest to its links, and then with all nodes that
    :func:`possible` can't rule out. So no link between candidates is missed,
    while a band of alike texts costs few comparisons a text. A class is named
    by its least doc_id (null if it has none); texts without words, null
    included, are classes by themselves. Repeated rows are copies of each other.
    """
    signed = map_append(docs.select("doc_id", "text"), lambda batch: _sign(batch.column(1), params), [T.StructField("_key", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))], ("text",))
    signed = table(signed, "signed")
    nodes = signed.where(F.col("_key").isNotNull()).groupBy("_key").agg(F.min("_bands").alias("_bands"))
    rows = table(nodes.select("_key", F.explode("_bands").alias("band")), "bands")
    shared = rows.groupBy("band").agg(F.min("_key").alias("lead"), F.count("*").alias("n")).where("n > 1")
    members = table(rows.join(shared, "band").select("band", "_key", "lead"), "shared-bands")
    stars = table(members.where(F.col("_key") != F.col("lead")).select(F.col("lead").alias("a"), F.col("_key").alias("b")).distinct(), "stars")
    wanted = members.select("_key").distinct()
    texts = table(distinct_texts(docs).join(wanted, "_key", "left_semi").groupBy("_key").agg(F.min("text").alias("text")), "texts")
    links = table(verified(stars, texts, params), "links")
    label = components(links)

    mixed = table(_mixed(members, label), "mixed")
    close = links.select(F.col("a").alias("_key"), "sim").union(links.select("b", "sim")).groupBy("_key").agg(F.max("sim").alias("sim"))
    hubs = mixed.where(F.col("c") == F.col("main")).join(close, "_key").groupBy("band").agg(F.max(F.struct("sim", "_key"))["_key"].alias("hub"))
    near = mixed.where(F.col("c") != F.col("main")).join(hubs, "band").select(F.least("_key", "hub").alias("a"), F.greatest("_key", "hub").alias("b")).distinct()
    more = table(verified(near.join(stars, ["a", "b"], "left_anti"), texts, params), "links")
    if more.limit(1).count():
        links = links.union(more)
        label = components(links)

    odd = F.max(F.col("c") != F.col("main")).alias("odd")
    left = table(_mixed(members, label).groupBy("_key", "c").agg(odd), "left")
    last = table(verified(possible(left, texts, params), texts, params), "links")
    if last.limit(1).count():
        label = components(links.union(last))

    # rows are counted per text first, texts per class: neither a text's copies nor a class meet in one task
    worded = signed.where(F.col("_key").isNotNull()).select("doc_id", "_key")
    per_text = worded.groupBy("_key").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
    per_text = table(per_text.join(label.withColumnRenamed("v", "_key"), "_key", "left").select("_key", "_least", "_n", F.coalesce("c", "_key").alias("_class")), "class-texts")
    per_class = per_text.groupBy("_class").agg(F.min("_least").alias("class_id"), F.sum("_n").alias("class_size"))
    many = max(1000, int(signed.count() * params.heavy_share))
    keyed = table(split_join(per_text.drop("_least"), table(per_class, "classes"), "_class", "class_size", many), "class-keys")
    names = ["doc_id", "class_id", "class_size", "_key", "_class"]
    out = split_join(worded, keyed, "_key", "_n", many).select(*names)
    none = F.lit(None).cast("binary")
    alone = signed.where(F.col("_key").isNull()).select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), none.alias("_key"), none.alias("_class"))
    return out.unionByName(alone)


def deduplicated(docs: DataFrame, params: NearDupParams = NearDupParams()) -> DataFrame:
    """Rows of ``docs`` without near-duplicates: of each class the row of least doc_id, null last.

    Texts without words stay, each of them; of rows equal in id and words one stays.
    """
    found = table(classes(docs, params), "classes").where(F.col("_class").isNotNull())
    first = found.groupBy("_class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id"), "_key")).alias("r"))
    first = first.select("r.*", F.lit(True).alias("_stays"))
    keyed = with_key(docs).withColumn("_none", F.col("doc_id").isNull()).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)))
    kept = keyed.join(first, ["_none", "_id", "_key"], "left").where(F.col("_key").isNull() | F.col("_stays"))
    apart = F.when(F.col("_key").isNull(), F.monotonically_increasing_id())
    return kept.withColumn("_apart", apart).dropDuplicates(["_none", "_id", "_key", "_apart"]).select(*docs.columns)
