"""Benchmark decontamination by a prefix-filtered set join.

Items are cut in windows of consecutive words. Words are ordered by how rare
they are in the documents; a text can only contain a window if it contains the
window's rarest word, so that word alone (the necessary prefix of a set that
must be contained entirely) is joined. A match fixes where the window would
lie: it must not begin before the text or end after it, and then all its words
are compared in order.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, table

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class DecontamParams:
    """window: consecutive words that count as leaked.

    literal_words: up to as many prefix words are looked up in place; beyond it
    texts are probed by a shuffled join, which gives the same rows; only words
    whose hash is marked in a bitmap of 2^bitmap_bits bits are shuffled then.
    """

    window: int = 10
    literal_words: int = 100_000
    bitmap_bits: int = 22


def words(text: Column) -> Column:
    """Words of ASCII letters, lower-cased, digits and all other characters; null gives none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct (item, words) windows: every ``size`` words, or all of a shorter item that has words.

    Items without an id have windows too; their item is null.
    """
    w = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("_w"))
    w = w.where(F.size("_w") > 0)
    last = F.greatest(F.lit(0), F.size("_w") - size)
    cut = F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(F.col("_w"), i + 1, F.lit(size))))
    return w.select("item", cut.alias("window")).distinct()


def marked(vocabulary: DataFrame, bits: int) -> Callable[[Column], Column]:
    """Test of a word that all words of ``vocabulary`` pass, and few others: a bitmap of hashes, of fixed size."""
    h = lambda w: F.xxhash64(w, F.lit(13)).bitwiseAND((1 << bits) - 1)
    place = h(F.col("word"))
    parts = vocabulary.select(F.shiftright(place, 6).alias("i"), F.expr("1L").alias("one"), place.bitwiseAND(63).cast("int").alias("k")).groupBy("i").agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("k"))).alias("m"))
    cells = [0] * (1 << (bits - 6))
    for r in parts.collect():  # at most 2^(bits - 6) rows, whatever the vocabulary
        cells[r.i] = r.m
    table = F.split(F.lit(",".join(map(str, cells))), ",").cast("array<bigint>")  # folded to one constant
    return lambda w: F.call_function("getbit", F.get(table, F.shiftright(h(w), 6).cast("int")), h(w).bitwiseAND(63).cast("int")) == 1


def rarity(docs: DataFrame, vocabulary: DataFrame, few: list[str] | None, params: DecontamParams) -> DataFrame:
    """How often each word of the benchmark occurs in all documents; 0 where it doesn't."""
    every = words(F.col("text"))
    found = F.filter(every, (lambda w: w.isin(few)) if few is not None else marked(vocabulary, params.bitmap_bits))
    counts = docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return vocabulary.join(counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def prefixes(docs: DataFrame, items: DataFrame, params: DecontamParams) -> DataFrame:
    """Each distinct window with its rarest word and that word's place in it, and the items that hold it."""
    per = table(windows(items, params.window), "benchmark-windows")
    vocabulary = per.select(F.explode("window").alias("word")).distinct()
    few = None
    if vocabulary.count() <= params.literal_words:
        few = [r.word for r in vocabulary.collect()]
    counts = rarity(docs, vocabulary, few, params)
    held = per.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    spread = held.select("window", F.posexplode("window").alias("offset", "word")).join(counts, "word")
    rarest = spread.groupBy("window").agg(F.min(F.struct("n", "word", "offset")).alias("_p"))
    return held.join(rarest, "window").select("window", "items", F.col("_p.word").alias("word"), F.col("_p.offset").alias("offset"))


def _context(i: Column, w: Column, span: int) -> Column:
    """Word i, its place and the words around it, all that any window on it can cover."""
    start = F.greatest(i - (span - 1), F.lit(0))
    return F.struct(F.get(w, i).alias("word"), i.alias("at"), start.alias("from"), F.slice(w, start + 1, i - start + span).alias("around"))


def hits(docs: DataFrame, index: DataFrame, params: DecontamParams) -> DataFrame:
    """Per row of ``docs`` (key ``_row``): n_words, the spans that windows cover and the items found.

    Only places of prefix words leave the row, with the words around them.
    """
    span = params.window
    n_prefixes = index.count()
    probe = index.select("word").distinct()
    text = docs.select("_row", words(F.col("text")).alias("_w"))
    if n_prefixes <= params.literal_words:
        # the condition above is the proven bound of both the literal set and the broadcast
        rare = [r.word for r in probe.collect()]
        chosen = lambda w: F.filter(F.transform(w, lambda x, i: F.when(x.isin(rare), i)), lambda i: i.isNotNull())
        places = text.select("_row", F.size("_w").alias("n_words"), chosen(F.col("_w")).alias("_at"), "_w")
        index = F.broadcast(index)
    else:
        # rows are numbered once: both reads below must agree on ``_row``
        docs = table(docs, "benchmark-rows")
        text = docs.select("_row", words(F.col("text")).alias("_w"))
        may = marked(probe, params.bitmap_bits)
        some = F.filter(F.transform("_w", lambda x, i: F.when(may(x), F.struct(i.alias("at"), x.alias("word")))), lambda x: x.isNotNull())
        spread = text.select("_row", F.inline(some))
        at = spread.join(probe, "word", "left_semi").groupBy("_row").agg(F.collect_list("at").alias("_at"))
        places = text.join(at, "_row", "left").select("_row", F.size("_w").alias("n_words"), F.coalesce("_at", F.array().cast("array<int>")).alias("_at"), "_w")
    around = F.transform("_at", lambda i: _context(i, F.col("_w"), span))
    spots = places.select("_row", "n_words", F.explode_outer(around).alias("_c")).select("_row", "n_words", "_c.*")
    fits = (F.col("at") >= F.col("offset")) & (F.col("at") - F.col("offset") + F.size("window") <= F.col("n_words"))
    start = F.col("at") - F.col("offset")
    same = F.slice(F.col("around"), start - F.col("from") + 1, F.size("window")) == F.col("window")
    near = spots.join(index, "word", "left")
    ok = F.coalesce(fits, F.lit(False)) & F.when(fits, same).otherwise(False)
    return near.select(
        "_row",
        "n_words",
        F.when(ok, F.struct(start.alias("a"), (start + F.size("window")).alias("z"))).alias("span"),
        F.when(ok, F.col("items")).alias("items"),
    )


def _covered(spans: Column) -> Column:
    """Number of places that sorted spans cover together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda s, x: F.struct(
        F.greatest(s["end"], x["z"]).alias("end"),
        (s["n"] + F.greatest(F.lit(0), x["z"] - F.greatest(s["end"], x["a"]))).cast("long").alias("n"),
    )
    return F.aggregate(spans, zero, step)["n"]


def decontaminate(docs: DataFrame, items: DataFrame, params: DecontamParams = DecontamParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with n_words, n_hit, n_items, items_sha256, contaminated.

    A text without words, or null, is clean; items without words are in no
    text. Windows of items without an id are hits too, but n_items and
    items_sha256 tell of ids only. Repeated rows get a result each. An empty
    benchmark leaves all clean. Columns of ``docs`` that are named like results
    are replaced, other columns of the benchmark are ignored.
    """
    names = [c for c in keep if c not in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")]
    index = table(prefixes(docs.select("text"), items, params), "benchmark-prefixes")
    rows = docs.select(F.struct(F.monotonically_increasing_id().alias("_n"), *names).alias("_row"), "text")
    found = hits(rows, index, params).groupBy("_row", "n_words").agg(F.collect_set("span").alias("_s"), F.collect_set("items").alias("_i"))
    items_of = F.sort_array(F.array_distinct(F.flatten("_i")))
    out = found.select("_row.*", F.col("n_words").cast("long").alias("n_words"), _covered(F.sort_array("_s")).alias("n_hit"), items_of.alias("_items"))
    return out.select(
        *names, "n_words", "n_hit", F.size("_items").cast("long").alias("n_items"), F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


#: DuckDB SQL of the contract.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
v AS (SELECT DISTINCT item, len(x) AS n, array_to_string(x, ' ') AS win FROM
    (SELECT item, unnest([w[i:i + 9] FOR i IN range(1, greatest(1, len(w) - 9) + 1)]) AS x FROM b WHERE len(w) > 0)),
m AS (SELECT DISTINCT n FROM v),
p AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS win FROM
    (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, m WHERE len(w) >= n)),
h AS (SELECT p.row, p.i, p.n, v.item FROM p JOIN v ON p.win = v.win AND p.n = v.n),
c AS (SELECT row, count(DISTINCT j) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS j FROM h) GROUP BY row),
e AS (SELECT row, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT row, item FROM h) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (row) LEFT JOIN e USING (row)
"""
