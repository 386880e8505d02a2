"""Language-model scoring by a probabilistic suffix tree over bytes.

Texts are spelled as lower-cased words with one space between and an end mark.
A context of up to ``depth`` bytes is a candidate if it is not too rare, and stays
if its next-byte distribution diverges from that of its own suffix (or if a
longer context that ends in it stays). Distributions are smoothed towards those
of the suffix; each byte is scored in the state of the longest retained suffix
of what precedes it. All contexts are counted, tested and smoothed in tables;
the most frequent are sent to workers, the others are joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bytewords as bw
from tidemark.llm.common import bound_batches, table

END, SPACE = 10, 32
#: Whole units of log10 that sums over documents are kept in, so that they don't depend on the order of addition.
SCALE = 10**10


@dataclass(frozen=True)
class TreeParams:
    """depth: longest context; min_count: least symbols that a context
    precedes, whatever the training size; min_share: a least share of all
    symbols besides, none unless set; divergence: least log-likelihood gain, in
    units of the logarithm of the training size; max_states: the most frequent
    contexts, so many of them, are sent to all workers; symbols after all others
    are scored by a join, with the same result; head_share: words of at least this share of all
    training tokens, at most 1 / head_share of them, are sent to all workers;
    counts of the others are joined.
    """

    depth: int = 5
    min_count: int = 10
    min_share: float = 0.0
    divergence: float = 1.0
    max_states: int = 100_000
    head_share: float = 1e-6


def spelled(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ``depth`` end marks, their offsets; and word starts, ends and counts before each text."""
    data = bw.lower_table()[data]
    word = bw.byte_class("space")[data]
    starts, ends, before = bw.spans(word, offsets)
    size = ends - starts + 1
    words = np.diff(before)
    run = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=run[1:])
    per = run[before[1:]] - run[before[:-1]] + (words == 0) + depth
    to = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=to[1:])
    doc = np.repeat(np.arange(len(words)), words)
    first = run[:-1] - run[before[doc]] + to[doc] + depth
    out = np.full(int(to[-1]), END, np.uint8)
    out[np.repeat(first - starts, size - 1) + np.flatnonzero(word)] = data[word]
    inner = np.ones(len(size), bool)
    inner[before[1:][words > 0] - 1] = False
    out[(first + size - 1)[inner]] = SPACE
    return out, to, starts, ends, before


def tally(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and how often each occurs."""
    if counts is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, counts = values[order], counts[order]
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.diff(np.append(first, len(values))) if counts is None else np.add.reduceat(counts, first)


def counted(texts: DataFrame, params: TreeParams) -> DataFrame:
    """kind (0: words by hash, 1: runs of depth + 1 symbols), key, n over all ``texts``."""
    bound_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[], []]

        def out() -> Iterator[pa.RecordBatch]:
            for kind in (0, 1):
                if held[kind]:
                    keys, n = tally(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))
                    for i in range(0, len(keys), 1 << 17):
                        part = keys[i : i + (1 << 17)]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part), pa.array(n[i : i + (1 << 17)])], names=["kind", "key", "n"])
                    held[kind] = []

        for batch in batches:
            raw, offsets = bw.buffers(batch.column(0))
            for _, _, data, at in bw.chunks(raw, offsets, 1 << 20):
                symbols, to, starts, ends, _ = spelled(data, at, params.depth)
                held[0].append(tally(bw.word_hashes(bw.lower_table()[data], starts, ends).view(np.int64)))
                code = np.zeros(len(symbols) - params.depth, np.int64)
                for k in range(params.depth + 1):
                    code = code << 8 | symbols[k : len(code) + k]
                real = np.ones(len(symbols), bool)
                for k in range(params.depth):
                    real[to[:-1] + k] = False
                held[1].append(tally(code[real[params.depth :]]))
            for kind in (0, 1):
                if sum(len(k) for k, _ in held[kind]) > 3_000_000:
                    held[kind] = [tally(*(np.concatenate(x) for x in zip(*held[kind], strict=True)))]
            if max((len(h[0][0]) if h else 0) for h in held) > 2_000_000:
                yield from out()
        yield from out()

    found = texts.select("text").mapInArrow(run, "kind byte, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class SuffixTree:
    """Retained contexts as transition and log-probability tables over the symbols seen in training."""

    def __init__(self, depth: int, symbol: np.ndarray, child: np.ndarray, logp: np.ndarray):
        self.depth, self.symbol, self.child, self.logp = depth, symbol, child, logp

    @classmethod
    def learn(cls, levels: list[tuple[np.ndarray, np.ndarray]], params: TreeParams) -> SuffixTree:
        """``levels[d]``: codes of d context bytes and the next, and counts, of the candidates of that length.

        The definition of :func:`tables` and :func:`planted` for levels that fit in memory; all contexts are held.
        """
        codes, n = levels[0]
        seen = np.unique(codes & 255) if len(codes) else np.zeros(0, np.int64)
        width = len(seen) + 1
        symbol = np.full(256, width - 1, np.int64)
        symbol[seen] = np.arange(len(seen))
        total = float(n.sum())
        root = np.full(width, 0.5)
        root[symbol[codes & 255]] += n
        root /= total + 128.0
        known: dict[int, dict[int, np.ndarray]] = {0: {0: root}}
        gain = params.divergence * np.log(max(total, 2))
        keep: list[set[int]] = [{0}] + [set() for _ in range(params.depth)]
        for d in range(1, params.depth + 1):
            codes, n = levels[d]
            known[d] = {}
            order = np.argsort(codes)
            codes, n = codes[order], n[order]
            contexts, first = np.unique(codes >> 8, return_index=True)
            for s, a, b in zip(contexts.tolist(), first.tolist(), np.append(first, len(codes))[1:].tolist(), strict=True):
                parent = known[d - 1].get(s & ((1 << 8 * (d - 1)) - 1))
                if parent is None:
                    continue
                to, c = symbol[codes[a:b] & 255], n[a:b].astype(float)
                size, weight = c.sum(), float(b - a)
                p = parent * (weight / (size + weight))
                p[to] += c / (size + weight)
                known[d][s] = p
                won = float((c * np.log(c / size / parent[to])).sum())
                if won >= gain:
                    keep[d].add(s)
        for d in range(params.depth, 1, -1):
            keep[d - 1] |= {s & ((1 << 8 * (d - 1)) - 1) for s in keep[d]}
        node = {(d, s): i for i, (d, s) in enumerate((d, s) for d in range(params.depth + 1) for s in sorted(keep[d]))}
        logp = np.zeros((len(node), width), np.float32)
        child = np.zeros((len(node), width), np.int32)
        for (d, s), i in node.items():
            logp[i] = np.log10(known[d][s])
            if d:
                child[node[d - 1, s & ((1 << 8 * (d - 1)) - 1)], symbol[s >> 8 * (d - 1)]] = i
        return cls(params.depth, symbol, child, logp)

    def score(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """log10 probability of each text; texts are ``spelled``."""
        return self.scored(symbols, offsets)[0]

    def scored(self, symbols: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each text but for symbols after contexts that are not held; their number per text; their runs of depth + 1 symbols."""
        n = len(offsets) - 1
        s = self.symbol[symbols]
        m = len(s) - self.depth
        if m <= 0:
            return np.zeros(n), np.zeros(n, np.int64), np.zeros(0, np.int64)
        width = self.child.shape[1]
        flat = self.child.ravel()
        state = np.zeros(m, np.int64)
        open_ = np.arange(m)
        away = []
        for k in range(self.depth):
            # 0 is the root, which is nobody's child: no longer suffix is retained; -1: one is, but isn't held
            step = flat[state[open_] * width + s[open_ + (self.depth - 1 - k)]]
            away.append(open_[step < 0])
            on = np.flatnonzero(step > 0)
            open_ = open_[on]
            state[open_] = step[on]
        value = self.logp.ravel()[state * width + s[self.depth :]].astype(np.float64)
        far = np.sort(np.concatenate(away))
        value[far] = 0
        text = np.searchsorted(offsets, far, "right") - 1
        real = far < offsets[text + 1] - self.depth
        far, text = far[real], text[real]
        code = np.zeros(len(far), np.int64)
        for k in range(self.depth + 1):
            code = code << 8 | symbols[far + k]
        # a text's first symbol follows its pads; the pads of the next text are not scored
        edges = np.stack([offsets[:-1], offsets[1:] - self.depth], 1).ravel()
        return np.add.reduceat(np.append(value, 0.0), edges)[::2], np.bincount(text, minlength=n), code


def _low(c: Column, symbols: int) -> Column:
    """The last ``symbols`` symbols of a code."""
    return c.bitwiseAND((1 << 8 * symbols) - 1)


@dataclass(frozen=True)
class Tables:
    """levels[d]: code of d context symbols and the next, p; states: retained contexts as d, c, m (symbols after it), w (distinct ones)."""

    total: int
    levels: list[DataFrame]
    states: DataFrame


def tables(grams: DataFrame, total: int, params: TreeParams) -> Tables:
    """All retained contexts and smoothed probabilities of what follows candidates, from ``grams`` (key, n)."""
    spark = grams.sparkSession
    per = [grams.select(F.col("key").alias("code"), "n")]
    for d in range(params.depth, 0, -1):
        per.insert(0, table(per[0].groupBy(_low(F.col("code"), d).alias("code")).agg(F.sum("n").alias("n")), "grams"))
    least = max(params.min_count, params.min_share * total)
    gain = params.divergence * float(np.log(max(total, 2)))
    levels = [table(per[0].select("code", ((F.col("n") + 0.5) / (total + 128.0)).alias("p")), "level")]
    tested = [spark.createDataFrame([], "c long, m long, w long, won double")]
    for d in range(1, params.depth + 1):
        rows = per[d].withColumn("c", F.shiftright("code", 8))
        rows = rows.join(rows.groupBy("c").agg(F.sum("n").alias("m"), F.count("*").alias("w")).where(F.col("m") >= least), "c")
        # a suffix of a candidate is one, and what follows the candidate follows it
        rows = rows.withColumn("_up", _low(F.col("code"), d)).join(levels[-1].select(F.col("code").alias("_up"), F.col("p").alias("q")), "_up")
        rows = rows.select("c", "code", "m", "w", ((F.col("n") + F.col("w") * F.col("q")) / (F.col("m") + F.col("w"))).alias("p"), F.floor(F.col("n") * F.log(F.col("n") / F.col("m") / F.col("q")) * 1e5 + 0.5).alias("g"))
        levels.append(table(rows, "level"))
        tested.append(levels[-1].groupBy("c", "m", "w").agg((F.sum("g") / 1e5).alias("won")))
    states = []
    for d in range(params.depth, 0, -1):
        stay = tested[d].where(F.col("won") >= gain).select("c")
        if states:
            stay = stay.union(states[-1].select(_low(F.col("c"), d))).distinct()
        states.append(table(tested[d].join(stay, "c", "left_semi").select(F.lit(d).alias("d"), "c", "m", "w"), "states"))
    every = states[0]
    for x in states[1:]:
        every = every.union(x)
    return Tables(total, levels, every)


def planted(t: Tables, params: TreeParams) -> tuple[SuffixTree, bool]:
    """The tree of the ``max_states`` most frequent retained contexts; whether there are others."""
    more = t.states.count() > params.max_states
    held = t.states
    if more:
        # a suffix is at least as frequent and shorter, so it is held where its context is
        held = table(held.orderBy(F.desc("m"), "d", "c").limit(params.max_states), "held-states")
    first = t.levels[0].toArrow()
    codes = first["code"].to_numpy().astype(np.int64)
    seen = np.sort(codes)
    width = len(seen) + 1
    symbol = np.full(256, width - 1, np.int64)
    symbol[seen] = np.arange(len(seen))
    got = held.orderBy("d", "c").toArrow()
    depth, c, m, w = (got[k].to_numpy().astype(np.int64) for k in ("d", "c", "m", "w"))
    logp = np.zeros((1 + len(c), width), np.float32)
    child = np.zeros((1 + len(c), width), np.int32)
    logp[0] = np.log10(0.5 / (t.total + 128.0))
    logp[0, symbol[codes]] = np.log10(first["p"].to_numpy())
    above, at = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for d in range(1, params.depth + 1):
        of = lambda x, d=d: at[np.searchsorted(above, x & ((1 << 8 * (d - 1)) - 1))]
        if more and len(above):
            # edges out of held contexts to others; at most as many as ``child`` has places
            mine = held.where(F.col("d") == d - 1).select("c") if d > 1 else t.states.sparkSession.range(1).select(F.col("id").alias("c"))
            others = t.states.where(F.col("d") == d).select("c").join(held.where(F.col("d") == d).select("c"), "c", "left_anti")
            out = others.withColumn("_s", F.col("c")).withColumn("c", _low(F.col("c"), d - 1)).join(mine, "c", "left_semi").select("_s").toArrow()["_s"].to_numpy().astype(np.int64)
            child[of(out), symbol[out >> 8 * (d - 1)]] = -1
        here = np.flatnonzero(depth == d)
        up = of(c[here])
        child[up, symbol[c[here] >> 8 * (d - 1)]] = here + 1
        logp[here + 1] = logp[up] + np.log10(w[here] / (m[here] + w[here]))[:, None]
        above, at = c[here], here + 1
        if not len(here):
            break
        rows = t.levels[d].join(held.where(F.col("d") == d).select("c"), "c", "left_semi").select("code", "p").toArrow()
        code = rows["code"].to_numpy().astype(np.int64)
        logp[at[np.searchsorted(above, code >> 8)], symbol[code & 255]] = np.log10(rows["p"].to_numpy())
    return SuffixTree(params.depth, symbol, child, logp), more


def looked_up(runs: DataFrame, t: Tables, params: TreeParams) -> DataFrame:
    """``runs`` (key: depth context symbols and the next; distinct) with p in the state of the longest retained suffix."""
    key = F.col("key")
    first = t.levels[0].select(F.col("code").alias("_code"), F.col("p").alias("_p"))
    out = runs.join(first, F.col("_code") == _low(key, 1), "left").select("key", F.coalesce("_p", F.lit(0.5 / (t.total + 128.0))).alias("p"))
    for d in range(1, params.depth + 1):
        back = t.states.where(F.col("d") == d).select(F.col("c").alias("_c"), (F.col("w") / (F.col("m") + F.col("w"))).alias("_back"))
        own = t.levels[d].select(F.col("code").alias("_code"), F.col("p").alias("_p"))
        out = out.join(back, F.col("_c") == _low(F.shiftright("key", 8), d), "left").join(own, F.col("_code") == _low(key, d + 1), "left")
        out = out.select("key", F.when(F.col("_back").isNull(), F.col("p")).otherwise(F.coalesce("_p", F.col("p") * F.col("_back"))).alias("p"))
    return out


def score(docs: DataFrame, may_learn: Column, params: TreeParams = TreeParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with n_tokens, n_known, train_tokens, base_score and score.

    Null and empty texts are the end mark alone; it counts as a token that
    every training text has, null and empty ones too. Without training texts
    the tree is its root and all words are unknown. Words are told apart by
    64-bit hashes. Repeated rows get a result each; columns of ``docs`` named
    like results are replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    names = [c for c in keep if c not in ("n_tokens", "n_known", "train_tokens", "base_score", "score")]
    training = docs.where(may_learn)
    stats = table(counted(training, params), "counts")
    ends = training.count()
    kinds = {r.kind: (r.n, r.v) for r in stats.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    words_n, vocabulary = kinds.get(0, (0, 0))
    tokens = words_n + ends
    vocabulary += 1 if ends else 0
    log_of = lambda c: F.log10((c + 0.5) / (tokens + 0.5 * (vocabulary + 1)))
    whole = lambda c: F.floor(c * SCALE + 0.5).cast("long")
    counts = stats.where("kind = 0").select("key", "n")
    often = counts.where(F.col("n") >= params.head_share * tokens).select("key", "n", whole(log_of(F.col("n"))).alias("l")).orderBy("key").toArrow()
    head = (often["key"].to_numpy().astype(np.int64), often["l"].to_numpy().astype(np.int64))
    end_log = int(np.floor(np.log10((ends + 0.5) / (tokens + 0.5 * (vocabulary + 1))) * SCALE + 0.5))
    known_runs = tables(stats.where("kind = 1"), kinds.get(1, (0, 0))[0], params)
    tree, more = planted(known_runs, params)
    held = spark.sparkContext.broadcast((tree, *head))
    at = len(names)
    schema = docs.select(*names).schema.add("n_tokens", "long").add("_known", "long").add("_base", "long").add("score", "double").add("_tail", T.ArrayType(T.LongType())).add("_runs", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, keys, logs = held.value
        for batch in batches:
            raw, offsets = bw.buffers(batch.column(at))
            parts = []
            for _, _, data, to in bw.chunks(raw, offsets):
                symbols, spots, starts, stops, before = spelled(data, to, tree.depth)
                n = len(to) - 1
                h = bw.word_hashes(bw.lower_table()[data], starts, stops).view(np.int64)
                doc = np.repeat(np.arange(n), np.diff(before))
                spot = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[spot] == h if len(keys) else np.zeros(len(h), bool)
                base = np.zeros(len(h) + 1, np.int64)
                np.cumsum(np.where(hit, logs[spot] if len(keys) else 0, 0), out=base[1:])
                known = np.bincount(doc[hit], minlength=n)
                parts.append((np.diff(before) + 1, known, base[before[1:]] - base[before[:-1]], np.bincount(doc[~hit], minlength=n), h[~hit], *tree.scored(symbols, spots)))
            size, known, base, tails, tail, logp, runs, codes = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 8
            lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(k)).astype(np.int32)), pa.array(v.astype(np.int64))) for k, v in ((tails, tail), (runs, codes))]
            arrays = [*batch.columns[:at], pa.array(size), pa.array(known), pa.array(base), pa.array(logp.astype(np.float64)), *lists]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    scored = table(docs.select(*names, "text").mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = counts.where(F.col("n") < params.head_share * tokens)
    tail = scored.select("_row", F.explode("_tail").alias("key")).join(rare, "key", "left")
    tail = tail.groupBy("_row").agg(F.sum(F.when(F.col("n").isNotNull(), 1).otherwise(0)).alias("_k"), F.sum(whole(log_of(F.coalesce("n", F.lit(0))))).alias("_b"))
    zero = F.lit(0).cast("long")
    out = scored.drop("_tail", "_runs").join(tail, "_row", "left")
    if more:
        runs = scored.select("_row", F.explode("_runs").alias("key"))
        values = looked_up(runs.select("key").distinct(), known_runs, params)
        out = out.join(runs.join(values, "key").groupBy("_row").agg(F.sum(whole(F.log10("p"))).alias("_l")), "_row", "left")
    else:
        out = out.withColumn("_l", zero)
    return out.select(
        *names,
        "n_tokens",
        (F.col("_known") + F.coalesce("_k", zero) + (1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        ((F.col("_base") + F.coalesce("_b", zero) + end_log) / F.lit(float(SCALE))).alias("base_score"),
        (F.col("score") + F.coalesce("_l", zero) / F.lit(float(SCALE))).alias("score"),
    )
