"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text is
built. A text is parsed greedily into the longest phrases that occur in the
sample; the language whose sample explains it with the fewest phrases, each
weighed by the bits that a pointer into the sample costs, wins.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bytewords as bw
from tidemark.llm.common import map_append


@dataclass(frozen=True)
class LangIdParams:
    """Bounds of the training sample, which is made of whole texts, and of the parse.

    max_langs: labels that are learned, the most frequent. sample_docs: texts a
    language learns from at most. sample_letters: no further text is added once
    a language's texts have as many characters; with more than six languages
    all share six times as many. Texts longer than that are learned from only
    where a language has too few others, the shortest first, and never beyond
    ``longest`` times it. max_symbols: letters that have a symbol of their own;
    any other letter is spelled as several symbols. block: symbols of a text that
    are parsed side by side, which the result doesn't depend on; sync: symbols
    after which a block is first compared with its parse from another state.
    """

    max_langs: int = 200
    sample_docs: int = 96
    sample_letters: int = 40_000
    longest: int = 4
    max_symbols: int = 94
    block: int = 512
    sync: int = 64

    def budget(self, langs: int) -> int:
        """Characters for each language."""
        return max(1, min(self.sample_letters, 6 * self.sample_letters // max(langs, 1)))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings; state 0 starts."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new, at = len(step), last
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        while at >= 0 and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at >= 0:
            to = step[at][c]
            if length[at] + 1 == length[to]:
                link[new] = to
            else:
                copy = len(step)
                step.append(step[to].copy())
                link.append(link[to])
                length.append(length[at] + 1)
                link[to] = link[new] = copy
                while at >= 0 and step[at].get(c) == to:
                    step[at][c] = copy
                    at = link[at]
        last = new
    return step


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Boolean table of the code points that are letters."""
    return np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def lowered(c: int) -> int:
    low = chr(c).lower()
    return ord(low) if len(low) == 1 else c


class LanguageModel:
    """Parsing tables of all languages; its size is bounded by ``LangIdParams``."""

    def __init__(self, samples: dict[str, list[str]], params: LangIdParams):
        self.langs = sorted(samples)
        self.params = params
        found: Counter[int] = Counter()
        for texts in samples.values():
            for text in texts:
                found.update(lowered(ord(c)) for c in text if c.isalpha())
        own = sorted(found, key=lambda c: (-found[c], c))[: params.max_symbols]
        # 0: a run of other characters, 1: a spelled letter follows, the last: never in a text
        self.base = max(16, len(own))
        self.digits = math.ceil(math.log(sys.maxunicode + 1, self.base))
        self.width = self.base + 3
        symbol = {c: i + 2 for i, c in enumerate(own)}
        table = letters().astype(np.uint8)
        for c in np.flatnonzero(table).tolist():
            if s := symbol.get(lowered(c)):
                table[c] = s
        self.symbol_of = table
        #: Transitions of each automaton as arrays (state, symbol, next state).
        self.steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.states: list[int] = []
        bits = []
        for lang in self.langs:
            seq: list[int] = []
            for text in samples[lang]:
                points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
                sym, _ = self._stream(points, np.array([0, len(points)]))
                seq += [*sym.tolist(), self.width - 1]
                if len(seq) >= params.budget(len(self.langs)):
                    break
            trans = suffix_automaton(seq[:-1])
            size = [len(d) for d in trans]
            self.steps.append((np.repeat(np.arange(len(trans), dtype=np.int32), size), np.array([c for d in trans for c in d], np.uint8), np.array([to for d in trans for to in d.values()], np.int32)))
            self.states.append(len(trans))
            bits.append(np.log2(max(2, len(seq))))
        self.bits = np.array(bits)
        self._unfold()

    def _unfold(self) -> None:
        """Parsing table of all automata, one after another: next state, and whether a phrase begins."""
        tables, roots, base = [], [], 0
        for n, (at, c, to) in zip(self.states, self.steps, strict=True):
            t = np.full((n, self.width), -1, np.int64)
            t[at, c] = to
            root = np.where(t[0] < 0, 0, t[0])
            # nothing stays in the start, so its row can stand for "no phrase is open": any symbol opens one
            missing = t < 0
            missing[0] = True
            t = (np.where(missing, root, t) * self.width + base) * 2 + missing
            tables.append(t.astype(np.int32).ravel())
            roots.append(base)
            base += n * self.width
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int64)

    def __getstate__(self) -> dict:
        """What is sent to workers: the transitions, of which there are one or two a state, without the table."""
        return {k: v for k, v in self.__dict__.items() if k not in ("table", "roots")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._unfold()

    def _stream(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each text, runs of other characters as one, and their offsets."""
        sym = self.symbol_of[points]
        keep = sym != 0
        keep[1:] |= sym[:-1] != 0
        keep[offsets[:-1][np.diff(offsets) > 0]] = True
        size = keep.astype(np.int64)
        spelled = np.flatnonzero(sym == 1)
        size[spelled] = 1 + self.digits
        at = np.zeros(len(sym) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        if not len(spelled):
            return sym[keep], at[offsets]
        out = np.zeros(at[-1], np.uint8)
        out[at[:-1][keep]] = sym[keep]
        kinds, which = np.unique(points[spelled], return_inverse=True)
        code = np.array([lowered(c) for c in kinds.tolist()])[which]
        for k in range(self.digits):
            out[at[:-1][spelled] + k + 1] = code // self.base ** (self.digits - 1 - k) % self.base + 2
        return out, at[offsets]

    def _advance(self, state: np.ndarray, sym: np.ndarray, start: np.ndarray, length: np.ndarray, a: int, z: int) -> np.ndarray:
        """Parse symbols a to z of blocks, the longest first, from ``state``, which moves on; phrases opened in each."""
        count = np.zeros(state.shape, np.int32)
        active = len(length) - np.searchsorted(length[::-1], np.arange(a + 1, z + 1), "left")
        for j in range(a, z):
            k = active[j - a]
            if not k:
                break
            got = self.table[state[..., :k] + sym[start[:k] + j]]
            count[..., :k] += got & 1
            np.right_shift(got, 1, out=got)
            state[..., :k] = got
        return count

    def parse(self, sym: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Greedy phrases of each text by each language: array (languages, texts).

        Blocks of a text are parsed side by side as if each began a text, then
        again from the state that the block before really ends in, until no
        state changes. Parses soon agree whatever they began with, so little is
        done twice.
        """
        block, n = self.params.block, len(offsets) - 1
        parts = -(-np.diff(offsets) // block)
        doc = np.repeat(np.arange(n), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = offsets[doc] + nth * block
        length = np.minimum(block, offsets[doc + 1] - start)
        order = np.argsort(-length, kind="stable")
        start, length, doc, nth = start[order], length[order], doc[order], nth[order]
        if not len(order) or not self.langs:
            return np.zeros((len(self.langs), n))
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        # the block before each, by the order of lengths
        before = place[np.maximum(order - 1, 0)]
        later = np.zeros(len(order), np.int64)
        later[before[nth > 0]] = np.flatnonzero(nth > 0)
        goes_on = np.zeros(len(order), bool)
        goes_on[before[nth > 0]] = True

        most, sync = int(length[0]), min(self.params.sync, int(length[0]))
        entry = np.repeat(self.roots[:, None], len(order), 1).astype(np.int32)
        state = entry.astype(np.int64)
        early = self._advance(state, sym, start, length, 0, sync)
        middle = state.astype(np.int32)
        total = early + self._advance(state, sym, start, length, sync, most)
        leaves = state.astype(np.int32)
        lang, at = np.nonzero(np.broadcast_to(nth > 0, entry.shape))
        while len(at):
            new = leaves[lang, before[at]]
            changed = new != entry[lang, at]
            lang, at, new = lang[changed], at[changed], new[changed]
            entry[lang, at] = new
            by_length = np.argsort(at, kind="stable")
            lang, at, state = lang[by_length], at[by_length], new[by_length].astype(np.int64)
            count = self._advance(state, sym, start[at], length[at], 0, sync)
            same = state == middle[lang, at]
            total[lang, at] += count - early[lang, at]
            early[lang, at], middle[lang, at] = count, state
            lang, at, state = lang[~same], at[~same], state[~same]
            rest = self._advance(state, sym, start[at], length[at], sync, most)
            total[lang, at] = early[lang, at] + rest
            moved = (state != leaves[lang, at]) & goes_on[at]
            leaves[lang, at] = state
            lang, at = lang[moved], later[at[moved]]
        return np.stack([np.bincount(doc, c, n) for c in total])

    def predict(self, column: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
        """Language, score, bits per symbol of each text, and whether they explain it better than plain symbols."""
        raw, offsets = bw.buffers(column)
        name = np.full(len(column), len(self.langs), np.int64)
        score, bits, fits = np.zeros(len(column)), np.zeros(len(column)), np.zeros(len(column), bool)
        for a, b, data, at in bw.chunks(raw, offsets, 2 << 20):
            sym, to = self._stream(*bw.utf32(data, at))
            if not self.langs or not len(sym):
                continue
            cost = self.parse(sym, to) * self.bits[:, None]
            lettered = np.zeros(len(sym) + 1, np.int64)
            np.cumsum(sym != 0, out=lettered[1:])
            some = lettered[to[1:]] > lettered[to[:-1]]
            best = cost.argmin(0)
            least = cost.min(0)
            second = np.partition(cost, 1, 0)[1] if len(cost) > 1 else np.full(len(least), np.inf)
            name[a:b] = np.where(some, best, len(self.langs))
            score[a:b] = np.where(some, np.clip(1 - least / np.maximum(second, 1e-9), 0, 1), 0)
            size = np.diff(to)
            bits[a:b] = np.where(some, least / np.maximum(size, 1), 0)
            fits[a:b] = some & (least <= size * np.log2(self.params.max_symbols + 3) + 2 * self.bits.max())
        names = pa.array([*self.langs, "und"], pa.string())
        return names.take(pa.array(name)), pa.array(score), pa.array(bits), pa.array(fits)


def fit(docs: DataFrame, may_learn: Column, params: LangIdParams = LangIdParams()) -> LanguageModel:
    """Learn from a bounded sample of whole texts, drawn by a hash of id and text.

    Rows without a label, text or id teach nothing, equal rows count once.
    Labels are counted first, by an aggregation; then only rows below a
    language's hash threshold, about four times as many as it may learn from,
    are grouped, ranked and brought to the driver.
    """
    rows = docs.where(may_learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).withColumn("lang", F.col("lang").cast("string"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(params.max_langs).collect()}
    if not sizes:
        return LanguageModel({}, params)
    budget, whole = params.budget(len(sizes)), 1 << 40
    pick = {lang: min(whole, 4 * params.sample_docs * whole // n + 1) for lang, n in sizes.items()}
    below = F.create_map(*[F.lit(x) for kv in pick.items() for x in kv])
    size, h = F.length("text"), F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(whole))
    drawn = rows.where((size > 0) & (size <= params.longest * budget)).select("lang", h.alias("_h"), F.col("text").cast("string").alias("text")).where(F.col("_h") < F.element_at(below, F.col("lang")))
    drawn = drawn.groupBy("lang", "_h").agg(F.min("text").alias("text")).withColumn("_n", F.length("text"))
    order = Window.partitionBy("lang").orderBy(F.when(F.col("_n") > budget, F.col("_n")).otherwise(0), "_h")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = drawn.withColumns({"_r": F.row_number().over(order), "_before": before}).where((F.col("_r") <= params.sample_docs) & (F.col("_before") < budget))
    samples: dict[str, list[str]] = {}
    for r in sorted(chosen.select("lang", "_r", "text").collect(), key=lambda r: (r.lang, r["_r"])):
        samples.setdefault(r.lang, []).append(r.text)
    return LanguageModel(samples, params)


def identify(docs: DataFrame, model: LanguageModel, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``bits`` and ``explained`` to every row.

    Null, empty and letterless texts give ``und`` and 0. Score is
    1 - best / second best cost, so 0 means a tie, which the name first in
    order wins; bits is the best cost by symbol. A text is explained if that
    cost is at most that of two phrases and of all its symbols spelled one by
    one in an alphabet of ``max_symbols``: random letters are not. Repeated rows give repeated results. Existing
    columns of these four names are replaced.
    """
    at = docs.columns.index("text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType()), T.StructField("explained", T.BooleanType())]
    return map_append(docs, lambda batch: held.value.predict(batch.column(at)), fields, drop)
