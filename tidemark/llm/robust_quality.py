"""Quality rules: base counts and robust multivariate outliers.

Each text that passes the base rules becomes a vector of five logarithmic
ratios. Per language and source a minimum-covariance-determinant estimate is
sought: from several starts, concentration steps move to the nearest half of
the texts, the start whose half ends with the least determinant wins, and the
texts near it give the final estimate. Texts far from it by Mahalanobis
distance are rejected. Every step is one aggregation over (group, start,
distance bin) and small joins; vectors and weights are whole numbers, so all
sums are exact and do not depend on how rows are dealt out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, let, space_words, table

GRID = 256
DIMS = range(5)
PAIRS = [(i, j) for i in DIMS for j in range(i + 1)]
#: Weights are whole multiples of 1 / UNIT.
UNIT = 64


@dataclass(frozen=True)
class QualityParams:
    """min_words, max_repeat_pct: base rules.

    share: part of a group that the estimate is concentrated on; steps:
    concentration steps from each start; near: chance that a normal vector is
    near enough for the final estimate; prior: weight in texts of the
    language's estimate in a group's; floor: standard deviation added to each
    of the five ratios; scatter: a text of n words has (1 + scatter / n) times
    the covariance of its group, since the ratios of short texts scatter; tail:
    chance that a normal vector is rejected.
    """

    min_words: int = 20
    max_repeat_pct: int = 30
    share: float = 0.5
    steps: int = 4
    near: float = 0.975
    prior: int = 64
    floor: tuple[float, ...] = (0.1, 0.15, 0.15, 0.15, 0.15)
    scatter: int = 200
    tail: float = 1e-6


def chi2_cdf(x: float, k: int) -> float:
    """Distribution function of chi-square for odd k."""
    out = math.erf(math.sqrt(x / 2))
    for d in range(1, k, 2):
        out -= (x / 2) ** (d / 2) * math.exp(-x / 2) / math.gamma(d / 2 + 1)
    return out


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def _removed(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeated(words: Column, span: int = 8) -> Column:
    """Words inside windows of ``span`` words that occur twice or more; windows are compared by 64-bit hashes."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - span), lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(span))))

    def places(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(t: Column) -> Column:
            same = lambda k: F.coalesce(F.get(t, k)["h"], F.lit(None))
            hit = F.filter(t, lambda x, k: F.coalesce(same(k - 1) == x["h"], F.lit(False)) | F.coalesce(same(k + 1) == x["h"], F.lit(False)))
            return F.sort_array(F.transform(hit, lambda x: x["i"]))

        return let(tagged, twice)

    def total(p: Column) -> Column:
        gaps = F.transform(p, lambda x, k: F.least(F.lit(span), F.coalesce(F.get(p, k + 1) - x, F.lit(span))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    seek = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(places(h), total))
    return F.when(n <= span, F.lit(0)).otherwise(let(hashes, seek))


def statistics(docs: DataFrame, params: QualityParams, keep: list[str]) -> DataFrame:
    """Base counts, base_failed and, where it passes, the vector in steps of 1/256, of each row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(*keep, F.col("lang").alias("_lang"), F.col("source").alias("_source"), text.alias("_t"), space_words(F.col("text")).alias("_w"), lines.alias("_l"))
    d = d.select(
        *keep,
        F.coalesce(F.concat(F.lit("0"), "_lang"), F.lit("1")).alias("_lang"),
        F.coalesce(F.concat(F.lit("0"), "_source"), F.lit("1")).alias("_source"),
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        _removed(F.col("_t"), "[#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("_w")).cast("long").alias("n_repeat_words"),
        _removed(F.col("_t"), "[A-Z]+").cast("long").alias("_upper"),
        _removed(F.col("_t"), "[!?.,;:]+").cast("long").alias("_marks"),
    )
    failed = (F.col("n_words") < params.min_words) | (100 * F.col("n_repeat_words") > params.max_repeat_pct * F.col("n_words"))
    return d.withColumn("base_failed", failed).select("*", F.expr(weight_sql(params)).alias("_k"), *[F.expr(f"cast(floor({e} * {GRID} + 0.5) as bigint)").alias(f"_x{i}") for i, e in enumerate(RATIOS)])


#: The five ratios, in SQL that Spark and DuckDB share; texts without words give 0.
_N, _C = "greatest(n_words, 1)", "greatest(word_chars, 1)"
RATIOS = (
    f"ln({_C} / cast({_N} as double))",
    f"ln(1 + 20 * n_symbols / cast({_N} as double))",
    f"ln(1 + 20 * _upper / cast({_C} as double))",
    f"ln(1 + 5 * _marks / cast({_N} as double))",
    f"ln(1 + 5 * n_repeat_words / cast({_N} as double))",
)


def weight_sql(params: QualityParams) -> str:
    """Weight of a text, which is the inverse of its covariance's factor, in whole multiples of 1 / UNIT."""
    return f"cast(floor({UNIT} * n_words / cast(n_words + {params.scatter} as double) + 0.5) as bigint) + 1"


def start_sql(rows: str, quantile: str, each: str, params: QualityParams) -> str:
    """First models of each group: its medians, lower and upper quartiles, with median deviations per axis.

    Where less than half of a group is of another kind, one of the three points
    lies among the rest. ``each`` gives a row for each start.
    """
    mids = ", ".join(f"{quantile.format(f'_x{i}', q)} as {name}{i}" for i in DIMS for name, q in (("m", 0.5), ("a", 0.25), ("b", 0.75)))
    held = ", ".join(f"max(g.{name}{i}) as {name}{i}" for i in DIMS for name in "mab")
    devs = ", ".join(quantile.format(f"abs(r._x{i} - g.m{i})", 0.5) + f" as d{i}" for i in DIMS)
    chol = ", ".join(f"sqrt(d{i} * d{i} * {1.4826**2} + {(params.floor[i] * GRID) ** 2})" + f" as l{i}{j}" if i == j else f"cast(0 as double) as l{i}{j}" for i, j in PAIRS)
    points = ", ".join(f"case _s when 0 then m{i} when 1 then a{i} else b{i} end as m{i}" for i in DIMS)
    return f"""
    select _lang, _source, _s, {points}, {chol} from (select *, {each} as _s from (
      select r._lang, r._source, {held}, {devs}
      from {rows} r join (select _lang, _source, {mids} from {rows} where not base_failed group by _lang, _source) g
        on r._lang = g._lang and r._source = g._source
      where not r.base_failed group by r._lang, r._source) q) e"""


def distance_sql(rows: str, model: str, columns: str, how: str = "left") -> str:
    """Squared Mahalanobis distance of each row, by forward substitution with the Cholesky factor, times the row's weight."""
    out = f"select r.*, g._s, {', '.join(f'g.m{i}' for i in DIMS)}, {', '.join(f'g.l{i}{j}' for i, j in PAIRS)} from {rows} r {how} join {model} g on r._lang = g._lang and r._source = g._source"
    for i in DIMS:
        rest = "".join(f" - l{i}{j} * y{j}" for j in range(i))
        out = f"select q.*, (_x{i} - m{i}{rest}) / l{i}{i} as y{i} from ({out}) q"
    return f"select {columns}, ({' + '.join(f'y{i} * y{i}' for i in DIMS)}) * _k / {UNIT}.0 as _d2 from ({out}) q"


SUMS = ["n", "k", *[f"s{i}" for i in DIMS], *[f"s{i}{j}" for i, j in PAIRS]]


def moments_sql(near: str, keys: str) -> str:
    """Count, weight, and weighted sums and products of the vectors in ``near`` by ``keys``."""
    sums = ", ".join([f"sum(_k * _x{i}) as s{i}" for i in DIMS] + [f"sum(_k * _x{i} * _x{j}) as s{i}{j}" for i, j in PAIRS])
    return f"select {keys}, count(*) as n, sum(_k) as k, {sums} from ({near}) a group by {keys}"


def model_sql(group: str, scale: float, params: QualityParams) -> str:
    """Centres and Cholesky factors from moments by group and start, drawn towards those of the language."""
    total = ", ".join(f"cast(sum({s}) as double) as {s}" for s in SUMS)
    sized = f"select _lang, _s, {', '.join(f'sum({s}) as t{s}' for s in SUMS)} from groups group by _lang, _s"
    mean = ", ".join(f"s{i} / k as a{i}, l.ts{i} / l.tk as b{i}" for i in DIMS)
    p = params.prior
    cov = ", ".join(
        f"((s{i}{j} - a{i} * a{j} * k) / {UNIT} + {p} * (ts{i}{j} - b{i} * b{j} * tk) / (tn * {UNIT})) / (n + {p}) * {scale}" + (f" + {(params.floor[i] * GRID) ** 2}" if i == j else "") + f" as c{i}{j}" for i, j in PAIRS
    )
    centre = ", ".join(f"(n * a{i} + {p} * b{i}) / (n + {p}) as m{i}" for i in DIMS)
    out = f"select q.*, {centre}, {cov} from (select g.*, {', '.join(f't{s}' for s in SUMS)}, {mean} from groups g join langs l on g._lang = l._lang and g._s = l._s) q"
    for i, j in PAIRS:
        inner = f"c{i}{j}" + "".join(f" - l{i}{m} * l{j}{m}" for m in range(j))
        out = f"select q.*, {f'sqrt(greatest({inner}, 0.000001))' if i == j else f'({inner}) / l{j}{j}'} as l{i}{j} from ({out}) q"
    picked = ", ".join([f"m{i}" for i in DIMS] + [f"l{i}{j}" for i, j in PAIRS])
    return f"with groups as (select _lang, _source, _s, {total} from ({group}) c group by _lang, _source, _s), langs as ({sized}) select _lang, _source, _s, {picked} from ({out}) q"


def step_sql(rows: str, model: str, params: QualityParams) -> str:
    """One concentration step of each start: the model of the nearest ``share`` of each group."""
    near = distance_sql(f"(select * from {rows} where not base_failed)", model, f"_lang, _source, _s, _k, {', '.join(f'_x{i}' for i in DIMS)}", "inner")
    bins = moments_sql(f"select *, cast(floor(8 * ln(_d2 + 0.000001)) as bigint) as bin from ({near}) b", "_lang, _source, _s, bin")
    cut = f"select *, sum(n) over (partition by _lang, _source, _s order by bin) - n as before, sum(n) over (partition by _lang, _source, _s) as whole from ({bins}) d"
    scale = params.share / chi2_cdf(chi2_quantile(params.share, 5), 7)
    return model_sql(f"select * from ({cut}) f where before < {params.share} * whole", scale, params)


def best_sql(model: str) -> str:
    """Of each group the model of least determinant."""
    det = " * ".join(f"l{i}{i}" for i in DIMS)
    return f"select * from (select *, row_number() over (partition by _lang, _source order by {det}, _s) as place from {model}) w where place = 1"


def final_sql(rows: str, model: str, params: QualityParams) -> str:
    """Model of all texts near the best one."""
    near = distance_sql(f"(select * from {rows} where not base_failed)", model, f"_lang, _source, 0 as _s, _k, {', '.join(f'_x{i}' for i in DIMS)}", "inner")
    limit = chi2_quantile(params.near, 5)
    return model_sql(moments_sql(f"select * from ({near}) b where _d2 <= {limit}", "_lang, _source, _s"), params.near / chi2_cdf(limit, 7), params)


def cutoff(params: QualityParams) -> float:
    return chi2_quantile(1 - params.tail, 5)


def verdict_sql(params: QualityParams) -> str:
    return f"(not base_failed and coalesce(_d2 <= {cutoff(params)}, false))"


def judge(docs: DataFrame, params: QualityParams = QualityParams(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of each row with its counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words, so they fail. Null languages and
    sources form groups of their own. A group of one text, or of equal texts,
    keeps them: its spread is the floor and its language's. Repeated rows get a
    result each. Columns of ``docs`` named like results are replaced.
    """
    out = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    names = [c for c in keep if c not in out]
    spark = docs.sparkSession
    rows = table(statistics(docs, params, names), "quality-rows")
    model = table(spark.sql(start_sql("{rows}", "percentile({}, {})", "explode(array(0, 1, 2))", params), rows=rows), "quality-model")
    for k in range(params.steps + 2):
        text = step_sql("{rows}", "{model}", params) if k < params.steps else best_sql("{model}") if k == params.steps else final_sql("{rows}", "{model}", params)
        before, model = model, table(spark.sql(text, model=model, **({"rows": rows} if "{rows}" in text else {})), "quality-model")
        discard(before)
    columns = ", ".join([*names, *out[:-1]])
    return spark.sql(f"select {columns}, {verdict_sql(params)} as kept from ({distance_sql('{rows}', '{model}', columns)}) v", rows=rows, model=model)


def sql(params: QualityParams = QualityParams()) -> str:
    """DuckDB SQL of :func:`judge` on ``documents``."""
    ratios = ", ".join(f"floor({e} * {GRID} + 0.5)::bigint as _x{i}" for i, e in enumerate(RATIOS))
    steps = "".join(f", model{k + 1} as ({step_sql('rows', f'model{k}', params)})" for k in range(params.steps))
    steps += f", best as ({best_sql(f'model{params.steps}')}), final as ({final_sql('rows', 'best', params)})"
    return rf"""
with raw as (select row_number() over () as id, doc_id, coalesce('0' || lang, '1') as _lang, coalesce('0' || source, '1') as _source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from documents),
win as (select id, i, array_to_string(w[i:i + 7], ' ') as g from (select id, w, unnest(range(1, len(w) - 6)) as i from raw where len(w) >= 8)),
twice as (select id, i, count(*) over (partition by id, g) as n from win),
rep as (select id, count(distinct j) as n from (select id, unnest(range(i, i + 8)) as j from twice where n > 1) group by id),
base as (select raw.id, doc_id, _lang, _source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as _upper, length(t) - length(regexp_replace(t, '[!?.,;:]', '', 'g')) as _marks from raw left join rep using (id)),
rows as (select *, n_words < {params.min_words} or 100 * n_repeat_words > {params.max_repeat_pct} * n_words as base_failed, {weight_sql(params)} as _k, {ratios} from base),
model0 as ({start_sql("rows", "quantile_cont({}, {})", "unnest([0, 1, 2])", params)}){steps}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, {verdict_sql(params)} as kept
from ({distance_sql("rows", "final", "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed")}) v"""
