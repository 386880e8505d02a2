"""URL filter: rules on host and path first, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, let, table


@dataclass(frozen=True)
class UrlParams:
    """lengths: of the n-grams; buckets: that they are hashed in, which bounds
    the model; rounds, rate: of gradient descent over all labelled URLs, with
    steps that shrink by the root of a bucket's squared gradients so far;
    most_labels: URLs that are learned from, those of least hash; chained,
    broadcast_rules: see :func:`judge`.
    """

    lengths: tuple[int, ...] = (3, 4, 5)
    buckets: int = 8192
    rounds: int = 15
    rate: float = 1.0
    most_labels: int = 100_000
    chained: int = 100
    broadcast_rules: int = 100_000


#: (verdict, host, path) of each rule.
RULES = (("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/"))

# Words that labelled hosts are made of.
BLOCKED = "casino poker betting bets slots jackpot pills viagra pharmacy adult porn xxx escort spam farm ads track tracker clickbait loans payday replica warez torrent".split()
SYLLABLES = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le".split()
ALLOWED = "library museum school university garden weather news science history music cooking travel health sports forum wiki recipes theatre village hospital gallery archive journal council station weaving orchard harbor mountain river translation teacher thread other within there another nation relation".split()


def labelled(spark: SparkSession) -> DataFrame:
    """The small labelled table, built by rule: url, label (1: block), word; three URLs a word, and names of common syllables.

    No host occurs twice. ``word`` is what a host is about: hosts of a word are
    held out together, so that a model is judged on words it hasn't seen.
    """
    forms = ("https://www.{0}.example.com/en/12", "http://{0}-{1}.example.net/de/{1}/345?page=2", "http://m.{1}{0}.example.org/fr/67.html")
    rows = []
    for words, label, extra in ((BLOCKED, 1, ("win", "free", "best", "cheap", "x")), (ALLOWED, 0, ("blog", "city", "open", "our", "old"))):
        for i, w in enumerate(words):
            rows += [(f.format(w, extra[(i + k) % len(extra)]), label, w) for k, f in enumerate(forms)]
    names = [a + SYLLABLES[(i + 7 * k) % len(SYLLABLES)] + SYLLABLES[(i * k + 3) % len(SYLLABLES)] for k in (1, 2, 3, 4) for i, a in enumerate(SYLLABLES)]
    rows += [(forms[i % 3].format(name, "blog"), 0, name) for i, name in enumerate(names)]
    return spark.createDataFrame(rows, "url string, label int, word string")


def held_out(labels: DataFrame, params: UrlParams | None = None, folds: int = 4) -> DataFrame:
    """(label, n, right): how many URLs of each label a model judges rightly that learned from other words, fold by fold."""
    params = params or UrlParams()
    fold = F.pmod(F.xxhash64("word", F.lit(17)), F.lit(folds))
    out = None
    for k in range(folds):
        model = train(labels.where(fold != k), params)
        p = logit(features(host_of(F.col("url")), path_of(F.col("url")), params), *model)
        part = labels.where(fold == k).select("label", ((p >= 0).cast("int") == F.col("label")).alias("right"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("right").alias("right"))


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def features(host: Column, path: Column, params: UrlParams) -> Column:
    """Buckets of the n-grams of host and path, apart from each other."""

    def grams(text: Column, tag: str, n: int) -> Column:
        def cut(chars: Column) -> Column:
            gram = lambda i: F.pmod(F.crc32(F.concat(F.lit(tag), F.array_join(F.slice(chars, i, F.lit(n)), "")).cast("binary")), F.lit(params.buckets))
            return F.transform(F.sequence(F.lit(1), F.size(chars) - n + 1), gram)

        short = (F.length(text) + 2 < n) | (text == "")
        marked = F.concat(F.lit("^"), text, F.lit("$"))
        return F.when(short, F.array().cast("array<bigint>")).otherwise(let(F.split(marked, ""), cut))

    return F.concat(*[grams(c, tag, n) for c, tag in ((host, "h"), (path, "p")) for n in params.lengths])


def logit(buckets: Column, weights: list[float], bias: float) -> Column:
    """Value of the model; n-grams are scaled so that long URLs weigh no more than short ones."""
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to a constant; one literal for all
    total = F.aggregate(buckets, F.lit(0.0), lambda a, f: a + F.get(w, f.cast("int")))
    return total / F.sqrt(F.greatest(F.size(buckets), F.lit(1)).cast("double")) + F.lit(bias)


def train(labels: DataFrame, params: UrlParams = UrlParams()) -> tuple[list[float], float]:
    """Weights by bucket and bias, by gradient descent; each round is one aggregation by bucket.

    Gradients are summed as whole numbers, so every run gives the same model.
    An empty table gives zeros.
    """
    x = features(host_of(F.col("url")), path_of(F.col("url")), params)
    known = labels.where(F.col("label").isNotNull()).select("url", "label").orderBy(F.xxhash64("url", F.lit(23)), "url").limit(params.most_labels)
    rows = table(known.select("label", x.alias("x")), "url-labels")
    n = max(1, rows.count())
    weights, bias, unit = [0.0] * params.buckets, 0.0, 2.0**40
    squares: dict[int, float] = {}
    for _ in range(params.rounds):
        error = 1 / (1 + F.exp(-logit(F.col("x"), weights, bias))) - F.col("label")
        step = rows.select("x", error.alias("e"), (error / F.sqrt(F.greatest(F.size("x"), F.lit(1)).cast("double"))).alias("g"))
        whole = lambda c: F.sum(F.floor(F.col(c) * unit).cast("long"))
        per = step.select(F.explode("x").alias("f"), "g").groupBy("f").agg(whole("g").alias("s")).union(step.select(F.lit(-1).cast("long").alias("f"), "e").groupBy("f").agg(whole("e")))
        gradient = {r.f: r.s / unit / n for r in sorted(per.collect(), key=lambda r: r.f)}
        for f, g in gradient.items():
            squares[f] = squares.get(f, 0.0) + g * g
        change = {f: params.rate * g / (squares[f] ** 0.5 + 1e-12) for f, g in gradient.items()}
        bias -= change.pop(-1, 0.0)
        for f, c in change.items():
            weights[f] -= c
    return weights, bias


def _by_chain(rows: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Add ``rule`` and ``_v`` by one condition a rule."""
    rule = verdict = None
    for says, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    none = F.lit(None).cast("string")
    return rows.withColumns({"rule": none if rule is None else rule, "_v": none if verdict is None else verdict})


def _by_join(rows: DataFrame, rules: DataFrame, few: int) -> DataFrame:
    """Add ``rule`` and ``_v`` by a join of each host and its parent domains with the rules' hosts."""
    rows = table(rows.withColumn("_row", F.monotonically_increasing_id()), "url-rows")
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    held = rules.select(F.col("host").alias("_of"), F.col("path").alias("_begin"), F.col("verdict").alias("_says"), F.col("place").alias("_place"))
    held = F.broadcast(held) if rules.count() <= few else held
    spread = rows.select("_row", F.col("path"), F.explode(parents).alias("_of")).where("_of <> ''")
    fits = spread.join(held, "_of").where(F.expr("startswith(path, _begin)"))
    text = F.concat("_of", "_begin")
    best = fits.groupBy("_row").agg(F.max_by(F.struct(text.alias("rule"), F.col("_says").alias("_v")), F.struct(F.length(text), -F.col("_place"))).alias("_b"))
    return rows.join(best, "_row", "left").select(*[c for c in rows.columns if c != "_row"], "_b.rule", "_b._v")


def judge(pages: DataFrame, model: tuple[list[float], float], rules: Sequence[tuple[str, str, str]] = RULES, params: UrlParams = UrlParams(), keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Columns ``keep`` of each row with host, path, rule, verdict and p_block.

    The longest rule whose host is the URL's or a parent domain and whose path
    begins the URL's decides; equally long ones in the order given. Otherwise
    the model blocks at a chance of one half. A null URL, or one without
    ``://``, has neither host nor path and is judged by the bias alone.
    Repeated rows get a result each. Up to ``chained`` rules are tried one by
    one, more are joined, by broadcast up to ``broadcast_rules`` of them.
    """
    names = [c for c in keep if c not in ("host", "path", "rule", "verdict", "p_block")]
    rows = pages.select(*names, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    if len(rules) <= params.chained:
        rows = _by_chain(rows, rules)
    else:
        made = rows.sparkSession.createDataFrame([(*r, i) for i, r in enumerate(rules)], "verdict string, host string, path string, place long")
        rows = _by_join(rows, made, params.broadcast_rules)
    rows = rows.withColumn("p_block", 1 / (1 + F.exp(-logit(features(F.col("host"), F.col("path"), params), *model))))
    return rows.select(*names, "host", "path", "rule", F.coalesce("_v", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")).alias("verdict"), "p_block")
