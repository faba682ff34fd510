"""URL filters: rules for hosts and paths, and boosted trees for what no rule decides.

The trees see the letters of a URL only: lengths, depths, the share of digits, the
entropy of its characters, the number of parameters, and how often labelled URLs with the same
suffix (last label of the host, last two labels, ending of the path) are blocked.
Everything is DataFrame expressions: features, histograms of gradients, and the
trees themselves, which become CASE expressions.

Gradients are whole numbers (2^30 for 1), so that sums don't depend on their order.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEXICAL = ["url_length", "host_length", "host_depth", "path_depth", "digit_share", "entropy", "n_params"]
SUFFIXES = ["host_suffix", "domain_suffix", "path_suffix"]
FEATURES = LEXICAL + [f"{s}_rate" for s in SUFFIXES]
UNIT = 1 << 30
FOLDS = 5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as (rule, verdict), null if none fits. Ties: the longer host, then block."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block")):
        out = F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """``urls`` with LEXICAL and SUFFIXES; a null URL counts as empty."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    host, path = host_of(url), path_of(url)
    n = F.length(url)
    labels = F.split(host, r"\.", -1)
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    last = F.coalesce(F.try_element_at(segments, F.lit(-1)), F.lit(""))
    # sorted characters, whose runs are summed up: n log n for a text of any length
    begin = F.struct(F.lit("").alias("c"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    part = lambda run: F.when(run > 0, run * F.log2(run.cast("double"))).otherwise(0.0)
    runs = F.aggregate(F.array_sort(F.split(url, "", -1)), begin, lambda acc, c: F.when(c == "", acc).when(
        c == acc["c"], F.struct(acc["c"].alias("c"), (acc["run"] + 1).alias("run"), acc["sum"].alias("sum"))).otherwise(
        F.struct(c.alias("c"), F.lit(1).alias("run"), (acc["sum"] + part(acc["run"])).alias("sum"))),
        lambda acc: acc["sum"] + part(acc["run"]))
    return urls.withColumns({
        "url_length": n, "host_length": F.length(host), "host_depth": F.when(host == "", 0).otherwise(F.size(labels)), "path_depth": F.size(segments),
        "digit_share": F.when(n > 0, F.floor((n - F.length(F.translate(url, "0123456789", ""))) * 1000 / n)).otherwise(0).cast("int"),
        "entropy": F.when(n > 0, F.round(F.log2(n.cast("double")) - runs / n, 6)).otherwise(0.0),
        "n_params": F.size(F.filter(F.split(query, "&", -1), lambda s: s != "")),
        "host_suffix": F.element_at(labels, -1), "domain_suffix": F.regexp_extract(host, r"(?s)([^.]*\.?[^.]*)$", 1),
        "path_suffix": F.when(path.endswith("/"), "/").otherwise(F.regexp_extract(last, r"(?s)(\.[^.]*)$", 1)),
    })


@dataclass(frozen=True)
class Node:
    """A split (rows with feature <= cut go left) or, without a feature, a leaf."""
    value: float = 0.0
    feature: str | None = None
    bin: int = 0
    cut: float = 0.0
    left: Node | None = None
    right: Node | None = None

    def expression(self, of: str = "") -> Column:
        """``of`` 'bin': over the columns of bins, else over the features."""
        if self.feature is None:
            return F.lit(float(self.value))
        goes_left = F.col(f"{self.feature}_bin") <= self.bin if of == "bin" else F.col(self.feature) <= F.lit(self.cut)
        return F.when(goes_left, self.left.expression(of)).otherwise(self.right.expression(of))


@dataclass
class Model:
    """prior: share of blocked among the labels (null: none); rates: (kind, suffix, n, blocked), one row a suffix."""
    prior: float
    base: float
    rates: DataFrame
    trees: list[Node] = field(default_factory=list)
    smoothing: float = 10.0


def suffix_rates(labelled: DataFrame) -> DataFrame:
    """(kind, suffix, n, blocked, n_of, blocked_of): labelled rows of each suffix, all and by fold. Counted before they are shuffled."""
    kinds = F.explode(F.array(*[F.struct(F.lit(s).alias("kind"), F.col(s).alias("suffix")) for s in SUFFIXES])).alias("k")
    rows = labelled.select(kinds, "fold", "label")
    of = lambda what: F.array(*[F.sum(F.when(F.col("fold") == f, what).otherwise(0)) for f in range(FOLDS)])
    return rows.groupBy("k.kind", "k.suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("blocked"),
                                                  of(F.lit(1)).alias("n_of"), of(F.col("label")).alias("blocked_of"))


def with_rates(rows: DataFrame, model: Model, held: bool = False) -> DataFrame:
    """``rows`` with a smoothed rate of blocked for each suffix; ``held``: without the labels of the row's own fold.
    The rates have a row a suffix; Spark broadcasts them if they are small as measured, and splits hot suffixes of a shuffled join."""
    for s in SUFFIXES:
        rate = model.rates.where(F.col("kind") == s).select(F.col("suffix").alias(f"{s}_key"), F.struct("n", "blocked", "n_of", "blocked_of").alias(f"{s}_seen"))
        rows = rows.join(rate, rows[s] == rate[f"{s}_key"], "left")
        seen = F.col(f"{s}_seen")
        own = lambda name: F.coalesce(seen[name] - (F.get(seen[f"{name}_of"], F.col("fold")) if held else 0), F.lit(0))  # noqa: E731,B023
        rows = rows.withColumn(f"{s}_rate", F.round((own("blocked") + model.smoothing * model.prior) / (own("n") + model.smoothing), 6)).drop(f"{s}_key", f"{s}_seen")
    return rows


def _split(hist: dict[tuple[str, int], tuple[int, int]], cuts: dict[str, list[float]], least: float, ridge: float):
    """The split of largest gain as (gain, feature, bin, sums on its left), None without a gain; ties: first feature, first cut."""
    best = None
    worth = lambda g, h: (g / UNIT) ** 2 / (h / UNIT + ridge)
    for f in FEATURES:
        bins = sorted((b, *v) for (name, b), v in hist.items() if name == f)
        g_all, h_all = sum(b[1] for b in bins), sum(b[2] for b in bins)
        g, h = 0, 0
        for b, g_b, h_b in bins[:-1]:
            g, h = g + g_b, h + h_b
            gain = worth(g, h) + worth(g_all - g, h_all - h) - worth(g_all, h_all)
            if h >= least * UNIT and h_all - h >= least * UNIT and gain > 1e-6 and (best is None or gain > best[0] + 1e-9):
                best = (gain, f, b, (g, h))
    return best


def grow(rows: DataFrame, cuts: dict[str, list[float]], depth: int, rate: float, least: float, ridge: float) -> Node:
    """One tree on ``rows`` (<feature>_bin, g, h): level by level, from one histogram a level of at most
    2^depth nodes x features x bins rows."""
    splits: dict[int, tuple[str, int]] = {}
    totals: dict[int, tuple[int, int]] = {}
    level = [1]
    for d in range(depth):
        node = F.lit(1)
        for k in sorted(splits):  # parents come first
            f, b = splits[k]
            node = F.when(node == k, F.when(F.col(f"{f}_bin") <= b, 2 * k).otherwise(2 * k + 1)).otherwise(node)
        cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"{f}_bin").alias("b")) for f in FEATURES]))
        got = (rows.select(node.alias("node"), "g", "h", cells.alias("x")).where(F.col("node") >= 1 << d)
               .groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect())
        hists: dict[int, dict[tuple[str, int], tuple[int, int]]] = {}
        for r in got:
            hists.setdefault(r["node"], {})[r["f"], r["b"]] = (r["g"], r["h"])
        new = []
        for k in level:
            hist = hists[k]
            if k == 1:
                own = [v for (f, _), v in hist.items() if f == FEATURES[0]]
                totals[1] = (sum(v[0] for v in own), sum(v[1] for v in own))
            best = _split(hist, cuts, least, ridge)
            if best:
                splits[k], left = best[1:3], best[3]
                totals[2 * k], totals[2 * k + 1] = left, (totals[k][0] - left[0], totals[k][1] - left[1])
                new += [2 * k, 2 * k + 1]
        level = new
        if not level:
            break

    def built(k: int) -> Node:
        if k in splits:
            f, b = splits[k]
            return Node(feature=f, bin=b, cut=cuts[f][b], left=built(2 * k), right=built(2 * k + 1))
        g, h = totals[k]
        return Node(value=rate * (g / UNIT) / (h / UNIT + ridge))
    return built(1)


def train(labelled: DataFrame, max_labels: int = 50_000, n_trees: int = 12, depth: int = 3, n_bins: int = 16, rate: float = 0.3, least: float = 1.0,
          ridge: float = 1.0) -> Model:
    """Boosted trees for ``labelled`` (url, label: 1 to block, 0 to allow; rows with a null label are left out).

    Suffix rates count all labels. Trees are fitted on ``max_labels`` labels, the largest number
    expected of a choice by hash (all, if there are fewer), each with rates of the other folds. Cuts lie
    midway between quantiles: a suffix without labels has the rate of all and stays
    beside its nearest. Without labels, or with one kind of label, there are no trees and every
    URL scores the share of blocked labels (0 without labels).
    """
    rows = lexical(labelled.select("url", F.col("label").cast("int").alias("label")).where("label is not null"))
    rows = cut_lineage(rows.withColumn("fold", F.pmod(F.crc32(F.coalesce("url", F.lit(""))), F.lit(FOLDS)).cast("int")), "url-labels")
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = blocked / n if n else 0.0
    model = Model(prior, 0.0, cut_lineage(suffix_rates(rows), "url-suffixes"))
    if not 0 < blocked < n:
        return model
    if n > max_labels:
        rows = rows.where(F.pmod(F.xxhash64("url", F.lit("url-sample")), F.lit(1 << 30)) < int((1 << 30) * max_labels / n))
    rows = cut_lineage(with_rates(rows, model, held=True).select("label", *FEATURES), "url-sample")
    points = [k / n_bins for k in range(n_bins + 1)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), points, 10_000).alias(f) for f in FEATURES]).first()
    cuts = {f: [(a + b) / 2 for a, b in itertools.pairwise(sorted(set(found[f] or [])))] for f in FEATURES}
    bins = [sum(((F.col(f) > F.lit(float(c))).cast("int") for c in cuts[f]), F.lit(0)) for f in FEATURES]
    rows = rows.select("label", *[b.alias(f"{f}_bin") for b, f in zip(bins, FEATURES)]).groupBy("label", *[f"{f}_bin" for f in FEATURES]).agg(F.count(F.lit(1)).alias("n"))
    base = F.log(F.lit(prior / (1 - prior)))
    model.base = labelled.sparkSession.range(1).select(base).first()[0]
    rows = cut_lineage(rows.withColumn("margin", F.lit(model.base)), "url-margins")
    for _ in range(n_trees):
        p = 1 / (1 + F.exp(-F.col("margin")))
        whole = lambda x: F.round(x * UNIT).cast("long") * F.col("n")
        tree = grow(rows.withColumns({"g": whole(F.col("label") - p), "h": whole(p * (1 - p))}), cuts, depth, rate, least, ridge)
        if tree.feature is None:
            break
        model.trees.append(tree)
        rows = cut_lineage(rows.withColumn("margin", F.col("margin") + tree.expression("bin")), "url-margins")
    return model


def score(urls: DataFrame, model: Model) -> DataFrame:
    """``urls`` with ``score``: the probability (0 to 1) that the method blocks ``url``. One scan and the joins of the suffix rates."""
    if not model.trees:
        return urls.withColumn("score", F.lit(float(model.prior)))
    rows = with_rates(lexical(urls), model)
    margin = F.lit(float(model.base))
    for tree in model.trees:
        margin = margin + tree.expression()
    return rows.withColumn("score", 1 / (1 + F.exp(-margin))).drop(*LEXICAL, *SUFFIXES, *[f"{s}_rate" for s in SUFFIXES])


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", **training) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): each row's host and path, its longest fitting rule, and allow or block.

    Where no rule fits, the trees decide: block from a score of 0.5. They learn from
    ``labelled`` (url, label), by default the URLs of ``pages`` that a rule decides.
    A null URL, or one without ``://``, has empty host and path and goes to the trees.
    Repeated rows are judged alike, an empty table gives no rows, further columns are ignored.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).withColumn("ruled", rule_for(F.col("host"), F.col("path"), rules))
    if labelled is None:
        labelled = urls.where("ruled is not null").select("url", (F.col("ruled.verdict") == "block").cast("int").alias("label"))
    scored = score(urls, train(labelled, **training))
    return scored.select("page_id", "host", "path", "ruled.rule",
                         F.coalesce("ruled.verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
