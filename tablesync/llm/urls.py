"""URL filters: rules first, and gradient-boosted trees on lexical features for the URLs no rule names.

Features are column expressions of the URL alone: lengths, depth, digit ratio, entropy, counts of parameters, and statistics of the
host's suffixes and of the first path segment. A statistic is kept for each of ``SLOTS`` hash slots (how often the slot occurs, and how often
a labelled URL of it is blocked), counted over all rows; the table of slots has a fixed size, which is what is broadcast. The trees are
fitted on a bounded sample of the labelled rows, second-order boosting of the logistic loss over quantile bins, and scored as CASE expressions.

Results for odd input: a NULL URL, or one without ``://``, has empty host and path and fits no rule; its features are those of an empty text (the
lengths of what is there otherwise). URLs of any length are read whole. With no labelled rows, or labels of one kind, there are no trees and the score is the labels'
share (0 with none, so URLs are allowed). Repeated URLs count as often as they stand there. Other columns are carried along untouched
inside a struct, so none can clash. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

__all__ = ["FEATURES", "Rule", "Trees", "UrlModel", "fit_trees", "host_and_path", "judge", "learn_urls", "matching_rule", "score_urls"]

SLOTS = 4096
MAX_RULES = 500  # they are one expression; a longer list belongs in a join on the host's suffixes
SAMPLE = 20_000  # labelled rows the trees are fitted on
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``block`` or ``allow`` for a host, its subdomains and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between the first ``://`` and the path, A-Z lower-cased, and the path up to query or fragment."""
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(there, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule], of: str = "text") -> Column:
    """The text (or ``verdict``) of the longest rule that fits, else NULL; the first in order of text where two are equally long."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, of))).otherwise(found)
    return found


# --- features ------------------------------------------------------------------------


def _entropy(text: Column) -> Column:
    """Bits a code point of a text; one scan of it for each code point it has."""
    size = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size > 0, -F.aggregate(shares, F.lit(0.0), lambda s, p: s + F.when(p > 0, p * F.log2(p)).otherwise(0.0))).otherwise(0.0)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


PLAIN = (
    "url_length", "host_length", "path_length", "depth", "labels", "longest_label", "digit_ratio", "host_digit_ratio", "host_hyphens",
    "parameters", "query_length", "host_entropy", "path_entropy",
)
SUFFIXES = ("tld", "domain", "head")  # the host's last label, its last two, the path's first segment
FEATURES = (*PLAIN, *[f"{s}_{kind}" for s in SUFFIXES for kind in ("common", "blocked")])


def _plain_features(df: DataFrame) -> DataFrame:
    """``url``, ``host`` and ``path`` to the plain features and the slots of the suffixes."""
    url, host, path = F.coalesce("url", F.lit("")), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    digits = lambda c: F.length(F.regexp_replace(c, "[^0-9]+", ""))
    made = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "depth": _count(path, "/"), "labels": F.size(labels),
        "longest_label": F.array_max(F.transform(labels, F.length)), "digit_ratio": _ratio(digits(url), F.length(url)),
        "host_digit_ratio": _ratio(digits(host), F.length(host)), "host_hyphens": _count(host, "-"),
        "parameters": F.when(query == "", 0).otherwise(_count(query, "&") + 1), "query_length": F.length(query),
        "host_entropy": _entropy(host), "path_entropy": _entropy(path),
    }
    suffixes = {
        "tld": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2),
        "head": F.regexp_extract(path, r"^/([^/]*)", 1),
    }
    slots = {f"{s}_slot": F.pmod(F.xxhash64(F.lit(s), c), F.lit(SLOTS)).cast("int") for s, c in suffixes.items()}
    return df.withColumns({**{k: v.cast("double") for k, v in made.items()}, **slots})


def _with_statistics(df: DataFrame, model_slots: DataFrame) -> DataFrame:
    for s in SUFFIXES:
        table = model_slots.where(F.col("suffix") == s).select(
            F.col("slot").alias(f"{s}_slot"), F.col("common").alias(f"{s}_common"), F.col("blocked").alias(f"{s}_blocked"))
        df = df.join(F.broadcast(table), f"{s}_slot", "left")  # SLOTS rows at most
    return df.fillna({f"{s}_{k}": v for s in SUFFIXES for k, v in (("common", 0.0), ("blocked", 0.5))}).drop(*[f"{s}_slot" for s in SUFFIXES])


# --- trees ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """``base`` plus a sum of trees. A tree is a leaf (a number) or (feature, threshold, tree up to it, tree above it)."""

    base: float
    trees: tuple = field(default=())

    def raw(self, rows: np.ndarray) -> np.ndarray:
        def walk(tree, held):
            if not isinstance(tree, tuple):
                return np.full(len(held), tree)
            f, threshold, low, high = tree
            out, left = np.empty(len(held)), held[:, f] <= threshold
            out[left], out[~left] = walk(low, held[left]), walk(high, held[~left])
            return out

        return self.base + sum((walk(t, rows) for t in self.trees), np.zeros(len(rows)))

    def column(self, names: Sequence[str] = FEATURES) -> Column:
        """The same sum over columns."""
        def case(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, threshold, low, high = tree
            return F.when(F.col(names[f]) <= F.lit(float(threshold)), case(low)).otherwise(case(high))

        total = F.lit(float(self.base))
        for tree in self.trees:
            total = total + case(tree)
        return total


def _best_split(binned: np.ndarray, rows: np.ndarray, grad: np.ndarray, hess: np.ndarray, bins: int, ridge: float, least: int):
    """(gain, feature, bin) of the best cut of the rows, a cut leaving ``least`` rows on each side; None where no cut gains."""
    best = None
    g, h = grad[rows].sum(), hess[rows].sum()
    for f in range(binned.shape[1]):
        at = binned[rows, f]
        sums = [np.cumsum(np.bincount(at, w, bins))[:-1] for w in (grad[rows], hess[rows], None)]
        gain = sums[0] ** 2 / (sums[1] + ridge) + (g - sums[0]) ** 2 / (h - sums[1] + ridge) - g ** 2 / (h + ridge)
        gain[(sums[2] < least) | (len(rows) - sums[2] < least)] = -np.inf
        b = int(np.argmax(gain))
        if gain[b] > 1e-9 and (best is None or gain[b] > best[0]):
            best = (float(gain[b]), f, b)
    return best


def fit_trees(rows: np.ndarray, labels: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 64, ridge: float = 1.0, least: int = 10) -> Trees:
    """Boosted trees for labels 0 and 1: each round fits a tree to gradient and curvature of the logistic loss."""
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        return Trees(-30.0 if share == 0.0 else 30.0)
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins)[1:-1], method="lower")) for f in range(rows.shape[1])]
    binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], axis=1)
    # a value equal to an edge lies in the bin that ends there, so "up to the edge" is "in bins up to its"
    base = float(np.log(share / (1 - share)))
    raw, trees = np.full(len(labels), base), []

    def grow(held: np.ndarray, left: int, grad: np.ndarray, hess: np.ndarray):
        split = _best_split(binned, held, grad, hess, bins, ridge, least) if left and len(held) >= 2 * least else None
        if split is None:
            value = float(-rate * grad[held].sum() / (hess[held].sum() + ridge))
            raw[held] += value
            return value
        _, f, b = split
        low = binned[held, f] <= b
        return f, float(edges[f][b]), grow(held[low], left - 1, grad, hess), grow(held[~low], left - 1, grad, hess)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-raw))
        trees.append(grow(np.arange(len(labels)), depth, p - labels, p * (1 - p)))
    return Trees(base, tuple(trees))


# --- the operator --------------------------------------------------------------------


@dataclass
class UrlModel:
    """Trees, and the table of slots (suffix, slot, common, blocked) their features read."""

    trees: Trees
    slots: DataFrame


def learn_urls(pages: DataFrame, sample: int = SAMPLE, smoothing: float = 8.0) -> UrlModel:
    """From rows of ``url`` and ``label`` (1 block, 0 allow, NULL unlabelled). Statistics are of all rows; the trees see ``sample`` labelled ones, chosen by hash."""
    hold = Scratch()
    host, path = host_and_path(F.col("url"))
    rows = pages.select("url", F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path"))
    slotted = _plain_features(rows)
    named = F.explode(F.array(*[F.struct(F.lit(s).alias("suffix"), F.col(f"{s}_slot").alias("slot")) for s in SUFFIXES])).alias("at")
    counted = slotted.select("label", named).groupBy("at.suffix", "at.slot").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0.0)).alias("blocked"))
    # slots without labels tell as little as half of them blocked
    slots = hold(counted.select(
        "suffix", "slot", F.log2(F.col("n") + 1.0).alias("common"), ((F.col("blocked") + smoothing / 2) / (F.col("labelled") + smoothing)).alias("blocked")), "slots").read()
    chosen = rows.where("label is not null").orderBy(F.xxhash64("url"), "url", "label").limit(sample)
    seen = _with_statistics(_plain_features(chosen), slots).select("label", *FEATURES).toPandas()  # sample rows of numbers at most
    seen = seen.sort_values(["label", *FEATURES])
    return UrlModel(fit_trees(seen[list(FEATURES)].to_numpy(float), seen["label"].to_numpy(float)), slots)


def score_urls(pages: DataFrame, model: UrlModel) -> DataFrame:
    """(row, host, path, score): score is how likely the URL is to be blocked; ``row`` holds the columns given, among them ``url``."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), "url").select("row", "url", host.alias("host"), path.alias("path"))
    known = _with_statistics(_plain_features(rows), model.slots)
    return known.select("row", "host", "path", (1 / (1 + F.exp(-model.trees.column()))).alias("score"))


def judge(pages: DataFrame, rules: Sequence[Rule], sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """(row, host, path, rule, verdict, score): the verdict of the longest rule that fits, else of trees trained on the URLs that rules label."""
    host, path = host_and_path(F.col("url"))
    said = matching_rule(host, path, rules, "verdict")
    model = learn_urls(pages.select("url", F.when(said.isNotNull(), (said == "block").cast("int")).alias("label")), sample)
    scored = score_urls(pages, model)
    learned = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    h, p = F.col("host"), F.col("path")
    return scored.select("row", "host", "path", matching_rule(h, p, rules).alias("rule"), F.coalesce(matching_rule(h, p, rules, "verdict"), learned).alias("verdict"), "score")
