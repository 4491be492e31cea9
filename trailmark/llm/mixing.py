"""Mixing sources to target weights by soft membership (DataFrame expressions only).

1. The domains are the classes of a labelled table.  A naive Bayes classifier over the presence of
   words is fitted on a bounded sample of labelled rows (``TRAIN_ROWS``, drawn by a hash of the id).
   The ``VOCABULARY`` words whose presence differs most between the domains (chi-squared) carry
   weights, as literals of the plan; one part of the sample calibrates scale and bias.
2. Every whole text gets posteriors: a document belongs to all domains by share.
3. Projected gradient least squares finds a rate for every document, not below zero, so
   that the expected tokens of each domain (tokens x posterior x rate, summed) match the target
   weights.  In the metric weighted by tokens the gradient of a rate is its posteriors times one
   number per domain.  An iteration is one small aggregate that tries projected steps of several
   sizes: the step of one over the Lipschitz constant, which always lowers the squared misfit,
   larger ones, and those scaled by the curvature over the rates above zero.  The one with the
   least misfit is taken.  The fit ends when the targets are met, or when the projected gradient
   is small beside the misfit: then they cannot be met, the rates are the least squares and
   a warning names the totals.  A fit that does neither in ``MAX_STEPS`` steps raises.
   Steps are part of the next plan; rates are written every ``STORE_EVERY`` steps.
4. A document is taken ``floor(rate)`` times, and once more if a hash of its id falls below
   the rest, which keeps the expected totals.

Defined cases: null and empty texts have no tokens and the prior as posteriors; without
labelled rows the posteriors are equal; a domain without any tokens cannot be
matched and is left out of the fit; repeated rows get equal rates; null ids draw like any
other value; an empty table gives no rows; extra columns are carried by
``mixed_documents``, whatever their names (own columns start with ``__mix_``).
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Target shares of expected tokens: domain -> weight.
TARGETS = {"high": 0.80, "low": 0.12, "toxic": 0.08}
#: Labelled rows the classifier is fitted on at most, words that carry weights at most, their least
#: chi-squared, and slots of the table that finds them.
TRAIN_ROWS = 20_000
VOCABULARY = 1_024
MIN_CHI2 = 16.0
SLOTS = 16_384
#: Steps of the calibration and of the fit, steps between stored rates, misfit to stop at, and
#: projected gradient to stop at as a share of the misfit.
CALIBRATION_STEPS = 2_000
MAX_STEPS, STORE_EVERY, TOLERANCE, STATIONARY = 256, 8, 1e-5, 1e-4
#: Sizes tried, in steps of one over the Lipschitz constant and of the curvature above zero.
GRADIENT_SIZES, CURVATURE_SIZES = [4.0**k for k in range(10)], [1.0, 0.5, 0.25]
_SMOOTH = 0.5
_GRID = 1 << 40


def _hashed_words(text: Column) -> Column:
    """The hash of every word of a text, repeats included."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _literal(values: list, kind: str) -> Column:
    """A constant array, written as text and folded once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, quality, toxic`` -> doc_id, domain."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").when(F.col("quality") == 0, "low")
    return labels.select("doc_id", domain.alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL")


class Classifier:
    """Word weights per domain, and the calibrated scale and biases of their sums."""

    def __init__(self, domains: list[str], words: list[int], weights: list[list[float]]):
        self.domains, self.scale, self.bias = domains, 1.0, [0.0] * len(domains)
        # place 1 stands for "no such word"; a slot leads to one word, the strongest first
        self.words, self.weights, self.slots = [0], [[0.0] * len(domains)], [1] * SLOTS
        for h, w in zip(words, weights, strict=True):
            if self.slots[h % SLOTS] == 1:
                self.words.append(h)
                self.weights.append(w)
                self.slots[h % SLOTS] = len(self.words)

    def places(self, hashed: Column) -> Column:
        """The distinct places of a text's known words."""
        slots, words = _literal(self.slots, "int"), _literal(self.words, "bigint")

        def place(h: Column) -> Column:
            return F.element_at(slots, (F.pmod(h, F.lit(SLOTS)) + 1).cast("int"))

        return F.array_distinct(F.transform(F.filter(hashed, lambda h: F.element_at(words, place(h)) == h), place))

    def sums(self, places: Column) -> list[Column]:
        """Per domain the weights of the words present, over the root of their number."""
        out = []
        for k in range(len(self.domains)):
            held = _literal([round(w[k], 5) for w in self.weights], "double")
            total = F.aggregate(places, F.lit(0.0), lambda acc, i: acc + F.element_at(held, i))  # noqa: B023
            out.append(total / F.sqrt(F.size(places) + F.lit(1.0)))
        return out

    def calibrate(self, sums: np.ndarray, domain: np.ndarray) -> None:
        """Scale and biases by gradient descent on the log loss."""
        n = len(self.domains)
        truth = np.eye(n)[domain]
        scale, bias = 0.5, np.log((truth.sum(axis=0) + 1) / (len(truth) + n))
        size = max(float((sums**2).mean()), 1e-9) if len(sums) else 1.0
        for _ in range(CALIBRATION_STEPS if len(sums) else 0):
            z = sums * scale + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            wrong = p / p.sum(axis=1, keepdims=True) - truth
            scale = max(0.0, scale - float((wrong * sums).sum()) / len(sums) / size)
            bias = bias - wrong.mean(axis=0)
        self.scale, self.bias = float(scale), [float(b) for b in bias]


def _chi_squared(present: list[Column], sizes: list[int]) -> Column:
    """Of a word's presence against the domains (2 rows, a column per domain)."""
    everything, total = sum(sizes), sum(present[1:], present[0])
    out = F.lit(0.0)
    for n_k, n in zip(present, sizes, strict=True):
        if n:
            there, absent = total * n / everything, (everything - total) * n / everything
            out = out + (n_k - there) ** 2 / there + F.when(absent > 0, (n_k - there) ** 2 / absent).otherwise(0.0)
    return out


def fit_classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], train_rows: int = TRAIN_ROWS) -> Classifier:
    """Naive Bayes over word presence; ``labelled`` is ``doc_id, domain``."""
    draw = F.xxhash64("doc_id")
    picked = labelled.filter(F.col("domain").isin(domains)).dropDuplicates(["doc_id"]).orderBy(draw, "doc_id").limit(train_rows)
    # at most TRAIN_ROWS rows of two short columns
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "domain", (F.pmod(draw, F.lit(3)) == 0).alias("held"), _hashed_words(F.col("text")).alias("words"))
    train = sample.filter("NOT held")
    there = {r["domain"]: r["n"] for r in train.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = [there.get(d, 0) for d in domains]
    if not sum(sizes):
        return Classifier(domains, [], [])
    present = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)) for d in domains]
    counted = train.select("domain", F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(
        *[p.alias(f"n{k}") for k, p in enumerate(present)])
    chosen = counted.withColumn("chi2", _chi_squared([F.col(f"n{k}") for k in range(len(domains))], sizes)).filter(
        F.col("chi2") >= MIN_CHI2).orderBy(F.desc("chi2"), "word").limit(VOCABULARY).collect()
    weights = []
    for r in chosen:
        logs = [math.log((r[f"n{k}"] + _SMOOTH) / (n + 2 * _SMOOTH)) for k, n in enumerate(sizes)]
        weights.append([x - sum(logs) / len(logs) for x in logs])
    out = Classifier(domains, [r["word"] for r in chosen], weights)
    held = sample.filter("held").select("domain", out.places(F.col("words")).alias("places")).select(
        "domain", *[c.alias(f"s{k}") for k, c in enumerate(out.sums(F.col("places")))]).collect()  # a third of TRAIN_ROWS
    out.calibrate(np.array([[r[f"s{k}"] for k in range(len(domains))] for r in held]).reshape(len(held), len(domains)),
                  np.array([domains.index(r["domain"]) for r in held], int))
    return out


def with_posteriors(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """Adds ``__mix_tokens`` and ``__mix_p`` (posteriors in the order of the domains)."""
    hashed = docs.withColumn("__mix_w", _hashed_words(F.col("text")))
    placed = hashed.withColumn("__mix_places", classifier.places(F.col("__mix_w"))).withColumn(
        "__mix_tokens", F.size("__mix_w").cast("long")).drop("__mix_w")
    sums = classifier.sums(F.col("__mix_places"))
    scored = placed.withColumn("__mix_s", F.array(*[
        s * F.lit(classifier.scale) + F.lit(b) for s, b in zip(sums, classifier.bias, strict=True)])).drop("__mix_places")
    top = F.array_max("__mix_s")
    raised = scored.withColumn("__mix_e", F.transform("__mix_s", lambda s: F.exp(s - top))).drop("__mix_s")
    total = F.aggregate("__mix_e", F.lit(0.0), lambda acc, e: acc + e)
    return raised.withColumn("__mix_p", F.transform("__mix_e", lambda e: e / total)).drop("__mix_e")


def _step(rate: Column, change: list) -> Column:
    """One projected gradient step of a rate."""
    total = F.lit(0.0)
    for k, c in enumerate(change):
        total = total + F.col("__mix_p")[k] * (c if isinstance(c, Column) else F.lit(c))
    return F.greatest(F.lit(0.0), rate - total)


def fit_steps(rows: DataFrame, targets: dict[str, float], domains: list[str]) -> tuple[list[list[float]], list[float]]:
    """``rows`` with tokens and posteriors -> every step (a number per domain), and the totals reached."""
    rows = rows.select("__mix_tokens", "__mix_p")
    n = len(domains)

    def measure(df: DataFrame, rate: Column, changes: list[list[float]]) -> list[tuple[np.ndarray, np.ndarray, float]]:
        """After each change: the totals, the curvature over the rates above zero, and the squared way of the rates."""
        held = F.array(*[F.array(*[F.lit(c) for c in change]) for change in changes])
        tried = df.select("*", rate.alias("__mix_r")).select("*", F.posexplode(held).alias("__mix_nth", "__mix_change"))
        moved = tried.withColumn("__mix_next", _step(F.col("__mix_r"), [F.col("__mix_change")[k] for k in range(n)]))
        p = [F.col("__mix_p")[k] for k in range(n)]
        above = F.when(F.col("__mix_next") > 0, F.col("__mix_tokens")).otherwise(0)
        sums = [F.sum(F.col("__mix_tokens") * p[k] * F.col("__mix_next")) for k in range(n)]
        sums += [F.sum(above * p[k] * p[j]) for k in range(n) for j in range(n)]
        sums.append(F.sum(F.col("__mix_tokens") * (F.col("__mix_r") - F.col("__mix_next")) ** 2))
        found = {r[0]: np.array([float(x or 0.0) for x in r[1:]]) for r in moved.groupBy("__mix_nth").agg(*sums).collect()}
        got = [found.get(i, np.zeros(n + n * n + 1)) for i in range(len(changes))]
        return [(x[:n], x[n:-1].reshape(n, n), float(x[-1])) for x in got]

    now, curvature, _ = measure(rows, F.lit(1.0), [[0.0] * n])[0]
    everything, wanted = now.sum(), sum(targets.values())
    goal = np.array([everything * targets[d] / wanted for d in domains])
    reachable = now > 0

    def misfit_of(totals: np.ndarray) -> np.ndarray:
        return np.where(reachable, totals - goal, 0.0)

    lipschitz = float(np.linalg.eigvalsh(curvature)[-1])  # all rates are above zero here
    steps: list[list[float]] = []
    rate = F.lit(1.0)
    while (abs(misfit := misfit_of(now)) > TOLERANCE * everything).any():
        changes = [misfit / lipschitz * s for s in GRADIENT_SIZES]
        changes += [np.linalg.lstsq(curvature, misfit, rcond=1e-9)[0] * s for s in CURVATURE_SIZES]
        changes = [[float(c) for c in change] for change in changes]
        tried = measure(rows, rate, changes)
        size = float((misfit**2).sum())
        # the first change is the projected gradient over the Lipschitz constant
        gradient = lipschitz * math.sqrt(tried[0][2])
        if gradient <= STATIONARY * math.sqrt(everything * size):
            break
        after = [float((misfit_of(totals) ** 2).sum()) for totals, _, _ in tried]
        best = int(np.argmin(after))
        if len(steps) == MAX_STEPS or after[best] >= size:
            raise RuntimeError(f"no fit after {len(steps)} steps: {_shares(now, domains)} of the tokens, "
                               f"wanted {_shares(goal, domains)}, projected gradient {gradient / math.sqrt(everything * size):.2g}")
        steps.append(changes[best])
        rate = _step(rate, steps[-1])
        if len(steps) % STORE_EVERY == 0:
            rows = stored(rows.select("__mix_tokens", "__mix_p", rate.alias("__mix_rate")), "rates")
            rate = F.col("__mix_rate")
        now, curvature, _ = tried[best]
    if (abs(now - goal) > TOLERANCE * everything).any():
        warnings.warn(f"targets out of reach: {_shares(now, domains)} of the tokens, wanted {_shares(goal, domains)}", stacklevel=2)
    return steps, now.tolist()


def _shares(totals: np.ndarray, domains: list[str]) -> str:
    return ", ".join(f"{d} {float(x):.6g}" for d, x in zip(domains, totals, strict=True))


def rate_after(steps: list[list[float]]) -> Column:
    """The rate of a row after all steps, from its posteriors."""
    if not steps:
        return F.lit(1.0)
    held = F.array(*[F.array(*[F.lit(c) for c in change]) for change in steps])

    def one(rate: Column, change: Column) -> Column:
        total = F.lit(0.0)
        for k in range(len(steps[0])):
            total = total + F.col("__mix_p")[k] * change[k]
        return F.greatest(F.lit(0.0), rate - total)

    return F.aggregate(held, F.lit(1.0), one)


def copies_of(rate: Column, key: Column) -> Column:
    draw = F.pmod(F.xxhash64(F.lit("copies"), key), F.lit(_GRID)) / F.lit(float(_GRID))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")


def fitted_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None,
                 carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns ``carry`` of every row with ``__mix_tokens``, ``__mix_p``, ``__mix_rate`` and ``__mix_copies``."""
    targets = TARGETS if targets is None else targets
    domains = sorted(targets)
    classifier = fit_classifier(docs, labelled, domains)
    rows = with_posteriors(docs, classifier)
    if "text" not in carry:
        rows = rows.select(*carry, "__mix_tokens", "__mix_p")
    rows = stored(rows, "posteriors")
    steps, _ = fit_steps(rows, targets, domains)
    out = rows.withColumn("__mix_rate", rate_after(steps))
    return out.withColumn("__mix_copies", copies_of(F.col("__mix_rate"), F.col("doc_id")))


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says."""
    rows = fitted_rates(docs, labelled, targets, tuple(docs.columns))
    return rows.filter("__mix_copies > 0").select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))).alias("__mix_nth")).drop("__mix_nth")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = fitted_rates(docs, domain_of_labels(table(spark, sf_dir, "labels")))
    posteriors = [F.col("__mix_p")[k].alias(f"p_{d}") for k, d in enumerate(sorted(TARGETS))]
    return rows.select("doc_id", F.col("__mix_tokens").alias("tokens"), *posteriors,
                       F.col("__mix_rate").alias("rate"), F.col("__mix_copies").alias("copies"))
