"""Mixing to target weights with soft membership.

A classifier fitted on a labelled table gives every document its domain posteriors p_d. With t_d
tokens, a document used at rate r_d adds r_d * t_d * p_d expected tokens to the domains. Rates are
fitted by projected-gradient least squares: r >= 0 minimises the squared relative distance of the
expected domain totals from the target totals. Rates start at the uniform rate, so among the many
solutions the one found stays close to it.

Texts are read once: tokens and posteriors are written beside the documents. Steps are measured in
the metric in which document i weighs t_i * (p_i . c), with c_d = S_d * w_d ** 2 for the tokens S_d
that domain d has and its weight w_d in the error. Projection onto r >= 0 stays a cut at zero, and by
Cauchy's inequality sum_i t_i (w p_i)(w p_i)' / (p_i . c) <= 1, so a step of length one never raises
the error. In this metric the gradient of document i hangs on p_i alone: documents with equal
posteriors have equal rates all along. They are one cell of the fit, with the sum of their tokens.
Posteriors have four decimals, so cells are far fewer than documents. Steps have momentum, which
starts anew where it points uphill.

An iteration is one aggregation of the cells to K sums; the cells' state is written every REWRITE
iterations, and the few steps since are repeated on it.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonehive.llm.docfeatures import SAMPLE_ROWS, Linear, fit
from tonehive.llm.store import cut
from tonehive.llm.textcore import SPACE_SEPARATED, each_words

#: The fit ends when every target is met within TOLERANCE of it. Where no rates meet the targets it ends
#: when LEVEL iterations lower the error by less than a share of GAIN; it warns then, and after ITERATIONS.
ITERATIONS, TOLERANCE = 1000, 1e-5
LEVEL, GAIN = 40, 0.005
REWRITE = 16
#: Decimals of a posterior.
DECIMALS = 4
DOMAINS = {"clean": 0.90, "rough": 0.05, "toxic": 0.05}


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain that the labelled table gives: toxic, else rough or clean by quality."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "clean").when(quality == 0, "rough")


def _posteriors(model: Linear | None, domains: list[str], text_col: str):
    """Tokens and posteriors of each text, beside the row that holds it or beside what was kept of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = "text" not in batch.schema.names
            text = batch.column("row").field(text_col) if inside else batch.column("text")
            p = np.full((batch.num_rows, len(domains)), 1.0 / max(len(domains), 1))
            if model is not None and set(model.names) & set(domains):
                got = model.posteriors(text)
                p[:] = 0.0
                for k, name in enumerate(model.names):
                    if name in domains:
                        p[:, domains.index(name)] = got[:, k]
                p /= np.maximum(p.sum(1, keepdims=True), 1e-12)
            p = np.round(p, DECIMALS)
            tokens = np.concatenate([np.zeros(0, np.int64), *(np.diff(words.bounds) for _, _, words in each_words(text, SPACE_SEPARATED))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * len(domains)), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(tokens.astype(np.int64)), lists], ["row", "tokens", "p"])

    return run


@dataclass(frozen=True)
class Rates:
    """A fit: its steps, and what expected totals they give.

    A step is (momentum, K-vector). `error` is the greatest distance of a total from its target,
    relative to the target; `met` tells whether it is within the tolerance.
    """

    start: float
    curve: np.ndarray
    steps: list[tuple[float, np.ndarray]]
    got: np.ndarray
    want: np.ndarray
    error: float
    met: bool

    def column(self, p: Column) -> Column:
        """Rate of a document from its array of posteriors."""
        start, curve, steps = self.start, self.curve, self.steps
        if not steps:
            return F.lit(start)

        @F.pandas_udf("double")
        def rate(*columns: pd.Series) -> pd.Series:
            x = np.stack([np.asarray(c, float) for c in columns], axis=1)
            r = np.full(len(x), start)
            return pd.Series(_folded(x, r, r, curve, steps)[0])

        return rate(*(p[i] for i in range(len(curve))))


def _folded(p: np.ndarray, r: np.ndarray, before: np.ndarray, curve: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(rates, rates one step earlier) after some steps."""
    own = 1.0 / np.maximum(p @ curve, 1e-300)
    for momentum, g in steps:
        r, before = np.maximum(r + momentum * (r - before) - (p @ g) * own, 0.0), r
    return r, before


def _advanced(state: DataFrame, curve: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> DataFrame:
    """p, t, r and before of every cell, some steps on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column("p").flatten().to_numpy().reshape(batch.num_rows, -1)
            new = _folded(p, batch.column("r").to_numpy(), batch.column("before").to_numpy(), curve, steps)
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("t"), *map(pa.array, new)], ["p", "t", "r", "before"])

    return state.mapInArrow(run, "p array<double>, t double, r double, before double")


def fit_rates(members: DataFrame, targets: np.ndarray, budget: float | None = None, iterations: int = ITERATIONS, tolerance: float = TOLERANCE) -> Rates:
    """Rates that bring the expected totals of `members` (tokens long, p array of K) to the targets.

    `targets` are K weights, normalised here. `budget` is the tokens wanted in all, by default those
    that there are. A domain that no document belongs to cannot be met; its share stays unmet, and
    the rates are the least squares. A target of 0 is aimed at with the weight of a target of a
    thousandth of the budget.
    """
    k = len(targets)
    cells = cut(members.groupBy("p").agg(F.sum(F.col("tokens").cast("double")).alias("t")).where("t > 0"))
    first = cells.agg(F.sum("t").alias("t"), *(F.sum(F.col("t") * F.col("p")[i]).alias(f"s{i}") for i in range(k))).first()
    if not first.t:
        return Rates(0.0, np.ones(k), [], np.zeros(k), np.zeros(k), 0.0, True)
    total = float(first.t)
    budget = total if budget is None else float(budget)
    want = np.asarray(targets, float) / np.sum(targets) * budget
    if budget <= 0:
        return Rates(0.0, np.ones(k), [], np.zeros(k), np.zeros(k), 0.0, True)
    start = budget / total
    weight = 1.0 / np.maximum(want, 1e-3 * budget)
    own = np.array([first[f"s{i}"] for i in range(k)])
    curve = np.maximum(own, 1e-12 * total) * weight * weight
    state = cells.select("p", "t", F.lit(start).alias("r"), F.lit(start).alias("before"))
    steps: list[tuple[float, np.ndarray]] = []
    pending = 0
    got = before = own * start
    momentum, speed = 0.0, 1.0
    errors = [float(np.linalg.norm((got - want) * weight))]
    while _error(got, want, weight) > tolerance and len(steps) < iterations and not (len(errors) > LEVEL and errors[-1] > (1 - GAIN) * errors[-1 - LEVEL]):
        if len(steps) > 1 and _error(got, before, weight) < 1e-12:  # nothing moves any more
            break
        begun = got + momentum * (got - before)
        steps.append((momentum, (begun - want) * weight * weight))
        pending += 1
        row = _advanced(state, curve, steps[-pending:]).agg(*(F.sum(F.col("t") * F.col("r") * F.col("p")[i]).alias(f"s{i}") for i in range(k))).first()
        new = np.array([row[f"s{i}"] for i in range(k)])
        if steps[-1][1] @ (new - got) > 0:  # uphill: momentum starts anew
            speed, momentum = 1.0, 0.0
        else:
            faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
            speed, momentum = faster, (speed - 1) / faster
        before, got = got, new
        errors.append(float(np.linalg.norm((got - want) * weight)))
        if pending == REWRITE:
            state = cut(_advanced(state, curve, steps[-pending:]))
            pending = 0
    error = _error(got, want, weight)
    if error > tolerance:
        warnings.warn(f"rates after {len(steps)} iterations are {error:.2g} of a target away from it", stacklevel=2)
    return Rates(start, curve, steps, got, want, error, error <= tolerance)


def _error(got: np.ndarray, want: np.ndarray, weight: np.ndarray) -> float:
    return float(np.abs((got - want) * weight).max())


def _mixed(rows: DataFrame, docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float | None, text_col: str, sample_rows: int) -> DataFrame:
    domains = sorted(targets)
    y = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(domain_of(F.col("quality"), F.col("toxic"))).alias("y"))
    model = fit(docs.select("doc_id", F.col(text_col).alias("text")), y, sample_rows)
    kinds = rows.schema["row"].dataType.simpleString()
    members = cut(rows.mapInArrow(_posteriors(model, domains, text_col), f"row {kinds}, tokens long, p array<double>"))
    rates = fit_rates(members.select("tokens", "p"), np.array([targets[d] for d in domains]), budget)
    return members.withColumn("rate", F.round(rates.column(F.col("p")), 6))


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """row (struct of all columns of `docs`), tokens, p (posteriors in order of the sorted domains) and rate.

    Tokens are runs of non-space characters. Null and empty texts have no tokens and get the rate
    of their posteriors like any other, but weigh nothing. Repeated rows and ties have equal rates.
    Without labels all domains are equally likely. Targets must not be negative; they are
    normalised. An empty table gives an empty result.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return _mixed(rows, docs, labels, DOMAINS if targets is None else targets, budget, text_col, sample_rows)


def mixing_report(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """doc_id, tokens, a column p_<domain> for each domain, and rate, for every row of documents."""
    targets = DOMAINS if targets is None else targets
    rows = docs.select(F.struct("doc_id").alias("row"), "text")
    mixed = _mixed(rows, docs, labels, targets, None, "text", SAMPLE_ROWS)
    return mixed.select(F.col("row.doc_id").alias("doc_id"), "tokens", *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(sorted(targets))), "rate")
