"""Quality by hierarchical empirical Bayes: a document's own evidence and its site's standing.

A linear classifier, fitted on labelled rows, gives each document's log-likelihood ratio for
"good". The expected number of good documents of every host and of every path of a host is a
grouped sum over all documents. A path's rate is shrunk towards its host's, a host's towards the
global rate, each with a strength found by the method of moments, so that sparse sites stay near
their parents. A document is left out of the rates that it is judged by, so that its evidence counts
once. The posterior is the site's log-odds plus the document's log-likelihood ratio.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonehive.llm.docfeatures import SAMPLE_ROWS, Linear, fit
from tonehive.llm.store import cut

GOOD = "good"
#: Bounds of the strength of shrinking, in documents.
STRENGTH = (2.0, 1000.0)
#: Evidence of a text of n words counts n / (n + FEW): a few words tell little.
FEW = 5
#: Evidence of a null text.
NO_TEXT = -20.0
#: Posterior under which a document is rejected.
LEAST = 0.2


def label_of(quality: Column, toxic: Column) -> Column:
    """Training target: good if the text is of quality and not toxic; null without a quality label."""
    return F.when(quality.isNull(), F.lit(None)).when((quality == 1) & (F.coalesce(toxic, F.lit(0)) == 0), GOOD).when(quality == 1, "toxic").otherwise("poor")


def fit_on_labels(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Linear | None:
    """Fits good / toxic / poor on the documents that `labels` (doc_id, quality, toxic) covers."""
    y = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(label_of(F.col("quality"), F.col("toxic"))).alias("y"))
    return fit(docs.select("doc_id", "text"), y, sample_rows)


def _evidence(model: Linear | None, text_col: str):
    """Log-likelihood ratio of good against all else, in place of the text or beside a row that holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside = "text" not in batch.schema.names
            text = batch.column("row").field(text_col) if inside else batch.column("text")
            llr = np.zeros(batch.num_rows)
            if model is not None and GOOD in model.names and len(model.names) > 1:
                k = model.names.index(GOOD)
                p, words = model.judged(text)
                p = np.clip(p[:, k], 1e-6, 1 - 1e-6)
                prior = np.clip(model.prior[k], 1e-6, 1 - 1e-6)
                llr = (np.log(p / (1 - p)) - np.log(prior / (1 - prior))) * words / (words + FEW)
                llr[~np.asarray(text.is_valid())] = NO_TEXT
            keep = ["row", "host", "path"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(llr)], [*keep, "llr"])

    return run


def _strength(groups: DataFrame, parent: str) -> float:
    """Prior weight by the method of moments: how far group rates differ beyond chance."""
    rate, mean = F.col("good") / F.col("n"), F.col(parent)
    got = groups.where("n >= 2").agg(
        F.sum(F.col("n") * (rate - mean) ** 2).alias("spread"), F.sum(mean * (1 - mean)).alias("chance"), F.sum(F.col("n") * mean * (1 - mean)).alias("scale"), F.count("*").alias("k")
    ).first()
    if not got.k or not got.scale:
        return STRENGTH[1]
    excess = (got.spread - got.chance) / got.scale  # about 1 / (strength + 1)
    return float(min(max(1.0 / excess - 1.0, STRENGTH[0]), STRENGTH[1])) if excess > 0 else STRENGTH[1]


def _logit(p: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(q / (1 - q))


def with_posterior(docs: DataFrame, model: Linear | None, host: Column, path: Column, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """row (struct of the columns `keep` of `docs`, by default all), llr, site (the site's rate) and posterior.

    Texts are read once: evidence is written beside the rows. A null text counts as strong evidence
    against; an empty one has none and is judged by its site. Null hosts and paths are sites like
    any other. A site of one document has its parent's rate.
    """
    keep = docs.columns if keep is None else keep
    text = [] if text_col in keep else [F.col(f"`{text_col}`").alias("text")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), host.cast("string").alias("host"), path.cast("string").alias("path"), *text)
    kinds = rows.schema["row"].dataType.simpleString()
    prior = 0.5 if model is None or GOOD not in model.names else float(np.clip(model.prior[model.names.index(GOOD)], 1e-3, 1 - 1e-3))
    offset = float(np.log(prior / (1 - prior)))
    scored = cut(rows.mapInArrow(_evidence(model, text_col), f"row {kinds}, host string, path string, llr double"))
    scored = scored.withColumn("own", 1 / (1 + F.exp(-(F.col("llr") + offset))))
    paths = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("own").alias("good")))
    whole = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    mean = whole.good / whole.n if whole.n else prior
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("parent", F.lit(mean))
    k = _strength(hosts, "parent")
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("good").alias("host_good"), ((F.col("good") + k * mean) / (F.col("n") + k)).alias("parent"))
    joined = cut(paths.join(cut(hosts), F.col("host").eqNullSafe(F.col("h"))).drop("h"))
    j = _strength(joined, "parent")
    sites = joined.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "n", "good", "host_n", "host_good")
    out = scored.join(sites, F.col("host").eqNullSafe(F.col("_h")) & F.col("path").eqNullSafe(F.col("_p")))
    # The three rates without the document itself.
    rest = (F.lit(whole.good or 0.0) - F.col("own")) / (whole.n - 1) if whole.n and whole.n > 1 else F.lit(prior)
    parent = (F.col("host_good") - F.col("own") + k * rest) / (F.col("host_n") - 1 + k)
    site = (F.col("good") - F.col("own") + j * parent) / (F.col("n") - 1 + j)
    out = out.select("row", "llr", site.alias("site"))
    return out.select("row", "llr", "site", (1 / (1 + F.exp(-(_logit(F.col("site")) + F.col("llr"))))).alias("posterior"))


def quality_report(docs: DataFrame, labels: DataFrame, least: float = LEAST, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, evidence, site_rate, posterior and kept for every row of documents.

    The host is `source`, the path (source, lang). A document is kept if its posterior of being
    good (of quality and not toxic) is at least `least`. Without usable labels all evidence is 0
    and all are judged alike. Repeated rows are judged alike. Whole texts are read, however long.
    Other columns, whatever their names, are not read. An empty table gives an empty result.
    """
    model = fit_on_labels(docs, labels, sample_rows)
    scored = with_posterior(docs, model, F.col("source"), F.col("lang"), keep=["doc_id"])
    return scored.select(F.col("row.doc_id").alias("doc_id"), F.round("llr", 6).alias("evidence"), F.round("site", 6).alias("site_rate"), F.round("posterior", 6).alias("posterior"), (F.col("posterior") >= least).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of `docs` whose posterior is at least `least`, with the columns they had."""
    model = fit_on_labels(docs, labels, sample_rows)
    return with_posterior(docs, model, F.col("source"), F.col("lang")).where(F.col("posterior") >= least).select("row.*")
