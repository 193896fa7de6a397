"""Document quality: a classifier's evidence with what its host and path are like.

A classifier trained on labelled documents gives each document's log-odds.  The
expected quality of a host is shrunk towards the global mean, that of a path
within the host towards the host (beta-binomial empirical Bayes): sparse sites
hardly move, large ones speak for themselves.  How strongly to shrink is
estimated from how much hosts, and paths within hosts, really differ.  A
document's own share is taken out of its path before the two are combined.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, cut
from .quality_rules import measure, values

# The classifier is fitted on this many labelled documents at most, those with the lowest hashes.
LABELLED = 20_000
KEEP = 0.5
# Bounds of the number of pseudo-documents a prior is worth.
WEAKEST, STRONGEST = 2.0, 10_000.0
EDGE = 1e-4


def features() -> dict[str, Column]:
    found = {f"f_{name}": F.least(value, F.lit(20.0)) for name, value in values().items()}
    found["f_log_words"] = F.log1p("n_words")
    found["f_any_symbols"] = F.least(F.col("n_symbols") / 5, F.lit(1.0))
    found["f_log_line_words"] = F.log1p(F.col("n_words") / F.greatest("n_lines", F.lit(1)))
    return found


def logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def evidence(measured: DataFrame, labels: DataFrame, keep: list[str], id_col: str, label: str) -> DataFrame:
    """``keep`` and ``p_document``, the classifier's probability.

    With no labels, or labels of one kind, every document gets the share of
    good labels (a half without any).
    """
    known = labels.select(F.col(id_col).alias("__id"), F.col(label).cast("double").alias("__label")).where("__id IS NOT NULL AND __label IN (0, 1)")
    columns = features()
    rows = (measured.select("doc_id", *[v.alias(k) for k, v in columns.items()])
            .join(known, F.col("doc_id") == F.col("__id")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED))
    rows = cut(rows)
    kinds = rows.agg(F.count("*").alias("n"), F.avg("__label").alias("share")).first()
    if not kinds["n"] or kinds["share"] in (0.0, 1.0):
        return measured.select(*keep, F.lit(0.5 if not kinds["n"] else kinds["share"]).alias("p_document"))
    assembler = VectorAssembler(inputCols=list(columns), outputCol="__features")
    model = LogisticRegression(featuresCol="__features", labelCol="__label", regParam=1e-3, maxIter=60).fit(assembler.transform(rows))
    scored = model.transform(assembler.transform(measured.select(*keep, *[v.alias(k) for k, v in columns.items()])))
    return scored.select(*keep, F.element_at(vector_to_array("probability"), 2).alias("p_document"))


def strength(groups: DataFrame, mean: Column) -> float:
    """Pseudo-documents of the prior around ``mean``, by the method of moments.

    ``groups`` has n, total (summed probabilities) and spread (summed p(1-p)).
    What group means differ beyond the noise of their documents is real.
    """
    rate = F.col("total") / F.col("n")
    row = groups.where("n > 1").agg(
        F.sum(F.col("n") * (rate - mean) ** 2).alias("between"), F.sum(F.col("noise")).alias("noise"),
        F.sum("n").alias("n"), F.avg(mean * (1 - mean)).alias("variance")).first()
    if not row["n"]:
        return STRONGEST
    real = (row["between"] - row["noise"]) / row["n"]
    if real <= 0 or not row["variance"]:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, row["variance"] / real - 1))


def posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, n, total, p_host, prior): posterior of each host; ``prior`` is worth of the host for its paths."""
    variance = F.coalesce(F.var_samp("p_document"), F.lit(0.0))
    paths = cut(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_document").alias("total"), variance.alias("noise")))
    hosts = cut(scored.groupBy("host").agg(F.count("*").alias("n"), F.sum("p_document").alias("total"), variance.alias("noise")))
    everything = hosts.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    mean = everything["total"] / everything["n"] if everything["n"] else 0.5
    between_hosts = strength(hosts, F.lit(mean))
    shrunk = hosts.select(F.col("host").alias("of"), ((F.col("total") + between_hosts * mean) / (F.col("n") + between_hosts)).alias("p_host"))
    joined = cut(paths.join(shrunk, F.col("host").eqNullSafe(F.col("of"))).drop("of"))
    return joined.select("host", "path", "n", "total", "p_host", F.lit(strength(joined, F.col("p_host"))).alias("worth"), F.lit(mean).alias("p_all"))


def quality_model(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, id_col: str = "doc_id",
                  text: str = "text", label: str = "quality", keep: float = KEEP) -> DataFrame:
    """One row for each input row: doc_id, p_document, p_host, p_path, p_quality, kept.

    ``host`` and ``path`` default to the source, and the language within it.
    Null hosts and paths are groups of their own.  Null and empty texts are
    scored as texts without words.  Repeated rows count as often as they come.
    Labels that are null or neither 0 nor 1 are ignored.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), (F.col("source") if host is None else host).cast("string").alias("host"),
                       (F.col("lang") if path is None else path).cast("string").alias("path"), F.col(text).alias("text"))
    measured = cut(measure(slim, ["doc_id", "host", "path"]))
    scored = cut(evidence(measured, labels, ["doc_id", "host", "path"], id_col, label))
    sites = posteriors(scored).withColumnsRenamed({"host": "at_host", "path": "at_path"})
    sites = cut(sites)
    joined = scored.join(broadcast_if_small(sites, sites.count()), F.col("host").eqNullSafe(F.col("at_host")) & F.col("path").eqNullSafe(F.col("at_path")))
    others = (F.col("total") - F.col("p_document") + F.col("worth") * F.col("p_host")) / (F.col("n") - 1 + F.col("worth"))
    posterior = 1 / (1 + F.exp(-(logit(F.col("p_document")) + logit(others) - logit(F.col("p_all")))))
    return joined.select("doc_id", "p_document", "p_host", others.alias("p_path"), posterior.alias("p_quality"), (posterior >= keep).alias("kept"))
