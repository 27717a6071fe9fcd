"""Quality of documents: classifier evidence with empirical-Bayes posteriors of host and path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyra.llm.labels import agreed_labels
from papyra.llm.quality_rules import measures, rule_values
from papyra.llm.stored import stored
from papyra.llm.toxicity import fold
from papyra.sources.sizes import can_broadcast

THRESHOLD = 0.5
HELD_OUT = 2
_LEAST = 1e-6


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - _LEAST)), F.lit(_LEAST))
    return F.log(p) - F.log(1 - p)


def _features() -> dict[str, Column]:
    return {f"f_{name}": value for name, value in rule_values().items()} | {
        "f_length": F.log1p("n_words"),
        "f_letters": F.when(F.col("n_words") > 0, F.col("word_chars") / F.col("n_words")).otherwise(0.0),
    }


def document_evidence(measured: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """``measured`` with ``p``, the probability of good by the text alone, and ``known``.

    A logistic regression over the measures, fitted on all labelled rows outside the held-out fold;
    ``known`` is their label. Without labels of both classes ``p`` is the share of good labels, or
    one half.
    """
    marks = agreed_labels(labels, "id", label_col, "known").withColumn("known", F.col("known").cast("double"))
    marks = marks.where(fold(F.col("id")) != HELD_OUT)
    features = _features()
    marked = stored(measured.join(marks, "id", "left").withColumns(features), "evidence")
    shares = marked.where("known is not null").agg(F.count("*").alias("n"), F.avg("known").alias("good")).first()
    if not shares["n"] or shares["good"] in (0.0, 1.0):
        return marked.withColumn("p", F.lit(shares["good"] if shares["n"] else 0.5)).withColumn("prior", F.col("p"))
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = LogisticRegression(labelCol="known", regParam=1e-3, maxIter=60).fit(
        assembler.transform(marked.where("known is not null")).select("features", "known")
    )
    found = model.transform(assembler.transform(marked))
    return found.withColumn("p", vector_to_array("probability")[1]).withColumn("prior", F.lit(shares["good"]))


@dataclass
class Shrinkage:
    """Global rate, and how many documents a host's and a path's own prior weigh."""

    rate: float
    host: float
    path: float


def _weight(excess: float, room: float) -> float:
    """Prior weight from the intraclass correlation ``excess / room``, by the method of moments."""
    correlation = min(max(excess / room if room > 0 else 0.0, 1e-4), 0.99)
    return 1 / correlation - 1


def shrinkage(paths: DataFrame) -> tuple[Shrinkage, DataFrame]:
    """Weights estimated from ``paths(host, path, n, s)``; and paths with their hosts' sums.

    The spread of host rates around the global rate, and of path rates around their hosts', beyond
    what binomial chance explains, tells how much sites differ. The less, the more weight a prior
    gets, so sparse sites shrink to their host and sparse hosts to the whole.
    """
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n_host"), F.sum("s").alias("s_host"))
    total = hosts.agg(F.sum("n_host").alias("n"), F.sum("s_host").alias("s")).first()
    rate = min(max(total["s"] / total["n"], _LEAST), 1 - _LEAST) if total["n"] else 0.5
    spread = hosts.agg(
        F.sum(F.col("n_host") * F.pow(F.col("s_host") / F.col("n_host") - rate, F.lit(2))).alias("ss"),
        F.count("*").alias("k"), F.sum(F.col("n_host").cast("double") * F.col("n_host")).alias("nn"),
    ).first()
    n, k = total["n"] or 0, spread["k"]
    excess = (spread["ss"] or 0.0) / (rate * (1 - rate)) - (k - 1)
    host_weight = _weight(excess, n - (spread["nn"] or 0.0) / max(n, 1) - (k - 1))
    both = paths.join(hosts, "host")
    centre = (F.col("s_host") + host_weight * rate) / (F.col("n_host") + host_weight)
    spread = both.agg(
        F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - centre, F.lit(2)) / (centre * (1 - centre))).alias("ss"),
        F.count("*").alias("k"), F.sum(F.col("n").cast("double") * F.col("n") / F.col("n_host")).alias("nn"),
    ).first()
    inner = spread["k"] - k
    path_weight = _weight((spread["ss"] or 0.0) - inner, n - (spread["nn"] or 0.0) - inner)
    return Shrinkage(rate, host_weight, path_weight), both


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    host_col: str = "source", path_col: str = "lang", label_col: str = "quality", threshold: float = THRESHOLD,
) -> DataFrame:
    """``id_col, held_out, evidence, host_rate, path_rate, score, kept`` for each row of ``docs``.

    ``evidence`` is the log likelihood ratio of good by the text alone. A host's rate of good
    documents is the sum of its documents' labels, or probabilities where there is none, shrunk
    towards the global rate; a path's rate (a path belongs to its host) is shrunk towards its
    host's. Both leave out the document itself. The score is the posterior with the path's rate as
    prior and the evidence on top; kept is a score of at least ``threshold``.

    Sums are formed before rows are shuffled, so a host with a third of all rows is no burden. Null
    hosts and paths are a host and a path; null texts count as empty; null and repeated ids are
    kept, each row for itself. Labels with null ids or other values than 0 and 1 teach nothing.
    """
    given = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), F.col(text_col).alias("_text"),
    )
    evidence = document_evidence(
        stored(measures(given, "_text"), "measures"), labels.withColumnsRenamed({id_col: "id"}), label_col
    ).withColumn("r", F.coalesce("known", "p"))
    sums = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("r").alias("s"))
    weights, paths = shrinkage(stored(sums, "sites"))
    paths = stored(paths, "sites")
    near = F.broadcast(paths) if can_broadcast(paths) else paths
    host_rate = (F.col("s_host") - F.col("r") + weights.host * weights.rate) / (F.col("n_host") - 1 + weights.host)
    path_rate = (F.col("s") - F.col("r") + weights.path * F.col("host_rate")) / (F.col("n") - 1 + weights.path)
    ratio = _logit(F.col("p")) - _logit(F.col("prior"))
    return (
        evidence.select("id", "host", "path", "p", "prior", "r").join(near, ["host", "path"])
        .withColumn("host_rate", host_rate).withColumn("path_rate", path_rate).withColumn("evidence", ratio)
        .withColumn("score", 1 / (1 + F.exp(-(F.col("evidence") + _logit(F.col("path_rate"))))))
        .select(
            F.col("id").alias(id_col), F.coalesce(fold(F.col("id")) == HELD_OUT, F.lit(False)).alias("held_out"),
            "evidence", "host_rate", "path_rate", "score", (F.col("score") >= threshold).alias("kept"),
        )
    )
