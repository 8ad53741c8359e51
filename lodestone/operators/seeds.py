"""Intent seeds: first questions, hashed n-gram vectors, clusters, representatives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lodestone.plans.schema import texts

DIM = 256
THRESHOLD = 0.72
MIN_CHARS = 3


def first_question(events: Column | str = "events") -> Column:
    """The first user turn that is not blank, stripped."""
    stripped = F.transform(texts("user", events), lambda t: F.regexp_replace(t, r"^\s+|\s+$", ""))
    return F.get(F.filter(stripped, lambda t: t != ""), F.lit(0))


def collect_questions(trajectories: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    return trajectories.select("session_id", "lineage_id", "domain", first_question().alias("query")).where(F.length("query") >= min_chars)


def hash_embed(text: Column, dim: int = DIM, sizes: tuple[int, ...] = (3, 4, 5)) -> Column:
    """Unit vector of hashed character n-gram counts of the lower-cased text; all zero for a text without n-grams."""

    def grams(c: Column) -> Column:
        parts = [F.when(F.size(c) >= n, _grams(c, n)).otherwise(F.array().cast("array<string>")) for n in sizes]
        return F.transform(F.concat(*parts), lambda g: F.pmod(F.xxhash64(g), F.lit(dim)).cast("int"))

    bins = F.transform(F.array(F.split(F.lower(F.coalesce(text, F.lit(""))), "")), grams)[0]

    def vector(s: Column) -> Column:
        # sorted, with every bin once besides: a bin's count is the length of its run, less one
        ends = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == F.size(s) - 1) | (F.get(s, i + 1) != s[i]))
        counts = F.transform(F.array(ends), lambda e: F.transform(e, lambda x, i: (x - F.coalesce(F.get(e, i - 1), F.lit(-1)) - 1).cast("double")))[0]

        return F.transform(F.transform(F.array(counts), lambda c: F.struct(c.alias("c"), F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)).alias("n"))), lambda v: F.transform(v["c"], lambda x: F.when(v["n"] > 0, x / v["n"]).otherwise(F.lit(0.0))))[0]

    every = F.sequence(F.lit(0), F.lit(dim - 1))
    return F.transform(F.array(F.array_sort(F.concat(bins, every))), vector)[0]


def _grams(chars: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(chars) - n), lambda i: F.concat(*[chars[i + j] for j in range(n)]))


def cosine(a: Column, b: Column) -> Column:
    """Dot product of unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


#: rows whose products with all centroids are made at once
AT_ONCE = 256


def greedy_labels(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Single pass: each vector joins the nearest running-mean centroid within the threshold, else opens a cluster.

    Each vector depends on those before it, so this is one task.  Products with
    the centroids of a block's start are one matrix product for the block; only
    centroids that moved or were opened since then are multiplied again.
    """
    dim = vectors.shape[1] if vectors.ndim > 1 else 0
    centroids = np.zeros((64, dim))
    counts = np.zeros(64, np.int64)
    opened = 0
    out = np.zeros(len(vectors), np.int64)
    for lo in range(0, len(vectors), AT_ONCE):
        block = vectors[lo : lo + AT_ONCE]
        begun = opened
        # a centroid that moves is left to the fresh ones, its column is put out
        sims = block @ centroids[:begun].T
        fresh: list[int] = []
        place: dict[int, int] = {}
        own = np.zeros((len(block), dim))
        for i, v in enumerate(block):
            j, best = -1, -np.inf
            if begun:
                j = int(sims[i].argmax())
                best = sims[i, j]
            if fresh:
                again = own[: len(fresh)] @ v
                top = again.max()
                if top >= best:  # ties go to the first centroid
                    f = min(fresh[x] for x in np.flatnonzero(again == top))
                    j = f if top > best else min(j, f)
                    best = top
            if j >= 0 and best >= threshold:
                c = (centroids[j] * counts[j] + v) / (counts[j] + 1)
                centroids[j] = c / (np.linalg.norm(c) or 1.0)
                counts[j] += 1
            else:
                if opened == len(counts):  # room doubles, so that growing stays linear
                    centroids = np.concatenate([centroids, np.zeros_like(centroids)])
                    counts = np.concatenate([counts, np.zeros_like(counts)])
                j = opened
                centroids[j] = v
                counts[j] = 1
                opened += 1
            if j not in place:
                place[j] = len(fresh)
                fresh.append(j)
                if j < begun:
                    sims[:, j] = -np.inf
            own[place[j]] = centroids[j]
            out[lo + i] = j
    return out


def greedy_cluster(rows: DataFrame, block: str | None, order: str, threshold: float = THRESHOLD) -> DataFrame:
    """Order-dependent greedy clustering inside each block; adds `label` (block/number).

    Without a block all rows are clustered in one pass (label: the number).
    One task holds one block, so blocks must be bounded; kmeans_cluster() is the way without that bound.
    """
    schema = StructType([*rows.schema.fields, StructField("label", StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        labels = greedy_labels(np.array(pdf["vector"].tolist(), dtype=float), threshold)
        if block is None:
            return pdf.assign(label=[f"{n:012d}" for n in labels])
        return pdf.assign(label=[f"{b}/{n}" for b, n in zip(pdf[block], labels, strict=True)])

    out = rows.groupBy(*([block] if block else [])).applyInPandas(run, schema)
    # only the clustering itself is one task; what follows is not
    return out if block else out.repartition(rows.sparkSession.sparkContext.defaultParallelism)


def kmeans_cluster(rows: DataFrame, k: int | None = None, seed: int = 0) -> DataFrame:
    """MLlib k-means on the vectors, k defaulting to the root of the number of rows; adds `label`."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    # the vectors cost more than the clusters: they are made once
    rows = rows.persist(StorageLevel.DISK_ONLY)
    k = k or max(1, int(max(1, rows.count()) ** 0.5))
    ready = rows.withColumn("_features", array_to_vector("vector"))
    model = KMeans(k=max(2, k), seed=seed, featuresCol="_features", predictionCol="label").fit(ready)
    return model.transform(ready).drop("_features").withColumn("label", F.col("label").cast("string"))


def centroids(rows: DataFrame, label: str = "label", vector: str = "vector") -> DataFrame:
    """(label, centroid): unit mean vectors, by dimension, so no group is collected."""
    dims = rows.select(label, F.posexplode(vector).alias("d", "x")).groupBy(label, "d").agg(F.avg("x").alias("x"))
    mean = dims.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda e: e["x"]).alias("m"))
    norm = F.sqrt(F.aggregate("m", F.lit(0.0), lambda a, x: a + x * x))
    return mean.select(label, F.transform("m", lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))).alias("centroid"))


def representatives(rows: DataFrame, text: str = "query", label: str = "label", vector: str = "vector", places: int = 9) -> DataFrame:
    """Per cluster the row nearest its centroid; ties to the shorter, then the smaller text."""
    met = rows.join(centroids(rows, label, vector), label)
    near = F.round(cosine(F.col(vector), F.col("centroid")), places)
    return met.groupBy(label).agg(F.min_by(F.struct(*rows.columns), F.struct(-near, F.length(text), F.col(text))).alias("rep"), F.count("*").alias("cluster_size"))


def build_seeds(clustered: DataFrame) -> DataFrame:
    """seed_id, query, cluster_id, cluster_size, original_lineage_ids, domain, source_session_ids; largest cluster first."""
    # read three times: without this each read would cluster again
    clustered = clustered.persist(StorageLevel.DISK_ONLY)
    reps = representatives(clustered)
    ids = clustered.groupBy("label").agg(F.array_sort(F.collect_set("lineage_id")).alias("original_lineage_ids"), F.array_sort(F.collect_set("session_id")).alias("source_session_ids"))
    # one row per cluster
    rank = F.row_number().over(W.orderBy(F.desc("cluster_size"), "label")) - 1
    rows = reps.join(ids, "label").withColumn("cluster_id", rank)
    sid = F.concat(F.lit("seed-"), F.substring(F.sha2(F.concat(F.col("cluster_id").cast("string"), F.lit("::"), F.col("rep.query")), 256), 1, 12))
    return rows.select(sid.alias("seed_id"), F.col("rep.query").alias("query"), "cluster_id", "cluster_size", "original_lineage_ids", F.col("rep.domain").alias("domain"), "source_session_ids")


def embed_with(model_factory, batch: int = 256):
    """An Arrow UDF from a factory of `texts -> vectors`; the model is made once per worker."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def embed(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = model_factory()
        for s in parts:
            out: list = []
            for lo in range(0, len(s), batch):
                out += [list(map(float, v)) for v in model(s.iloc[lo : lo + batch].tolist())]
            yield pd.Series(out)

    return embed


def extract(trajectories: DataFrame, method: str = "greedy", block: str | None = "domain", threshold: float = THRESHOLD, k: int | None = None, seed: int = 0) -> DataFrame:
    """Seeds of the trajectories' first questions."""
    rows = collect_questions(trajectories).withColumn("vector", hash_embed(F.col("query"))).withColumn("domain", F.coalesce("domain", F.lit("")))
    clustered = greedy_cluster(rows, block, "session_id", threshold) if method == "greedy" else kmeans_cluster(rows, k, seed)
    return build_seeds(clustered)
