"""Near-duplicate vectors: spherical k-means cells and blocked products inside them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corvane.llm.common import components, written

THRESHOLD = 0.93
CELLS = 16
SAMPLE = 4096
BLOCK = 4096


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids; starts from spread-out rows, empty cells keep their centroid."""
    centre = [vectors[0]] if len(vectors) else []
    while len(centre) < min(cells, len(vectors)):
        centre.append(vectors[np.argmin((vectors @ np.array(centre).T).max(axis=1))])
    centroids = np.array(centre)
    for _ in range(rounds if len(centroids) else 0):
        home = (vectors @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def unit(rows: pd.Series) -> np.ndarray:
    matrix = np.array(rows.tolist(), np.float64).reshape(len(rows), -1)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, cells: int = CELLS, sample: int = SAMPLE,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector, exact for cosine >= threshold.

    Centroids are fitted on at most ``sample`` vectors, chosen by hash; every vector is
    assigned. Two linked vectors differ by at most sqrt(2 - 2 * threshold), so one of them lies
    within half of that of the border between their cells, and visits the other's cell; a pair
    that would meet in two cells counts in the lower one. So nothing is lost; the price is
    copies of vectors near borders, and for vectors without structure that is most of them.

    Cells are cut into blocks, and two blocks meet in one task, which returns a link count per
    vector and a spanning forest, never pairs. Equal vectors are one vector with a count.
    Only rows with equal labels are compared. Null labels, and vectors that are null, empty,
    zero or hold null or non-finite components, link with nothing and are kept. Vectors of
    different lengths never link. Rows that repeat an id are separate vectors.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vec_col).cast("array<double>").alias("vec"))
    good = F.col("label").isNotNull() & F.col("vec").isNotNull() & F.coalesce(
        F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)
    ) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("vec", F.when(good, F.col("vec")))
    once = written(
        rows.filter("vec is not null").groupBy("label", "vec").agg(
            F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("node", F.monotonically_increasing_id()),
        "vectors")
    width = F.size("vec")
    some = once.select(width.alias("width"), "vec").orderBy(F.xxhash64("vec"), "vec").limit(sample).toPandas()
    centroids = {int(w): spherical_kmeans(unit(part["vec"]), cells) for w, part in some.groupby("width")}
    reach = np.sqrt(max(2 - 2 * threshold, 0)) / 2 + 1e-9

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, part in batch.groupby(batch["vec"].map(len)):
                centre = centroids.get(int(length))
                if centre is None or not len(centre):
                    centre = np.eye(1, int(length))
                likeness = unit(part["vec"]) @ centre.T
                home = likeness.argmax(axis=1)
                apart = np.linalg.norm(centre[home][:, None] - centre[None], axis=2)
                near = likeness[np.arange(len(home)), home][:, None] - likeness <= reach * apart
                near[np.arange(len(home)), home] = True
                visits = [np.flatnonzero(x).astype(np.int32) for x in near]
                yield pd.DataFrame({
                    "node": part["node"], "label": part["label"], "copies": part["copies"], "vec": part["vec"],
                    "width": int(length), "home": home.astype(np.int32), "visits": visits})

    label = once.schema["label"].dataType.simpleString()
    placed = written(once.mapInPandas(
        place, f"node bigint, label {label}, copies bigint, vec array<double>, width int, home int, visits array<int>"), "cells")
    key = ["label", "width", "cell"]
    sizes = placed.select("label", "width", F.explode("visits").alias("cell")).groupBy(*key).agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks"))
    spread = (
        placed.withColumn("cell", F.explode("visits")).join(sizes, key)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
        .drop("blocks", "other")
    )

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        matrix, cell = unit(part["vec"]), int(part["cell"].iloc[0])
        block, home = part["block"].to_numpy(), part["home"].to_numpy()
        node, copies = part["node"].to_numpy(), part["copies"].to_numpy()
        across = part["low"].iloc[0] != part["high"].iloc[0]
        resident = home == cell
        comes = [set(v.tolist()) for v in part["visits"]]
        links, group, edges = np.zeros(len(part), np.int64), np.arange(len(part)), []
        for at in range(0, len(part), 512):
            hits = np.tril(matrix[at:at + 512] @ matrix[:at + 512].T >= threshold, at - 1)
            for row in np.flatnonzero(hits.any(axis=1)) + at:
                hit = np.zeros(len(part), bool)
                hit[:hits.shape[1]] = hits[row - at]
                hit &= resident | resident[row]
                if across:
                    hit &= block != block[row]
                for other in np.flatnonzero(hit & (home != home[row])):
                    elsewhere = home[other] if resident[row] else home[row]
                    stays = other if resident[other] else row
                    if elsewhere in comes[stays] and elsewhere < cell:
                        hit[other] = False
                links[row] += copies[hit].sum()
                links[hit] += copies[row]
                for other in np.unique(group[hit]):
                    if other != group[row]:
                        edges.append((node[np.flatnonzero(hit & (group == other))[0]], node[row]))
                        group[group == other] = group[row]
        found = links > 0
        return pd.DataFrame({
            "a": np.r_[node[found], [a for a, _ in edges]].astype(np.int64),
            "b": pd.array([None] * int(found.sum()) + [int(b) for _, b in edges], "Int64"),
            "links": np.r_[links[found], np.zeros(len(edges))].astype(np.int64)})

    met = written(spread.groupBy(*key, "low", "high").applyInPandas(meet, "a bigint, b bigint, links bigint"), "links")
    counts = met.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = components(met.filter("b is not null").select("a", "b")).join(once.select("node", "first"), "node")
    smallest = parts.groupBy("component").agg(F.min("first").alias("smallest"))
    named = parts.join(smallest, "component").select("node", "smallest")
    facts = once.join(counts, "node", "left").join(named, "node", "left").select(
        "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("smallest", "first").alias("component_id"))
    grouped = rows.filter("vec is not null").join(facts, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("vec is null").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.vec) = len(b.vec) AND list_cosine_similarity(a.vec, b.vec) >= 0.93),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(low.b, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low.b, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN low ON low.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
