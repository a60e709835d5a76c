"""Groups of similar vectors and related entries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as ST

from corvane.operators.similarity import (
    DIGITS, SEARCH_ROWS, SLICE_ROWS, _block_of, _blocks_for, _keyed, _matrix, top_matches,
)
from corvane.session import cut


def _joining_edges(
    left: np.ndarray, right: np.ndarray, left_nodes: np.ndarray, right_nodes: np.ndarray,
    nodes: int, threshold: float,
) -> list[tuple[int, int]]:
    """A spanning forest of the matches between two blocks of vectors.

    Nodes carry the label of their group so far; a row adds one edge per group it joins. Products are
    taken in single precision first; those that may reach the threshold, with all that single precision
    can be off, and would join two groups, are taken again in double precision. Rows that one group
    holds already are not multiplied with each other.
    """
    label = np.arange(nodes)
    edges: list[tuple[int, int]] = []
    lengths = np.sqrt((right * right).sum(axis=1))
    longest = lengths[np.isfinite(lengths)].max(initial=0.0)
    error = np.sqrt((left * left).sum(axis=1)) * longest * (left.shape[1] + 8) * 2.0 ** -23
    least = threshold - error - 10.0 ** -DIGITS
    rough_left, rough_right = left.astype(np.float32), right.astype(np.float32)
    for at in range(0, len(left), SLICE_ROWS):
        for low in range(0, len(right), SLICE_ROWS):
            own = label[left_nodes[at:at + SLICE_ROWS]]
            others = label[right_nodes[low:low + SLICE_ROWS]]
            found, counts = np.unique(np.concatenate([own, others]), return_counts=True)
            common = found[counts.argmax()]  # pairs within one group need no product
            for rows, columns in (
                (np.flatnonzero(own != common), np.arange(len(others))),
                (np.flatnonzero(own == common), np.flatnonzero(others != common)),
            ):
                rows, columns = rows + at, columns + low
                if not len(rows) or not len(columns):
                    continue
                near = rough_left[rows] @ rough_right[columns].T >= least[rows, None]
                for row in np.flatnonzero(near.any(axis=1)):
                    me, some = left_nodes[rows[row]], columns[near[row]]
                    some = some[label[right_nodes[some]] != label[me]]
                    some = some[np.round(right[some] @ left[rows[row]], DIGITS) >= threshold]
                    hits = right_nodes[some]
                    groups, first = np.unique(label[hits], return_index=True)
                    for group, where in zip(groups, first):
                        edges.append((me, hits[where]))
                        label[label == group] = label[me]
    return edges


def _block_pairs(rows: DataFrame, block_rows: int):
    """The rows cut into hash blocks and copied so that each pair of blocks meets once, as (lb, rb) with lb <= rb."""
    blocks = _blocks_for(rows.count(), block_rows)
    left = rows.withColumn("lb", _block_of(blocks)).withColumn(
        "rb", F.explode(F.sequence("lb", F.lit(blocks - 1))))
    renamed = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    right = renamed.withColumn("rb", _block_of(blocks)).withColumn(
        "lb", F.explode(F.sequence(F.lit(0), F.col("rb"))))
    return left.groupBy("lb", "rb").cogroup(right.groupBy("lb", "rb"))


def similarity_edges(
    vectors: DataFrame, threshold: float, dim: int, id_col: str = "id", vec: str = "vec",
    block_rows: int = SEARCH_ROWS,
) -> DataFrame:
    """Edges (a, b) that connect exactly what all pairs with cosine >= threshold connect.

    Each block pair emits a spanning forest of its matches, fewer edges than it has rows,
    so a group of m near copies costs about m edges and not m squared.
    """
    rows = _keyed(vectors, id_col, None, vec)
    kind = rows.schema["id"].dataType
    schema = ST.StructType([ST.StructField("a", kind), ST.StructField("b", kind)])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        ids = pd.unique(pd.concat([left["id"], right["id"]], ignore_index=True))
        at = pd.Index(ids)
        la, rb = at.get_indexer(left["id"]), at.get_indexer(right["id"])
        edges = _joining_edges(
            _matrix(left["indices"], left["values"], dim),
            _matrix(right["indices"], right["values"], dim), la, rb, len(ids), threshold,
        )
        return pd.DataFrame({"a": [ids[x] for x, _ in edges], "b": [ids[y] for _, y in edges]})

    return _block_pairs(rows, block_rows).applyInPandas(meet, schema)


def connected_components(
    nodes: DataFrame, edges: DataFrame, id_col: str = "id",
) -> DataFrame:
    """(id, component) with the smallest id of the component as its label.

    Each round takes the smallest neighbour label, then follows labels one step, so long
    chains shorten quickly; it ends when no label changes. Labels are checkpointed per round.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).distinct()
    both = cut(both)
    labels = cut(nodes.select(F.col(id_col).alias("id"), F.col(id_col).alias("component")))
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        lowered = labels.join(near, labels["id"] == near["a"], "left").select(
            "id", F.least("component", "near").alias("component"),
            F.col("component").alias("previous"),
        )
        hop = lowered.select(F.col("id").alias("component"), F.col("component").alias("next"))
        jumped = cut(
            lowered.join(hop, "component").select(
                "id", F.col("next").alias("component"), "previous"
            )
        )
        moved = jumped.filter(F.col("component") != F.col("previous")).limit(1).count()
        labels = jumped.select("id", "component")
        if not moved:
            return labels


def cluster_vectors(
    vectors: DataFrame, threshold: float, dim: int, id_col: str = "id", vec: str = "vec",
    min_size: int = 2, block_rows: int = SEARCH_ROWS,
) -> DataFrame:
    """(id, cluster): components of the similarity graph; small ones are noise, -1."""
    edges = similarity_edges(vectors, threshold, dim, id_col, vec, block_rows)
    parts = connected_components(vectors, edges, id_col)
    sizes = parts.groupBy("component").agg(F.count("*").alias("members"))
    return parts.join(sizes, "component").select(
        "id", F.when(F.col("members") >= min_size, F.col("component")).otherwise(-1).alias("cluster")
    )


def related_entries(
    documents: DataFrame, sentences: DataFrame, clusters: DataFrame, dim: int,
    doc_id: str = "entry_id", sentence_id: str = "sentence_id", min_vectors: int = 5,
    top: int = 3, **grid: int,
) -> DataFrame:
    """Related entries of each document: (entry_id, rank, related).

    Takes the ``top`` most similar sentences of other entries and keeps those in the
    cluster of the best one. Nothing is related unless more than ``min_vectors``
    sentences of other entries exist. ``documents(doc_id, owner, vec)``: ``owner`` is the
    entry whose own sentences are left out; ``sentences(sentence_id, entry_id, vec)``.
    """
    per_entry = sentences.groupBy("entry_id").agg(F.count("*").alias("own"))
    total = sentences.agg(F.count("*").alias("n")).select("n").scalar()
    enough = (
        documents.select(F.col(doc_id).alias("left_id"), "owner")
        .join(per_entry, F.col("owner") == F.col("entry_id"), "left")
        .filter(total - F.coalesce("own", F.lit(0)) > min_vectors)
        .select("left_id")
    )
    near = top_matches(
        documents, sentences, top, doc_id, sentence_id, dim, left_group="owner",
        right_group="entry_id", other_group=True, **grid,
    ).join(enough, "left_id", "left_semi")
    labelled = near.join(
        clusters.select(F.col("id").alias("right_id"), "cluster"), "right_id"
    ).join(
        sentences.select(F.col(sentence_id).alias("right_id"), F.col("entry_id").alias("related")),
        "right_id",
    )
    first = labelled.filter(F.col("rank") == 1).select("left_id", F.col("cluster").alias("best"))
    return (
        labelled.join(first, "left_id")
        .filter(F.col("cluster") == F.col("best"))
        .select(F.col("left_id").alias("entry_id"), "rank", "related")
    )
