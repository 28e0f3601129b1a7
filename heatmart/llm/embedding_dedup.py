"""Near-duplicate vectors: a small-world graph per shard, every shard asked, cosines checked, components joined."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from heatmart.llm.common import stored
from heatmart.llm.components import components
from heatmart.llm.hnsw import Graph

# Different vectors per shard.
SHARD = 8192
COSINE = 0.98


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no NULL or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _graph(rows: pd.DataFrame) -> pd.DataFrame:
    v = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    v /= np.linalg.norm(v / np.abs(v).max(1, keepdims=True), axis=1, keepdims=True) * np.abs(v).max(1, keepdims=True)
    graph = Graph.build(v.astype(np.float32), rows["rep"].to_numpy()).audit(COSINE)
    exact = v[np.argsort(rows["rep"].to_numpy())]
    return pd.DataFrame({"label": rows["label"].iloc[:1], "dim": rows["dim"].iloc[:1], "shards": rows["shards"].iloc[:1],
                         "shard": rows["shard"].iloc[:1], "graph": [graph.pack()], "exact": [exact.tobytes()]})


def _asked(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row asks one shard's graph for the neighbours of another shard's vectors."""
        for batch in batches:
            for i in range(batch.num_rows):
                index, exact, other, other_exact = (batch.column(c)[i].as_py() for c in range(4))
                graph, queries = Graph.unpack(index), Graph.unpack(other)
                q, node = graph.within(queries.vectors, least - 1e-4)
                a, b = queries.ids[q], graph.ids[node]
                # Exact vectors are stored by rising id.
                va = np.frombuffer(other_exact).reshape(len(queries.ids), -1)
                vb = np.frombuffer(exact).reshape(len(graph.ids), -1)
                ia, ib = np.searchsorted(np.sort(queries.ids), a), np.searchsorted(np.sort(graph.ids), b)
                good = np.zeros(len(a), bool)
                for k in range(0, len(a), 65536):
                    part = slice(k, k + 65536)
                    good[part] = np.einsum("nd,nd->n", va[ia[part]], vb[ib[part]]) >= least
                good &= a != b
                for k in range(0, max(int(good.sum()), 1), 65536):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.minimum(a, b)[good][k:k + 65536]), pa.array(np.maximum(a, b)[good][k:k + 65536])], ["a", "b"])
    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, shard_rows: int = SHARD) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors of one label (and length) are linked when their cosine, in double
    precision, is at least ``cosine``. Equal vectors of a label form a class,
    named by its smallest id; classes are dealt into shards of about
    ``shard_rows``, so neither a large label nor a group of copies fills a
    task. Every shard has a graph, whose beam was widened until an audit
    against full comparison passed; each shard's vectors ask all shards of
    their label. Beams full of neighbours are widened further, so the number of
    partners has no limit.

    A NULL label, and vectors that are NULL, empty, zero or hold NULL or
    non-finite components, link with nothing. A row without id links with
    nothing, has a NULL component and is kept. Rows that share an id are one
    node of the components; each counts as a vector of its own in n_links.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
                          F.col(label_col).alias("label"))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector"))
    rows = rows.withColumn("fit", F.coalesce(fit, F.lit(False)))
    key = F.sha2(F.array_join("vector", ","), 256)
    rows = rows.withColumn("key", F.when(F.col("fit"), key))
    classes = rows.where("fit").groupBy("label", "key").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"), F.first(F.size("vector")).alias("dim"))
    # An id of several vectors names several classes: numbers tell those apart.
    classes, _ = stored(classes.withColumn("class", F.monotonically_increasing_id()))
    counts = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).alias("shards"))
    dealt = classes.join(counts, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key"), "shards"))
    kind = dict(classes.dtypes)["label"]
    graphs, _ = stored(dealt.select("label", "dim", "shards", "shard", F.col("class").alias("rep"), "vector").groupBy("label", "dim", "shard").applyInPandas(
        _graph, f"label {kind}, dim int, shards long, shard long, graph binary, exact binary"))
    asking = graphs.select("label", "dim", F.col("graph").alias("other"), F.col("exact").alias("other_exact"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"))
    links, _ = stored(graphs.join(asking, ["label", "dim", "shard"]).select("graph", "exact", "other", "other_exact")
                      .mapInArrow(_asked(cosine), "a long, b long").distinct())
    both = links.union(links.select("b", "a"))
    sizes = classes.select(F.col("class").alias("b"), "copies")
    linked = both.join(sizes, "b").groupBy(F.col("a").alias("class")).agg(F.sum("copies").alias("linked"))
    named = (links.join(classes.select(F.col("class").alias("a"), F.col("rep").alias("rep_a")), "a")
             .join(classes.select(F.col("class").alias("b"), F.col("rep").alias("rep_b")), "b").select("rep_a", "rep_b"))
    joined = components(named.toDF("a", "b").union(_tied(rows, classes)))
    of = rows.join(classes.select("label", "key", "class", "rep", "copies"), ["label", "key"], "left")
    of = of.join(linked, "class", "left").join(joined.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "rep", "id"))
    n_links = F.when(F.col("fit"), F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long")
    return of.select("id", n_links.alias("n_links"), component.alias("component_id")).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _tied(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, class) of ids whose rows belong to several classes."""
    of = rows.where("fit").join(classes, ["label", "key"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))
    several = of.groupBy("a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).where("lo < hi")
    return of.join(several.select("a"), "a", "left_semi")
