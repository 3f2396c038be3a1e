"""Topic clusters of texts: hashed features, k-means, assignment, quality, partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import ElementwiseProduct, HashingTF, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions.text import cluster_text, shape_flags, stable_hash, url_host
from ..session import drop, stored
from .sampling import apportion, below_share, sub_partition, top_by_hash

#: Dimensions and weights of words (one and two) and of pieces of words (three to five characters).
WORD_DIMS, PIECE_DIMS, WORD_WEIGHT, PIECE_WEIGHT = 262_144, 131_072, 0.8, 0.2
CLUSTERS, FIT_DOCUMENTS, QUALITY_DOCUMENTS = 128, 1_000_000, 200_000
MAX_SHARE, MIN_SHARE = 0.35, 1e-6

#: Steps and local rounds of k-means ||, and clusters whose centres the driver has at a time.
STEPS, LOCAL_ROUNDS, AT_ONCE = 2, 30, 16


def document_id(row: list[Column], otherwise: Column) -> Column:
    """The first id that isn't empty or 0, else a hash."""
    given = [F.when((c.cast("string") != "") & (c.cast("string") != "0"), c.cast("string")) for c in row]
    return F.coalesce(*given, stable_hash("document", otherwise))


def prepared(df: DataFrame, row: str, text: str = "text", url: str | None = None) -> DataFrame:
    """row, normalised text, host, shape flags and bytes; texts that are empty then are left out."""
    t = cluster_text(F.col(text))
    host = url_host(F.col(url)) if url else F.lit("")
    return df.select(row, t.alias("text"), host.alias("host"), *shape_flags(F.col(text))).where("text <> ''")


def _pieces(word: Column) -> Column:
    padded = F.concat(F.lit(" "), word, F.lit(" "))
    return F.flatten(F.array(*(F.when(F.length(padded) >= n, F.transform(F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i, n=n: F.substring(padded, i, F.lit(n)))).otherwise(F.array().cast("array<string>")) for n in (3, 4, 5))))


def features(df: DataFrame, text: str = "text", word_dims: int = WORD_DIMS, piece_dims: int = PIECE_DIMS) -> DataFrame:
    """Adds `features`: hashed counts of words and pairs of words, and of pieces of words, weighted, of length 1."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?U)\b\w\w+\b"), 0)
    shaped = df.withColumn("__w", words)
    pairs = F.when(F.size("__w") > 1, F.zip_with(F.slice("__w", 1, F.size("__w") - 1), F.slice("__w", 2, F.size("__w") - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    shaped = shaped.withColumn("__g", F.concat("__w", pairs)).withColumn("__c", F.flatten(F.transform("__w", _pieces)))
    out = HashingTF(inputCol="__g", outputCol="__gv", numFeatures=word_dims).transform(shaped)
    out = HashingTF(inputCol="__c", outputCol="__cv", numFeatures=piece_dims).transform(out)
    out = Normalizer(inputCol="__gv", outputCol="__gn").transform(out)
    out = Normalizer(inputCol="__cv", outputCol="__cn").transform(out)
    out = ElementwiseProduct(inputCol="__gn", outputCol="__gs", scalingVec=Vectors.dense([WORD_WEIGHT] * word_dims)).transform(out)
    out = ElementwiseProduct(inputCol="__cn", outputCol="__cs", scalingVec=Vectors.dense([PIECE_WEIGHT] * piece_dims)).transform(out)
    out = VectorAssembler(inputCols=["__gs", "__cs"], outputCol="__v").transform(out)
    out = Normalizer(inputCol="__v", outputCol="features").transform(out)
    return out.drop("__w", "__g", "__c", "__gv", "__cv", "__gn", "__cn", "__gs", "__cs", "__v")


_CENTRE = "cluster int, n long, cost double, at binary, mean binary"


class Centres:
    """The centres of clusters, sparse: a table in the shared folder, of which the driver has a few at a time, and broadcasts of them."""

    def __init__(self, table: DataFrame, k: int, dims: int, prediction: str = "cluster") -> None:
        self.table, self.k, self.dims, self.prediction = table, k, dims, prediction
        context = table.sparkSession.sparkContext
        self.sent = [context.broadcast(self._some(a)) for a in range(0, k, AT_ONCE)]

    def _some(self, first: int) -> list[tuple]:
        rows = self.table.where((F.col("cluster") >= first) & (F.col("cluster") < first + AT_ONCE)).select("cluster", "at", "mean").collect()
        return [(r["cluster"], bytes(r["at"]), bytes(r["mean"])) for r in rows]

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802
        """As MLlib's model has them: dense, on the driver."""
        out = np.zeros((self.k, self.dims))
        for c, at, mean in (x for a in range(0, self.k, AT_ONCE) for x in self._some(a)):
            out[c, np.frombuffer(at, np.int32)] = np.frombuffer(mean, np.float32)
        return list(out)

    def setPredictionCol(self, name: str) -> Centres:  # noqa: N802
        return Centres(self.table, self.k, self.dims, name)

    def transform(self, vectors: DataFrame) -> DataFrame:
        return assign(vectors, self).withColumnRenamed("cluster", self.prediction).drop("distance")

    def free(self) -> None:
        for x in self.sent:
            x.destroy()
        drop(self.table)


def _loaded(sent: list, k: int, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the table for each feature, table of features by cluster, squares of the centres); features of no centre share the last row."""
    used, square = np.zeros(dims, bool), np.full(k, np.inf)
    for x in sent:
        for _, at, _ in x.value:
            used[np.frombuffer(at, np.int32)] = True
        x.__dict__.pop("_value", None)
    place = np.where(used, np.cumsum(used) - 1, int(used.sum())).astype(np.int32)
    table = np.zeros((int(used.sum()) + 1, k), np.float32)
    for x in sent:
        for c, at, mean in x.value:
            mean = np.frombuffer(mean, np.float32)
            table[place[np.frombuffer(at, np.int32)], c] = mean
            square[c] = (mean.astype(np.float64) ** 2).sum()
        x.__dict__.pop("_value", None)  # one block at a time
    return place, table, square


def _sparse(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, features, values) of all rows; a vector without indices is dense."""
    at, values = vectors.field("indices"), vectors.field("values")
    sizes = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    where = at.flatten().to_numpy(zero_copy_only=False) if not at.null_count else np.concatenate([np.arange(n) if x is None else np.asarray(x, np.int64) for x, n in zip(at.to_pylist(), sizes, strict=True)])
    return np.append(0, np.cumsum(sizes)), where, flat


def _nearest(part: tuple, loaded: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centre, squared distance) of each row, row by row: a row costs its own features times the number of clusters."""
    (ends, where, flat), (place, table, square) = part, loaded
    n = len(ends) - 1
    spots, values = place[where], flat.astype(np.float32)
    dots = np.empty((n, len(square)))
    for i in range(n):
        a, b = ends[i], ends[i + 1]
        dots[i] = values[a:b] @ table[spots[a:b]]
    own = np.bincount(np.repeat(np.arange(n), np.diff(ends)), flat * flat, n)
    away = square - 2 * dots + own[:, None]
    best = away.argmin(1)
    return best.astype(np.int32), np.maximum(away[np.arange(n), best], 0.0)


def _sums(sent: list, k: int, dims: int):
    """Sums of a task's vectors by cluster, sparse."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded, total = None, None
        n, cost = np.zeros(k, np.int64), np.zeros(k)
        for b in batches:
            if loaded is None:
                loaded, total = _loaded(sent, k, dims), np.zeros((k, dims), np.float32)  # pages that are never touched take no memory
            ends, where, flat = part = _sparse(b.column("features"))
            cluster, away = _nearest(part, loaded)
            n += np.bincount(cluster, minlength=k)
            cost += np.bincount(cluster, away, k)
            of = np.repeat(cluster, np.diff(ends))
            order = np.argsort(of, kind="stable")
            cuts = np.searchsorted(of[order], np.arange(k + 1))
            for c in np.flatnonzero(np.diff(cuts)):
                mine = order[cuts[c] : cuts[c + 1]]
                used, spot = np.unique(where[mine], return_inverse=True)
                total[c, used] += np.bincount(spot, flat[mine]).astype(np.float32)
        for c in np.flatnonzero(n):
            at = np.flatnonzero(total[c]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([n[c]]), pa.array([cost[c]]), pa.array([at.tobytes()], pa.binary()), pa.array([total[c, at].tobytes()], pa.binary())], ["cluster", "n", "cost", "at", "mean"])

    return run


def _mean(dims: int):
    def run(table: pa.Table) -> pa.Table:
        total, n = np.zeros(dims), pc.sum(table.column("n")).as_py()
        for at, part in zip(table.column("at"), table.column("mean"), strict=True):
            total[np.frombuffer(at.as_py(), np.int32)] += np.frombuffer(part.as_py(), np.float32)
        at = np.flatnonzero(total).astype(np.int32)
        mean = (total[at] / n).astype(np.float32)
        return pa.table([table.column("cluster")[:1], pa.array([n]), pa.array([pc.sum(table.column("cost")).as_py()]), pa.array([at.tobytes()], pa.binary()), pa.array([mean.tobytes()], pa.binary())], names=["cluster", "n", "cost", "at", "mean"])

    return run


def _centres(spark, rows: list[tuple], dims: int) -> Centres:  # noqa: ANN001
    """Centres from (features, values) of each."""
    made = [(i, 1, 0.0, np.asarray(at, np.int32).tobytes(), np.asarray(values, np.float32).tobytes()) for i, (at, values) in enumerate(rows)]
    return Centres(stored(spark.createDataFrame(made, _CENTRE), "centres"), len(rows), dims)


def _starts(vectors: DataFrame, row: str, k: int, seed: int, dims: int) -> list[tuple]:
    """Starting centres by k-means ||: STEPS times some 2 k rows, drawn by their squared distance from those before; these, weighted by
    the rows they are nearest to, are clustered on the driver, by their dot products alone."""
    spark, chosen, state = vectors.sparkSession, [], None

    def add(wanted: DataFrame) -> None:
        nonlocal state
        found = vectors.join(F.broadcast(wanted.select(row)), row, "left_semi").select(row, "features").orderBy(row).collect()
        if not found:
            return
        first = len(chosen)
        for r in found:
            v = r["features"].toArray() if not hasattr(r["features"], "indices") else None
            chosen.append((np.flatnonzero(v), v[np.flatnonzero(v)]) if v is not None else (r["features"].indices, r["features"].values))
        centres = _centres(spark, chosen[first:], dims)
        new = assign(vectors.select(row, "features"), centres).select(row, (F.col("cluster") + first).alias("best"), (F.col("distance") * F.col("distance")).alias("d"))
        if state is not None:
            new = state.join(new.select(row, F.col("best").alias("b"), F.col("d").alias("e")), row).select(row, F.when(F.col("e") < F.col("d"), F.col("b")).otherwise(F.col("best")).alias("best"), F.least("d", "e").alias("d"))
        before, state = state, stored(new, "nearest")
        if before is not None:
            drop(before)
        centres.free()

    add(top_by_hash(vectors.select(row), row, 1, seed))
    for step in range(STEPS):
        total = state.agg(F.sum("d")).first()[0] or 0.0
        if total > 0:
            u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(step), F.col(row)), F.lit(1 << 30)) + 0.5) / F.lit(float(1 << 30))
            add(state.where(u < 2.0 * k * F.col("d") / total))
    if len(chosen) < k:
        add(state.where("d > 1e-9").orderBy(F.desc("d"), row).limit(k - len(chosen)))
    weight = np.zeros(len(chosen))
    for r in state.groupBy("best").count().collect():
        weight[r["best"]] = r["count"]
    drop(state)
    n = len(chosen)
    gram, dense = np.zeros((n, n)), np.zeros(dims)
    for i, (at, values) in enumerate(chosen):
        dense[at] = values
        gram[i] = [dense[a] @ v for a, v in chosen]
        dense[at] = 0.0
    own, draw = np.diag(gram), np.random.default_rng(seed)
    pick = [int(draw.choice(n, p=weight / weight.sum()))]
    away = np.maximum(own + own[pick[0]] - 2 * gram[pick[0]], 0)
    while len(pick) < min(k, n):
        odds = away * np.maximum(weight, 1e-9)
        odds[pick] = 0
        x = int(draw.choice(n, p=odds / odds.sum())) if odds.sum() > 0 else next(i for i in range(n) if i not in pick)
        pick.append(x)
        away = np.minimum(away, np.maximum(own + own[x] - 2 * gram[x], 0))
    share = np.zeros((len(pick), n))
    share[np.arange(len(pick)), pick] = 1.0
    label = None
    for _ in range(LOCAL_ROUNDS):
        far = own[None, :] - 2 * share @ gram + ((share @ gram) * share).sum(1)[:, None]
        new = far.argmin(0)
        if label is not None and (new == label).all():
            break
        label = new
        for c in range(len(pick)):
            mine = (label == c) * np.maximum(weight, 1e-9)
            if mine.any():
                share[c] = mine / mine.sum()
    out = []
    for c in range(len(pick)):
        for i in np.flatnonzero(share[c]):
            dense[chosen[i][0]] += share[c, i] * chosen[i][1]
        at = np.flatnonzero(dense)
        out.append((at, dense[at]))
        dense[at] = 0.0
    return out


def fit(vectors: DataFrame, row: str, k: int = CLUSTERS, documents: int = FIT_DOCUMENTS, seed: int = 0, rounds: int = 10) -> Centres:
    """k-means on the documents with the smallest hashes; fewer documents than clusters is an error.

    Lloyd iterations from starts of k-means ||.  Sums are added up cluster by cluster, so no process but the workers has all centres
    dense, and those only over the features that occur.  A cluster that gets no row keeps its centre."""
    n = vectors.count()
    if min(n, documents) < k:
        raise ValueError(f"fewer documents than {k} clusters")
    sample = vectors if n <= documents else stored(top_by_hash(vectors, row, documents, seed), "sample")
    dims, spark = vectors.select("features").first()["features"].size, vectors.sparkSession
    centres, before = _centres(spark, _starts(sample, row, k, seed, dims), dims), None
    for _ in range(rounds):
        k = centres.k
        new = stored(sample.select("features").mapInArrow(_sums(centres.sent, k, dims), _CENTRE).groupBy("cluster").applyInArrow(_mean(dims), _CENTRE), "centres")
        got = new.select("cluster", "n", "cost").orderBy("cluster").collect()
        if missing := sorted(set(range(k)) - {r["cluster"] for r in got}):
            part, new = new, stored(new.unionByName(centres.table.where(F.col("cluster").isin(missing)).withColumn("n", F.lit(0).cast("long"))), "centres")
            drop(part)
        state = [(r["cluster"], r["n"], round(r["cost"], 4)) for r in got]
        centres.free()
        centres = Centres(new, k, dims)
        if state == before:
            break
        before = state
    return centres


def assign(vectors: DataFrame, model: Centres) -> DataFrame:
    """Columns but the features, with `cluster` and `distance` to its centre.

    Vectors stay sparse.  The centres are broadcast a few at a time; their size is clusters times dimensions at most, which the settings fix."""
    kept = [c for c in vectors.columns if c != "features"]
    schema = StructType([*vectors.select(*kept).schema.fields, StructField("cluster", IntegerType()), StructField("distance", DoubleType())])
    sent, k, dims = model.sent, model.k, model.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = None
        for b in batches:
            loaded = loaded or _loaded(sent, k, dims)
            cluster, away = _nearest(_sparse(b.column("features")), loaded)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(cluster), pa.array(np.sqrt(away))], [*kept, "cluster", "distance"])

    return vectors.select(*kept, "features").mapInArrow(run, schema)


def quality(assigned: DataFrame, row: str, clusters: int, documents: int = QUALITY_DOCUMENTS, seed: int = 0) -> DataFrame:
    """n_docs, bytes, share and distance percentiles of each cluster (cluster null: all), with `ok`: all clusters used, none too large or small.

    Percentiles are of a bounded hash sample of the documents, as the reference's gate has them."""
    total = assigned.count()
    sample = assigned.where(below_share(F.col(row), min(1.0, documents / max(total, 1)), seed))
    p = F.percentile("distance", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)))
    by = assigned.groupBy("cluster").agg(F.count("*").alias("n_docs"), F.sum("bytes").alias("bytes"))
    spread = sample.groupBy("cluster").agg(p.alias("p")).unionByName(sample.agg(p.alias("p")).withColumn("cluster", F.lit(None).cast("int")))
    every = assigned.agg(F.count("*").alias("n_docs"), F.sum("bytes").alias("bytes")).withColumn("cluster", F.lit(None).cast("int"))
    joined = by.unionByName(every).alias("a").join(spread.alias("s"), F.col("a.cluster").eqNullSafe(F.col("s.cluster")), "left")
    share = F.col("n_docs") / F.lit(max(total, 1))
    used = by.count() == clusters
    ok = F.when(F.col("a.cluster").isNull(), F.lit(used)).otherwise((share <= MAX_SHARE) & (share >= MIN_SHARE))
    return joined.select(F.col("a.cluster").alias("cluster"), "n_docs", "bytes", F.round(share, 6).alias("share"), *(F.round(F.get("p", F.lit(i)), 6).alias(n) for i, n in enumerate(("p50", "p95", "p99"))), ok.alias("ok"))


def partition_plan(sizes: DataFrame, desired: int) -> DataFrame:
    """Physical partitions of each cluster, at least one, the rest by bytes: adds `share` (how many) and `first`."""
    weighed = sizes.withColumn("__weight", F.coalesce(F.when(F.col("bytes") > 0, F.col("bytes")), F.col("n_docs")))
    clusters = sizes.count()
    return apportion(weighed, "cluster", "__weight", max(0, desired - clusters)).drop("__weight")


def physical_partition(assigned: DataFrame, plan: DataFrame, row: str, seed: int = 0) -> DataFrame:
    """Adds physical_partition: a cluster's documents are dealt over its partitions by hash."""
    rules = plan.select("cluster", "share", "first")
    return assigned.join(F.broadcast(rules), "cluster").withColumn("physical_partition", F.col("first") + sub_partition(F.col(row), F.col("share"), seed)).drop("share", "first")


def shuffle_order(df: DataFrame, row: str, partition: str = "physical_partition") -> DataFrame:
    """Each partition together, in the order of a hash seeded by it."""
    h = F.substring(F.sha2(F.concat(F.col(partition).cast("string"), F.lit("\0"), F.col(row).cast("string")), 256), 1, 16)
    return df.repartition(partition).sortWithinPartitions(partition, h, row)


def skew(df: DataFrame, text: str = "text") -> DataFrame:
    """documents, bytes, html_like, code_like, non_ascii and documents without text."""
    flags = shape_flags(F.col(text))
    return df.select(cluster_text(F.col(text)).alias("t"), *flags).agg(
        F.count("*").alias("documents"), *(F.sum(n).alias(n) for n in ("bytes", "html_like", "code_like", "non_ascii")), F.count_if(F.col("t") == "").alias("excluded")
    )
