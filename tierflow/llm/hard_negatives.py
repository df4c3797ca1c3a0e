"""Hard-negative mining with lists shared by clusters of anchors.

Anchors are clustered by direction.  For an anchor u of a cluster with centroid c
and radius r (its largest angle to a member), a row x at the angle t from c has

    u.x <= |u| * |x| * cos(max(0, t - r)),

so |x| * cos(max(0, t - r)) sorts the rows once for the whole cluster, and every
member walks that list until the bound of the next row, times |u|, is below
what it still needs.  Whatever it has not walked then is certified to be out.

Two walks.  The first finds the positives of an anchor: its best rows with the
same label.  The second finds, for each positive, the best rows with another
label whose score lies between ``LOW`` and ``HIGH`` percent of the positive's; it
needs nothing below ``LOW`` percent of the least positive, so the walk ends
there, and rows that no cluster of a shelf can use are not even sent to it.

How it is dealt out: anchors lie on shelves of at most about ``SHELF`` (a larger
cluster is split over shelves by id), rows in slices by a hash; a cell is a
shelf with a slice.  A cell gets its anchors first and then its rows as a
stream, in blocks of ``BLOCK``; it keeps a few best rows for each anchor, and
these are merged over the slices.  So memory is bounded by the shelf, no group
is gathered, and equal vectors, however many, are rows like others.  Scores are
exact: in doubles where no sum can reach 2**53, else in Python integers
(clipped to the long range).

The centroids are fitted on at most ``FIT_ROWS`` anchors (the first by a hash of
the id), a bound that only moves the speed: every anchor is clustered, every row
is listed, and the results do not depend on the clusters.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part; shorter vectors count as filled up with zeros; entries
beyond the long range are its ends.  Ids are compared as they are: "other rows"
are rows with another id; equal ids with different vectors or labels are anchors
of their own, exactly equal anchor rows are one anchor, but repeated rows each
count as candidates.  A null id is no anchor and comes last in ties.  Anchors
without a positive, and positives without a negative, give no rows.  An empty
table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import by_value, cut, read
from tierflow.llm.whitening import quantise

by_value(__name__)

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SHELF = 8192  # anchors of a cell
BLOCK = 4096  # rows of a list
STRIDE = 512  # rows of a list that are scored at once
MEMBERS = 64  # anchors of a cluster, on average
MAX_CLUSTERS = 1024
FIT_ROWS, FIT_BYTES = 16_384, 1 << 26
NO_ID = (1 << 63) - 1  # stands for a null id: last in ties


def unit(x):
    """Rows over their norms (a zero row stays) and the norms."""
    import numpy as np
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def angles(x, centroids):
    """Angle of every row of ``x`` to every centroid."""
    import numpy as np
    return np.arccos(np.clip(unit(x)[0] @ centroids.T, -1.0, 1.0))


def centroids_of(sample, clusters: int, rounds: int = 8, seed: int = 11):
    """Spherical k-means over a bounded sample."""
    x = unit(sample)[0]
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), size=min(clusters, len(x)), replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        length = np.sqrt((total * total).sum(axis=1))
        c = np.where(length[:, None] > 0, total / np.where(length > 0, length, 1)[:, None], c)
    return c


def bounds(x, norms, centroid, radius: float):
    """|x| cos(max(0, t - r)), a little raised so that rounding cannot cut a row off."""
    import numpy as np
    t = angles(x, centroid[None])[:, 0]
    b = norms * np.cos(np.maximum(0.0, t - radius))
    return b + 1e-7 * norms + 1e-9


def scores(u, x, exact: bool):
    """Inner products of all rows of ``u`` with all rows of ``x``, as longs."""
    import numpy as np
    if exact:
        return (u @ x.T).astype(np.int64)
    big = u.astype(object) @ x.astype(object).T
    return np.clip(big, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def keep_best(best_s, best_id, s, ids, ok):
    """Merge the scores ``s`` (anchors x rows) where ``ok`` into the best so far, by
    falling score, then smaller id.  Free places have the least long."""
    import numpy as np
    k = best_s.shape[1]
    useful = ok & (s >= best_s[:, -1:])
    columns = np.flatnonzero(useful.any(axis=0))
    rows = np.flatnonzero(useful.any(axis=1))
    if not len(columns):
        return
    least = np.iinfo(np.int64).min
    part = np.ix_(rows, columns)
    all_s = np.hstack([best_s[rows], np.where(useful[part], s[part], least)])
    all_id = np.hstack([best_id[rows], np.broadcast_to(ids[columns], (len(rows), len(columns)))])
    order = np.lexsort((all_id, ~all_s), axis=1)[:, :k]  # ~s falls as s rises, without overflow
    best_s[rows] = np.take_along_axis(all_s, order, axis=1)
    best_id[rows] = np.take_along_axis(all_id, order, axis=1)


class Shelf:
    """The anchors of a cell and the best rows found so far."""

    def __init__(self, table, centroids, radii, width, exact, wanted, low, high):
        import numpy as np
        self.low, self.high, self.exact, self.centroids, self.radii = low, high, exact, centroids, radii
        self.key = table["key"]
        cluster = np.array(table["cluster"])
        order = np.argsort(cluster, kind="stable")
        self.key = [table["key"][i] for i in order]
        self.ids = np.array(table["id"], dtype=np.int64)[order]
        self.labels = np.array(table["label"], dtype=object)[order]
        self.x = table["x"][order]
        self.norms = unit(self.x.astype(np.float64))[1]
        cluster = cluster[order]
        at = np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]]) if len(cluster) else []
        self.clusters = list(zip(cluster[at], at, np.r_[at[1:], len(cluster)], strict=True)) if len(cluster) else []
        # without positives' scores there is one list for each anchor, else one for each positive
        self.positive = None
        lists = 1
        if table["scores"][0] is not None:
            lists = max(map(len, table["scores"]))
            self.positive = np.full((len(order), lists), -1, dtype=np.int64)
            for row, i in enumerate(order):
                self.positive[row, :len(table["scores"][i])] = table["scores"][i]
        self.best_s = np.full((lists, len(order), wanted), np.iinfo(np.int64).min)
        self.best_id = np.full((lists, len(order), wanted), NO_ID)

    def need(self, lo, hi):
        """The least score that each of the anchors lo..hi can still use."""
        import numpy as np
        last = self.best_s[:, lo:hi, -1].astype(np.float64)
        if self.positive is None:
            return last[0]
        p = self.positive[lo:hi].T.astype(np.float64)
        # a window of a negative score is empty
        return np.where(p < 0, np.inf, np.maximum(last, np.floor(p * self.low / 100) - 1)).min(axis=0)

    def walk(self, ids, labels, x):
        """Let every cluster walk its list of the rows of one block."""
        import numpy as np
        real = x.astype(np.float64)
        norms = unit(real)[1]
        for cluster, lo, hi in self.clusters:
            bound = bounds(real, norms, self.centroids[cluster], self.radii[cluster])
            order = np.argsort(-bound, kind="stable")
            for start in range(0, len(order), STRIDE):
                reach = bound[order[start]] * self.norms[lo:hi]
                active = lo + np.flatnonzero(reach * (1 + 1e-9) + 1 >= self.need(lo, hi))
                if not len(active):  # certified: the bounds only fall from here
                    break
                rows = order[start:start + STRIDE]
                s = scores(self.x[active], x[rows], self.exact)
                same = self.labels[active][:, None] == labels[rows][None, :]
                if self.positive is None:
                    self._merge(0, active, s, ids[rows], same & (self.ids[active][:, None] != ids[rows][None, :]))
                    continue
                for j in range(len(self.best_s)):
                    p = self.positive[active, j][:, None]
                    if self.exact:
                        ok = (100 * s >= self.low * p) & (100 * s <= self.high * p)
                    else:
                        wide, q = s.astype(object), p.astype(object)
                        ok = ((100 * wide >= self.low * q) & (100 * wide <= self.high * q)).astype(bool)
                    self._merge(j, active, s, ids[rows], ok & (p >= 0) & ~same)

    def _merge(self, j, active, s, ids, ok):
        best_s, best_id = self.best_s[j][active], self.best_id[j][active]
        keep_best(best_s, best_id, s, ids, ok)
        self.best_s[j][active], self.best_id[j][active] = best_s, best_id

    def results(self):
        import numpy as np
        import pyarrow as pa
        j, a, k = np.nonzero(self.best_s > np.iinfo(np.int64).min)
        return pa.record_batch([
            pa.array([self.key[i] for i in a], pa.int64()), pa.array(self.ids[a]), pa.array(j.astype(np.int32)),
            pa.array(self.best_s[j, a, k]), pa.array(self.best_id[j, a, k])],
            names=["key", "anchor_id", "list", "score", "id"])


def _walk_cells(cells: DataFrame, centroids, radii, width: int, exact: bool, wanted: int) -> DataFrame:
    """``cells(shelf, slice, kind, key, id, label, x, cluster, scores)``, sorted with the
    anchors (kind 0) of each cell before its rows."""
    make, block, low, high = Shelf, BLOCK, LOW, HIGH

    def dense(column):
        import numpy as np
        flat = column.flatten().to_numpy(zero_copy_only=False)
        size = np.diff(column.offsets.to_numpy())
        if (size == width).all():
            x = flat.reshape(len(size), width)
        else:  # shorter vectors: zeros behind
            x = np.zeros((len(size), width), dtype=flat.dtype)
            x[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        return x.astype(np.float64) if exact else x.astype(np.int64)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        cell, shelf, anchors, rows, held = None, None, [], [], 0

        def flush():
            nonlocal shelf, rows, held
            if rows and anchors and shelf is None:
                table = {k: sum((a[k] for a in anchors), []) for k in ("key", "id", "label", "cluster", "scores")}
                table["x"] = np.vstack([a["x"] for a in anchors])
                shelf = make(table, centroids, radii, width, exact, wanted, low, high)
            if rows and shelf is not None:
                ids, labels, x = (np.concatenate(p) for p in zip(*rows, strict=True))
                for lo in range(0, len(ids), block):
                    shelf.walk(ids[lo:lo + block], labels[lo:lo + block], x[lo:lo + block])
            rows, held = [], 0

        for batch in batches:
            here = batch.column("shelf").to_numpy().astype(np.int64) * (1 << 32) + batch.column("slice").to_numpy()
            kind = batch.column("kind").to_numpy()
            edge = np.flatnonzero(np.r_[True, (here[1:] != here[:-1]) | (kind[1:] != kind[:-1])]) if len(here) else []
            for lo, hi in zip(edge, np.r_[edge[1:], len(here)].astype(int) if len(here) else [], strict=True):
                if here[lo] != cell:
                    flush()
                    if shelf is not None:
                        yield shelf.results()
                    cell, shelf, anchors = here[lo], None, []
                part = batch.slice(lo, hi - lo)
                x = dense(part.column("x"))
                if kind[lo] == 0:
                    anchors.append({"x": x, **{k: part.column(k).to_pylist() for k in ("key", "id", "label", "cluster", "scores")}})
                    continue
                rows.append((part.column("id").to_numpy(), np.array(part.column("label").to_pylist(), dtype=object), x))
                held += len(x)
                if held >= block:
                    flush()
        flush()
        if shelf is not None:
            yield shelf.results()

    sorted_cells = cells.repartition(F.col("shelf"), F.col("slice")).sortWithinPartitions("shelf", "slice", "kind")
    return sorted_cells.mapInArrow(run, "key long, anchor_id long, list int, score long, id long")


def _useful_shelves(rows: DataFrame, centroids, radii, need, norms, first, parts, width: int, shelves: int) -> DataFrame:
    """``rows`` with ``shelves``: those with a cluster whose bound reaches what any of its
    members needs.  ``need`` and ``norms``: least score and largest norm by cluster."""
    measure, names = angles, rows.columns
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", shelves array<int>"

    def run(batches):
        import numpy as np
        import pyarrow as pa
        table = np.zeros((len(first), shelves), dtype=bool)
        for c in range(len(first)):
            table[c, first[c]:first[c] + parts[c]] = True
        for b in batches:
            column = b.column("x")
            size = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.zeros((len(size), width))
            x[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
            length = np.sqrt((x * x).sum(axis=1))
            sent, ends = [], [0]
            for lo in range(0, len(x), 1024):
                t = measure(x[lo:lo + 1024], centroids)
                # a negative bound counts as zero: it is no bound for members of smaller norm
                share = np.maximum(np.cos(np.maximum(0.0, t - radii)), 0.0) + 1e-7
                reach = length[lo:lo + 1024, None] * share * norms + 1
                use = (reach * (1 + 1e-9) >= need) @ table
                r, s = np.nonzero(use)
                sent.append(s)
                ends.extend((ends[-1] + np.cumsum(use.sum(axis=1))).tolist())
            sent = np.concatenate(sent) if sent else np.zeros(0)
            yield pa.record_batch([*b.columns, pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(sent.astype(np.int32)))], names=[*names, "shelves"])

    return rows.mapInArrow(run, schema)


def mine(rows: DataFrame, every: int = 100) -> DataFrame:
    """``rows(id long, label, x array<long>)`` -> ``anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score``; anchors have an id divisible by
    ``every``."""
    spark = rows.sparkSession
    schema = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
              "negative_score long")
    is_anchor = F.col("id") % every == 0
    total, width, n_anchors, most = rows.agg(
        F.count("*"), F.max(F.size("x")), F.count_if(is_anchor),
        F.max(F.greatest(F.array_max("x"), -F.array_min("x")))).first()
    if not n_anchors:
        return spark.createDataFrame([], schema)
    width, most = width or 0, max(most or 0, 1)
    exact = 100 * most * most * max(width, 1) < 1 << 53
    if most < 1 << 31:
        rows = rows.withColumn("x", F.col("x").cast("array<int>"))
    key = F.xxhash64("label", "x")
    anchors = cut(rows.filter(is_anchor).select("id", "label", "x", key.alias("key")).distinct())

    # clusters: centroids from a bounded sample, then every anchor to its nearest
    dims = max(width, 1)
    sample = anchors.orderBy(F.xxhash64("id"), "key").limit(max(1, min(FIT_ROWS, FIT_BYTES // (8 * dims)))).select("x")
    fitted = np.zeros((n_anchors if n_anchors < FIT_ROWS else FIT_ROWS, dims))
    taken = 0
    for (x,) in sample.collect():
        fitted[taken, :len(x)] = x
        taken += 1
    centroids = centroids_of(fitted[:taken], min(MAX_CLUSTERS, -(-n_anchors // MEMBERS)))
    measure, names = angles, ["id", "label", "x", "key"]

    def nearest(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            x = np.zeros((len(b), dims))
            for i, v in enumerate(b.column("x").to_pylist()):
                x[i, :len(v)] = v
            t = measure(x, centroids)
            c = t.argmin(axis=1)
            yield pa.record_batch([*b.columns, pa.array(c.astype(np.int32)), pa.array(t[np.arange(len(x)), c]),
                                   pa.array(np.sqrt((x * x).sum(axis=1)))], names=[*names, "cluster", "angle", "norm"])

    kind_of_x = "int" if most < 1 << 31 else "bigint"
    label_type = rows.schema["label"].dataType.simpleString()
    anchors = cut(anchors.select(*names).mapInArrow(
        nearest, f"id long, label {label_type}, x array<{kind_of_x}>, key long, cluster int, angle double, norm double"))

    # shelves: clusters side by side; one larger than a shelf is split by id
    k = len(centroids)
    count, radii, norms = np.zeros(k, dtype=np.int64), np.zeros(k), np.zeros(k)
    for c, n, r, m in anchors.groupBy("cluster").agg(F.count("*"), F.max("angle"), F.max("norm")).collect():
        count[c], radii[c], norms[c] = n, r, m
    radii += 1e-9
    parts = np.maximum(1, -(-count // SHELF))
    first, shelf, room = np.zeros(k, dtype=np.int64), 0, SHELF
    for c in range(k):
        size = -(-int(count[c]) // int(parts[c]))
        if parts[c] > 1 or size > room:
            shelf, room = (shelf + 1 if room < SHELF else shelf), SHELF
        first[c] = shelf
        if parts[c] > 1:
            shelf, room = shelf + int(parts[c]), SHELF
        else:
            room -= size
    shelves = int((first + parts).max())
    at = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("cluster") + 1)
    anchors = anchors.withColumn("shelf", (at(first) + F.pmod(F.xxhash64("id"), at(parts))).cast("int"))

    tasks = 2 * spark.sparkContext.defaultParallelism
    slices = max(1, min(-(-total // BLOCK), -(-tasks // shelves)))
    id_or_last = F.coalesce("id", F.lit(NO_ID))
    candidates = rows.select(id_or_last.alias("id"), "label", "x",
                             F.pmod(F.xxhash64("id", "x"), F.lit(slices)).cast("int").alias("slice"))

    def cells(anchors, candidates):
        a = anchors.select("shelf", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
                           F.lit(0).alias("kind"), "key", "id", "label", "x", "cluster", "scores")
        null = lambda t: F.lit(None).cast(t)
        c = candidates.select(F.explode("shelves").alias("shelf"), "slice", F.lit(1).alias("kind"),
                              null("long").alias("key"), "id", "label", "x", null("int").alias("cluster"),
                              null("array<long>").alias("scores"))
        return a.unionByName(c)

    every_shelf = candidates.withColumn("shelves", F.sequence(F.lit(0), F.lit(shelves - 1)))
    found = _walk_cells(cells(anchors.withColumn("scores", F.lit(None).cast("array<long>")), every_shelf),
                        centroids, radii, dims, exact, POSITIVES)
    order = F.struct(F.bitwise_not("score").alias("down"), "id")
    positives = found.groupBy("key", "anchor_id").agg(
        F.slice(F.sort_array(F.collect_list(order)), 1, POSITIVES).alias("positives"))  # few from each slice
    ranked = cut(anchors.join(positives.withColumnRenamed("anchor_id", "id"), ["key", "id"]).withColumn(
        "scores", F.transform("positives", lambda p: F.bitwise_not(p["down"]))))

    # the least score that a cluster can use: of its least positive that is not negative
    least = F.array_min(F.filter("scores", lambda s: s >= 0))
    need = np.full(k, np.inf)
    for c, s in ranked.groupBy("cluster").agg(F.min(least)).collect():
        if s is not None:
            need[c] = np.floor(s * LOW / 100) - 1
    useful = _useful_shelves(candidates, centroids, radii, need, norms, first, parts, dims, shelves)
    found = _walk_cells(cells(ranked, useful), centroids, radii, dims, exact, NEGATIVES)
    negatives = found.groupBy("key", "anchor_id", "list").agg(
        F.slice(F.sort_array(F.collect_list(order)), 1, NEGATIVES).alias("negatives"))
    p = F.element_at("positives", F.col("list") + 1)
    out = negatives.join(ranked.select("key", F.col("id").alias("anchor_id"), "positives"), ["key", "anchor_id"])
    real = lambda c: F.when(c != NO_ID, c)
    return out.select("anchor_id", p.alias("p"), F.posexplode("negatives").alias("at", "n")).select(
        "anchor_id", real(F.col("p.id")).alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        real(F.col("n.id")).alias("negative_id"), F.bitwise_not("p.down").alias("positive_score"),
        F.bitwise_not("n.down").alias("negative_score"))


def labelled_rows(df: DataFrame, id_col: str, label_col: str, vec_col: str) -> DataFrame:
    """``id, label, x``: the rows that take part, with integer vectors."""
    part = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                     F.col(f"`{vec_col}`").alias("vector"))
    return quantise(part.filter(F.col("label").isNotNull()), "vector").select("id", "label", "x")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_rows(read(spark, sf_dir, "embeddings"), "vec_id", "label", "embedding")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved))


_SQL = f"""
WITH e AS (SELECT vec_id, label, embedding FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
l AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v FROM e),
a AS (SELECT DISTINCT vec_id, label, v FROM l WHERE vec_id % 100 = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = l.label AS same, l.vec_id AS id,
             list_dot_product(a.v, l.v)::BIGINT AS score
      FROM a JOIN l ON l.vec_id <> a.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {POSITIVES}),
n AS (SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
             row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
      FROM p JOIN s USING (anchor_id)
      WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= {NEGATIVES}
"""

QUERIES = {"op13_hard_negatives": op13_hard_negatives}
ORACLES = {"op13_hard_negatives": _SQL}
