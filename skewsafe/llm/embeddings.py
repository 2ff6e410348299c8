"""Operator 6: near-duplicate vectors by randomised-rotation binary codes.

1. Equal vectors are one class from here on (grouped by a digest, with map-side
   combine), so any number of exact copies is one row with a count.
2. An inverted file: centroids and hubs are fitted on a bounded sample
   (``SAMPLE`` classes, chosen by digest) and every class is assigned. A hub is a
   sample vector with many close neighbours. Classes within half the link angle
   of a hub are its ball: any two of them are linked by the triangle inequality,
   so their links are counted and never enumerated, however many they are.
   Other classes belong to the cell of their nearest centre.
3. Every class looks for partners in the ``PROBES`` nearest cells and in all cells
   whose centroid is within twice the link angle, however many they are: a partner
   that is within the link angle of its own centroid is met for certain, so a dense
   group over many cells is searched whole. (A ball is a cell; its own members
   skip it.) The visited side travels as the rotated
   vector, once; the visiting side as a code: the signs of its rotated
   coordinates, with the factor <code, vector> that corrects the estimate
   <code, q> / factor of the inner product to be unbiased. Cells are cut into
   blocks of bounded size, so a hot cell is many tasks.
4. The estimate's confidence bound (``EPSILON``) rules a pair out, or sends it to
   exact recomputation in double precision. Only pairs with an exact cosine of at
   least the threshold are links.

Recall is that of the probes for partners that are far from their centroid
(measured in the tests against brute force); precision is exact.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skewsafe.llm.common import staged
from skewsafe.llm.components import connected_components

THRESHOLD = 0.9
SAMPLE = 16_384
MAX_CELLS = 512
PER_CELL = 256
PROBES = 12
BLOCK = 8192
EPSILON = 3.0
#: A hub has at least this share of the sample (and HUB_MIN vectors) in its ball.
HUB_SHARE, HUB_MIN = 0.002, 8
SEED = 20


def unit_vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the list column as double unit vectors, all of one length; and their lengths."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    x = flat.reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True), x


def _digest(vector: str):
    """Digest and length of each vector; null for one that links with nothing."""

    @arrow_udf("struct<digest:binary,dim:int>")
    def digest(vectors: pa.Array) -> pa.Array:
        digests, dims = [], []
        for v in vectors:
            values = v.as_py()
            x = np.array(values if values and None not in values else [], dtype=np.float64)
            with np.errstate(over="ignore", invalid="ignore"):
                good = len(x) > 0 and np.isfinite(x).all() and 0 < np.linalg.norm(x) < np.inf
            digests.append(hashlib.blake2b((x + 0.0).tobytes(), digest_size=16).digest() if good else None)
            dims.append(len(x) if good else None)
        columns = [pa.array(digests, pa.binary()), pa.array(dims, pa.int32())]
        return pa.StructArray.from_arrays(columns, ["digest", "dim"])

    return digest(F.col(vector))


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(rotated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of rotated unit vectors and the factors <code, vector>."""
    signs = rotated >= 0
    return np.packbits(signs, axis=1), np.abs(rotated).sum(axis=1) / np.sqrt(rotated.shape[1])


def estimates(queries: np.ndarray, packed: np.ndarray, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of <query, vector>, and the half width of each vector's confidence bound."""
    dim = queries.shape[1]
    signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1
    raw = queries @ signs.T / np.sqrt(dim)
    width = EPSILON * np.sqrt(np.maximum(0, 1 - factors**2)) / factors / np.sqrt(max(1, dim - 1))
    return raw / factors.astype(np.float32), width


def fit_index(sample: np.ndarray, rows: int, threshold: float = THRESHOLD) -> tuple[np.ndarray, int]:
    """Centres (unit rows): centroids, then hubs; and how many are hubs."""
    close = np.cos(np.arccos(threshold) / 2) + 1e-9
    near = np.zeros(len(sample), dtype=np.int64)
    for a in range(0, len(sample), 1024):
        near[a:a + 1024] = (sample[a:a + 1024] @ sample.T >= close).sum(axis=1)
    hubs: list[int] = []
    free = near >= max(HUB_MIN, HUB_SHARE * len(sample))
    while free.any():
        hub = int(np.where(free, near, 0).argmax())
        hubs.append(hub)
        # Another hub of the same group would only split its ball.
        free &= sample @ sample[hub] < threshold
    count = int(np.clip(rows // PER_CELL, 1, min(MAX_CELLS, len(sample))))
    centroids = sample[np.random.default_rng(SEED).permutation(len(sample))[:count]]
    for _ in range(4):
        home = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centroids)
    return np.concatenate([centroids, sample[hubs]]), len(hubs)


def assign(unit: np.ndarray, centres: np.ndarray, hubs: int, threshold: float = THRESHOLD, probes: int = PROBES):
    """Home cell, whether it is a ball, and the probed cells of each unit vector (-1: none)."""
    plain = len(centres) - hubs
    similar = unit @ centres.T
    home, ball = similar[:, :plain].argmax(axis=1), np.zeros(len(unit), bool)
    if hubs:
        close = np.cos(np.arccos(threshold) / 2) + 1e-9  # the margin covers rounding
        best = similar[:, plain:].argmax(axis=1)
        ball = similar[np.arange(len(unit)), plain + best] >= close
        home = np.where(ball, plain + best, home)
    # The cells of the nearest centroids, all whose centroid is within twice the
    # link angle, and every ball that could hold a partner.
    k = min(probes, plain)
    nearest = np.argpartition(-similar[:, :plain], k - 1, axis=1)[:, :k]
    angle = np.arccos(threshold)
    reachable = np.empty(similar.shape, bool)
    reachable[:, :plain] = similar[:, :plain] >= np.cos(min(2 * angle, np.pi)) - 1e-9
    np.put_along_axis(reachable, nearest, True, axis=1)
    reachable[:, plain:] = similar[:, plain:] >= np.cos(1.5 * angle) - 1e-9
    reachable[ball, home[ball]] = False
    width = int(reachable.sum(axis=1).max(initial=0))
    order = np.argsort(~reachable, axis=1, kind="stable")[:, :width]
    return home, ball, np.where(np.take_along_axis(reachable, order, axis=1), order, -1)


def _assigned(classes: DataFrame, dim: int, centres: np.ndarray, hubs: int, threshold: float) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(centres)  # bounded by the sample

    def rows(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            unit, _ = unit_vectors(batch.column(1))
            home, ball, probed = assign(unit, shared.value, hubs, threshold)
            rotated = unit @ rotation(dim).T
            packed, factors = codes(rotated)
            raw = rotated.astype(np.float32)
            yield pa.RecordBatch.from_pydict(
                {
                    "cid": batch.column(0),
                    "home": pa.array(home, pa.int32()),
                    "ball": pa.array(ball),
                    "probes": pa.array([p[p >= 0] for p in probed.astype(np.int32)], pa.list_(pa.int32())),
                    "code": pa.array([c.tobytes() for c in packed], pa.binary()),
                    "factor": pa.array(factors),
                    "rotated": pa.array([r.tobytes() for r in raw], pa.binary()),
                }
            )

    return classes.select("cid", "embedding").mapInArrow(
        rows,
        "cid long, home int, ball boolean, probes array<int>, code binary, factor double, rotated binary",
    )


def _candidates(threshold: float):
    """Pairs of one block of a cell that the confidence bounds cannot rule out."""

    def pairs(block: pa.Table) -> pa.Table:
        base = block.filter(block["visits"].to_numpy() == 0)
        probe = block.filter(block["visits"].to_numpy() == 1)
        a, b = [], []
        if base.num_rows and probe.num_rows:
            queries = np.frombuffer(b"".join(base["rotated"].to_pylist()), np.float32).reshape(base.num_rows, -1)
            packed = np.frombuffer(b"".join(probe["code"].to_pylist()), np.uint8).reshape(probe.num_rows, -1)
            mine, theirs = base["cid"].to_numpy(), probe["cid"].to_numpy()
            factors = probe["factor"].to_numpy()
            for i in range(0, len(mine), 1024):
                about, width = estimates(queries[i:i + 1024], packed, factors)
                x, y = np.nonzero(about >= threshold - width)
                a.append(mine[i + x])
                b.append(theirs[y])
        x, y = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        other = x != y
        low, high = np.minimum(x, y)[other], np.maximum(x, y)[other]
        return pa.table({"a": pa.array(low, pa.int64()), "b": pa.array(high, pa.int64())})

    return pairs


def _exact(threshold: float):
    @arrow_udf("boolean")
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        if not len(left):
            return pa.array([], pa.bool_())
        _, x = unit_vectors(left)
        _, y = unit_vectors(right)
        cosine = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
        return pa.array(cosine >= threshold)

    return linked


def _blocks(assigned: DataFrame) -> DataFrame:
    """Rows of every (cell, base block, visitor block): at most about ``BLOCK`` of each kind."""
    spark = assigned.sparkSession
    # A row per cell (bounded): how many blocks its members and its visitors make.
    members = assigned.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("n")).collect()
    # Cells without members (a ball took them) are not visited.
    there = F.array_intersect("probes", F.lit([r["cell"] for r in members]).cast("array<int>"))
    probes = assigned.select("cid", F.explode(there).alias("cell"), "code", "factor")
    visitors = probes.groupBy("cell").agg(F.count("*").alias("n")).collect()
    guests = {r["cell"]: -(-r["n"] // BLOCK) for r in visitors}
    cells = spark.createDataFrame(
        [(r["cell"], -(-r["n"] // BLOCK), guests[r["cell"]]) for r in members if r["cell"] in guests],
        "cell int, nb long, np long",
    )
    number = F.xxhash64("cid")
    base = assigned.withColumnRenamed("home", "cell").join(F.broadcast(cells), "cell").select(
        "cell", F.pmod(number, "nb").alias("bi"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("np") - 1)).alias("bj"),
        F.lit(0).alias("visits"), "cid", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("double").alias("factor"),
        "rotated",
    )
    visiting = probes.join(F.broadcast(cells), "cell").select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("bi"), F.pmod(number, "np").alias("bj"),
        F.lit(1).alias("visits"), "cid", "code", "factor", F.lit(None).cast("binary").alias("rotated"),
    )
    return base.unionByName(visiting)


def class_links(classes: DataFrame, dim: int, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Links between classes (``cid, embedding`` of one length ``dim``).

    Returns the exact links ``a, b`` (``a < b``, each once) between classes that
    do not share a ball, and the ball members ``cid, ball``.
    """
    spark = classes.sparkSession
    rows = classes.count()
    sample = classes.select("digest", "embedding").orderBy("digest").limit(SAMPLE).select("embedding").collect()
    points = np.array([r["embedding"] for r in sample], dtype=np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centres, hubs = fit_index(points, rows, threshold)
    assigned = staged(_assigned(classes, dim, centres, hubs, threshold), "vector-cells")
    schema = "a long, b long"
    found = _blocks(assigned).groupBy("cell", "bi", "bj").applyInArrow(_candidates(threshold), schema=schema)
    left = classes.select(F.col("cid").alias("a"), F.col("embedding").alias("left"))
    right = classes.select(F.col("cid").alias("b"), F.col("embedding").alias("right"))
    balls = assigned.where("ball").select("cid", F.concat_ws("/", F.lit(dim), "home").alias("ball"))
    links = staged(
        staged(found.distinct(), "vector-candidates").join(left, "a").join(right, "b")
        .where(_exact(threshold)("left", "right")).select("a", "b"),
        "vector-links",
    )
    return links, balls


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row's ``vec_id, n_links, component_id, kept``.

    ``vectors`` has ``vec_id`` and ``embedding``. One output row per input row;
    equal vectors (also repeated rows) count as links of each other. A vector
    that is null, empty, zero or has null or non-finite components has no links
    and is its own component. Vectors of different lengths do not link. A null
    id is never kept, and its component is that of the other ids (null if none).
    An empty table gives no rows.
    """
    rows = staged(vectors.select("vec_id", "embedding", _digest("embedding").alias("d")).select("*", "d.*").drop("d"), "vectors")
    classes = staged(
        rows.where("digest is not null").groupBy("dim", "digest")
        .agg(F.first("embedding").alias("embedding"), F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "vector-classes",
    )
    dims = [r["dim"] for r in classes.select("dim").distinct().collect()]
    counted = classes.select("cid", "digest", "first_id", "copies")
    if not dims:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.col("vec_id").isNotNull().alias("kept"),
        )
    links, balls = None, None
    for dim in sorted(dims):
        found, members = class_links(classes.where(F.col("dim") == dim), dim, threshold)
        links = found if links is None else links.unionByName(found)
        balls = members if balls is None else balls.unionByName(members)
    # Links outside balls, by both ends; inside a ball everyone links with everyone.
    size = counted.select(F.col("cid").alias("other"), "copies")
    ends = links.select(F.col("a").alias("cid"), F.col("b").alias("other")).unionByName(
        links.select(F.col("b").alias("cid"), F.col("a").alias("other"))
    )
    outside = ends.join(size, "other").groupBy("cid").agg(F.sum("copies").alias("outside"))
    members = balls.join(counted.select("cid", "copies"), "cid")
    ball_sizes = members.groupBy("ball").agg(F.sum("copies").alias("inside"), F.min("cid").alias("center"))
    in_ball = staged(members.select("cid", "ball").join(ball_sizes, "ball").select("cid", "inside", "center"), "vector-balls")
    roots = connected_components(links.unionByName(in_ball.select(F.col("cid").alias("a"), F.col("center").alias("b"))))
    of = (
        counted.join(outside, "cid", "left").join(in_ball.select("cid", "inside"), "cid", "left")
        .join(staged(roots, "vector-roots").withColumnRenamed("node", "cid"), "cid", "left")
        .select(
            "digest", "first_id", F.coalesce("root", "cid").alias("root"),
            (F.coalesce("inside", "copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
        )
    )
    of = staged(of, "vector-components")
    least = of.groupBy("root").agg(F.min("first_id").alias("component_id"))
    found = of.join(least, "root").select("digest", "n_links", "component_id", F.lit(True).alias("_known"))
    component = F.when(F.col("_known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.select("vec_id", "digest").join(found, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
