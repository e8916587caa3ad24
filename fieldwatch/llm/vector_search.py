"""Exact largest inner products, searched in buckets of vectors of like length.

Vectors are dealt by decreasing length into even buckets, and searched in rounds of
``GROWTH`` times as many buckets as all rounds before. A query that knows its k-th best
score of the earlier rounds has a local threshold in each bucket: the cosine that a
vector as long as the bucket's longest needs to reach that score. Above 1 the bucket is
left out; from ``COORDINATE_FROM`` on, the query's largest coordinates bound those of
candidates; below it only vectors that are long enough are candidates. All candidates
are verified by their integer products. Queries go to buckets by shuffle, and a task
holds one bucket and some queries at a time, so neither side is broadcast.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.words import sorted_groups
from fieldwatch.session import materialise

SCALE = 1024
TOP = 10
#: Components in one bucket.
BUCKET_COMPONENTS = 1 << 19
#: A round searches so many times the buckets of all rounds before it.
GROWTH = 15
#: Spans of buckets in a round whose longest vector the driver knows.
SPANS = 64
#: Local cosine threshold from which coordinates tell more than lengths.
COORDINATE_FROM = 0.9
#: Coordinates of a query that bound those of candidates.
COORDINATES = 4
#: Bounds are loosened by this, far above the rounding of doubles.
SLACK = 1e-9
#: Queries that meet a bucket in one product.
QUERIES_AT_ONCE = 256
#: Stands for no threshold; own vectors lie below even this.
NONE, OWN = -(2**63) + 1, -(2**63)
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """``vec_id``, ``vector`` of whole numbers floor(scale * x) and its ``length``.

    Vectors that are null or hold a null or a non-finite component take no part, nor do
    rows without an id, which no result could name, and vectors whose products may pass
    64 bits (squared length from 2**62). Of rows that share an id the smallest vector
    counts.
    """
    scaled = F.transform("embedding", lambda x: x.cast("double") * F.lit(float(scale)))
    fits = F.forall("scaled", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float(2**31))))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("scaled"))
        .filter(F.col("vec_id").isNotNull() & F.coalesce(fits, F.lit(False)))
        .select("vec_id", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("vector"))
        .groupBy("vec_id")
        .agg(F.min("vector").alias("vector"))
        .withColumn("length", F.sqrt(squares))
        .filter(F.col("length") < F.lit(2.0**31))
    )


def matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Vectors as rows of equal width, filled up with zeros."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    rows = np.zeros((len(column), max(width, int(sizes.max(initial=0)))), dtype=np.int64)
    rows[np.arange(rows.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return rows


class Bucket:
    """Vectors by decreasing length, with the two ways to leave some of them out."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, vectors: np.ndarray):
        order = np.argsort(-lengths, kind="stable")
        self.ids, self.lengths, self.vectors = ids[order], lengths[order], vectors[order]
        self.longest = float(self.lengths[0])
        self.by_id = np.argsort(self.ids)
        self.sorted_ids = self.ids[self.by_id]
        self.as_floats: dict[type, np.ndarray] = {}
        self.coordinates: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.verified = 0

    def own_places(self, ids: np.ndarray) -> np.ndarray:
        """Where the vector with each id stands; -1 where it is elsewhere."""
        at = np.minimum(np.searchsorted(self.sorted_ids, ids), len(self.ids) - 1)
        return np.where(self.sorted_ids[at] == ids, self.by_id[at], -1)

    def long_enough(self, lengths: np.ndarray, floors: np.ndarray) -> np.ndarray:
        """How many of the vectors are long enough to reach each query's floor."""
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(floors > 0, floors / lengths, 0.0) * (1 - SLACK)
        return np.searchsorted(-self.lengths, -needed, side="right")

    def coordinate(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """One coordinate of all directions in order, and whose it is."""
        if place not in self.coordinates:
            values = self.vectors[:, place] / np.maximum(self.lengths, 1e-300)
            order = np.argsort(values, kind="stable")
            self.coordinates[place] = values[order], order
        return self.coordinates[place]

    def within(self, direction: np.ndarray, cosine: float) -> np.ndarray:
        """Vectors whose coordinates allow an angle to ``direction`` of that cosine.

        A direction within angle a of another has each coordinate between the cosines of
        that one's own angle to the axis plus and minus a.
        """
        angle = np.arccos(min(cosine, 1.0))
        ranges = []
        for place in np.argsort(-np.abs(direction))[:COORDINATES]:
            values, order = self.coordinate(int(place))
            axis = np.arccos(np.clip(direction[place], -1.0, 1.0))
            low = np.cos(min(axis + angle, np.pi)) - SLACK
            high = np.cos(max(axis - angle, 0.0)) + SLACK
            ranges.append(order[np.searchsorted(values, low) : np.searchsorted(values, high, "right")])
        ranges.sort(key=len)
        inside = ranges[0]
        for other in ranges[1:]:
            marked = np.zeros(len(self.ids), dtype=bool)
            marked[other] = True
            inside = inside[marked[inside]]
        return inside

    def products(self, queries: np.ndarray, longest: float, rows: slice | np.ndarray) -> np.ndarray:
        """Inner products, in the fastest numbers that hold all of them exactly.

        No sum on the way to a product is above the product of both lengths.
        """
        most = longest * self.longest * (1 + SLACK)
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
        if kind not in self.as_floats:
            self.as_floats[kind] = self.vectors.astype(kind)
        some = self.as_floats[kind][rows]
        self.verified += len(queries) * len(some)
        return queries.astype(kind) @ some.T

    def best(
        self, ids: np.ndarray, lengths: np.ndarray, queries: np.ndarray, floors: np.ndarray, top: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query places, vector places and scores that may be among each query's best."""
        with np.errstate(divide="ignore", invalid="ignore"):
            cosines = np.where(floors > 0, floors / (lengths * self.longest), 0.0) * (1 - SLACK)
        reach = self.long_enough(lengths, floors)
        own = self.own_places(ids)
        by_coordinate = (cosines >= COORDINATE_FROM) & (cosines <= 1)
        found = []
        for row in np.flatnonzero(by_coordinate):
            inside = self.within(queries[row] / lengths[row], float(cosines[row]))
            inside = inside[(inside < reach[row]) & (inside != own[row])]
            if len(inside):
                scores = self.products(queries[row : row + 1], lengths[row], inside)
                found.append(chosen(scores, floors[row : row + 1], top, np.array([row]), inside))
        rest = np.flatnonzero(~by_coordinate & (cosines <= 1) & (reach > 0))
        rest = rest[np.argsort(reach[rest], kind="stable")]
        for start in range(0, len(rest), QUERIES_AT_ONCE):
            rows = rest[start : start + QUERIES_AT_ONCE]
            some = slice(0, int(reach[rows].max()))
            scores = self.products(queries[rows], float(lengths[rows].max()), some)
            mine = np.flatnonzero((own[rows] >= 0) & (own[rows] < some.stop))
            scores[mine, own[rows][mine]] = OWN if scores.dtype.kind == "i" else -np.inf
            found.append(chosen(scores, floors[rows], top, rows, np.arange(some.stop)))
        if not found:
            return (np.empty(0, np.int64),) * 3
        rows, places, scores = (np.concatenate(part) for part in zip(*found, strict=True))
        order = np.lexsort((self.ids[places], -scores, rows))
        rows, places, scores = rows[order], places[order], scores[order]
        first = np.searchsorted(rows, rows)
        kept = np.arange(len(rows)) - first < top
        return rows[kept], places[kept], scores[kept]


def chosen(scores: np.ndarray, floors: np.ndarray, top: int, rows: np.ndarray, places: np.ndarray):
    """Scores not below a row's floor, nor below its ``top``-th best; ties all stay."""
    floors = floors.astype(scores.dtype)
    many = np.count_nonzero(scores >= floors[:, None], axis=1) > top
    if many.any():
        last = scores.shape[1] - top
        floors[many] = np.maximum(floors[many], np.partition(scores[many], last, axis=1)[:, last])
    row, place = np.nonzero(scores >= floors[:, None])
    return rows[row], places[place], scores[row, place].astype(np.int64)


def search_buckets(top: int):
    """Walk rows sorted by bucket, its vectors before the queries that it is asked."""

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members: list[pa.RecordBatch] = []
        bucket = None
        for new, batch in sorted_groups(batches, ["bucket", "asks"]):
            if not batch.column("asks")[0].as_py():
                if new:
                    members, bucket = [], None
                members.append(batch)
                continue
            if new and not members:
                raise ValueError("queries of a bucket without vectors")
            if bucket is None:
                whole = pa.Table.from_batches(members).combine_chunks().to_batches()[0]
                bucket = Bucket(
                    whole.column("id").to_numpy(), whole.column("length").to_numpy(), matrix(whole.column("vector"))
                )
            width = bucket.vectors.shape[1]
            ids = batch.column("id").to_numpy()
            rows, places, scores = bucket.best(
                ids,
                batch.column("length").to_numpy(),
                matrix(batch.column("vector"), width)[:, :width],
                batch.column("floor").to_numpy(),
                top,
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[rows]), pa.array(bucket.ids[places]), pa.array(scores)],
                ["query_id", "vec_id", "score"],
            )

    return search


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The ``top`` highest scores of each query, ties to smaller ids."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def rounds_of(buckets: int, growth: int = GROWTH) -> list[tuple[int, int]]:
    """Ranges of buckets, each ``growth`` times as long as all before it."""
    ranges, done = [], 0
    while done < buckets:
        until = min(buckets, max(1, done * (growth + 1)))
        ranges.append((done, until))
        done = until
    return ranges


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    top: int = TOP,
    scale: float = SCALE,
    bucket_components: int = BUCKET_COMPONENTS,
) -> DataFrame:
    """The ``top`` vectors of highest integer inner product with each query vector.

    Both tables have ``vec_id`` and ``embedding``; ``integer_vectors`` says what takes
    part. A vector with the query's id is the query's own and no candidate. Vectors of
    different sizes are compared as if the shorter were filled up with zeros. Returns
    ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``; fewer rows where there are
    fewer candidates, none for empty tables.
    """
    thin = integer_vectors(vectors, scale)
    asked = materialise(integer_vectors(queries, scale))
    rows, width = thin.agg(F.count("*"), F.max(F.size("vector"))).head()
    count = max(1, -(-rows // max(1, bucket_components // max(1, width or 1))))
    ranged = thin.repartitionByRange(count, F.desc("length"), "vec_id")
    dealt = materialise(ranged.withColumn("bucket", F.spark_partition_id()))
    spark = vectors.sparkSession
    most_tasks = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    best = spark.createDataFrame([], FOUND + ", rank int")
    for start, until in rounds_of(dealt.rdd.getNumPartitions()):
        here = dealt.filter((F.col("bucket") >= start) & (F.col("bucket") < until))
        span = -(-(until - start) // SPANS)
        spans = here.groupBy(F.floor((F.col("bucket") - start) / span).alias("span"))
        # At most SPANS numbers.
        longest = {int(at): length for at, length in spans.agg(F.max("length")).collect()}
        if not longest:
            continue
        bounds = [longest.get(i, 0.0) for i in range(max(longest) + 1)]
        floors = best.filter(F.col("rank") == top).select(
            F.col("query_id").alias("vec_id"), F.col("score").alias("floor")
        )
        met = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
        reached = F.size(
            F.filter(
                F.array(*map(F.lit, bounds)),
                lambda bound: (F.col("floor") <= 0) | (bound * F.col("length") * (1 + SLACK) >= F.col("floor")),
            )
        )
        last = F.least(F.lit(until), F.lit(start) + reached * span) - 1
        # Spans at the end may be empty, and so may buckets of a round.
        visits = met.filter(reached > 0).select(
            F.explode(F.sequence(F.lit(start), last)).alias("bucket"),
            F.lit(True).alias("asks"),
            F.col("vec_id").alias("id"),
            "length",
            "vector",
            "floor",
        )
        filled = here.select("bucket").distinct()
        held = here.select(
            "bucket", F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "length", "vector",
            F.lit(NONE).alias("floor"),
        )
        tasks = min(2 * (until - start), most_tasks)
        found = (
            held.unionByName(visits.join(filled, "bucket", "left_semi"))
            .repartition(tasks, "bucket")
            .sortWithinPartitions("bucket", "asks")
            .mapInArrow(search_buckets(top), FOUND)
        )
        best = materialise(ranked(best.drop("rank").unionByName(found), top))
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
