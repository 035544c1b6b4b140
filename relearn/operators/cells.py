"""Random forests grown on counts of binned rows (M3).

What a tree of MLlib learns from a row is the bins of its features and its label.  Rows that agree in these are one
cell, and of a few numeric features there are only so many cells, whatever the number of rows.  So the rows are read
a few times to find the bins and count the cells; the trees are then grown by MLlib on cells.

The bootstrap stays one of rows: MLlib draws for every row and tree a Poisson(1) number of copies, and the copies of a
cell of n rows are a Poisson(n) number, which is drawn here from a hash of the cell and the tree.  Each tree has a seed
and draws of its own, so a forest of fewer trees is the first part of one with more.
"""

from __future__ import annotations

import functools
import itertools
import math
import uuid
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, StorageLevel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relearn.operators.trees import with_thresholds
from relearn.session import ensure_checkpoint_dir

#: Most features of rows that are counted by cell; beyond, nearly every row is a cell of its own.
MAX_FEATURES = 16
#: Rows to a cell, on average, from which trees are grown on cells.
MIN_ROWS = 2
#: Quantiles that are kept of each partition of the rows, for each bin.
POINTS = 8
#: Cells to a task of a tree, and the tasks that draw their copies.
CELL_ROWS, FIRST_PARTS = 100_000, 32
#: Trees that are grown at a time.
TREES_AT_ONCE = 8


@dataclass
class Cells:
    """Counted rows ``(b0, b1, ..., label, n)``, the thresholds between each feature's bins, and the number of classes."""
    table: DataFrame
    thresholds: list[list[float]]
    size: int
    most: int
    classes: int

    def unpersist(self) -> None:
        self.table.unpersist()


@functools.lru_cache(maxsize=64)
def poisson_table(power: int) -> tuple[int, tuple[float, ...]]:
    """The least value k0 of Poisson(2^power) that counts, and P(X <= k) for k = k0, k0 + 1, ... up to 1."""
    mean = 2.0 ** power
    reach = 10 * math.sqrt(mean) + 20
    low, high = max(0, int(mean - reach)), int(mean + reach)
    chances = [math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(low, high + 1)]
    total = math.fsum(chances)
    sums = [s / total for s in itertools.accumulate(chances)]
    return low, tuple(s for i, s in enumerate(sums) if 0 < s < 1 and (i == 0 or s > sums[i - 1]))


def poisson_draws(df: DataFrame, n: str, most: int, keys: list[Column], out: str) -> DataFrame:
    """``df`` with a Poisson(n) draw for each row, fixed by ``keys``; n is a bigint of at most ``most``.

    The binary digits of n are drawn one by one: sums of independent Poisson numbers are Poisson numbers."""
    digits = range(max(1, most.bit_length()))
    name = f"__{uuid.uuid4().hex[:8]}_"
    bit = [F.shiftright(F.col(n), j).bitwiseAND(F.lit(1).cast("long")) for j in digits]
    uniform = [F.shiftrightunsigned(F.xxhash64(F.lit(j), *keys), 11) / F.lit(2.0 ** 53) for j in digits]
    wide = df.select("*", *[F.when(b == 1, u).otherwise(F.lit(-1.0)).alias(f"{name}{j}") for j, b, u in zip(digits, bit, uniform)])
    tables = [poisson_table(j) for j in digits]
    drawn = Bucketizer(splitsArray=[[-math.inf, *sums, math.inf] for _, sums in tables], inputCols=[f"{name}{j}" for j in digits],
                       outputCols=[f"{name}d{j}" for j in digits]).transform(wide)
    total = sum((b * (F.col(f"{name}d{j}").cast("long") + F.lit(low)) for j, b, (low, _) in zip(digits, bit, tables)), F.lit(0).cast("long"))
    return drawn.select(*df.columns, total.alias(out))


def _values(size: int) -> list[Column]:
    return [F.get(F.col("__x"), F.lit(i)).alias(f"v{i}") for i in range(size)]


def bin_thresholds(rows: DataFrame, features: str, size: int, max_bins: int) -> tuple[list[list[float]], int]:
    """Thresholds between each feature's bins, and the number of rows.

    The middles between its distinct values if there are at most ``max_bins``, else quantiles, which are values of rows.
    The quantiles are put together from those of the partitions, so equal rows in equal partitions have equal bins."""
    x = rows.select(vector_to_array(F.col(features)).alias("__x")).select(*_values(size))
    known = [F.when(~F.isnan(f"v{i}"), F.col(f"v{i}")) for i in range(size)]
    steps = POINTS * max_bins
    shares = F.array(*[F.lit((k + 0.5) / steps) for k in range(steps)])

    def of_parts(told: dict) -> list:                 # partitions x features x steps numbers
        """Of each partition its rows and what ``told`` says of features."""
        return x.groupBy(F.spark_partition_id().alias("part")).agg(
            F.count(F.lit(1)).alias("n"), *[F.struct(F.count(known[i]).alias("n"), v.alias("v")).alias(f"v{i}") for i, v in told.items()]).orderBy("part").collect()

    def points(i: int):
        return F.percentile_approx(known[i], shares, F.lit(4 * steps))
    head = x.limit(4 * max_bins).collect()            # saves work only: features that have many values here have them everywhere
    many = {i for i in range(size) if len({r[i] for r in head if r[i] == r[i]}) > max_bins}
    parts = of_parts({i: points(i) if i in many else F.approx_count_distinct(known[i]) for i in range(size)})
    told = {i: [p[f"v{i}"] for p in parts] for i in range(size)}
    few = {i for i in range(size) if i not in many and all(p.v <= 1.5 * max_bins for p in told[i])}
    if len(many) < size:
        again = of_parts({i: F.collect_set(known[i]) if i in few else points(i) for i in range(size) if i not in many})
        told |= {i: [p[f"v{i}"] for p in again] for i in range(size) if i not in many}
    wide = {i for i in few if len({v + 0.0 for p in told[i] for v in p.v}) > max_bins}
    if wide:
        again = of_parts({i: points(i) for i in wide})
        told |= {i: [p[f"v{i}"] for p in again] for i in wide}
    out = []
    for i in range(size):
        if i in few - wide:
            own = sorted({v + 0.0 for p in told[i] for v in p.v})
            out.append(sorted({(a + b) / 2 for a, b in itertools.pairwise(own)}))
            continue
        points_of = sorted((v, p.n / steps) for p in told[i] for v in p.v or [])
        ranks = list(itertools.accumulate(w for _, w in points_of))
        wanted, at = [], 0
        for k in range(1, max_bins):
            while at < len(points_of) - 1 and ranks[at] < ranks[-1] * k / max_bins:
                at += 1
            wanted.append(points_of[at][0])
        out.append(sorted(set(wanted)))
    return out, sum(p.n for p in parts)


def binned(rows: DataFrame, features: str, thresholds: list[list[float]], keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the bins ``b0, b1, ...`` of the features: a value is in the first bin whose threshold isn't under it.

    NaN is in the last bin, as MLlib sends it to the right."""
    size = len(thresholds)
    x = rows.select(*keep, vector_to_array(F.col(features)).alias("__x")).select(*keep, *_values(size))
    cut = [i for i, t in enumerate(thresholds) if t]
    if cut:
        x = Bucketizer(splitsArray=[[-math.inf, *[math.nextafter(t, math.inf) for t in thresholds[i]], math.inf] for i in cut],
                       inputCols=[f"v{i}" for i in cut], outputCols=[f"w{i}" for i in cut], handleInvalid="keep").transform(x)
    return x.select(*keep, *[F.least(F.col(f"w{i}").cast("int"), F.lit(len(t))).alias(f"b{i}") if t else F.lit(0).alias(f"b{i}") for i, t in enumerate(thresholds)])


def counted(rows: DataFrame, features: str, thresholds: list[list[float]], label: str) -> DataFrame:
    """``(b0, b1, ..., label, n)``: rows by bins and label."""
    names = [f"b{i}" for i in range(len(thresholds))]
    return binned(rows, features, thresholds, [label]).groupBy(*names, label).agg(F.count(F.lit(1)).alias("n"))


def cell_key(size: int, label: str) -> Column:
    """A hash of a cell's bins and label."""
    return F.xxhash64(*[F.col(f"b{i}") for i in range(size)], F.col(label))


def cell_rows(rows: DataFrame, features: str, thresholds: list[list[float]], label: str) -> DataFrame:
    """One row ``(features, label, n)`` per cell of ``rows``; a tree with these thresholds says of it what it says of the cell's rows."""
    ends = [[*t, math.nextafter(t[-1], math.inf)] if t else [0.0] for t in thresholds]
    value = [F.get(F.array(*[F.lit(v) for v in e]), F.col(f"b{i}")) for i, e in enumerate(ends)]
    return counted(rows, features, thresholds, label).select(array_to_vector(F.array(*value)).alias(features), label, "n")


def joined_trees(trees: list, like, count: int, features: int, classes: int) -> RandomForestClassificationModel:
    """A forest of ``count`` of MLlib's fitted trees with the parameters of ``like``."""
    sc = SparkContext._active_spark_context          # threads of a pool have no active session
    ml = sc._jvm.org.apache.spark.ml.classification
    array = sc._gateway.new_array(ml.DecisionTreeClassificationModel, count)
    for i in range(count):
        array[i] = trees[i]._java_obj
    model = RandomForestClassificationModel(ml.RandomForestClassificationModel(f"RandomForestClassifier_{uuid.uuid4().hex[:12]}", array, features, classes))
    like._copyValues(model, {like.numTrees: count})
    model._transfer_params_to_java()
    return model


def first_trees(model: RandomForestClassificationModel, count: int) -> RandomForestClassificationModel:
    """The forest of the first ``count`` trees."""
    return model if count == model.getNumTrees else joined_trees(model.trees, model, count, model.numFeatures, model.numClasses)


class CellForestClassifier(RandomForestClassifier):
    """``RandomForestClassifier`` whose trees are grown on counted cells where that is the same job; else MLlib's own fit.

    Not on cells: rows with weights, subsamples, categorical features, leaves with a least number of rows, many
    features, and rows that nearly all have a cell of their own."""

    def cells(self, rows: DataFrame) -> Cells | None:
        """The cells of the training rows, cached; None if trees aren't grown on cells.  The caller unpersists."""
        features, label = self.getFeaturesCol(), self.getLabelCol()
        attributes = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
        if (self.isDefined(self.weightCol) and self.getWeightCol() or not self.getBootstrap() or self.getSubsamplingRate() != 1.0
                or self.getMinInstancesPerNode() > 1 or {"nominal", "binary"} & set(attributes)):
            return None
        first = rows.select(features).first()
        if first is None or not 1 <= first[0].size <= MAX_FEATURES:
            return None
        thresholds, number = bin_thresholds(rows, features, first[0].size, self.getMaxBins())
        table = counted(rows, features, thresholds, label).persist(StorageLevel.MEMORY_AND_DISK)
        told = table.agg(F.count(F.lit(1)).alias("cells"), F.max("n").alias("most"), F.max(label).alias("top"), F.min(label).alias("low"),
                         F.count_if(F.col(label).isNull() | F.isnan(F.col(label).cast("double")) | (F.col(label) % 1 != 0)).alias("odd")).first()
        if told.cells * MIN_ROWS > number or told.odd or told.low < 0 or told.top < 1 or told.top >= 100:
            table.unpersist()
            return None
        return Cells(table, thresholds, told.cells, told.most, int(told.top) + 1)

    def grow(self, cells: Cells) -> RandomForestClassificationModel:
        """The forest of the cells' rows."""
        label, names, spark = self.getLabelCol(), [f"b{i}" for i in range(len(cells.thresholds))], cells.table.sparkSession
        strategy = self.getFeatureSubsetStrategy()
        if strategy == "auto":
            strategy = "all" if self.getNumTrees() == 1 else "sqrt"
        marked = F.col(label).cast("double").alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": cells.classes}})
        numbers = spark.range(self.getNumTrees()).select(F.col("id").cast("int").alias("tree"))
        keyed = cells.table.repartition(FIRST_PARTS).select(*names, label, "n", cell_key(len(names), label).alias("key")).crossJoin(F.broadcast(numbers))     # a few dozen trees
        drawn = poisson_draws(keyed, "n", cells.most, [F.lit(self.getSeed()), F.col("tree"), F.col("key")], "copies")
        drawn = VectorAssembler(inputCols=names, outputCol="bins").transform(drawn).select("tree", "bins", marked, F.col("copies").cast("double").alias("copies"))
        drawn = drawn.repartition(self.getNumTrees(), "tree").sortWithinPartitions("tree").persist(StorageLevel.MEMORY_AND_DISK)
        parts = max(1, -(-cells.size // CELL_ROWS))
        params = {"impurity": self.getImpurity(), "maxDepth": self.getMaxDepth(), "minInfoGain": self.getMinInfoGain(), "maxMemoryInMB": self.getMaxMemoryInMB(),
                  "minWeightFractionPerNode": self.getMinWeightFractionPerNode(), "cacheNodeIds": self.getCacheNodeIds(), "checkpointInterval": self.getCheckpointInterval()}
        # MLlib looks for bins in maxBins^2 rows; they are to be found in all cells
        params["maxBins"] = max(self.getMaxBins(), math.isqrt(cells.size) + 1)

        def tree(number: int):
            own = drawn.where((F.col("tree") == number) & (F.col("copies") > 0)).drop("tree").coalesce(parts)
            one = RandomForestClassifier(featuresCol="bins", labelCol="label", weightCol="copies", numTrees=1, bootstrap=False, featureSubsetStrategy=strategy,
                                         seed=self.getSeed() * 1_000_003 + number, **params).fit(own)
            return one.trees[0]
        try:
            drawn.count()
            with ThreadPool(min(TREES_AT_ONCE, self.getNumTrees())) as pool:
                grown = pool.map(tree, range(self.getNumTrees()), chunksize=1)
        finally:
            drawn.unpersist()
        ensure_checkpoint_dir(spark)
        return with_thresholds(joined_trees(grown, self, len(grown), len(names), cells.classes), spark, cells.thresholds)

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        cells = self.cells(dataset)
        if cells is None:
            return super()._fit(dataset)
        try:
            return self.grow(cells)
        finally:
            cells.unpersist()
