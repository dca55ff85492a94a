"""Zone clusters, feature selection and fare models on MLlib."""

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.operators.sinks import publish
from tripmart.plans.warehouse import Warehouse
from tripmart.storage import file_bytes

# Model inputs in the order of the feature vector, and what is predicted.
LABEL = "total_amount"
FEATURES = [
    "vendor_id",
    "pu_location_id",
    "do_location_id",
    "ratecode_id",
    "payment_id",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "pick_hour",
    "pick_weekday_id",
    "drop_hour",
    "drop_weekday_id",
]
SEED = 42
# Cluster and model settings.
CLUSTERS = 5
REG_PARAM = 0.01
FOREST_TREES = 50
FOREST_DEPTH = 7
# Bytes that a forest's fit holds of a training row in memory: bins and bags once, nodes of up to three levels.
FOREST_ROW_BYTES = 4 * (len(FEATURES) + FOREST_TREES) + 100
FOREST_NODE_BYTES = 3 * (4 * FOREST_TREES + 20)
# Few rows need not be counted: a row takes some 14 bytes or more in its files; if less, nodes may go to disk.
LEAST_STORED_BYTES = 8
# Zones are dealt to this many ordered partitions by a hash of their id.
ZONE_PARTITIONS = 8


def trip_features(warehouse: Warehouse, year: int | None = None) -> DataFrame:
    """Label and features of the facts of one year, or of all.

    The year selects partitions of the fact; its calendar columns replace the join.
    """
    facts = warehouse.fact_with_calendar()
    if year is not None:
        facts = facts.filter(F.col("pick_year") == year)
    return facts.select("trip_id", "datetimestamp_id", LABEL, *FEATURES)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def standardise(df: DataFrame, column: str = "features", output: str = "scaledFeatures") -> DataFrame:
    """Shift and scale each feature to mean zero and unit sample deviation."""
    scaler = StandardScaler(inputCol=column, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(df).transform(df)


def cluster_zones(dim_location: DataFrame, side: str) -> DataFrame:
    """K-means cluster of every zone by its standardised coordinates.

    The start centres depend on the order of rows. A zone's id alone decides its partition
    and its place there, however the lookup is stored and however long it is.
    """
    key = dim_location.columns[0]
    x, y = f"{side}_x", f"{side}_y"
    zones = dim_location.withColumnsRenamed({"X": x, "Y": y})
    zones = zones.repartition(ZONE_PARTITIONS, key).sortWithinPartitions(key)
    scaled = standardise(assemble(zones, [x, y]))
    kmeans = KMeans(
        k=CLUSTERS, seed=SEED, featuresCol="scaledFeatures", predictionCol="cluster"
    )
    clustered = kmeans.fit(scaled).transform(scaled)
    return clustered.select(key, x, y, "zone", "borough", "service_zone", "cluster")


def label_correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of every feature with the label, one row per feature."""
    row = df.agg(*(F.corr(LABEL, name).alias(name) for name in FEATURES))
    return row.unpivot([], FEATURES, "feature", "corr")


def correlation_matrix(df: DataFrame) -> DataFrame:
    """Pearson correlation of every pair of label and features, one row per cell.

    Only the finished matrix reaches the driver, whose size is that of the feature list.
    """
    columns = [LABEL, *FEATURES]
    vectors = assemble(df.select(*columns), columns).select("features")
    matrix = Correlation.corr(vectors, "features").head()[0].toArray()
    cells = [
        (left, right, float(matrix[i, j]))
        for i, left in enumerate(columns)
        for j, right in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(cells, "feature string, other string, corr double")


def in_training(key: str) -> Column:
    """Whether a row belongs to the training share of about 80 %, by a hash of its key.

    The share of a row never changes, unlike that of a random split.
    """
    return F.substring(F.md5(F.col(key).cast("string")), 1, 2) < "cc"


def split(df: DataFrame, key: str = "trip_id") -> tuple[DataFrame, DataFrame]:
    return df.filter(in_training(key)), df.filter(~in_training(key))


def fit_linear(train: DataFrame) -> Model:
    return LinearRegression(featuresCol="features", labelCol=LABEL, regParam=REG_PARAM).fit(train)


def fit_tree(train: DataFrame) -> Model:
    return DecisionTreeRegressor(featuresCol="features", labelCol=LABEL, seed=SEED).fit(train)


def cache_bytes(spark: SparkSession) -> int:
    """Memory that executors have left for cached rows; on a local master the driver's."""
    scala = spark._jvm.scala.jdk.javaapi.CollectionConverters
    managers = scala.asJava(spark.sparkContext._jsc.sc().getExecutorMemoryStatus())
    left = [managers[name]._2() for name in managers]
    if not spark.sparkContext.master.startswith("local["):  # the driver is among them and holds no rows
        driver = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
        left = [managers[name]._2() for name in managers if name != driver]
    return sum(left)


def nodes_fit(train: DataFrame) -> bool:
    """Whether a forest's fit has room in memory for its rows with their nodes; counts them unless their files are small."""
    most = cache_bytes(train.sparkSession) // (FOREST_ROW_BYTES + FOREST_NODE_BYTES)
    files = train.inputFiles()
    if files and file_bytes(train.sparkSession, files) // LEAST_STORED_BYTES <= most:
        return True
    return train.count() <= most


def fit_forest(train: DataFrame) -> Model:
    """Rows keep the nodes they are in while that fits in memory; the trees are the same either way.

    Without kept nodes each level walks every tree from its root for every row. Nodes that do not fit would go
    to disk anew for each level, several times what else the fit keeps, and take as long to read.
    """
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=LABEL,
        numTrees=FOREST_TREES,
        maxDepth=FOREST_DEPTH,
        seed=SEED,
        cacheNodeIds=nodes_fit(train),
    )
    return forest.fit(train)


def cluster_certificate(clustered: DataFrame) -> DataFrame:
    """Whether each zone of ``cluster_zones`` lies nearest to the centre of its own cluster.

    Centres are the means of the standardised coordinates of their members; there are CLUSTERS at most.
    """
    key, *axes = clustered.columns[:3]
    row = clustered.agg(*(f(a).alias(f"{f.__name__}_{a}") for a in axes for f in (F.avg, F.stddev_samp))).first()
    scaled = clustered.withColumns(
        {a: (F.col(a) - row[f"avg_{a}"]) / row[f"stddev_samp_{a}"] for a in axes}
    )
    centres = scaled.groupBy("cluster").agg(*(F.avg(a).alias(a) for a in axes)).collect()

    def distance(centre) -> Column:
        return sum(((F.col(a) - centre[a]) ** 2 for a in axes), F.lit(0.0))

    own = F.lit(None).cast("double")
    for centre in centres:
        own = F.when(F.col("cluster") == centre["cluster"], distance(centre)).otherwise(own)
    nearest = F.array_min(F.array(*(distance(centre) for centre in centres)))
    return scaled.select(key, (own <= nearest + 1e-9).alias("nearest"))


def linear_certificate(features: DataFrame) -> DataFrame:
    """Whether the linear model meets the normal equation of each feature on its training rows.

    At the least penalised squares the covariance of a feature with the error equals the
    penalty's slope; both are compared as a share of the spreads of feature and label.
    """
    train, _ = split(features)
    model = fit_linear(train)
    error = F.col(LABEL) - F.col("prediction")
    spread = F.stddev_pop(LABEL)
    sums = [
        ((F.covar_pop(name, error) - REG_PARAM / spread * float(slope) * F.var_pop(name))
         / F.greatest(F.stddev_pop(name) * spread, F.lit(1e-12))).alias(name)
        for name, slope in zip(FEATURES, model.coefficients)
    ]
    row = model.transform(train).agg(*sums)
    return row.unpivot([], FEATURES, "feature", "rest").select(
        "feature", (F.abs("rest") < 1e-6).alias("optimal")
    )


def tree_certificate(features: DataFrame) -> DataFrame:
    """Whether the tree predicts the mean of each leaf's training rows, and how many rows those are.

    Rows of a leaf have one prediction; leaves that predict the same have the same mean.
    """
    train, _ = split(features)
    leaves = fit_tree(train).transform(train).groupBy("prediction").agg(
        F.avg(LABEL).alias("mean"), F.count("*").alias("rows")
    )
    off = F.abs(F.col("mean") - F.col("prediction")) / F.greatest(F.abs("mean"), F.lit(1.0))
    return leaves.agg(
        F.lit("Decision Tree").alias("name"),
        (F.max(off) < 1e-9).alias("leaves_are_means"),
        F.sum("rows").alias("rows"),
    )


def forest_certificate(features: DataFrame) -> DataFrame:
    """Whether the forest predicts the mean of its trees on every test row, and how many rows those are.

    Every tree predicts every row in the same pass. What a tree predicts is a mean of training
    labels, so it lies between the least and the largest of them.
    """
    train, test = split(features)
    model = fit_forest(train)
    low, high = train.agg(F.min(LABEL), F.max(LABEL)).first()
    predicted = model.transform(test)
    names = [f"tree_{number}" for number in range(len(model.trees))]
    for name, tree in zip(names, model.trees):
        predicted = tree.setPredictionCol(name).transform(predicted)
    trees = F.array(*names)
    mean = F.aggregate(trees, F.lit(0.0), lambda total, one: total + one) / len(names)
    off = F.abs(F.col("prediction") - mean) / F.greatest(F.abs(mean), F.lit(1.0))
    inside = (F.array_min(trees) >= low - 1e-9) & (F.array_max(trees) <= high + 1e-9)
    return predicted.agg(
        F.lit("Random Forest").alias("name"),
        F.lit(len(names)).alias("trees"),
        F.bool_and(off < 1e-9).alias("mean_of_trees"),
        F.bool_and(inside).alias("within_labels"),
        F.count("*").alias("rows"),
    )


def evaluation_certificate(features: DataFrame, scores: DataFrame) -> DataFrame:
    """Whether the scores of each model are of the test rows and agree with each other.

    The mean square error is the share of the label's variance that R2 leaves over, and the mean
    absolute error is never above its root. ``label_spread`` is the deviation of the test rows' labels.
    """
    _, test = split(features)
    variance, rows = test.agg(F.var_pop(LABEL), F.count("*")).first()
    left = (1 - F.col("r2")) * variance
    return scores.select(
        "name",
        F.lit(rows).cast("long").alias("rows"),
        F.round(F.sqrt(F.lit(variance)), 4).alias("label_spread"),
        (F.abs(F.col("rmse") * F.col("rmse") - left) <= 1e-9 * variance).alias("r2_agrees"),
        (F.col("mae") <= F.col("rmse")).alias("mae_below_rmse"),
        (F.col("r2") > 0).alias("better_than_mean"),
    )


# Names of the models in the score table.
MODELS = {
    "Linear Regression": fit_linear,
    "Decision Tree": fit_tree,
    "Random Forest": fit_forest,
}


def regression_metrics(predictions: DataFrame, name: str, prediction: str = "prediction") -> DataFrame:
    """Name, root mean square error, mean absolute error and R2 of predictions, in one pass."""
    label = F.col(LABEL)
    error = label - F.col(prediction)
    squared = F.avg(error * error)
    return predictions.agg(
        F.lit(name).alias("name"),
        F.sqrt(squared).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - squared / F.var_pop(label)).alias("r2"),
    )


def score_model(features: DataFrame, name: str) -> DataFrame:
    """Train a model on the training share of assembled features and score it on the rest."""
    train, test = split(features)
    return regression_metrics(MODELS[name](train).transform(test), name)


def publish_scores(features: DataFrame, area: str, table: str = "model_evaluation") -> None:
    """Score all models and replace the table by their rows in one write."""
    publish(reduce(DataFrame.unionByName, (score_model(features, name) for name in MODELS)), area, table)
