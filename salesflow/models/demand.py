"""Demand model: a forest on log boxes, calibrated, evaluated and explained.

Zone, region and month are indexed. Client and product have more labels than a tree can branch on
or a driver should hold, so they enter as the smoothed mean of the target over their other rows,
kept as a table and looked up by label. Which column is treated how depends on its name alone.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesflow.functions import log_target
from salesflow.names import ENCODED, INDEXED, MAX_BINS, NUMERIC, PIECES_PER_BOX
from salesflow.operators.aggregates import bias_factor, error_metrics
from salesflow.operators.joins import lookup_join
from salesflow.operators.ranking import split, split_by_hash
from salesflow.session import path_exists, stage
from salesflow.sources.pointers import POINTERS, current_state, folder_names, publish_state, remove_folder

LABEL = "Log_Venta"
TARGET = "Venta_Cajas"
ALL_ROWS = -1  # the fold that stands for all of them
LOOKUP_BYTES = 64  # of a label's row in a lookup, beside its text
UNITS = 1_000_000  # targets are added as whole millionths, so that the order of tasks does not matter


def with_log_target(df: DataFrame) -> DataFrame:
    return df.withColumn(LABEL, log_target(TARGET))


def training_frame(df: DataFrame, stable: bool = True, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the training table with its log target, 80/20.

    ``stable`` splits by a hash of the row instead of at random.
    """
    df = with_log_target(df)
    if stable:
        return split_by_hash(df)
    train, test = split(df, (0.8, 0.2), seed)
    return train, test


# --- encoding by the target -------------------------------------------------

def fold_of(df: DataFrame, folds: int = 5) -> Column:
    """A stable fold of each row; equal rows share one."""
    return F.pmod(F.xxhash64(F.lit("fold"), *[f"`{c}`" for c in df.columns]), F.lit(folds)).cast("int")


def _encoding_cells(df: DataFrame, columns: list[str], target: str, **folds: Column) -> DataFrame:
    """Sum (in whole millionths) and number of the targets per ``column``, ``label`` and fold columns; written."""
    labels = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label"))
                                for c in columns]))
    rows = df.select(F.round(F.col(target) * UNITS).cast("bigint").alias("units"),
                     *[fold.alias(name) for name, fold in folds.items()], labels)
    return stage(rows.groupBy("column", "label", *folds).agg(
        F.coalesce(F.sum("units"), F.lit(0)).alias("units"), F.count("units").alias("n")), "encoding_cells")


def _means_by_label(cells: DataFrame, searches: list[int], smoothing: float) -> DataFrame:
    """(``column``, ``label``, ``means``), a row for every label and one without: an array of structs ``fold``, ``n``, ``value``,
    whose last two hold the rows a mean is of and the mean for every one of ``searches``, null where it has no such rows.

    A search leaves out the cells with its number in ``outer``, ``ALL_ROWS`` none. All searches are summed at once and lie side
    by side, so the cells move once, by label, and are not repeated.
    """
    def sums(what: str) -> list[Column]:
        return [F.sum(F.when(F.lit(True) if s == ALL_ROWS else F.col("outer") != s, F.col(c))).alias(f"{c}{i}_{what}")
                for i, s in enumerate(searches) for c in ("units", "n")]

    def entry(fold: Column, n: list[Column], value: list[Column]) -> Column:
        return F.struct(fold.alias("fold"), F.array(*n).alias("n"), F.array(*value).alias("value"))

    each = range(len(searches))
    both = [f"{c}{i}_" for i in each for c in ("units", "n")]
    overall = cells.groupBy("column").agg(*sums("overall"))  # one row a column
    mean = [F.try_divide(F.col(f"units{i}_overall"), F.col(f"n{i}_overall") * UNITS) for i in each]
    means = overall.select("column", *[m.alias(f"mean{i}") for i, m in enumerate(mean)])
    own = F.struct("fold", *[f"{c}own" for c in both])  # as many for a label as there are folds
    none = F.struct(F.lit(ALL_ROWS).alias("fold"), *[F.lit(0).cast("bigint").alias(f"{c}own") for c in both])
    labels = (cells.where("label IS NOT NULL").repartition("column", "label").groupBy("column", "label", "fold").agg(*sums("own"))
              .groupBy("column", "label").agg(*[F.sum(f"{c}own").alias(f"{c}all") for c in both],
                                              F.array_append(F.collect_list(own), none).alias("own")))

    def left(cell: Column) -> Column:
        n = [F.col(f"n{i}_all") - cell[f"n{i}_own"] for i in each]
        value = [((F.col(f"units{i}_all") - cell[f"units{i}_own"]) / UNITS + F.col(f"mean{i}") * smoothing) / (n[i] + smoothing)
                 for i in each]
        return entry(cell["fold"], n, value)

    seen = labels.join(F.broadcast(means), ["column"]).select("column", "label", F.transform("own", left).alias("means"))
    unseen = overall.select("column", F.lit(None).cast("string").alias("label"), F.array(
        entry(F.lit(ALL_ROWS), [F.col(f"n{i}_overall") for i in each], mean)).alias("means"))
    return seen.unionByName(unseen)


def _means_by_row(means: DataFrame, searches: list[int]) -> DataFrame:
    """``_means_by_label`` as rows: ``held_out``, ``column``, ``label``, ``fold``, ``n``, ``value``."""
    by_fold = means.select("column", "label", F.inline("means"))
    by_search = F.inline(F.array(*[F.struct(F.lit(s).alias("held_out"), F.col("n")[i].alias("n"), F.col("value")[i].alias("value"))
                                   for i, s in enumerate(searches)]))
    return by_fold.select("column", "label", "fold", by_search).where("n IS NOT NULL").select(
        "held_out", "column", "label", "fold", "n", "value")


def target_encoding(df: DataFrame, columns: list[str], target: str, fold: Column,
                    smoothing: float = 20.0) -> DataFrame:
    """(``column``, ``label``, ``fold``, ``value``): smoothed mean of the target per label.

    A row with a fold holds the mean over the label's rows in all other folds, for training;
    fold -1 the mean over all its rows, for everything else. Means are drawn towards the overall
    mean as by ``smoothing`` rows of it; that mean is the row without a label, for unseen ones.
    """
    means = _means_by_label(_encoding_cells(df, columns, target, fold=fold), [ALL_ROWS], smoothing)
    return _means_by_row(means, [ALL_ROWS]).drop("held_out", "n")


def nested_encoding(df: DataFrame, columns: list[str], target: str, outer: Column, fold: Column, folds: int,
                    smoothing: float = 20.0) -> DataFrame:
    """(``held_out``, ``column``, ``label``, ``fold``, ``n``, ``value``): the encodings that a search needs.

    For each of the ``folds`` values of ``outer`` held out, those of ``target_encoding`` over all other rows: no target
    of a held-out row is in them, and none of a training row's own ``fold``. All come from one pass over the rows.
    """
    searches = list(range(folds))
    return _means_by_row(_nested_means(df, columns, target, outer, fold, searches, smoothing), searches)


def _nested_means(df: DataFrame, columns: list[str], target: str, outer: Column, fold: Column, searches: list[int],
                  smoothing: float = 20.0) -> DataFrame:
    return _means_by_label(_encoding_cells(df, columns, target, outer=outer, fold=fold), searches, smoothing)


def mean_column(column: str) -> str:
    return f"{column}_Media"


def encode(df: DataFrame, encodings: DataFrame, columns: list[str] = ENCODED,
           fold: Column | None = None) -> DataFrame:
    """``df`` with the encoding of every column, out of fold where ``fold`` is given.

    The table holds all columns' labels; those of each are measured, so a column with few is broadcast whatever the others have.
    """
    wanted = F.col("label").isNotNull() & (F.lit(True) if fold is not None else F.col("fold") == ALL_ROWS)
    known = {r["column"]: r for r in encodings.groupBy("column").agg(  # one row a column
        F.max(F.when(F.col("label").isNull(), F.col("value"))).alias("mean"),
        F.sum(F.when(wanted, F.octet_length("label") + LOOKUP_BYTES)).alias("bytes")).collect()}
    df = df.withColumn("_fold", F.lit(ALL_ROWS) if fold is None else fold)
    for c in columns:
        own = encodings.where((F.col("column") == c) & F.col("label").isNotNull())
        if fold is None:
            own = own.where(F.col("fold") == ALL_ROWS)
        lookup = own.select(F.col("label").alias("_label"), F.col("fold").alias("_fold"),
                            F.col("value").alias(mean_column(c)))
        mean, size = (known[c]["mean"], known[c]["bytes"]) if c in known else (None, None)
        df = lookup_join(df.withColumn("_label", F.col(f"`{c}`").cast("string")), lookup, ["_label", "_fold"], size=size)
        df = df.withColumn(mean_column(c), F.coalesce(mean_column(c), F.lit(mean))).drop("_label")
    return df.drop("_fold")


# --- the model --------------------------------------------------------------

@dataclass(frozen=True)
class DemandModel:
    """Fitted stages and the encoding table. ``search``: what a grid search tried, its mean error and that of every
    held-out fold."""

    pipeline: PipelineModel
    encodings: DataFrame
    search: tuple[tuple[dict, float, tuple[float, ...]], ...] = ()

    @property
    def stages(self) -> list[Transformer]:
        return self.pipeline.stages

    def transform(self, df: DataFrame) -> DataFrame:
        return self.score(self.encode(df))

    def encode(self, df: DataFrame, columns: list[str] = ENCODED) -> DataFrame:
        return encode(df, self.encodings, columns)

    def score(self, encoded: DataFrame) -> DataFrame:
        """As ``transform``, for rows that have their encodings."""
        return self.pipeline.transform(encoded)

    def save(self, path: str) -> None:
        """Write a new version aside, read it back, then make it the current one. A save that is cut short leaves the
        model before it; a model can be saved to the path that it was loaded from. See ``drop_old_versions``."""
        spark = self.encodings.sparkSession
        number, _ = current_state(spark, path)
        version = uuid.uuid4().hex
        folder = f"{path}/{version}"
        self.pipeline.write().save(f"{folder}/pipeline")
        self.encodings.write.parquet(f"{folder}/encodings")
        rows, kept = self.encodings.count(), spark.read.parquet(f"{folder}/encodings").count()
        if rows != kept or len(PipelineModel.load(f"{folder}/pipeline").stages) != len(self.stages):
            raise RuntimeError(f"{folder} does not hold the model: {kept} of {rows} encodings")
        publish_state(spark, path, {"version": version, "encodings": rows}, number)


def load_model(spark: SparkSession, path: str) -> DemandModel:
    """The current version of the model at ``path``."""
    _, state = current_state(spark, path)
    if not state:
        raise FileNotFoundError(f"no whole model at {path}")
    folder = f"{path}/{state['version']}"
    return DemandModel(PipelineModel.load(f"{folder}/pipeline"), spark.read.parquet(f"{folder}/encodings"))


def drop_old_versions(spark: SparkSession, path: str) -> list[str]:
    """Remove all versions of a model but the current one, and what saves cut short have left. Not while a
    model of an older version is in use."""
    _, state = current_state(spark, path)
    old = [name for name in folder_names(spark, path) if name not in (POINTERS, state.get("version"))]
    for name in old:
        remove_folder(spark, f"{path}/{name}")
    return old


def load_model_or_none(spark: SparkSession, path: str) -> DemandModel | None:
    """The saved model, or None where nothing lies at ``path`` (callers then show the catalogue
    without a score). A model that is there and cannot be read is an error."""
    return load_model(spark, path) if path_exists(spark, path) else None


def index_stages(columns: list[str] = INDEXED) -> StringIndexer:
    """Labels by frequency; labels not seen in training and nulls share one extra index."""
    return StringIndexer(inputCols=columns, outputCols=[f"{c}_Index" for c in columns], handleInvalid="keep")


def assemble(indexed: list[str] = INDEXED, encoded: list[str] = ENCODED,
             numbers: list[str] = NUMERIC) -> VectorAssembler:
    return VectorAssembler(inputCols=[*[mean_column(c) for c in encoded], *[f"{c}_Index" for c in indexed], *numbers],
                           outputCol="features", handleInvalid="keep")


def forest(trees: int = 20, depth: int = 5, max_bins: int = MAX_BINS,
           seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=trees,
                                 maxDepth=depth, maxBins=max_bins, seed=seed)


def invert_stage() -> SQLTransformer:
    """Log prediction -> boxes."""
    return SQLTransformer(statement="SELECT *, expm1(prediction) AS prediction_raw FROM __THIS__")


def _inputs(df: DataFrame, *more: Column) -> DataFrame:
    """The columns that features are made of and the label: lookups by shuffle move whole rows."""
    return df.select(*ENCODED, *INDEXED, *NUMERIC, LABEL, *more)


def _fit_features(rows: DataFrame, encoded: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """(fitted feature stages, features and label of the training rows). Indices need no encodings. A forest reads its rows several
    times, so their features are made once and persisted; they are the caller's to unpersist."""
    fitted = Pipeline(stages=[index_stages(), assemble()]).fit(rows)
    return fitted, fitted.transform(encoded).select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)


def _features(train: DataFrame) -> tuple[DataFrame, PipelineModel, DataFrame, DataFrame]:
    """(encodings, fitted feature stages, features and label of the training rows, what of it is persisted)."""
    fold = fold_of(train)
    encodings = stage(target_encoding(train, ENCODED, LABEL, fold), "encodings", keep=True)
    encoded = encode(_inputs(train, fold.alias("_own")), encodings, fold=F.col("_own")).drop("_own")
    fitted, rows = _fit_features(_inputs(train), encoded)
    return encodings, fitted, rows, rows


def fit(train: DataFrame, regressor: RandomForestRegressor | None = None) -> DemandModel:
    """One forest, without a search."""
    encodings, fitted, rows, held = _features(train)
    try:
        trees = (regressor or forest()).fit(rows)
    finally:
        held.unpersist()
    return DemandModel(PipelineModel([*fitted.stages, trees, invert_stage()]), encodings)


def search_fold(df: DataFrame, folds: int, seed: int = 42) -> Column:
    """A stable fold of each row for a search, independent of its ``fold_of``; equal rows share one."""
    return F.pmod(F.xxhash64(F.lit(f"search {seed}"), *[f"`{c}`" for c in df.columns]), F.lit(folds)).cast("int")


def _search_column(column: str, held_out: int) -> str:
    return f"{mean_column(column)}_{'todas' if held_out == ALL_ROWS else held_out}"


def _encode_searches(rows: DataFrame, means: DataFrame, searches: list[int]) -> DataFrame:
    """``rows`` with the encodings of every search; ``rows`` have their folds in ``_outer`` and ``_own``.

    ``means`` are those of ``_nested_means``, written: what ``encode`` would look up for each search lies side by side for a label, so
    that every column is looked up once. Rows of a search get theirs out of their own fold, the ones it holds out from all others.
    """
    known = means.where("label IS NOT NULL")
    unseen = {r["column"]: r["means"][0]["value"] for r in means.where("label IS NULL").collect()}  # one row a column
    sizes = {r["column"]: r["bytes"] for r in known.groupBy("column").agg(F.sum(
        F.octet_length("label") + LOOKUP_BYTES + F.size("means") * 8 * len(searches)).alias("bytes")).collect()}
    for c in ENCODED:
        lookup = known.where(F.col("column") == c).select(
            F.col("label").alias("_label"), F.map_from_arrays("means.fold", "means.value").alias("_means"))
        rows = lookup_join(rows.withColumn("_label", F.col(f"`{c}`").cast("string")), lookup, ["_label"], size=sizes.get(c))
        rows = rows.withColumns({"_own_means": F.element_at("_means", F.col("_own")), "_all_means": F.element_at("_means", F.lit(ALL_ROWS))})
        rows = rows.withColumns({_search_column(c, s): F.coalesce(
            F.when(F.col("_outer") == s, F.col("_all_means")[i]).otherwise(F.col("_own_means")[i]),
            F.lit(unseen[c][i] if c in unseen else None).cast("double")) for i, s in enumerate(searches)})
        rows = rows.drop("_label", "_means", "_own_means", "_all_means", c)
    return rows.drop("_own")


def _rows_of_search(rows: DataFrame, held_out: int) -> DataFrame:
    """``_encode_searches``' rows with the encodings of one search under the names that the features have."""
    means = [F.col(_search_column(c, held_out)).alias(mean_column(c)) for c in ENCODED]
    return rows.select(*means, *INDEXED, *NUMERIC, LABEL)


def _errors_of_fold(rows: DataFrame, held_out: int, regressor: RandomForestRegressor, grid: list[dict],
                    parallelism: int) -> list[float] | None:
    """RMSE of every grid point on one held-out fold of ``_encode_searches``' rows; None if the fold is empty. Nothing is
    fitted on held-out rows: neither forest nor index nor encoding."""
    seen = _rows_of_search(rows.where(F.col("_outer") != held_out), held_out)
    fitted, seen = _fit_features(seen, seen)
    left = fitted.transform(_rows_of_search(rows.where(F.col("_outer") == held_out), held_out)).select("features", LABEL)
    left = left.persist(StorageLevel.MEMORY_AND_DISK)
    evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction", metricName="rmse")
    try:
        if left.isEmpty():
            return None
        models, errors = regressor.fitMultiple(seen, grid), [0.0] * len(grid)

        def one(_: int) -> None:
            place, trees = next(models)
            errors[place] = evaluator.evaluate(trees.transform(left))

        with ThreadPoolExecutor(parallelism) as pool:
            list(pool.map(one, range(len(grid))))
        return errors
    finally:
        seen.unpersist()
        left.unpersist()


def tune(train: DataFrame, trees: tuple[int, ...] = (20, 50), depths: tuple[int, ...] = (5, 10),
         folds: int = 3, parallelism: int = 2, seed: int = 42, max_bins: int = MAX_BINS,
         fold_col: str | None = None) -> DemandModel:
    """Grid search with cross validation by RMSE of the log target; the best forest is fitted again on all rows.

    Rows are dealt to folds by a seeded hash, or by the whole numbers from 0 to ``folds - 1`` in ``fold_col``. Encodings are
    nested: those of a fold's search leave its rows out, so the error is one on rows never seen.
    """
    if folds < 2:
        raise ValueError("folds must be 2 at least")
    outer = search_fold(train, folds, seed) if fold_col is None else F.col(fold_col)
    regressor = forest(max_bins=max_bins, seed=seed)
    grid = (ParamGridBuilder().addGrid(regressor.numTrees, list(trees))
            .addGrid(regressor.maxDepth, list(depths)).build())
    dealt = stage(_inputs(train, outer.alias("_outer"), fold_of(train).alias("_own")), "dealt_rows")
    searches = [ALL_ROWS, *range(folds)]  # the model's own holds nothing out
    means = stage(_nested_means(dealt, ENCODED, LABEL, F.col("_outer"), F.col("_own"), searches), "nested_encodings")
    encodings = stage(_means_by_row(means, searches).where(F.col("held_out") == ALL_ROWS).drop("held_out", "n"), "encodings", keep=True)
    # In the partitions of the lookup: files are read in larger ones, which a forest's points outgrow. On disk: memory is the forests'.
    rows = _encode_searches(dealt, means, searches).persist(StorageLevel.DISK_ONLY)
    try:
        each = [_errors_of_fold(rows, f, regressor, grid, parallelism) for f in range(folds)]
        by_point = list(zip(*[errors for errors in each if errors is not None], strict=True))
        if not by_point:
            raise ValueError("no fold has rows")
        tried = tuple(({p.name: v for p, v in point.items()}, sum(errors) / len(errors), errors)
                      for point, errors in zip(grid, by_point, strict=True))
        best = min(range(len(grid)), key=lambda k: tried[k][1])
        every = _rows_of_search(rows, ALL_ROWS)
        fitted, every = _fit_features(every, every)
        try:
            found = regressor.fit(every, grid[best])
        finally:
            every.unpersist()
    finally:
        rows.unpersist()
    return DemandModel(PipelineModel([*fitted.stages, found, invert_stage()]), encodings, tried)


def forest_of(model: DemandModel) -> RandomForestRegressionModel:
    return next(s for s in model.stages if isinstance(s, RandomForestRegressionModel))


def split_points(model: DemandModel, feature: str) -> list[float]:
    """The values of a numeric ``feature`` at which any tree branches, in rising order; rows at a value go with the
    smaller ones. At most one a bin of the training data, and none for a feature that no tree uses."""
    inputs = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    branch = re.compile(rf"If \(feature {inputs.index(feature)} <= ([^)]+)\)")
    return sorted(set(map(float, branch.findall(forest_of(model).toDebugString))))


def winning_parameters(model: DemandModel) -> dict[str, int]:
    trees = forest_of(model)
    return {"numTrees": trees.getNumTrees, "maxDepth": trees.getOrDefault("maxDepth")}


def calibrate(model: DemandModel, data: DataFrame) -> DemandModel:
    """Append the factor that makes predicted boxes add up to the actual ones of ``data``.

    Pass the training part for the usual factor, or held-out data for an unbiased one.
    The fitted stages are reused; nothing is trained again.
    """
    row = bias_factor(model.transform(data), TARGET, "prediction_raw").first()
    factor = 1.0 if row.factor is None else row.factor
    boxes = f"prediction_raw * {factor!r}D"
    scaled = SQLTransformer(statement=(
        f"SELECT *, {boxes} AS prediction_final, {boxes} * {PIECES_PER_BOX} "
        "AS prediction_piezas FROM __THIS__"))
    return replace(model, pipeline=PipelineModel([*model.stages, scaled]))


def evaluate(model: DemandModel, test: DataFrame, actual: str = TARGET,
             predicted: str = "prediction_final") -> DataFrame:
    """Error measures in boxes; ``actual=LABEL, predicted="prediction"`` gives those of the uncalibrated
    model on the log scale."""
    return error_metrics(model.transform(test), actual, predicted)


def feature_importance(model: DemandModel, schema: StructType, k: int = 10) -> DataFrame:
    """The ``k`` most important features; names come from the metadata of the vector
    column in ``schema`` (of a transformed frame). As many rows as the model has inputs."""
    attrs = schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    trees = forest_of(model)
    rows = [(names[i], float(w)) for i, w in enumerate(trees.featureImportances.toArray())]
    return (SparkSession.active().createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(k))
