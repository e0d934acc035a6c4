"""Dense PCA and sparse truncated SVD, fitted on training rows only."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel, StandardScaler, StandardScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg import Vectors as OldVectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(wanted: int, rows: int, columns: int) -> int:
    n = min(wanted, rows - 1, columns - 1)
    if n < 1:
        raise ValueError("not enough rows or columns to reduce")
    return n


def pca(train: DataFrame, key: str, array: str, wanted: int = 16) -> tuple[PCAModel, StandardScalerModel, int]:
    """(model, centring model, components); centring is a step of its own, as Spark's PCA doesn't centre what it transforms."""
    vectors = train.select(key, array_to_vector(F.col(array).cast("array<double>")).alias("raw"))
    size = vectors.select(F.size(vector_to_array("raw")).alias("n")).first()["n"]
    k = components(wanted, vectors.count(), size)
    centre = StandardScaler(inputCol="raw", outputCol="centred", withMean=True, withStd=False).fit(vectors)
    return PCA(k=k, inputCol="centred", outputCol="reduced").fit(centre.transform(vectors)), centre, k


def pca_transform(df: DataFrame, model: PCAModel, centre: StandardScalerModel, key: str, array: str) -> DataFrame:
    vectors = df.select(key, array_to_vector(F.col(array).cast("array<double>")).alias("raw"))
    return model.transform(centre.transform(vectors)).select(key, vector_to_array("reduced").alias("reduced"))


def save_pca(reduced: DataFrame, model: PCAModel, centre: StandardScalerModel, path: str) -> None:
    """The reduced rows and both fitted steps, each in a folder of its own."""
    reduced.write.mode("overwrite").parquet(f"{path}/rows")
    centre.write().overwrite().save(f"{path}/centre")
    model.write().overwrite().save(f"{path}/model")


def load_pca(path: str) -> tuple[PCAModel, StandardScalerModel]:
    return PCAModel.load(f"{path}/model"), StandardScalerModel.load(f"{path}/centre")


def svd(df: DataFrame, key: str, features: str, wanted: int = 16) -> DataFrame:
    """(component, singular_value, explained_variance) of sparse rows that are never made dense; variance is U*S's share."""
    rows = df.select(features).rdd.map(lambda r: OldVectors.fromML(r[0])).persist()  # read for the product, for U and for the statistics
    matrix = RowMatrix(rows)
    k = components(wanted, matrix.numRows(), matrix.numCols())
    found = matrix.computeSVD(k, computeU=True)
    s = found.s.toArray()
    stats = matrix.computeColumnSummaryStatistics()
    total = float(stats.variance().sum())
    spread = found.U.multiply(_diagonal(s)).computeColumnSummaryStatistics().variance()
    return df.sparkSession.createDataFrame([(i, float(s[i]), float(spread[i] / total) if total else 0.0) for i in range(len(s))], "component int, singular_value double, explained_variance double")


def _diagonal(s):
    from pyspark.mllib.linalg import DenseMatrix

    n = len(s)
    return DenseMatrix(n, n, [float(s[i]) if i == j else 0.0 for j in range(n) for i in range(n)])
