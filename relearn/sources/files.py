"""CSV/JSON sources and sinks, literal rows, model storage.

CSV is read with a declared schema: inference costs an extra pass over the
data and can change types between days.  Writes go to folders of part files
(one per task), never through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

# Fixed schemas of the reference's CSV inputs.
URL_SCHEMA = "url string, label string"
DEMO_SCHEMA = ("transaction_id string, timestamp timestamp, amount double, hour_of_day int, "
               "day_of_week int, distance_from_home double, distance_from_last_transaction double, "
               "ratio_to_median_purchase_price double, repeat_retailer int, used_chip int, "
               "used_pin_number int, online_order int, fraud int")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, header: bool = True) -> DataFrame:
    """CSV with a header.  Pass ``schema`` (recommended); without it the
    schema is inferred, which reads the input twice."""
    reader = spark.read.option("header", header)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str] | str) -> DataFrame:
    """S3: a DataFrame from literal rows (small, driver-side by nature)."""
    return spark.createDataFrame(list(rows), columns if isinstance(columns, str) else list(columns))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header and no index column, one part file per task."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines (nested structs stay nested)."""
    df.write.mode(mode).json(path)


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline, replacing what is at ``path``."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline saved by ``save_model``."""
    return PipelineModel.load(path)
