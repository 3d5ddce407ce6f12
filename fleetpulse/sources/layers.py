"""Layer schemas and reads by path or catalog name."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..constants import SENSOR_SCHEMA

# All fields nullable: file readers never enforce NOT NULL; the not_null
# checks do. Reading with these schemas keeps ``ingestion_date`` a string
# (partition discovery alone would turn it into a date).
BRONZE_SCHEMA = StructType(
    [StructField(f.name, f.dataType, True) for f in SENSOR_SCHEMA.fields]
    + [StructField("_ingested_at", TimestampType(), True),
       StructField("_source_path", StringType(), True),
       StructField("_pipeline_version", StringType(), True)])

_SILVER_EXTRA = [
    ("_quality_passed", BooleanType()), ("hour_of_day", IntegerType()), ("day_of_week", IntegerType()),
    ("rpm_prev", DoubleType()), ("rpm_delta", DoubleType()),
    ("temp_coolant_prev", DoubleType()), ("temp_coolant_delta", DoubleType()),
    ("emissions_severity", StringType()), ("engine_status", StringType()),
    ("_transformed_at", TimestampType()),
]
SILVER_SCHEMA = StructType(
    [StructField(f.name, TimestampType() if f.name == "timestamp" else f.dataType, True)
     for f in BRONZE_SCHEMA.fields]
    + [StructField(n, t, True) for n, t in _SILVER_EXTRA])

COUNT_TYPE = LongType()


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan a layer by path with its declared schema (partition columns keep
    their declared types; filters on them prune directories)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a layer by catalog name."""
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Catalog listing as a DataFrame (``SHOW TABLES``)."""
    return spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")


def inspect(df: DataFrame, n: int = 5) -> tuple[str, DataFrame]:
    """(tree-formatted schema, first ``n`` rows as a DataFrame)."""
    return df.schema.treeString(), df.limit(n)


def profile(df: DataFrame) -> DataFrame:
    """(position, column, type, rows, nulls) of every column, in one aggregate over the table; of an
    empty table zeros."""
    fields = df.schema.fields
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{k}")
                                                     for k, f in enumerate(fields)])
    each = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(f.name).alias("column"),
                              F.lit(f.dataType.simpleString()).alias("type"), "rows", F.col(f"n{k}").alias("nulls"))
                     for k, f in enumerate(fields)])
    return wide.select(F.explode(each).alias("r")).select("r.*")


@dataclass(frozen=True)
class LayerRegistry:
    """Maps layer names to storage paths under one root (shared storage on a
    cluster), so operators take DataFrames and jobs resolve names here."""
    root: str
    fmt: str = "parquet"

    def path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}"

    def read(self, spark: SparkSession, layer: str) -> DataFrame:
        schema = {"bronze": BRONZE_SCHEMA, "silver": SILVER_SCHEMA}.get(layer)
        return read_layer(spark, self.path(layer), schema, self.fmt)


def readings_from_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    """A small list of reading dicts (e.g. a sample fetched by a client) as a
    DataFrame under the declared schema, so types and column order do not
    depend on inference. For anything large, write files and scan them."""
    from ..constants import SENSOR_COLUMNS
    nullable = StructType([StructField(f.name, f.dataType, True) for f in SENSOR_SCHEMA.fields])
    return spark.createDataFrame([tuple(r.get(c) for c in SENSOR_COLUMNS) for r in records], nullable)
