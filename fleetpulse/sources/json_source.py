"""Raw sensor JSON under an explicit schema (no inference).

Line-delimited JSON is the default: it splits across tasks. A pretty-printed
JSON array must be read with ``multi_line=True``; read line by line, every
text line would become one all-NULL row. Unparseable records are kept in a
corrupt-record column so they can be routed to quarantine, not lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..constants import SENSOR_SCHEMA

CORRUPT = "_corrupt_record"


def read_sensor_json(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                     schema: StructType = SENSOR_SCHEMA, keep_corrupt: bool = True) -> DataFrame:
    """Typed readings; with ``keep_corrupt`` an extra ``_corrupt_record``
    column holds the text of records that did not parse."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)]) if keep_corrupt else schema
    reader = (spark.read.schema(full).option("multiLine", str(bool(multi_line)).lower())
              .option("mode", "PERMISSIVE"))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def bad_record(df: DataFrame) -> Column:
    """Records to quarantine: text that did not parse under the schema, and
    records without any declared field (an empty object, a bracket-only line of
    an array read line by line). Other columns of ``df`` do not count."""
    empty = F.lit(True)
    for f in SENSOR_SCHEMA.fields:
        empty = empty & F.col(f.name).isNull()
    return F.col(CORRUPT).isNotNull() | empty


def split_corrupt(df: DataFrame, source: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(parsed rows without the corrupt column, quarantined raw records with
    their file). ``source`` is the column with the file each record came from,
    by default the file being scanned. ``df`` must be a staged copy or another
    plan that reads more than the corrupt column."""
    source = F.col("_metadata.file_path") if source is None else source
    good = df.filter(~bad_record(df)).drop(CORRUPT)
    bad = df.filter(bad_record(df)).select(F.coalesce(F.col(CORRUPT), F.lit("{}")).alias("raw_record"),
                                           source.alias("_source_path"))
    return good, bad
