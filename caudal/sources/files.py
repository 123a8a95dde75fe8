"""CSV and Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


CORRUPT = "_corrupt_line"
MALFORMED = "LINEA_ILEGIBLE"


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and a declared schema; nothing is inferred. A line that does not fit fails the job."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", enforceSchema=True)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All lines of CSV files in the declared schema, with CORRUPT: the raw line, where it does not fit.

    Lines with too few or too many fields do not fit, nor do values that do not parse. All columns are parsed
    whatever is selected, so that a line is judged the same in each reading.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return (spark.read.option("columnPruning", "false")
            .csv(path, header=True, schema=StructType([*schema.fields, StructField(CORRUPT, StringType())]),
                 mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=True))


def split_csv(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the rows that fit, the others): each line is in one of them. The others have what could be parsed, and `line`.

    Spark reads a raw line only together with other columns; a key of the row is one of them in a reject.
    """
    columns = [c for c in scanned.columns if c != CORRUPT]
    good = scanned.filter(F.col(CORRUPT).isNull()).select(*columns)
    return good, scanned.filter(F.col(CORRUPT).isNotNull()).select(*columns, F.col(CORRUPT).alias("line"))


def write_files(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a frame as Snappy Parquet or as CSV with a header."""
    writer = df.write.mode("overwrite")
    if fmt == "parquet":
        writer.option("compression", "snappy").parquet(path)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format: {fmt}")
