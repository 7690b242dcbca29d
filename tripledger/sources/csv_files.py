"""CSV source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, header: bool = True) -> DataFrame:
    """Read a file or a directory of files.

    With a schema the columns bind by position, whatever the header says, and a cell that does not
    parse becomes null while its row stays. Without one every column is a string; no pass over the
    data is spent on guessing types.
    """
    return spark.read.csv(path, schema=schema, header=header, mode="PERMISSIVE")


def rejected_cells(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """(file, line, column, value): the cells that :func:`read_csv` makes null because they don't parse.

    One row per cell, with the text of its line; for a line with too few or too many cells, one row whose
    column and value are null. Empty cells are nulls, not rejected. Lines that parse are not kept anywhere.
    """
    bad = "_bad_line"
    while bad in schema.fieldNames():
        bad += "_"
    told = spark.read.csv(path, schema=StructType([*schema.fields, StructField(bad, StringType())]), header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=bad)
    texts = StructType([StructField(f"c{i}", StringType()) for i in range(len(schema.fields))] + [StructField("more", StringType())])
    line = F.col(bad)
    # The line's cells as text, and one more that only a longer line has.
    kept = told.select(
        F.col("_metadata.file_path").alias("file"),
        line.alias("line"),
        F.from_csv(line, texts.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), {"mode": "PERMISSIVE"}).alias("texts"),
        *[F.col(f"`{field.name}`").isNull().alias(f"null_{i}") for i, field in enumerate(schema.fields)],
    ).where("line is not null")
    cells = F.filter(
        F.array(*[
            F.when(F.col(f"null_{i}") & F.col(f"texts.c{i}").isNotNull(), F.struct(F.lit(field.name).alias("column"), F.col(f"texts.c{i}").alias("value")))
            for i, field in enumerate(schema.fields)
        ]),
        lambda cell: cell.isNotNull(),
    )
    return kept.select("file", "line", F.explode_outer(cells).alias("cell")).select("file", "line", "cell.column", "cell.value")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """Write a directory of part files, each with a header; refuses an existing directory by default."""
    df.write.mode(mode).csv(path, header=header)
