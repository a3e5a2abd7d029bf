"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# The white space of the data contracts: space, tab, line feed, vertical tab,
# form feed, carriage return (fixed values).
WHITESPACE = " \t\n\x0b\x0c\r"

# Text handled at once inside a Python task, in characters.
CHUNK_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: the lineage ends
    at files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hash(df: DataFrame, exclude: tuple = ()) -> Column:
    """One number for a whole row: what orders rows that agree in all else."""
    cols = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
            for f in df.schema.fields if f.name not in exclude]
    return F.xxhash64(*cols)


def discard(df: DataFrame) -> None:
    """Delete the files of a frame made by ``materialise``."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive [start, end) slices of about ``limit`` characters; a longer
    text is a slice of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """True for documents kept apart: crc32 of the id's decimal text."""
    crc = F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8"))
    return crc % modulus == remainder
