"""Small helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.session import work_folder

# A word is a run of anything but these: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"

# Python workers get batches of so many rows; a batch of long texts stays a few MB.
BATCH_ROWS = "256"


def tuned(spark: SparkSession) -> SparkSession:
    """Bound the rows that Arrow hands to a Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def id_remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def sampled_texts(rows: DataFrame, most: int, by: str, text: str = "text") -> DataFrame:
    """(by, text): one row for each of the ``most`` different texts with the least hashes, per value of ``by``.

    Copies count once, so the sample does not depend on them. Null texts and null values of
    ``by`` are left out.
    """
    own, span = F.col("__hash"), float(1 << 53)
    place = F.struct(F.shiftrightunsigned(own, 11).alias("spot"), own.alias("hash"))
    hashed = rows.where(F.col(text).isNotNull() & F.col(by).isNotNull()).select(by, text, F.xxhash64(text).alias("__hash"))
    texts = written(hashed.select(by, "__hash").distinct(), "text-hashes")
    sizes = written(texts.groupBy(by).agg(F.count("*").alias("__texts")), "text-counts")
    # Somewhat more than are asked for, so that only these are ranked.
    share = (most + 10 * most**0.5 + 10) * span / F.col("__texts")
    rank = F.row_number().over(Window.partitionBy(by).orderBy("__place"))
    last = (
        texts.join(sizes, by)
        .withColumn("__place", place)
        .where(F.col("__place.spot") < share)
        .withColumn("__rank", rank)
        .where(F.col("__rank") <= most)
        .groupBy(by)
        .agg(F.max("__place").alias("__last"))
    )
    chosen = hashed.join(written(last, "sample-limits"), by).where(place <= F.col("__last"))
    return chosen.dropDuplicates([by, "__hash"]).select(by, text)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and nothing runs twice."""
    spark = df.sparkSession
    path = work_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
