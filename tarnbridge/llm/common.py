"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of input for each range that a sort deals rows into, at most; a size that Spark does not know is given as a very large one.
RANGE_BYTES, UNKNOWN_BYTES = 128 << 20, 1 << 60
#: The ASCII white space that separates words.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    It is the folder of ``spark.checkpoint.dir``. Where that is unset, a
    temporary folder serves for a local master only.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="spark-tarnbridge-")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` from a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Workspace:
    """Tables in the shared folder that one computation needs; all but the kept ones are removed when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stored(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        path = scratch(self.spark, name)
        if not keep:
            self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        context = self.spark.sparkContext
        for path in self.paths:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        self.paths.clear()


def plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the identifier and the text (null: empty), under the names ``doc_id`` and ``text``."""
    return docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))


def held_out(doc_id="doc_id"):
    """Whether crc32 of the identifier as text is a multiple of 5; a null identifier is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def by_range(df: DataFrame, *keys) -> DataFrame:
    """``df`` dealt into ranges of the keys: as many as the session's shuffle partitions, which adaptive execution may
    merge, or more where the tables that are read hold more than RANGE_BYTES for each of those."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    wanted = -(-sum(n for n in sizes if n < UNKNOWN_BYTES) // RANGE_BYTES)
    if wanted > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartitionByRange(wanted, *keys)
    return df.repartitionByRange(*keys)


def settled(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df.select(*columns)``, computed once for a row: a generator keeps later filters and projections from repeating the expressions."""
    return df.select(F.explode(F.array(F.struct(*columns))).alias("settled")).select("settled.*")


def every_column(docs: DataFrame, *but: str) -> list[Column]:
    """The columns of ``docs`` but some, whatever signs their names hold."""
    return [docs["`" + c.replace("`", "``") + "`"] for c in docs.columns if c not in but]


def other_columns(docs: DataFrame, *known: str):
    """The columns of ``docs`` but the known ones, as text to order rows by that are equal in those."""
    rest = every_column(docs, *known)
    return F.to_json(F.struct(*rest)) if rest else F.lit("")


def matching_rows(docs: DataFrame, doc_id: str, text: str, who: dict, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose expressions ``who`` (by name) have values that are in ``kept``, one row for each.

    Of several rows the first stays in the order of the text and then of the other columns. One
    shuffle of ``docs``; the window reuses it. The rows travel as one struct, so no name can clash.
    """
    left = docs.select(F.struct(*every_column(docs)).alias("row"), other_columns(docs, doc_id, text).alias("others"), *[e.alias(k) for k, e in who.items()])
    found = left.join(kept.select(*who).distinct(), list(who), "left_semi")
    order = Window.partitionBy(*who).orderBy(F.col("row")[text].asc_nulls_first(), "others")
    return found.withColumn("rank", F.row_number().over(order)).filter("rank = 1").select("row.*")
