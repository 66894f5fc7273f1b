"""Helpers that several corpus operators use: words, hashes, durable tables, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words: the space and the five ASCII controls from tab to carriage return.
WHITE = r"[\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    """The column as text; a null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def plain_words(text: Column) -> Column:
    """`words` with empty strings among them; splits at spaces where there are only these and line feeds, which is faster."""
    spaced = F.replace(text, F.lit("\n"), F.lit(" "))
    return F.when(text.rlike(r"[\x09\x0B-\x0D]"), F.split(text, WHITE)).otherwise(F.split(spaced, " "))


def words(text: Column) -> Column:
    """The words of a text, in order."""
    return F.array_remove(plain_words(text), "")


#: Columns of `with_row_key`: they are never null, so that joins on them need no null-safe comparison.
ROW_KEY = ["unknown", "id", "hash"]


def with_row_key(docs: DataFrame, **more: Column) -> DataFrame:
    """(row, *ROW_KEY, *more): each row of docs as a struct, so that no name of its columns can clash; whether doc_id is null, the id (0 if so), a hash of the text."""
    doc_id = F.col("doc_id").cast("bigint")
    key = {"unknown": doc_id.isNull(), "id": F.coalesce(doc_id, F.lit(0)), "hash": F.xxhash64(text_of())}
    return docs.select(F.struct(*docs.columns).alias("row"), *(c.alias(k) for k, c in (key | more).items()))


def one_of_each(df: DataFrame, key: list[str]) -> DataFrame:
    """One row of each kind of rows equal in key; stays partitioned by it, for a join that follows.

    The limit on the row number is applied before the exchange too, so that a task sends one row of a kind at most.
    """
    numbered = df.withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1))))
    return numbered.where("copy = 1").drop("copy")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is set and all is on one machine (tests)."""
    for where in (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()):
        if where:
            return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write the rows to a table in the shared folder and read them back.

    Cuts the lineage, and freezes what would otherwise be computed anew each time it is used. A
    lost executor takes nothing with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_durable(df: DataFrame) -> None:
    """Delete a table that `durable` wrote and that nothing reads any more."""
    jvm = df.sparkSession._jvm
    for name in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (u, v) as rows (node, root), root the smallest node reached.

    Alternates the large-star and small-star steps until no edge changes; each step is one grouped
    minimum (with map-side combining) and one join, and its edges are written to the shared
    folder. Nodes without an edge have no row. Rows with a null end are ignored.
    """
    edges = edges.select("u", "v").where("u <> v")
    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, old = durable(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()), edges
        drop_durable(old)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
