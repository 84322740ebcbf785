"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to its distinct digests,
these are anti-joined (sort-merge, the index side is read in place without a shuffle), what
is new is appended, and the document kept for each digest is read from the index. A new index
starts as an empty table, so the first batch takes the same path. Decisions come from a join of the
narrow (row, digest) table with the groups, whose large partitions adaptive execution can split, so a text that holds a third of all rows is
never gathered in one task.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from studyloom.session import durable, ensure_checkpoint_dir, own


def normalised(text: Column) -> Column:
    """Null as empty, A-Z lower-cased and nothing else."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase,
                       string.ascii_lowercase)


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return F.sha2(normalised(text).cast("binary"), 256)


class DigestIndex:
    """Digests seen so far and the document kept for each: (digest, keep_id).

    `table` names an existing or new catalog table; without it a new one is made below
    `spark.checkpoint.dir` and goes with `session.release`. `buckets` is fixed when the table is made.
    """

    def __init__(self, spark: SparkSession, table: str | None = None, buckets: int | None = None,
                 path: str | None = None):
        self.spark = spark
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = table or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or f"{ensure_checkpoint_dir(spark)}/{self.table}"
        if table is None:
            own(spark, self.path, self.table)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def create(self) -> None:
        """An empty table, if there is none."""
        if not self.exists():
            self.append(self.spark.createDataFrame([], "digest string, keep_id long"))

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, rows: DataFrame) -> None:
        """Add (digest, keep_id) rows whose digests the index does not hold."""
        (rows.select("digest", "keep_id")
         .repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One decision per row of `docs`, and the new digests appended to the index.

    Needs `doc_id` and `text`; other columns are ignored, whatever their names. Returns doc_id,
    keep_id, group_size (rows of this batch with the text), kept, text_sha256.

    Of equal new texts the row with the largest doc_id stays; a null doc_id is the smallest. Of
    rows with equal text and doc_id one stays. A text that the index already holds stays out
    and keep_id is the indexed document. Null text counts as empty; texts of any length are digested
    whole. An empty batch gives no rows and leaves an empty index. A batch that was appended before keeps
    nothing when it is given again, so a failed run starts again from the index it began with.
    """
    rows = durable(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_digest(F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row_key")))
    groups = rows.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.max_by("row_key", F.coalesce("doc_id", F.lit(-(1 << 63)))).alias("keep_row"))
    groups = durable(groups)
    index.create()
    # written before the index changes; the hint keeps a small index from being broadcast
    fresh = durable(groups.join(index.read().select("digest").hint("merge"), "digest",
                                "left_anti"))
    index.append(fresh)
    groups = durable(
        groups.select("digest", "group_size")
        .join(index.read().hint("merge"), "digest")
        .join(fresh.select("digest", "keep_row"), "digest", "left"))
    joined = rows.join(groups, "digest")
    return joined.select(
        "doc_id", "keep_id", "group_size",
        F.coalesce(F.col("row_key") == F.col("keep_row"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"))


def keep_distinct(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of `docs` that `deduplicate` keeps, all columns; nulls, repeated rows, long texts and
    empty tables as there.

    The few that go are taken out by an anti-join, so the texts need not be shuffled.
    """
    decided = durable(deduplicate(docs, index).groupBy(
        F.col("doc_id").alias("_exact_id"), F.col("text_sha256").alias("_exact_sha")).agg(
        F.bool_or("kept").alias("_exact_kept"), F.count(F.lit(1)).alias("_exact_rows")))
    gone = decided.filter(~F.col("_exact_kept")).select("_exact_id", "_exact_sha")
    name = "_exact_digest"
    while name in docs.columns:
        name += "_"
    marked = docs.withColumn(name, text_digest(F.col("text")))
    staying = marked.join(
        gone, marked["doc_id"].cast("long").eqNullSafe(gone["_exact_id"])
        & (marked[name] == gone["_exact_sha"]), "left_anti")
    if not decided.where("_exact_kept and _exact_rows > 1").isEmpty():
        # rows equal in doc_id and text: one of them stays
        staying = staying.dropDuplicates(["doc_id", name])
    return staying.drop(name)
