"""Exact dedup against a persistent digest index, with DataFrame operations only.

The index is a table of (digest, keep_id, batch), bucketed and sorted by digest. A batch is first
folded to one row a digest (partial aggregation takes hot digests apart before any shuffle), the
new digests are found by a sort-merge anti-join that leaves the index where it lies, and are
appended under the batch's name. What a batch keeps is then read off the index alone: a digest
belongs to the batch whose name its row carries. So a batch that is added again, after a crash
before, in or behind the append, appends what is missing and gets the verdicts that it got or
would have got. Only digests and keys are ever shuffled, texts never.

Each append adds a file to the buckets it touches; ``compact`` rewrites the index with one sorted
file a bucket, which a merge join then reads without sorting. One writer at a time.

Defined results: a null text counts as empty. Within a batch the row with the largest key stays;
null keys lose to any other, and a group of null keys keeps one row with a null ``keep_id``. A
digest that an earlier batch brought keeps the earlier row, so no row of the new batch stays.
Rows that repeat both key and text are ties, of which exactly one stays. An empty batch gives an
empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import delete, drop_matches, new_path, settle
from .textnorm import lower_ascii

_SORTED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def digest_of(text: Column) -> Column:
    """SHA-256 of the text with A-Z lowered, as 32 bytes."""
    return F.unhex(F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class DigestIndex:
    """A digest table at ``path``; an existing one is opened, else it is created empty.

    ``buckets`` is fixed when the index is made and kept in its folder's name. Size it so that
    one bucket of the full index (some 45 bytes a distinct text) fits a task.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, key_type: str = "bigint"):
        self.spark, self.path, self.key_type = spark, path.rstrip("/"), key_type
        self.buckets, self.generation = self._find() or (buckets, 0)

    @property
    def location(self) -> str:
        return f"{self.path}/b{self.buckets}/g{self.generation}"

    def _list(self, path: str) -> list[str]:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _find(self) -> tuple[int, int] | None:
        """Buckets and the newest whole generation; one whose rewriting died has no _SUCCESS."""
        for name in self._list(self.path):
            if name[:1] == "b" and name[1:].isdigit():
                made = [int(g[1:]) for g in self._list(f"{self.path}/{name}") if g[:1] == "g" and g[1:].isdigit()]
                whole = [g for g in made if "_SUCCESS" in self._list(f"{self.path}/{name}/g{g}")]
                return int(name[1:]), max(whole, default=0)
        return None

    @contextmanager
    def _registered(self, location: str | None = None) -> Iterator[str]:
        """The name of the index in the catalog, which forgets it afterwards; the files stay."""
        name, before = f"digest_index_{uuid.uuid4().hex}", self.spark.conf.get(_SORTED_SCAN, "false")
        self.spark.sql(
            f"CREATE TABLE {name} (digest BINARY, keep_id {self.key_type}, batch STRING) USING PARQUET "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location or self.location}'"
        )
        self.spark.conf.set(_SORTED_SCAN, "true")
        try:
            yield name
        finally:
            self.spark.conf.set(_SORTED_SCAN, before)
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _append(self, rows: DataFrame, name: str, location: str) -> None:
        # All of a bucket goes to one task, into however many tasks the rows are dealt: a file a bucket.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (
            rows.repartition(self.buckets, bucket)
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .mode("append")
            .option("path", location)
            .saveAsTable(name)
        )
        self.spark.catalog.refreshTable(name)

    def table(self) -> DataFrame:
        """The index's rows (digest, keep_id, batch), without its buckets."""
        return self.spark.read.schema(f"digest binary, keep_id {self.key_type}, batch string").parquet(self.location)

    def add(self, docs: DataFrame, key: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
        """Append the new digests of ``docs`` under the name ``batch``; the verdict on each of its rows.

        Returns (key, digest, keep_id, group_size, kept); group_size counts the rows of this
        batch with that text. Without a name the batch is taken for a new one.
        """
        batch = batch or uuid.uuid4().hex
        rows = settle(
            docs.select(F.col(key).alias("k"), digest_of(F.col(text)).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests"
        )
        best = F.max(F.struct("k", "row"))
        groups = rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        groups = settle(groups.select("digest", F.col("best.k").alias("k"), F.col("best.row").alias("row"), "group_size"), "groups")
        with self._registered() as name:
            fresh = groups.hint("merge").join(self.spark.table(name), "digest", "left_anti")
            self._append(fresh.select("digest", F.col("k").alias("keep_id"), F.lit(batch).alias("batch")), name, self.location)
            ours = F.col("batch") == F.lit(batch)
            verdicts = settle(
                groups.hint("merge").join(self.spark.table(name), "digest")
                .select("digest", "keep_id", "group_size", F.when(ours, F.col("row")).alias("kept_row")),
                "verdicts",
            )
        # Both sides are shuffled here for this join alone, so adaptive execution may split a hot digest.
        return rows.join(verdicts, "digest").select(
            F.col("k").alias(key), "digest", "keep_id", "group_size", F.coalesce(F.col("row") == F.col("kept_row"), F.lit(False)).alias("kept")
        )

    def compact(self) -> None:
        """Rewrite the index with one sorted file a bucket. The old generation goes once the new one is whole."""
        old, new = self.location, f"{self.path}/b{self.buckets}/g{self.generation + 1}"
        delete(self.spark, new)  # what a rewriting that died left
        rows = self.table()
        with self._registered(new) as name:
            self._append(rows, name, new)
        self.generation += 1
        delete(self.spark, old)


def keep_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", index_path: str | None = None, buckets: int | None = None, batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text is new and whose key is the largest of it, with all their columns.

    Rows that go are looked up by a hash of key and digest; texts are shuffled only where those
    are too many to broadcast. Of rows that repeat both key and text, any one stays.
    """
    found = _index(docs, key, index_path, buckets).add(docs, key, text, batch)
    marks = settle(
        found.groupBy(_mark(F.col(key), F.col("digest")).alias("__wk_m"))
        .agg(F.bool_or("kept").alias("stays"), F.bool_and("kept").alias("all_stay"))
        .where("not all_stay"),
        "not-kept",
    )
    mark = _mark(F.col(key), digest_of(F.col(text)))
    twice = marks.where("stays").select("__wk_m")  # equal key and text in several rows, of which one is kept
    if twice.isEmpty():
        return drop_matches(docs, mark, marks.select("__wk_m"), "__wk_m")
    names, again = docs.columns, docs.withColumn("__wk_mark", mark)
    again = again.join(twice, F.col("__wk_mark") == F.col("__wk_m"))
    one = again.groupBy("__wk_mark").agg(F.first(F.struct(*names)).alias("__wk_row"))
    return drop_matches(docs, mark, marks.select("__wk_m"), "__wk_m").unionByName(one.select(*[F.col("__wk_row")[c].alias(c) for c in names]))


def _mark(key: Column, digest: Column) -> Column:
    """32 bytes that tell a key (null too) and a digest."""
    return F.unhex(F.sha2(F.concat(F.coalesce(key.cast("string"), F.lit("-")).cast("binary"), F.lit(" ").cast("binary"), digest), 256))


def _index(docs: DataFrame, key: str, path: str | None, buckets: int | None) -> DigestIndex:
    spark = docs.sparkSession
    n = buckets or max(8, min(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return DigestIndex(spark, path or new_path(spark, "digests"), n, docs.schema[key].dataType.simpleString())


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", index_path: str | None = None, buckets: int | None = None, batch: str | None = None) -> DataFrame:
    """One row a document: (key, keep_id, group_size, kept, text_sha256)."""
    found = _index(docs, key, index_path, buckets).add(docs, key, text, batch)
    return found.select(key, "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def dedup_batches(batches: list[DataFrame], key: str = "doc_id", text: str = "text", index_path: str | None = None, buckets: int | None = None) -> DataFrame:
    """``exact_dedup`` of batches that are added one after the other; group_size counts the rows of all of them."""
    index = _index(batches[0], key, index_path, buckets)
    found = [index.add(b, key, text, str(i)).select(key, "digest", "keep_id", "group_size", "kept") for i, b in enumerate(batches)]
    each = settle(reduce(DataFrame.unionByName, found), "batches")
    sizes = settle(each.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")), "sizes")
    return each.drop("group_size").join(sizes, "digest").select(
        key, "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
