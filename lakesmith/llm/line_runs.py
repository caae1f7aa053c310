"""Line dedup by levelled sorted runs of line hashes.

A run is a table of (key, docs, holder), one row for each key of a line: bucketed and sorted by key. Documents come in
batches by descending id. The keys of a batch are merge-anti-joined with the runs so far: those that no run has
enter with the largest id of the batch that holds them, their holder for good, since later batches have smaller ids; the others add
their count of documents alone. What a batch adds is a new run of level 0. ``FAN`` runs of a level
are compacted to one run of the next level, which sums the counts and keeps the holder, so that a new batch meets few runs.
Runs and batches have the same buckets; the joins shuffle the batch only.

The last compaction tells the keys of ``least_docs`` documents or more. Their lines are dropped except in the holder.
Keys of a ``1 / HOT_SHARE`` share of all lines are at most ``HOT_SHARE`` many, which bounds their broadcast; the rest
meets its lines in a shuffled join, where no key has a larger share.

All of it is DataFrame functions. A key is the MD5 of a stripped, lower-cased line (128 bits).

Defined results: null and empty texts are one empty line. Rows with equal ids are one document. Rows with null ids count for
no line and lose none. An empty table gives an empty result. Extra columns are kept by ``without_common_lines``.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_scratch, scratch_path
from .common import ascii_lowered, fresh, staged
from .ranges import slice_count

#: Runs of a level that are compacted to one of the next; batches of one call; see above for HOT_SHARE.
FAN, BATCHES, HOT_SHARE = 2, 4, 1000
#: Fixed value: what is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


class LineRuns:
    """Levelled runs of keys below the shared scratch folder; ``drop`` removes them."""

    def __init__(self, spark: SparkSession, buckets: int, fan: int = FAN):
        self.spark, self.buckets, self.fan = spark, buckets, fan
        self.levels: list[list[tuple[str, str]]] = []

    def _write(self, rows: DataFrame) -> tuple[str, str]:
        name, path = f"line_runs_{uuid4().hex}", scratch_path(self.spark, "line-run")
        rows.sortWithinPartitions("key").write.bucketBy(self.buckets, "key").sortBy("key").option("path", path).format("parquet").saveAsTable(name)
        return name, path

    def _remove(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.spark.sql(f"DROP TABLE {name}")
            drop_scratch(self.spark, path)

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, own: DataFrame) -> None:
        """A batch's keys (key, docs, holder), each once; all its documents have smaller ids than those of earlier batches."""
        new, again = own, None
        for run in self.runs():
            new = new.join(run.select("key"), "key", "left_anti")
            met = own.join(run.where("holder IS NOT NULL").select("key"), "key", "left_semi")  # of a key, one run has the holder
            again = met if again is None else again.unionAll(met)
        rows = new if again is None else new.unionAll(again.withColumn("holder", F.lit(None).cast("long")))
        self._insert(0, self._write(rows.repartition(self.buckets, "key")))

    def _insert(self, level: int, run: tuple[str, str]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan:
            old = self.levels[level]
            merged = self._write(compacted([self.spark.table(name) for name, _ in old]))
            self.levels[level] = []
            self._remove(old)
            self._insert(level + 1, merged)

    def merged(self) -> DataFrame | None:
        """All keys, each once."""
        return compacted(self.runs()) if self.levels else None

    def drop(self) -> None:
        self._remove([run for level in self.levels for run in level])
        self.levels = []


def compacted(runs: list[DataFrame]) -> DataFrame:
    """The runs' keys, each once, by merge joins of runs that are bucketed and sorted alike.

    Not a union and a grouping: the planner takes a union of bucketed scans for partitioned by key where it has since
    decided to read them unbucketed, and leaves out the exchange that the grouping needs.
    """
    rows = runs[0]
    for run in runs[1:]:
        own, other = rows.select("key", "docs", "holder"), run.toDF("__key", "__docs", "__holder")
        rows = own.join(other, F.col("key") == F.col("__key"), "full")
        docs = F.coalesce("docs", F.lit(0)) + F.coalesce("__docs", F.lit(0))
        rows = rows.select(F.coalesce("key", "__key").alias("key"), docs.alias("docs"), F.greatest("holder", "__holder").alias("holder"))
    return rows


def line_key(line: Column, least_chars: int) -> Column:
    """The key of a lower-cased line; null if it is too short to have one."""
    stripped = F.btrim(line, F.lit(BLANKS))
    return F.when(F.char_length(stripped) >= least_chars, F.unhex(F.md5(stripped)))


def keyed_lines(docs: DataFrame, least_chars: int, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, text_hash, at, key) of every line that has a key."""
    keys = F.transform(F.split(ascii_lowered(F.col(text_column)), "\n"), lambda line, at: F.struct(at.alias("at"), line_key(line, least_chars).alias("key")))
    keys = F.filter(keys, lambda line: line["key"].isNotNull())
    rows = docs.where(F.col(id_column).isNotNull())
    rows = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), F.explode(keys).alias("line"))
    return rows.select("doc_id", "text_hash", "line.at", "line.key")


def batch_bounds(docs: DataFrame, batches: int, id_column: str) -> list[int]:
    """Ids that cut the documents into about equal batches; any cut gives the same lines."""
    cuts = docs.agg(F.percentile_approx(F.col(id_column).cast("long"), [k / batches for k in range(1, batches)])).first()[0]
    return sorted(set(cuts or []))


def dropped_lines(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, batches: int = BATCHES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text_hash, gone): the numbers, from 0, of the lines that a text loses, for texts that lose any."""
    spark = docs.sparkSession
    bounds = batch_bounds(docs, batches, id_column)
    batch = sum((F.when(F.col("doc_id") > b, 0).otherwise(1) for b in bounds), F.lit(0))  # 0: the largest ids
    path = scratch_path(spark, "lines")
    lines = keyed_lines(docs, least_chars, id_column, text_column).withColumn("batch", batch)
    lines.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)

    runs = LineRuns(spark, slice_count(docs, 0.25))
    for k in range(len(bounds) + 1):
        own = lines.where(F.col("batch") == k).groupBy("key")
        runs.add(own.agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("holder")))
    common = staged(runs.merged().where(F.col("docs") >= least_docs), "common-lines")
    runs.drop()

    share = lines.count() // HOT_SHARE
    hot, rest = common.where(F.col("docs") > share), common.where(F.col("docs") <= share)
    cold = lines.join(F.broadcast(hot.select("key")), "key", "left_anti").join(rest, "key")
    met = lines.join(F.broadcast(hot), "key").unionByName(cold).where("doc_id < holder")
    return staged(met.groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("gone")), "dropped-lines")


def with_lines(docs: DataFrame, names: tuple[str, str, str], id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` and three columns: its number of lines, of dropped lines, and the text of the lines that stay."""
    gone = dropped_lines(docs, id_column=id_column, text_column=text_column, **options).withColumnsRenamed({"doc_id": "__doc", "text_hash": "__of"})
    own_hash, lines, lost = (fresh(docs, n) for n in ("__text_hash", "__lines", "__gone"))
    gone = gone.withColumnRenamed("gone", lost)
    rows = docs.withColumn(own_hash, F.xxhash64(text_column))
    rows = rows.join(gone, (rows[id_column].cast("long") == gone["__doc"]) & (rows[own_hash] == gone["__of"]), "left").drop(gone["__doc"], gone["__of"])
    rows = rows.withColumn(lines, F.split(F.coalesce(F.col(text_column), F.lit("")), "\n"))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    kept = F.when(F.col(lost).isNull(), F.coalesce(F.col(text_column), F.lit(""))).otherwise(F.array_join(F.transform(stays, lambda i: F.col(lines)[i]), "\n"))
    n_lines, n_dropped, kept_text = names
    return rows.select(*[F.col(c) for c in docs.columns], F.size(lines).cast("long").alias(n_lines), F.coalesce(F.size(lost), F.lit(0)).cast("long").alias(n_dropped), kept.alias(kept_text))


def line_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 (of the lines that stay, joined by a line feed) of every row."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    rows = with_lines(rows, ("n_lines", "n_dropped", "kept"), "doc_id", "text", **options)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def without_common_lines(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with the dropped lines taken out of the texts that have any."""
    n_lines, n_dropped, kept = (fresh(docs, n) for n in ("__n_lines", "__n_dropped", "__kept"))
    rows = with_lines(docs, (n_lines, n_dropped, kept), id_column, text_column, **options)
    text = F.when(F.col(n_dropped) > 0, F.col(kept)).otherwise(F.col(text_column))
    return rows.select(*[text.alias(c) if c == text_column else F.col(c) for c in docs.columns])
