"""Line dedup over levelled sorted runs of line hashes.

A run is a table of line hashes with the number of documents that hold each, bucketed and
sorted by hash. A new batch is reduced to its distinct hashes and merge-anti-joined with every
run: hashes that a run already settles (found in ``least`` documents) need no more counting.
The rest become a run of level 0. When a level holds ``fan`` runs, they are merged into one
run of the next, where counts of equal hashes are added; so there are at most ``fan`` - 1 runs
on each of log(batches) levels. With ``least`` 1 a run settles whatever it holds, and lines
seen in an earlier batch are simply known.

A line's key is the line without ASCII white space at both ends, with A-Z in lower case; it
is known by 128 bits of hash. Every row counts as a document, repeated rows too. Null texts
count as empty: one empty line, which has no key and stays. Lines are counted and found in
the JVM, whole texts at a time; a line that most texts share is one row per run, and on the
way back the larger side of a join that adaptive execution can split. What a text loses
depends on the text alone, so texts meet their lost lines by hash of text; ids may repeat
or be null.
"""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docketlake.llm.common import Staging, pick, whole
from docketlake.session import drop_scratch, scratch_path

#: Documents that a line must be found in to be dropped, and code points it must have.
LEAST, SHORTEST = 10, 1
#: Runs of a level that are merged, and batches that a whole table is taken in.
FAN, BATCHES = 4, 8
HASH, TEXT = ["h1", "h2"], ["t1", "t2"]


def line_keys(text: str | Column) -> Column:
    """The key of every line of a text, in order."""
    return F.transform(F.split(whole(text), "\n"), lambda line: F.translate(
        F.btrim(line, F.lit(" \t\n\x0b\x0c\r")), string.ascii_uppercase, string.ascii_lowercase))


def _hashes(value: str, names: list[str]) -> list[Column]:
    return [F.xxhash64(F.lit(i), F.col(value)).alias(name) for i, name in enumerate(names, 1)]


def line_counts(docs: DataFrame, batches: int = BATCHES, shortest: int = SHORTEST) -> DataFrame:
    """(batch, h1, h2, docs): in how many documents of a batch each line stands."""
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")
    lines = pick(docs, "doc_id", "text").select(batch, F.explode(F.array_distinct(line_keys("text"))).alias("key"))
    return (lines.where(F.char_length("key") >= shortest).select("batch", *_hashes("key", HASH))
            .groupBy("batch", *HASH).agg(F.count("*").alias("docs")))


class LineRuns:
    """The levelled runs; a context that removes their tables at its end.

    The driver holds names of tables only. A batch is added whole or not at all: its run is
    known once its table is written.
    """

    def __init__(self, spark: SparkSession, least: int = LEAST, fan: int = FAN):
        self.spark, self.least, self.fan = spark, least, fan
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._paths: dict[str, str] = {}

    def __enter__(self) -> "LineRuns":
        return self

    def __exit__(self, *_) -> None:
        self._remove([name for level in self.levels for name in level])

    def runs(self) -> Iterator[DataFrame]:
        """The runs, oldest level first."""
        return (self.spark.table(name) for level in reversed(self.levels) for name in level)

    def new_in(self, counts: DataFrame) -> DataFrame:
        """The rows of (h1, h2, ...) that no run settles."""
        for run in self.runs():
            counts = counts.join(run.where(F.col("docs") >= self.least).hint("merge"), HASH, "left_anti")
        return counts

    def add(self, counts: DataFrame) -> None:
        """Take in the (h1, h2, docs) of a batch, one row per hash."""
        self._write(self.new_in(counts.select(*HASH, "docs")), 0)
        level = 0
        while len(self.levels[level]) >= self.fan:
            merged = self.levels[level]
            self._write(self._summed(merged), level + 1)
            self.levels[level] = []
            self._remove(merged)
            level += 1

    def settled(self) -> DataFrame:
        """The hashes found in ``least`` documents so far, over all runs."""
        names = [name for level in self.levels for name in level]
        return self._summed(names).where(F.col("docs") >= self.least).select(*HASH)

    def _summed(self, names: list[str]) -> DataFrame:
        # Read as plain files: a union of bucketed tables may lose its partitioning after planning relied on it.
        runs = self.spark.read.schema("h1 bigint, h2 bigint, docs bigint").parquet(*(self._paths[n] for n in names))
        return runs.groupBy(*HASH).agg(F.sum("docs").alias("docs"))

    def _write(self, counts: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", scratch_path(self.spark, "line-run")
        (counts.repartition(self.buckets, *HASH).write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", path).saveAsTable(name))
        self._paths[name] = path
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _remove(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_scratch(self.spark, self._paths.pop(name))


def common_lines(docs: DataFrame, staging: Staging, least: int = LEAST, shortest: int = SHORTEST,
                 batches: int = BATCHES, fan: int = FAN) -> DataFrame:
    """(h1, h2) of the lines found in at least ``least`` documents; the table is taken in batches."""
    counts = staging.save(line_counts(docs, batches, shortest), "batch")
    with LineRuns(docs.sparkSession, least, fan) as runs:
        for batch in range(batches):
            runs.add(counts.where(F.col("batch") == batch))
        return staging.save(runs.settled())


def dropped_lines(docs: DataFrame, common: DataFrame) -> DataFrame:
    """(t1, t2, dropped): for every text with common lines their numbers, from 0, ascending."""
    texts = docs.select(whole(docs["text"]).alias("text"))
    lines = texts.select(*_hashes("text", TEXT), F.posexplode(line_keys("text")).alias("at", "key"))
    return (lines.select(*TEXT, "at", *_hashes("key", HASH)).join(common, HASH)
            .groupBy(*TEXT).agg(F.sort_array(F.collect_set("at")).alias("dropped")))   # lines of one text


def _kept(lines: Column, dropped: Column) -> Column:
    """The lines between the dropped ones, piece by piece: linear in the lines."""
    n = F.coalesce(F.size(dropped), F.lit(0))

    def pieces(every: Column) -> Column:
        def piece(j: Column) -> Column:
            begin = F.when(j == 0, 0).otherwise(F.get(dropped, j - 1) + 1)
            end = F.when(j == n, F.size(every)).otherwise(F.get(dropped, j))
            return F.slice(every, begin + 1, end - begin)

        return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), n), piece))).otherwise(every)

    # The lambda's variable holds the split text, which is so split once.
    return F.transform(F.array(lines), pieces)[0]


def without_lines(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` with the dropped lines cut from ``text``; two columns are added: _n_lines, _n_dropped."""
    lost = dropped.select(*(F.col(c).alias(f"_{c}") for c in (*TEXT, "dropped")))
    text = whole(docs["text"])
    own = [F.xxhash64(F.lit(i), text).alias(f"_own{i}") for i in (1, 2)]
    joined = docs.select("*", *own).join(
        lost, (F.col("_own1") == F.col("_t1")) & (F.col("_own2") == F.col("_t2")), "left")
    text = F.col("text")
    cut = F.array_join(_kept(F.split(whole(text), "\n"), F.col("_dropped")), "\n")
    return joined.select(
        *(F.when(text.isNotNull(), cut).alias("text") if c == "text" else F.col(c) for c in docs.columns),
        F.size(F.split(whole(text), "\n")).cast("bigint").alias("_n_lines"),
        F.coalesce(F.size("_dropped"), F.lit(0)).cast("bigint").alias("_n_dropped"))
