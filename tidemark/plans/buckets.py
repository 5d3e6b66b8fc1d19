"""Targets kept in folders by a hash of their key.

The table is partitioned by the key's hash and bucketed by the key with the
same number, so a folder is a bucket. An upsert reads and rewrites only the
folders that its batch's keys fall into (dynamic partition overwrite), and
joins them to the batch without shuffling the target: its scan is already
dealt by the key. Three tables of the catalog belong to a target ``name``:
the keyed rows, ``name_unkeyed`` (rows without a whole key, in a folder per
run) and ``name_runs`` (the runs applied, in a folder per run).

A run is applied once: a replay is found in ``name_runs`` and changes nothing.
A run that ended half-way is run again in full; each of its three writes
replaces whole folders, so what it had written already is written again, not
doubled. Spark moves the finished folders in place when the write commits:
a lost executor costs the tasks it had; one writer at a time is assumed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.upsert import _keys, dedup_last_wins, distinct_keys, match_keys
from tidemark.session import fresh_scratch, materialize

BUCKET, RUN = "_bucket", "_run"
FIRST_RUN = "created"
HOT = 8  # a folder of so many times the mean of the rows is read in splits


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block (reads and writes that are
    planned inside it)."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class BucketedTarget:
    """One target table by its catalog name; ``create`` makes a new one."""

    def __init__(self, spark: SparkSession, name: str, key: str | Sequence[str], buckets: int):
        self.spark, self.name, self.key, self.buckets = spark, name, _keys(key), buckets

    @property
    def unkeyed(self) -> str:
        return f"{self.name}_unkeyed"

    @property
    def runs(self) -> str:
        return f"{self.name}_runs"

    def _has_key(self) -> Column:
        cond = F.lit(True)
        for k in self.key:
            cond = cond & F.col(f"`{k}`").isNotNull()
        return cond

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows with a key and their folder, brought together by folder.
        ``rebalance`` lets AQE split a folder that a hot key makes large."""
        bucket = F.pmod(F.hash(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets))
        return rows.where(self._has_key()).withColumn(BUCKET, bucket).hint("rebalance", BUCKET)

    @classmethod
    def create(cls, df: DataFrame, name: str, key: str | Sequence[str], buckets: int,
               path: str | None = None, exist_ok: bool = False) -> BucketedTarget:
        """A new target holding ``df``. With ``path`` its tables are external,
        in folders below it; else in the warehouse. Choose ``buckets`` so that
        a folder is what one task can rewrite (some 100 MB). With ``exist_ok``
        tables that are there already stay as they are (``df`` should be empty)."""
        if {BUCKET, RUN} & set(df.columns):
            raise ValueError(f"{BUCKET} and {RUN} are the target's own columns")
        out = cls(df.sparkSession, name, key, buckets)

        def put(rows: DataFrame, table: str, part: str, bucketed: bool = False) -> None:
            w = rows.write.format("parquet").partitionBy(part).mode("ignore" if exist_ok else "errorifexists")
            if bucketed:
                w = w.bucketBy(buckets, *out.key)
            if path:
                w = w.option("path", f"{path}/{part[1:]}-{table.rsplit('.', 1)[-1]}")
            w.saveAsTable(table)

        put(out._dealt(df), name, BUCKET, bucketed=True)
        put(df.where(~out._has_key()).withColumn(RUN, F.lit(FIRST_RUN)), out.unkeyed, RUN)
        put(out.spark.range(1).select(F.current_timestamp().alias("applied_at"), F.lit(FIRST_RUN).alias(RUN)),
            out.runs, RUN)
        return out

    def columns(self) -> list[str]:
        return [c for c in self.spark.table(self.name).columns if c != BUCKET]

    def read(self) -> DataFrame:
        """All rows, in the target's column order."""
        cols = [F.col(f"`{c}`") for c in self.columns()]
        return self.spark.table(self.name).select(*cols).unionAll(self.spark.table(self.unkeyed).select(*cols))

    def exists(self) -> bool:
        return all(self.spark.catalog.tableExists(t) for t in (self.name, self.unkeyed, self.runs))

    def applied(self, run: str) -> bool:
        return not self.spark.table(self.runs).where(F.col(RUN) == run).isEmpty()

    def _fit(self, batch: DataFrame) -> DataFrame:
        """Adds columns that only the batch has to the target, and returns the
        batch with all columns of the target. A column whose type differs is
        refused: inserting would change its values."""
        have = {f.name: f.dataType for f in self.spark.table(self.name).schema.fields if f.name != BUCKET}
        fields = {f.name: f.dataType for f in batch.schema.fields}
        differ = [c for c, t in fields.items() if c in have and have[c] != t]
        if differ:
            raise ValueError(f"types differ from the target's: {', '.join(differ)}")
        if set(self.key) - set(fields):
            raise ValueError("the batch lacks a key column")
        for c in [c for c in fields if c not in have]:
            for table in (self.name, self.unkeyed):
                if c not in self.spark.table(table).columns:
                    self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{c}` {fields[c].simpleString()})")
        every = {**have, **fields}
        return batch.select(*[F.col(f"`{c}`") if c in fields else F.lit(None).cast(t).alias(c)
                              for c, t in every.items()])

    def hot(self, touched: Sequence[int]) -> bool:
        """Whether one of these folders is much larger than the others. A scan
        dealt by the key reads a folder in one task; a hot folder is read in
        splits and shuffled instead, where AQE splits it again for the join.
        The counts come from the files' footers, no column is read."""
        seen = (self.spark.table(self.name).where(F.col(BUCKET).isin(list(touched))).groupBy(BUCKET).count()
                .agg(F.max("count"), F.sum("count")).first())
        return (seen[0] or 0) * len(touched) > HOT * (seen[1] or 0)

    def merged(self, batch: DataFrame, touched: Sequence[int]) -> DataFrame:
        """The new rows of the touched folders: what they hold but for the
        batch's keys, and the keyed rows of the batch."""
        old = self.spark.table(self.name).where(F.col(BUCKET).isin(list(touched)))
        kept = match_keys(old, distinct_keys(batch, self.key), self.key, "left_anti")
        return kept.select(*old.columns).unionAll(self._dealt(batch).select(*old.columns))

    def upsert(self, batch: DataFrame, run: str, order_cols: Sequence[Column | str] | None = None,
               written: bool = False) -> list[int]:
        """Applies a batch as run ``run`` and returns the folders rewritten.

        Without ``order_cols`` all batch rows replace the target rows of their
        key (delete-insert); with them the last batch row of each key does.
        Rows without a whole key never match and are added. A run already
        applied changes nothing. An empty batch rewrites no folder. A batch is
        written once before it is applied, unless it is a table already
        (``written``) and taken as it is.
        """
        if not run:
            raise ValueError("a run needs a name")
        if self.applied(run):
            return []
        if order_cols is not None:
            batch = dedup_last_wins(batch, self.key, order_cols)
        staged = self._fit(batch)
        if not written or order_cols is not None:
            staged = materialize(staged, fresh_scratch(self.spark, "bucket-batch"))
        # one number per folder at most
        touched = sorted(r[0] for r in self._dealt(staged).select(BUCKET).distinct().collect())
        with _setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            if touched:
                dealt = "false" if self.hot(touched) else "true"
                with _setting(self.spark, "spark.sql.sources.bucketing.enabled", dealt):
                    self.merged(staged, touched).write.insertInto(self.name, overwrite=True)
            (staged.where(~self._has_key()).withColumn(RUN, F.lit(run))
             .select(*self.spark.table(self.unkeyed).columns).write.insertInto(self.unkeyed, overwrite=True))
            (self.spark.range(1).select(F.current_timestamp().alias("applied_at"), F.lit(run).alias(RUN))
             .write.insertInto(self.runs, overwrite=True))
        return touched

    def forget(self) -> None:
        """Takes the three tables out of the catalog (files of external tables stay)."""
        for table in (self.name, self.unkeyed, self.runs):
            try:
                self.spark.sql(f"DROP TABLE {table}")
            except AnalysisException as e:
                if "TABLE_OR_VIEW_NOT_FOUND" not in str(e):
                    raise
