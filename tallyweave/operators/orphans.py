"""References to records that do not exist: keyed orphan state, kept up batch by batch."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyweave.operators.skew import hot_keys, salted_join
from tallyweave.session import checkpoint_dir

FAR = "9999-12-31 00:00:00"


def stripped(col: Column) -> Column:
    """col without white space of any kind at either end."""
    return F.regexp_replace(col, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def parent_index(parents: DataFrame, salts: int = 16) -> DataFrame:
    """(ref_key, first_from, steps) of parents (ref_key, valid_from, valid_to).

    A key is alive at t if some row has valid_from <= t < valid_to; that is so exactly if the greatest valid_to among rows with
    valid_from <= t lies after t. steps keeps only rows that raise this maximum, ordered by valid_from. Rows of one key are
    reduced in `salts` parts before they meet, so a hot key costs no single task; a part keeps just its rising rows. Rows without valid_from are never
    alive; a key that has no other keeps an empty staircase.
    """
    rows = parents.where("ref_key is not null").groupBy("ref_key", "valid_from").agg(F.max(F.coalesce("valid_to", F.lit(FAR).cast("timestamp_ntz"))).alias("valid_to"))

    def rising(steps: Column) -> Column:
        empty = F.expr("cast(array() as array<struct<valid_from:timestamp_ntz,valid_to:timestamp_ntz>>)")
        return F.aggregate(F.array_sort(steps), empty, lambda acc, s: F.when((F.size(acc) == 0) | (s["valid_to"] > F.try_element_at(acc, F.lit(-1))["valid_to"]), F.concat(acc, F.array(s))).otherwise(acc))

    step = F.struct("valid_from", "valid_to")
    part = rows.groupBy("ref_key", F.pmod(F.xxhash64("valid_from"), F.lit(salts)).alias("_salt")).agg(F.min("valid_from").alias("first_from"), rising(F.collect_list(F.when(F.col("valid_from").isNotNull(), step))).alias("steps"))
    return part.groupBy("ref_key").agg(F.min("first_from").alias("first_from"), rising(F.flatten(F.collect_list("steps"))).alias("steps"))


def probe(refs: DataFrame, index: DataFrame, hot: list | None = None) -> DataFrame:
    """refs (ref_id, ref_key, ref_at) with reason: null (resolved), 'missing', 'late' or 'deleted'.

    missing: the key has no parent row. late: it has, but none with valid_from <= ref_at (also if ref_at is null). deleted: each
    parent row with valid_from <= ref_at has ended by then.
    """
    end = F.array_max(F.transform(F.filter("steps", lambda s: s["valid_from"] <= F.col("ref_at")), lambda s: s["valid_to"]))
    reason = (
        F.when(F.col("steps").isNull(), "missing")
        .when(F.coalesce(F.col("first_from") > F.col("ref_at"), F.lit(True)), "late")
        .when(end <= F.col("ref_at"), "deleted")
    )
    joined = salted_join(refs, index, "ref_key", "left", hot=hot, spread=F.xxhash64("ref_id"))
    return joined.select("ref_id", "ref_key", "ref_at", reason.alias("reason"))


@dataclass(frozen=True)
class OrphanState:
    """State of one reference, kept in a shared folder: each batch adds what it changes and reads only the buckets of the keys it brings.

    parents: rows (parent_id, ref_key, valid_from, valid_to, gone), the newest of a (ref_key, parent_id) counts; owners: the keys of each parent_id; index: the
    staircase of each key (see parent_index), the newest counts; refs: references with their reason, those older than their key's newest parent row were
    probed again and do not count any more. Every table has the batch `v` and a bucket of its key as folders. A batch that is run again after a failure writes its own
    folders anew. buckets: parts of the tables by key, to be chosen once by the state's size. hot: keys that were
    hot in some batch, fewer than skew.HOT_SHARE a batch.
    """

    spark: SparkSession
    folder: str
    buckets: int = 32
    v: int = 0
    kinds: dict[str, StructType] = field(default_factory=dict)
    hot: tuple[str, ...] = ()

    @staticmethod
    def new(spark: SparkSession, folder: str | None = None, buckets: int = 32) -> OrphanState:
        """An empty state in folder, or in one of its own below the session's shared checkpoint folder."""
        return OrphanState(spark, folder or f"{checkpoint_dir(spark)}/orphans-{uuid.uuid4().hex}", buckets)

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, df: DataFrame, key: str) -> list[int]:
        """The buckets of df's keys."""
        return sorted(r[0] for r in df.select(self.bucket(key).alias("b")).distinct().collect())

    def written(self, table: str, df: DataFrame, key: str, spread: str | None = None) -> OrphanState:
        """The state with df added to a table as its next batch; with `spread`, a bucket is written by up to eight tasks, so that a hot key burdens none."""
        v = self.v + 1
        df = df.withColumn("bucket", self.bucket(key))
        df.repartition("bucket", *([F.pmod(F.xxhash64(spread), F.lit(8))] if spread else [])).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/{table}/v={v}")
        return replace(self, kinds={table: StructType([*df.drop("bucket").schema.fields, *self.spark.range(0).selectExpr("0 as v", "0 as bucket").schema.fields]), **self.kinds})

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame | None:
        """A table, or the named buckets of it; None before its first row."""
        if table not in self.kinds:
            return None
        df = self.spark.read.schema(self.kinds[table]).parquet(f"{self.folder}/{table}")
        return df if buckets is None else df.where(F.col("bucket").isin(buckets))

    def index(self, buckets: list[int] | None = None) -> DataFrame | None:
        df = self.read("index", buckets)
        return None if df is None else df.groupBy("ref_key").agg(F.max_by(F.struct("first_from", "steps"), "v").alias("x")).select("ref_key", "x.first_from", "x.steps")

    def refs(self, buckets: list[int] | None = None, waiting: bool = False, before: int | None = None) -> DataFrame | None:
        """References that count now (or did before a batch), or only those that wait for a parent."""
        df, again = self.read("refs", buckets), self.read("parents", buckets)
        if df is None:
            return None
        df = df.where("reason is not null") if waiting else df
        if before is not None:
            df, again = (x if x is None else x.where(F.col("v") < before) for x in (df, again))
        if again is None:
            return df.select("ref_id", "ref_key", "ref_at", "reason")
        last = again.groupBy("ref_key").agg(F.max("v").alias("last"))
        return salted_join(df, last, "ref_key", "left", hot=list(self.hot), spread=F.xxhash64("ref_id")).where("last is null or v >= last").select("ref_id", "ref_key", "ref_at", "reason")

    def orphans(self) -> DataFrame:
        """References that wait for a parent now."""
        return self.refs(waiting=True)

    def snapshot(self, table: str) -> DataFrame:
        """Orphans of a table by month of the reference: (table_name, period, reason, orphans)."""
        return self.orphans().groupBy(F.lit(table).alias("table_name"), F.date_format("ref_at", "yyyy-MM").alias("period"), "reason").agg(F.count(F.lit(1)).alias("orphans"))


def step(state: OrphanState, new_refs: DataFrame | None = None, new_parents: DataFrame | None = None) -> OrphanState:
    """The state after one batch of references (ref_id, ref_key, ref_at) and parent rows (parent_id, ref_key, valid_from, valid_to).

    New references probe the index of their keys. A parent row that arrives resolves what waits for its key; a row of a known parent_id
    replaces the earlier ones, so a deletion (valid_to set) reopens what it had resolved: the index is rebuilt for the keys of new and replaced rows
    only, and only references of these keys are probed again.

    Null, empty and blank keys are no references and are left out. Repeated rows stay; ref_id may repeat. Empty tables give
    empty states. Other columns of the inputs are not read.
    """
    v, todo = state.v + 1, None
    if new_parents is not None:
        new = new_parents.select("parent_id", "ref_key", "valid_from", "valid_to")
        gone = None
        owners = state.read("owners", state.buckets_of(new, "parent_id")) if "owners" in state.kinds else None
        state = state.written("owners", new.select("parent_id", "ref_key").distinct(), "parent_id")
        if owners is not None:  # keys that replaced rows had
            old = owners.select("parent_id", "ref_key").distinct().join(new.select("parent_id").distinct(), "parent_id", "left_semi")
            gone = old.join(new.select("parent_id", "ref_key").distinct(), ["parent_id", "ref_key"], "left_anti")
        rows = new.withColumn("gone", F.lit(False))
        if gone is not None:
            rows = rows.unionByName(gone.withColumn("gone", F.lit(True)), allowMissingColumns=True)
        state = state.written("parents", rows.where("ref_key is not null"), "ref_key", "parent_id")
        touched = state.read("parents").where(F.col("v") == v).select("ref_key").distinct()
        if owners is None:  # the first parents: all are alive, all keys are new
            at, index = None, parent_index(new)
        else:
            at = state.buckets_of(touched, "ref_key")
            known = state.read("parents", at).join(touched, "ref_key", "left_semi")
            last = known.groupBy("ref_key", "parent_id").agg(F.max("v").alias("v"))
            alive = known.join(last, ["ref_key", "parent_id", "v"], "left_semi").where("not gone")
            index = touched.join(parent_index(alive), "ref_key", "left")
        again = state.refs(at, before=v)
        state = state.written("index", index, "ref_key")
        if again is not None:
            todo = again.join(touched, "ref_key", "left_semi").select("ref_id", "ref_key", "ref_at")
    if new_refs is not None:
        new_refs = new_refs.select("ref_id", stripped(F.col("ref_key")).alias("ref_key"), "ref_at").where("ref_key <> ''")
        todo = new_refs if todo is None else todo.unionByName(new_refs)
    if todo is not None:
        index = state.index(state.buckets_of(todo, "ref_key") if v > 1 and "index" in state.kinds else None)
        hot = hot_keys(todo, "ref_key")
        state = replace(state, hot=tuple(sorted({*state.hot, *hot})))
        probed = todo.withColumn("reason", F.lit("missing")) if index is None else probe(todo, index, hot)
        state = state.written("refs", probed, "ref_key", "ref_id")
    return replace(state, v=v)
