import random
from datetime import datetime, timedelta

from tallyweave.operators.orphans import OrphanState, step

T0 = datetime(2024, 1, 1)
REF, PAR = "ref_id long, ref_key string, ref_at timestamp_ntz, valid_to string", "parent_id long, ref_key string, valid_from timestamp_ntz, valid_to timestamp_ntz, reason string"


def day(n):
    return None if n is None else T0 + timedelta(days=n)


def brute(refs, parents):
    out = {}
    for i, key, at, _ in refs:
        key = (key or "").strip()
        if not key:
            continue
        mine = [p for p in parents if p[1] == key]
        known = [p for p in mine if at is not None and p[2] is not None and p[2] <= at]
        if not mine:
            out[i] = "missing"
        elif not known:
            out[i] = "late"
        elif all(p[3] is not None and p[3] <= at for p in known):
            out[i] = "deleted"
    return out


def made(seed, n=300, hot=True):
    rnd = random.Random(seed)
    key = lambda: "hot" if hot and rnd.random() < 0.35 else f"k{rnd.randrange(25)}"
    refs = [(i, rnd.choice([key(), f" {key()}\t", None, "  ", "never"]) if rnd.random() < 0.3 else key(), day(rnd.randrange(100)) if rnd.random() < 0.98 else None, "x") for i in range(n)]
    parents = [(i, key() if rnd.random() < 0.97 else None, day(rnd.randrange(100)), None, "x") for i in range(60)]
    parents = [(i, k, a, a + timedelta(days=rnd.randrange(30)) if rnd.random() < 0.6 else None, r) for i, k, a, _, r in parents]
    return refs, parents


def got(state):
    return {r["ref_id"]: r["reason"] for r in state.orphans().collect()}


def test_against_brute_force(spark):
    for seed in range(2):
        refs, parents = made(seed)
        for n in (1, 7):
            s = step(OrphanState.new(spark, buckets=4), spark.createDataFrame(refs, REF).repartition(n), spark.createDataFrame(parents, PAR))
            assert got(s) == brute(refs, parents)


def test_batches_give_what_one_pass_gives(spark):
    refs, parents = made(9)
    s = step(OrphanState.new(spark, buckets=4), new_refs=spark.createDataFrame(refs[:150], REF))
    assert set(got(s).values()) == {"missing"}
    s = step(s, new_parents=spark.createDataFrame([(i, k, a, None, r) for i, k, a, _, r in parents], PAR))
    s = step(s, new_refs=spark.createDataFrame(refs[150:], REF), new_parents=spark.createDataFrame(parents[:30], PAR))
    s = step(s, new_parents=spark.createDataFrame(parents[30:], PAR))
    assert got(s) == brute(refs, parents)
    months = {(r["period"], r["reason"]): r["orphans"] for r in s.snapshot("t").collect()}
    assert sum(months.values()) == len(got(s))


def test_empty_tables(spark):
    refs, parents = spark.createDataFrame([], REF), spark.createDataFrame([], PAR)
    assert got(step(OrphanState.new(spark, buckets=4), refs, parents)) == {}
    some = spark.createDataFrame([(1, "a", day(1), "x"), (1, "a", day(1), "x")], REF)
    assert step(OrphanState.new(spark, buckets=4), some, parents).orphans().count() == 2


def test_parents_may_move_to_another_key_and_lack_a_start(spark):
    refs = [(1, "a", day(5), "x"), (2, "b", day(5), "x"), (3, "c", day(5), "x")]
    first = [(1, "a", day(1), None, "x"), (2, "c", None, None, "x")]
    s = step(OrphanState.new(spark, buckets=4), spark.createDataFrame(refs, REF), spark.createDataFrame(first, PAR))
    assert got(s) == {2: "missing", 3: "late"}
    s = step(s, new_parents=spark.createDataFrame([(1, "b", day(1), None, "x"), (2, "c", day(2), day(3), "x")], PAR))
    assert got(s) == {1: "missing", 3: "deleted"}
    s = step(s, spark.createDataFrame([(4, "a", day(9), "x")], REF), spark.createDataFrame([(1, "a", day(6), None, "x"), (1, "a", day(6), None, "x")], PAR))
    assert got(s) == {1: "late", 2: "missing", 3: "deleted"}


def test_a_small_batch_reads_the_buckets_of_its_keys(spark):
    refs = [(i, f"k{i % 300}", day(5), "x") for i in range(3000)]
    s = step(OrphanState.new(spark, buckets=4), spark.createDataFrame(refs, REF), spark.createDataFrame([(i, f"k{i}", day(1), None, "x") for i in range(300)], PAR))
    batch = spark.createDataFrame([(7, "k7", day(1), day(2), "x")], PAR)
    at = s.buckets_of(batch, "ref_key")
    plan = s.read("refs", at)._jdf.queryExecution().executedPlan().toString()
    assert len(at) == 1 and "PartitionFilters: [isnotnull(bucket" in plan
    s = step(s, new_parents=batch)
    assert s.read("refs").where(f"v = {s.v}").count() == s.read("index").where(f"v = {s.v}").count() * 10 == 10 and len(got(s)) == 10
