"""Tables with loads and versions: the key index, the landing ledger, rebuilds."""

import pytest
from pyspark.sql import functions as F

from foodgrid.operators.dedup import asc
from foodgrid.sinks import keyed
from foodgrid.session import shared_folder
from foodgrid.sinks.commits import CommitLog
from foodgrid.sinks.keyed import KeyedTable
from foodgrid.sinks.versions import VersionedTable

SCHEMA = "id string, v string, t long"


def rows_of(table):
    return sorted(((r["id"], r["v"], r["load"]) for r in table.rows().collect()), key=str)


def batch(spark, rows):
    return spark.createDataFrame([(i, v, t) for t, (i, v) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize("capacity", [4, 1 << 12])
def test_keyed_table_loads_each_key_once(spark, tmp, capacity):
    table = KeyedTable(spark, f"{tmp}/t", SCHEMA, buckets=4, capacity=capacity)
    assert table.rows().collect() == []
    # a target may hold a key many times, and keeps it so
    table.append_all(batch(spark, [("a", "1"), ("a", "2"), (None, "x"), ("b", "3")]))
    new = batch(spark, [("c", "first"), ("c", "second"), ("a", "no"), (None, "no"), ("d", "4")])
    table.append(new, [asc("t")])
    want = [("a", "1", 1), ("a", "2", 1), (None, "x", 1), ("b", "3", 1), ("c", "first", 2), ("d", "4", 2)]
    assert rows_of(table) == sorted(want, key=str)
    table.append(new, [asc("t")])       # again: nothing
    table.append(new.limit(0), [asc("t")])
    assert rows_of(table) == sorted(want, key=str)
    assert [e["rows"] for e in table.log.entries()] == [4, 2, 0, 0]
    # another session finds rows, index and filter by the path alone
    spark.sql(f"drop table {table.name}")
    other = KeyedTable(spark, f"{tmp}/t", SCHEMA, buckets=4, capacity=capacity)
    other.append(batch(spark, [("d", "no"), ("e", "5")] + [(f"k{i}", "n") for i in range(300)]), [asc("t")])
    assert len(rows_of(other)) == len(want) + 301


def test_keyed_table_survives_a_dead_load(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", SCHEMA, buckets=2)
    table.append_all(batch(spark, [("a", "1")]))
    torn = batch(spark, [("b", "2"), ("c", "3")]).withColumn("v", F.raise_error(F.lit("torn")))
    with pytest.raises(Exception, match="torn"):
        table.append(torn, [asc("t")])
    # one that wrote rows and keys but no record
    table.log.add, kept = (lambda **k: (_ for _ in ()).throw(RuntimeError("dead"))), table.log.add
    with pytest.raises(RuntimeError, match="dead"):
        table.append(batch(spark, [("b", "lost")]), [asc("t")])
    table.log.add = kept
    assert rows_of(table) == [("a", "1", 1)]
    table.append(batch(spark, [("b", "2")]), [asc("t")])
    assert rows_of(table) == [("a", "1", 1), ("b", "2", 2)]


def test_index_is_neither_exchanged_nor_broadcast(spark, tmp):
    table = KeyedTable(spark, f"{tmp}/t", SCHEMA, buckets=8)
    table.append_all(batch(spark, [(f"k{i}", "x") for i in range(200)]))
    plan = table.absent(batch(spark, [("k1", "a"), ("z", "b")]))._jdf.queryExecution().executedPlan().toString()
    index = plan[plan.index("FileScan parquet"):]
    assert "SelectedBucketsCount: 8 out of 8" in index and "SortMergeJoin" in plan and "Broadcast" not in plan
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("FileScan parquet")
    assert "/rows/" not in plan


def test_bloom_blocks_have_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).selectExpr("concat('k', id) as id")
    blocks = -(-20_000 * keyed.BITS_PER_KEY // keyed.BLOCK_BITS)
    bloom = keyed.bloom_of(keys, "id", blocks).cache()
    both = keys.withColumn("there", F.lit(True)).unionByName(
        spark.range(20_000).selectExpr("concat('other', id) as id", "false as there"))
    got = both.withColumn("block", keyed._block("id", blocks)).join(bloom, "block", "left") \
        .groupBy("there").agg(F.avg(keyed.seen("id").cast("int")).alias("share")).collect()
    share = {r["there"]: r["share"] for r in got}
    assert share[True] == 1 and share[False] < 0.03


def test_rebuild_keeps_the_old_rows_until_the_new_ones_are_whole(spark, tmp):
    table = VersionedTable(spark, f"{tmp}/v")
    with pytest.raises(LookupError):
        table.read()
    table.rebuild(spark.range(3))
    before = table.read()
    with pytest.raises(Exception, match="torn"):
        table.rebuild(spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(
            F.raise_error(F.lit("torn")))))
    assert table.read().count() == 3
    table.rebuild(table.read().union(spark.range(5)).withColumn("x", F.lit("y")))   # reads what it replaces
    assert table.read().columns == ["id", "x"] and table.read().count() == 8
    assert table.read(1).count() == before.count() == 3
    table.rebuild(spark.range(1))
    assert table.read().count() == 1 and table.read(1).count() == 8
    with pytest.raises(LookupError):
        table.read(2)


def test_commit_log_tells_two_writers(spark, tmp):
    one = CommitLog(spark, f"{tmp}/c", "x string")
    one.add(x="a")
    two = CommitLog(spark, f"{tmp}/c", "x string")
    two.entries = lambda: []
    two.add(x="b")
    with pytest.raises(RuntimeError, match="more than one writer"):
        one.entries()
    assert shared_folder(spark, "t") != shared_folder(spark, "t")


# --- landing: sizes, ledger ------------------------------------------------------

HITS = "id string, name string, term string, location_index int"


def landed(path):
    import glob
    import os
    return {os.path.relpath(f, path): open(f, "rb").read() for f in glob.glob(f"{path}/**/*.json", recursive=True)}


def test_landing_files_follow_the_pairs_sizes(spark, tmp):
    from foodgrid.sinks import writers
    path = f"{tmp}/landing"
    hot = spark.range(6000).selectExpr("concat('h', id) as id", "repeat('x', 40) as name", "'Food' as term",
                                       "0 as location_index")
    few = spark.createDataFrame([("a", "n", "Food", 1), ("b", "n", "Desserts", 0), ("c", "n", None, 2)], HITS)
    writers.write_landing(hot.unionByName(few), path, target_bytes=64_000)
    before = landed(path)
    sizes = [len(v) for k, v in before.items() if k.startswith("term=Food/location_index=0/")]
    assert len(before) == len(sizes) + 3                # a small pair is one file
    assert 5 <= len(sizes) <= 16 and max(sizes) < 2 * 64_000
    writers.write_landing(spark.createDataFrame([("z", "n", "Food", 1)], HITS), path, target_bytes=64_000)
    after = landed(path)
    own = "term=Food/location_index=1/"
    assert {k: v for k, v in after.items() if not k.startswith(own)} == \
        {k: v for k, v in before.items() if not k.startswith(own)}
    assert [v for k, v in after.items() if k.startswith(own)] == [b'{"id":"z","name":"n"}\n']
    writers.write_landing(few.limit(0), path)
    assert landed(path) == after


def ledgered(spark, tmp, unit):
    from foodgrid.sinks.ledger import LedgeredTable
    return LedgeredTable(spark, f"{tmp}/raw", "id string, name string, feed string", unit, ("id",))


def reader(spark):
    return lambda paths: spark.read.schema("id string, name string").json(paths) \
        .select("*", F.col("_metadata.file_path").alias("file_path"))


def to_rows(df):
    return df.withColumn("feed", F.substring("id", 1, 1))


def test_ledger_loads_a_file_once_and_replaces_a_changed_one(spark, tmp):
    import os
    from tests.fixtures import write
    from foodgrid.sinks.ledger import by_file
    land = f"{tmp}/land"
    table = ledgered(spark, tmp, by_file)
    names = ["Coffee & Tea-La Cañada-1.json", "Food-a%2Fb-2.json", "Food-empty-3.json"]
    write(land, names[0], '{"id":"a1","name":"x"}\n{"id":"b1","name":"x"}\n')
    write(land, names[1], '{"id":"a2","name":"x"}\n{"id":"a2","name":"x"}\n')
    write(land, names[2], "")
    get = lambda: sorted((r["id"], r["name"], r["batch"]) for r in table.rows().collect())
    assert table.load(land, reader(spark), to_rows) == 2        # a file of no bytes is no unit
    first = [("a1", "x", 1), ("a2", "x", 1), ("a2", "x", 1), ("b1", "x", 1)]
    assert get() == first
    assert table.load(land, reader(spark), to_rows) == 0 and get() == first     # a rerun adds nothing
    write(land, names[1], '{"id":"a2","name":"changed"}\n')
    write(land, "sub/new.json", '{"id":"c","name":"y"}\n')
    # a load that dies leaves the old rows, and is made good by the next one
    with pytest.raises(Exception, match="torn"):
        table.load(land, reader(spark), lambda df: to_rows(df).withColumn("name", F.raise_error(F.lit("torn"))))
    assert get() == first
    assert table.load(land, reader(spark), to_rows) == 2
    assert get() == [("a1", "x", 1), ("a2", "changed", 2), ("b1", "x", 1), ("c", "y", 2)]
    os.remove(os.path.join(land, names[0]))      # what vanished keeps its rows
    assert table.load(land, reader(spark), to_rows) == 0 and len(get()) == 4
    write(land, names[1], '{"id":null,"name":"changed again"}\n')
    with pytest.raises(Exception, match="NULL in required column id"):
        table.load(land, reader(spark), to_rows)
    assert table.superseded().count() == 1


def test_ledger_by_folder_reads_rewritten_pairs_only(spark, tmp):
    from foodgrid.sinks import writers
    from foodgrid.sinks.ledger import by_folder
    path = f"{tmp}/land"
    table = ledgered(spark, tmp, by_folder)
    rows = [(f"{c}{i}", "x", t, i) for c, t in (("f", "Food"), ("c", "Coffee & Tea")) for i in range(3)]
    writers.write_landing(spark.createDataFrame(rows, HITS), path)
    assert table.load(path, reader(spark), to_rows) == 6
    writers.write_landing(spark.createDataFrame([("c9", "y", "Coffee & Tea", 1)], HITS), path)
    seen = []
    assert table.load(path, lambda p: (seen.extend(p), reader(spark)(p))[1], to_rows) == 1
    assert len(seen) == 1
    got = sorted((r["id"], r["batch"]) for r in table.rows().collect())
    assert got == [("c0", 1), ("c2", 1), ("c9", 2), ("f0", 1), ("f1", 1), ("f2", 1)]


# --- lists: positions, quarantine, ranges --------------------------------------------

def test_positions_of_many_files_in_many_splits(spark, tmp):
    from foodgrid.schemas import CITY_LOCATIONS
    from foodgrid.sources import files
    from tests.fixtures import write
    want = []
    for f, n in (("b.csv", 700), ("a.csv", 300), ("c.csv", 0), ("d.csv", 1)):
        lines = [f"{f}{i},{i}.5,-1.0" for i in range(n)]
        write(f"{tmp}/cities", f, "Name,Latitude,Longitude\n" + "".join(x + "\n" for x in lines))
        want.append((f, lines))
    names = [x.split(",")[0] for _, lines in sorted(want) for x in lines]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, cost in (("700", "1"), ("4000", "1"), ("128m", "4m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            df = files.read_csv(spark, f"{tmp}/cities", CITY_LOCATIONS)
            tasks = df.rdd.getNumPartitions()
            for ranges in (1, 6):
                got = files.with_position(df, ranges=ranges).collect()
                assert [r["Name"] for r in sorted(got, key=lambda r: r["position"])] == names
                assert sorted(r["position"] for r in got) == list(range(len(names)))
        assert tasks < 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", "4m")


def test_bad_list_rows_go_to_quarantine(spark, tmp):
    from foodgrid.schemas import CITY_LOCATIONS
    from foodgrid.sources import files
    from tests.fixtures import write
    text = 'Name,Latitude,Longitude\n"San, Jose",37.3,-121.9\nx,abc,1\ny,1\n,2,3\nz,1,2,3\nw,north,east\nv,,\n'
    path = write(tmp, "cities.csv", text)
    good, bad, counts = files.load_checked(spark, path, CITY_LOCATIONS, f"{tmp}/out")
    assert good.columns == ["Name", "Latitude", "Longitude"] and counts == {"accepted": 3, "rejected": 4}
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("San, Jose", 37.3, -121.9), (None, 2.0, 3.0), ("v", None, None)], key=str)
    assert {(r["line"], r["reason"]) for r in bad.collect()} == {
        ("x,abc,1", "Latitude: abc is not double"), ("y,1", "number of fields"), ("z,1,2,3", "number of fields"),
        ("w,north,east", "Latitude: north is not double; Longitude: east is not double")}


def test_ranges_take_every_row_once_on_a_skewed_key(spark):
    from foodgrid.sources import files
    df = spark.range(6000).selectExpr("case when id % 3 = 0 then 7 when id % 50 = 0 then null else id * id end as k",
                                      "id")
    conditions = files.key_ranges(df, "k", 8)
    assert len(set(conditions)) == len(conditions) <= 9
    counts = [df.filter(c).count() for c in conditions]
    assert sum(counts) == 6000
    union = df.filter(conditions[0])
    for c in conditions[1:]:
        union = union.unionAll(df.filter(c))
    assert sorted(r["id"] for r in union.collect()) == list(range(6000))
    rest = sorted(counts)[:-2]       # without the hot value's range and the nulls
    assert max(rest) < 3 * 6000 / 8
    got = files.read_ranges(df, "k", 8)
    assert {r["key_range"]: r["count"] for r in got.groupBy("key_range").count().collect()} == \
        {i: c for i, c in enumerate(counts) if c}
    assert files.key_ranges(df.filter("k is null"), "k", 4) == ["k is not null", "k is null"]
