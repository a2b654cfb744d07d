import pytest
from pyspark.sql import functions as F

from dimkeep.functions.predicates import differs
from dimkeep.operators.keys import assign_keys
from dimkeep.operators.merge import (
    ACTION,
    action_counts,
    delete_members,
    insert_new,
    mark_members,
    merge,
    rows_to_insert,
    survivors,
    update_where,
)

SCHEMA = "k int, n string"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d"), (-1, "sentinel")], SCHEMA)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "e"), (None, "q")], SCHEMA)


def plain(t, s):
    return differs(t("n"), s("n"))


def blank(t, s):
    return differs(t("n"), s("n"), "")


def test_plain_change_leaves_null_alone(target, source, rows):
    assert rows(merge(target, source, ["k"], changed=plain)) == sorted(
        [
            (1, "a", "NONE"), (2, "B", "UPDATE"), (3, None, "NONE"), (4, "d", "NONE"),
            (-1, "sentinel", "NONE"), (5, "e", "INSERT"), (None, "q", "INSERT"),
        ],
        key=repr,
    )


def test_blank_as_null_updates_null(target, source, rows):
    assert (3, "c", "UPDATE") in rows(merge(target, source, ["k"], changed=blank))


def test_gone_rows_are_deleted_but_counted(target, source, rows):
    merged = merge(target, source, ["k"], changed=blank, gone="delete", gone_if=lambda t: t("k") != -1)
    assert (4, "d", "DELETE") in rows(merged) and (-1, "sentinel", "NONE") in rows(merged)
    assert rows(action_counts(merged)) == [(2, 2, 1)]
    assert 4 not in [r[0] for r in rows(survivors(merged))]


def test_gone_rows_are_reset(target, source, rows):
    merged = merge(target, source, ["k"], changed=blank, gone={"n": "none"}, gone_if=lambda t: t("k") >= 4)
    assert (4, "none", "UPDATE") in rows(merged) and (-1, "sentinel", "NONE") in rows(merged)


def test_reset_condition_unknown_is_no(spark, source, rows):
    target = spark.createDataFrame([(9, None), (8, "x")], SCHEMA)
    merged = merge(target, source, ["k"], changed=plain, gone="delete", gone_if=lambda t: t("n") != "y")
    got = rows(merged)
    assert (9, None, "NONE") in got and (8, "x", "DELETE") in got


def test_second_run_changes_nothing(target, source, rows):
    keyed = source.where("k is not null")
    once = survivors(merge(target, keyed, ["k"], changed=blank))
    assert rows(action_counts(merge(once, keyed, ["k"], changed=blank))) == [(0, 0, 0)]


def test_null_key_goes_in_on_every_run(target, source, rows):
    once = survivors(merge(target, source, ["k"], changed=blank))
    assert rows(action_counts(merge(once, source, ["k"], changed=blank))) == [(1, 0, 0)]


CONSUMERS = {
    "count": lambda df: df.count(),
    "no_action": lambda df: df.drop(ACTION).collect(),
    "survivors": lambda df: survivors(df).collect(),
    "inserts": lambda df: df.where(F.col(ACTION) == "INSERT").collect(),
    "others": lambda df: df.where(F.col(ACTION) != "INSERT").collect(),
    "counts": lambda df: action_counts(df).collect(),
    "named": lambda df: df.where("n is not null").select("n").collect(),
}


@pytest.mark.parametrize("consumer", CONSUMERS)
@pytest.mark.parametrize("empty", [False, True])
def test_repeated_key_fails_however_the_result_is_used(spark, target, consumer, empty):
    source = spark.createDataFrame([(2, "B"), (2, "C"), (7, "x")], SCHEMA)
    target = spark.createDataFrame([], SCHEMA) if empty else target
    with pytest.raises(Exception, match="k=2"):
        CONSUMERS[consumer](merge(target, source, ["k"], changed=plain))


def test_unlisted_columns_keep_or_are_null(spark, rows):
    target = spark.createDataFrame([(1, "a", True)], "k int, n string, flag boolean")
    source = spark.createDataFrame([(1, "b"), (2, "c")], SCHEMA)
    assert rows(merge(target, source, ["k"])) == [(1, "b", True, "UPDATE"), (2, "c", None, "INSERT")]


def test_marker_columns_steer_and_vanish(spark, target, source, rows):
    members = spark.createDataFrame([(4,), (4,)], "k int")
    marked = mark_members(target, members, ["k"], "m")
    merged = merge(marked, source, ["k"], changed=plain, gone="delete", gone_if=lambda t: t("m"), markers=["m"])
    assert merged.columns == ["k", "n", ACTION]
    assert [r[0] for r in rows(merged) if r[2] == "DELETE"] == [4]


def test_target_rows_with_one_key_are_all_updated(spark, source, rows):
    target = spark.createDataFrame([(2, "b"), (2, "b"), (2, "B")], SCHEMA)
    merged = merge(target, source.where("k = 2"), ["k"], changed=plain)
    assert rows(merged) == [(2, "B", "NONE"), (2, "B", "UPDATE"), (2, "B", "UPDATE")]


def test_composite_key_with_partial_null(spark, rows):
    target = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "x int, y int, n string")
    source = spark.createDataFrame([(1, None, "A"), (1, 2, "B")], "x int, y int, n string")
    assert rows(merge(target, source, ["x", "y"])) == sorted(
        [(1, None, "a", "NONE"), (1, 2, "B", "UPDATE"), (1, None, "A", "INSERT")], key=repr
    )


def test_small_source_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id k", "cast(id as string) n").write.parquet(path)
    target, source = spark.read.parquet(path), spark.read.parquet(path).where("k < 3")
    plan = merge(target, source, ["k"], changed=plain)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_large_merge_shuffles_each_side_once(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id k", "cast(id as string) n").write.parquet(path)
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    try:
        merged = merge(spark.read.parquet(path), spark.read.parquet(path), ["k"], changed=plain)
        merged.collect()
        final = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        for name in names:
            spark.conf.unset(name)
    # Target, source, and the keys of both; the second uses are reused.
    assert final.count("+- Exchange hashpartitioning") == 4 and final.count("ReusedExchange") == 2


def test_insert_only(spark, rows):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    batch = spark.createDataFrame([(1, "z"), (2, "b"), (2, "b"), (None, "n")], SCHEMA)
    assert rows(rows_to_insert(target, batch, ["k"], distinct=False)) == sorted(
        [(2, "b"), (2, "b"), (None, "n")], key=repr
    )
    assert rows(insert_new(target, batch, ["k"])) == sorted(
        [(1, "a", "NONE"), (2, "b", "INSERT"), (None, "n", "INSERT")], key=repr
    )


def test_insert_only_fails_on_two_rows_for_a_new_key(spark):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    batch = spark.createDataFrame([(2, "b"), (2, "c")], SCHEMA)
    with pytest.raises(Exception, match="k=2"):
        insert_new(target, batch, ["k"]).collect()


def test_delete_and_update_where(spark, target, rows):
    gone = spark.createDataFrame([(1,), (9,)], "k int")
    assert [r[0] for r in rows(delete_members(target, gone, ["k"])) if r[2] == "DELETE"] == [1]
    changed = update_where(target, F.col("n") == "b", {"n": F.lit("x")})
    assert rows(action_counts(changed)) == [(0, 1, 0)]
    assert (3, None, "NONE") in rows(changed)


def test_keys_are_dense_and_stable(spark, rows):
    target = spark.createDataFrame([(7, "old"), (-1, "?")], SCHEMA)
    new = spark.range(5000).selectExpr("cast(id as string) n")
    first = rows(assign_keys(target, new, ["n"], "k"))
    assert sorted(k for k, _ in first) == list(range(8, 5008))
    assert rows(assign_keys(target, new.repartition(7), ["n"], "k")) == first


def test_keys_start_at_one_in_an_empty_table(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(assign_keys(empty, spark.createDataFrame([("x",)], "n string"), ["n"], "k")) == [(1, "x")]
