"""Change capture: applying the difference gives the new version."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelwing import session
from parcelwing.operators import cdc
from parcelwing.sources import adapter
from parcelwing.streaming import jobs

SCHEMA = "id int, name string, size int"
tables = st.dictionaries(st.integers(0, 12), st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])))
quick = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, table):
    return spark.createDataFrame([(k, *v) for k, v in table.items()], SCHEMA)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@quick
@given(old=tables, new=tables)
def test_merging_the_changes_gives_the_new_version(spark, old, new):
    before, after = frame(spark, old), frame(spark, new)
    diff = cdc.changes(before, after, ["id"])
    merged = cdc.merge(before, diff, ["id"])
    assert content(merged) == content(after)
    assert content(cdc.merge(merged, diff, ["id"])) == content(after)  # a replay changes nothing


@quick
@given(versions=st.lists(tables, min_size=3, max_size=3))
def test_net_changes_equal_the_direct_difference(spark, versions):
    frames = [frame(spark, v) for v in versions]
    log = cdc.changes(frames[0], frames[1], ["id"]).withColumn("v", F.lit(1)).unionByName(
        cdc.changes(frames[1], frames[2], ["id"]).withColumn("v", F.lit(2)))
    assert content(cdc.net(log, ["id"], "v")) == content(cdc.changes(frames[0], frames[2], ["id"]))


def test_an_update_is_a_flagged_pair(spark):
    old, new = frame(spark, {1: ("a", 1), 2: ("b", 2), 3: ("a", 3)}), frame(spark, {1: ("a", 9), 3: ("a", 3), 4: (None, None)})
    rows = {(r.id, r._cdc_action, r._cdc_is_update, r["size"]) for r in cdc.changes(old, new, ["id"]).collect()}
    assert rows == {(1, "DELETE", True, 1), (1, "INSERT", True, 9), (2, "DELETE", False, 2), (4, "INSERT", False, None)}


def test_first_read_is_all_inserts_with_stable_ids(spark):
    df = frame(spark, {1: ("a", 1), 2: ("b", 2)})
    first, again = cdc.initial_snapshot(df, ["id"]), cdc.initial_snapshot(df.repartition(3), ["id"])
    assert {(r._cdc_action, r._cdc_is_update) for r in first.collect()} == {("INSERT", False)}
    assert {(r.id, r._cdc_row_id) for r in first.collect()} == {(r.id, r._cdc_row_id) for r in again.collect()}


def test_soft_delete_marks_and_revives(spark):
    v0, v1 = frame(spark, {1: ("a", 1), 2: ("b", 2)}), frame(spark, {2: ("b", 5)})
    day1, day2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    kept = cdc.soft_merge(v0, cdc.changes(v0, v1, ["id"]), ["id"], day1)
    assert content(kept) == sorted([(1, "a", 1, True, day1), (2, "b", 5, False, None)], key=str)
    replayed = cdc.soft_merge(kept, cdc.changes(v0, v1, ["id"]), ["id"], day2)
    assert content(replayed) == content(kept)
    revived = cdc.soft_merge(kept, cdc.changes(v1, v0, ["id"]), ["id"], day2)
    assert content(revived) == sorted([(1, "a", 1, False, None), (2, "b", 2, False, None)], key=str)


def test_dedup_keeps_the_latest_row(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 3), (1, "b", 3), (2, None, None)], SCHEMA)
    assert content(cdc.dedup(df, ["id"], ["size"])) == sorted([(1, "b", 3), (2, None, None)], key=str)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(versions=st.lists(tables, min_size=4, max_size=4), data=st.data())
def test_any_cut_into_batches_gives_the_last_version(spark, versions, data):
    """Change rows of three versions in random batches, out of order and some of them repeated."""
    frames = [frame(spark, v) for v in versions]
    rows = [r for n, (a, b) in enumerate(zip(frames, frames[1:]), 1)
            for r in cdc.stamped(cdc.changes(a, b, ["id"]), n).collect()]
    schema = cdc.stamped(cdc.changes(frames[0], frames[1], ["id"]), 1).schema
    shuffled = data.draw(st.permutations(rows + rows[::2]))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(shuffled)), min_size=2, max_size=2)))
    log = session.scratch(spark, "log")
    for number, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(shuffled)])):
        jobs._batch_writer(log, "s")(spark.createDataFrame(shuffled[low:high], schema), number)
    assert content(jobs.current_state(frames[0], log, ["id"], after=0)) == content(frames[-1])
    assert content(jobs.current_state(frames[0], log, ["id"], after=0, upto=2)) == content(frames[2])
    # a base as of version 2: the rows before it, replayed or not, have no say any more
    base = jobs.compact(frames[0], log, ["id"], session.scratch(spark, "base"), after=0, upto=2)
    assert content(jobs.current_state(base, log, ["id"], after=2)) == content(frames[-1])


def test_settled_version_stops_before_a_gap(spark):
    log = session.scratch(spark, "log")
    frames = [frame(spark, {1: ("a", n)}) for n in range(6)]
    for n in (1, 2, 4, 5):
        rows = cdc.stamped(cdc.changes(frames[n - 1], frames[n], ["id"]), n)
        jobs._batch_writer(log, "s")(rows, n)
    assert jobs.settled_version(spark, log) == 2
    assert jobs.settled_version(spark, log, after=3) == 5
    assert jobs.settled_version(spark, log, after=5) == 5
    assert {(r[0], r["rows"]) for r in jobs.stale_changes(spark, log, 2).collect()} == {(1, 2), (2, 2)}


def test_streams_with_other_checkpoints_keep_their_folders(spark):
    """Two change sets, each by a stream of its own, into one log; both in one batch each, the later first."""
    v0, v1, v2 = adapter.customer_versions(spark, "/root/testdata/sf0.001")
    keys, log = ["customer_id"], session.scratch(spark, "log")
    sets = [cdc.stamped(cdc.changes(v1, v2, keys), 2), cdc.stamped(cdc.changes(v0, v1, keys), 1)]
    for rows in sets:
        inbox = session.scratch(spark, "inbox")
        rows.write.parquet(inbox)
        jobs.apply_changes(jobs.change_stream(spark, inbox, rows.schema), log, session.scratch(spark, "checkpoint"))
    assert content(jobs.current_state(v0, log, keys, after=0)) == content(v2)


def test_counting_changes_moves_no_images(spark, capsys):
    """Two versions meet by key and mark; columns that nobody asks for stay out of the join."""
    old, new = frame(spark, {1: ("a", 1), 2: ("b", 2)}), frame(spark, {1: ("a", 2)})
    counted = cdc.changes(old, new, ["id"]).groupBy(cdc.ACTION, cdc.IS_UPDATE).count()
    assert content(counted) == sorted([("DELETE", False, 1), ("DELETE", True, 1), ("INSERT", True, 1)], key=str)
    counted.explain("formatted")
    joined = capsys.readouterr().out.split("Exchange\n")[1:]
    assert joined and not any("_old" in part or "_new" in part for part in joined)


def test_marks_tell_nulls_zeros_and_nested_values_as_a_comparison_does(spark):
    schema = "id int, a string, b string, x double, l array<int>, s struct<p: int, q: int>, v decimal(9, 2)"
    base = ("p", None, 0.0, [None, 1], (None, 1), None)
    nan = float("nan")
    others = [(None, "p", *base[2:]), ("", *base[1:]), (*base[:3], [1, None], *base[4:]), (*base[:4], (1, None), None),
              (*base[:2], nan, *base[3:]), (*base[:3], None, *base[4:]), (*base[:2], 1e-300, *base[3:])]
    same = [base, (*base[:2], -0.0, *base[3:])]
    rows = [*others, *same]
    old = spark.createDataFrame([(k, *base) for k in range(len(rows))] + [(99, None, None, nan, None, None, None)], schema)
    new = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)] + [(99, None, None, nan, None, None, None)], schema)
    assert {r.id for r in cdc.changes(old, new, ["id"]).collect()} == set(range(len(others)))
