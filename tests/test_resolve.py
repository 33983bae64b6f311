import random

import pytest
from helpers import at, gated_events, one_at_a_time
from pyspark.sql import functions as F

from changeflow import model
from changeflow.operators import resolve

DAY_MS = 24 * 3600 * 1000


def random_log(rng, n, keys=6, hot=0.0, reused=0.0):
    """Events with swapped versions, ties, repeats near and far; ``reused`` of the new events take an id in use,
    for another version or another key."""
    events, made, ms = [], [], 0
    versions = {}
    for offset in range(n):
        ms += rng.choice([1, 50, 1000, 3_600_000, 20_000_000])
        if made and rng.random() < 0.35:
            event_id, p, w, v = rng.choice(made)
        else:
            k = 0 if rng.random() < hot else rng.randrange(keys)
            p, w = f"P{k % 3}", f"W{k}"
            versions[k] = versions.get(k, 0) + rng.choice([0, 1, 1, 2])
            v = max(1, versions[k] + rng.choice([-2, 0, 0, 1]))
            event_id = f"E{offset}"
            if made and rng.random() < reused:
                same_key = [m[0] for m in made[-30:] if (m[1], m[2]) == (p, w)]
                event_id = rng.choice(same_key or [made[-1][0]]) if rng.random() < 0.7 else rng.choice(made)[0]
            made.append((event_id, p, w, v))
        events.append((offset, event_id, p, w, v, ms + rng.choice([0, 0, -500])))
    return events


def labels_of(df):
    return {r.kafka_offset: r.result for r in df.select("kafka_offset", "result").collect()}


def state_of(df):
    return {(r.product_id, r.warehouse_id): (r.row_version, r.last_event_id) for r in df.collect()}


@pytest.mark.parametrize("seed, hot_rows", [(1, 10**6), (2, 10**6), (3, 25), (4, 7), (5, 1)])
def test_outcomes_equal_one_at_a_time(spark, seed, hot_rows):
    events = random_log(random.Random(seed), 400, hot=0.4)
    want, state, _ = one_at_a_time(events, DAY_MS)
    gated = gated_events(spark, events).cache()
    assert set(want.values()) == {"applied", "rejected", "skipped"}
    assert labels_of(resolve.event_outcomes(gated, hot_rows=hot_rows)) == want
    assert state_of(resolve.versioned_upsert(None, gated)) == state


@pytest.mark.parametrize("seed, hot_rows", [(11, 10**6), (12, 9)])
def test_any_batch_split_gives_the_same_answer(spark, seed, hot_rows):
    rng = random.Random(seed)
    events = random_log(rng, 300, hot=0.4)
    want, want_state, _ = one_at_a_time(events, DAY_MS)
    check_split(spark, rng, events, want, want_state, hot_rows)


def check_split(spark, rng, events, want, want_state, hot_rows, dedupe="id_and_key"):
    cuts = sorted(rng.sample(range(1, 300), 2))
    got, state, marks = {}, None, None
    for lo, hi in zip([0, *cuts], [*cuts, 300]):
        gated = gated_events(spark, events[lo:hi]).cache()
        out = resolve.event_outcomes(gated, state, marks, hot_rows=hot_rows, dedupe=dedupe).cache()
        got.update(labels_of(out))
        state = spark.createDataFrame(resolve.versioned_upsert(state, out).collect(), model.STATE)
        marks = spark.createDataFrame(resolve.mark_applied(out, marks).select(*[f.name for f in model.MARKS]).collect(), model.MARKS)
    assert got == want
    assert state_of(state) == want_state


@pytest.mark.parametrize("dedupe", ["id_and_key", "id"])
@pytest.mark.parametrize("seed, hot_rows, reused", [(21, 10**6, 0.1), (22, 10**6, 0.6), (23, 25, 0.3), (24, 7, 0.5)])
def test_reused_ids_equal_one_at_a_time(spark, dedupe, seed, hot_rows, reused):
    events = random_log(random.Random(seed), 300, hot=0.4, reused=reused)
    want, state, _ = one_at_a_time(events, DAY_MS, dedupe=dedupe)
    assert want != one_at_a_time(events, DAY_MS, dedupe="id" if dedupe != "id" else "id_and_key")[0]
    out = resolve.event_outcomes(gated_events(spark, events).cache(), hot_rows=hot_rows, dedupe=dedupe)
    assert labels_of(out) == want
    assert state_of(resolve.versioned_upsert(None, out)) == state


@pytest.mark.parametrize("dedupe, seed, hot_rows", [("id_and_key", 31, 10**6), ("id_and_key", 32, 9), ("id", 33, 10**6), ("id", 34, 9)])
def test_any_batch_split_with_reused_ids(spark, dedupe, seed, hot_rows):
    rng = random.Random(seed)
    events = random_log(rng, 300, hot=0.4, reused=0.4)
    want, want_state, _ = one_at_a_time(events, DAY_MS, dedupe=dedupe)
    check_split(spark, rng, events, want, want_state, hot_rows, dedupe)


def test_a_skipped_event_raises_no_version(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "a", "P", "W", 7, 1), (2, "b", "P", "W", 6, 2), (3, "a", "Q", "W", 1, 3)])
    assert labels_of(resolve.event_outcomes(gated)) == {0: "applied", 1: "skipped", 2: "applied", 3: "applied"}
    by_id = resolve.event_outcomes(gated, dedupe="id")
    assert labels_of(by_id) == {0: "applied", 1: "skipped", 2: "applied", 3: "skipped"}
    assert state_of(resolve.versioned_upsert(None, by_id)) == {("P", "W"): (6, "b")}
    with pytest.raises(ValueError):
        resolve.event_outcomes(gated, dedupe="key")


def test_an_id_applied_again_after_its_mark_expired_is_remembered_anew(spark):
    hour = 3_600_000
    events = [(0, "a", "P", "W", 1, 0), (1, "a", "P", "W", 2, 25 * hour), (2, "a", "P", "W", 3, 26 * hour), (3, "a", "P", "W", 4, 50 * hour)]
    want = {0: "applied", 1: "applied", 2: "skipped", 3: "applied"}
    assert labels_of(resolve.event_outcomes(gated_events(spark, events))) == want


def test_a_chain_of_overturned_labels(spark):
    """Every label hangs on the one before it: the rounds go on until none changes."""
    events, n = [], 0
    for k in range(12):
        events += [(n, f"x{k}", "P", "W", 10 * k + 5, n), (n + 1, f"x{k}", "P", "W", 10 * k + 9, n + 1), (n + 2, f"x{k + 1}", "P", "W", 10 * k + 7, n + 2)]
        n += 3
    want, _, _ = one_at_a_time(events, DAY_MS)
    assert labels_of(resolve.event_outcomes(gated_events(spark, events))) == want


def test_first_arrival_wins_a_tie_and_new_keys_ignore_versions(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "b", "P", "W", 5, 1), (2, "c", "Q", "W", 1, 2)])
    assert labels_of(resolve.event_outcomes(gated)) == {0: "applied", 1: "rejected", 2: "applied"}
    assert state_of(resolve.versioned_upsert(None, gated))[("P", "W")] == (5, "a")


def test_repeat_of_a_stale_event_is_stale_again(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "b", "P", "W", 4, 1), (2, "b", "P", "W", 4, 2)])
    assert labels_of(resolve.event_outcomes(gated)) == {0: "applied", 1: "rejected", 2: "rejected"}


def test_mark_expires_and_a_repeat_does_not_extend_it(spark):
    events = [(0, "a", "P", "W", 5, 0), (1, "a", "P", "W", 5, DAY_MS - 1), (2, "a", "P", "W", 5, DAY_MS)]
    out = resolve.event_outcomes(gated_events(spark, events))
    assert labels_of(out) == {0: "applied", 1: "skipped", 2: "rejected"}
    assert [r.marked_at for r in resolve.mark_applied(out).collect()] == [at(0)]
    assert resolve.mark_applied(out, now=F.lit(at(DAY_MS))).count() == 0
    assert resolve.mark_applied(out, now=F.lit(at(DAY_MS - 1))).count() == 1


def test_one_id_on_two_keys_is_two_events(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "a", "Q", "W", 5, 1)])
    assert labels_of(resolve.event_outcomes(gated)) == {0: "applied", 1: "applied"}


def test_was_applied(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "b", "P", "W", 5, 1)])
    marks = resolve.mark_applied(resolve.event_outcomes(gated))
    later = gated_events(spark, [(2, "a", "P", "W", 5, 10), (3, "a", "P", "W", 5, DAY_MS), (4, "b", "P", "W", 5, 10)])
    seen = {r.kafka_offset: r.seen for r in resolve.was_applied(later, marks).collect()}
    assert seen == {2: True, 3: False, 4: False}
    other = gated_events(spark, [(5, "a", "Q", "W", 5, 10)])
    assert [r.seen for r in resolve.was_applied(other, marks).collect()] == [False]
    assert [r.seen for r in resolve.was_applied(other, marks, dedupe="id").collect()] == [True]
    assert spark.range(1).select(resolve.mark_key(F.lit("x"))).first()[0] == "cdc:applied:x"


@pytest.mark.parametrize("hot_rows", [10**6, 1])
def test_ordering_check(spark, hot_rows):
    gated = gated_events(
        spark, [(0, "a", "P", "W", 1, 0), (1, "b", "P", "W", 3, 1), (2, "c", "P", "W", 2, 2), (3, "d", "P", "W", 4, 3)]
    ).withColumn("kafka_partition", F.when(F.col("kafka_offset") == 3, 1).otherwise(0))
    out = {r.kafka_offset: r for r in resolve.ordering_check(gated, hot_rows).collect()}
    assert set(out) == {2, 3}
    assert out[2].previous_version == 3 and out[2].version_not_newer and out[3].partition_changed


def test_id_conflicts(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 1, 0), (1, "a", "P", "W", 3, 1), (2, "b", "P", "W", 3, 1)])
    assert [r.event_id for r in resolve.id_conflicts(gated).collect()] == ["a"]


def test_delete_modes(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 1, 0)]).withColumn("op", F.lit("d"))
    assert resolve.versioned_upsert(None, gated).first().stock_status == "ACTIVE"
    assert resolve.versioned_upsert(None, gated, "tombstone").first().stock_status == "DELETED"
    with pytest.raises(ValueError):
        resolve.versioned_upsert(None, gated, "drop")


def test_ordinary_path_shuffles_once(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 1, 0)])
    plan = resolve.labelled(gated, []).select("_applied", "_skipped", "_open")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_state_is_aggregated_before_the_shuffle(spark):
    gated = gated_events(spark, [(0, "a", "P", "W", 1, 0)])
    plan = resolve.versioned_upsert(None, gated)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 1 and plan.count("Exchange hashpartitioning") == 1


def test_state_follows_outcomes_when_an_id_is_used_again(spark):
    labelled = resolve.event_outcomes(gated_events(spark, [(0, "a", "P", "W", 5, 0), (1, "a", "P", "W", 7, 1)]))
    assert labels_of(labelled) == {0: "applied", 1: "skipped"}
    assert state_of(resolve.versioned_upsert(None, labelled)) == {("P", "W"): (5, "a")}


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_settled_keys_leave_the_rounds(spark, monkeypatch, hot_rows):
    """One key has a long chain of labels that overturn one another; the others are settled by the first round."""
    ids_and_versions = [("a", 5), ("a", 9), ("b", 7), ("b", 8), ("c", 8), ("c", 9)]
    chain = [(o, e, "P", "W", v, o) for o, (e, v) in enumerate(ids_and_versions)]
    short = [(1000 + 10 * k + i, f"K{k}-{min(i, 1)}", f"S{k}", "W", i + 1, 1000 + i) for k in range(10) for i in range(4)]
    events, rounds, written = chain + short, [], resolve.written

    def counted(df, name):
        table = written(df, name)
        if name == "open":
            rounds.append(table.count())
        return table

    monkeypatch.setattr(resolve, "written", counted)
    want, _, _ = one_at_a_time(events, DAY_MS)
    assert labels_of(resolve.event_outcomes(gated_events(spark, events).cache(), hot_rows=hot_rows)) == want
    assert rounds[0] == rounds[1] == len(events)  # all are open
    assert len(rounds) > 3 and set(rounds[2:]) == {len(chain)}
