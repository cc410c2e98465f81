"""Change application on small logs with results worked out by hand."""

import random

import pytest

from lakekit.operators import scd
from lakekit.streaming.changes import ChangeTarget

DDL = "id string, name string, ingredients string, _change_type string, _change_timestamp string"
CONTROL = ["_change_type", "_change_timestamp"]
SETTINGS = "device long, mode string, gain int, _change_type string, at int"


def apply(df, scd_type, **kw):
    kw = {"delete_when": "_change_type = 'delete'", "ignore_null_updates": True, "except_cols": CONTROL, **kw}
    return scd.apply_changes(df, "id", "_change_timestamp", scd_type=scd_type, **kw)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def settings_log(seed, n=250):
    """Changes of device settings; several of different types may share a device and a time, cut (the delete) comes between add and put."""
    r = random.Random(seed)
    seen = {(r.randrange(9), r.randrange(40), r.choice(["add", "cut", "put", "put"])) for _ in range(n)}
    pick = lambda v: None if r.random() < 0.4 else v
    return [(k, *((None, None) if t == "cut" else (pick(f"m{r.randrange(99)}"), pick(r.randrange(99)))), t, at) for k, at, t in seen]


def replay(log, scd_type, keep_nulls, order=lambda e: e[3]):
    """The rules one change after the other: per device by time, then type; NULLs of an update keep the value unless ``keep_nulls``."""
    out = set()
    for device in {e[0] for e in log}:
        mine = sorted((e for e in log if e[0] == device), key=lambda e: (e[4], order(e)))
        times = sorted({e[4] for e in mine})
        state, opened = None, []
        for at in times:
            for e in (e for e in mine if e[4] == at):
                if e[3] == "cut":
                    state = None
                else:
                    old = (None, None) if state is None or keep_nulls else state
                    state = tuple(o if v is None else v for v, o in zip(e[1:3], old))
            opened.append((state, at))
        if scd_type == 1:
            out |= {(device, *state)} if state is not None else set()
        else:
            out |= {(device, *st, at, nxt) for (st, at), nxt in zip(opened, [*times[1:], None]) if st is not None}
    return out


@pytest.mark.parametrize("scd_type", [1, 2])
@pytest.mark.parametrize("keep_nulls", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs_equal_a_replay(spark, scd_type, keep_nulls, seed):
    log = settings_log(seed)
    df = spark.createDataFrame(log, SETTINGS).repartition(3)
    got = scd.apply_changes(df, "device", "at", "_change_type = 'cut'", not keep_nulls, ["_change_type", "at"], scd_type)
    assert as_set(got) == replay(log, scd_type, keep_nulls)


def test_tie_order_is_an_argument(spark):
    """The same log read with the types of a tie in the other order."""
    log = settings_log(3)
    back = {"add": 3, "cut": 2, "put": 1}
    df = spark.createDataFrame([(*e, back[e[3]]) for e in log], SETTINGS + ", n int")
    got = scd.apply_changes(df, "device", "at", "_change_type = 'cut'", True, ["_change_type", "at", "n"], 1, tie_by="n")
    assert as_set(got) == replay(log, 1, False, lambda e: back[e[3]])


def test_delete_and_reinsert_forgets(spark):
    log = [(1, "m", 4, "add", 10), (1, None, None, "cut", 20), (1, None, 7, "put", 30)]
    df = spark.createDataFrame(log, SETTINGS)
    go = lambda kind: as_set(scd.apply_changes(df, "device", "at", "_change_type = 'cut'", True, ["_change_type", "at"], kind))
    assert go(1) == {(1, None, 7)} and go(2) == {(1, "m", 4, 10, 20), (1, None, 7, 30, None)}


def test_late_row_does_not_overwrite(spark):
    feed = [("a", "new", "n", "update", "5"), ("a", "old", "o", "insert", "1")]
    assert as_set(apply(spark.createDataFrame(feed, DDL), 1)) == {("a", "new", "n")}


def test_struct_sequence(spark):
    df = spark.createDataFrame([("a", 1, 2, "x"), ("a", 1, 10, "y"), ("a", 0, 99, "z")], "id string, ts int, item int, v string")
    got = scd.apply_changes(df, "id", ["ts", "item"]).collect()
    assert [r.v for r in got] == ["y"]
    h = scd.apply_changes(df, "id", ["ts", "item"], except_cols=["ts", "item"], scd_type=2).orderBy("__START_AT").collect()
    assert [(r.v, tuple(r["__START_AT"]), r["__END_AT"] and tuple(r["__END_AT"])) for r in h] == [("z", (0, 99), (1, 2)), ("x", (1, 2), (1, 10)), ("y", (1, 10), None)]


def random_feed(seed, n=300):
    r = random.Random(seed)
    out = []
    for i in range(n):
        kind = r.choice(["insert", "update", "update", "delete"])
        gone = kind == "delete"
        pick = lambda p: None if gone or r.random() < 0.4 else f"{p}{i}"
        out.append((f"k{r.randrange(12)}", pick("n"), pick("i"), kind, f"{r.randrange(120):04d}"))
    return out


@pytest.mark.parametrize("scd_type", [1, 2])
def test_shuffled_micro_batches_equal_the_whole_log(spark, new_dir, scd_type):
    feed = random_feed(scd_type)
    whole = as_set(apply(spark.createDataFrame(feed, DDL), scd_type))
    random.Random(9).shuffle(feed)
    t = ChangeTarget(spark, new_dir("target"), "id", "_change_timestamp", DDL, delete_when="_change_type = 'delete'",
                     ignore_null_updates=True, except_cols=CONTROL, scd_type=scd_type, buckets=4)
    assert t.read().isEmpty()
    for i, part in enumerate([feed[:120], feed[120:130], feed[130:]]):
        t.apply_batch(spark.createDataFrame(part, DDL), i)
    t.apply_batch(spark.createDataFrame(feed[130:], DDL), 2)  # the batch comes again after a failure
    assert as_set(t.read()) == whole


def test_intervals_are_not_made_anew_by_every_batch(spark, new_dir):
    """Six batches of equal size: the intervals follow when the log has doubled; ``read`` knows the changes since."""
    feed = random_feed(3, 60)
    t = ChangeTarget(spark, new_dir("target"), "id", "_change_timestamp", DDL, delete_when="_change_type = 'delete'",
                     ignore_null_updates=True, except_cols=CONTROL, scd_type=2, buckets=2)
    for i in range(6):
        t.apply_batch(spark.createDataFrame(feed[10 * i : 10 * i + 10], DDL), i)
    assert t.table.version == 2 and t.log.version == 5
    assert as_set(t.read()) == as_set(apply(spark.createDataFrame(feed, DDL), 2))


@pytest.mark.parametrize("scd_type", [1, 2])
def test_stream_with_a_new_checkpoint_goes_on(spark, new_dir, scd_type):
    src, out = new_dir("src"), new_dir("target")
    ddl = "id int, v int, s int"
    target = lambda: ChangeTarget(spark, out, "id", "s", spark.createDataFrame([], ddl).schema, scd_type=scd_type, buckets=4)
    stream = lambda: spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).json(src)
    for i in range(3):
        spark.createDataFrame([(i, i, 1)], ddl).coalesce(1).write.mode("append").json(src)
    target().run(stream(), new_dir("checkpoint"))
    spark.createDataFrame([(9, 9, 1)], ddl).coalesce(1).write.mode("append").json(src)
    t = target()
    t.run(stream(), new_dir("checkpoint"))
    assert {r.id for r in t.read().collect()} == {0, 1, 2, 9} and t.read().count() == 4


def test_intervals_do_not_overlap_when_hot(spark):
    df = spark.createDataFrame(random_feed(5, 600), DDL)
    plain = as_set(apply(df, 2))
    assert as_set(apply(df, 2, ranges=12)) == plain
    by_key = {}
    for r in plain:
        by_key.setdefault(r[0], []).append((r[3], r[4]))
    for spans in by_key.values():
        spans.sort()
        assert all(a[1] is not None and a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_state_merge_is_order_free(spark):
    feed = random_feed(6)
    a, b = spark.createDataFrame(feed[:150], DDL), spark.createDataFrame(feed[150:], DDL)
    st = lambda df: scd.scd1_state(df, ["id"], ["_change_timestamp"], "_change_type = 'delete'", True)
    cols = ["id", "name", "ingredients"]
    one = as_set(scd.scd1_view(scd.scd1_merge(st(a), st(b), ["id"]), cols))
    two = as_set(scd.scd1_view(scd.scd1_merge(st(b), st(a), ["id"]), cols))
    assert one == two == as_set(apply(spark.createDataFrame(feed, DDL), 1))
