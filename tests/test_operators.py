"""Quality, governance, lineage, profile, functions and flows on small fixtures."""

import datetime
import json
import random
import threading
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakekit.functions import nested as N, scalar as X, udfs as D
from lakekit.operators import governance as GV, lineage as L, pairs as PA, profile as PR, quality as Q
from lakekit.plans import gold
from lakekit.streaming.files import stream_files
from lakekit.streaming.flows import Flow


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- functions --------------------------------------------------------------------------------------

NAMES = ["a", "b2", "long name", "x:y", "ü"]


def random_value(r, depth):
    """A JSON value: objects and arrays of random size down to ``depth``, text and numbers below."""
    kind = r.choice("oal" if depth else "l")
    if kind == "o":
        return {n: random_value(r, depth - 1) for n in r.sample(NAMES, r.randrange(1, 5))}
    if kind == "a":
        return [random_value(r, depth - 1) for _ in range(r.randrange(0, 4))]
    return r.choice([f"t{r.randrange(99)}", r.randrange(1000)])


def paths_of(value, path="$"):
    """(path, value) of every part of a document."""
    yield path, value
    for step, v in value.items() if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else ():
        plain = f"[{step}]" if isinstance(step, int) else f".{step}" if step.isalnum() else f"['{step}']"
        yield from paths_of(v, path + plain)


@pytest.mark.parametrize("seed", range(4))
def test_json_paths_of_random_documents(spark, seed):
    doc = {"top": random_value(random.Random(seed), 4), "end": 1}
    known = [(p, v) for p, v in paths_of(doc)][1:]
    df = spark.createDataFrame([(json.dumps(doc, ensure_ascii=False),)], "raw string")
    got = df.select(*[N.json_path("raw", p).alias(f"c{i}") for i, (p, _) in enumerate(known)], N.json_path("raw", "$.top.none").alias("none")).first()
    for (p, v), text in zip(known, got):
        assert (text if isinstance(v, str) else json.loads(text)) == v, p
    assert got["none"] is None


def test_json_wildcard_of_random_arrays(spark):
    r = random.Random(5)
    docs = [{"in": {"list": [{"k": i} if r.random() < 0.5 else {"other": i, "k k": 0} for i in range(r.randrange(0, 7))]}} for _ in range(20)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, raw string")
    got = df.select("id", N.json_paths("raw", "$.in.list", "k").alias("kept"), N.json_paths("raw", "$.in.list", "k", keep_missing=False).alias("found")).collect()
    for g in got:
        want = [str(x["k"]) if "k" in x else None for x in docs[g.id]["in"]["list"]]
        assert g.kept == want and g.found == [w for w in want if w is not None]


def test_parse_by_example_accepts_single_quotes(spark):
    df = spark.createDataFrame([('{"rain": [0.5], "time": ["t"]}',), ("broken",)], "j string")
    got = df.select(N.parse_by_example("j", "{'rain': [0, 0.1], 'time': ['x']}").alias("s")).select("s.rain", "s.time").collect()
    assert tuple(got[0]) == ([0.5], ["t"]) and tuple(got[1]) == (None, None)


def test_zip_rows_pads_short_arrays(spark):
    df = spark.createDataFrame([(1, ["a", "b", "c"], [1.0], None), (2, ["d"], [2.0], [3.0])], "k int, t array<string>, x array<double>, y array<double>")
    assert rows(N.zip_rows(df, {"t": "t", "x": "x"}, ["k"])) == sorted([(1, "a", 1.0), (1, "b", None), (1, "c", None), (2, "d", 2.0)], key=repr)


def test_sale_items(spark):
    items = '[{"id":"Mix","size":"Small","notes":"","cost":5},{"id":"custom","size":"Large","notes":"no ice","cost":9,"ingredients":["Kiwi","Kiwi"]}]'
    raw = spark.createDataFrame([("s1", "2023-03-01 10:00:00", "SYD01", items), ("s2", "2023-03-01 10:00:00", "SYD01", "[]"), ("s3", "t", "SYD01", "{bad")], "id string, ts string, store_id string, sale_items string")
    got = rows(gold.sale_items(raw).select("id", "item_number", "product_id", "product_cost", "product_ingredients"))
    assert got == [("s1-0", 0, "Mix", "5", None), ("s1-1", 1, "custom", "9", '["Kiwi","Kiwi"]')]
    df = spark.createDataFrame([("custom", None), ("Custom", None), ("custom", "[]")], "product_id string, product_ingredients string")
    count = lambda rules: Q.metrics(df, "d", rules).first().failed_records
    assert count(gold.item_rules()) == 1 and count(gold.item_rules(ignore_case=True)) == 2


def test_weather_hours(spark):
    hourly = '{"time":["2023-03-01T00:00","2023-03-01T01:00"],"temperature_2m":[21.9,21.6],"rain":[0.0]}'
    raw = spark.createDataFrame([(-33.9, 151.2, "GMT", 0.5, hourly)], "latitude double, longitude double, timezone string, generationtime_ms double, hourly string")
    got = gold.weather_hours(raw).orderBy("time").collect()
    assert [(r.pk, r.temperature_2m, r.rain) for r in got] == [("-33.9|151.2|2023-03-01T00:00", 21.9, 0.0), ("-33.9|151.2|2023-03-01T01:00", 21.6, None)]


def test_scalar_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    day = lambda s: F.lit(s).cast("date")
    busy = lambda d, h, hol=False: one(X.busy_time(day(d), F.lit(h), F.lit(hol)))
    assert busy("2023-03-08", 11) and busy("2023-03-08", 17) and not busy("2023-03-08", 13) and not busy("2023-03-08", 18)
    assert busy("2023-03-11", 10) and busy("2023-03-11", 19) and not busy("2023-03-11", 15)  # Saturday
    assert busy("2023-01-04", 14) and busy("2023-03-08", 14, True)
    assert one(X.store_country(F.lit("AKL01"))) == "NZ" and one(X.store_country(F.lit("XXX"))) == "AU"
    assert one(X.backfill_start(day("2023-03-15"), 3)) == datetime.date(2022, 12, 1)
    assert one(X.backfill_start(day("2023-03-01"), 3)) == datetime.date(2022, 11, 1)
    assert [one(X.hex_byte(F.lit(v))) for v in (-5, 0, 10, 255, 300)] == ["00", "00", "0A", "FF", "FF"]
    assert one(X.log_ratio(F.lit(0.0), F.lit(2.0))) is None and one(X.log_ratio(F.lit(1.0), F.lit(0.0))) is None
    assert abs(one(X.h_concentration(F.lit(3.0))) - 1e-3) < 1e-15
    assert one(X.composite_id(F.lit("a"), F.lit(None).cast("int"))) is None and one(X.composite_id(F.lit("a"), F.lit(7))) == "a-7"
    assert one(X.case_in(F.lit("z"), {"AUS": ["a"]})) is None
    assert one(X.last_days(F.lit("2024-01-23").cast("timestamp"), "2024-01-30")) and not one(X.last_days(F.lit("2024-01-22 23:59:59").cast("timestamp"), "2024-01-30"))


def test_sql_functions(spark):
    D.literal_function(spark, "t_unit", "kPa")
    D.sql_function(spark, "t_grade", "x INT", "concat('g', cast(x % 3 as string))", "STRING")
    spark.createDataFrame([("HAM", "Hamburg"), ("OSL", "Oslo"), ("OSL", "Gardermoen")], "code string, name string").createOrReplaceTempView("t_ports")
    D.lookup_function(spark, "t_port", "t_ports", "code", "name")
    assert rows(spark.sql("select t_unit(), t_grade(id) from range(2)")) == [("kPa", "g0"), ("kPa", "g1")]
    q = "select c.code, t_port(c.code) from values ('OSL'), ('XXX') as c(code)"
    assert rows(spark.sql(q)) == [("OSL", "Gardermoen"), ("XXX", None)]


def test_model_function_uses_names(spark):
    predict = lambda pdf: pdf["b"] - pdf["a"]
    D.register_model(spark, "t_model", predict, ["a", "b"])
    spark.createDataFrame([(1.0, 5.0), (2.0, 2.0)], "a double, b double").createOrReplaceTempView("t_features")
    assert rows(spark.sql("select *, t_model(*) as p from t_features")) == [(1.0, 5.0, 4.0), (2.0, 2.0, 0.0)]
    one = D.model_function(lambda pdf: pdf["a"] * 2, ["a"])
    assert rows(spark.table("t_features").select(one("a"))) == [(2.0,), (4.0,)]


# --- quality ----------------------------------------------------------------------------------------

RULES = {"five": "length(store_id) = 5", "state": "state in ('CANCELED', 'COMPLETED')"}


@pytest.fixture
def sales(spark):
    data = [(1, "SYD01", "COMPLETED"), (2, "SYDN01", "PENDING"), (3, "SYD1", "CANCELED"), (4, None, "COMPLETED"), (5, "AKL01", "PENDING")]
    return spark.createDataFrame(data, "id int, store_id string, state string")


def test_expectations(sales):
    assert rows(Q.metrics(sales, "s", RULES)) == [("s", "five", 2, 3), ("s", "state", 3, 2)]
    assert rows(Q.drop_violations(sales, RULES).select("id")) == [(1,)]
    good, bad = Q.quarantine(sales, RULES)
    assert rows(good.select("id")) == [(1,)]
    assert {r.id: r.failed_rules for r in bad.collect()} == {2: ["five", "state"], 3: ["five"], 4: ["five"], 5: ["state"]}
    with pytest.raises(Exception, match="expectation failed: state"):
        Q.fail_on_violation(sales, {"state": RULES["state"]}).collect()
    assert Q.fail_on_violation(sales.where("id = 1"), RULES).count() == 1


def test_event_log_query(spark, sales):
    m = Q.metrics(sales, "silver", RULES)
    log = Q.progress_event(m, F.lit(5), F.lit(0), "silver", "e1").unionByName(
        spark.createDataFrame([("e2", "flow_definition", "x", '{"flow_definition":{}}')], "id string, event_type string, flow string, details string"), allowMissingColumns=True)
    assert rows(Q.event_metrics(log)) == [("e1", "silver", "five", 3, 2), ("e1", "silver", "state", 2, 3)]


def test_alert(spark):
    df = spark.createDataFrame([("a", 3), ("b", 9)], "store string, n int")
    state, hits = Q.evaluate_alert(df, "n", ">", 5)
    assert state == "TRIGGERED" and rows(hits) == [("b", 9)]
    assert Q.evaluate_alert(df, "n", ">", 9)[0] == "OK"


# --- governance and lineage -------------------------------------------------------------------------


def test_governance(spark):
    cust = spark.createDataFrame([(1, "FR", "Ann", "addr"), (2, "USA", "Bob", "addr"), (3, "SPAIN", "Cid", "addr")], "id int, country string, name string, address string")
    member = spark.createDataFrame([("u", "ANALYST_FR"), ("u", "ANALYST_FR"), ("w", "ANALYST_USA")], "user string, group_name string")
    group = F.concat(F.lit("ANALYST_"), "country")
    assert rows(GV.row_filter(cust, group, member, "u").select("id")) == [(1,)]
    assert GV.row_filter(cust, group, member, "nobody").isEmpty()
    assert rows(GV.membership_flag(cust, group, member, "u").select("id", "is_member")) == [(1, True), (2, False), (3, False)]
    perm = spark.createDataFrame([("u", "FR", 0), ("u", "USA", 1), ("w", "FR", None)], "analyst_email string, country_filter string, gdpr_filter long")
    view = GV.secure_view(cust, perm, "country", ["id", "country"], ["name"], "u")
    assert view.columns == ["id", "country", "name"]
    assert rows(view) == [(1, "FR", "Ann"), (2, "USA", "da6645f6e22bf5f75974dc7eed5fcd6160d6b51e")]
    assert rows(GV.secure_view(cust, perm, "country", ["id"], ["name"], "w")) == [(1, "Ann")]
    me = spark.range(1).select(F.current_user()).first()[0]
    own = spark.createDataFrame([(me, "FR", 0)], perm.schema)
    assert rows(GV.own_permissions(own)) == [(me, "FR", 0)]


def test_lineage(spark):
    e = spark.createDataFrame([("menu", "dinner"), ("dinner", "dp"), ("price", "dp"), ("dp", "menu"), ("menu", "dp")], "source string, target string")
    assert rows(L.closure(e, ["menu"])) == [("dinner", 1), ("dp", 1)]  # the start is not repeated when a cycle returns to it
    assert rows(L.closure(e, ["dp"], downstream=False)) == [("dinner", 1), ("menu", 1), ("price", 1)]
    assert L.closure(e, ["nothing"]).isEmpty()
    chain = spark.range(130).selectExpr("concat('n', id) as source", "concat('n', id + 1) as target")
    far = L.closure(chain, ["n0"])
    assert far.count() == 130 and far.agg(F.max("depth")).first()[0] == 130
    with pytest.raises(ValueError, match="more than 5 steps"):
        L.closure(chain, ["n0"], max_depth=5)
    grants = spark.createDataFrame([("u", "dinner")], "user string, name string")
    assert rows(L.redact(L.closure(e, ["menu"]), grants, "u")) == [("REDACTED", 1), ("dinner", 1)]
    menu = spark.createDataFrame([(1, "a", "b", "c")], "recipe_id int, app string, main string, desert string")
    dinner = gold.dinner(menu)
    m = {"full_menu": ["menu.app", "menu.main", "menu.desert"]}
    assert len(rows(L.column_edges("dinner", m, {"menu": menu, "dinner": dinner}))) == 3
    with pytest.raises(ValueError):
        L.column_edges("dinner", {"full_menu": ["menu.soup"]}, {"menu": menu, "dinner": dinner})
    at = e.withColumn("at", F.when(F.col("source") == "menu", "2024-03-01").otherwise("2024-01-01").cast("timestamp"))
    assert L.recent(at, "2024-03-15").count() == 2


def test_profile(spark):
    df = spark.createDataFrame([(float(i), None if i % 4 else i, 7) for i in range(1, 101)], "a double, b int, c int")
    p = {r.column: r for r in PR.profile(df, ["a", "b"], approximate=False).collect()}
    assert (p["a"]["count"], p["a"].nulls, p["a"].distinct, p["a"].mean, p["a"].median) == (100, 0, 100, 50.5, 50.5)
    assert (p["b"]["count"], p["b"].nulls, p["b"].distinct) == (25, 75, 25)
    q = {r.column: r for r in PR.profile(df).collect()}
    assert abs(q["a"].distinct - 100) <= 15 and abs(q["a"].median - 50) <= 1
    assert rows(PR.missing_values(df)) == [("a", 0), ("b", 75), ("c", 0)]
    assert rows(PR.low_variance(df).where("low").select("column")) == [("c",)]
    assert rows(PR.histogram(df, "a", 1, 101, 4)) == [(1, 25), (2, 25), (3, 25), (4, 25)]


def test_popular_combinations(spark):
    items = [(1, "a"), (1, "b"), (1, "a"), (2, "b"), (2, "a"), (3, "c"), (4, "c"), (5, "a"), (6, "b"), (6, "a"), (7, "d")]
    got = rows(gold.popular_combinations(spark.createDataFrame(items, "s int, i string"), "s", "i", 2))
    assert got == [(2, 3, "c"), (3, 1, "a"), (3, 1, "b")]


def pairs_by_hand(items, k):
    sales = {}
    for s, i in items:
        if s is not None and i is not None:
            sales.setdefault(s, set()).add(i)
    n = Counter(p for v in sales.values() for p in combinations(sorted(v), 2))
    return [(*p, c) for p, c in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:k]]


@pytest.mark.parametrize("seed,heavy,buckets,largest", [(1, 256, 512, 1000), (2, 3, 4, 2), (3, 1, 1, 1), (4, 8, 16, 0)])
def test_popular_pairs(spark, seed, heavy, buckets, largest):
    """Few items and small tables, so ties, useless bounds and a short list of heavy items all occur; one sale holds a third of the rows."""
    r = random.Random(seed)
    items = [(0 if r.random() < 0.33 else r.randrange(60), None if r.random() < 0.02 else f"i{int(r.random() ** 2 * 40)}") for _ in range(700)] + [(None, "i1"), (None, "i2")]
    got = PA.top_pairs(spark.createDataFrame(items, "s int, i string"), "s", "i", 15, heavy, buckets, largest)
    assert [tuple(x) for x in got.collect()] == pairs_by_hand(items, 15)


@pytest.mark.parametrize("block,giant,hot", [(3, 1000, 1000), (3, 8, 5), (256, 8, 1), (2, 4, 1)])
def test_popular_pairs_of_split_sales_and_items(spark, monkeypatch, block, giant, hot):
    """Sales longer than a block, sales that are asked, items whose pairs go to several tasks, a few pairs in memory."""
    for name, v in {"BLOCK": block, "GIANT": giant, "HOT": hot, "AT_ONCE": 50}.items():
        monkeypatch.setattr(PA, name, v)
    r = random.Random(block + giant)
    items = [(0 if r.random() < 0.2 else r.randrange(60), f"i{int(r.random() ** 2 * 40)}") for _ in range(700)]
    df = spark.createDataFrame(items, "s int, i string")
    for args in [(), (3, 64, 1000), (3, 4, 2)]:
        assert [tuple(x) for x in PA.top_pairs(df, "s", "i", 15, *args).collect()] == pairs_by_hand(items, 15)


def test_pairs_are_sent_together(spark):
    """Without useful bounds every pair is formed; what is shuffled for it is a few rows per task, not a row per pair."""
    code = pa.array([list(range(i, i + 40)) for i in range(500)], pa.list_(pa.int32()))
    batch = pa.record_batch({"two": pa.array([False] * 500), "code": code, "side": pa.array([[0] * 40] * 500, pa.list_(pa.int32()))})
    sent = list(PA._send(iter([batch]), 10_000, 4, {}, []))
    assert sum(b.num_rows for b in sent) == 4 and sum(b.nbytes for b in sent) < 4 * 500 * 780
    got = {(r["a"], r["b"]): r["n"] for b in PA._count(iter(sent), 10_000, 1) for r in b.to_pylist()}
    assert got == Counter(p for i in range(500) for p in combinations(range(i, i + 40), 2))


def test_pairs_of_a_very_large_sale(spark):
    """100,000 items in one sale (5e9 pairs), three of them often together elsewhere; and sales that have no pair at all."""
    big = spark.range(100_000).select(F.lit(-1).cast("long").alias("s"), F.col("id").alias("i"))
    small = spark.range(3000).select(F.col("id").alias("s"), F.explode(F.array((F.col("id") % 3) * 7, (F.col("id") % 5) * 1000 + 500, F.col("id") + 20_000)).alias("i"))
    alone = spark.range(50).select((F.col("id") + 10_000).alias("s"), F.lit(1).cast("long").alias("i"))
    rows = small.unionByName(alone)
    want = pairs_by_hand([tuple(r) for r in rows.collect()], 10**6)
    want = sorted(((a, b, n + 1) for a, b, n in want), key=lambda x: (-x[2], x[:2]))[:10]
    assert [tuple(x) for x in PA.top_pairs(rows.unionByName(big), "s", "i", 10).collect()] == want
    assert PA.top_pairs(alone, "s", "i").count() == 0 and PA.top_pairs(alone.where("false"), "s", "i").count() == 0


# --- flows ------------------------------------------------------------------------------------------


def test_flow_end_to_end(spark, new_dir):
    base = new_dir()
    flow = Flow(spark, f"{base}/flow")
    raw_ddl = "id int, store_id string, ts string, state string"
    put = lambda n, data: spark.createDataFrame(data, raw_ddl).coalesce(1).write.json(f"{base}/in/{n}")

    @flow.table(comment="gold")
    def per_store():
        return flow.read("silver").groupBy("store_id").agg(F.count_distinct("id").alias("n"))

    @flow.stream(expect={"five": "length(store_id) = 5"}, expect_or_drop={"known id": "id is not null"})
    def clean():
        return flow.read_stream("raw")

    @flow.stream()
    def raw():
        return stream_files(spark, f"{base}/in/*", "json", raw_ddl)

    flow.apply_changes("silver", "clean", "id", "ts", except_cols=["ts"])

    put("1", [(1, "SYD01", "1", "PENDING"), (2, "SYD01", "1", "COMPLETED"), (None, "SYD01", "1", "x"), (3, "S1", "1", "COMPLETED")])
    flow.update()
    assert rows(flow.read("per_store")) == [("S1", 1), ("SYD01", 2)]
    put("2", [(1, "AKL01", "2", "COMPLETED"), (2, "OLD01", "0", "COMPLETED")])
    flow.update()
    assert rows(flow.read("silver")) == sorted([(1, "AKL01", "COMPLETED"), (2, "SYD01", "COMPLETED"), (3, "S1", "COMPLETED")], key=repr)
    assert rows(flow.read("per_store")) == [("AKL01", 1), ("S1", 1), ("SYD01", 1)]
    m = rows(Q.event_metrics(flow.event_log()).groupBy("dataset", "name").agg(F.sum("failed_records"), F.sum("passed_records")))
    assert m == [("clean", "five", 1, 5), ("clean", "known id", 1, 5)]
    edges = {(r.source, r.target) for r in flow.edges().collect()}
    assert edges == {("raw", "clean"), ("clean", "silver"), ("silver", "per_store")}
    flow.update(full_refresh=True)
    assert rows(flow.read("per_store")) == [("AKL01", 1), ("S1", 1), ("SYD01", 1)]


def test_flow_errors(spark, new_dir):
    flow = Flow(spark, new_dir())
    flow.table("a")(lambda: flow.read("b"))
    flow.table("b")(lambda: flow.read("a"))
    with pytest.raises(ValueError, match="read each other"):
        flow.update()
    with pytest.raises(ValueError, match="twice"):
        flow.table("a")(lambda: None)


def test_progress_says_whether_all_reports_came(spark, new_dir):
    base = new_dir()
    flow = Flow(spark, f"{base}/flow", patience=0.2)
    spark.range(10).write.parquet(f"{base}/in")
    flow.stream("s", expect={"small": "id < 7"})(lambda: stream_files(spark, f"{base}/in", "parquet", "id long"))
    complete = lambda: [r[0] for r in flow.event_log().where("event_type = 'flow_progress'").orderBy("timestamp").select(F.get_json_object("details", "$.flow_progress.complete")).collect()]
    flow.patience = 600
    flow.update()
    assert complete() == ["true"]
    assert rows(Q.event_metrics(flow.event_log()).select("passed_records", "failed_records")) == [(7, 3)]
    flow.patience, flow._watch.onQueryTerminated = 0.2, lambda event: None  # the end of the next run is never heard of
    flow.update()
    assert complete() == ["true", "false"]
    run = {"over": threading.Event(), "batches": {4, 6}}
    run["over"].set()
    assert not flow._all_reported(run) and flow._all_reported(run | {"batches": {4, 5, 6}}) and flow._all_reported(run | {"batches": set()})
    flow.stop()
