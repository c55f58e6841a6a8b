import datetime as dt
import json
import random

from conftest import rows
from pyspark.sql import functions as F

from freshet.operators import archive_rows as R
from freshet.operators import joins as J
from freshet.operators import ordering as O
from freshet.plans import gates as Gt
from freshet.session import fresh_path
from freshet.sources import archive as Ar
from freshet.sources import documents as D
from freshet.sources import points as P


def test_merges(table):
    old = table("k int, v string, t int", [(1, "a", 1), (2, "b", 1)])
    new = table("k int, v string, t int", [(2, "c", 0), (3, "d", 5), (3, "e", 9)])
    assert rows(Ar.merge_keep_last(old, new, ["k"], ["t"])) == [(1, "a", 1), (2, "c", 0), (3, "e", 9)]
    assert rows(Ar.merge_keep_first(old, new, ["k"], ["t"])) == [(1, "a", 1), (2, "b", 1), (3, "d", 5)]
    nothing = old.filter("false")
    assert rows(Ar.merge_keep_last(nothing, old, ["k"], ["t"])) == rows(Ar.merge_keep_last(old, nothing, ["k"], ["t"])) == rows(old)


def test_merge_of_a_new_column(table):
    old = table("k int, t int", [(1, 1)])
    new = table("k int, t int, extra double", [(2, 1, 5.0)])
    assert rows(Ar.merge_keep_last(old, new, ["k"], ["t"]).select("k", "extra")) == [(1, None), (2, 5.0)]


def test_label_slice(table):
    store = table("id string, source string, n int", [("a", "official", 1), ("b", "model", 1)])
    new = table("id string, source string, n int", [("a", "model", 7), ("c", "model", 7)])
    got = rows(Ar.replace_slice(store, new, F.col("source") == "official", "id", ["n"]))
    assert got == [("a", "official", 1), ("c", "model", 7)]


def test_highest_takes_the_first_of_equals(table):
    df = table("k int, v double, t int", [(1, 5.0, 2), (1, 5.0, 1), (1, None, 0), (2, None, 1)])
    assert rows(R.highest(df, ["k"], "v", ["t"])) == [(1, 5.0, 1)]


def test_manifest(table):
    old = table("p int, v int", [(1, 1), (1, 2), (2, 5), (3, 5)])
    new = table("p int, v int", [(1, 2), (1, 1), (2, 6), (4, 1)])
    h = lambda d: J.content_hash(d, ["p"], ["v"])
    assert rows(J.manifest_diff(h(old), h(new), ["p"], "digest")) == [(2, "changed"), (3, "missing"), (4, "added")]
    # repeated rows count
    assert h(table("p int, v int", [(1, 1), (1, 1)])).collect() != h(table("p int, v int", [(1, 1)])).collect()


def test_unreadable_parts_are_left_out(spark, table):
    root = fresh_path(spark, "parts")
    table("a int, b int", [(1, 2)]).write.parquet(f"{root}/x")
    table("a int", [(5,)]).write.parquet(f"{root}/y")
    schema = table("a int, b int", []).schema
    assert rows(P.union_parts(spark, [f"{root}/{p}" for p in "xyz"], schema)) == [(1, 2), (5, None)]
    assert P.union_parts(spark, [f"{root}/q"], schema).count() == 0


def test_every_lost_row_of_a_part_is_accounted_for(spark, tmp_path):
    rng = random.Random(1)
    for part in "abcd":
        data = [(i, "".join(rng.choice("abcdefgh") for _ in range(40)), rng.random()) for i in range(4000)]
        spark.createDataFrame(data, "k int, s string, v double").repartition(4).write.option("parquet.block.size", 4096).parquet(str(tmp_path / part))
    files = {p: sorted((tmp_path / p).glob("*.parquet")) for p in "abcd"}
    files["b"][1].write_bytes(files["b"][1].read_bytes()[:-30])
    files["c"][2].write_bytes(b"")
    # page headers are spoiled, the footer is whole
    whole = bytearray(files["d"][0].read_bytes())
    whole[4:2004] = bytes([255]) * 2000
    files["d"][0].write_bytes(whole)
    for crc in tmp_path.glob("*/.*.crc"):
        crc.unlink()
    paths = [str(tmp_path / p) for p in "abcde"]
    account = P.parts_account(spark, paths).collect()
    lost = {(r.path[-1], r.reason): r for r in P.skipped_parts(spark, paths).collect()}
    assert set(lost) == {("b", "unreadable"), ("c", "empty"), ("d", "damaged"), ("e", "missing")}
    assert lost["b", "unreadable"].file.endswith(files["b"][1].name) and lost["d", "damaged"].n_rows < 1000
    assert len(account) == 17 and sum(r.reason is None for r in account) == 13
    schema = spark.createDataFrame([], "k int, s string, v double").schema
    assert P.union_parts(spark, paths, schema).count() >= 13_000
    got = P.union_parts(spark, paths, schema).select(F.to_json(F.struct("k", "s", "v")).alias("h")).where("h IS NOT NULL").count()
    assert got == sum(r.n_rows or 0 for r in account)


def test_archive_rewrites_only_the_parts_of_a_batch(spark, table):
    schema = "day date, k int, v int"
    day = lambda y, i: dt.date(y, 1, i)
    a = Ar.Archive(spark, fresh_path(spark, "archive"), table(schema, []).schema, ["day", "k"], ["v"], F.year("day"))
    assert a.version() == 0 and rows(a.read()) == []
    assert a.merge(table(schema, [(day(2020, 1), 1, 1), (day(2020, 2), 1, 2), (day(2021, 1), 1, 3), (None, 5, 5), (day(2021, 1), 1, 2)]), "one") == 1
    first = {r.part: r.folder for r in a.live().collect()}
    assert set(first) == {"2020", "2021", "none"}
    assert a.merge(table(schema, [(day(2021, 1), 1, 30), (day(2022, 1), 1, 4), (None, 5, 50)]), "two") == 2
    second = {r.part: r.folder for r in a.live().collect()}
    assert second["2020"] == first["2020"] and second["2021"] != first["2021"] and set(second) == {"2020", "2021", "2022", "none"}
    now = [(None, 5, 50), (day(2020, 1), 1, 1), (day(2020, 2), 1, 2), (day(2021, 1), 1, 30), (day(2022, 1), 1, 4)]
    assert rows(a.read()) == now
    # an older version is still whole
    assert rows(a.read(1)) == [(None, 5, 5), (day(2020, 1), 1, 1), (day(2020, 2), 1, 2), (day(2021, 1), 1, 3)]
    # a repeated batch is known, an empty one changes no row
    assert a.merge(table(schema, [(day(2020, 1), 1, 99)]), "two") == 2 and a.merge(table(schema, []), "nothing") == 3
    # a merge that was cut off before its log row leaves folders that nobody reads
    table(schema, [(day(2020, 1), 1, 77)]).withColumn(Ar.PART, F.lit("2020")).write.partitionBy(Ar.PART).parquet(f"{a.root}/data/lost")
    assert rows(a.read()) == now


def test_immutable_archive_adds_only_new_keys(spark, table):
    schema = "k int, part string, v int"
    a = Ar.Archive(spark, fresh_path(spark, "archive"), table(schema, []).schema, ["k"], ["v"], F.col("k") % 2, keep="first")
    a.merge(table(schema, [(1, "x", 5), (1, "x", 4), (2, "y", 6)]), "one")
    a.merge(table(schema, [(1, "x", 0), (3, "x", 7), (None, "z", 8)]), "two")
    a.merge(table(schema, [(None, "z", 1), (3, "x", 0)]), "three")
    assert rows(a.read()) == [(None, "z", 8), (1, "x", 4), (2, "y", 6), (3, "x", 7)]
    # what is there is not written again
    folders = [r.folder for r in a.live().where("part = '1'").collect()]
    assert len(folders) == 2 and spark.read.option("recursiveFileLookup", "true").parquet(*[f"{a.root}/data/{f}" for f in folders]).count() == 4
    assert rows(a.read(1)) == [(1, "x", 4), (2, "y", 6)]


def test_catalog(table):
    have = table("p int, year int, n_rows bigint", [(1, 2020, 366), (1, 2021, 300), (2, 2020, 359)])
    got = rows(P.catalog_diff(have, have.select("p").distinct(), "p", (2020, 2021)).select("p", "year", "n_rows", "expected"))
    assert got == [(1, 2021, 300, 365), (2, 2021, 0, 365)]


def test_hourly_documents(spark, table):
    doc = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-04T01:00", "2024-01-04T00:00", "2024-01-06T01:00", "2024-01-02T00:00"], "precipitation": [1, 2, 3, 4, None]}}
    df = table("p int, doc string", [(1, json.dumps(doc)), (2, "not json")])
    now = F.expr("TIMESTAMP_NTZ'2024-01-04 00:00:00'")
    got = rows(D.hourly_rows(df, "p", "doc", now))
    assert got == [(1, dt.datetime(2024, 1, 1), 1.0, "OBSERVED"), (1, dt.datetime(2024, 1, 4), 3.0, "OBSERVED"), (1, dt.datetime(2024, 1, 4, 1), 2.0, "FORECAST")]


def test_arrays_shorter_than_time_leave_no_ensemble(table):
    doc = {"daily": {"time": ["2024-01-01", "2024-01-02"], "river_discharge": [5.0, 6.0], "river_discharge_max": [7.0]}}
    got = D.daily_rows(table("s int, doc string", [(1, json.dumps(doc))]), ["s"], "doc", F.lit("2024-01-01").cast("date")).orderBy("d").collect()
    assert got[0]["ensemble"]["max"] == 7.0 and got[0]["ensemble"]["min"] is None
    assert got[1]["ensemble"] is None and got[1]["cls"] == "FORECAST"


def test_snapshots_bare_or_wrapped(table):
    docs = [
        {"basin": "a", "inputs": {"q_today_m3s": {"value": None, "class": "x"}}, "colour": {"value": "RED"}, "threshold_m3s": 5},
        {"basin": "b", "degraded": True, "model": "m", "error": "e"},
        {"predictions": {"h1": {"q_m3s": {"value": 2.5}, "p_exceed_threshold": 0.1}}, "colour": "GREEN"},
    ]
    df = table("i int, doc string", [(i, json.dumps(d)) for i, d in enumerate(docs)])
    got = D.flatten_snapshot(df, "i", "doc").orderBy("i").collect()
    assert (got[0]["q_now_m3s"], got[0]["colour"], got[0]["threshold_m3s"], got[0]["degraded"]) == (None, "RED", 5.0, False)
    assert (got[1]["degraded"], got[1]["shipped"], got[1]["error"], got[1]["colour"]) == (True, "m", "e", None)
    assert (got[2]["predicted_h1_m3s"], got[2]["p_exceed_h1"], got[2]["colour"]) == (2.5, 0.1, "GREEN")


def test_alert_coordinate_needs_both_numbers(table):
    doc = "<cap:identifier> </cap:identifier><cap:altitude>25.5</cap:altitude><cap:ceiling>x</cap:ceiling><cap:headline>a\nb</cap:headline>"
    r = D.alert_fields(table("i int, doc string", [(7, doc)]), "i", "doc").collect()[0]
    assert (r["identifier"], r["approx_lat"], r["approx_lon"], r["headline"], r["sender"]) == ("7", None, None, "a\nb", "")


def test_lines_of_words(table):
    words = [(1, 9.0, 5.0, "12"), (1, 9.4, 1.0, "Alder"), (1, 8.8, 7.0, "3.5"), (1, 9.0, 9.0, "-4"), (1, 9.0, 11.0, "5"), (1, 30.0, 1.0, "Alder"), (1, 30.0, 2.0, "1")]
    got = D.line_table(table("d int, top double, x double, t string", words), "d", "top", "x", "t", ["Alder", "Birch"]).collect()
    assert [(r["line"], r["entity"], list(r["numbers"]), r["raw"]) for r in got] == [(3, "Alder", [12.0, 3.5, -4.0, 5.0], "Alder 12 3.5 -4 5")]


def test_positional_numbers(table):
    df = table("n array<double>", [([10.0, 20.0, 5.0, 15.0, 7.0, 1.0, 1.0, 1.0, 1.0],), ([10.0, 20.0, 0.0, 25.0],), ([20.0, 10.0, 1.0, 15.0, 1.0, 2.0],)])
    got = D.label_numbers(df, "n").collect()
    assert [(r["fill_fraction"], r["present_storage_mu"], r["needs_review"]) for r in got] == [(0.5, 7.0, False), (None, None, True), (None, None, False)]


def test_rank_over_buckets_is_the_plain_rank(spark):
    df = spark.range(500).selectExpr("id % 3 AS g", "id", "(id * 7919) % 101 AS v")
    got = O.bucketed_rank(df, ["g"], F.floor(-F.col("v") / 10), [F.col("v").desc(), F.col("id")]).collect()
    for g in range(3):
        want = sorted((r for r in got if r["g"] == g), key=lambda r: (-r["v"], r["id"]))
        assert [r["rank"] for r in want] == list(range(1, len(want) + 1))


def test_uncovered_rivers(table):
    df = table("r string", [("Old Dun",), ("Dun",), ("Ey",), (None,), ("Ey",)])
    assert rows(O.uncovered(df, "r", ["dun"])) == [("Ey",)]


def test_gates_report_every_broken_rule(table):
    df = table("i int, role string, cls string, source string, retrieved_at string", [(1, "risk", "OBSERVED", "", None), (2, "risk", "SIMULATED", "s", "t"), (3, "x", None, "s", "t")])
    got = rows(Gt.provenance_gate(df, ["i"], {"risk": ("SIMULATED",)}))
    assert got == [(1, "missing retrieved_at"), (1, "missing source"), (1, "risk must be SIMULATED"), (3, "bad class")]


def test_marks_gate_with_missing_values_is_quiet(table):
    s = "i int, warning double, danger double, trend string, peak double, peak_at string, gauge_lat double, gauge_lon double, pin_lat double, pin_lon double, stale boolean, since string, checked_at string"
    quiet = (1, None, 5.0, None, None, None, None, None, 1.0, 1.0, None, None, None)
    bad = (2, 6.0, 5.0, "up", 5.0, None, 1.0, 1.0, 1.01, 1.0, True, "x", None)
    got = rows(Gt.marks_gate(table(s, [quiet, bad]), "i"))
    assert [v for i, v in got if i == 1] == []
    assert len([v for i, v in got if i == 2]) == 5


def test_published_documents(table):
    df = table("id int, v double", [(1, 2.5), (2, None)])
    docs = Ar.publish_documents(df, {"v": "OBSERVED"}, F.lit("s"), F.lit("t"), ["id"])
    got = [json.loads(r["document"]) for r in docs.orderBy("id").collect()]
    assert got[0] == {"id": 1, "v": {"value": 2.5, "class": "OBSERVED", "source": "s", "retrieved_at": "t"}}
    assert got[1]["v"] == {"class": "OBSERVED", "source": "s", "retrieved_at": "t"}
