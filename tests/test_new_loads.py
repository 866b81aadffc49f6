"""Ids that go on, CSV rejects, stream metrics and archives, VARIANT sheets, strict bands."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.bands import DIM_CLOUD, DIM_WIND_SPEED, band_dimension
from sluice.operators.documents import clean_spec_sheet, sheet_schema, variant_entries, variant_sheets
from sluice.operators.sales import append_sales
from sluice.sinks import versioned
from sluice.sinks.numbered import commit_numbered
from sluice.sinks.versioned import commit_load, read_table
from sluice.sources.files import SALES_HEADER, split_sales_csv
from sluice.streaming.logs import read_stream_metrics, run_counted_log_stream


def keyed(spark, values):
    return spark.createDataFrame([(v, f"v{v}") for v in values], "k long, v string").repartition(3)


def ids(spark, path):
    return {r.k: r.id for r in read_table(spark, path).collect()}


def test_ids_go_on_and_repeated_loads_change_nothing(spark, tmp_dir):
    p = tmp_dir + "/t"
    assert commit_numbered(keyed(spark, [30, 10, 20]), p, ["k"], run="a") == {"first_id": 1, "rows": 3}
    assert commit_numbered(keyed(spark, [5, 6]), p, ["k"], run="b") == {"first_id": 4, "rows": 2}
    want = {10: 1, 20: 2, 30: 3, 5: 4, 6: 5}
    assert ids(spark, p) == want
    for run, values in (("a", [20, 30, 10]), ("b", [6, 5])):
        commit_numbered(keyed(spark, values), p, ["k"], run=run)
        assert ids(spark, p) == want
    commit_numbered(keyed(spark, [5, 6, 7]), p, ["k"], run="b")  # the last block may grow
    assert ids(spark, p) == want | {7: 6}
    with pytest.raises(ValueError, match="block"):
        commit_numbered(keyed(spark, [10, 20, 30, 40]), p, ["k"], run="a")
    assert commit_numbered(keyed(spark, []), p, ["k"], run="c") == {"first_id": 7, "rows": 0}
    assert commit_numbered(keyed(spark, [1]), p, ["k"], run="d")["first_id"] == 7
    assert sorted(ids(spark, p).values()) == list(range(1, 8))


def test_two_numbering_writers_share_no_id(spark, tmp_dir, monkeypatch):
    p = tmp_dir + "/t"
    commit_numbered(keyed(spark, [1]), p, ["k"], run="a")
    real, raced = versioned.publish, []

    def publish(session, folder, number, content):
        if not raced:
            raced.append(number)
            commit_numbered(keyed(spark, [2, 3]), p, ["k"], run="b")
        return real(session, folder, number, content)

    monkeypatch.setattr(versioned, "publish", publish)
    assert commit_numbered(keyed(spark, [4]), p, ["k"], run="c") == {"first_id": 4, "rows": 1}
    assert ids(spark, p) == {1: 1, 2: 2, 3: 3, 4: 4}


ROW = "Asia,Japan,Snacks,Online,L,7/27/2012,{},7/28/2012,{},1.00,1.00,1.00,1.00,1.00"


def csv(tmp_dir, name, lines):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(",".join(SALES_HEADER) + "\n" + "".join(x + "\n" for x in lines))
    return path


def test_sales_loads_continue(spark, tmp_dir):
    one, two = (csv(tmp_dir, n, [ROW.format(k, 1) for k in keys]) for n, keys in (("a.csv", [9, 7]), ("b.csv", [2, 8])))
    for path, run in ((one, "d1"), (two, "d2"), (two, "d2"), (one, "d1")):
        append_sales(spark, path, tmp_dir + "/sales", run)
    assert {r.order_id: r.id for r in read_table(spark, tmp_dir + "/sales").collect()} == {7: 1, 9: 2, 2: 3, 8: 4}


def test_every_csv_line_in_exactly_one_output(spark, tmp_dir):
    good = [ROW.format(1, 5), ROW.format(2, 6).replace("Japan", '"Korea, South"'), ROW.format(3, "")]
    bad = [ROW.format(4, "many"), ROW.format(5, 5).replace("7/27/2012", "27/7/2012"), ROW.format(6, 5) + ",extra",
           ROW.format(7, 5).rsplit(",", 3)[0], ROW.format("", 5).replace("Asia", '"Asia'), "just text"]
    path = csv(tmp_dir, "s.csv", [x for pair in zip(good, bad, strict=False) for x in pair] + bad[3:])
    counts = split_sales_csv(spark, path, tmp_dir + "/good", tmp_dir + "/bad")
    assert counts == {"rows": 9, "good": 3, "bad": 6}
    rows = spark.read.parquet(tmp_dir + "/good").collect()
    assert sorted((r["Order ID"], r["Country"], r["Units Sold"]) for r in rows) == [
        (1, "Japan", 5), (2, "Korea, South", 6), (3, "Japan", None)]
    rejected = spark.read.parquet(tmp_dir + "/bad").collect()
    assert sorted(r.line for r in rejected) == sorted(bad) and {r.reason for r in rejected} == {"malformed"}
    counts = split_sales_csv(spark, path, tmp_dir + "/good", tmp_dir + "/bad", required=["Units Sold"])
    assert counts == {"rows": 9, "good": 2, "bad": 7}
    missing = spark.read.parquet(tmp_dir + "/bad").where("reason = 'missing value'").collect()
    assert [json.loads(r.line)["Order ID"] for r in missing] == [3]
    with pytest.raises(ValueError, match="lacks"):
        split_sales_csv(spark, _headless(tmp_dir), tmp_dir + "/g", tmp_dir + "/b")


def _headless(tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,2\n")
    return path


LINE = "2015-10-17 18:14:59,542 INFO [main] org.Foo: message {}\n"


def drop(folder, name, parsed, dropped):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("".join(LINE.format(i) for i in range(parsed)) + "\tat Foo.bar\n" * dropped)


def test_metrics_of_every_batch_outlive_restarts(spark, tmp_dir):
    base = tmp_dir + "/s"

    def run():
        return run_counted_log_stream(spark, base + "/in", base + "/out", base + "/ckpt", max_files_per_trigger=1)

    drop(base + "/in", "a.log", 3, 1)
    first = run()
    seen = [p["observedMetrics"]["log_lines"] for p in map(json.loads, (p.json for p in first.recentProgress)) if p.get("observedMetrics")]
    assert [(m["rows_read"], m["rows_parsed"], m["rows_dropped"]) for m in seen if m["rows_read"]] == [(4, 3, 1)]
    drop(base + "/in", "b.log", 2, 0)
    run()
    run()  # nothing new
    want = [(0, 4, 3, 1), (1, 2, 2, 0)]
    read = lambda: sorted((r.batch_id, r.rows_read, r.rows_parsed, r.rows_dropped)
                          for r in read_stream_metrics(spark, base + "/out").collect())
    assert read() == want
    # The driver died after the batch's output, before its commit: the batch is replayed.
    os.remove(base + "/ckpt/commits/1")
    if os.path.exists(base + "/ckpt/commits/.1.crc"):
        os.remove(base + "/ckpt/commits/.1.crc")
    run()
    assert read() == want
    assert spark.read.csv(base + "/out").count() == 5


def test_archived_files_are_read_once(spark, tmp_dir):
    base = tmp_dir + "/s"
    for i in range(4):
        drop(base + "/in", f"f{i}.log", 2, 1)
        run_counted_log_stream(spark, base + "/in", base + "/out", base + "/ckpt", max_files_per_trigger=1,
                               archive_dir=base + "/archive", max_file_age="7d")
    left = [f for f in os.listdir(base + "/in") if f.endswith(".log")]
    archived = [f for _, _, names in os.walk(base + "/archive") for f in names if f.endswith(".log")]
    assert sorted(left + archived) == [f"f{i}.log" for i in range(4)] and len(archived) >= 2
    assert sorted((r.rows_read, r.rows_parsed) for r in read_stream_metrics(spark, base + "/out").collect()) == [(3, 2)] * 4


SHEET = {"url": ["https://x.y/1"], "Brand": ["B"], "Brief": {"Name": ["no"]},
         "Size": {"Min. Width": ["70 mm"], "Mass": ["142 g\n, ", "5 oz\n"], "a\"b.c": ["q\"uote\n"]}, "Empty": {}}


def test_string_or_list_comes_back(spark, tmp_dir):
    raw = spark.createDataFrame([(1, json.dumps(SHEET)), (2, '{"url": []}')], "doc_id int, raw string")
    sheets = variant_sheets(clean_spec_sheet(raw, keep=["doc_id"]), keep=["doc_id"])
    sheets.write.parquet(tmp_dir + "/v")
    back = spark.read.parquet(tmp_dir + "/v")
    docs = {r[0]: json.loads(r[1]) for r in back.select("doc_id", F.to_json("sheet")).collect()}
    assert docs[1] == {"url": "https://x.y/1", "Brand": "B", "Empty": {},
                       "Size": {"Minimum Width": "70 mm", "Mass": ["142 g", "5 oz"], "a\"b.c": "q\"uote"}}
    assert back.where("doc_id = 1").select(F.variant_get("sheet", "$.Size.Mass[1]", "string")).first()[0] == "5 oz"
    entries = sorted((r.category or "", r.attribute, r.kind, r.value) for r in variant_entries(back, ["doc_id"]).where("doc_id = 1").collect())
    assert entries == [("", "Brand", "STRING", '"B"'), ("", "url", "STRING", '"https://x.y/1"'),
                       ("Size", "Mass", "ARRAY<STRING>", '["142 g","5 oz"]'), ("Size", "Minimum Width", "STRING", '"70 mm"'),
                       ("Size", 'a"b.c', "STRING", '"q\\"uote"')]
    assert "Mass: ARRAY<STRING>" in sheet_schema(back) and "`Minimum Width`: STRING" in sheet_schema(back)


def bands(spark, rows):
    return spark.createDataFrame(rows, "Variable string, Value string, Meaning string")


@pytest.mark.parametrize("rows, spec", [
    ([("Wind Speed", "1", "Below 0.3m/s (calm)"), ("Wind Speed", "2", "O.3-3.4m/s (light)"),
      ("Wind Speed", "3", "Over 3.4m/s (gale)")], DIM_WIND_SPEED),
    ([("Wind Speed", "1", "Below 0.3m/s (calm)"), ("Wind Speed", "2", "0.3-3,4m/s (light)"),
      ("Wind Speed", "3", "Over 3.4m/s (gale)")], DIM_WIND_SPEED),
    ([("Cloud Cover", "x", "0%-6%"), ("Cloud Cover", "2", "6%-19%")], DIM_CLOUD)])
def test_a_bad_bound_or_code_fails_unless_lenient(spark, rows, spec):
    with pytest.raises(Exception, match="no number in a band table"):
        band_dimension(bands(spark, rows), spec).collect()
    assert band_dimension(bands(spark, rows), spec, lenient=True).count() == len(rows)


def test_append_and_numbered_parts_share_a_table(spark, tmp_dir):
    p = tmp_dir + "/t"
    commit_numbered(keyed(spark, [1]), p, ["k"], run="a")
    with pytest.raises(ValueError):
        commit_load(keyed(spark, [1]), p)  # without ids the columns differ
