import datetime as dt
import json

from pyspark.sql import functions as F

from sluice.operators.documents import (
    clean_spec_sheet,
    normalise_inspections,
    spec_entries,
    typed_trips,
    zips_table,
)


def test_normalise_inspections(spark):
    docs = spark.createDataFrame(
        [("b2", 10, "Acme", ("NYC", "", "Main St", "12")),
         ("a1", 11, "Bolt", ("", "10001", "", ""))],
        "_id string, certificate_number long, business_name string, "
        "address struct<city:string, zip:string, street:string, number:string>")
    inspection, address = normalise_inspections(docs)
    assert inspection.columns == ["certificate_number", "business_name", "address_id"]
    ins = {r.business_name: r for r in inspection.collect()}
    assert ins["Bolt"].address_id == 0 and ins["Acme"].address_id == 1  # index in _id order
    assert ins["Acme"].certificate_number == "10"
    addr = {r.address_id: r for r in address.collect()}
    assert addr[1].zip is None and addr[1].city == "NYC"
    assert addr[0].city is None and addr[0].street is None and addr[0].number is None


def test_zips_keep_leading_zero(spark):
    z = spark.createDataFrame([("01001", "AGAWAM", "MA", 15338, [-72.622739, 42.070206])],
                              "_id string, city string, state string, pop long, loc array<double>")
    r = zips_table(z).collect()[0]
    assert (r.zip, r.lat, r.lon) == ("01001", 42.070206, -72.622739)


def test_typed_trips(spark):
    trips = spark.createDataFrame(
        [("x1", 372, "2016-01-01 00:00:45.0000", "2016-01-01 00:06:57.1234", 3183, "Exchange Place", 3194, 24393,
          "Subscriber", 1985, 1)],
        "_id string, tripduration int, starttime string, stoptime string, `start station id` int, "
        "`start station name` string, `end station id` int, bikeid int, usertype string, `birth year` int, gender int")
    r = typed_trips(trips).collect()[0]
    assert r.start_station_id == "3183" and r.bikeid == "24393" and r.end_station_id == "3194"
    assert r.stoptime == dt.datetime(2016, 1, 1, 0, 6, 57, 123400)
    assert r.birth_year == 1985


SHEET = {
    "url": ["https://example.com/phone/1"],
    "Brief": {"Released": ["2020"]},
    "General": {"Brand": ["Acme"], "Model": ["X1\n"]},
    "Camera": {
        "Sec. Cam. Module": ["8 MP"],
        "Aux. Cam.": ["2 MP\n, ", "depth"],
        "Auxilary4 Cam": ["1 MP"],
        "Min. Equiv. Focal": ["17 mm"],
        "Res. Density": ["400 ppi"],
        "Cam. Res.": ["12 MP"],
        "Camera Res.": ["13 MP"],
    },
}


def test_clean_spec_sheet(spark):
    raw = spark.createDataFrame([(1, json.dumps(SHEET))], "doc_id long, raw string")
    clean = clean_spec_sheet(raw, keep=["doc_id"]).collect()[0]
    assert clean.fields == {"url": "https://example.com/phone/1"}
    assert "Brief" not in clean.specs
    assert clean.specs["General"] == {"Brand": ["Acme"], "Model": ["X1"]}
    cam = clean.specs["Camera"]
    assert cam["Secondary Camera Module"] == ["8 MP"]
    assert cam["Auxilary Camera"] == ["2 MP", "depth"]
    assert cam["Auxilary 4 Cam"] == ["1 MP"]
    assert cam["Minimum Equivalent Focal"] == ["17 mm"]
    assert cam["Res. Density"] == ["400 ppi"]      # abbreviation without expansion is kept
    assert cam["Camera Res."] == ["13 MP"]         # collision: the later entry wins
    assert "Sec. Cam. Module" not in cam and "Aux. Cam." not in cam


def test_spec_entries_long_form(spark):
    raw = spark.createDataFrame([(1, json.dumps(SHEET))], "doc_id long, raw string")
    rows = spec_entries(clean_spec_sheet(raw, keep=["doc_id"]), keep=["doc_id"])
    got = {(r.category, r.attribute, r.value_index): (r.value, r.n_values) for r in rows.collect()}
    assert got[(None, "url", 0)] == ("https://example.com/phone/1", 1)
    assert got[("Camera", "Auxilary Camera", 1)] == ("depth", 2)
    assert rows.where(F.col("category") == "Brief").count() == 0


def test_json_array_of_documents_with_oid(spark, tmp_dir):
    import os

    from sluice.sources.files import oid_to_text, read_json_documents

    docs = [{"_id": {"$oid": "5a0b8f1e2c6d4b3a1e9f0001"}, "tripduration": 5},
            {"_id": {"$oid": "5a0b8f1e2c6d4b3a1e9f0002"}, "tripduration": 7}]
    path = os.path.join(tmp_dir, "trips.json")
    with open(path, "w") as f:
        json.dump(docs, f, indent=1)
    df = oid_to_text(read_json_documents(spark, path, "_id struct<`$oid`: string>, tripduration int"))
    assert sorted((r._id[-4:], r.tripduration) for r in df.collect()) == [("0001", 5), ("0002", 7)]


def test_sheets_with_different_keys(spark):
    a = {"url": ["u1"], "Display": {"Size": ["6.1 in"]}}
    b = {"url": ["u2"], "Display": {"Size": ["6.5 in"], "Display Notch": ["Yes"]}, "NFC": {"Support": ["Yes"]}}
    raw = spark.createDataFrame([(1, json.dumps(a)), (2, json.dumps(b))], "doc_id long, raw string")
    rows = {r.doc_id: r for r in clean_spec_sheet(raw, keep=["doc_id"]).collect()}
    assert rows[1].specs == {"Display": {"Size": ["6.1 in"]}}
    assert rows[2].specs["Display"]["Display Notch"] == ["Yes"] and rows[2].specs["NFC"] == {"Support": ["Yes"]}


def test_spec_sheet_stream_stores_each_url_once(spark, tmp_dir):
    import os

    from sluice.streaming.documents import read_stored_sheets, run_spec_sheet_stream

    def sheet(u, brand):
        return json.dumps({"url": [u], "Brief": {"x": ["y"]}, "General": {"Brand": [brand], "Sec. Cam.": ["8 MP"]}})

    in_dir = os.path.join(tmp_dir, "in")
    os.makedirs(in_dir)
    with open(os.path.join(in_dir, "a.jsonl"), "w") as f:
        f.write("\n".join([sheet("u1", "A"), sheet("u2", "B"), sheet("u1", "A")]) + "\n")
    with open(os.path.join(in_dir, "b.jsonl"), "w") as f:
        f.write("\n".join([sheet("u2", "B"), sheet("u3", "C")]) + "\n")
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    run_spec_sheet_stream(spark, in_dir, out, ckpt, max_files_per_trigger=1)
    stored = read_stored_sheets(spark, out)
    assert sorted(r.url for r in stored.collect()) == ["u1", "u2", "u3"]
    row = stored.where("url = 'u3'").first()
    assert row.specs["General"] == {"Brand": ["C"], "Secondary Camera": ["8 MP"]}
    # Restart with one new file: only the new URL is added.
    with open(os.path.join(in_dir, "c.jsonl"), "w") as f:
        f.write("\n".join([sheet("u3", "C"), sheet("u4", "D")]) + "\n")
    run_spec_sheet_stream(spark, in_dir, out, ckpt)
    assert sorted(r.url for r in read_stored_sheets(spark, out).collect()) == ["u1", "u2", "u3", "u4"]


def _clean_in_python(sheet):
    """The documented cleaning rules, written plainly for comparison."""
    from sluice.operators.documents import EXCLUDED_TOP_KEY, KEY_REPLACEMENTS

    fields, specs = {}, {}
    for top, val in sheet.items():
        if top == EXCLUDED_TOP_KEY:
            continue
        if isinstance(val, dict):
            out = {}
            for k, items in val.items():
                for old, new in KEY_REPLACEMENTS:
                    k = k.replace(old, new)
                if len(items) == 1:
                    out[k] = [items[0].replace("\n", "")]
                else:
                    out[k] = [x.replace("\n, ", "").replace("\n", "") for x in items]
            specs[top] = out
        else:
            fields[top] = val[0]
    return fields, specs


def test_clean_spec_sheet_matches_python_rules_on_random_sheets(spark):
    import random

    rnd = random.Random(11)
    keys = ["Sec. Cam.", "Secondary Cam.", "Aux. Lens", "Auxilary4 Mic", "Min. Equiv. Focal", "Res. Density",
            "Brand", "Cam. Res.", "Camera Res.", "Model"]
    texts = ["8 MP", "x\n", "\n, y", "a\n, b\n", "", "plain"]
    sheets = []
    for i in range(60):
        sheet = {"url": [f"u{i}", "extra"], "Brief": {"Brand": ["z"]}}
        for cat in rnd.sample(["General", "Camera", "Display"], rnd.randint(1, 3)):
            sheet[cat] = {k: [rnd.choice(texts) for _ in range(rnd.randint(1, 3))]
                          for k in rnd.sample(keys, rnd.randint(1, 6))}
        sheets.append(sheet)
    raw = spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(sheets)], "doc_id long, raw string")
    got = {r.doc_id: (r.fields, r.specs) for r in clean_spec_sheet(raw, keep=["doc_id"]).collect()}
    for i, s in enumerate(sheets):
        assert got[i] == _clean_in_python(s), i
