import hashlib
import json
import random
import re
import zipfile

import pytest

from pyspark.sql import functions as F

from snapledger.functions.canonical import canonical_json, content_hash, normalize_float
from snapledger.operators import ingest as ing
from snapledger.operators import invariants, validate
from snapledger.plans import models
from snapledger.sources import readers, spec
from snapledger.sources.state import Store

NOW = "2026-05-01 00:00:00"
CPSC = {"RecallID": 24001, "RecallNumber": "24-001", "RecallDate": "2024-01-15", "LastPublishDate": "2024-01-15", "Title": "Widget Recall"}
FDA = {"PRODUCTID": "219875", "RECALLEVENTID": "98815", "RID": 1, "CENTERCD": "CFSAN", "PRODUCTTYPESHORT": "Food", "EVENTLMD": "04/24/2026", "FIRMLEGALNAM": "Acme Foods LLC"}
USDA = {"field_recall_number": "004-2020", "langcode": "English", "field_title": "Sample recall", "field_recall_date": "2020-05-15", "field_recall_type": "Active Recall", "field_recall_classification": "Class I", "field_archive_recall": "True", "field_has_spanish": "True", "field_active_notice": "False"}
EST = {"establishment_id": "6163082", "establishment_name": "CS Beef Packers, LLC", "establishment_number": "M630", "address": "1 Road", "city": "Kuna", "state": "ID", "zip": "83634", "LatestMPIActiveDate": "2026-04-01", "status_regulated_est": "", "activities": ["Meat Processing"], "dbas": []}


def raw(spark, *records):
    return spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x), "file") for x in records], "raw string, raw_landing_path string")


BAD = [
    (CPSC | {"RecallID": "not-an-int"}, spec.CPSC), (CPSC | {"RecallID": "24001"}, spec.CPSC), (CPSC | {"NewCpscField": 1}, spec.CPSC), (CPSC | {"Title": 12}, spec.CPSC), (CPSC | {"RecallDate": "15.1.2024"}, spec.CPSC),
    (CPSC | {"Products": [{"Name": "A", "Odd": "x"}]}, spec.CPSC), (CPSC | {"Products": [{"Description": "A"}]}, spec.CPSC), ({k: v for k, v in CPSC.items() if k != "RecallNumber"}, spec.CPSC),
    (FDA | {"UNKNOWN_EXTRA_FIELD": "x"}, spec.FDA), (FDA | {"RID": True}, spec.FDA), (FDA | {"RID": ""}, spec.FDA), (FDA | {"EVENTLMD": "2026-04-24"}, spec.FDA), (FDA | {"FIRMFEINUM": "abc"}, spec.FDA),
    (USDA | {"langcode": "French"}, spec.USDA), (USDA | {"field_archive_recall": "yes"}, spec.USDA), (USDA | {"field_archive_recall": ""}, spec.USDA),
    (EST | {"geolocation": True}, spec.ESTABLISHMENTS), (EST | {"activities": [1]}, spec.ESTABLISHMENTS), ({k: v for k, v in EST.items() if k != "establishment_id"}, spec.ESTABLISHMENTS), ("[1]", spec.CPSC), ("not json", spec.CPSC),
]


@pytest.mark.parametrize("of, minimal", [(spec.CPSC, CPSC), (spec.FDA, FDA), (spec.USDA, USDA), (spec.ESTABLISHMENTS, EST)], ids=lambda x: getattr(x, "name", ""))
def test_minimal_records_are_valid_and_bad_ones_are_not(spark, of, minimal):
    bad = [x for x, y in BAD if y is of]
    found = [r.errors for r in validate.parsed(raw(spark, minimal, *bad).coalesce(1), of).select("errors").collect()]
    assert found[0] == [] and len(found) == 1 + len(bad) and all(found[1:]), found


def test_values_are_stored_as_they_come(spark):
    row = validate.parsed(raw(spark, FDA | {"PRODUCTID": 219875, "RECALLEVENTID": 98815.0, "FIRMFEINUM": "", "RECALLNUM": "", "EVENTLMD": "4/5/2026"}), spec.FDA).first()
    assert (row.errors, row.source_recall_id, row.recall_event_id, row.firm_fei_num, row.recall_num, str(row.event_lmd)) == ([], "219875", 98815, None, "", "2026-04-05 00:00:00")
    row = validate.parsed(raw(spark, EST | {"geolocation": False, "county": "Ada"}), spec.ESTABLISHMENTS).first()
    assert (row.geolocation, row.county, row.activities, row.dbas) == ("false", "Ada", ["Meat Processing"], [])
    row = validate.parsed(raw(spark, CPSC | {"RecallDate": "2024-01-15T10:00:00", "Products": [{"Name": "A", "Model": ""}]}), spec.CPSC).first()
    assert str(row.recall_date) == "2024-01-15 10:00:00" and row.products[0].name == "A" and row.products[0].model == "" and row.hazards == []


def test_golden_digests(spark):
    one = spark.createDataFrame([("CPSC-001", "Test Recall", 42, None)], "source_recall_id string, title string, count int, optional string")
    assert one.select(content_hash(one)).first()[0] == "ddcf31d5864e6a9cb2ee497885fe59513a86ee77a8c0fe6f8a815888106e2407"
    two = spark.createDataFrame([("X-1", (1, None), [1, None, 3])], "id string, nested struct<a:int,b:int>, items array<int>")
    assert two.select(content_hash(two)).first()[0] == "26471774a7cb070756862c9294e7527ae8be3a5fc14b26796f0f4909bb8f9f48"
    assert two.select(canonical_json(two, exclude=["nested"])).first()[0] == '{"id":"X-1","items":[1,null,3]}'


def test_hashes_equal_pythons(spark):
    floats = [0.0, -0.0, 1.0, 0.1, 100.0, 123456.789, 9999999.0, 1e7, 12345678.5, 1e15, 123456789012345.6, 1e16, 1.5e16, 1.2345678901234567e17, 1e22, 1e100, 0.001, 0.0001, 0.00012345678901234567, 1e-5, 1.5e-7, 5e-324, -2.5e-8, 1.7976931348623157e308]
    texts = ["plain", 'quote " and \\ backslash', "tab\tline\nreturn\r\b\f", "ctl \x00\x01\x0b\x0e\x0f\x10\x1a\x1f\x1f end", "literal \\u001F and \\\\u001F", "\\\x1f", "é — 日本 \U0001f600 \x7f \u2028", "</a>"]
    for values, kind in ((floats, "double"), (texts, "string")):
        rows = [(i, v, [v, None], (v, None)) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}, items array<{kind}>, nested struct<b:{kind},a:string>")
        for r in df.select("*", canonical_json(df).alias("text"), content_hash(df).alias("digest")).collect():
            want = json.dumps({"i": r.i, "v": r.v, "items": r["items"], "nested": {"b": r.v}}, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
            assert r.text == want and r.digest == hashlib.sha256(want.encode()).hexdigest()
    rng = random.Random(2)
    odd = [0.5e-6, 1.5e-6, 2.5e-6, 0.1234565, 3.0, 1e-9, 2.675, 123456.7890125] + [k / 2e6 for k in range(1, 400, 2)] + [rng.uniform(-1e6, 1e6) for _ in range(200)]
    got = spark.createDataFrame([(x,) for x in odd + [-x for x in odd]], "x double").select("x", normalize_float(F.col("x")).alias("y")).collect()
    assert [(r.x, r.y) for r in got if r.y != round(r.x, 6)] == []


def test_ingest_is_idempotent_and_keeps_books(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    batch = [CPSC | {"RecallNumber": f"24-{i:03}", "RecallID": i} for i in range(21)] + [CPSC | {"RecallID": "bad"}]
    first = ing.ingest(raw(spark, *batch), spec.CPSC, store, NOW)
    again = ing.ingest(raw(spark, *batch), spec.CPSC, store, "2026-05-02 00:00:00")
    assert (first.inserted, first.rejected, first.status, again.inserted) == (21, 1, "success", 0)
    assert store.cursor("cpsc") == "2024-01-15" and store.read("runs", "extraction_runs").count() == 2
    changed = batch[:21]
    changed[3] = changed[3] | {"Title": "Other"}
    assert ing.ingest(raw(spark, *changed), spec.CPSC, store, "2026-05-03 00:00:00").inserted == 1
    assert ing.ingest(raw(spark, *batch[:21]), spec.CPSC, store, "2026-05-04 00:00:00").inserted == 1  # A, B, A


def test_rejections_abort_after_the_writes(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    fine = [CPSC | {"RecallNumber": str(i)} for i in range(19)]
    with pytest.raises(ing.RejectionError):
        ing.ingest(raw(spark, *fine[:18], CPSC | {"x": 1}), spec.CPSC, store, NOW)
    assert store.read("bronze", "cpsc").count() == 18 and store.read("runs", "extraction_runs").first().status == "aborted"
    assert ing.ingest(raw(spark, *fine, CPSC | {"x": 1}), spec.CPSC, store, NOW).status == "success"  # 5 per cent isn't over it
    assert ing.ingest(raw(spark), spec.CPSC, store, NOW).fetched == 0


def test_hash_excludes_and_siblings(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    ing.ingest(raw(spark, FDA), spec.FDA, store, NOW)
    assert ing.ingest(raw(spark, FDA | {"RID": 9}), spec.FDA, store, NOW).inserted == 0
    good, bad = validate.validate(raw(spark, USDA, USDA | {"langcode": "Spanish"}, USDA | {"langcode": "Spanish", "field_recall_number": "999-2020"}, USDA | {"field_recall_date": "2999-01-01", "field_recall_number": "1"}, USDA | {"field_recall_number": " \t"}), spec.USDA)
    from snapledger.operators import invariants

    passed, rejected = invariants.check(good, spec.USDA, NOW)
    assert bad.count() == 0 and passed.count() == 2
    assert {r.source_recall_id: r.failure_reason for r in rejected.collect()} == {"999-2020": "no English sibling in the batch", "1": "recall_date out of range", " \t": "blank id"}


def test_archives_lines_and_drift(spark, tmp_path):
    names = spec.NHTSA.positions
    base = dict.fromkeys(names, "") | {"record_id": "1", "campno": "20V001", "odate": "19010101", "rcdate": "20200101", "do_not_drive": "Yes", "desc_defect": '<a href="x">"quoted"</a>'}
    rows = [base, base | {"record_id": "2", "rcdate": "20190101"}, base | {"record_id": "3", "fmvss": "1234"}]
    lines = ["\t".join(r[n] for n in names) for r in rows] + ["\t".join(["x"] * 30)]
    for name in ("pre", "post"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("data.txt", "\r\n".join(lines) + "\r\n\r\n")
    scan = readers.positional(readers.zip_lines(spark, f"{tmp_path}/pre.zip"), spec.NHTSA)
    good, bad = validate.validate(scan, spec.NHTSA)
    assert {r.source_recall_id: (r.do_not_drive, r.desc_defect, str(r.odate)) for r in good.collect()}["1"] == (True, base["desc_defect"], "1901-01-01 00:00:00")
    assert sorted(r.failure_stage for r in bad.collect()) == ["extract", "validate_records"]
    assert readers.positional(readers.zip_lines(spark, f"{tmp_path}/pre.zip"), spec.NHTSA, since="20200101").count() == 3
    both = readers.concatenated(*(readers.zip_lines(spark, f"{tmp_path}/{n}.zip") for n in ("pre", "post")))
    assert both.count() == 8
    a, b = readers.inner_fingerprints(spark, f"{tmp_path}/*.zip").collect()
    assert a.sha256 == b.sha256 and readers.unchanged(readers.fingerprints(spark, f"{tmp_path}/pre.zip"), readers.fingerprints(spark, f"{tmp_path}/pre.zip"))


def test_envelopes(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"STATUSCODE": 400, "MESSAGE": "ok", "RESULTCOUNT": 1, "RESULT": [FDA]}))
    (tmp_path / "b.json").write_text(json.dumps({"STATUSCODE": 412, "MESSAGE": "none"}))
    assert validate.validate(readers.envelope(spark, str(tmp_path)), spec.FDA)[0].count() == 1
    (tmp_path / "c.json").write_text(json.dumps({"STATUSCODE": 401, "MESSAGE": "no"}))
    with pytest.raises(readers.AuthError):
        readers.envelope(spark, str(tmp_path))
    (tmp_path / "arr.txt").write_text(json.dumps([CPSC, CPSC]))
    assert readers.json_array(spark, str(tmp_path / "arr.txt")).count() == 2


def test_models(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    ing.ingest(raw(spark, CPSC | {"Manufacturers": [{"Name": " Acme Foods llc", "CompanyID": "7"}], "Retailers": [{"Name": " "}], "Products": [{"Name": "A"}, {"Name": "B"}], "ProductUPCs": [{"UPC": "123"}]}), spec.CPSC, store, NOW)
    ing.ingest(raw(spark, FDA, FDA | {"PRODUCTID": "219876", "RECALLNUM": "F-1"}), spec.FDA, store, NOW)
    ing.ingest(raw(spark, USDA | {"field_establishment": "Pilgrim&#039;s Pride"}, USDA | {"langcode": "Spanish", "field_summary": "hola"}), spec.USDA, store, NOW)
    ing.ingest(raw(spark, EST | {"establishment_name": "PILGRIM'S PRIDE", "activities": [" Poultry Processing"]}), spec.ESTABLISHMENTS, store, NOW)
    names = dict.fromkeys(spec.NHTSA.positions, "") | {"record_id": "1", "campno": "20V001", "yeartxt": "9999", "odate": "19010101"}
    ing.ingest(raw(spark, names), spec.NHTSA, store, NOW)
    built = models.build({f"{n}_bronze": store.read("bronze", n) for n in spec.SOURCES})
    assert built["recall_event"].count() == 3 and built["recall_product"].count() == 5
    titles = {r.source: r.title for r in built["recall_event"].collect()}
    assert titles == {"CPSC": "Widget Recall", "FDA": "F-1 — Acme Foods LLC", "USDA": "Sample recall"}
    firms = {r.normalized_name: r for r in built["firm"].collect()}
    assert set(firms) == {"ACME FOODS LLC", "PILGRIM'S PRIDE"} and firms["ACME FOODS LLC"].observed_company_ids == ["7"] and firms["PILGRIM'S PRIDE"].observed_company_ids == ["M630"]
    assert built["recall_event_firm"].count() == 3 and built["recalls_by_month"].agg({"event_count": "sum"}).first()[0] == 3
    one = built["firm_establishment_attributes"].first()
    assert one.activities == ["Poultry Processing"] and one.dbas is None
    assert built["stg_nhtsa_recalls"].first().model_year is None and built["stg_nhtsa_recalls"].first().odate is None and built["nhtsa_event"].first().products == 1
    assert built["usda_with_spanish"].first().summary_alt_lang == "hola"


def test_stream_runs_the_same_ingest(spark, tmp_path):
    from snapledger.streaming.stream import ingest_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(json.dumps(CPSC | {"RecallNumber": str(i)}) for i in range(5)))
    store = Store(spark, f"file://{tmp_path}/store")
    lines = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "raw")
    for _ in range(2):
        ingest_stream(lines, spec.CPSC, store, f"file://{tmp_path}/cp", lambda: NOW).awaitTermination(60)
    assert store.read("bronze", "cpsc").count() == 5


def test_state(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    store.put_cursor("a", "2024-01-01", NOW, etag="x")
    store.put_cursor("b", "2024-01-02", NOW)
    store.put_cursor("a", "2023-01-01", NOW)
    assert (store.cursor("a"), store.cursor("b"), store.cursor("c")) == ("2023-01-01", "2024-01-02", None)
    assert store.state("cursors").where("source = 'a'").first().etag == "x"
    path = store.land("a", raw(spark, CPSC), "2026-05-01")
    assert store.replay(path).first().raw == json.dumps(CPSC)
    store.append("t", "x", spark.range(3))
    with pytest.raises(RuntimeError):
        store.remove("t", "x", 4)
    store.remove("t", "x", 3)
    assert not store.exists("t", "x")


def _parsings(df):
    """How often the optimised plan parses a record."""
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", 10_000)
    return len(re.findall("parse_?json", df._jdf.queryExecution().optimizedPlan().toString(), re.IGNORECASE))


def test_a_record_is_parsed_once_however_many_filters_follow(spark):
    raw = spark.range(3).selectExpr("concat('{\"field_title\":\"', id, '\"}') AS raw", "'x' AS raw_landing_path")
    for of in spec.SOURCES.values():
        valid, bad = validate.validate(raw, of)
        assert _parsings(valid.where("source_recall_id <> 'x'")) == 1
        assert _parsings(bad) == 1 and bad.count() == 3
    good, odd = invariants.check(validate.validate(raw, spec.USDA)[0], spec.USDA, "2026-05-01 00:00:00")
    assert _parsings(good) == 2 and _parsings(odd) == 2


def test_a_model_makes_only_the_feeds_that_it_needs(spark, monkeypatch):
    from snapledger.plans import catalog, feeds

    made = []
    monkeypatch.setattr(feeds, "_FEEDS", {n: lambda x, n=n, f=f: made.append(n) or f(x) for n, f in feeds._FEEDS.items()})
    catalog.QUERIES["model_stg_fda"](spark, "/root/testdata/sf0.001").count()
    assert made == ["fda"]


def test_valid_rows_are_those_without_errors(spark):
    rng = random.Random(5)
    odd = ["", " ", "x", None, 0, 7, -1, 1.5, 2.0, 1e30, 2**31, 2**70, True, False, [], [None], ["a"], ["a", None], ["a", 1], [[]], {}, [{}], [{"Name": None}], [{"Name": "a"}, {}], [{"Name": "a"}, None], [{"Name": "a"}, {"Name": "b", "CompanyID": None}],
           [{"Name": "a", "CompanyID": 1}], [{"Name": 1}, {"Name": "b"}], [{"Name": "a", "x": "y"}], [{"Name": ["a"]}], [{"URL": "u", "Caption": None}], [{"Name": 'a "Name": 5'}], "2024-01-15", "2024-01-15T10:00:00Z", "15.1.2024", "4/5/2026", "True", "Yes", "English", "12", " 12 ", "20240115"]
    nhtsa = dict.fromkeys(spec.NHTSA.positions, "")
    broken = ["", "null", "[]", "[1]", "not json", "{", "{}", '{"RecallID":1,"RecallID":2}', "{'RecallNumber':'1'}", None]
    for of, minimal in ((spec.CPSC, CPSC), (spec.FDA, FDA), (spec.USDA, USDA), (spec.ESTABLISHMENTS, EST), (spec.NHTSA, nhtsa)):
        names = [f.source for f in of.fields]
        texts = [json.dumps({"`": 1} | minimal), json.dumps(minimal | {f"{names[0]}: STRING, x": 1}), json.dumps(minimal)[:-1] + f', "{names[0]}": "again"}}', json.dumps(minimal) + " {}", json.dumps([minimal]), *broken]
        for f in {x.type: x for x in of.fields}.values():
            texts += [json.dumps(minimal | {f.source: v}) for v in odd] + [json.dumps({k: v for k, v in minimal.items() if k != f.source})]
        for _ in range(60):
            record = minimal | {k: rng.choice(odd) for k in rng.sample(names, 3)}
            texts.append(json.dumps(dict(rng.sample(list(record.items()), len(record)))))
        df = spark.createDataFrame([(x, "file", i % 50 == 7) for i, x in enumerate(texts)], "raw string, raw_landing_path string, drift boolean").coalesce(1)
        rows, found = validate.parsed(df, of).collect(), validate.valid(df, of)
        want = [tuple(r[c] for c in found.columns) for r in rows if r.errors == []]
        assert len(rows) == len(texts) and len(want) > 10 and sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_valid_rows_read_no_record_piece_by_piece(spark):
    """Each field of each record was looked up and its lists were opened in separate parsings."""
    df = raw(spark, CPSC)
    plan = validate.valid(df, spec.CPSC)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\(", plan)) == 1 and "variant_get" not in plan
