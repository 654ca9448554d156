import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


#: Queries over feeds made from the tables; the dear ones are left to the driver.
FEEDS = ["feed_cpsc", "feed_fda", "feed_usda_outcome", "feed_establishments", "scan_positional", "scan_since", "scan_text_lines", "scan_json_array", "scan_envelope", "scan_pages", "scan_archives", "scan_unchanged", "scan_conditional", "scan_replay", "scan_between", "scan_matching", "http_dates", "hash_floats", "hash_controls", "ingest_runs", "ingest_books", "ingest_reset", "ingest_backfill", "retention", "model_recall_event", "model_event_firms", "resolved_firms", "report_by_parameters"]


def test_every_query_of_the_core_has_sql():
    from snapledger.plans import catalog, feeds  # noqa: F401

    assert set(catalog.SQL) == set(catalog.QUERIES) and len(catalog.QUERIES) > 100


def test_nothing_else_imports_the_training_data_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for at, _, files in os.walk(os.path.join(root, "snapledger")):
        for name in files:
            if name.endswith(".py") and not at.endswith("llm"):
                assert "llm" not in open(os.path.join(at, name)).read(), name


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", ["events_by_month", "conditional_insert", "column_diffs", "lifecycle", "coverage", "weekday_gaps", "firm_roll_up", "stuck_cursors", *FEEDS])
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{DATA}/{file}'")
    df = entry.queries()[name](spark, DATA)
    names = sorted(df.columns)
    result = con.execute(f"SELECT {', '.join(names)} FROM ({entry.oracle_sql()[name]})").fetchall()
    key = lambda r: [str(x) for x in r]
    assert sorted(map(tuple, df.select(*names).collect()), key=key) == sorted(result, key=key)


def test_latest_wave_and_transitions(spark):
    from snapledger.operators import versions

    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "b"), (2, 1, None)], "id int, at int, v string")
    assert sorted(r.at for r in versions.latest_by(rows, ["id"], "at").collect()) == [1, 3]
    assert [r.v_change for r in versions.transitions(rows, ["id"], ["at"], ["v"]).orderBy("id", "at").collect()] == ["first_run", "changed", "unchanged", "first_run"]
    assert versions.wave(rows.where("id = 1"), rows, ["id"]).first().asDict() == {"re_versioned": 1, "brand_new": 1, "total": 2}
    assert [(r.old_value, r.new_value) for r in versions.history(rows, ["id"], ["at"], ["v"]).collect()] == [("a", "b")]


def test_contracts_on_empty_tables(spark):
    from snapledger.operators import checks

    empty = spark.createDataFrame([], "a int, at timestamp")
    assert checks.unique(empty, "a").isEmpty() and checks.relationships(empty, "a", empty, "a").isEmpty()
    assert checks.freshness(empty, "at", "2024-01-01", 1, 2).first().status == "error" and checks.row_floor(empty, 1).count() == 1
    some = spark.createDataFrame([(None,), (5,)], "a int")
    assert checks.orphans(some, "a", empty, "a").count() == 2 and checks.relationships(some, "a", empty, "a").count() == 1


def test_similar_names_lose_no_pair(spark):
    import random

    from snapledger.plans import reports

    def edits(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, e in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != e)))
            row = new
        return row[-1]

    rng, names = random.Random(7), ["", "A", "BCDE", "XRED LACE", "RED LACE"]
    for _ in range(110):
        t = list(rng.choice(names)) if rng.random() < 0.8 else [rng.choice("ABCD ") for _ in range(rng.choice([3, 7, 14, 25]))]
        for _ in range(rng.randint(0, 4)):
            p = rng.randint(0, len(t))
            t[p : p + rng.randint(0, 1)] = rng.choice(["", "A", "B", "C"])
        names.append("".join(t))
    df = spark.createDataFrame([(x,) for x in names] + [(None,)], "name string")
    keys = sorted({x.strip() for x in names})
    for most in (2, 5):
        want = sorted((x, y, edits(x, y)) for i, x in enumerate(keys) for y in keys[i + 1 :] if edits(x, y) <= most)
        assert sorted(map(tuple, reports.similar_names(df, "name", most).collect())) == want


def test_a_small_table_is_dealt_to_all_cores(spark):
    from snapledger.plans import feeds

    rows = feeds._dealt(spark.range(100))
    assert rows.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism and rows.count() == 100


def test_days_are_read_by_the_format_that_they_fit(spark):
    from pyspark.sql import functions as F

    from snapledger.functions import parse

    rows = spark.createDataFrame([("2024-01-15",), ("2024-01-15T10:00:00",), ("2024-01-15T10:00:00Z",), ("T",), ("",), ("15.01.2024",), ("2024-01-15T",)], "t string").coalesce(1)
    value, bad = parse.day("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")(F.col("t"), F.lit("STRING"))
    found = rows.select(F.date_format(value, "dd HH").alias("v"), bad.alias("bad"))
    assert [r.v for r in found.collect()] == ["15 00", "15 10", "15 10", None, None, None, None]
    assert [r.bad for r in found.collect()] == [False, False, False, True, True, True, True]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "ontains(t" in plan  # an exception for each text that a format doesn't fit is dear
