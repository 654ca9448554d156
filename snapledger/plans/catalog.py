"""The registered queries, bound to the driver's tables, each beside the DuckDB SQL that it is held against.

Two kinds: ``shown`` ones run an operator of this library against SQL of its own; ``sql`` ones are single SQL
primitives whose text both engines take, which Spark plans by itself. Every query runs over its whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.canonical import content_hash
from ..operators import checks, profile, validate, versions
from . import models, reports

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations", "embeddings", "pages", "benchmark")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def shown(name: str, sql: str | None) -> Callable:
    """Registers a function of Tables as a query."""

    def register(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, sf_dir: plan(Tables(spark, sf_dir))
        if sql:
            SQL[name] = sql
        return plan

    return register


_NAMED = re.compile(rf"(\b(?:FROM|JOIN)\s+|,\s+)({'|'.join(TABLES)})\b(?!\.)")


def sql(name: str, text: str, duck: str | None = None) -> None:
    """Registers one SQL text for both engines; ``duck`` where DuckDB spells it another way.

    The tables are bound to the one statement; no view is left in the session.
    """
    bound = _NAMED.sub(r"\1{\2}", text)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(bound, **{x: spark.read.parquet(f"{sf_dir}/{x}.parquet") for x in TABLES if "{" + x + "}" in bound})

    QUERIES[name], SQL[name] = run, duck or text


# --- flagship: two sources, latest versions, harmonised, by month


@shown(
    "events_by_month",
    """
WITH o AS (SELECT 'orders' AS source, CAST(o_custkey AS VARCHAR) AS id, o_orderdate AS seen, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders),
e AS (SELECT 'events' AS source, CAST(user_id AS VARCHAR) AS id, ts AS seen, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events),
u AS (SELECT source, seen, md5(source || '|' || id) AS key FROM (SELECT * FROM o WHERE rn = 1 UNION ALL SELECT * FROM e WHERE rn = 1))
SELECT CAST(date_trunc('month', seen) AS DATE) AS month, source, count(*) AS event_count, count(DISTINCT key) AS distinct_events FROM u GROUP BY 1, 2""",
)
def _by_month(x: Tables) -> DataFrame:
    orders = versions.latest_by(x.orders.select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], "o_orderdate", "o_orderkey").select(F.lit("orders").alias("source"), F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("at"))
    events = versions.latest_by(x.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", "event_id").select(F.lit("events").alias("source"), F.col("user_id").alias("id"), F.col("ts").alias("at"))
    rows = orders.unionByName(events).withColumn("key", t.surrogate_key(F.col("source"), F.col("id")))
    return models.by_month(rows, "at", "source", "key")


# --- versions


@shown("latest_order", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def _latest(x: Tables) -> DataFrame:
    return versions.latest_by(x.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@shown("latest_then_filter", "SELECT source, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn = 1 AND lang = 'en'")
def _latest_lang(x: Tables) -> DataFrame:
    return versions.latest_by(x.documents.select("source", "lang", "doc_id"), ["source", "lang"], "doc_id").where("lang = 'en'")


@shown("top_five_orders", "SELECT o_orderpriority, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 5")
def _top5(x: Tables) -> DataFrame:
    return versions.top_by(x.orders, ["o_orderpriority"], 5, F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_orderpriority", "o_orderkey", "o_totalprice")


_PAIR = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS z FROM orders),
o AS (SELECT * FROM r WHERE a = 1), n AS (SELECT * FROM r WHERE z = 1)"""


def _old_new(x: Tables) -> tuple[DataFrame, DataFrame]:
    return versions.first_by(x.orders, ["o_custkey"], "o_orderdate", "o_orderkey"), versions.latest_by(x.orders, ["o_custkey"], "o_orderdate", "o_orderkey")


@shown(
    "column_diffs",
    _PAIR + """ SELECT count(*) AS pairs, CAST(sum(CAST(o.o_orderstatus IS DISTINCT FROM n.o_orderstatus AS INT)) AS BIGINT) AS o_orderstatus_diffs, CAST(sum(CAST(o.o_orderpriority IS DISTINCT FROM n.o_orderpriority AS INT)) AS BIGINT) AS o_orderpriority_diffs,
CAST(sum(CAST(o.o_totalprice IS DISTINCT FROM n.o_totalprice AS INT)) AS BIGINT) AS o_totalprice_diffs FROM o JOIN n USING (o_custkey)""",
)
def _diffs(x: Tables) -> DataFrame:
    return versions.column_diffs(*_old_new(x), ["o_custkey"], ["o_orderstatus", "o_orderpriority", "o_totalprice"])


@shown("phantom_versions", _PAIR + " SELECT o_custkey, o.o_orderkey AS old_key, n.o_orderkey AS new_key FROM o JOIN n USING (o_custkey) WHERE o.o_orderkey IS DISTINCT FROM n.o_orderkey AND o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority")
def _phantom(x: Tables) -> DataFrame:
    out = versions.phantom_versions(*_old_new(x), ["o_custkey"], ["o_orderstatus", "o_orderpriority"], "o_orderkey")
    return out.select("o_custkey", F.col("old.o_orderkey").alias("old_key"), F.col("new.o_orderkey").alias("new_key"))


@shown("kind_transitions", _PAIR + " SELECT CASE WHEN o.o_orderstatus IS NULL THEN 'null' WHEN o.o_orderstatus = '' THEN 'empty_string' ELSE 'value' END AS before, CASE WHEN n.o_orderstatus IS NULL THEN 'null' WHEN n.o_orderstatus = '' THEN 'empty_string' ELSE 'value' END AS after, count(*) AS n FROM o JOIN n USING (o_custkey) GROUP BY 1, 2")
def _kinds(x: Tables) -> DataFrame:
    return reports.kind_transitions(*_old_new(x), ["o_custkey"], "o_orderstatus")


@shown(
    "rebaseline_wave",
    """WITH b AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01'), a AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')
SELECT count(b.l_orderkey) AS re_versioned, count(*) FILTER (WHERE b.l_orderkey IS NULL) AS brand_new, count(*) AS total FROM a LEFT JOIN b USING (l_orderkey, l_linenumber)""",
)
def _wave(x: Tables) -> DataFrame:
    rows, cut = x.lineitem, F.lit("1998-01-01").cast("timestamp_ntz")
    return versions.wave(rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut), ["l_orderkey", "l_linenumber"])


_STORED = "SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0"


@shown(
    "conditional_insert",
    f"""WITH s AS ({_STORED}), l AS (SELECT o_orderkey, max_by(sha256('{{"o_orderstatus":"' || o_orderstatus || '"}}'), o_orderdate) AS h FROM s GROUP BY o_orderkey)
SELECT o.o_orderkey, o_orderstatus FROM orders o LEFT JOIN l USING (o_orderkey) WHERE l.h IS DISTINCT FROM sha256('{{"o_orderstatus":"' || o_orderstatus || '"}}')""",
)
def _insert(x: Tables) -> DataFrame:
    stored = x.orders.where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    hashed = lambda df: df.withColumn("content_hash", content_hash(df, ["o_orderstatus"]))
    return versions.new_versions(hashed(x.orders.select("o_orderkey", "o_orderstatus")), hashed(stored), ["o_orderkey"], at="o_orderdate").select("o_orderkey", "o_orderstatus")


@shown("content_hash", """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS content_hash FROM customer""")
def _hash(x: Tables) -> DataFrame:
    return x.customer.select("c_custkey", content_hash(x.customer, ["c_name", "c_nationkey", "c_mktsegment"]).alias("content_hash"))


@shown("multi_version_identities", "SELECT l_orderkey, count(DISTINCT l_partkey) AS versions, count(*) AS rows FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_partkey) >= 2")
def _multi(x: Tables) -> DataFrame:
    return versions.multi_version(x.lineitem, ["l_orderkey"], "l_partkey")


@shown("edit_summary", "SELECT CAST(sum(v) AS BIGINT) AS versions, count(*) AS identities, count(*) FILTER (WHERE v > 1) AS edited, CAST(sum(v) - count(*) AS BIGINT) AS extra FROM (SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS v FROM lineitem GROUP BY 1, 2)")
def _edits(x: Tables) -> DataFrame:
    return reports.edits(x.lineitem, ["l_orderkey", "l_linenumber"], "l_partkey")


_LAG = "lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, row_number() OVER w AS rn"
_TRANS = f"""WITH l AS (SELECT *, {_LAG} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
c AS (SELECT *, CASE WHEN rn = 1 THEN 'first_run' WHEN event_type IS NOT DISTINCT FROM pt THEN 'unchanged' ELSE 'changed' END AS tc, CASE WHEN rn = 1 THEN 'first_run' WHEN value IS NOT DISTINCT FROM pv THEN 'unchanged' ELSE 'changed' END AS bc FROM l),
v AS (SELECT *, CASE WHEN tc = 'first_run' THEN 'first_run' WHEN tc = 'unchanged' AND bc = 'unchanged' THEN 'agree_same' WHEN tc = 'changed' AND bc = 'changed' THEN 'agree_changed' WHEN tc = 'changed' THEN 'tag_only' ELSE 'body_only' END AS verdict FROM c)"""


@shown("change_signals", _TRANS + " SELECT event_id, tc AS event_type_change, bc AS value_change, verdict FROM v")
def _signals(x: Tables) -> DataFrame:
    return reports.change_signals(x.events, "user_id", "ts", "event_type", "value").select("event_id", "event_type_change", "value_change", "verdict")


@shown(
    "signal_summary",
    _TRANS + """, s AS (SELECT count(*) AS transitions, count(*) FILTER (WHERE verdict = 'agree_same') AS agree_same, count(*) FILTER (WHERE verdict = 'agree_changed') AS agree_changed, count(*) FILTER (WHERE verdict = 'tag_only') AS tag_only, count(*) FILTER (WHERE verdict = 'body_only') AS body_only FROM v WHERE verdict <> 'first_run')
SELECT *, CASE WHEN transitions < 7 THEN 'insufficient' WHEN body_only = 0 AND tag_only <= agree_changed THEN 'go' ELSE 'no_go' END AS decision FROM s""",
)
def _summary(x: Tables) -> DataFrame:
    return reports.signal_summary(x.events, "user_id", "ts", "event_type", "value")


@shown(
    "field_history",
    """WITH u AS (SELECT user_id, ts, 'event_type' AS field, event_type AS v FROM events UNION ALL SELECT user_id, ts, 'props', props FROM events),
l AS (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS rn FROM u WINDOW w AS (PARTITION BY user_id, field ORDER BY ts))
SELECT user_id, ts, field, p AS old_value, v AS new_value FROM l WHERE rn > 1 AND p IS DISTINCT FROM v""",
)
def _history(x: Tables) -> DataFrame:
    return versions.history(x.events, ["user_id"], ["ts"], ["event_type", "props"])


@shown(
    "field_history_routine",
    """WITH u AS (SELECT user_id, ts, event_type AS v, value < 10 AS odd FROM events),
l AS (SELECT *, lag(v) OVER w AS p, row_number() OVER w AS rn FROM u WINDOW w AS (PARTITION BY user_id ORDER BY ts))
SELECT user_id, ts, 'event_type' AS field, p AS old_value, v AS new_value FROM l WHERE rn > 1 AND p IS DISTINCT FROM v AND NOT odd""",
)
def _routine_history(x: Tables) -> DataFrame:
    rows = x.events.withColumn("kind", F.when(F.col("value") < 10, "schema_rebaseline").otherwise("routine"))
    return versions.history(rows, ["user_id"], ["ts"], ["event_type"], change_type="kind")


@shown(
    "lifecycle",
    """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events), r AS (SELECT day, row_number() OVER (ORDER BY day) AS o FROM (SELECT DISTINCT day FROM d)),
g AS (SELECT user_id, min(day) AS first_seen, max(day) AS last_seen, count(*) AS runs_seen, min(o) AS a, max(o) AS b FROM d JOIN r USING (day) GROUP BY user_id),
e AS (SELECT user_id, count(DISTINCT event_type) AS edit_count FROM events WHERE event_type <> 'error' GROUP BY user_id)
SELECT user_id, first_seen, last_seen, runs_seen, b = (SELECT max(o) FROM r) AS is_currently_active, b - a + 1 > runs_seen AS was_ever_retracted, coalesce(edit_count, 0) AS edit_count
FROM g LEFT JOIN e USING (user_id)""",
)
def _lifecycle(x: Tables) -> DataFrame:
    seen = x.events.select("user_id", F.to_date("ts").alias("day"))
    return versions.lifecycle(seen, ["user_id"], "day", x.events.where("event_type <> 'error'"), "event_type")


@shown("presence_manifest", "SELECT DISTINCT 'run-1' AS run_id, 'events' AS source, user_id FROM events")
def _presence(x: Tables) -> DataFrame:
    return versions.presence(x.events, "run-1", "events", ["user_id"])


# --- models on the tables at hand

_FIRMS = """SELECT c_name AS name, CAST(c_custkey AS VARCHAR) AS company FROM customer UNION ALL SELECT s_name, CAST(s_suppkey AS VARCHAR) FROM supplier UNION ALL SELECT p_name, CAST(p_partkey AS VARCHAR) FROM part"""


@shown(
    "firm_roll_up",
    f"""WITH f AS (SELECT DISTINCT upper(trim(name)) AS normalized_name, name, company FROM ({_FIRMS}))
SELECT md5(normalized_name) AS firm_id, normalized_name, min(name) AS canonical_name, count(DISTINCT name) AS names, string_agg(DISTINCT company, ',' ORDER BY company) AS companies FROM f GROUP BY normalized_name""",
)
def _firm(x: Tables) -> DataFrame:
    rows = x.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").cast("string").alias("company")).unionByName(x.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("company"))).unionByName(x.part.select(F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("company")))
    return models.roll_up(rows, "name", "company").select("firm_id", "normalized_name", "canonical_name", F.size("observed_names").cast("long").alias("names"), F.array_join("observed_company_ids", ",").alias("companies"))


@shown("role_union", "SELECT DISTINCT md5(upper(trim(name))) AS firm_id, role FROM (SELECT c_name AS name, 'customer' AS role FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier UNION ALL SELECT p_name, 'part' FROM part)")
def _roles(x: Tables) -> DataFrame:
    each = [x.customer.select(F.col("c_name").alias("name"), F.lit("customer").alias("role")), x.supplier.select(F.col("s_name").alias("name"), F.lit("supplier").alias("role")), x.part.select(F.col("p_name").alias("name"), F.lit("part").alias("role"))]
    return each[0].unionByName(each[1]).unionByName(each[2]).select(F.md5(t.name_key(F.col("name"))).alias("firm_id"), "role").distinct()


@shown("product_ordinals", "SELECT p_partkey, i, md5('PART|' || p_partkey || '|' || i) AS product_id, w AS word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, unnest(range(1, len(string_split(p_name, ' ')) + 1)) AS i FROM part)")
def _ordinals(x: Tables) -> DataFrame:
    each = x.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("j", "word")).withColumn("i", (F.col("j") + 1).cast("long"))
    return each.select("p_partkey", "i", t.surrogate_key(F.lit("PART"), F.col("p_partkey"), F.col("i")).alias("product_id"), "word")


@shown("payload_json", """SELECT c_custkey, '{"name":"' || c_name || '","nothing":null,"nation":' || c_nationkey || '}' AS payload FROM customer""")
def _payload(x: Tables) -> DataFrame:
    return x.customer.select("c_custkey", F.to_json(F.struct(F.col("c_name").alias("name"), F.lit(None).cast("string").alias("nothing"), F.col("c_nationkey").alias("nation")), {"ignoreNullFields": "false"}).alias("payload"))


@shown("title_cleanup", "SELECT page_id, nullif(replace(replace(url, '&#039;', ''''), '&amp;', '&'), '') AS url, coalesce(nullif(url, ''), 'none') || ' — ' || page_id AS title FROM pages")
def _title(x: Tables) -> DataFrame:
    return x.pages.select("page_id", t.blank_to_null(t.unescape(F.col("url"))).alias("url"), F.concat(F.coalesce(t.blank_to_null(F.col("url")), F.lit("none")), F.lit(" — "), F.col("page_id").cast("string")).alias("title"))


@shown("trimmed_arrays", "SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda x: trim(x)), '|') AS words FROM part")
def _arrays(x: Tables) -> DataFrame:
    return x.part.select("p_partkey", F.array_join(t.trimmed(F.split("p_name", " ")), "|").alias("words"))


# --- contracts


@shown("check_not_null", "SELECT o_orderkey FROM orders WHERE o_orderstatus IS NULL")
def _not_null(x: Tables) -> DataFrame:
    return checks.not_null(x.orders, "o_orderstatus").select("o_orderkey")


@shown("check_unique", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1")
def _unique(x: Tables) -> DataFrame:
    return checks.unique(x.lineitem, "l_orderkey")


@shown("check_accepted_values", "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL AND lang NOT IN ('en', 'fr') GROUP BY lang")
def _accepted(x: Tables) -> DataFrame:
    return checks.accepted_values(x.documents, "lang", ["en", "fr"])


@shown("check_relationships", "SELECT doc_id FROM documents d WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def _relationships(x: Tables) -> DataFrame:
    return checks.relationships(x.documents.select("doc_id"), "doc_id", x.labels, "doc_id")


@shown("check_orphans", "SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)")
def _orphans(x: Tables) -> DataFrame:
    return checks.orphans(x.orders.select("o_orderkey"), "o_orderkey", x.lineitem, "l_orderkey")


@shown("check_freshness", "SELECT max(ts) AS latest, CAST(round(date_diff('second', max(ts), TIMESTAMP '2024-02-03 00:00:00') / 3600.0, 2) AS DOUBLE) AS hours, CASE WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-03 00:00:00') / 3600.0 > 168 THEN 'error' WHEN date_diff('second', max(ts), TIMESTAMP '2024-02-03 00:00:00') / 3600.0 > 48 THEN 'warn' ELSE 'pass' END AS status FROM events WHERE ts < TIMESTAMP '2024-02-01'")
def _fresh(x: Tables) -> DataFrame:
    rows = x.events.where(F.col("ts") < F.lit("2024-02-01").cast("timestamp_ntz"))
    return checks.freshness(rows, "ts", "2024-02-03 00:00:00", 48, 168).select(F.col("latest").cast("timestamp_ntz").alias("latest"), F.col("hours").cast("double").alias("hours"), "status")


@shown("check_row_floor", "SELECT count(*) AS n, CAST(1000000000 AS BIGINT) AS least FROM orders HAVING count(*) < 1000000000")
def _floor(x: Tables) -> DataFrame:
    return checks.row_floor(x.orders, 1_000_000_000)


@shown("check_baseline", "SELECT * FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS n, avg(count(*)) OVER (ORDER BY CAST(ts AS DATE) ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS baseline FROM events GROUP BY 1) WHERE abs(n - baseline) > 0.1 * baseline")
def _baseline(x: Tables) -> DataFrame:
    return checks.baseline_drift(profile.cadence(x.events, "ts", "day").withColumnRenamed("period", "day"), "day", "n", 0.1)


@shown("quarantine_split", "SELECT event_id, array_to_string(list_filter([CASE WHEN NOT coalesce(event_type IN ('click', 'view'), false) THEN 'known_type' END, CASE WHEN NOT coalesce(value > 20, false) THEN 'positive' END], lambda z: z IS NOT NULL), ';') AS reasons FROM events WHERE NOT (coalesce(event_type IN ('click', 'view'), false) AND coalesce(value > 20, false))")
def _quarantine(x: Tables) -> DataFrame:
    return validate.rule_split(x.events, {"positive": F.col("value") > 20, "known_type": F.col("event_type").isin("click", "view")}, "event_id")[1]


@shown("quarantine_kept", "SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND value > 20")
def _kept(x: Tables) -> DataFrame:
    return validate.rule_split(x.events, {"positive": F.col("value") > 20, "known_type": F.col("event_type").isin("click", "view")}, "event_id")[0].select("event_id")


# --- profiles


@shown("null_rates", "SELECT count(*) AS rows, CAST(round(100.0 * count(*) FILTER (WHERE l_returnflag IS NULL) / nullif(count(*), 0), 2) AS DOUBLE) AS l_returnflag_null_pct, CAST(round(100.0 * count(*) FILTER (WHERE l_discount IS NULL) / nullif(count(*), 0), 2) AS DOUBLE) AS l_discount_null_pct FROM lineitem")
def _nulls(x: Tables) -> DataFrame:
    return profile.null_rates(x.lineitem, ["l_returnflag", "l_discount"])


@shown("null_rates_by", "SELECT source, count(*) AS rows, CAST(round(100.0 * count(*) FILTER (WHERE text IS NULL) / count(*), 2) AS DOUBLE) AS text_null_pct FROM documents GROUP BY source")
def _nulls_by(x: Tables) -> DataFrame:
    return reports.null_rates_by(x.documents, "source", ["text"])


@shown("unpivoted_kinds", "SELECT (SELECT count(*) FROM customer) AS rows, * FROM (SELECT 'c_name' AS column, count(*) FILTER (WHERE c_name IS NULL) AS nulls, count(*) FILTER (WHERE c_name = '') AS blanks FROM customer UNION ALL SELECT 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment IS NULL), count(*) FILTER (WHERE c_mktsegment = '') FROM customer)")
def _unpivot(x: Tables) -> DataFrame:
    return profile.kinds(x.customer, ["c_name", "c_mktsegment"])


@shown("distribution", "SELECT l_returnflag, count(*) AS n, CAST(round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct FROM lineitem GROUP BY l_returnflag")
def _distribution(x: Tables) -> DataFrame:
    return profile.distribution(x.lineitem, "l_returnflag")


@shown("top_values", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 10")
def _top_values(x: Tables) -> DataFrame:
    return profile.top_values(x.part, "p_brand", 10)


@shown("weekly_cadence", "SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS period, count(*) AS n FROM orders GROUP BY 1")
def _weekly(x: Tables) -> DataFrame:
    return profile.cadence(x.orders, "o_orderdate", "week")


@shown("extent", "SELECT count(*) AS rows, min(o_orderdate) AS first, max(o_orderdate) AS last, count(DISTINCT CAST(o_orderdate AS DATE)) AS days FROM orders")
def _extent(x: Tables) -> DataFrame:
    return profile.extent(x.orders, "o_orderdate")


@shown("spike_days", "SELECT CAST(o_orderdate AS DATE) AS period, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, period LIMIT 10")
def _spikes(x: Tables) -> DataFrame:
    return profile.spikes(x.orders, "o_orderdate", 10)


_BIG = "o_totalprice > 400000"


@shown("weekday_gaps", f"WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE {_BIG}), s AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM d) SELECT day, dayname(day) AS weekday FROM s ANTI JOIN d USING (day) WHERE extract(dow FROM day) NOT IN (0, 6)")
def _gaps(x: Tables) -> DataFrame:
    return profile.gaps(x.orders.where(_BIG), "o_orderdate")


@shown("coverage", "SELECT count(*) AS rows, count(l.doc_id) AS matched, CAST(round(100.0 * count(l.doc_id) / nullif(count(*), 0), 2) AS DOUBLE) AS pct FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def _coverage(x: Tables) -> DataFrame:
    return profile.coverage(x.documents, F.col("doc_id"), x.labels, F.col("doc_id"))


@shown("name_coverage", "SELECT count(*) AS rows, count(r.k) AS matched, CAST(round(100.0 * count(r.k) / nullif(count(*), 0), 2) AS DOUBLE) AS pct FROM documents d LEFT JOIN (SELECT DISTINCT upper(trim(lang)) AS k FROM documents WHERE lang IN ('en', 'de')) r ON upper(trim(d.lang)) = r.k")
def _names(x: Tables) -> DataFrame:
    return reports.name_coverage(x.documents, "lang", x.documents.where("lang IN ('en', 'de')"), "lang")


@shown("unmatched_names", "SELECT DISTINCT doc_id AS key FROM documents ANTI JOIN labels USING (doc_id)")
def _unmatched(x: Tables) -> DataFrame:
    return profile.unmatched(x.documents, F.col("doc_id"), x.labels, F.col("doc_id"))


@shown("array_shape", "SELECT count(*) FILTER (WHERE embedding IS NULL) AS nulls, count(*) FILTER (WHERE len(embedding) = 0) AS empty, CAST(min(len(embedding)) AS INT) AS shortest, CAST(max(len(embedding)) AS INT) AS longest, round(avg(len(embedding)), 4) AS mean FROM embeddings")
def _shape(x: Tables) -> DataFrame:
    return profile.array_shape(x.embeddings, "embedding")


@shown("histogram_of_counts", "SELECT rows, count(*) AS keys FROM (SELECT l_orderkey, count(*) AS rows FROM lineitem GROUP BY 1) GROUP BY rows")
def _histogram(x: Tables) -> DataFrame:
    return profile.histogram_of_counts(x.lineitem, "l_orderkey")


@shown("cross_tab", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _cross(x: Tables) -> DataFrame:
    return profile.cross_tab(x.lineitem, "l_returnflag", "l_linestatus")


# --- reports over runs: events stand for runs, event types for sources


@shown("totals_with_zeros", "SELECT event_type, CAST(coalesce(total, 0) AS BIGINT) AS total, CAST(coalesce(recent, 0) AS BIGINT) AS recent, latest FROM (SELECT DISTINCT event_type FROM events) LEFT JOIN (SELECT event_type, count(*) AS total, count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-15') AS recent, max(ts) AS latest FROM events WHERE value > 99 GROUP BY 1) USING (event_type)")
def _totals(x: Tables) -> DataFrame:
    return reports.totals_with_zeros(x.events, "event_type", x.events.where("value > 99"), "ts", "2024-01-22", 7)


@shown("failure_stages", "SELECT event_type, count(*) AS n, min(ts) AS first, max(ts) AS last FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1")
def _stages(x: Tables) -> DataFrame:
    return reports.stages(x.events, ["event_type"], "ts", "2024-01-22", 7)


@shown("latest_rejections", "SELECT event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 5")
def _rejections(x: Tables) -> DataFrame:
    return reports.latest_rejections(x.events, "event_type", "ts", "event_id").select("event_type", "event_id", "ts")


@shown("latest_runs", "SELECT user_id, event_id, CAST(date_diff('second', ts, TIMESTAMP '2024-03-01') AS BIGINT) AS seconds, left(props, 120) AS error_excerpt FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def _runs(x: Tables) -> DataFrame:
    rows = x.events.withColumn("done", F.lit("2024-03-01").cast("timestamp_ntz"))
    return reports.latest_runs(rows, "user_id", "ts", "done", "props", "event_id").select("user_id", "event_id", "seconds", "error_excerpt")


@shown("recent_runs", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 20")
def _recent(x: Tables) -> DataFrame:
    return reports.recent_runs(x.events, "ts", "event_id").select("event_id", "ts")


@shown("daily_volume", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS runs, count(*) FILTER (WHERE value < 10) AS failed, round(sum(value), 2) AS amount FROM events WHERE ts >= TIMESTAMP '2024-01-08' GROUP BY 1, 2")
def _volume(x: Tables) -> DataFrame:
    return reports.daily_volume(x.events, "event_type", "ts", "value", F.col("value") < 10, "2024-01-22", 14)


@shown("tag_formats", "SELECT CASE WHEN props IS NULL THEN 'none' WHEN props LIKE 'W/%' THEN 'weak' WHEN regexp_matches(props, '^\"?[0-9a-f]+\"?$') THEN 'hex' ELSE 'other' END AS form, count(*) AS n, CAST(min(length(props)) AS BIGINT) AS shortest, CAST(max(length(props)) AS BIGINT) AS longest FROM events GROUP BY 1")
def _formats(x: Tables) -> DataFrame:
    return reports.tag_formats(x.events, "props")


@shown("header_prints", "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, k NULLS LAST LIMIT 10")
def _headers(x: Tables) -> DataFrame:
    return reports.header_prints(x.events, "props", ["k"])


@shown("response_capture", "SELECT event_id, CAST(len(json_keys(props)) AS BIGINT) AS n_headers, left(props, 8) AS tag_start, CAST(length(props) AS BIGINT) AS tag_length FROM events")
def _capture(x: Tables) -> DataFrame:
    return reports.response_capture(x.events, "props", "props").select("event_id", "n_headers", "tag_start", "tag_length")


@shown("within_day", "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS runs, count(DISTINCT event_type) AS tags, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1, 2")
def _within(x: Tables) -> DataFrame:
    return reports.within_day(x.events, "user_id", "ts", "event_type")


@shown(
    "stuck_cursors",
    """WITH l AS (SELECT user_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1),
j AS (SELECT c_custkey AS user_id, c_name AS cursor, date_diff('second', ts, TIMESTAMP '2024-02-01') / 3600.0 AS age, ts, value FROM customer LEFT JOIN l ON c_custkey = user_id)
SELECT user_id, cursor, CASE WHEN ts IS NULL THEN 'never_ran' WHEN round(age, 2) > 48 THEN 'stale' WHEN value = 0 THEN 'idle' ELSE 'healthy' END AS verdict FROM j""",
)
def _stuck(x: Tables) -> DataFrame:
    cursors = x.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("cursor"))
    return reports.stuck_cursors(cursors, x.events, "user_id", "cursor", "ts", "value", "2024-02-01 00:00:00", tie="event_id").select("user_id", "cursor", "verdict")


@shown("column_population", "SELECT count(*) AS rows, count(props) AS props_set, count(value) AS value_set, count(*) FILTER (WHERE props IS NOT NULL AND event_type = 'click') AS props_picked, count(*) FILTER (WHERE value IS NOT NULL AND event_type = 'click') AS value_picked FROM events")
def _population(x: Tables) -> DataFrame:
    return reports.population(x.events, ["props", "value"], F.col("event_type") == "click")


@shown("bronze_sanity", "SELECT count(*) AS rows, count(DISTINCT user_id) AS keys, max(ts) AS latest, (SELECT count(*) FROM orders) AS rejected FROM events")
def _sanity(x: Tables) -> DataFrame:
    return reports.sanity(x.events, "user_id", "ts", x.orders)


@shown("quarantine_samples", "SELECT event_type, count(*) AS n, min(props) AS sample FROM events GROUP BY 1")
def _samples(x: Tables) -> DataFrame:
    return reports.quarantine_samples(x.events, "event_type", "props")


@shown("group_sizes", "SELECT o_custkey, count(DISTINCT o_orderkey) AS members FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderkey) >= 3 ORDER BY members DESC, o_custkey LIMIT 15")
def _sizes(x: Tables) -> DataFrame:
    return reports.group_sizes(x.orders, "o_custkey", "o_orderkey", 3, 15)


_TWO = "SELECT source, bool_or(lang = 'en') AS a, bool_or(lang = 'es') AS b FROM documents GROUP BY 1"


@shown("bilingual", f"SELECT count(*) FILTER (WHERE a AND b) AS both, count(*) FILTER (WHERE a AND NOT b) AS first_only, count(*) FILTER (WHERE NOT a AND b) AS second_only, count(*) AS keys FROM ({_TWO})")
def _bilingual(x: Tables) -> DataFrame:
    return reports.bilingual(x.documents, "source", "lang", "en", "es")


@shown("claimed_siblings", "WITH u AS (SELECT conv_id, length(text) > 100 AS c, EXISTS (SELECT 1 FROM conversations a WHERE a.conv_id = t.conv_id AND a.role = 'system') AS s FROM conversations t WHERE role = 'user') SELECT count(*) FILTER (WHERE c AND s) AS claimed_there, count(*) FILTER (WHERE c AND NOT s) AS claimed_missing, count(*) FILTER (WHERE NOT c AND s) AS unclaimed_there, count(*) AS rows FROM u")
def _claimed(x: Tables) -> DataFrame:
    return reports.claimed_siblings(x.conversations, "conv_id", "role", "user", "system", F.length("text") > 100)


@shown("sibling_dates", "SELECT * FROM (SELECT conv_id, max(CASE WHEN role = 'user' THEN turn END) AS first_value, max(CASE WHEN role = 'assistant' THEN turn END) AS second_value FROM conversations GROUP BY 1) WHERE first_value IS DISTINCT FROM second_value")
def _siblings(x: Tables) -> DataFrame:
    return reports.sibling_dates(x.conversations, "conv_id", "role", "user", "assistant", "turn")


@shown("prefix_split", "SELECT count(*) FILTER (WHERE url LIKE 'http://%') AS plain, count(*) FILTER (WHERE url LIKE 'https://%') AS secure, count(*) FILTER (WHERE NOT coalesce(url LIKE 'http://%', false) AND NOT coalesce(url LIKE 'https://%', false)) AS other, count(*) AS rows FROM pages")
def _prefixes(x: Tables) -> DataFrame:
    return reports.prefix_split(x.pages, "url", {"plain": "http://", "secure": "https://"})


@shown("triage", "SELECT f AS field, count(*) AS n FROM part, (VALUES ('red'), ('green'), ('a_u')) v(f) WHERE p_name LIKE '%' || f || '%' GROUP BY f")
def _triage(x: Tables) -> DataFrame:
    return reports.triage(x.part, "p_name", ["red", "green", "a_u"])


@shown("similar_names", "SELECT x.k AS a, y.k AS b, CAST(levenshtein(x.k, y.k) AS BIGINT) AS edits FROM (SELECT DISTINCT upper(trim(p_name)) AS k FROM part) x JOIN (SELECT DISTINCT upper(trim(p_name)) AS k FROM part) y ON x.k < y.k WHERE levenshtein(x.k, y.k) <= 5")
def _similar(x: Tables) -> DataFrame:
    return reports.similar_names(x.part, "p_name", 5)


@shown("serving_list", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def _list(x: Tables) -> DataFrame:
    return reports.search(x.orders, [F.desc("o_orderdate"), F.asc("o_orderkey")], 50, status=F.col("o_orderstatus") == "F", price=F.col("o_totalprice") > 100000).select("o_orderkey", "o_orderdate")


@shown("windowed_counts", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _windowed(x: Tables) -> DataFrame:
    from ..streaming.stream import windowed_counts

    return windowed_counts(x.events.withColumn("at", F.col("ts").cast("timestamp")), "at", "1 day", "2 days", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# --- primitives that both engines spell alike

sql("p_cast_rename", "SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS price, CAST(o_orderdate AS DATE) AS day FROM orders")
sql("p_case_tristate", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'active' WHEN o_orderstatus = 'F' THEN 'closed' ELSE NULL END AS status, CAST(NULL AS INT) AS nothing FROM orders")
sql("p_null_safe", "SELECT o_orderkey, o_orderstatus IS NOT DISTINCT FROM 'O' AS same, (o_orderstatus = 'O') IS TRUE AS yes, (o_orderstatus = 'O') IS FALSE AS no FROM orders")
sql("p_like_regex", "SELECT p_partkey FROM part WHERE p_name LIKE 'a%' OR regexp_like(p_type, '^[A-M].*E')", "SELECT p_partkey FROM part WHERE p_name LIKE 'a%' OR regexp_matches(p_type, '^[A-M].*E')")
sql("p_not_in_list", "SELECT n_name FROM nation WHERE n_regionkey NOT IN (0, 2)")
sql("p_in_subquery", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
sql("p_in_case", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'labelled' ELSE 'plain' END AS kind FROM documents")
sql("p_in_filter", "SELECT count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels)) AS labelled, count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS plain FROM documents")
sql("p_not_in_subquery", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
sql("p_not_in_nulls", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT CASE WHEN quality = 0 THEN doc_id END FROM labels)")
sql("p_scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)")
sql("p_scalar_items", "SELECT (SELECT count(*) FROM orders) AS orders_n, (SELECT count(*) FROM lineitem) AS lines_n, CASE WHEN (SELECT count(*) FROM orders) < (SELECT count(*) FROM lineitem) THEN 'ok' ELSE 'odd' END AS verdict")
sql("p_relative_time", "SELECT event_id FROM events WHERE ts >= TIMESTAMP_NTZ '2024-01-22 00:00:00' - INTERVAL '7' DAY", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-22 00:00:00' - INTERVAL 7 DAY")
sql("p_values", "SELECT a, b FROM (VALUES (1, 'x'), (2, 'y')) AS v(a, b) WHERE a > 1")
sql("p_passthrough", "SELECT *, c_nationkey * 2 AS twice FROM customer")
sql("j_inner_residual", "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_acctbal < s_acctbal")
sql("j_left_key", "SELECT n_name, count(s_suppkey) AS suppliers FROM nation LEFT JOIN supplier ON upper(trim(CAST(n_nationkey AS STRING))) = upper(trim(CAST(s_nationkey AS STRING))) GROUP BY n_name")
sql("j_left_composite", "SELECT a.l_orderkey, a.l_linenumber, b.n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) a LEFT JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY l_orderkey, l_linenumber) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber")
sql("j_anti_null", "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL")
sql("j_explode", "SELECT p_partkey, w FROM part LATERAL VIEW explode(split(p_name, ' ')) x AS w", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part")
sql("j_theta_like", "SELECT v.w, p_partkey FROM (VALUES ('red'), ('green')) AS v(w) CROSS JOIN part WHERE p_name LIKE concat('%', v.w, '%')")
sql("j_latest_subquery", "SELECT c_custkey, last.o_orderkey FROM customer JOIN (SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) z WHERE rn = 1) last ON c_custkey = last.o_custkey")
sql("a_basic", "SELECT o_orderpriority, count(*) AS n, count(o_orderstatus) AS set_n, count(DISTINCT o_custkey) AS custs, min(o_totalprice) AS least, max(o_totalprice) AS most, round(sum(o_totalprice), 0) AS total, round(avg(o_totalprice), 3) AS mean FROM orders GROUP BY o_orderpriority")
sql("a_distinct_tuple", "SELECT count(DISTINCT struct(l_orderkey, l_linenumber)) AS pairs, count(*) - count(DISTINCT struct(l_orderkey, l_linenumber)) AS extra FROM lineitem", "SELECT count(DISTINCT (l_orderkey, l_linenumber)) AS pairs, count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS extra FROM lineitem")
sql("a_distinct_day", "SELECT count(DISTINCT CAST(ts AS DATE)) AS days FROM events")
sql("a_filter_pivot", "SELECT conv_id, max(turn) FILTER (WHERE role = 'user') AS last_user, max(turn) FILTER (WHERE role = 'assistant') AS last_answer, bool_or(role = 'system') AS has_system FROM conversations GROUP BY conv_id")
sql("a_having_ordinal", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 10")
sql("a_sorted_set", "SELECT n_regionkey, array_join(array_sort(collect_set(n_name)), ',') AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
sql("a_empty_set_null", "SELECT n_regionkey, nullif(array_join(array_sort(collect_set(CASE WHEN n_nationkey < 3 THEN n_name END)), ','), '') AS names FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) FILTER (WHERE n_nationkey < 3) AS names FROM nation GROUP BY n_regionkey")
sql("w_named_lag", "SELECT event_id, lag(event_type) OVER w AS prev_type, lag(value) OVER w AS prev_value FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)")
sql("o_nulls_last", "SELECT event_type, value FROM events ORDER BY value DESC NULLS LAST, event_id LIMIT 25")
sql("u_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
sql("u_metric_rows", "SELECT 'customers' AS metric, count(*) AS n FROM customer UNION ALL SELECT 'suppliers', count(*) FROM supplier")
sql("f_dates", "SELECT o_orderkey, CAST(dayofweek(o_orderdate) - 1 AS BIGINT) AS dow, date_format(o_orderdate, 'EEEE') AS day, CAST(unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) AS epoch FROM orders", "SELECT o_orderkey, CAST(extract(dow FROM o_orderdate) AS BIGINT) AS dow, dayname(o_orderdate) AS day, CAST(epoch(o_orderdate) AS BIGINT) AS epoch FROM orders")
sql("f_strings", "SELECT p_partkey, left(p_name, 5) AS head, CAST(length(p_name) AS BIGINT) AS n, concat('\"', p_name, '\"') AS quoted, md5(p_name) AS m, upper(trim(p_name)) AS k FROM part", "SELECT p_partkey, left(p_name, 5) AS head, CAST(length(p_name) AS BIGINT) AS n, '\"' || p_name || '\"' AS quoted, md5(p_name) AS m, upper(trim(p_name)) AS k FROM part")
sql("f_json_path", "SELECT event_id, get_json_object(props, '$.k') AS k FROM events", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
sql("f_safe_divide", "SELECT o_orderpriority, round(sum(o_totalprice) / nullif(count(*) FILTER (WHERE o_orderstatus = 'none'), 0), 2) AS share FROM orders GROUP BY o_orderpriority")
sql("f_series", "SELECT day FROM (SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-31')) AS day) s", "SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day")
sql("f_array_element", "SELECT vec_id, embedding[0] AS first, CAST(size(embedding) AS BIGINT) AS n FROM embeddings", "SELECT vec_id, embedding[1] AS first, CAST(len(embedding) AS BIGINT) AS n FROM embeddings")
