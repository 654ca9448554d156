"""Queries over feeds: landed records made from the driver's tables, run through this library's own scans, validation,
invariants, ingestion and models, beside DuckDB SQL that says what must come out.

Each feed takes a whole table and spoils some of its records in known ways, by a remainder of the key. The SQL knows
only the remainders; it shares nothing with the operators.
"""

from __future__ import annotations

import dataclasses
import io
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..functions.canonical import content_hash
from ..operators import ingest, invariants, validate, versions
from ..session import work_dir
from ..sources import fetch, readers, spec
from ..sources.state import Store
from . import models, reports
from .catalog import Tables, shown

FIRST, SECOND, THIRD = "2026-05-01 00:00:00", "2026-05-02 00:00:00", "2026-05-03 00:00:00"


def _place(x: Tables, name: str) -> str:
    return f"{work_dir(x.spark)}/feeds/{name}-{uuid.uuid4().hex}"


def _dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly: a table may be one file, and reading is cheap beside what follows.

    The number of tasks is given, as Spark would judge by bytes and put a small table's records into one.
    """
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def _raw(df: DataFrame, *members: str) -> DataFrame:
    """Records as JSON text from SQL for each member; a null member is left out."""
    return _dealt(df).select(F.concat(F.lit("{"), F.concat_ws(",", *(F.expr(m) for m in members)), F.lit("}")).alias("raw"), F.lit("landed").alias("raw_landing_path"))


def _at(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _written(x: Tables, path: str, content: bytes) -> str:
    """A small file, written through Hadoop's file system."""
    jvm = x.spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(x.spark.sparkContext._jsc.hadoopConfiguration()).create(place)
    out.write(content)
    out.close()
    return path


# --- the feeds' records


def _cpsc(x: Tables, title: str = "o_orderpriority") -> DataFrame:
    return _raw(
        x.orders.withColumn("d", F.col("o_orderkey") % 10),
        """CASE WHEN d <> 2 THEN '"RecallNumber":"' || o_orderkey || '"' END""",
        """'"RecallID":' || CASE WHEN d = 0 THEN '"' || o_orderkey || '"' ELSE CAST(o_orderkey AS STRING) END""",
        """'"RecallDate":"' || CASE d WHEN 3 THEN date_format(o_orderdate, 'dd.MM.yyyy') WHEN 6 THEN date_format(o_orderdate, "yyyy-MM-dd'T'10:00:00") ELSE date_format(o_orderdate, 'yyyy-MM-dd') END || '"'""",
        """'"LastPublishDate":"' || date_format(o_orderdate, 'yyyy-MM-dd') || '"'""",
        """CASE WHEN d = 1 THEN '"Extra":1' END""",
        f"""'"Title":' || CASE d WHEN 4 THEN '12' WHEN 7 THEN 'null' ELSE '"' || {title} || '"' END""",
        """'"Products":[' || CASE d WHEN 5 THEN '{"Name":"A","Odd":"x"}' WHEN 8 THEN '{"Description":"A"}' ELSE '{"Name":"P' || o_custkey || '","Model":""},{"Name":"Q"}' END || ']'""",
        """'"Manufacturers":[{"Name":" Maker ' || (o_custkey % 50) || '","CompanyID":"' || (o_custkey % 50) || '"},{"Name":" "}]'""",
        """'"Retailers":[{"Name":"MAKER ' || (o_custkey % 70) || ' "}]'""",
    )


_CPSC_ERRORS = """CASE o_orderkey % 10 WHEN 0 THEN 'RecallID: not valid' WHEN 1 THEN 'Extra: unknown field' WHEN 2 THEN 'RecallNumber: missing' WHEN 3 THEN 'RecallDate: not valid'
WHEN 4 THEN 'Title: not valid' WHEN 5 THEN 'Products: not valid' WHEN 8 THEN 'Products: not valid' ELSE '' END"""
_CPSC_FINE = "o_orderkey % 10 IN (6, 7, 9)"


def _fda(x: Tables) -> DataFrame:
    return _raw(
        x.part.withColumn("d", F.col("p_partkey") % 10),
        """'"PRODUCTID":' || CASE WHEN d = 0 THEN CAST(p_partkey AS STRING) ELSE '"' || p_partkey || '"' END""",
        """'"RECALLEVENTID":' || CASE d WHEN 1 THEN p_size || '.0' WHEN 2 THEN '"' || p_size || '"' ELSE CAST(p_size AS STRING) END""",
        """'"RID":' || CASE d WHEN 3 THEN 'true' WHEN 4 THEN '""' ELSE CAST(p_partkey AS STRING) END""",
        """CASE WHEN d <> 9 THEN '"CENTERCD":"CFSAN"' END""",
        """'"PRODUCTTYPESHORT":"Food"'""",
        """'"FIRMLEGALNAM":"' || p_brand || '"'""",
        """'"EVENTLMD":"' || CASE WHEN d = 5 THEN '2024-03-09' ELSE '3/9/2024' END || '"'""",
        """'"FIRMFEINUM":' || CASE d WHEN 6 THEN '""' WHEN 7 THEN '"abc"' ELSE '"30' || p_size || '"' END""",
        """'"TERMINATIONDT":""'""",
        """'"RECALLINITIATIONDT":"01/15/2024"'""",
        """'"RECALLNUM":"' || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'F-' || p_partkey END || '"'""",
        """'"PRODUCTDESCRIPTIONTXT":"' || p_name || '"'""",
        """CASE WHEN d = 8 THEN '"UNKNOWN_EXTRA_FIELD":"x"' END""",
    )


_FDA_ERRORS = """CASE p_partkey % 10 WHEN 3 THEN 'RID: not valid' WHEN 4 THEN 'RID: not valid' WHEN 5 THEN 'EVENTLMD: not valid' WHEN 7 THEN 'FIRMFEINUM: not valid'
WHEN 8 THEN 'UNKNOWN_EXTRA_FIELD: unknown field' WHEN 9 THEN 'CENTERCD: missing' ELSE '' END"""
_FDA_FINE = "p_partkey % 10 IN (0, 1, 2, 6)"


def _usda(x: Tables) -> DataFrame:
    """Two customers make one number: the even one is English, the odd one its Spanish sibling."""
    return _raw(
        x.customer.withColumn("d", F.col("c_custkey") % 10),
        """'"field_recall_number":"' || CASE WHEN c_custkey % 100 = 10 THEN ' \\\\u00a0' ELSE CAST(c_custkey div 2 AS STRING) END || '"'""",
        """'"langcode":"' || CASE WHEN d = 4 THEN 'French' WHEN c_custkey % 2 = 0 THEN 'English' ELSE 'Spanish' END || '"'""",
        """'"field_title":"Recall ' || c_custkey || '"'""",
        """'"field_recall_date":"' || CASE WHEN d = 6 THEN '2999-01-01' ELSE '2020-05-15' END || '"'""",
        """'"field_recall_type":"Active Recall"'""",
        """'"field_recall_classification":"Class I"'""",
        """'"field_archive_recall":"' || CASE WHEN d = 8 THEN 'yes' WHEN c_nationkey % 2 = 0 THEN 'True' ELSE 'False' END || '"'""",
        """'"field_has_spanish":"True"'""",
        """'"field_active_notice":"' || CASE WHEN c_nationkey % 3 = 0 THEN '' WHEN c_nationkey % 3 = 1 THEN 'True' ELSE 'False' END || '"'""",
        """'"field_last_modified_date":"' || CASE WHEN c_nationkey % 2 = 0 THEN '' ELSE '2021-06-0' || (1 + c_nationkey % 7) END || '"'""",
        """'"field_establishment":"' || CASE WHEN c_nationkey < 5 THEN '' ELSE 'Farmer&#039;s &amp; ' || c_mktsegment END || '"'""",
        """'"field_summary":"' || CASE WHEN c_custkey % 2 = 0 THEN 'sum ' ELSE 'hola ' END || c_custkey || '"'""",
    )


_USDA_OUTCOME = """CASE WHEN c_custkey % 100 = 10 THEN 'blank id' WHEN c_custkey % 100 = 11 THEN 'no English sibling in the batch' ELSE CASE c_custkey % 10
WHEN 4 THEN 'langcode: not valid' WHEN 5 THEN 'no English sibling in the batch' WHEN 6 THEN 'recall_date out of range' WHEN 7 THEN 'no English sibling in the batch'
WHEN 8 THEN 'field_archive_recall: not valid' WHEN 9 THEN 'no English sibling in the batch' ELSE 'valid' END END"""
_USDA_FINE = "c_custkey % 10 IN (0, 2) AND c_custkey % 100 <> 10"


def _establishments(x: Tables) -> DataFrame:
    return _raw(
        x.supplier.withColumn("d", F.col("s_suppkey") % 10),
        """CASE WHEN d <> 4 THEN '"establishment_id":"' || s_suppkey || '"' END""",
        """'"establishment_name":"' || CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) || ' ' ELSE s_name END || '"'""",
        """'"establishment_number":"' || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'M' || s_suppkey END || '"'""",
        """'"address":"1 Road","city":"Kuna","state":"ID","zip":"83634"'""",
        """'"LatestMPIActiveDate":"' || CASE WHEN d = 5 THEN '4/1/2026' ELSE '2026-04-01' END || '"'""",
        """'"status_regulated_est":""'""",
        """'"activities":' || CASE d WHEN 3 THEN '[1]' ELSE '[" Meat ","Poultry"]' END""",
        """'"dbas":' || CASE d WHEN 7 THEN 'null' WHEN 8 THEN '[]' ELSE '[" D' || s_suppkey || '"]' END""",
        """'"geolocation":' || CASE d WHEN 0 THEN 'false' WHEN 1 THEN 'true' ELSE '"43.5,-116.4"' END""",
        """'"county":' || CASE WHEN d IN (2, 6) THEN 'false' ELSE '"Ada"' END""",
        """'"grant_date":"' || CASE WHEN d = 6 THEN '' ELSE '2001-02-03' END || '"'""",
    )


_EST_ERRORS = """CASE s_suppkey % 10 WHEN 1 THEN 'geolocation: not valid' WHEN 3 THEN 'activities: not valid' WHEN 4 THEN 'establishment_id: missing' WHEN 5 THEN 'LatestMPIActiveDate: not valid' WHEN 7 THEN 'dbas: null' ELSE '' END"""
_EST_FINE = "s_suppkey % 10 IN (0, 2, 6, 8, 9)"

_NHTSA_VALUES = {
    "record_id": "CAST(p_partkey AS STRING)", "campno": "'20V' || p_size", "maketxt": "p_brand", "modeltxt": "p_type", "yeartxt": "CASE WHEN p_partkey % 5 = 0 THEN '9999' ELSE '2012' END",
    "compname": "'C'", "mfgname": "'M'", "rcltype": "'V'", "potaff": "'1'", "mfgtxt": "p_brand", "desc_defect": "'<a href=\"x\">\"q\"</a>'", "conequence_defect": "'c'", "corrective_action": "'a'",
    "odate": "CASE d WHEN 6 THEN '00220101' WHEN 7 THEN '30190101' WHEN 2 THEN '19010101' ELSE '' END", "rcdate": "CASE WHEN d = 4 THEN '' ELSE '20' || lpad(p_size, 2, '0') || '0315' END", "fmvss": "CASE WHEN d = 1 THEN '1234' ELSE '108' END",
    "do_not_drive": "CASE d WHEN 2 THEN 'Yes' WHEN 3 THEN 'No' WHEN 5 THEN 'maybe' ELSE '' END",
}


def _nhtsa_lines(x: Tables) -> DataFrame:
    """Tab-separated lines without a header; every eighth has a field too many."""
    rows = _dealt(x.part.withColumn("d", F.col("p_partkey") % 8))
    fields = [F.expr(_NHTSA_VALUES.get(n, "''")) for n in spec.NHTSA.positions]
    return rows.select(F.concat_ws("\t", *fields, F.when(F.col("d") == 0, "x")).alias("value"), F.lit("landed").alias("raw_landing_path"))


def _batch(raw: DataFrame, of: spec.SourceSpec, at: str) -> DataFrame:
    """What ingestion would append: valid rows that keep the invariants, hashed."""
    good, _ = invariants.check(validate.valid(raw, of), of, THIRD)
    return ingest.hashed(good, of, at).drop("raw")


# --- validation and invariants


@shown(
    "feed_cpsc",
    f"""SELECT CASE WHEN o_orderkey % 10 <> 2 THEN CAST(o_orderkey AS VARCHAR) END AS id, {_CPSC_ERRORS} AS errors, 'validate_records' AS stage, CASE WHEN {_CPSC_FINE} THEN o_orderkey END AS recall_id,
CASE WHEN {_CPSC_FINE} THEN strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 10 = 6 THEN ' 10:00:00' ELSE ' 00:00:00' END END AS recall_date, CASE WHEN {_CPSC_FINE} AND o_orderkey % 10 <> 7 THEN o_orderpriority END AS title,
CASE WHEN {_CPSC_FINE} THEN 'P' || o_custkey || '|' || 'Q' END AS products, CASE WHEN {_CPSC_FINE} THEN '' END AS model, CASE WHEN {_CPSC_FINE} THEN 0 END AS hazards FROM orders""",
)
def _feed_cpsc(x: Tables) -> DataFrame:
    rows = validate.parsed(_cpsc(x), spec.CPSC)
    fine = lambda c: F.when(F.size("errors") == 0, c)
    return rows.select(
        F.col("source_recall_id").alias("id"), F.array_join("errors", "; ").alias("errors"), "stage", fine(F.col("recall_id").cast("long")).alias("recall_id"), fine(_at("recall_date")).alias("recall_date"),
        fine(F.col("title")).alias("title"), fine(F.array_join("products.name", "|")).alias("products"), fine(F.col("products")[0]["model"]).alias("model"), fine(F.size("hazards")).alias("hazards"),
    )


@shown(
    "feed_fda",
    f"""SELECT CAST(p_partkey AS VARCHAR) AS id, {_FDA_ERRORS} AS errors, CASE WHEN {_FDA_FINE} THEN CAST(p_size AS BIGINT) END AS event, CASE WHEN {_FDA_FINE} AND p_partkey % 10 <> 6 THEN CAST('30' || p_size AS BIGINT) END AS fei,
CASE WHEN {_FDA_FINE} THEN '2024-03-09 00:00:00' END AS changed, CASE WHEN {_FDA_FINE} THEN CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'F-' || p_partkey END END AS number, true AS not_ended FROM part""",
)
def _feed_fda(x: Tables) -> DataFrame:
    rows = validate.parsed(_fda(x), spec.FDA)
    fine = lambda c: F.when(F.size("errors") == 0, c)
    return rows.select(
        F.col("source_recall_id").alias("id"), F.array_join("errors", "; ").alias("errors"), fine(F.col("recall_event_id")).alias("event"), fine(F.col("firm_fei_num")).alias("fei"),
        fine(_at("event_lmd")).alias("changed"), fine(F.col("recall_num")).alias("number"), F.col("termination_dt").isNull().alias("not_ended"),
    )


@shown("feed_usda_outcome", f"SELECT c_custkey, {_USDA_OUTCOME} AS outcome FROM customer")
def _feed_usda(x: Tables) -> DataFrame:
    valid, malformed = validate.validate(_usda(x), spec.USDA)
    key = lambda json: F.regexp_extract(F.get_json_object(json, "$.field_title"), "([0-9]+)$", 1).cast("long").alias("c_custkey")
    checked = invariants.marked(valid, spec.USDA, FIRST).select(key("raw"), F.coalesce("_why", F.lit("valid")).alias("outcome"))
    return checked.unionByName(malformed.select(key("raw_record"), F.col("failure_reason").alias("outcome")))


@shown(
    "feed_usda_values",
    f"""SELECT CAST(c_custkey // 2 AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'English' ELSE 'Spanish' END AS langcode, c_nationkey % 2 = 0 AS archived, CASE c_nationkey % 3 WHEN 1 THEN true WHEN 2 THEN false END AS active,
CASE WHEN c_nationkey % 2 = 1 THEN '2021-06-0' || (1 + c_nationkey % 7) || ' 00:00:00' END AS changed, CASE WHEN c_nationkey < 5 THEN '' ELSE 'Farmer&#039;s &amp; ' || c_mktsegment END AS establishment FROM customer WHERE {_USDA_OUTCOME} = 'valid'""",
)
def _feed_usda_values(x: Tables) -> DataFrame:
    rows = _batch(_usda(x), spec.USDA, FIRST)
    return rows.select(F.col("source_recall_id").alias("id"), "langcode", F.col("archive_recall").alias("archived"), F.col("active_notice").alias("active"), _at("last_modified_date").alias("changed"), "establishment")


@shown("feed_usda_rejected", f"SELECT CASE WHEN {_USDA_OUTCOME} LIKE '%:%' THEN 'validate_records' ELSE 'invariants' END AS stage, {_USDA_OUTCOME} AS reason, count(*) AS n FROM customer WHERE {_USDA_OUTCOME} <> 'valid' GROUP BY 1, 2")
def _feed_rejected(x: Tables) -> DataFrame:
    valid, malformed = validate.validate(_usda(x), spec.USDA)
    rejected = malformed.unionByName(invariants.check(valid, spec.USDA, FIRST)[1])
    return rejected.groupBy(F.col("failure_stage").alias("stage"), F.col("failure_reason").alias("reason")).agg(F.count("*").alias("n"))


@shown("sibling_pairing", f"SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1 AND {_USDA_OUTCOME} = 'valid'")
def _pairing(x: Tables) -> DataFrame:
    good, _ = invariants.check(validate.valid(_usda(x), spec.USDA), spec.USDA, FIRST)
    return good.where("langcode = 'Spanish'").select(F.regexp_extract("title", "([0-9]+)$", 1).cast("long").alias("c_custkey"))


@shown(
    "feed_establishments",
    f"""SELECT CASE WHEN s_suppkey % 10 <> 4 THEN CAST(s_suppkey AS VARCHAR) END AS id, {_EST_ERRORS} AS errors, CASE WHEN {_EST_FINE} THEN CASE WHEN s_suppkey % 10 = 0 THEN 'false' ELSE '43.5,-116.4' END END AS geolocation,
CASE WHEN {_EST_FINE} THEN CASE WHEN s_suppkey % 10 IN (2, 6) THEN 'false' ELSE 'Ada' END END AS county, CASE WHEN {_EST_FINE} THEN ' Meat |Poultry' END AS activities, CASE WHEN {_EST_FINE} THEN CASE WHEN s_suppkey % 10 = 8 THEN '' ELSE ' D' || s_suppkey END END AS dbas,
CASE WHEN {_EST_FINE} AND s_suppkey % 10 <> 6 THEN '2001-02-03 00:00:00' END AS granted FROM supplier""",
)
def _feed_establishments(x: Tables) -> DataFrame:
    rows = validate.parsed(_establishments(x), spec.ESTABLISHMENTS)
    fine = lambda c: F.when(F.size("errors") == 0, c)
    return rows.select(
        F.col("source_recall_id").alias("id"), F.array_join("errors", "; ").alias("errors"), fine(F.col("geolocation")).alias("geolocation"), fine(F.col("county")).alias("county"),
        fine(F.array_join("activities", "|")).alias("activities"), fine(F.array_join("dbas", "|")).alias("dbas"), fine(_at("grant_date")).alias("granted"),
    )


# --- scans


@shown(
    "scan_positional",
    """SELECT CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS id, CASE p_partkey % 8 WHEN 0 THEN 'wrong number of fields' WHEN 1 THEN 'fmvss: not valid' WHEN 5 THEN 'do_not_drive: not valid' ELSE '' END AS errors,
CASE WHEN p_partkey % 8 = 0 THEN 'extract' ELSE 'validate_records' END AS stage, CASE p_partkey % 8 WHEN 6 THEN '0022-01-01' WHEN 7 THEN '3019-01-01' WHEN 2 THEN '1901-01-01' END AS opened,
CASE p_partkey % 8 WHEN 2 THEN true WHEN 3 THEN false END AS parked, CASE WHEN p_partkey % 8 <> 0 THEN '<a href="x">"q"</a>' END AS defect FROM part""",
)
def _positional(x: Tables) -> DataFrame:
    rows = validate.parsed(readers.positional(_nhtsa_lines(x), spec.NHTSA), spec.NHTSA)
    drift = F.col("stage") == "extract"
    return rows.select(
        F.col("source_recall_id").alias("id"), F.array_join("errors", "; ").alias("errors"), "stage", F.when(~drift, F.date_format("odate", "yyyy-MM-dd")).alias("opened"),
        F.when(~drift, F.col("do_not_drive")).alias("parked"), F.when(~drift, F.col("desc_defect")).alias("defect"),
    )


@shown("scan_since", "SELECT p_partkey % 8 = 0 AS drift, count(*) AS n FROM part WHERE p_partkey % 8 = 0 OR (p_partkey % 8 <> 4 AND p_size >= 25) GROUP BY 1")
def _since(x: Tables) -> DataFrame:
    return readers.positional(_nhtsa_lines(x), spec.NHTSA, since="20250101").groupBy("drift").agg(F.count("*").alias("n"))


@shown("scan_text_lines", "SELECT c_custkey, c_name AS value FROM customer")
def _text_lines(x: Tables) -> DataFrame:
    """Lines with CRLF and empty lines between, a tab within, and a vertical tab, which doesn't end a line."""
    path = _place(x, "lines")
    x.customer.select(F.concat("c_custkey", F.lit("\t\x0b"), "c_name", F.lit("\r\n\r")).alias("value")).write.text(path)
    parts = F.split("value", "\t\x0b")
    return readers.text_lines(x.spark, path).select(parts[0].cast("long").alias("c_custkey"), parts[1].alias("value"))


@shown("scan_json_array", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def _json_array(x: Tables) -> DataFrame:
    """Two files that hold one array each, one of them compressed, as one scan."""
    path = _place(x, "array")
    whole = x.nation.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("value"))
    whole.coalesce(1).write.text(f"{path}/a")
    whole.coalesce(1).write.option("compression", "gzip").text(f"{path}/b")
    rows = readers.concatenated(readers.json_array(x.spark, f"{path}/a"), readers.json_array(x.spark, f"{path}/b"))
    return rows.select(F.from_json("raw", "n_nationkey int, n_name string").alias("r")).select("r.*")


@shown("scan_json_lines", "SELECT s_suppkey, s_name FROM supplier")
def _json_lines(x: Tables) -> DataFrame:
    path = _place(x, "json-lines")
    x.supplier.select(F.concat(F.to_json(F.struct("s_suppkey", "s_name")), F.lit("\n ")).alias("value")).write.text(path)
    return readers.json_lines(x.spark, path).select(F.from_json("raw", "s_suppkey long, s_name string").alias("r")).select("r.*")


@shown("scan_envelope", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_regionkey FROM nation")
def _envelope(x: Tables) -> DataFrame:
    """A page for each region, and a last one without rows."""
    path = _place(x, "pages")
    rows = x.nation.groupBy("n_regionkey").agg(F.collect_list(F.struct(F.col("n_nationkey").alias("PRODUCTID"), "n_regionkey")).alias("RESULT"))
    page = F.to_json(F.struct(F.lit(400).alias("STATUSCODE"), F.lit("ok").alias("MESSAGE"), "RESULT"))
    none = x.spark.createDataFrame([('{"STATUSCODE":"412","MESSAGE":"none"}',)], "value string")
    rows.select(page.alias("value")).unionByName(none).repartition(8, "value").sortWithinPartitions("value").write.option("maxRecordsPerFile", 1).text(path)
    return readers.envelope(x.spark, path).select(F.from_json("raw", "PRODUCTID string, n_regionkey int").alias("r")).select(F.col("r.PRODUCTID").alias("id"), "r.n_regionkey")


@shown("scan_pages", "SELECT CAST(start AS INT) AS start, CAST(least(7, n - start + 1) AS INT) AS rows FROM (SELECT count(*) AS n FROM nation), (SELECT unnest(range(1, 1000, 7)) AS start) WHERE start <= n + CASE WHEN n % 7 = 0 THEN 1 ELSE 0 END")
def _pages(x: Tables) -> DataFrame:
    """The page loop with its stop rule, over a source that answers from a small table."""
    names = [r.n_name for r in x.nation.orderBy("n_nationkey").collect()]
    found, start = [], 1
    for page in fetch.pages(lambda first: names[first - 1 : first + 6], size=7):
        found.append((start, len(page)))
        start += 7
    return x.spark.createDataFrame(found, "start int, rows int")


@shown("scan_archives", "SELECT n_nationkey, n_name, part FROM nation, (VALUES ('post'), ('pre')) v(part)")
def _archives(x: Tables) -> DataFrame:
    """The one member that fits of each of two archives, concatenated."""
    path = _place(x, "archives")
    rows = x.nation.orderBy("n_nationkey").collect()  # a dimension, written to a fixture
    scans = []
    for name in ("pre", "post"):
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("readme.md", "not this one")
            z.writestr("data.txt", "\r\n".join(f"{r.n_nationkey}\t{r.n_name}" for r in rows) + "\r\n\r\n")
        lines = readers.zip_lines(x.spark, _written(x, f"{path}/{name}.zip", data.getvalue()))
        scans.append(lines.select(F.split("value", "\t").alias("f"), F.regexp_extract("raw_landing_path", "([a-z]+)[.]zip$", 1).alias("part")))
    return readers.concatenated(*scans).select(F.col("f")[0].cast("int").alias("n_nationkey"), F.col("f")[1].alias("n_name"), "part")


@shown("scan_unchanged", "SELECT 'same' AS pair, true AS unchanged, true AS inner_same UNION ALL SELECT 'wrapper', false, true UNION ALL SELECT 'other', false, false")
def _unchanged(x: Tables) -> DataFrame:
    """Whether a dump is the one seen before, by the file as it lies there and by what it holds."""
    path = _place(x, "dumps")
    rows = [r.r_name for r in x.region.orderBy("r_regionkey").collect()]

    def archive(name: str, lines: list[str], comment: bytes = b"") -> str:
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as z:
            z.comment = comment
            z.writestr(zipfile.ZipInfo("data.txt"), "\n".join(lines))
        return _written(x, f"{path}/{name}/data.zip", data.getvalue())

    first, found = archive("first", rows), []
    for pair, other in (("same", archive("same", rows)), ("wrapper", archive("wrapper", rows, b"new")), ("other", archive("other", rows[:-1]))):
        outer = readers.unchanged(readers.fingerprints(x.spark, first), readers.fingerprints(x.spark, other))
        inner = readers.unchanged(readers.inner_fingerprints(x.spark, first), readers.inner_fingerprints(x.spark, other))
        found.append((pair, outer, inner))
    return x.spark.createDataFrame(found, "pair string, unchanged boolean, inner_same boolean")


@shown("scan_conditional", "SELECT * FROM (VALUES (200, 'old', 'rows'), (304, 'old', 'none'), (304, 'new', 'StaleTagError'), (304, 'odd', 'StaleTagError'), (304, NULL, 'none'), (401, NULL, 'AuthError'), (500, NULL, 'TransientError')) v(status, modified, outcome)")
def _conditional(x: Tables) -> DataFrame:
    """What an answer to a conditional request means."""
    dates = {"old": "Sun, 06 Nov 1994 08:49:37 GMT", "new": "Mon, 07 Nov 1994 08:49:37 GMT", "odd": "yesterday", None: None}
    found = []
    for status, modified in ((200, "old"), (304, "old"), (304, "new"), (304, "odd"), (304, None), (401, None), (500, None)):
        answer = fetch.Answer(status, {"last-modified": dates[modified]} if modified else {}, b"[]")
        try:
            outcome = "rows" if fetch.changed(answer, dates["old"]) else "none"
        except RuntimeError as error:
            outcome = type(error).__name__
        found.append((status, modified, outcome))
    return x.spark.createDataFrame(found, "status int, modified string, outcome string")


@shown("scan_replay", "SELECT s_suppkey FROM supplier")
def _replay(x: Tables) -> DataFrame:
    """What was landed, compressed, read again."""
    store = Store(x.spark, _place(x, "store"))
    path = store.land("est", _establishments(x), "2026-05-01")
    rows = store.replay(path)
    return rows.select(F.regexp_extract("raw", '"establishment_name":"[^0-9]*([0-9]+)', 1).cast("long").alias("s_suppkey"))


@shown("scan_between", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def _between(x: Tables) -> DataFrame:
    return readers.between(x.orders, "o_orderdate", "1996-01-01", "1996-12-31").select("o_orderkey")


@shown("scan_matching", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red') AND contains(lower(p_type), 'eco')")
def _matching(x: Tables) -> DataFrame:
    return readers.matching(x.part, p_name="RED", p_type="eco").select("p_partkey")


@shown("http_dates", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS seen, true AS odd_is_null FROM orders")
def _http_dates(x: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    return x.orders.select("o_orderkey", F.date_format(t.http_date(text), "yyyy-MM-dd HH:mm:ss").alias("seen"), t.http_date(F.lit("yesterday")).isNull().alias("odd_is_null"))


# --- hashes


@shown("hash_excludes", "SELECT count(DISTINCT h) AS hashes, count(*) AS rows FROM (SELECT sha256('{\"o_orderpriority\":\"' || o_orderpriority || '\"}') AS h FROM orders)")
def _excludes(x: Tables) -> DataFrame:
    rows = x.orders.select("o_orderkey", "o_orderpriority")
    return rows.withColumn("h", content_hash(rows, exclude=["o_orderkey"])).agg(F.countDistinct("h").alias("hashes"), F.count("*").alias("rows"))


@shown("hash_floats", "SELECT o_orderkey, sha256('{\"o_orderkey\":' || o_orderkey || ',\"x\":' || CAST(o_totalprice * 1e6 AS VARCHAR) || ',\"y\":' || CAST(o_totalprice / 1e11 AS VARCHAR) || '}') AS h FROM orders")
def _floats(x: Tables) -> DataFrame:
    rows = x.orders.select("o_orderkey", (F.col("o_totalprice") * 1e6).alias("x"), (F.col("o_totalprice") / 1e11).alias("y"))
    return rows.select("o_orderkey", content_hash(rows).alias("h"))


@shown("hash_controls", "SELECT p_partkey, sha256('{\"x\":\"' || p_name || '\\u000b\\u001f\\\\u001F\"}') AS h FROM part")
def _controls(x: Tables) -> DataFrame:
    rows = x.part.select("p_partkey", F.concat("p_name", F.lit("\x0b\x1f\\u001F")).alias("x"))
    return rows.select("p_partkey", content_hash(rows, ["x"]).alias("h"))


# --- ingestion

_OPEN = {s.name: dataclasses.replace(s, most_records=1 << 30) for s in spec.SOURCES.values()}


def _customers(x: Tables, title: str, extra: str = "NULL") -> DataFrame:
    """A feed with few faults: one customer in forty has an id that isn't a number."""
    return _raw(
        x.customer,
        """'"RecallNumber":"' || c_custkey || '"'""",
        """'"RecallID":' || CASE WHEN c_custkey % 40 = 0 THEN '"x"' ELSE CAST(c_custkey AS STRING) END""",
        """'"RecallDate":"2024-01-15","LastPublishDate":"2024-02-' || lpad(1 + c_custkey % 28, 2, '0') || '"'""",
        f"""'"Title":"' || {title} || '"'""",
        extra,
    )


_TITLES = ("c_name", "CASE WHEN c_custkey % 7 = 1 THEN 'new' ELSE c_name END", "c_name")


def _three_runs(x: Tables) -> Store:
    """The feed, the feed with some titles changed, and the first one again."""
    store = Store(x.spark, _place(x, "store"))
    for at, title in zip((FIRST, SECOND, THIRD), _TITLES, strict=True):
        ingest.ingest(_customers(x, title), _OPEN["cpsc"], store, at, run_id=at)
    return store


_RUNS = """SELECT * FROM (VALUES ('2026-05-01 00:00:00', 1), ('2026-05-02 00:00:00', 2), ('2026-05-03 00:00:00', 3)) r(run_id, n), (SELECT count(*) AS fetched, count(*) FILTER (WHERE c_custkey % 40 <> 0) AS fine,
count(*) FILTER (WHERE c_custkey % 7 = 1 AND c_custkey % 40 <> 0) AS moved, count(*) FILTER (WHERE c_custkey % 40 = 0) AS bad FROM customer)"""


@shown("ingest_runs", f"SELECT run_id, 'success' AS status, fetched AS records_extracted, CASE WHEN n = 1 THEN fine ELSE moved END AS records_inserted, bad AS records_rejected, 'routine' AS change_type FROM ({_RUNS})")
def _ingest_runs(x: Tables) -> DataFrame:
    return _three_runs(x).runs().select("run_id", "status", "records_extracted", "records_inserted", "records_rejected", "change_type")


@shown(
    "ingest_bronze",
    """SELECT CAST(c_custkey AS VARCHAR) AS source_recall_id, c_name AS title, '2026-05-01 00:00:00' AS seen FROM customer WHERE c_custkey % 40 <> 0
UNION ALL SELECT CAST(c_custkey AS VARCHAR), coalesce(v.t, c_name), v.seen FROM customer, (VALUES ('new', '2026-05-02 00:00:00'), (NULL, '2026-05-03 00:00:00')) v(t, seen) WHERE c_custkey % 7 = 1 AND c_custkey % 40 <> 0""",
)
def _ingest_bronze(x: Tables) -> DataFrame:
    return _three_runs(x).read("bronze", "cpsc").select("source_recall_id", "title", _at("extraction_timestamp").alias("seen"))


@shown("ingest_rejected", f"SELECT run_id, CAST(c_custkey AS VARCHAR) AS source_recall_id, 'RecallID: not valid' AS failure_reason, 'validate_records' AS failure_stage, 'cpsc' AS source FROM customer, (SELECT run_id FROM ({_RUNS})) WHERE c_custkey % 40 = 0")
def _ingest_rejected(x: Tables) -> DataFrame:
    return _three_runs(x).rejected("cpsc", "fda").select("run_id", "source_recall_id", "failure_reason", "failure_stage", "source")


@shown("ingest_presence", f"SELECT run_id, 'cpsc' AS source, CAST(c_custkey AS VARCHAR) AS source_recall_id FROM customer, (SELECT run_id FROM ({_RUNS})) WHERE c_custkey % 40 <> 0")
def _ingest_presence(x: Tables) -> DataFrame:
    return _three_runs(x).read("presence", "cpsc").select("run_id", "source", "source_recall_id")


@shown(
    "ingest_books",
    """SELECT 'cursor' AS what, '2024-02-28' AS value UNION ALL SELECT 'after rescan', '2024-02-28' UNION ALL SELECT 'etag after touch', 'tag' UNION ALL SELECT 'touched', '2026-05-03 00:00:00' UNION ALL SELECT 'next start', '2024-02-28'
UNION ALL SELECT 'start without cursor', '2026-04-24' UNION ALL SELECT 'odd cursor', 'ValueError' UNION ALL SELECT 'too many records', 'TransientError' UNION ALL SELECT 'no identity', 'IdentityError' UNION ALL SELECT 'too many rejected', 'RejectionError'
UNION ALL SELECT 'rows after abort', CAST(count(*) AS VARCHAR) FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 40 <> 0 UNION ALL SELECT 'status after abort', 'aborted'""",
)
def _books(x: Tables) -> DataFrame:
    """Cursors, and runs that don't end well."""
    import datetime as dt

    store, of, found = Store(x.spark, _place(x, "store")), _OPEN["cpsc"], []

    def outcome(run: Callable) -> str:
        try:
            return str(run())
        except (RuntimeError, ValueError) as error:
            return type(error).__name__

    ingest.ingest(_customers(x, "c_name"), of, store, FIRST)
    found.append(("cursor", store.cursor("cpsc")))
    old = _customers(x, "'older'").withColumn("raw", F.replace("raw", F.lit("2024-02-"), F.lit("2020-02-")))
    ingest.ingest(old, of, store, SECOND, change_type="historical_seed", keep_cursor=True)
    found.append(("after rescan", store.cursor("cpsc")))
    store.put_cursor("cpsc", store.cursor("cpsc"), SECOND, etag="tag")
    store.touch("cpsc", THIRD)
    row = store.state("cursors").where("source = 'cpsc'").first()
    found += [("etag after touch", row.etag), ("touched", row.updated_at)]
    today = dt.date(2026, 5, 1)
    found += [("next start", str(ingest.cursor_start(store, "cpsc", today))), ("start without cursor", str(ingest.cursor_start(store, "fda", today, lookback_days=7)))]
    store.put_cursor("odd", "soon", FIRST)
    found.append(("odd cursor", outcome(lambda: ingest.cursor_start(store, "odd", today))))
    found.append(("too many records", outcome(lambda: ingest.ingest(_customers(x, "c_name"), dataclasses.replace(of, most_records=3), store, THIRD))))
    nameless = _customers(x, "c_name").withColumn("raw", F.regexp_replace("raw", '"RecallNumber":"[0-9]+"', '"RecallNumber":"1"'))
    found.append(("no identity", outcome(lambda: ingest.ingest(nameless, dataclasses.replace(of, identity=("source_recall_id", "description")), store, THIRD))))
    fresh = Store(x.spark, _place(x, "store"))
    faulty = _customers(x, "c_name", """CASE WHEN c_custkey % 2 = 1 THEN '"Odd":1' END""")
    found.append(("too many rejected", outcome(lambda: ingest.ingest(faulty, of, fresh, FIRST))))
    found += [("rows after abort", str(fresh.read("bronze", "cpsc").count())), ("status after abort", fresh.runs().first().status)]
    return x.spark.createDataFrame(found, "what string, value string")


@shown("ingest_reset", "SELECT 'guarded' AS step, 'RuntimeError' AS outcome UNION ALL SELECT 'other feed kept', CAST(count(*) FILTER (WHERE c_custkey % 40 <> 0) AS VARCHAR) FROM customer UNION ALL SELECT 'emptied', 'true' UNION ALL SELECT 'cursor', 'None'")
def _reset(x: Tables) -> DataFrame:
    """A feed is emptied for a fresh start, unless a run of it can't be had again; other feeds stay."""
    store, found = Store(x.spark, _place(x, "store")), []
    a, b = (dataclasses.replace(_OPEN["cpsc"], name=n) for n in ("a", "b"))
    for of, kind in ((a, "routine"), (b, "historical_seed")):
        ingest.ingest(_customers(x, "c_name"), of, store, FIRST, change_type=kind)
    try:
        store.reset("b", SECOND)
    except RuntimeError as error:
        found.append(("guarded", type(error).__name__))
    store.reset("a", SECOND)
    found += [("other feed kept", str(store.read("bronze", "b").count())), ("emptied", str(not store.exists("bronze", "a") and store.runs().where("source = 'a'").isEmpty()).lower()), ("cursor", str(store.cursor("a")))]
    return x.spark.createDataFrame(found, "step string, outcome string")


@shown("ingest_backfill", "SELECT 'old' AS run_id, CAST(c_custkey AS VARCHAR) AS source_recall_id FROM customer WHERE c_custkey % 40 <> 0")
def _backfill(x: Tables) -> DataFrame:
    """The manifest of a run from before there were any, from what it landed; a second try adds nothing."""
    store = Store(x.spark, _place(x, "store"))
    path = store.land("cpsc", _customers(x, "c_name"), "2026-04-01")
    for _ in range(2):
        ingest.backfill_presence(store, _OPEN["cpsc"], path, "old", FIRST)
    return store.read("presence", "cpsc").select("run_id", "source_recall_id")


@shown("ingest_batch_repeats", "SELECT CAST(c_custkey AS VARCHAR) AS source_recall_id, count(*) * 2 AS n FROM customer WHERE c_custkey % 40 <> 0 GROUP BY 1")
def _repeats(x: Tables) -> DataFrame:
    """Rows that repeat within a batch are all kept."""
    store, raw = Store(x.spark, _place(x, "store")), _customers(x, "c_name")
    ingest.ingest(raw.unionAll(raw), _OPEN["cpsc"], store, FIRST)
    return store.read("bronze", "cpsc").groupBy("source_recall_id").agg(F.count("*").alias("n"))


@shown("retention", "SELECT o_orderkey FROM (SELECT *, min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY date_trunc('month', o_orderdate)) AS f, date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS age FROM orders) WHERE age <= 90 OR (age <= 365 AND CAST(o_orderdate AS DATE) = f)")
def _retention(x: Tables) -> DataFrame:
    store = Store(x.spark, _place(x, "store"))
    store.append("bronze", "orders", x.orders)
    return store.prune("bronze", "orders", "o_orderdate", "2000-01-01").select("o_orderkey")


# --- models


_FEEDS = {
    "cpsc": lambda x: _batch(_cpsc(x, "'older'"), spec.CPSC, FIRST).unionByName(_batch(_cpsc(x), spec.CPSC, SECOND)),
    "fda": lambda x: _batch(_fda(x), spec.FDA, FIRST),
    "usda": lambda x: _batch(_usda(x), spec.USDA, FIRST),
    "usda_establishments": lambda x: _batch(_establishments(x), spec.ESTABLISHMENTS, FIRST),
    "nhtsa": lambda x: _batch(readers.positional(_nhtsa_lines(x), spec.NHTSA), spec.NHTSA, FIRST),
}


def _bronze(x: Tables, wanted: list[str]) -> dict[str, DataFrame]:
    """The bronze tables that the wanted models need, stored as ingestion does; two versions of cpsc, the later one counts.

    Feeds are stored at the same time: much of each is planning, and small ones leave cores idle.
    """
    store, found, todo = Store(x.spark, _place(x, "bronze")), set(), list(wanted)
    while todo:
        name = todo.pop()
        if name in models.MODELS:
            todo += models.MODELS[name].needs
        else:
            found.add(name)

    def stored(name: str) -> DataFrame:
        feed = name.removesuffix("_bronze")
        store.append("bronze", feed, _FEEDS[feed](x))
        return store.read("bronze", feed)

    names = sorted(found)
    with ThreadPoolExecutor(len(names)) as pool:
        tasks = [pool.submit(inheritable_thread_target(x.spark)(stored), n) for n in names]  # each with local properties of its own
        return {n: task.result() for n, task in zip(names, tasks, strict=True)}


def _models(x: Tables, *wanted: str) -> dict[str, DataFrame]:
    return models.build(_bronze(x, list(wanted)), list(wanted))


def _built(x: Tables, name: str) -> DataFrame:
    return _models(x, name)[name]


@shown("model_stg_cpsc", f"SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 10 <> 7 THEN o_orderpriority END AS title, strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS published FROM orders WHERE {_CPSC_FINE}")
def _stg_cpsc(x: Tables) -> DataFrame:
    return _built(x, "stg_cpsc_recalls").select(F.col("source_recall_id").alias("id"), "title", _at("published_at").alias("published"))


@shown("model_stg_fda", f"SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 2 = 1 THEN 'F-' || p_partkey END AS number, p_name AS product FROM part WHERE {_FDA_FINE}")
def _stg_fda(x: Tables) -> DataFrame:
    return _built(x, "stg_fda_recalls").select(F.col("source_recall_id").alias("id"), F.col("recall_num").alias("number"), F.col("product_description_txt").alias("product"))


@shown("model_stg_usda", f"SELECT CAST(c_custkey // 2 AS VARCHAR) AS id, 'Recall ' || c_custkey AS title, CASE WHEN c_nationkey >= 5 THEN 'Farmer''s & ' || c_mktsegment END AS establishment FROM customer WHERE {_USDA_FINE}")
def _stg_usda(x: Tables) -> DataFrame:
    return _built(x, "stg_usda_recalls").select(F.col("source_recall_id").alias("id"), "title", "establishment")


@shown("model_stg_establishments", f"SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 10 NOT IN (2, 6) THEN 'Ada' END AS county, CASE WHEN s_suppkey % 3 <> 0 THEN 'M' || s_suppkey END AS number, 'Meat|Poultry' AS activities, CASE WHEN s_suppkey % 10 <> 8 THEN 'D' || s_suppkey END AS dbas FROM supplier WHERE {_EST_FINE}")
def _stg_establishments(x: Tables) -> DataFrame:
    rows = _built(x, "stg_usda_establishments")
    return rows.select(F.col("source_recall_id").alias("id"), "county", F.col("establishment_number").alias("number"), F.array_join("activities", "|").alias("activities"), F.array_join("dbas", "|").alias("dbas"))


_FDA_EVENTS = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY p_size ORDER BY CAST(p_partkey AS VARCHAR) DESC) AS rn FROM part WHERE {_FDA_FINE}) WHERE rn = 1"
_EVENTS = f"""SELECT md5('CPSC|' || o_orderkey) AS recall_event_id, 'CPSC' AS source, CAST(o_orderkey AS VARCHAR) AS source_recall_id, CASE WHEN o_orderkey % 10 <> 7 THEN o_orderpriority END AS title, NULL AS classification, NULL AS status, o_orderdate AS published_at FROM orders WHERE {_CPSC_FINE}
UNION ALL SELECT md5('FDA|' || p_size), 'FDA', CAST(p_size AS VARCHAR), CASE WHEN p_partkey % 2 = 1 THEN 'F-' || p_partkey ELSE 'CFSAN-' || p_size END || ' — ' || p_brand, NULL, NULL, TIMESTAMP '2024-03-09' FROM ({_FDA_EVENTS})
UNION ALL SELECT md5('USDA|' || c_custkey // 2), 'USDA', CAST(c_custkey // 2 AS VARCHAR), 'Recall ' || c_custkey, 'Class I', CASE c_nationkey % 3 WHEN 1 THEN 'active' WHEN 2 THEN 'closed' END,
  CASE WHEN c_nationkey % 2 = 1 THEN CAST('2021-06-0' || (1 + c_nationkey % 7) AS TIMESTAMP) ELSE TIMESTAMP '2020-05-15' END FROM customer WHERE {_USDA_FINE}"""


@shown("model_recall_event", f"SELECT recall_event_id, source, source_recall_id, 'RECALL' AS event_type, title, classification, status, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS published FROM ({_EVENTS})")
def _recall_event(x: Tables) -> DataFrame:
    return _built(x, "recall_event").select("recall_event_id", "source", "source_recall_id", "event_type", "title", "classification", "status", _at("published_at").alias("published"))


@shown("model_recalls_by_month", f"SELECT CAST(date_trunc('month', published_at) AS DATE) AS month, source, count(*) AS event_count, count(DISTINCT recall_event_id) AS distinct_events FROM ({_EVENTS}) GROUP BY 1, 2")
def _recalls_by_month(x: Tables) -> DataFrame:
    return _built(x, "recalls_by_month")


_PRODUCTS = f"""SELECT md5('CPSC|' || o_orderkey || '|' || i) AS recall_product_id, md5('CPSC|' || o_orderkey) AS recall_event_id, 'CPSC' AS source, CASE i WHEN 1 THEN 'P' || o_custkey ELSE 'Q' END AS product_name, CASE i WHEN 1 THEN '' END AS model FROM orders, (VALUES (1), (2)) v(i) WHERE {_CPSC_FINE}
UNION ALL SELECT md5('FDA|' || p_partkey), md5('FDA|' || p_size), 'FDA', p_name, NULL FROM part WHERE {_FDA_FINE}
UNION ALL SELECT md5('USDA|' || c_custkey // 2), md5('USDA|' || c_custkey // 2), 'USDA', 'Recall ' || c_custkey, NULL FROM customer WHERE {_USDA_FINE}"""


@shown("model_recall_product", _PRODUCTS)
def _recall_product(x: Tables) -> DataFrame:
    return _built(x, "recall_product").select("recall_product_id", "recall_event_id", "source", "product_name", "model")


_LINKS = f"""SELECT md5('CPSC|' || o_orderkey) AS recall_event_id, 'MAKER ' || o_custkey % 50 AS k, 'manufacturer' AS role FROM orders WHERE {_CPSC_FINE} UNION SELECT md5('CPSC|' || o_orderkey), 'MAKER ' || o_custkey % 70, 'retailer' FROM orders WHERE {_CPSC_FINE}
UNION SELECT md5('FDA|' || p_size), upper(p_brand), 'manufacturer' FROM part WHERE {_FDA_FINE}
UNION SELECT md5('USDA|' || c_custkey // 2), upper('Farmer''s & ' || c_mktsegment), 'establishment' FROM customer WHERE {_USDA_FINE} AND c_nationkey >= 5"""


@shown("model_event_firms", f"SELECT recall_event_id, md5(k) AS firm_id, role FROM ({_LINKS})")
def _event_firms(x: Tables) -> DataFrame:
    return _built(x, "recall_event_firm")


_FIRMS = f"""SELECT ' Maker ' || o_custkey % 50 AS name, CAST(o_custkey % 50 AS VARCHAR) AS company FROM orders WHERE {_CPSC_FINE} UNION SELECT 'MAKER ' || o_custkey % 70 || ' ', NULL FROM orders WHERE {_CPSC_FINE}
UNION SELECT p_brand, CASE WHEN p_partkey % 10 <> 6 THEN '30' || p_size END FROM part WHERE {_FDA_FINE} UNION SELECT 'Farmer''s & ' || c_mktsegment, NULL FROM customer WHERE {_USDA_FINE} AND c_nationkey >= 5"""


@shown("model_firm", f"SELECT md5(upper(trim(name))) AS firm_id, min(name) AS canonical_name, count(DISTINCT name) AS names, string_agg(DISTINCT company, ',' ORDER BY company) AS companies FROM ({_FIRMS}) GROUP BY upper(trim(name))")
def _firm(x: Tables) -> DataFrame:
    return _built(x, "firm").select("firm_id", "canonical_name", F.size("observed_names").cast("long").alias("names"), F.array_join("observed_company_ids", ",").alias("companies"))


@shown("model_establishment_attributes", f"SELECT CAST(s_suppkey AS VARCHAR) AS establishment_id, md5(upper(trim(s_name))) AS firm_id, 'Kuna' AS city, CASE WHEN s_suppkey % 3 <> 0 THEN 'M' || s_suppkey END AS number FROM supplier WHERE {_EST_FINE}")
def _attributes(x: Tables) -> DataFrame:
    return _built(x, "firm_establishment_attributes").select("establishment_id", "firm_id", "city", F.col("establishment_number").alias("number"))


@shown("model_nhtsa_event", "SELECT md5('NHTSA|20V' || p_size) AS recall_event_id, '20V' || p_size AS campaign, count(*) AS products, max(p_brand) AS manufacturer, max(CASE WHEN p_partkey % 8 <> 4 THEN '20' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-03-15' END) AS announced FROM part WHERE p_partkey % 8 IN (2, 3, 4, 6, 7) AND (p_partkey % 8 = 4 OR p_size <= 26) GROUP BY p_size")
def _nhtsa_event(x: Tables) -> DataFrame:
    rows = _built(x, "nhtsa_event")
    return rows.select("recall_event_id", F.col("source_recall_id").alias("campaign"), "products", "manufacturer", F.date_format("announced_at", "yyyy-MM-dd").alias("announced"))


@shown("model_stg_nhtsa", "SELECT CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_partkey % 5 <> 0 THEN 2012 END AS model_year, CAST(NULL AS VARCHAR) AS opened FROM part WHERE p_partkey % 8 IN (2, 3, 4, 6, 7) AND (p_partkey % 8 = 4 OR p_size <= 26)")
def _stg_nhtsa(x: Tables) -> DataFrame:
    return _built(x, "stg_nhtsa_recalls").select(F.col("source_recall_id").alias("id"), "model_year", F.date_format("odate", "yyyy-MM-dd").alias("opened"))


@shown("model_spanish_summary", f"SELECT CAST(c_custkey // 2 AS VARCHAR) AS id, 'sum ' || c_custkey AS summary, CASE WHEN EXISTS (SELECT 1 FROM customer s WHERE s.c_custkey = customer.c_custkey + 1) THEN 'hola ' || (c_custkey + 1) END AS summary_alt_lang FROM customer WHERE {_USDA_FINE}")
def _spanish(x: Tables) -> DataFrame:
    return _built(x, "usda_with_spanish").select(F.col("source_recall_id").alias("id"), "summary", "summary_alt_lang")


@shown("models_in_order", "SELECT 'firm' AS model UNION ALL SELECT 'stg_cpsc_recalls' UNION ALL SELECT 'stg_fda_recalls' UNION ALL SELECT 'stg_usda_recalls' UNION ALL SELECT 'stg_usda_establishments'")
def _in_order(x: Tables) -> DataFrame:
    """What a model needs is built first; tables are written, the rest are views."""
    bronze, store = _bronze(x, ["firm"]), Store(x.spark, _place(x, "store"))

    def write(name: str, df: DataFrame) -> DataFrame:
        store.append("models", name, df)
        return store.read("models", name)

    built = models.build(bronze, ["firm"], write)
    assert store.exists("models", "firm") and not store.exists("models", "stg_fda_recalls")
    return x.spark.createDataFrame([(n,) for n in built if n not in bronze], "model string")


# --- serving and parameters


@shown("serving_detail", f"""SELECT e.recall_event_id, title, (SELECT string_agg(product_name, '|' ORDER BY product_name, recall_product_id) FROM ({_PRODUCTS}) p WHERE p.recall_event_id = e.recall_event_id) AS products,
(SELECT string_agg(DISTINCT role, '|' ORDER BY role) FROM ({_LINKS}) l WHERE l.recall_event_id = e.recall_event_id) AS roles FROM ({_EVENTS}) e WHERE source = 'FDA' AND source_recall_id = '11'""")
def _detail(x: Tables) -> DataFrame:
    built = _models(x, "recall_event", "recall_product", "recall_event_firm", "firm")
    one = reports.detail(built["recall_event"], built["recall_product"], built["recall_event_firm"], built["firm"], "FDA", "11")
    return one.select("recall_event_id", "title", F.array_join("products.product_name", "|").alias("products"), F.array_join(F.array_distinct("firms.role"), "|").alias("roles"))


@shown("serving_product_search", f"SELECT recall_product_id FROM ({_PRODUCTS}) WHERE contains(lower(product_name), 'red')")
def _product_search(x: Tables) -> DataFrame:
    return reports.product_search(_built(x, "recall_product"), "RED").select("recall_product_id")


@shown("serving_firm_events", f"SELECT md5(k) AS firm_id, source, count(*) AS events, strftime(min(published_at), '%Y-%m-%d') AS first, strftime(max(published_at), '%Y-%m-%d') AS last FROM (SELECT DISTINCT recall_event_id, k FROM ({_LINKS})) JOIN ({_EVENTS}) USING (recall_event_id) GROUP BY k, source")
def _firm_events(x: Tables) -> DataFrame:
    built = _models(x, "recall_event", "recall_event_firm")
    rows = reports.firm_events(built["recall_event_firm"], built["recall_event"])
    return rows.select("firm_id", "source", "events", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first", "last")))


@shown(
    "resolved_firms",
    """WITH k AS (SELECT DISTINCT upper(trim(p_name)) AS k, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS number FROM part), n AS (SELECT * FROM k WHERE number IS NOT NULL),
a AS (SELECT n.k, min(g.anchor) AS anchor FROM n JOIN (SELECT number, min(k) AS anchor FROM n GROUP BY number) g USING (number) GROUP BY n.k),
l AS (SELECT DISTINCT k FROM k WHERE k NOT IN (SELECT k FROM a)),
c AS (SELECT l.k, a.anchor, row_number() OVER (PARTITION BY l.k ORDER BY levenshtein(l.k, a.k), a.k) AS rn FROM l JOIN a ON levenshtein(l.k, a.k) <= 2)
SELECT k AS normalized_name, anchor FROM a UNION ALL SELECT l.k, coalesce(c.anchor, l.k) FROM l LEFT JOIN c ON l.k = c.k AND rn = 1""",
)
def _resolved(x: Tables) -> DataFrame:
    rows = x.part.select("p_name", F.when(F.col("p_partkey") % 3 == 0, F.col("p_size")).alias("number"))
    return reports.resolved_firms(rows, "p_name", "number")


@shown("report_by_parameters", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000 GROUP BY 1")
def _parameters(x: Tables) -> DataFrame:
    """A report as SQL with named parameters, over tables that are given and not registered."""
    text = "SELECT o_orderpriority, count(*) AS n FROM {runs} WHERE o_orderstatus = :status AND o_totalprice > :least GROUP BY 1"
    return reports.parameterised(x.spark, text, {"runs": x.orders}, status="F", least=200000)


@shown("sample_rows", "SELECT least(100, count(*)) AS n FROM orders")
def _sample(x: Tables) -> DataFrame:
    return x.orders.limit(100).agg(F.count("*").alias("n"))


@shown(
    "verify_first_extraction",
    """SELECT 'rows' AS what, CAST(count(*) AS DOUBLE) AS value FROM part UNION ALL SELECT 'identities', count(DISTINCT p_partkey) FROM part UNION ALL SELECT 'versions over one', 0 UNION ALL SELECT 'null p_brand', count(*) FILTER (WHERE p_brand IS NULL) FROM part
UNION ALL SELECT 'empty p_name', count(*) FILTER (WHERE p_name = '') FROM part UNION ALL SELECT 'p_type: ' || p_type, count(*) FROM part GROUP BY p_type""",
)
def _verify(x: Tables) -> DataFrame:
    return reports.verification(x.part, ["p_partkey"], "p_partkey", nulls=["p_brand"], empties=["p_name"], spread="p_type")
