"""The harmonised models: a registry of named plans, built in order of what they need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, name_key, surrogate_key, trimmed, unescape
from ..operators.versions import latest_by


@dataclass(frozen=True)
class Model:
    needs: tuple[str, ...]
    plan: Callable[..., DataFrame]
    table: bool = False


MODELS: dict[str, Model] = {}


def model(*needs: str, table: bool = False) -> Callable:
    def register(plan: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        MODELS[plan.__name__] = Model(needs, plan, table)
        return plan

    return register


def build(sources: dict[str, DataFrame], wanted: list[str] | None = None, write: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every wanted model (all by default) and what it needs. ``write`` materialises the ones marked as tables; the rest stay lazy views."""
    need, todo = set(), list(wanted or MODELS)
    while todo:
        name = todo.pop()
        if name not in need and name in MODELS:
            need.add(name)
            todo += MODELS[name].needs
    built = dict(sources)
    for name in TopologicalSorter({n: MODELS[n].needs for n in need}).static_order():
        if name in need:
            m = MODELS[name]
            df = m.plan(*(built[x] for x in m.needs))
            built[name] = write(name, df) if write and m.table else df
            df.createOrReplaceTempView(name)
    return built


_LINEAGE = ("content_hash", "extraction_timestamp", "raw_landing_path")


def _latest(bronze: DataFrame, *keys: str) -> DataFrame:
    """The newest version of each identity; equal times by content hash."""
    return latest_by(bronze, keys, "extraction_timestamp", "content_hash")


def _nulled(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns})


@model("cpsc_bronze")
def stg_cpsc_recalls(bronze: DataFrame) -> DataFrame:
    return _latest(bronze, "source_recall_id").withColumnsRenamed({"recall_date": "announced_at", "last_publish_date": "published_at"})


@model("fda_bronze")
def stg_fda_recalls(bronze: DataFrame) -> DataFrame:
    return _nulled(
        _latest(bronze, "source_recall_id"), "recall_num", "phase_txt", "center_classification_type_txt", "initial_firm_notification_txt", "distribution_area_summary_txt",
        "voluntary_type_txt", "product_description_txt", "product_short_reason_txt", "product_distributed_quantity",
    )


@model("usda_bronze")
def stg_usda_recalls(bronze: DataFrame) -> DataFrame:
    """Versions are ranked for each number and language before the other language is left out."""
    rows = _latest(bronze, "source_recall_id", "langcode").where("langcode = 'English'").withColumnsRenamed({"recall_date": "announced_at", "last_modified_date": "published_at", "closed_date": "closed_at", "recall_url": "url", "recall_classification": "classification"})
    rows = _nulled(rows, "closed_year", "year", "risk_level", "recall_reason", "processing", "states", "establishment", "labels", "qty_recovered", "summary", "product_items", "distro_list", "media_contact", "company_media_contact", "url")
    return rows.withColumn("establishment", unescape(F.col("establishment")))


@model("usda_establishments_bronze")
def stg_usda_establishments(bronze: DataFrame) -> DataFrame:
    rows = _nulled(_latest(bronze, "source_recall_id"), "establishment_number", "address", "fips_code", "phone", "duns_number", "size", "district", "circuit")
    return rows.withColumns({c: F.nullif(F.col(c), F.lit("false")) for c in ("county", "geolocation")} | {c: trimmed(F.col(c)) for c in ("activities", "dbas")})


def _payload(*columns: str) -> Column:
    """A JSON object that keeps its null members."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _event(rows: DataFrame, source: str, key: str, **columns: Column) -> DataFrame:
    return rows.select(
        surrogate_key(F.lit(source), F.col(key)).alias("recall_event_id"), F.lit(source).alias("source"), F.col(key).cast("string").alias("source_recall_id"), F.lit("RECALL").alias("event_type"),
        *(c.alias(name) for name, c in columns.items()), *_LINEAGE,
    )


@model("stg_cpsc_recalls", "stg_fda_recalls", "stg_usda_recalls", table=True)
def recall_event(cpsc: DataFrame, fda: DataFrame, usda: DataFrame) -> DataFrame:
    """One row for each event. Of an FDA event's products the newest speaks for it; equal ones by product id and hash."""
    none = F.lit(None).cast("string")
    one = latest_by(fda, ["recall_event_id"], "extraction_timestamp", "source_recall_id", "content_hash")
    return (
        _event(cpsc, "CPSC", "source_recall_id", announced_at=F.col("announced_at"), published_at=F.col("published_at"), title=F.col("title"), description=F.col("description"), url=F.col("url"), classification=none, status=none, hazards=F.to_json("hazards"),
               source_payload_raw=_payload("recall_id", "consumer_contact", "sold_at_label", "manufacturer_countries", "product_upcs", "remedies", "remedy_options", "in_conjunctions", "images", "injuries"))
        .unionByName(_event(one, "FDA", "recall_event_id", announced_at=F.col("recall_initiation_dt"), published_at=F.col("event_lmd"),
                            title=F.concat(F.coalesce("recall_num", F.concat("center_cd", F.lit("-"), F.col("recall_event_id").cast("string"))), F.lit(" — "), "firm_legal_nam"),
                            description=F.col("distribution_area_summary_txt"), url=none, classification=F.col("center_classification_type_txt"), status=F.col("phase_txt"), hazards=none,
                            source_payload_raw=_payload("recall_num", "center_cd", "product_type_short", "firm_fei_num", "center_classification_dt", "termination_dt", "enforcement_report_dt", "determination_dt", "initial_firm_notification_txt", "voluntary_type_txt")))
        .unionByName(_event(usda, "USDA", "source_recall_id", announced_at=F.col("announced_at"), published_at=F.coalesce("published_at", "announced_at"), title=F.col("title"), description=F.col("summary"), url=F.col("url"), classification=F.col("classification"),
                            status=F.when(F.col("active_notice"), "active").when(~F.col("active_notice"), "closed"), hazards=none,
                            source_payload_raw=_payload("establishment", "recall_type", "risk_level", "recall_reason", "processing", "states", "related_to_outbreak", "archive_recall", "closed_at", "distro_list", "labels", "qty_recovered")))
    )


def _product(rows: DataFrame, source: str, event_key: str, key: Column, **columns: Column) -> DataFrame:
    names = ("product_name", "product_description", "model", "type", "category_id", "number_of_units", "upc", "source_specific_attrs")
    return rows.select(key.alias("recall_product_id"), surrogate_key(F.lit(source), F.col(event_key)).alias("recall_event_id"), F.lit(source).alias("source"), F.col("source_recall_id"), *(columns.get(n, F.lit(None).cast("string")).cast("string").alias(n) for n in names))


@model("stg_cpsc_recalls", "stg_fda_recalls", "stg_usda_recalls", table=True)
def recall_product(cpsc: DataFrame, fda: DataFrame, usda: DataFrame) -> DataFrame:
    """A product's place in its record, from 1, is part of its key."""
    each = cpsc.select("source_recall_id", "product_upcs", F.posexplode("products").alias("i", "p"))
    return (
        _product(each, "CPSC", "source_recall_id", surrogate_key(F.lit("CPSC"), F.col("source_recall_id"), F.col("i") + 1), product_name=F.col("p.name"), product_description=F.col("p.description"), model=F.col("p.model"), type=F.col("p.type"),
                 category_id=F.col("p.category_id"), number_of_units=F.col("p.number_of_units"), upc=F.get("product_upcs", 0).getField("upc"))
        .unionByName(_product(fda, "FDA", "recall_event_id", surrogate_key(F.lit("FDA"), F.col("source_recall_id")), product_name=F.col("product_description_txt"), product_description=F.col("product_short_reason_txt"), type=F.col("product_type_short"),
                              number_of_units=F.col("product_distributed_quantity"), source_specific_attrs=_payload("center_cd", "recall_num", "phase_txt", "center_classification_type_txt")))
        .unionByName(_product(usda, "USDA", "source_recall_id", surrogate_key(F.lit("USDA"), F.col("source_recall_id")), product_name=F.col("title"), product_description=F.col("product_items"), source_specific_attrs=_payload("qty_recovered", "labels", "states")))
    )


_ROLES = {"manufacturers": "manufacturer", "retailers": "retailer", "importers": "importer", "distributors": "distributor"}


def firms_by_role(cpsc: DataFrame) -> DataFrame:
    """(source_recall_id, role, raw_name, company_id): four arrays tagged and exploded in one scan."""

    def named(column: str, role: str) -> Column:
        rows = F.coalesce(column, F.array().cast(cpsc.schema[column].dataType))
        return F.transform(rows, lambda x: F.struct(F.lit(role).alias("role"), x["name"].alias("raw_name"), x["company_id"].alias("company_id")))

    tagged = F.flatten(F.array(*(named(c, role) for c, role in _ROLES.items())))
    return cpsc.select("source_recall_id", F.explode(tagged).alias("x")).select("source_recall_id", "x.*").where("raw_name IS NOT NULL AND trim(raw_name) <> ''")


def _named(column: str) -> str:
    return f"{column} IS NOT NULL AND trim({column}) <> ''"


@model("stg_cpsc_recalls", "stg_fda_recalls", "stg_usda_recalls", "stg_usda_establishments", table=True)
def firm(cpsc: DataFrame, fda: DataFrame, usda: DataFrame, establishments: DataFrame) -> DataFrame:
    """One row for each name as compared; the first observed form, in order of bytes, is the canonical one."""
    numbers = establishments.select(name_key(F.col("establishment_name")).alias("k"), F.col("establishment_number").alias("company_id"))
    own = usda.where(_named("establishment")).select(F.col("establishment").alias("raw_name"), name_key(F.col("establishment")).alias("k")).distinct()
    rows = (
        firms_by_role(cpsc).select("raw_name", "company_id")
        .unionByName(fda.where(_named("firm_legal_nam")).select(F.col("firm_legal_nam").alias("raw_name"), F.col("firm_fei_num").cast("string").alias("company_id")).distinct())
        .unionByName(own.join(numbers, "k", "left").select("raw_name", "company_id"))
    )
    return roll_up(rows, "raw_name", "company_id")


def roll_up(rows: DataFrame, name: str, company: str) -> DataFrame:
    """Names rolled up by their compared form. Pairs are made distinct first, so a name that very many rows share costs little."""
    pairs = rows.select(name_key(F.col(name)).alias("normalized_name"), F.col(name).alias("raw_name"), F.col(company).alias("company_id")).distinct()
    return pairs.groupBy("normalized_name").agg(F.min("raw_name").alias("canonical_name"), F.array_sort(F.collect_set("raw_name")).alias("observed_names"), F.array_sort(F.collect_set("company_id")).alias("ids")).select(
        F.md5("normalized_name").alias("firm_id"), "normalized_name", "canonical_name", "observed_names", F.when(F.size("ids") > 0, F.col("ids")).alias("observed_company_ids")
    )


@model("stg_cpsc_recalls", "stg_fda_recalls", "stg_usda_recalls", table=True)
def recall_event_firm(cpsc: DataFrame, fda: DataFrame, usda: DataFrame) -> DataFrame:
    def link(rows: DataFrame, source: str, key: str, name: str, role: Column) -> DataFrame:
        return rows.where(_named(name)).select(surrogate_key(F.lit(source), F.col(key)).alias("recall_event_id"), F.md5(name_key(F.col(name))).alias("firm_id"), role.alias("role")).distinct()

    return (
        link(firms_by_role(cpsc), "CPSC", "source_recall_id", "raw_name", F.col("role"))
        .unionByName(link(fda, "FDA", "recall_event_id", "firm_legal_nam", F.lit("manufacturer")))
        .unionByName(link(usda, "USDA", "source_recall_id", "establishment", F.lit("establishment")))
    )


@model("stg_usda_establishments", table=True)
def firm_establishment_attributes(establishments: DataFrame) -> DataFrame:
    columns = "establishment_number address city state zip county fips_code geolocation phone duns_number size district circuit status_regulated_est latest_mpi_active_date grant_date activities dbas".split()
    return establishments.where(_named("establishment_name")).select(F.col("source_recall_id").alias("establishment_id"), F.md5(name_key(F.col("establishment_name"))).alias("firm_id"), "establishment_name", *columns)


def by_month(events: DataFrame, at: str = "published_at", source: str = "source", key: str = "recall_event_id") -> DataFrame:
    out = events.where(F.col(at).isNotNull()).groupBy(F.date_trunc("month", at).cast("date").alias("month"), F.col(source).alias("source"))
    return out.agg(F.count("*").alias("event_count"), F.countDistinct(key).alias("distinct_events"))


@model("recall_event")
def recalls_by_month(events: DataFrame) -> DataFrame:
    return by_month(events)


@model("nhtsa_bronze")
def stg_nhtsa_recalls(bronze: DataFrame) -> DataFrame:
    """Designed further: placeholder years and dates become null, and dates out of range too."""
    sane = lambda c: F.when(~F.date_format(c, "yyyyMMdd").isin("19010101", "11111111", "19000101") & F.year(c).between(1950, 2100), F.col(c))
    return _latest(bronze, "source_recall_id").withColumns({c: sane(c) for c in ("bgman", "endman", "odate", "rcdate", "datea")} | {"model_year": F.nullif(F.col("yeartxt"), F.lit("9999")).try_cast("int")})


@model("stg_nhtsa_recalls")
def nhtsa_event(rows: DataFrame) -> DataFrame:
    """Designed further: an event for each campaign, with its number of lines."""
    return rows.groupBy("campno").agg(F.min("rcdate").alias("announced_at"), F.max("datea").alias("published_at"), F.count("*").alias("products"), F.max("mfgtxt").alias("manufacturer")).select(surrogate_key(F.lit("NHTSA"), F.col("campno")).alias("recall_event_id"), F.lit("NHTSA").alias("source"), F.col("campno").alias("source_recall_id"), "announced_at", "published_at", "products", "manufacturer")


@model("usda_bronze", "stg_usda_recalls")
def usda_with_spanish(bronze: DataFrame, english: DataFrame) -> DataFrame:
    """Designed further: the Spanish sibling's summary beside the English record."""
    spanish = _latest(bronze, "source_recall_id", "langcode").where("langcode = 'Spanish'").select("source_recall_id", F.col("summary").alias("summary_alt_lang"))
    return english.join(spanish, "source_recall_id", "left")
