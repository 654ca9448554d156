"""What a feed looks like: its fields, identity, hash and invariants. A new feed is a new SourceSpec."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from ..functions import parse


@dataclass(frozen=True)
class Field:
    source: str
    name: str
    type: Callable = parse.text
    required: bool = False
    default: str | None = None  # SQL for a missing key


@dataclass(frozen=True)
class SourceSpec:
    name: str
    fields: tuple[Field, ...]
    identity: tuple[str, ...] = ("source_recall_id",)
    hash_exclude: tuple[str, ...] = ()
    sane_dates: tuple[str, ...] = ()
    siblings: bool = False
    cursor: str | None = None
    most_records: int = 5000
    positions: tuple[str, ...] = field(default=())  # of a headerless file, in order

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]


def _plain(names: str, prefix: str = "", upper: bool = False) -> list[Field]:
    return [Field((prefix + n).upper() if upper else prefix + n, n) for n in names.split()]


def _list(source: str, name: str, required: dict[str, str], optional: dict[str, str] | None = None) -> Field:
    return Field(source, name, parse.objects(required, optional or {}), default="array()")


_ISO = parse.day("yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]")
_US, _US_BLANK = parse.day("M/d/yyyy"), parse.day("M/d/yyyy", blank=True)
_DAY, _DAY_BLANK = parse.day("yyyy-MM-dd"), parse.day("yyyy-MM-dd", blank=True)
_COMPACT = parse.day("yyyyMMdd", blank=True)

_NAME = {"Name": "name"}

# The feeds' keys and the columns that they become.
CPSC = SourceSpec(
    "cpsc",
    (
        Field("RecallNumber", "source_recall_id", required=True), Field("RecallID", "recall_id", parse.integer(), True),
        Field("RecallDate", "recall_date", _ISO, True), Field("LastPublishDate", "last_publish_date", _ISO, True),
        Field("Title", "title"), Field("Description", "description"), Field("URL", "url"), Field("ConsumerContact", "consumer_contact"), Field("SoldAtLabel", "sold_at_label"),
        _list("Products", "products", _NAME, {"Description": "description", "Model": "model", "Type": "type", "CategoryID": "category_id", "NumberOfUnits": "number_of_units"}),
        *(_list(s, s.lower(), _NAME, {"CompanyID": "company_id"}) for s in ("Manufacturers", "Retailers", "Importers", "Distributors")),
        _list("ManufacturerCountries", "manufacturer_countries", {"Country": "country"}), _list("ProductUPCs", "product_upcs", {"UPC": "upc"}),
        _list("Hazards", "hazards", _NAME, {"HazardType": "hazard_type", "HazardTypeID": "hazard_type_id"}), _list("Remedies", "remedies", _NAME), _list("Injuries", "injuries", _NAME),
        _list("RemedyOptions", "remedy_options", {"Option": "option"}), _list("Inconjunctions", "in_conjunctions", {"URL": "url"}), _list("Images", "images", {"URL": "url"}, {"Caption": "caption"}),
    ),
    sane_dates=("recall_date",), cursor="last_publish_date",
)

FDA = SourceSpec(
    "fda",
    (
        Field("PRODUCTID", "source_recall_id", parse.text_id, True), Field("RECALLEVENTID", "recall_event_id", parse.loose_integer("long"), True), Field("RID", "rid", parse.loose_integer(), True),
        Field("CENTERCD", "center_cd", required=True), Field("PRODUCTTYPESHORT", "product_type_short", required=True), Field("FIRMLEGALNAM", "firm_legal_nam", required=True),
        Field("EVENTLMD", "event_lmd", _US, True), Field("FIRMFEINUM", "firm_fei_num", parse.loose_integer("long", blank=True)),
        Field("RECALLINITIATIONDT", "recall_initiation_dt", _US_BLANK), Field("CENTERCLASSIFICATIONDT", "center_classification_dt", _US_BLANK), Field("TERMINATIONDT", "termination_dt", _US_BLANK),
        Field("ENFORCEMENTREPORTDT", "enforcement_report_dt", _US_BLANK), Field("DETERMINATIONDT", "determination_dt", _US_BLANK),
        Field("RECALLNUM", "recall_num"), Field("PHASETXT", "phase_txt"), Field("CENTERCLASSIFICATIONTYPETXT", "center_classification_type_txt"), Field("INITIALFIRMNOTIFICATIONTXT", "initial_firm_notification_txt"),
        Field("DISTRIBUTIONAREASUMMARYTXT", "distribution_area_summary_txt"), Field("VOLUNTARYTYPETXT", "voluntary_type_txt"), Field("PRODUCTDESCRIPTIONTXT", "product_description_txt"),
        Field("PRODUCTSHORTREASONTXT", "product_short_reason_txt"), Field("PRODUCTDISTRIBUTEDQUANTITY", "product_distributed_quantity"),
    ),
    hash_exclude=("rid",), sane_dates=("recall_initiation_dt",), cursor="event_lmd",
)

_TF, _TF_BLANK = parse.flag("True", "False"), parse.flag("True", "False", blank=True)
USDA = SourceSpec(
    "usda",
    (
        Field("field_recall_number", "source_recall_id", required=True), Field("langcode", "langcode", parse.one_of("English", "Spanish"), True),
        Field("field_title", "title", required=True), Field("field_recall_date", "recall_date", _DAY, True), Field("field_recall_type", "recall_type", required=True), Field("field_recall_classification", "recall_classification", required=True),
        Field("field_archive_recall", "archive_recall", _TF, True), Field("field_has_spanish", "has_spanish", _TF, True), Field("field_active_notice", "active_notice", _TF_BLANK), Field("field_related_to_outbreak", "related_to_outbreak", _TF_BLANK),
        Field("field_last_modified_date", "last_modified_date", _DAY_BLANK), Field("field_closed_date", "closed_date", _DAY_BLANK),
        *_plain("closed_year year risk_level recall_reason processing states establishment labels qty_recovered summary product_items distro_list media_contact company_media_contact recall_url en_press_release press_release", "field_"),
    ),
    identity=("source_recall_id", "langcode"), hash_exclude=("en_press_release", "press_release"), sane_dates=("recall_date",), siblings=True, cursor="last_modified_date",
)

ESTABLISHMENTS = SourceSpec(
    "usda_establishments",
    (
        Field("establishment_id", "source_recall_id", required=True), *(Field(n, n, required=True) for n in ("establishment_name", "establishment_number", "address", "city", "state", "zip")),
        Field("LatestMPIActiveDate", "latest_mpi_active_date", _DAY, True), Field("status_regulated_est", "status_regulated_est", required=True),
        Field("activities", "activities", parse.strings, True), Field("dbas", "dbas", parse.strings, True),
        *_plain("phone duns_number fips_code size district circuit"), Field("county", "county", parse.text_or_false), Field("geolocation", "geolocation", parse.text_or_false), Field("grant_date", "grant_date", _DAY_BLANK),
    ),
    most_records=20_000,
)

_NHTSA = "record_id campno maketxt modeltxt yeartxt mfgcampno compname mfgname bgman endman rcltype potaff odate influenced_by mfgtxt rcdate datea rpno fmvss desc_defect conequence_defect corrective_action notes rcl_cmpt_id mfr_comp_name mfr_comp_desc mfr_comp_ptno do_not_drive park_outside"
_NHTSA_TYPES = {"bgman": _COMPACT, "endman": _COMPACT, "odate": _COMPACT, "rcdate": _COMPACT, "datea": _COMPACT, "fmvss": parse.short_text(3), "do_not_drive": parse.flag("Yes", "No", blank=True), "park_outside": parse.flag("Yes", "No", blank=True)}
_NHTSA_REQUIRED = set("record_id campno maketxt modeltxt yeartxt compname mfgname rcltype potaff mfgtxt desc_defect conequence_defect corrective_action".split())
NHTSA = SourceSpec(
    "nhtsa",
    tuple(Field(n, "source_recall_id" if n == "record_id" else n, _NHTSA_TYPES.get(n, parse.text), n in _NHTSA_REQUIRED) for n in _NHTSA.split()),
    sane_dates=("rcdate",), most_records=500_000, positions=tuple(_NHTSA.split()),
)

SOURCES = {s.name: s for s in (CPSC, FDA, USDA, ESTABLISHMENTS, NHTSA)}
