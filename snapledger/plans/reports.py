"""Reports over runs, quarantine and bronze: each a plan with parameters, none tied to one feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name_key, percent
from ..operators import profile, versions


def _since(at: str, as_of: str, days: int) -> Column:
    return F.col(at) >= F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS")


def change_signals(runs: DataFrame, key: str, at: str, tag: str, body: str) -> DataFrame:
    """For each run whether tag and body changed since the run before, and what that says of the tag as a signal."""
    out = versions.transitions(runs, [key], [at], [tag, body])
    t, b = F.col(f"{tag}_change"), F.col(f"{body}_change")
    verdict = F.when(t == "first_run", "first_run").when((t == "unchanged") & (b == "unchanged"), "agree_same").when((t == "changed") & (b == "changed"), "agree_changed").when(t == "changed", "tag_only").otherwise("body_only")
    return out.withColumn("verdict", verdict)


def signal_summary(runs: DataFrame, key: str, at: str, tag: str, body: str, least: int = 7) -> DataFrame:
    """One row: transitions by verdict, and go or no_go; too few transitions are insufficient."""
    seen = change_signals(runs, key, at, tag, body).where("verdict <> 'first_run'")
    counts = seen.agg(F.count("*").alias("transitions"), *(F.count_if(F.col("verdict") == v).alias(v) for v in ("agree_same", "agree_changed", "tag_only", "body_only")))
    return counts.withColumn("decision", F.when(F.col("transitions") < least, "insufficient").when((F.col("body_only") == 0) & (F.col("tag_only") <= F.col("agree_changed")), "go").otherwise("no_go"))


def tag_formats(runs: DataFrame, tag: str) -> DataFrame:
    """How tags look: weak, quoted hex or other, with their lengths."""
    form = F.when(F.col(tag).isNull(), "none").when(F.col(tag).like("W/%"), "weak").when(F.col(tag).rlike('^"?[0-9a-f]+"?$'), "hex").otherwise("other")
    return runs.groupBy(form.alias("form")).agg(F.count("*").alias("n"), F.min(F.length(tag)).cast("long").alias("shortest"), F.max(F.length(tag)).cast("long").alias("longest"))


def header_prints(runs: DataFrame, headers: str, names: Sequence[str], n: int = 10) -> DataFrame:
    """The most frequent combinations of response headers (a JSON object or a map)."""
    get = (lambda k: F.col(headers)[k]) if runs.schema[headers].dataType.simpleString().startswith("map") else (lambda k: F.get_json_object(headers, f"$.{k}"))
    return runs.groupBy(*(get(k).alias(k.replace("-", "_")) for k in names)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *(F.asc_nulls_last(k.replace("-", "_")) for k in names)).limit(n)


def within_day(runs: DataFrame, key: str, at: str, tag: str) -> DataFrame:
    """Of each key and day the runs and the different tags."""
    return runs.groupBy(key, F.to_date(at).alias("day")).agg(F.count("*").alias("runs"), F.countDistinct(tag).alias("tags"), F.min(at).alias("first"), F.max(at).alias("last"))


def totals_with_zeros(sources: DataFrame, source: str, rejected: DataFrame, at: str, as_of: str, days: int = 7) -> DataFrame:
    """Of every source, also those without a row: all rejections, recent ones and the latest. Counted before the join."""
    counts = rejected.groupBy(source).agg(F.count("*").alias("total"), F.count_if(_since(at, as_of, days)).alias("recent"), F.max(at).alias("latest"))
    return sources.select(source).distinct().join(counts, source, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("total", "recent")})


def stages(rejected: DataFrame, by: Sequence[str], at: str, as_of: str, days: int = 7) -> DataFrame:
    return rejected.where(_since(at, as_of, days)).groupBy(*by).agg(F.count("*").alias("n"), F.min(at).alias("first"), F.max(at).alias("last"))


def latest_rejections(rejected: DataFrame, source: str, at: str, tie: str, n: int = 5) -> DataFrame:
    return versions.top_by(rejected, [source], n, F.desc(at), F.asc(tie))


def latest_runs(runs: DataFrame, source: str, started: str, finished: str, error: str | None = None, tie: str = "run_id") -> DataFrame:
    """The last run of each source with its seconds, and the start of its error."""
    out = versions.latest_by(runs, [source], started, tie).withColumn("seconds", F.unix_timestamp(finished) - F.unix_timestamp(started))
    return out.withColumn("error_excerpt", F.left(F.col(error), F.lit(120))) if error else out


def recent_runs(runs: DataFrame, started: str, tie: str, n: int = 20) -> DataFrame:
    return runs.orderBy(F.desc(started), F.asc(tie)).limit(n)


def daily_volume(runs: DataFrame, source: str, at: str, amount: str, failed: Column, as_of: str, days: int = 14) -> DataFrame:
    return runs.where(_since(at, as_of, days)).groupBy(source, F.to_date(at).alias("day")).agg(F.count("*").alias("runs"), F.count_if(failed).alias("failed"), F.round(F.sum(amount), 2).alias("amount"))


def response_capture(runs: DataFrame, headers: str, tag: str) -> DataFrame:
    """Of each run how many headers were kept and the start of the tag."""
    n = F.size(F.map_keys(headers)) if runs.schema[headers].dataType.simpleString().startswith("map") else F.size(F.json_object_keys(headers))
    return runs.withColumns({"n_headers": n.cast("long"), "tag_start": F.left(F.col(tag), F.lit(8)), "tag_length": F.length(tag).cast("long")})


def stuck_cursors(cursors: DataFrame, runs: DataFrame, source: str, cursor: str, started: str, inserted: str, as_of: str, hours: int = 48, tie: str = "run_id") -> DataFrame:
    """Of each source whether its cursor moves: never_ran, stale, idle (last run added nothing) or healthy."""
    last = versions.latest_by(runs, [source], started, tie).select(source, F.col(started).alias("last_run"), F.col(inserted).alias("last_inserted"))
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp("last_run")) / 3600.0
    verdict = F.when(F.col("last_run").isNull(), "never_ran").when(F.col("age_hours") > hours, "stale").when(F.col("last_inserted") == 0, "idle").otherwise("healthy")
    return cursors.select(source, cursor).join(last, source, "left").withColumn("age_hours", F.round(age, 2)).withColumn("verdict", verdict)


def population(df: DataFrame, columns: Sequence[str], where: Column | None = None) -> DataFrame:
    """How many rows have each column set, of all and of those that ``where`` picks."""
    picked = where if where is not None else F.lit(True)
    return df.agg(F.count("*").alias("rows"), *(F.count(c).alias(f"{c}_set") for c in columns), *(F.count_if(F.col(c).isNotNull() & picked).alias(f"{c}_picked") for c in columns))


def sanity(df: DataFrame, key: str, at: str, rejected: DataFrame) -> DataFrame:
    """One row of scalars from two tables, each aggregated to one row of its own."""
    one = df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("keys"), F.max(at).alias("latest"))
    return one.withColumn("rejected", rejected.agg(F.count("*")).scalar())


def quarantine_samples(rejected: DataFrame, stage: str, reason: str) -> DataFrame:
    return rejected.groupBy(stage).agg(F.count("*").alias("n"), F.min(reason).alias("sample"))


def edits(df: DataFrame, keys: Sequence[str], hash_col: str) -> DataFrame:
    """One row: versions, identities, and versions that are edits."""
    per = df.groupBy(*keys).agg(F.countDistinct(hash_col).alias("v"))
    return per.agg(F.sum("v").alias("versions"), F.count("*").alias("identities"), F.count_if(F.col("v") > 1).alias("edited")).withColumn("extra", F.col("versions") - F.col("identities"))


def group_sizes(df: DataFrame, group: str, member: str, least: int, n: int) -> DataFrame:
    """Groups with at least ``least`` different members, the largest first."""
    return df.groupBy(group).agg(F.countDistinct(member).alias("members")).where(F.col("members") >= least).orderBy(F.desc("members"), group).limit(n)


def null_rates_by(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("rows"), *(percent(F.count_if(F.col(c).isNull()), F.count("*")).alias(f"{c}_null_pct") for c in columns))


def bilingual(df: DataFrame, key: str, lang: str, first: str, second: str) -> DataFrame:
    """One row: keys with both languages, with one only."""
    per = df.groupBy(key).agg(F.bool_or(F.coalesce(F.col(lang) == first, F.lit(False))).alias("a"), F.bool_or(F.coalesce(F.col(lang) == second, F.lit(False))).alias("b"))
    return per.agg(F.count_if(F.col("a") & F.col("b")).alias("both"), F.count_if(F.col("a") & ~F.col("b")).alias("first_only"), F.count_if(~F.col("a") & F.col("b")).alias("second_only"), F.count("*").alias("keys"))


def claimed_siblings(df: DataFrame, key: str, lang: str, first: str, second: str, claim: Column) -> DataFrame:
    """Of the rows in the first language: claims against siblings that exist. The siblings' keys are made distinct and joined once."""
    there = df.where(F.col(lang) == second).select(key).distinct().withColumn("_there", F.lit(True))
    rows = df.where(F.col(lang) == first).join(there, key, "left").select(claim.alias("c"), F.col("_there").isNotNull().alias("t"))
    return rows.agg(F.count_if(F.col("c") & F.col("t")).alias("claimed_there"), F.count_if(F.col("c") & ~F.col("t")).alias("claimed_missing"), F.count_if(~F.col("c") & F.col("t")).alias("unclaimed_there"), F.count("*").alias("rows"))


def sibling_dates(df: DataFrame, key: str, lang: str, first: str, second: str, value: str) -> DataFrame:
    """Keys whose two languages differ in ``value``; a language that is missing is null."""
    per = df.groupBy(key).agg(F.max(F.when(F.col(lang) == first, F.col(value))).alias("first_value"), F.max(F.when(F.col(lang) == second, F.col(value))).alias("second_value"))
    return per.where(~F.col("first_value").eqNullSafe(F.col("second_value")))


def prefix_split(df: DataFrame, column: str, prefixes: dict[str, str]) -> DataFrame:
    """One row: how many values begin with each prefix, and with none."""
    none = F.lit(True)
    for p in prefixes.values():
        none = none & ~F.coalesce(F.col(column).like(p + "%"), F.lit(False))
    return df.agg(*(F.count_if(F.col(column).like(p + "%")).alias(name) for name, p in prefixes.items()), F.count_if(none).alias("other"), F.count("*").alias("rows"))


def triage(rejected: DataFrame, reason: str, fields: Sequence[str]) -> DataFrame:
    """How many reasons name each field: few fields, so each row is tested against the list in place and counted at once."""
    hits = F.filter(F.array(*map(F.lit, fields)), lambda f: F.like(F.col(reason), F.concat(F.lit("%"), f, F.lit("%"))))
    return rejected.select(F.explode(hits).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def kind_transitions(old: DataFrame, new: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """null, empty_string or value before, against after."""
    pairs = versions.paired(old, new, keys, [column])
    return pairs.groupBy(profile.kind_of(F.col(f"old.{column}")).alias("before"), profile.kind_of(F.col(f"new.{column}")).alias("after")).agg(F.count("*").alias("n"))


def name_coverage(left: DataFrame, name: str, right: DataFrame, right_name: str) -> DataFrame:
    return profile.coverage(left, name_key(F.col(name)), right, name_key(F.col(right_name)))


def similar_names(names: DataFrame, name: str, most: int = 2) -> DataFrame:
    """Designed further: all pairs of compared names at most ``most`` edits apart.

    The shorter name is cut into ``most`` + 1 pieces, so some piece stands unedited in the longer one, and one of
    them, the i-th from 0, is moved by at most i places seen from the left and ``most`` - i seen from the right. Candidates are checked before they're made distinct.
    """
    n = most + 1
    keys = names.select(name_key(F.col(name)).alias("a")).where("a IS NOT NULL").distinct().withColumn("l", F.length("a"))
    cut = keys.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("p", F.expr(f"CAST(l * i div {n} AS INT)"))
    pieces = cut.select(F.col("a").alias("b"), "l", "i", F.expr(f"substr(a, p + 1, CAST(l * (i + 1) div {n} AS INT) - p)").alias("piece"))
    probes = keys.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(most)))).withColumn("l", F.col("l") - F.col("d")).where("l >= 0")
    probes = probes.withColumn("p", F.expr(f"CAST(l * i div {n} AS INT)")).withColumn("w", F.expr(f"CAST(l * (i + 1) div {n} AS INT) - p"))
    probes = probes.withColumns({"lo": F.expr(f"greatest(p - i, p + d - ({most} - i), 0)"), "hi": F.expr(f"least(p + i, p + d + ({most} - i), l + d - w)")}).where("lo <= hi")
    probes = probes.withColumn("at", F.explode(F.sequence("lo", "hi"))).select("a", "l", "i", F.expr("substr(a, at + 1, w)").alias("piece")).distinct()
    close = probes.join(pieces, ["l", "i", "piece"]).where("a <> b").where(F.levenshtein("a", "b", most) >= 0)
    pairs = close.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return pairs.select("a", "b", F.levenshtein("a", "b").cast("long").alias("edits"))


def search(df: DataFrame, order: Sequence[Column], n: int, **filters: Column) -> DataFrame:
    """Designed further: a page of a filtered list; filters are joined by AND."""
    out = df
    for condition in filters.values():
        out = out.where(condition)
    return out.orderBy(*order).limit(n)


def detail(events: DataFrame, products: DataFrame, links: DataFrame, firms: DataFrame, source: str, recall_id: str) -> DataFrame:
    """Designed further: one event with its products and its firms by role, as arrays in order of their keys."""
    one = events.where((F.col("source") == source) & (F.col("source_recall_id") == recall_id))
    key = "recall_event_id"
    parts = products.join(one.select(key), key, "left_semi").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("product_name", "recall_product_id"))).alias("products"))
    named = links.join(one.select(key), key, "left_semi").join(firms.select("firm_id", "canonical_name"), "firm_id")
    people = named.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("role", "canonical_name"))).alias("firms"))
    return one.join(parts, key, "left").join(people, key, "left")


def product_search(products: DataFrame, text: str = "", **exact: str) -> DataFrame:
    """Designed further: products whose name or description has the text, in any case, and whose columns (upc, model) are as given."""
    found = F.concat_ws(" ", "product_name", "product_description")
    out = products.where(F.contains(F.lower(found), F.lit(text.lower()))) if text else products
    for column, value in exact.items():
        out = out.where(F.col(column) == value)
    return out


def firm_events(links: DataFrame, events: DataFrame) -> DataFrame:
    """Designed further: of each firm its events in all sources, by source, and when the first and last were published."""
    rows = links.select("firm_id", "recall_event_id").distinct().join(events.select("recall_event_id", "source", "published_at"), "recall_event_id")
    return rows.groupBy("firm_id", "source").agg(F.count("*").alias("events"), F.min("published_at").alias("first"), F.max("published_at").alias("last"))


def resolved_firms(rows: DataFrame, name: str, number: str, most: int = 2) -> DataFrame:
    """Designed further: (normalized_name, anchor): names that share a registration number have one anchor, the least of their names.

    A name without a number takes the anchor of the closest name that has one, within ``most`` edits (equally close ones:
    the least); else it's its own.
    """
    keys = rows.select(name_key(F.col(name)).alias("k"), F.col(number).alias("number")).where("k IS NOT NULL").distinct()
    known = keys.where(F.col("number").isNotNull())
    least = known.groupBy("number").agg(F.min("k").alias("anchor"))
    anchored = known.join(least, "number").groupBy("k").agg(F.min("anchor").alias("anchor"))
    loose = keys.select("k").distinct().join(anchored, "k", "left_anti")
    pairs = similar_names(keys, "k", most)
    both = pairs.select(F.col("a").alias("k"), F.col("b").alias("other"), "edits").unionByName(pairs.select(F.col("b").alias("k"), F.col("a").alias("other"), "edits"))
    near = both.join(anchored.withColumnRenamed("k", "other"), "other").groupBy("k").agg(F.min(F.struct("edits", "other", "anchor")).alias("near"))
    fuzzy = loose.join(near, "k", "left").select("k", F.coalesce("near.anchor", "k").alias("anchor"))
    return anchored.unionByName(fuzzy).withColumnRenamed("k", "normalized_name")


def parameterised(spark: SparkSession, text: str, tables: dict[str, DataFrame], **values) -> DataFrame:
    """A report as SQL: ``{name}`` stands for a table that is given here and ``:name`` for a value, bound and never pasted in."""
    return spark.sql(text, args=values, **tables)


def verification(df: DataFrame, keys: Sequence[str], hash_col: str, nulls: Sequence[str], empties: Sequence[str], spread: str) -> DataFrame:
    """(what, value) rows that tell whether a first load is sound: rows, identities, versions beyond one for each, nulls, empty texts and a spread."""
    one = df.agg(
        F.count("*").alias("rows"), F.countDistinct(*keys).alias("identities"), (F.countDistinct(*keys, hash_col) - F.countDistinct(*keys)).alias("versions over one"),
        *(F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in nulls), *(F.count_if(F.col(c) == "").alias(f"empty {c}") for c in empties),
    )
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("what"), F.col(f"`{c}`").cast("double").alias("value")) for c in one.columns))).alias("x")).select("x.*")
    per = df.groupBy(spread).agg(F.count("*").cast("double").alias("value"))
    return rows.unionByName(per.select(F.concat(F.lit(f"{spread}: "), F.col(spread)).alias("what"), "value"))
