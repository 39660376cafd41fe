"""Projections of older stores and CRM objects to the model's rows: companies' keys and fields, verdicts, signals, contacts, costs.

A projection gives rows of one shape: keys (source_pk, type, value, strong, confidence), verdicts, signals (source_pk, code,
value), contacts. identity.golden then says which companies they are; nothing is looked up row by row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.functions.staging import staged

SHARED_BY = 3


def blank(c: str) -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def keys(rows: DataFrame, pk: str, made: list[tuple[str, Column, Column, Column]]) -> DataFrame:
    """source_pk, type, value, strong, confidence from (type, value, strong, confidence) columns; of a row's equal keys one is kept. A domain or page that SHARED_BY rows claim is weak."""
    parts = F.array(*[F.struct(F.lit(t).alias("type"), v.alias("value"), s.alias("strong"), c.cast("double").alias("confidence")) for t, v, s, c in made])
    out = rows.select(F.col(pk).alias("source_pk"), F.explode(parts).alias("k")).select("source_pk", "k.*").filter("value IS NOT NULL").dropDuplicates(["source_pk", "type", "value"])
    n = out.groupBy("type", "value").agg(F.countDistinct("source_pk").alias("_n"))
    shared = F.col("type").isin("domain", "linkedin_company") & (F.col("_n") >= SHARED_BY)
    return out.join(n, ["type", "value"]).select("source_pk", "type", "value", (F.col("strong") & ~shared).alias("strong"), "confidence")


def signals(rows: DataFrame, pk: str, made: dict[str, Column]) -> DataFrame:
    """source_pk, code, value of the filled columns."""
    parts = F.array(*[F.struct(F.lit(code).alias("code"), c.cast("string").alias("value")) for code, c in made.items()])
    return rows.select(F.col(pk).alias("source_pk"), F.explode(parts).alias("s")).select("source_pk", "s.*").filter("value IS NOT NULL")


def directory(entities: DataFrame, candidates: DataFrame, sites: DataFrame, classifications: DataFrame, prior: str, legal_id: Callable[[Column], Column] = norm.cin) -> dict[str, DataFrame]:
    """keys, verdicts, signals of a directory: entities with their candidate of the same page and name, and what their site says.

    Tax numbers count if they have their form; the legal id of a site counts for 0.8. Classifications come in as unscored
    verdicts, by rules or a model; those of the model `prior` are placeholders and don't. legal_id is the form of the legal ids.
    """
    c = candidates.select(F.col("linkedin").alias("_l"), F.col("name").alias("_n"), "tax_id", "vendor_id")
    rows = entities.join(c, entities["linkedin"].eqNullSafe(c["_l"]) & (entities["name"] == c["_n"]), "left").join(sites.withColumnRenamed("entity", "_e").withColumnRenamed("cin", "site_cin"), F.col("entity") == F.col("_e"), "left")
    tax = F.upper(F.regexp_replace("tax_id", r"\s+", ""))
    yes, one = F.lit(True), F.lit(1.0)
    made = [("cin", legal_id(F.col("cin")), yes, one), ("cin", legal_id(F.col("site_cin")), yes, F.lit(0.8)), ("vendor_org", F.lower(blank("vendor_id")), yes, one), ("tax_id", F.when(tax.rlike("^[A-Z0-9]{15}$"), tax), yes, one),
            ("linkedin_company", norm.linkedin_company(F.col("linkedin")), yes, one), ("domain", norm.domain(F.col("domain"), idn=False), yes, one)]
    real = classifications.filter(~F.col("model").eqNullSafe(F.lit(prior)))
    verdicts = real.join(entities.select("entity"), "entity", "left_semi").select(F.col("entity").alias("source_pk"), F.lit("unscored").alias("bucket"), F.when(F.col("model") == "rules", "rules").otherwise("llm").alias("method"), F.get(F.from_json("segments", "array<string>"), F.lit(0)).alias("segment"))
    return {"keys": keys(rows, "entity", made), "verdicts": verdicts, "signals": signals(rows, "entity", {"site_status": F.col("status"), "site_code": F.col("http_code")})}


def corpus(companies: DataFrame, identifiers: DataFrame, scores: DataFrame, indicators: DataFrame, definitions: DataFrame, blocks: DataFrame) -> dict[str, DataFrame]:
    """keys, verdicts, signals, orphans, suppressions of a scored corpus: a company's own domain is its first identifier's if it has none; weak ones stay weak.

    A score's label gives its bucket, who scored it the method. Indicators without a company or a definition are orphans. A blocked
    value is typed by its hint or its looks, and not brought in if it has no type.
    """
    first = identifiers.filter("type = 'domain'").groupBy(F.col("company").alias("_c")).agg(F.min_by("value", "position").alias("_d"))
    rows = companies.join(first, companies["company"] == first["_c"], "left").withColumn("_domain", F.coalesce(blank("domain"), F.col("_d")))
    own = keys(rows, "company", [("domain", norm.domain(F.col("_domain"), idn=False), F.lit(True), F.lit(1.0))])
    value = F.when(F.col("type") == "domain", norm.domain(F.col("value"), idn=False)).otherwise(F.lower(blank("value")))
    more = identifiers.select(F.col("company").alias("source_pk"), "type", value.alias("value"), (F.col("confidence") >= 0.9).alias("strong"), F.col("confidence").cast("double").alias("confidence")).filter("value IS NOT NULL")
    all_keys = own.unionByName(more.join(own.select("source_pk", "type", "value"), ["source_pk", "type", "value"], "left_anti"))
    known = companies.select("company")
    by = F.lower("scored_by")
    verdicts = scores.join(known, "company", "left_semi").select(
        F.col("company").alias("source_pk"), F.when(F.lower("label").isin("fit", "maybe"), F.lower("label")).otherwise("unscored").alias("bucket"),
        F.when(by.contains("llm"), "llm").when(by.contains("manual"), "manual").otherwise("rules").alias("method"), F.when(F.col("band").rlike("^P[1-4]$"), F.col("band")).alias("band"))
    met = indicators.join(known.withColumn("_k", F.lit(True)), "company", "left").join(F.broadcast(definitions), "indicator", "left")
    good = F.col("_k").isNotNull() & F.col("slug").isNotNull()
    typed = blocks.withColumns({"match": norm.match_type(F.col("value"), F.col("kind")), "as": norm.suppression_kind(F.col("reason"), F.col("kind"))})
    return {"keys": all_keys, "verdicts": verdicts, "signals": met.filter(good).select(F.col("company").alias("source_pk"), F.col("slug").alias("code"), F.col("value").cast("string").alias("value")),
            "orphans": met.filter(~good).select("company", "indicator"), "suppressions": typed.filter("match IS NOT NULL").select("match", F.col("as").alias("kind"), "value")}


def screened(companies: DataFrame, people: DataFrame, quota: DataFrame) -> dict[str, DataFrame]:
    """verdicts, contacts, costs of a screened list: a passed gate is unscored, a failed one out with its reason; the distinct listing sources in order; people with whether their company is there; a meter's use as a cost."""
    listed = F.array_sort(F.array_distinct(F.transform(F.from_json("sources", "array<struct<source:string>>"), lambda s: s["source"])))
    verdicts = companies.select(F.col("domain").alias("source_pk"), F.when(F.col("passed"), "unscored").otherwise("out").alias("bucket"), F.when(~F.col("passed"), "gate_fail").alias("code"), "reason", F.array_join(listed, ",").alias("sources"))
    known = companies.select(F.col("domain").alias("_d"), F.lit(True).alias("_k"))
    contacts = people.join(known, people["domain"] == known["_d"], "left").select("person", "domain", norm.email(F.col("email")).alias("email"), F.col("_k").isNull().alias("without_company"))
    unit = F.when(F.col("metric") == "search", "search_call").when(F.col("metric") == "credits", "credit").otherwise(F.col("metric"))
    costs = quota.select(F.lower("provider").alias("vendor"), unit.alias("unit"), F.col("used").cast("double").alias("qty"), F.when(F.col("metric") == "credits", F.col("used").cast("double")).alias("credits"))
    return {"verdicts": verdicts, "contacts": contacts, "costs": costs}


PLACES = "array<struct<id:string,name:string,website:string,address:string,rating:double,reviews:long>>"


def places(tiles: DataFrame) -> dict[str, DataFrame]:
    """keys, places, signals of map tiles whose JSON holds places: a place in several tiles counts once, by time and tile; a domain of SHARED_BY places is weak; the state is read from an Indian address."""
    flat = tiles.select("tile", "at", F.explode(F.from_json("places", PLACES)).alias("p")).select("tile", "at", "p.*").filter("trim(id) <> ''")
    first = flat.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy("at", "tile"))).filter("_r = 1")
    rows = first.withColumns({"state": F.nullif(F.regexp_extract("address", r",\s*([A-Za-z][A-Za-z &.]*?)\s+[0-9]{6},\s*India\s*$", 1), F.lit("")), "india": F.trim("address").endswith("India")})
    made = [("place_id", F.col("id"), F.lit(True), F.lit(1.0)), ("domain", norm.domain(F.col("website"), idn=False), F.lit(True), F.lit(1.0))]
    return {"keys": keys(flat.dropDuplicates(["id", "website"]), "id", made), "places": rows.select(F.col("id").alias("source_pk"), "name", "state", F.coalesce("india", F.lit(False)).alias("india")), "signals": signals(rows, "id", {"rating": F.col("rating"), "reviews": F.col("reviews")})}


def resolved(rows: DataFrame, legal_id: Callable[[Column], Column] = norm.cin) -> dict[str, DataFrame]:
    """keys, signals, contacts of resolver rows (domain, status, cin, stage, data): the legal id is the row's or its JSON's; a founder named there is a contact."""
    d = rows.withColumn("d", F.from_json("data", "struct<cin:string,company:string,founder_name:string,title:string,linkedin_url:string>"))
    cin = F.coalesce(legal_id(F.col("cin")), legal_id(F.col("d.cin")))
    made = [("domain", norm.domain(F.col("domain"), idn=False), F.lit(True), F.lit(1.0)), ("cin", cin, F.lit(True), F.lit(1.0))]
    people = d.filter("trim(d.founder_name) <> ''").select(F.col("domain").alias("source_pk"), F.trim("d.founder_name").alias("full_name"), F.col("d.title").alias("title"), norm.linkedin_person(F.col("d.linkedin_url")).alias("linkedin"))
    return {"keys": keys(d, "domain", made), "signals": signals(d, "domain", {"stage": F.col("stage"), "status": F.col("status")}), "contacts": people}


SURE = ("exact", "exact_api", "override")


def radar(candidates: DataFrame, links: DataFrame, entities: DataFrame, scored: DataFrame, evidence: DataFrame, legal_id: Callable[[Column], Column] = norm.cin) -> dict[str, DataFrame]:
    """keys, signals, unmatched of a radar: a candidate's legal ids, strong if confirmed or matched exactly, at match score / 100; scores and evidence by kind as signals, with how many there are and the last one's snippet; legal entities that no candidate points at."""
    sure = F.coalesce("confirmed", F.lit(False)) | F.col("method").isin(*SURE)
    ids = links.join(candidates.select("candidate"), "candidate", "left_semi").select(F.col("candidate").alias("source_pk"), F.lit("cin").alias("type"), legal_id(F.col("cin")).alias("value"), sure.alias("strong"), (F.coalesce("score", F.lit(100.0)) / 100.0).alias("confidence")).filter("value IS NOT NULL")
    ids = ids.groupBy("source_pk", "type", "value").agg(F.max(F.struct("strong", "confidence")).alias("b")).select("source_pk", "type", "value", "b.*")
    own = signals(scored.join(candidates.select("candidate"), "candidate", "left_semi"), "candidate", {"tier": F.col("tier"), "reason": F.nullif(F.trim("reason"), F.lit(""))})
    kinds = evidence.groupBy("candidate", "kind").agg(F.count("*").alias("n"), F.max_by("snippet", "id").alias("snippet"))
    found = kinds.select(F.col("candidate").alias("source_pk"), F.concat(F.lit("evidence_"), "kind").alias("code"), F.concat_ws("|", F.col("n").cast("string"), "snippet").alias("value"))
    return {"keys": ids, "signals": own.unionByName(found), "unmatched": entities.join(links.select("cin"), "cin", "left_anti").select(F.col("cin").alias("source_pk"), legal_id(F.col("cin")).alias("value"), norm.company_status(F.col("status")).alias("status"))}


def call_costs(calls: DataFrame, vendor: str, unit: str) -> DataFrame:
    """vendor, unit, qty, occurred_at, run: one unit a call, whatever it gave."""
    return calls.select("call", F.lit(vendor).alias("vendor"), F.lit(unit).alias("unit"), F.lit(1.0).alias("qty"), F.col("at").alias("occurred_at"), "run")


def prop(name: str) -> Column:
    """A property of a CRM object, null if it is blank."""
    return F.nullif(F.trim(F.try_element_at("properties", F.lit(name))), F.lit(""))


def crm_companies(objects: DataFrame, free_mail: tuple[str, ...], known: tuple[str, ...]) -> DataFrame:
    """account, id, name, domain, domain_strong, linkedin, slot, employees, country, custom of company objects.

    The domain is the first valid of three properties, and weak if it is a free-mail host. A portal's unique domain slot goes
    to one live company, the least id, to an archived one only if no live one has it. Employees below 0 are none. Properties
    that aren't known are kept as they are, in order of their names, empty ones out.
    """
    domain = F.coalesce(*[norm.domain(prop(p), idn=False) for p in ("domain", "unique_domain", "website")])
    unique = F.lower(prop("unique_domain"))
    rows = objects.withColumns({"domain": domain, "_unique": unique, "_e": norm.finite(prop("employees"))})
    w = Window.partitionBy("account", "_unique").orderBy("archived", F.length("id"), "id")
    holder = F.when(F.col("_unique").isNotNull() & (F.row_number().over(w) == 1), F.col("_unique"))
    extra = F.map_filter("properties", lambda k, v: ~k.isin(*known) & (F.trim(v) != ""))
    custom = F.array_join(F.transform(F.array_sort(F.map_entries(extra)), lambda e: F.concat_ws("=", e["key"], e["value"])), "&")
    rows = rows.withColumns({"slot": holder, "custom": custom})
    strong = F.col("domain").isNotNull() & ~F.col("domain").isin(*free_mail)
    return rows.select("account", "id", prop("name").alias("name"), "domain", strong.alias("domain_strong"), norm.linkedin_company(prop("linkedin_page")).alias("linkedin"), "slot", F.when(F.col("_e") >= 0, F.col("_e").cast("long")).alias("employees"), norm.country(prop("country")).alias("country"), "custom")


def crm_contacts(objects: DataFrame, stop: tuple[str, ...]) -> DataFrame:
    """account, id, email, linkedin, do_not_contact: one of the `stop` properties is set to true, yes or 1."""
    no = reduce(lambda a, b: a | b, [F.coalesce(F.lower(prop(p)).isin("true", "yes", "1"), F.lit(False)) for p in stop])
    return objects.select("account", "id", norm.email(prop("email")).alias("email"), norm.linkedin_person(prop("linkedin")).alias("linkedin"), no.alias("do_not_contact"))


def crm_deals(objects: DataFrame, stages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deals, unresolved): account, id, pipeline, stage, segment, amount, cost, currency, closed_at; and account, id of deals whose pipeline and stage aren't there.

    The segment is the first filled of three properties; money below 0 is none; a currency without three letters is USD.
    """
    money = lambda p: F.when(norm.finite(prop(p)) >= 0, norm.finite(prop(p)))
    cur = F.upper(prop("currency"))
    s = stages.select(F.col("pipeline").alias("_p"), F.col("stage").alias("_s"), F.lit(True).alias("_there")).distinct()
    rows = objects.withColumns({"pipeline": prop("pipeline"), "stage": prop("stage")})
    rows = rows.join(F.broadcast(s), (rows["pipeline"] == s["_p"]) & (rows["stage"] == s["_s"]), "left")
    deals = rows.filter("_there").select("account", "id", "pipeline", "stage", F.coalesce(prop("segment"), prop("scraped_type"), prop("category")).alias("segment"), money("amount").alias("amount"), money("cost").alias("cost"), F.when(F.length(cur) == 3, cur).otherwise("USD").alias("currency"), norm.utc_timestamp(prop("closedate"), milliseconds=True).alias("closed_at"))
    return deals, rows.filter("_there IS NULL").select("account", "id")


def crm_engagements(objects: DataFrame, created: str) -> DataFrame:
    """account, id, occurred_at (its own time, else its creation), body_sha of engagement objects; a blank body has none."""
    return objects.select("account", "id", F.coalesce(norm.utc_timestamp(prop("timestamp"), milliseconds=True), F.col(created)).alias("occurred_at"), F.sha2(prop("body"), 256).alias("body_sha"))


def verticals(categories: DataFrame, known: DataFrame) -> DataFrame:
    """category, vertical, method: a category's vertical by its slug, else by its segment, else a new one named by its slug."""
    rows = categories.withColumn("slug", F.coalesce(norm.slug(F.col("key")), F.concat(F.lit("category_"), F.col("category").cast("string"))))
    a = known.select(F.col("slug").alias("_slug"), F.col("vertical").alias("_by_slug"))
    b = known.filter("segment IS NOT NULL").groupBy(F.col("segment").alias("_seg")).agg(F.min("vertical").alias("_by_segment"))
    rows = rows.join(F.broadcast(a), rows["slug"] == a["_slug"], "left").join(F.broadcast(b), rows["segment"] == b["_seg"], "left")
    method = F.when(F.col("_by_slug").isNotNull(), "slug").when(F.col("_by_segment").isNotNull(), "segment").otherwise("new")
    return rows.select("category", F.coalesce(F.col("_by_slug").cast("string"), F.col("_by_segment").cast("string"), "slug").alias("vertical"), method.alias("method"))


def _creators(claims: DataFrame) -> DataFrame:
    """pk of the rows (pk, key) that share no key with an earlier such row.

    A round decides the rows that are the first of all their keys, and takes away those whose key such a row has; each
    key gives its first row only, so no pairs are made. The first row that is left is always decided. Where rows stand in each
    other's way one after another there are as many rounds as that chain has such rows; keys are those of one company.
    """
    open_, found = staged(claims.select("pk", "key"), "upsert-open"), []
    while not open_.isEmpty():
        first = open_.groupBy(F.col("key").alias("_k")).agg(F.min("pk").alias("first"))
        met = staged(open_.join(first, open_["key"] == first["_k"]).drop("_k"), "upsert-met")
        new = staged(met.groupBy("pk").agg(F.bool_and(F.col("pk") == F.col("first")).alias("_all")).filter("_all").select("pk"), "upsert-new")
        found.append(new)
        gone = met.join(new.select(F.col("pk").alias("_n")), F.col("first") == F.col("_n"), "left_semi").select(F.col("pk").alias("_g")).distinct()
        open_ = staged(open_.join(gone, open_["pk"] == gone["_g"], "left_anti"), "upsert-open")
    return reduce(DataFrame.unionByName, found) if found else claims.select("pk").limit(0)


def contact_upsert(rows: DataFrame) -> DataFrame:
    """pk, contact, method: rows (pk, company, linkedin, email) that are one person within a company, one after another by pk.

    A row that has the page, else the address, of a contact before it in its company is that contact; else it is a contact
    itself (contact is its pk, method new), and only contacts have keys, so what a linked row brings is nobody's. A row
    without keys is a contact; no company is a company too; the same page in another company is another contact (contact_candidates).
    """
    key = lambda kind: F.to_json(F.struct(F.lit(kind).alias("kind"), "company", F.col(kind).alias("value")))
    pairs = F.array(*[F.struct(F.lit(i).alias("order"), F.lit(k).alias("method"), F.when(F.col(k).isNotNull(), key(k)).alias("key")) for i, k in enumerate(("linkedin", "email"))])
    claims = staged(rows.select("pk", F.explode(pairs).alias("_c")).select("pk", "_c.*").filter("key IS NOT NULL"), "upsert-claims")
    creators = _creators(claims).select(F.col("pk").alias("_n"))
    keys = claims.join(creators, claims["pk"] == creators["_n"], "left_semi").select(F.col("key").alias("_k"), F.col("pk").alias("contact"))
    met = claims.join(keys, claims["key"] == keys["_k"]).filter("contact < pk").groupBy(F.col("pk").alias("_p")).agg(F.min(F.struct("order", "contact", "method")).alias("_c"))
    out = rows.select("pk").join(met, rows["pk"] == met["_p"], "left")
    return out.select("pk", F.coalesce("_c.contact", "pk").alias("contact"), F.coalesce("_c.method", F.lit("new")).alias("method"))


def contact_candidates(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """left, right, score: each contact (method new) with a page that an earlier one of another company has, and the first that has it; never merged."""
    new = linked.filter("method = 'new'").select(F.col("pk").alias("_n"))
    pages = rows.filter("linkedin IS NOT NULL").join(new, F.col("pk") == F.col("_n"), "left_semi").select("pk", "linkedin")
    first = pages.groupBy(F.col("linkedin").alias("_l")).agg(F.min("pk").alias("left"))
    met = pages.join(first, pages["linkedin"] == first["_l"]).filter("left < pk")
    return met.select("left", F.col("pk").alias("right"), F.lit(0.9).alias("score"))


def origin_refs(parts: dict[str, tuple[DataFrame, str, str]], confidence: dict[str, float]) -> DataFrame:
    """entity_type, entity_id, source_pk, method, confidence: a provenance row for each linked row of each type (frame, entity, method column), once."""
    made = F.create_map(*[F.lit(x) for pair in confidence.items() for x in pair])
    rows = [df.select(F.lit(t).alias("entity_type"), F.col(e).cast("string").alias("entity_id"), F.col("source_pk").cast("string").alias("source_pk"), F.col(m).alias("method")) for t, (df, e, m) in parts.items()]
    return reduce(DataFrame.unionByName, rows).distinct().withColumn("confidence", F.coalesce(F.try_element_at(made, F.col("method")), F.lit(1.0)))


def company_drift(deals: DataFrame, links: DataFrame) -> DataFrame:
    """deal, deal_company, link_company of deals whose company isn't that of their primary link; no company is a value."""
    primary = links.filter("is_primary").select("deal", F.col("company").alias("link_company"))
    rows = deals.select("deal", F.col("company").alias("deal_company")).join(primary, "deal")
    return rows.filter(~F.col("deal_company").eqNullSafe(F.col("link_company")))
