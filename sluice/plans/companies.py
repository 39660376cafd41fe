"""Identity and gate queries: customers and suppliers as two sources of companies, with keys that they share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import norm
from sluice.functions.patterns import take_by_demand
from sluice.functions.staging import staged
from sluice.operators import gates, identity
from sluice.plans import model

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Messy spellings of a domain, an address, a name and a phone number; a key is shared by a few neighbours, whatever the table's size, and the two keys of a company don't always agree.
PARTS = """SELECT {pk} * 2 + {odd} AS entity, '{source}' AS source, {pk} AS pk,
CASE {pk} % 7 WHEN 0 THEN ' HTTPS://www.d' || {third} || '.example/path?x ' WHEN 1 THEN 'D' || {third} || '.EXAMPLE' WHEN 2 THEN 'user@d' || {third} || '.example:8080'
WHEN 3 THEN '"d' || {third} || '.example."' WHEN 4 THEN 'not a host' WHEN 5 THEN CASE WHEN {pk} % 2 = 0 THEN 'https://mü.d' || {pk} || '.example' END ELSE 'generic.example' END AS raw_domain,
CASE {pk} % 5 WHEN 0 THEN 'https://in.social.example/company/C-' || {pair} || '/?trk=x' WHEN 1 THEN 'COMPANY/c-' || {pair} WHEN 2 THEN 'https://social.example/in/p-' || {pk} WHEN 3 THEN '' ELSE 'school/s-' || {third} END AS raw_linkedin,
CASE {pk} % 4 WHEN 0 THEN 'Café Unit ' || {third} || ' and Sons Incorporated' WHEN 1 THEN 'cafe  unit ' || {third} || ' Sons Pvt. Ltd.' ELSE 'The Café Unit ' || {third} || ' Sons PTE' END AS name,
CASE WHEN {pk} % 3 = 0 THEN NULL ELSE {nation} % 2 END AS country, CASE WHEN {pk} % 5 = 0 THEN NULL WHEN {pk} % 5 < 3 THEN 'City ' || ({pk} % 2) ELSE 'CITY ' || ({pk} % 2) END AS city,
CASE WHEN {pk} % 10 < 8 THEN 1.0 ELSE 0.5 END AS confidence,
CASE {pk} % 12 WHEN 0 THEN '+91 98' || (10000000 + {pk} * 37) WHEN 1 THEN '098' || (10000000 + {pk} * 41) WHEN 2 THEN '0044 20' || (10000000 + {pk}) WHEN 3 THEN '22' || (10000000 + {pk}) WHEN 4 THEN 'none'
WHEN 5 THEN '9999999999' WHEN 6 THEN '79' || (10000000 + {pk}) WHEN 7 THEN '+91 612' || (1000000 + {pk}) WHEN 8 THEN '0091 1800' || (1000000 + {pk}) WHEN 9 THEN '+971 50' || (1000000 + {pk}) WHEN 10 THEN '70' || (10000000 + {pk}) ELSE '9898989898' END AS raw_phone
FROM {{{table}}}"""
BASE = " UNION ALL ".join(
    PARTS.format(**p, third=f"CAST(floor({p['pk']} / 3) AS BIGINT)", pair=f"CAST({p['pk']} % 5 + 5 * floor({p['pk']} / 10) AS BIGINT)")
    for p in (dict(pk="c_custkey", odd=0, source="cust", nation="c_nationkey", table="customer"), dict(pk="s_suppkey", odd=1, source="supp", nation="s_nationkey", table="supplier"))
)
GENERIC = ("generic.example",)
# Written from the rules: trimmed of blanks and quotes; scheme, path, credentials, port, dots and www. off; punycode; 22 forms out of a name.
CO = rf"""b AS ({model.duck(BASE)}), n1 AS (SELECT *, trim(lower(raw_domain), ' "''') AS t FROM b),
n2 AS (SELECT *, replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '^[a-z]+://', ''), '[/?#].*$', ''), '^.*@', ''), ':[0-9]+$', ''), '^\.+|\.+$', '', 'g'), '^www\.', ''), 'mü.', 'xn--m-eha.') AS h,
lower(trim(raw_linkedin)) AS li FROM n1),
co AS (SELECT entity, source, pk, raw_domain, CASE WHEN regexp_matches(h, '^([a-z0-9]([a-z0-9-]*[a-z0-9])?\.)+[a-z0-9-]+$') THEN h END AS domain, raw_linkedin,
CASE WHEN regexp_matches(li, '(^|/)(company|school|showcase)/[^/?#\s]+') THEN regexp_extract(li, '(?:^|/)((company|school|showcase)/[^/?#\s]+)', 1) END AS linkedin,
name, array_to_string(list_filter(regexp_extract_all(strip_accents(lower(name)), '[a-z0-9]+'), lambda w: w NOT IN ('ltd', 'limited', 'pvt', 'private', 'llp', 'inc', 'incorporated', 'plc', 'corp', 'corporation', 'llc', 'co', 'company', 'gmbh', 'pte', 'opc', 'lp', 'sa', 'bv', 'ag', 'the', 'and')), ' ') AS name_key,
regexp_replace(lower(trim(name)), '\s+', ' ', 'g') AS name_norm, country, city, confidence, raw_phone FROM n2)"""
IDS = """ki AS (SELECT entity, source, 'domain' AS type, domain AS value, 0 AS priority, CAST(confidence AS DOUBLE) AS confidence FROM co WHERE domain IS NOT NULL UNION ALL SELECT entity, source, 'linkedin', linkedin, 1, 1.0 FROM co WHERE linkedin IS NOT NULL),
kc AS (SELECT ki.*, count(DISTINCT entity) OVER (PARTITION BY type, value) AS claims, count(DISTINCT entity) OVER (PARTITION BY source, type, value) AS own FROM ki),
id AS (SELECT entity, source, type, value, priority, confidence, claims, CASE WHEN own >= 3 OR confidence < 0.9 OR (type = 'domain' AND value = 'generic.example') THEN 'weak' ELSE 'strong' END AS strength FROM kc)"""
# Entities one after another: a key belongs to the company of its first claimant; the claimed key of least priority links, else the entity begins a company.
GOLD = """fc AS (SELECT type, value, min(entity) AS first FROM id WHERE strength = 'strong' GROUP BY type, value),
cl AS (SELECT id.entity, id.source, id.type, id.value, id.priority, fc.first FROM id JOIN fc ON id.type = fc.type AND id.value = fc.value WHERE id.strength = 'strong'),
pa AS (SELECT entity, arg_min(first, priority) AS into_, arg_min(type, priority) AS how FROM cl WHERE first < entity GROUP BY entity),
ch(entity, here) AS (SELECT entity, into_ FROM pa UNION ALL SELECT ch.entity, pa.into_ FROM ch JOIN pa ON ch.here = pa.entity),
go AS (SELECT co.entity, coalesce(min(ch.here), co.entity) AS golden, coalesce(any_value(pa.how), 'new') AS how FROM co LEFT JOIN ch ON co.entity = ch.entity LEFT JOIN pa ON co.entity = pa.entity GROUP BY co.entity),
ow AS (SELECT cl.*, a.golden, b.golden AS owner FROM cl JOIN go a ON cl.entity = a.entity JOIN go b ON cl.first = b.entity),
gf AS (SELECT golden, count(*) AS members, list_sort(list(DISTINCT source)) AS sources, arg_min(name_key, co.entity) AS name_key, arg_min(name_norm, co.entity) AS name_norm, arg_min(city, co.entity) FILTER (city IS NOT NULL) AS city, arg_min(country, co.entity) FILTER (country IS NOT NULL) AS country FROM co JOIN go ON co.entity = go.entity GROUP BY golden)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, source, pk, raw columns and their normal forms, of customers and suppliers."""
    # rows are few bytes and much work, so by their bytes they would be one task's
    raw = model.derived(spark, sf_dir, BASE).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "entity")
    rules = {"domain": ("domain", "raw_domain"), "linkedin": ("linkedin_company", "raw_linkedin"), "name_key": ("name_key", "name"), "name_norm": ("company_name", "name")}
    rows = norm.applied(raw, rules)
    return rows.withColumn("confidence", F.col("confidence").cast("double"))


TYPES = [("domain", "domain"), ("linkedin", "linkedin")]


def _ids(co: DataFrame) -> DataFrame:
    return identity.identifiers(co, TYPES, confidence={"domain": "confidence"}, generic={"domain": GENERIC})


#: What linking reads of a company.
KEYED = ["entity", "source", "pk", "domain", "linkedin", "confidence"]


def query(name: str, body: str, with_: str = "", *, once: bool = False, reads: list[str] | None = None):
    """A query over the companies, which are derived once and staged, unless the query reads them only once; of what it doesn't read (`reads`) nothing is derived."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            co = companies(spark, sf_dir).select(*(reads or ["*"]))
            return f(co if once else staged(co, "companies"))

        QUERIES[name] = run
        SQL[name] = f"WITH RECURSIVE {', '.join(x for x in (CO, IDS, with_) if x)} {body}"
        return f

    return add


@query("normalise_companies", "SELECT entity, domain, linkedin, name_key FROM co", once=True)
def _(co):
    return co.select("entity", "domain", "linkedin", "name_key")


@query("normalise_rejected", "SELECT entity, 'raw_domain' AS column, raw_domain AS value FROM co WHERE trim(raw_domain) <> '' AND domain IS NULL UNION ALL SELECT entity, 'raw_linkedin', raw_linkedin FROM co WHERE trim(raw_linkedin) <> '' AND linkedin IS NULL")
def _(co):
    return norm.normalise(co.select("entity", "raw_domain", "raw_linkedin"), {"raw_domain": "domain", "raw_linkedin": "linkedin_company"}, "entity")[1]


# Written from the rules: area codes of fixed lines that mobile numbers could begin with too leave a number unknown.
PHONES = r"""pe AS (SELECT entity, source, raw_phone, CASE WHEN d = '' THEN NULL WHEN starts_with(raw_phone, '+') THEN '+' || d WHEN starts_with(d, '00') THEN '+' || substr(d, 3) WHEN length(d) = 12 AND starts_with(d, '91') THEN '+' || d WHEN length(d) = 11 AND d[1] = '0' THEN '+91' || substr(d, 2) WHEN length(d) = 10 THEN '+91' || d END AS e
FROM (SELECT *, regexp_replace(raw_phone, '[^0-9]', '', 'g') AS d FROM co)), pn AS (SELECT *, CASE WHEN regexp_matches(e, '^\+[1-9][0-9]{7,14}$') THEN e END AS e164, substr(e, 4) AS nat, CASE WHEN length(regexp_replace(raw_phone, '[^0-9]', '', 'g')) >= 10 THEN right(regexp_replace(raw_phone, '[^0-9]', '', 'g'), 10) ELSE regexp_replace(raw_phone, '[^0-9]', '', 'g') END AS tail FROM pe),
ph AS (SELECT entity, source, raw_phone, e164, CASE WHEN e164 IS NULL OR NOT starts_with(e164, '+91') THEN 'unknown' WHEN length(nat) = 11 AND starts_with(nat, '1800') THEN 'tollfree' WHEN length(nat) = 10 AND nat[1] = '9' THEN 'mobile'
WHEN length(nat) = 10 AND nat[1] IN ('6', '7', '8') AND left(nat, 2) NOT IN ('79', '80') AND left(nat, 3) NOT IN ('612','621','631','641','651','661','671','674','680','712','721','731','734','741','751','755','761','771','788','821','824','831','832','836','861','863','866','870','877','884','891') THEN 'mobile'
WHEN length(nat) = 10 AND nat[1] IN ('1', '2', '3', '4', '5') THEN 'landline' ELSE 'unknown' END AS phone_type,
CASE WHEN starts_with(e164, '+971') THEN 'AE' WHEN starts_with(e164, '+91') THEN 'IN' WHEN starts_with(e164, '+44') THEN 'GB' END AS phone_country,
length(tail) < 7 OR len(list_distinct(string_split(tail, ''))) = 1 OR tail IN ('1234567890', '0123456789', '9876543210', '0987654321') OR regexp_matches(tail, '^(0?1234567|9876543)') AS is_dummy FROM pn)"""


def _phones(co: DataFrame) -> DataFrame:
    rows = co.withColumn("e164", norm.phone_e164(F.col("raw_phone")))
    return rows.withColumns({"phone_type": norm.phone_type(F.col("e164")), "phone_country": norm.phone_country(F.col("e164")), "is_dummy": norm.is_dummy_phone(F.col("raw_phone"))})


@query("classify_phones", "SELECT entity, e164, phone_type, phone_country, is_dummy FROM ph", PHONES, once=True)
def _(co):
    return _phones(co).select("entity", "e164", "phone_type", "phone_country", "is_dummy")


@query("mobile_gate", "SELECT owner, CASE WHEN bool_or(phone_type = 'mobile' AND NOT is_dummy) THEN arg_min(e164, entity) FILTER (phone_type = 'mobile' AND NOT is_dummy) END AS e164, coalesce(bool_or(phone_type = 'mobile' AND NOT is_dummy), false) AS has_mobile, count(*) AS phones FROM (SELECT entity // 14 AS owner, * FROM ph) GROUP BY owner", PHONES, once=True)
def _(co):
    phones = _phones(co).select(F.floor(F.col("entity") / 14).alias("owner"), F.col("entity").alias("phone_id"), "e164", "phone_type", F.lit(False).alias("is_primary"), "is_dummy")
    return gates.best_phone(phones)


@query("phone_gate_review", r"SELECT owner_kind, entity AS owner, raw_phone, e164, reason FROM (SELECT CASE WHEN source = 'cust' THEN 'contact' ELSE 'company' END AS owner_kind, *, CASE WHEN phone_type = 'unknown' AND regexp_matches(e164, '^\+91[6-9][0-9]{9}$') THEN 'mobile_shape_unclassified' WHEN e164 IS NULL AND regexp_matches(regexp_replace(raw_phone, '[ -]', '', 'g'), '^(\+91|0091|[6-9][0-9]{9}$)') THEN 'indian_shape_without_e164' END AS reason FROM ph WHERE NOT is_dummy) WHERE reason IS NOT NULL", PHONES, once=True)
def _(co):
    rows = _phones(co).withColumnRenamed("entity", "owner")
    return gates.phone_review({"contact": rows.filter("source = 'cust'"), "company": rows.filter("source = 'supp'")})


@query("identifier_candidates", "SELECT entity, source, type, value, priority, confidence, claims, strength FROM id", reads=KEYED)
def _(co):
    return _ids(co)


def linked(co: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The strong claims of the companies and what they are linked to."""
    claims = staged(identity.strong_claims(_ids(co)), "claims")
    return claims, staged(identity.golden(co, claims), "golden")


FILLED = ["name_key", "name_norm", "city", "country"]


@query("link_golden", "SELECT * FROM go", GOLD, reads=KEYED)
def _(co):
    return linked(co)[1]


@query("company_golden", "SELECT gf.golden, members, array_to_string(sources, ',') AS sources, name_norm, city, country, arg_min(value, ow.entity) FILTER (type = 'domain') AS domain, arg_min(value, ow.entity) FILTER (type = 'linkedin') AS linkedin FROM gf LEFT JOIN ow ON gf.golden = ow.golden AND ow.golden = owner GROUP BY ALL", GOLD)
def _(co):
    claims, labels = linked(co)
    keys = identity.golden_keys(claims, labels, ["domain", "linkedin"])
    rows = identity.golden_fields(co, labels, FILLED).join(keys, "golden", "left")
    return rows.select("golden", "members", F.array_join("sources", ",").alias("sources"), "name_norm", "city", "country", "domain", "linkedin")


@query("source_overlap", "SELECT n AS sources, count(*) AS companies FROM (SELECT golden, count(DISTINCT source) AS n FROM co JOIN go ON co.entity = go.entity GROUP BY golden) GROUP BY n", GOLD, reads=KEYED)
def _(co):
    return identity.source_overlap(co, linked(co)[1])


@query("identifier_conflicts", "SELECT least(golden, owner) AS left, greatest(golden, owner) AS right, array_to_string(list_sort(list(DISTINCT type)), ',') AS types, 0.9::DOUBLE AS score FROM ow WHERE golden <> owner GROUP BY ALL", GOLD, reads=KEYED)
def _(co):
    return identity.conflicts(*linked(co))


@query("name_merge_candidates", "SELECT a.golden AS left, b.golden AS right, least(95, 60 + 15 * CAST(a.name_norm = b.name_norm AS INT) + 10 * CAST(coalesce(lower(a.city) = lower(b.city), false) AS INT) + 10 * CAST(coalesce(a.country = b.country, false) AS INT)) / 100::DOUBLE AS score FROM gf a JOIN gf b ON a.name_key = b.name_key AND a.golden < b.golden AND len(list_distinct(list_concat(a.sources, b.sources))) >= 2 AND (a.country IS NULL OR b.country IS NULL OR a.country = b.country) JOIN (SELECT name_key FROM gf WHERE length(name_key) >= 4 GROUP BY name_key HAVING count(*) <= 6) k ON k.name_key = a.name_key", GOLD)
def _(co):
    return identity.name_candidates(identity.golden_fields(co, linked(co)[1], FILLED))


POINTERS = "p AS (SELECT entity, CASE WHEN pk % 3 = 0 AND pk > 0 THEN (pk // 3) * 2 + entity % 2 END AS into_ FROM co), w(entity, here, n) AS (SELECT entity, entity, 0 FROM p UNION ALL SELECT w.entity, p.into_, n + 1 FROM w JOIN p ON w.here = p.entity WHERE p.into_ IS NOT NULL), sv AS (SELECT entity, arg_max(here, n) AS survivor FROM w GROUP BY entity)"


def _pointers(co: DataFrame) -> DataFrame:
    return co.select("entity", F.when((F.col("pk") % 3 == 0) & (F.col("pk") > 0), F.floor(F.col("pk") / 3) * 2 + F.col("entity") % 2).alias("merged_into"))


@query("company_survivor", "SELECT * FROM sv", POINTERS, reads=["entity", "pk"])
def _(co):
    return identity.survivors(_pointers(co))


@query("identifier_survivor", "SELECT type, value, id.entity, survivor, survivor <> id.entity AS on_tombstone FROM id JOIN sv ON id.entity = sv.entity", POINTERS, reads=KEYED)
def _(co):
    return identity.identifier_survivors(_ids(co), identity.survivors(_pointers(co))).select("type", "value", "entity", "survivor", "on_tombstone")


ONE = "ow AS (SELECT type, value, min(entity) AS entity FROM id GROUP BY type, value HAVING count(DISTINCT entity) = 1)"
OWN = "ow AS (SELECT type, value, min(entity) AS entity FROM id WHERE source = 'supp' GROUP BY type, value HAVING count(DISTINCT entity) = 1)"


@query("unique_owner_lookup", "SELECT * FROM ow", ONE, reads=KEYED)
def _(co):
    return identity.unique_owner(_ids(co))


@query("multi_key_lookup", "SELECT c.pk, CASE WHEN a.entity IS NULL AND b.entity IS NULL THEN 'unlinked' WHEN a.entity <> b.entity THEN 'ambiguous' ELSE 'linked' END AS status, CASE WHEN a.entity <> b.entity THEN NULL ELSE coalesce(a.entity, b.entity) END AS found FROM co c LEFT JOIN ow a ON a.type = 'domain' AND a.value = c.domain LEFT JOIN ow b ON b.type = 'linkedin' AND b.value = c.linkedin WHERE c.source = 'cust'", OWN, reads=KEYED)
def _(co):
    owners = identity.unique_owner(_ids(co).filter("source = 'supp'"))
    rows = identity.lookup(co.filter("source = 'cust'").select("pk", "domain", "linkedin"), owners, TYPES)
    return rows.select("pk", "status", F.col("entity").alias("found"))


INDEX = "ix AS (SELECT 'domain' AS kind, domain AS value, 'p' || (pk % 3) AS portal, pk AS deal FROM co WHERE source = 'supp' AND pk % 9 <> 0 UNION ALL SELECT 'linkedin', linkedin, 'p' || (pk % 3), pk FROM co WHERE source = 'supp' AND pk % 9 <> 0), hi AS (SELECT DISTINCT co.pk AS lead, kind, portal, deal FROM co JOIN ix ON (kind = 'domain' AND value = domain) OR (kind = 'linkedin' AND value = linkedin) WHERE source = 'cust')"


def _leads(co: DataFrame) -> tuple[DataFrame, DataFrame]:
    leads = co.filter("source = 'cust'").withColumn("lead", F.col("pk"))
    supp = co.filter("source = 'supp'")
    index = supp.select(F.explode(F.array(F.struct(F.lit("domain").alias("kind"), F.col("domain").alias("value")), F.struct(F.lit("linkedin").alias("kind"), F.col("linkedin").alias("value")))).alias("k"), F.concat(F.lit("p"), (F.col("pk") % 3).cast("string")).alias("portal"), F.col("pk").alias("deal"), (F.col("pk") % 9 == 0).alias("is_archived"))
    return leads, index.select("k.kind", "k.value", "portal", "deal", "is_archived")


#: What is read of a company that is a lead or a deal.
FOUND = ["source", "pk", "domain", "linkedin"]


# pairs are many times the companies, so they aren't staged: they go to whoever reads them, as they are made of two narrow tables, which stay
@query("dedup_leads", "SELECT * FROM hi", INDEX, once=True, reads=FOUND)
def _(co):
    leads, index = _leads(co)
    return gates.dedup_hits(staged(leads.select("lead", "domain", "linkedin"), "leads", keep=True), staged(index, "deals", keep=True), dict(TYPES))


@query("dedup_explain", "SELECT lead, count(*) AS hits, array_to_string(list_sort(list(DISTINCT portal || ':' || kind || ':' || deal))[1:3], ' ') AS why FROM hi GROUP BY lead", INDEX)
def _(co):
    return gates.dedup_explain(*_leads(co), dict(TYPES))


# Deals, their companies and contacts, and leads with raw values of all five kinds.
FIVE = {
    "dl": "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'p0' ELSE 'p1' END AS portal, o_orderkey AS deal, CASE WHEN o_orderkey % 2 = 0 THEN '  Unit  ' || o_custkey ELSE 'unit ' || o_custkey END AS name, CASE WHEN o_orderkey % 4 = 0 THEN 'HTTPS://www.d' || o_custkey || '.example/x' END AS domain, o_orderkey % 9 = 0 AS is_archived FROM {orders}",
    "dc": "SELECT o_orderkey AS deal, CASE WHEN o_orderkey % 5 = 0 THEN 'e' || o_custkey || '.example' END AS domain, CASE WHEN o_orderkey % 7 = 0 THEN 'not a host' ELSE 'D' || (o_custkey + 1) || '.example' END AS other_domain FROM {orders} WHERE o_orderkey % 3 = 1",
    "ct": "SELECT o_orderkey AS deal, CASE WHEN o_orderkey % 2 = 0 THEN ' A' || o_custkey || '@X.example' END AS email, CASE WHEN o_orderkey % 3 = 0 THEN 'https://x.example/in/P-' || o_custkey || '/' END AS linkedin, CASE WHEN o_orderkey % 4 = 1 THEN '098' || (10000000 + o_custkey) END AS phone, o_orderkey % 5 = 0 AS is_archived FROM {orders}",
    "ld": "SELECT c_custkey AS lead, 'd' || c_custkey || '.example' AS domain, 'a' || (c_custkey + 2) || '@x.example' AS email, 'in/p-' || (c_custkey + 4) AS linkedin, '+9198' || (10000000 + c_custkey + 6) AS phone, 'UNIT ' || (c_custkey + 8) AS name FROM {customer} WHERE c_custkey % 10 = 0",
}
FIVE_SQL = f"""WITH {', '.join(f'{n} AS ({model.duck(t)})' for n, t in FIVE.items())},
ix AS (SELECT portal, deal, 'name' AS kind, regexp_replace(lower(trim(name)), '\\s+', ' ', 'g') AS value FROM dl WHERE NOT is_archived UNION SELECT portal, deal, 'domain', regexp_extract(lower(domain), '(d[0-9]+\\.example)', 1) FROM dl WHERE NOT is_archived AND domain IS NOT NULL
UNION SELECT portal, dl.deal, 'domain', dc.domain FROM dl JOIN dc ON dl.deal = dc.deal WHERE NOT is_archived AND dc.domain IS NOT NULL UNION SELECT portal, dl.deal, 'domain', lower(other_domain) FROM dl JOIN dc ON dl.deal = dc.deal WHERE NOT is_archived AND other_domain LIKE '%.example'
UNION SELECT portal, dl.deal, 'email', lower(trim(email)) FROM dl JOIN ct ON dl.deal = ct.deal WHERE NOT dl.is_archived AND NOT ct.is_archived AND email IS NOT NULL UNION SELECT portal, dl.deal, 'linkedin', regexp_extract(lower(linkedin), '(in/p-[0-9]+)', 1) FROM dl JOIN ct ON dl.deal = ct.deal WHERE NOT dl.is_archived AND NOT ct.is_archived AND linkedin IS NOT NULL
UNION SELECT portal, dl.deal, 'phone', '+91' || substr(phone, 2) FROM dl JOIN ct ON dl.deal = ct.deal WHERE NOT dl.is_archived AND NOT ct.is_archived AND phone IS NOT NULL),
pr AS (SELECT lead, 'domain' AS kind, domain AS value FROM ld UNION ALL SELECT lead, 'email', email FROM ld UNION ALL SELECT lead, 'linkedin', linkedin FROM ld UNION ALL SELECT lead, 'phone', phone FROM ld UNION ALL SELECT lead, 'name', lower(name) FROM ld)
SELECT lead, pr.kind, portal, deal FROM pr JOIN ix ON pr.kind = ix.kind AND pr.value = ix.value"""


def _dedup_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    deals, sites, people, leads = (model.derived(spark, sf_dir, t) for t in FIVE.values())
    normal = leads.withColumns({"domain": norm.domain(F.col("domain")), "email": norm.email(F.col("email")), "linkedin": norm.linkedin_person(F.col("linkedin")), "phone": norm.phone_e164(F.col("phone")), "name": norm.company_name(F.col("name"))})
    return gates.dedup_hits(normal, gates.deal_index(deals, sites, people), {k: k for k in ("domain", "email", "linkedin", "phone", "name")})


QUERIES["dedup_leads_by_contact"], SQL["dedup_leads_by_contact"] = _dedup_five, FIVE_SQL


BLOCKS = "bl AS (SELECT 'domain' AS kind, domain AS value, pk % 2 = 0 AS is_active, CASE WHEN pk % 10 = 0 THEN DATE '2024-01-01' END AS expires FROM co WHERE source = 'supp' AND domain IS NOT NULL)"


def _blocks(co: DataFrame) -> DataFrame:
    own = co.filter("source = 'supp' AND domain IS NOT NULL")
    return own.select(F.lit("domain").alias("kind"), F.col("domain").alias("value"), (F.col("pk") % 2 == 0).alias("is_active"), F.when(F.col("pk") % 10 == 0, F.lit("2024-01-01").cast("date")).alias("expires"))


@query("suppression_check", "SELECT pk AS lead, CASE WHEN domain IN (SELECT value FROM bl WHERE is_active AND (expires IS NULL OR expires > DATE '2024-01-20')) THEN 'suppressed' WHEN trim(raw_domain) <> '' AND domain IS NULL THEN 'unnormalisable' ELSE 'clear' END AS status FROM co WHERE source = 'cust'", BLOCKS)
def _(co):
    return gates.suppression(_leads(co)[0], _blocks(co), {"domain": "domain"}, {"domain": "raw_domain"}, "2024-01-20")


@query("campaign_gate", "SELECT lead, CASE WHEN key IS NULL THEN 'no_key' WHEN n > 1 THEN 'duplicate_in_file' WHEN test THEN 'test_lead' WHEN bad THEN 'no_phone' ELSE 'ok' END AS status FROM (SELECT pk AS lead, coalesce(linkedin, domain) AS key, row_number() OVER (PARTITION BY coalesce(linkedin, domain) ORDER BY pk) AS n, pk % 50 = 0 AS test, raw_phone = 'none' AS bad FROM co WHERE source = 'cust')", once=True)
def _(co):
    leads = staged(_leads(co)[0].select("lead", F.coalesce("linkedin", "domain").alias("key"), F.col("pk").alias("row"), "raw_phone"), "leads")
    return gates.campaign_gate(leads, [("test_lead", F.col("lead") % 50 == 0), ("no_phone", F.col("raw_phone") == "none")])


@query("round_robin_assignment", "SELECT pk, 'rep' || ((row_number() OVER (PARTITION BY country ORDER BY pk) - 1) % 3) AS rep FROM co WHERE source = 'cust'", once=True)
def _(co):
    return gates.round_robin(co.filter("source = 'cust'").select("pk", "country"), "country", ["pk"], ["rep0", "rep1", "rep2"]).select("pk", "rep")


@query("rebalance_plan", "SELECT p.pk, d.pk AS needer FROM (SELECT pk, country, row_number() OVER (PARTITION BY country ORDER BY pk) AS n FROM co WHERE source = 'cust') p JOIN (SELECT pk, country, sum(pk % 4) OVER (PARTITION BY country ORDER BY pk) AS hi, sum(pk % 4) OVER (PARTITION BY country ORDER BY pk) - pk % 4 AS lo FROM co WHERE source = 'supp') d ON p.country = d.country AND n > lo AND n <= hi")
def _(co):
    pool = co.filter("source = 'cust'").select("pk", "country")
    need = co.filter("source = 'supp'").select(F.col("pk").alias("needer"), "country", (F.col("pk") % 4).alias("need"))
    return take_by_demand(pool, need, ["country"], [F.col("pk")], [F.col("needer")], "need").select("pk", "needer")


@query("import_block_list", "SELECT n.kind, n.value, lists, CASE WHEN active IS NULL THEN 'insert' WHEN active THEN 'present' ELSE 'reactivate' END AS action FROM (SELECT 'domain' AS kind, domain AS value, count(DISTINCT pk % 4) AS lists FROM co WHERE source = 'cust' AND domain IS NOT NULL GROUP BY domain) n LEFT JOIN (SELECT kind, value, bool_or(is_active) AS active FROM bl GROUP BY ALL) o ON n.kind = o.kind AND n.value = o.value", BLOCKS)
def _(co):
    own = co.filter("source = 'cust' AND domain IS NOT NULL").select(F.lit("domain").alias("kind"), F.col("domain").alias("value"), (F.col("pk") % 4).alias("list"))
    return gates.block_list(own, _blocks(co))
