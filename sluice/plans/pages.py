"""Queries over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import text as tx
from sluice.operators import pages as pg
from sluice.plans import model
from sluice.plans.model import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
#: Families of terms, each matched by whole words of letters and digits.
FAMILIES = {"the": "the", "ing": "[a-z]+ing", "and": "and|und|et|y", "digits": "[0-9]{3,}"}
KINDS = [("about", "^/th"), ("contact", "^/an"), ("team", "^/er")]


def _visible() -> str:
    s = "html"
    for tag in tx.HIDDEN:
        s = f"regexp_replace({s}, '<{tag}[^>]*>.*?</{tag}>', ' ', 'gis')"
    s = f"regexp_replace(regexp_replace({s}, '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g')"
    for name, char in tx.ENTITIES.items():
        q = "''''" if char == "'" else f"'{char}'"
        s = f"replace({s}, '{name}', {q})"
    return f"trim(regexp_replace({s}, '\\s+', ' ', 'g'))"


PT = rf"WITH pt AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)), '^www\.', '') AS site, text, length(text) AS length FROM (SELECT *, {_visible()} AS text FROM pages))"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


@query("visible_text", f"{PT} SELECT page_id, site, md5(text) AS text_md5, length FROM pt")
def _(spark, d):
    return pg.page_texts(table(spark, d, "pages")).select("page_id", "site", F.md5("text").alias("text_md5"), "length")


@query("page_links", "WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"#]+)\"', 1)) AS link, generate_subscripts(regexp_extract_all(html, 'href=\"([^\"#]+)\"', 1), 1) AS pos FROM pages), f AS (SELECT page_id, link, min(pos) AS pos FROM l WHERE starts_with(link, '/') GROUP BY ALL), k AS (SELECT *, CASE WHEN regexp_matches(link, '^/th', 'i') THEN 0 WHEN regexp_matches(link, '^/an', 'i') THEN 1 WHEN regexp_matches(link, '^/er', 'i') THEN 2 ELSE 3 END AS r FROM f) SELECT * FROM (SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY r, pos) AS INT) AS place, link, ['about', 'contact', 'team', 'other'][r + 1] AS kind FROM k) WHERE place <= 8")
def _(spark, d):
    return pg.page_links(table(spark, d, "pages"), KINDS)


@query("site_status", f"{PT} SELECT site, count(*) AS pages, CAST(sum(length) AS BIGINT) AS length, CASE WHEN bool_or(regexp_matches(text, 'domain is for sale', 'i')) THEN 'parked' WHEN sum(length) < 1500 THEN 'thin' ELSE 'crawled' END AS status FROM pt GROUP BY site")
def _(spark, d):
    return pg.site_status(pg.page_texts(table(spark, d, "pages")), "domain is for sale", 1500)


@query("extract_emails", r"SELECT doc_id, email, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(regexp_replace(lower(text), '\s*[\[(]\s*at\s*[\])]\s*', '@', 'g'), '[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}')) AS email FROM documents) WHERE NOT regexp_matches(email, '\.(png|jpg|gif|svg|webp)$') GROUP BY ALL")
def _(spark, d):
    return pg.emails(table(spark, d, "documents"), "doc_id")


@query("signal_counts", "SELECT doc_id, " + ", ".join(f"CAST(len(list_filter(w, lambda x: regexp_full_match(x, '{p}'))) AS BIGINT) AS \"{n}\"" for n, p in FAMILIES.items()) + " FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents)")
def _(spark, d):
    return pg.signals(table(spark, d, "documents"), "doc_id", FAMILIES)


@query("company_excerpt", f"{PT}, r AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY length DESC, page_id) AS n FROM pt) SELECT site, md5(substr(string_agg(CASE WHEN n = 1 THEN substr(text, 1, 1500) ELSE substr(text, 1, 800) END, chr(10) ORDER BY n), 1, 4200)) AS excerpt_md5 FROM r WHERE n <= 6 GROUP BY site")
def _(spark, d):
    return pg.best_text(pg.page_texts(table(spark, d, "pages")), "site", "page_id").select("site", F.md5("excerpt").alias("excerpt_md5"))


SCORE = "sc AS (SELECT l.doc_id, source, quality, least(100, greatest(0, 20 + CASE WHEN quality = 1 THEN 30 ELSE 0 END + CASE WHEN toxic = 1 THEN -40 ELSE 0 END + CASE WHEN n_chars > 1000 THEN 15 ELSE 0 END + CASE WHEN n_chars > 5000 THEN 15 ELSE 0 END)) AS score FROM labels l JOIN documents d ON l.doc_id = d.doc_id), sb AS (SELECT *, CASE WHEN score >= 70 THEN 'P1' WHEN score >= 50 THEN 'P2' WHEN score >= 30 THEN 'P3' ELSE 'P4' END AS bucket FROM sc)"


def _scored(spark, d):
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "doc_id")
    return pg.score(rows, [(F.col("quality") == 1, 30), (F.col("toxic") == 1, -40), (F.col("n_chars") > 1000, 15), (F.col("n_chars") > 5000, 15)])


@query("icp_score", f"WITH {SCORE} SELECT doc_id, score, bucket, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, doc_id) AS rank FROM sb")
def _(spark, d):
    rows = pg.rank_in_tier(_scored(spark, d), "bucket", "score", "doc_id").select("doc_id", "score", "bucket", "rank")
    return rows.withColumn("rank", F.col("rank").cast("long"))


@query("bucket_shares", f"WITH {SCORE} SELECT bucket, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS pct FROM sb GROUP BY bucket")
def _(spark, d):
    from pyspark.sql import Window

    rows = _scored(spark, d).groupBy("bucket").agg(F.count("*").alias("n"))
    return rows.withColumn("pct", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(0))), 2))


@query("corpus_summary", f"WITH {SCORE} SELECT source, count(DISTINCT doc_id) AS docs, count(*) FILTER (bucket = 'P1') AS p1, count(*) FILTER (bucket = 'P2') AS p2, round(avg(score), 3) AS mean FROM sb GROUP BY source")
def _(spark, d):
    return _scored(spark, d).groupBy("source").agg(F.countDistinct("doc_id").alias("docs"), F.count_if(F.col("bucket") == "P1").alias("p1"), F.count_if(F.col("bucket") == "P2").alias("p2"), F.round(F.avg("score"), 3).alias("mean"))


@query("token_index", "SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+')) AS term FROM documents) GROUP BY ALL")
def _(spark, d):
    return pg.token_index(table(spark, d, "documents"), "doc_id")


@query("full_text_search", "SELECT doc_id, CAST(count(*) AS BIGINT) AS hits FROM (SELECT doc_id, unnest(regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+')) AS term FROM documents) WHERE term IN ('the', 'then', 'er') GROUP BY doc_id HAVING count(DISTINCT term) = 3")
def _(spark, d):
    return pg.search(table(spark, d, "documents"), "doc_id", ["the", "Thén", "er"])


@query("thread_rollup", "SELECT conv_id, count(*) AS messages, min(turn) AS first_turn, max(turn) AS last_turn, arg_min(md5(text), turn) AS subject, count(*) FILTER (role = 'user') AS from_user FROM conversations GROUP BY conv_id")
def _(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("messages"), F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.min_by(F.md5("text"), "turn").alias("subject"), F.count_if(F.col("role") == "user").alias("from_user"))


#: Each page with links, addresses and staff numbers of its own after what it has.
MORE = """SELECT page_id, regexp_replace(url, '^https?://[^/]+', 'https://www.s' || page_id % 9 || '.example') AS url, 's' || page_id % 9 || '.example' AS site, CASE page_id % 5 WHEN 0 THEN 404 WHEN 1 THEN NULL ELSE 200 END AS code,
html || '<a class="x" href="/about?x=1#top">a</a><a href="https://s' || page_id % 9 || '.example/team/us">t</a><a href="//other.example/about">o</a><A HREF="contact.html">c</A><a href="/about?x=1">again</a><a href="/files/team.pdf">f</a><a href="/">root</a> Write to Jane.Doe [at] s' || page_id % 9 || '.example or info@mail.s' || page_id % 9 || '.example, x@other.example, noreply@s' || page_id % 9 || '.example, zed' || page_id % 4 || '@s' || page_id % 9 || '.example <span data-cfemail="422a27022a306c316c2735"></span> We are a team of ' || (page_id * 37) % 30000 || ' with 45+ engineers' AS html FROM {pages}"""
R = f"WITH r AS ({model.duck(MORE)})"


@query("site_links", R + """, l AS (SELECT DISTINCT page_id, unnest([{'n': 0, 'link': 'https://www.s' || page_id % 9 || '.example/about?x=1', 'kind': 'about'}, {'n': 1, 'link': regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[^/]*$', '') || '/contact.html', 'kind': 'contact'}, {'n': 2, 'link': 'https://s' || page_id % 9 || '.example/team/us', 'kind': 'team'}], recursive := true) FROM r) SELECT page_id, CAST(n + 1 AS INT) AS place, link, kind FROM l""")
def _(spark, d):
    return pg.site_links(model.derived(spark, d, MORE).withColumn("html", F.regexp_replace("html", "(?s)^.*(?=<a class=.x.)", "")), [("about", "^/about"), ("contact", "contact"), ("team", "^/team")])


# The examples of RFC 3986, section 5.4, of references in http://a/b/c/d;p?q.
RFC = [
    ("g:h", "g:h"), ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"), ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q#s"),
    ("g#s", "http://a/b/c/g#s"), ("g?y#s", "http://a/b/c/g?y#s"), (";x", "http://a/b/c/;x"), ("g;x", "http://a/b/c/g;x"), ("g;x?y#s", "http://a/b/c/g;x?y#s"), ("", "http://a/b/c/d;p?q"), (".", "http://a/b/c/"), ("./", "http://a/b/c/"),
    ("..", "http://a/b/"), ("../", "http://a/b/"), ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../", "http://a/"), ("../../g", "http://a/g"), ("../../../g", "http://a/g"), ("../../../../g", "http://a/g"), ("/./g", "http://a/g"),
    ("/../g", "http://a/g"), ("g.", "http://a/b/c/g."), (".g", "http://a/b/c/.g"), ("g..", "http://a/b/c/g.."), ("..g", "http://a/b/c/..g"), ("./../g", "http://a/b/g"), ("./g/.", "http://a/b/c/g/"), ("g/./h", "http://a/b/c/g/h"),
    ("g/../h", "http://a/b/c/h"), ("g;x=1/./y", "http://a/b/c/g;x=1/y"), ("g;x=1/../y", "http://a/b/c/y"), ("g?y/./x", "http://a/b/c/g?y/./x"), ("g?y/../x", "http://a/b/c/g?y/../x"), ("g#s/./x", "http://a/b/c/g#s/./x"), ("g#s/../x", "http://a/b/c/g#s/../x"),
]


@query("resolved_links", f"WITH c AS ({model.values_sql(RFC, 'ref, target')}) SELECT page_id, ref, regexp_replace(target, '^http://a', 'http://a' || page_id) AS link FROM pages CROSS JOIN c")
def _(spark, d):
    refs = spark.sql(model.values_sql(RFC, "ref, target"))
    rows = model.table(spark, d, "pages").join(F.broadcast(refs.select("ref")))  # a fixed list of references a page
    return rows.select("page_id", "ref", tx.resolved(F.format_string("http://a%d/b/c/d;p?q", "page_id"), F.col("ref")).alias("link"))


CODED = "SELECT page_id, 's' || page_id % 9 || '.example' AS site, '<p>jane&#46;doe&#x40;s' || page_id % 9 || '.example, p' || page_id || '&commat;s' || page_id % 9 || '.example &bogus; &amp;#64; &#1114112;</p>' AS html FROM {pages}"


@query("coded_addresses", "SELECT DISTINCT 's' || page_id % 9 || '.example' AS site, unnest(['jane.doe@s' || page_id % 9 || '.example', 'p' || page_id || '@s' || page_id % 9 || '.example']) AS email FROM pages")
def _(spark, d):
    nobody = spark.sql("SELECT CAST(NULL AS STRING) AS site, CAST(NULL AS STRING) AS first, CAST(NULL AS STRING) AS last")
    return pg.site_addresses(model.derived(spark, d, CODED), nobody).select("site", "email")


@query("site_states", R + f", t AS (SELECT r.site, code, {_visible().replace('html', 'r.html')} AS text FROM r) SELECT site, count(*) AS pages, count(*) FILTER (code = 200) AS read, CAST(coalesce(sum(length(text)) FILTER (code = 200), 0) AS BIGINT) AS length, CASE WHEN count(*) FILTER (code = 200) = 0 THEN 'blocked' WHEN coalesce(bool_or(regexp_matches(text, 'domain is for sale', 'i')) FILTER (code = 200), false) THEN 'parked' WHEN sum(length(text)) FILTER (code = 200) < 8000 THEN 'thin' ELSE 'crawled' END AS status FROM t GROUP BY site")
def _(spark, d):
    rows = model.derived(spark, d, MORE).withColumn("text", tx.visible_text(F.col("html")))
    return pg.site_states(rows.withColumn("length", F.length("text")), "domain is for sale", 8000)


PEOPLE_SQL = "SELECT DISTINCT 's' || page_id % 9 || '.example' AS site, CASE WHEN page_id % 9 < 5 THEN 'Jane' ELSE 'Zed' END AS first, 'Doe' AS last FROM {pages}"


def _addresses(spark, d):
    rows = model.derived(spark, d, MORE).withColumn("html", F.regexp_replace("html", "(?s)^.*(?=<a class=.x.)", ""))
    return pg.site_addresses(rows, model.derived(spark, d, PEOPLE_SQL))


ADDRESSES = ", a AS (SELECT DISTINCT site, unnest(['jane.doe@' || site, 'info@mail.' || site, 'zed' || page_id % 4 || '@' || site]) AS email FROM r), sc AS (SELECT site, email, CASE WHEN starts_with(email, 'jane') AND CAST(substr(site, 2, 1) AS INT) < 5 THEN 0 WHEN starts_with(email, 'zed') AND CAST(substr(site, 2, 1) AS INT) >= 5 THEN 0 WHEN starts_with(email, 'info') THEN 10 ELSE 40 END AS score FROM a)"


@query("site_addresses", R + ADDRESSES + " SELECT * FROM sc")
def _(spark, d):
    return _addresses(spark, d)


@query("best_addresses", R + ADDRESSES + ", k AS (SELECT *, row_number() OVER (PARTITION BY site, score <= 1 ORDER BY score, length(email), email) AS n FROM sc) SELECT site, max(email) FILTER (score <= 1 AND n = 1) AS person, coalesce(string_agg(email, ',' ORDER BY n) FILTER (score > 1 AND n <= 4), '') AS others FROM k GROUP BY site")
def _(spark, d):
    return pg.best_addresses(_addresses(spark, d))


@query("hidden_addresses", "SELECT page_id, 'p' || page_id || '@h.example' AS email FROM pages")
def _(spark, d):
    hexed = lambda c: F.conv(c.cast("string"), 10, 16)
    text = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit("@h.example"))
    coded = F.transform(F.split(text, ""), lambda ch: F.lower(F.lpad(hexed(F.ascii(ch).bitwiseXOR(F.lit(66))), 2, "0")))
    rows = table(spark, d, "pages").select("page_id", F.concat(F.lit('<i data-cfemail="42'), F.array_join(F.filter(coded, lambda x: x != "42"), ""), F.lit('">')).alias("html"))
    return rows.select("page_id", F.get(pg.hidden_addresses(F.col("html")), F.lit(0)).alias("email"))


@query("site_headcount", R + " SELECT site, max(CASE WHEN (page_id * 37) % 30000 BETWEEN 45 AND 9999 THEN CAST((page_id * 37) % 30000 AS INT) ELSE 45 END) AS headcount FROM r GROUP BY site")
def _(spark, d):
    rows = model.derived(spark, d, MORE).withColumn("text", F.regexp_extract("html", "(We are a team of .*)$", 1))
    return pg.headcount(rows, "site")


ICP = {
    "c": "SELECT c_custkey AS company, CASE WHEN c_custkey % 3 = 0 THEN 'crawled' ELSE 'thin' END AS status, c_custkey % 7 AS tools, c_custkey % 5 AS practices, c_custkey % 4 AS artifacts, c_custkey % 3 AS hiring, c_custkey % 20 AS academic, CASE WHEN c_custkey % 6 > 0 THEN c_custkey * 13 % 1500 END AS headcount, c_custkey % 2 = 0 AS decision_maker FROM {customer}",
    "v": "SELECT o_custkey AS company, o_orderkey % 5 AS batch, o_orderkey AS at, CASE o_orderkey % 6 WHEN 0 THEN 'Fit' WHEN 1 THEN 'Fit' WHEN 2 THEN 'Maybe' WHEN 3 THEN 'Out' WHEN 4 THEN 'Unresolved' ELSE 'odd' END AS icp, CAST(o_orderkey % 11 AS DOUBLE) / 16 AS confidence, CASE o_orderkey % 4 WHEN 0 THEN 'services' WHEN 1 THEN 'academic' ELSE 'product' END AS type, o_orderkey % 3 > 0 AS own_product, o_orderkey % 5 AS richness FROM {orders}",
}


@query("icp_outcome", f"WITH c AS ({model.duck(ICP['c'])}), v AS ({model.duck(ICP['v'])}), l AS (SELECT company, unnest(arg_max({{'icp': icp, 'confidence': confidence, 'type': type, 'own_product': own_product, 'richness': richness}}, v.\"at\")) FROM v WHERE batch = company % 5 OR batch = 0 GROUP BY company), b AS (SELECT c.*, l.icp, l.type, l.confidence, l.richness, CASE WHEN icp = 'Fit' THEN CASE WHEN own_product AND type <> 'services' THEN 'Fit' ELSE 'Maybe' END WHEN icp IN ('Maybe', 'Out') THEN icp END AS bucket, CASE WHEN headcount IS NULL THEN 'unknown' WHEN headcount BETWEEN 20 AND 500 THEN 'A' WHEN headcount BETWEEN 501 AND 1000 THEN 'B' ELSE 'excluded' END AS tier FROM c LEFT JOIN l ON l.company = c.company), s AS (SELECT *, CASE WHEN bucket IS NULL THEN 0 ELSE CAST(least(100, greatest(0, CASE bucket WHEN 'Fit' THEN 60 WHEN 'Maybe' THEN 30 ELSE 0 END + floor(confidence * 10) + 5 * least(richness, 3) + least(2 * tools, 10) + least(2 * practices, 6) + least(3 * artifacts, 6) + CASE WHEN hiring >= 2 THEN 4 ELSE 0 END - CASE WHEN academic >= 12 THEN 10 ELSE 0 END + CASE WHEN decision_maker THEN 5 ELSE 0 END)) AS INT) END AS score FROM b) SELECT company, bucket, tier, score, CASE WHEN icp IS NULL THEN CASE WHEN status = 'crawled' THEN 'classify_pending' ELSE status END WHEN icp = 'Unresolved' THEN 'domain_unresolved' WHEN bucket IS NULL THEN 'classify_failed' WHEN bucket = 'Out' THEN 'out_' || CASE type WHEN 'academic' THEN 'academic' WHEN 'services' THEN 'services' ELSE 'other' END ELSE lower(bucket) || CASE tier WHEN 'A' THEN '_tier_A' WHEN 'B' THEN '_tier_B' WHEN 'excluded' THEN '_excluded_size' ELSE '_unknown_headcount' END END AS outcome, CASE WHEN bucket IN ('Fit', 'Maybe') THEN row_number() OVER (PARTITION BY tier, bucket IN ('Fit', 'Maybe') ORDER BY score DESC, company) END AS rank FROM s")
def _(spark, d):
    c, v = (model.derived(spark, d, ICP[k]) for k in "cv")
    allowed = c.select("company", F.explode(F.array_distinct(F.array(F.col("company") % 5, F.lit(0).cast("long")))).alias("batch"))
    return pg.icp_outcome(c, v, allowed)
