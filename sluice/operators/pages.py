"""Crawled pages: links, site status, addresses, signals, scores, and search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import text as tx
from sluice.functions.norm import strip_accents, without_accents
from sluice.functions.ranks import placed


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, site, text, length."""
    rows = pages.select("page_id", tx.host(F.col("url")).alias("site"), tx.visible_text(F.col("html")).alias("text"))
    return rows.withColumn("length", F.length("text"))


def page_links(pages: DataFrame, kinds: list[tuple[str, str]], most: int = 8) -> DataFrame:
    """page_id, place, link, kind: the first links of a page, distinct, ordered by kind, then by where they stand."""
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"#]+)"'), 1)
    rows = pages.select("page_id", F.posexplode(hrefs).alias("pos", "link")).filter(F.col("link").startswith("/"))
    rank = F.lit(len(kinds))
    for i, (_, pattern) in reversed(list(enumerate(kinds))):
        rank = F.when(F.col("link").rlike(f"(?i){pattern}"), i).otherwise(rank)
    first = rows.groupBy("page_id", "link").agg(F.min("pos").alias("pos")).withColumn("rank", rank)
    names = F.element_at(F.array(*[F.lit(k) for k, _ in kinds], F.lit("other")), F.col("rank") + 1)
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("rank", "pos"))
    return first.select("page_id", place.alias("place"), "link", names.alias("kind")).filter(F.col("place") <= most)


def site_status(texts: DataFrame, parked: str, thin: int = 800) -> DataFrame:
    """site, pages, length, status: parked if a page says so, thin below `thin` characters over its pages, else crawled."""
    rows = texts.groupBy("site").agg(F.count("*").alias("pages"), F.sum("length").alias("length"), F.max(F.col("text").rlike(f"(?i){parked}")).alias("parked"))
    return rows.select("site", "pages", "length", F.when(F.col("parked"), "parked").when(F.col("length") < thin, "thin").otherwise("crawled").alias("status"))


def emails(texts: DataFrame, key: str) -> DataFrame:
    """key, email, n: distinct addresses in texts, with [at] read as @; image names and placeholder domains are no addresses."""
    spelt = F.regexp_replace(F.lower("text"), r"\s*[\[(]\s*at\s*[\])]\s*", "@")
    found = F.regexp_extract_all(spelt, F.lit(r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}"), 0)
    rows = texts.select(key, F.explode(found).alias("email"))
    return rows.filter(~F.col("email").rlike(r"\.(png|jpg|gif|svg|webp)$")).groupBy(key, "email").agg(F.count("*").alias("n"))


def best_text(texts: DataFrame, key: str, order: str, first: int = 1500, rest: int = 800, most: int = 4200, pages: int = 6) -> DataFrame:
    """key, excerpt: the start of the key's longest page, then less of the next ones, `most` characters in all."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col("length").desc(), order))
    top = texts.withColumn("place", place).filter(F.col("place") <= pages)
    cut = F.when(F.col("place") == 1, F.substring("text", 1, first)).otherwise(F.substring("text", 1, rest))
    joined = top.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", cut.alias("t")))).alias("p"))
    return joined.select(key, F.substring(F.array_join(F.transform("p", lambda p: p["t"]), "\n"), 1, most).alias("excerpt"))


def signals(texts: DataFrame, key: str, families: dict[str, str]) -> DataFrame:
    """key and the count of each family's terms."""
    return texts.select(key, *[c.alias(n) for n, c in tx.term_counts(F.col("text"), families).items()]).groupBy(key).agg(*[F.sum(n).alias(n) for n in families])


def score(rows: DataFrame, points: list[tuple[Column, int]], base: int = 20) -> DataFrame:
    """rows with score, clamped to 0..100, and bucket."""
    total = F.lit(base)
    for hit, p in points:
        total = total + F.when(hit, p).otherwise(0)
    rows = rows.withColumn("score", F.least(F.lit(100), F.greatest(F.lit(0), total)))
    return rows.withColumn("bucket", F.when(F.col("score") >= 70, "P1").when(F.col("score") >= 50, "P2").when(F.col("score") >= 30, "P3").otherwise("P4"))


def rank_in_tier(rows: DataFrame, tier: str, value: str, tie: str) -> DataFrame:
    """rows with rank from 1 in their tier, the largest value first; a tier of any size spreads over ranges of its values."""
    return placed(rows, [tier], [F.col(value).desc(), F.col(tie)], "rank").withColumn("rank", F.col("rank") + 1)


def batches(rows: DataFrame, order: str, tie: str, size: int = 40) -> DataFrame:
    """rows with batch, from 0: `size` neighbours each in the order of all rows."""
    return placed(rows, [], [F.col(order), F.col(tie)], "_n").withColumn("batch", F.floor(F.col("_n") / size)).drop("_n")


def words(text: Column) -> Column:
    """The words of a text in lower case, accents off."""
    return F.regexp_extract_all(without_accents(F.lower(text)), F.lit(r"[\p{L}\p{N}]+"), 0)


def token_index(texts: DataFrame, key: str) -> DataFrame:
    """key, term, n of the terms of each text."""
    return texts.select(key, F.explode(words(F.col("text"))).alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))


def search(texts: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """key, hits of the texts that have all terms, accents and case ignored. Other words don't leave their row."""
    wanted = sorted({strip_accents(t.lower()) for t in terms})
    found = F.filter(words(F.col("text")), lambda w: w.isin(*wanted))
    rows = texts.select(key, F.explode(found).alias("term")).groupBy(key).agg(F.countDistinct("term").alias("found"), F.count("*").alias("hits"))
    return rows.filter(F.col("found") == len(wanted)).select(key, "hits")


SKIPPED_FILES = r"(?i)\.(pdf|png|jpe?g|gif|svg|zip|mp4)$"


def site_links(pages: DataFrame, kinds: list[tuple[str, str]], most: int = 8) -> DataFrame:
    """page_id, place, link, kind: the first links of a page to its own site (www or not), made absolute against the page's address, without fragment, distinct, ordered by kind, then by where they stand.

    Addresses are resolved as RFC 3986 has it. Links to the root, to files and of no kind are left out.
    """
    href = F.regexp_extract_all("html", F.lit('(?i)<a\\s[^>]*href="([^"]+)"'), 1)
    rows = pages.select("page_id", "url", F.posexplode(href).alias("pos", "raw")).withColumn("raw", F.regexp_replace(tx.decoded(F.trim("raw")), "#.*$", ""))
    rows = rows.filter("raw <> ''").withColumn("link", tx.resolved(F.col("url"), F.col("raw")))
    path = F.lower(F.regexp_extract("link", "^[a-zA-Z]+://[^/?#]+([^?#]*)", 1))
    rank = F.lit(None).cast("int")
    for i, (_, pattern) in reversed(list(enumerate(kinds))):
        rank = F.when(path.rlike(pattern), i).otherwise(rank)
    rows = rows.withColumn("rank", rank).filter((tx.host(F.col("link")) == tx.host(F.col("url"))) & F.col("rank").isNotNull() & ~path.rlike(SKIPPED_FILES) & ~path.isin("", "/"))
    first = rows.groupBy("page_id", "link").agg(F.min("pos").alias("pos"), F.min("rank").alias("rank"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy("rank", "pos"))
    names = F.element_at(F.array(*[F.lit(k) for k, _ in kinds]), F.col("rank") + 1)
    return first.select("page_id", place.alias("place"), "link", names.alias("kind")).filter(F.col("place") <= most)


def site_states(pages: DataFrame, parked: str, thin: int = 800) -> DataFrame:
    """site, pages, read, length, status: blocked if no page could be read (code below 200, 300 and above), parked if one says so, thin below `thin` characters, else crawled."""
    ok = F.coalesce(F.col("code").between(200, 299), F.lit(False))
    sums = pages.groupBy("site").agg(F.count("*").alias("pages"), F.count_if(ok).alias("read"), F.coalesce(F.sum(F.when(ok, F.col("length"))), F.lit(0)).alias("length"), F.coalesce(F.max(F.when(ok, F.col("text").rlike(f"(?i){parked}"))), F.lit(False)).alias("_parked"))
    status = F.when(F.col("read") == 0, "blocked").when(F.col("_parked"), "parked").when(F.col("length") < thin, "thin").otherwise("crawled")
    return sums.select("site", "pages", "read", "length", status.alias("status"))


# Local parts that stand for a role, from the most useful one; parts that say an address is none; endings of file names.
ROLES = ("info", "contact", "hello", "enquiry", "enquiries", "inquiry", "sales", "business", "support", "care", "admin", "hr", "careers", "office", "mail")
NO_PERSON = ("noreply", "no-reply", "donotreply", "example", "sentry", "wixpress", "user", "name", "yourname", "email", "test")
FILE_ENDS = (".png", ".jpg", ".jpeg", ".gif", ".svg", ".webp", ".css", ".js")


def hidden_addresses(html: Column) -> Column:
    """Addresses that pages hide in data-cfemail: hexadecimal bytes, each but the first XORed with the first."""
    byte = lambda h, i: F.conv(F.substring(h, 2 * i + 1, F.lit(2)), 16, 10).cast("int")
    decoded = lambda h: F.array_join(F.transform(F.sequence(F.lit(1), (F.length(h) / 2).cast("int") - 1), lambda i: F.char(byte(h, i).bitwiseXOR(byte(h, F.lit(0))))), "")
    found = F.filter(F.regexp_extract_all(html, F.lit('data-cfemail="([0-9a-f]+)"'), 1), lambda h: F.length(h) >= 4)
    return F.filter(F.transform(found, decoded), lambda e: e.contains("@"))


def site_addresses(pages: DataFrame, people: DataFrame) -> DataFrame:
    """site, email, score of a site's own addresses, hidden, spelt and coded ones: 0 and 1 are the person's (first and last name, first name alone), 10 and more a role's, 40 any other.

    pages: site, html; people: site, first, last. An address is the site's if its host is the site, in it or around it. The
    words of NO_PERSON and file names are no addresses.
    """
    spelt = F.regexp_replace(tx.decoded(F.col("html")), r"(?i)\s*[\[(]\s*at\s*[\])]\s*", "@")
    found = F.concat(hidden_addresses(F.col("html")), F.regexp_extract_all(spelt, F.lit(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), 0))
    rows = pages.select("site", F.explode(found).alias("email")).withColumn("email", F.lower(F.regexp_replace("email", r"^\.+|\.+$", ""))).distinct()
    local, host = F.split_part("email", F.lit("@"), F.lit(1)), F.split_part("email", F.lit("@"), F.lit(2))
    own = (host == F.col("site")) | host.endswith(F.concat(F.lit("."), "site")) | F.col("site").endswith(F.concat(F.lit("."), host))
    odd = F.lit(False)
    for word in NO_PERSON:
        odd = odd | local.contains(word)
    for end in FILE_ENDS:
        odd = odd | F.col("email").endswith(end)
    rows = rows.filter(own & ~odd).join(people.select(F.col("site").alias("_s"), "first", "last"), F.col("site") == F.col("_s"), "left")
    plain = lambda c: F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z]", "")
    f, l, lc = plain(F.col("first")), plain(F.col("last")), plain(local)
    both = (f != "") & (l != "")
    whole = both & (lc.isin(F.concat(f, l), F.concat(F.substring(f, 1, 1), l), F.concat(l, f), F.concat(f, F.substring(l, 1, 1))) | (lc == f) | (lc.contains(f) & lc.contains(l)))
    score = F.when(whole, 0).when((F.length(f) > 2) & (lc == f), 1)
    for i, role in enumerate(ROLES):
        score = score.when(lc.startswith(role), 10 + i)
    return rows.select("site", "email", score.otherwise(40).alias("score"))


def best_addresses(addresses: DataFrame, most: int = 4) -> DataFrame:
    """site, person (the best address of score 1 or less, the shortest of these) and others (the next few, joined)."""
    w = Window.partitionBy("site", F.col("score") <= 1).orderBy("score", F.length("email"), "email")
    ranked = addresses.withColumn("_r", F.row_number().over(w)).filter(((F.col("score") <= 1) & (F.col("_r") == 1)) | ((F.col("score") > 1) & (F.col("_r") <= most)))
    others = F.array_sort(F.collect_list(F.when(F.col("score") > 1, F.struct("_r", "email"))))
    return ranked.groupBy("site").agg(F.max(F.when(F.col("score") <= 1, F.col("email"))).alias("person"), F.array_join(F.transform(others, lambda x: x["email"]), ",").alias("others"))


# How pages say how many people a company has.
HEADCOUNTS = (r"team of (\d{2,4})", r"(\d{2,4})\+?\s*(?:employees|team members|people|professionals|engineers|experts)", r"over (\d{2,4})\s*(?:employees|team members)")


def headcount(texts: DataFrame, key: str) -> DataFrame:
    """key, headcount: the largest number from 5 to 20,000 that a text of the key gives as its staff."""
    found = F.concat(*[F.regexp_extract_all("text", F.lit(f"(?i){p}"), 1) for p in HEADCOUNTS])
    numbers = F.filter(F.transform(found, lambda x: x.cast("int")), lambda n: n.between(5, 20_000))
    return texts.groupBy(key).agg(F.max(F.array_max(numbers)).alias("headcount"))


def icp_outcome(companies: DataFrame, verdicts: DataFrame, allowed: DataFrame) -> DataFrame:
    """company, bucket, tier, score, outcome, rank of companies by their last verdict.

    A verdict counts if its batch was to judge the company (allowed: batch, company); of several the last by `at` does. A fit
    without a product of its own, or that sells services, is a maybe. The tier is by headcount. The score adds up what the
    verdict and the signals say, from 0 to 100. The rank is among fits and maybes of the tier, by score, then company. companies:
    company, status, tools, practices, artifacts, hiring, academic, headcount, decision_maker.
    """
    sure = verdicts.join(allowed, ["batch", "company"], "left_semi")
    last = sure.groupBy("company").agg(F.max_by(F.struct("icp", "confidence", "type", "own_product", "richness"), "at").alias("v"))
    rows = companies.join(last, "company", "left").select("*", "v.*")
    services = F.col("type").isin("services", "agency")
    bucket = F.when(F.col("icp") == "Fit", F.when(F.col("own_product") & ~F.coalesce(services, F.lit(False)), "Fit").otherwise("Maybe")).when(F.col("icp").isin("Maybe", "Out"), F.col("icp"))
    hc = F.col("headcount")
    tier = F.when(hc.isNull(), "unknown").when(hc.between(20, 500), "A").when(hc.between(501, 1000), "B").otherwise("excluded")
    rows = rows.withColumns({"bucket": bucket, "tier": tier})
    base = F.when(F.col("bucket") == "Fit", 60).when(F.col("bucket") == "Maybe", 30).otherwise(0)
    points = base + F.floor(F.coalesce("confidence", F.lit(0.0)) * 10) + 5 * F.least(F.coalesce("richness", F.lit(0)), F.lit(3)) + F.least(2 * F.col("tools"), F.lit(10)) + F.least(2 * F.col("practices"), F.lit(6)) + F.least(3 * F.col("artifacts"), F.lit(6))
    points = points + F.when(F.col("hiring") >= 2, 4).otherwise(0) - F.when(F.col("academic") >= 12, 10).otherwise(0) + F.when(F.col("decision_maker"), 5).otherwise(0)
    score = F.when(F.col("bucket").isNull(), 0).otherwise(F.least(F.lit(100), F.greatest(F.lit(0), points)))
    pending = F.when(F.col("icp").isNull(), F.when(F.col("status") == "crawled", "classify_pending").otherwise(F.col("status"))).when(F.col("icp") == "Unresolved", "domain_unresolved").when(F.col("bucket").isNull(), "classify_failed")
    out = F.concat(F.lit("out_"), F.when(F.col("type") == "academic", "academic").when(services, "services").otherwise("other"))
    size = F.when(F.col("tier").isin("A", "B"), F.concat(F.lit("_tier_"), "tier")).when(F.col("tier") == "excluded", "_excluded_size").otherwise("_unknown_headcount")
    rows = rows.withColumns({"score": score.cast("int"), "outcome": F.coalesce(pending, F.when(F.col("bucket") == "Out", out).otherwise(F.concat(F.lower("bucket"), size)))})
    good = rank_in_tier(rows.filter(F.col("bucket").isin("Fit", "Maybe")).select("company", "tier", "score"), "tier", "score", "company").select(F.col("company").alias("_c"), "rank")
    return rows.join(good, rows["company"] == good["_c"], "left").select("company", "bucket", "tier", "score", "outcome", "rank")
