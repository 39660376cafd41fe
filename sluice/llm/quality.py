"""Quality rules with host verdicts: failures by domain, rates shrunk by an empirical beta prior, verdicts joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common

SYMBOLS = "#*$%&|<>"
BLANK_CHARS = " \t\n\x0b\x0c\r"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: A host is rejected if its shrunk rate of failures, less so many standard deviations of the posterior beta, is above this.
MAX_HOST_RATE, DEVIATIONS = 0.8, 3.0


def with_features(docs: DataFrame, text: Column) -> DataFrame:
    """docs with the columns of FEATURES and base_failed, each computed inside the row with array functions.

    n_repeat_words: the hashes of all 3-word windows are compared as a set first; only where one comes twice are they
    sorted with their places, and the windows whose hash comes again are spelt and sorted by hash and words, so that equal ones stand side by side, and each repeated
    window adds the words that the repeated window before it doesn't have. Hashes only spare work: windows are equal if their
    words are. A null text gives null features but for a coalesced `text`; a text of any length is one row's arrays.
    """
    rows = docs.withColumn("_text", text)
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", f"[{common.BLANKS}]+"), ""))
    rows = rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    last = F.size("_words") - 3
    at = lambda i, k: F.get(F.col("_hashes"), i + k)
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)))
    rows = rows.withColumn("_windows", F.when(last >= 0, windows).otherwise(F.array().cast("array<bigint>")))
    word = lambda i, k: F.get(F.col("_words"), i + k)
    spelt = lambda i: F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2))
    # by hash and place first, so that only windows whose hash comes again are spelt
    numbered = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("_numbered", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), numbered))
    next_to = lambda j: F.get(F.col("_numbered"), j)["x"]
    again = F.filter("_numbered", lambda e, j: F.coalesce(next_to(j - 1) == e["x"], F.lit(False)) | F.coalesce(next_to(j + 1) == e["x"], F.lit(False)))
    rows = rows.withColumn("_sorted", F.sort_array(F.transform(again, lambda e: F.struct(e["x"].alias("x"), spelt(e["i"]).alias("w"), e["i"].alias("i")))))
    beside = lambda j: F.get(F.col("_sorted"), j)["w"]
    again = F.filter("_sorted", lambda e, j: F.coalesce(beside(j - 1) == e["w"], F.lit(False)) | F.coalesce(beside(j + 1) == e["w"], F.lit(False)))
    rows = rows.withColumn("_places", F.sort_array(F.transform(again, lambda e: e["i"])))
    added = F.transform("_places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), j + 1) - p, F.lit(3))))
    repeated = F.aggregate(added, F.lit(0), lambda a, b: a + b)
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{common.BLANKS}]"))
    rows = rows.withColumn("_lines", lines)
    rows = rows.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.translate("_text", BLANK_CHARS, "")).cast("long"),
            "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(repeated, F.lit(0)).cast("long"),
        }
    )
    rows = rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return rows.drop("_text", "_words", "_hashes", "_windows", "_numbered", "_sorted", "_places", "_lines")


def host_rates(rows: DataFrame) -> DataFrame:
    """host, n, failed, rate and deviation of each host, from rows of (host, base_failed); a null host is one of its own.

    rate and deviation are the mean and the standard deviation of the host's posterior beta. The prior beta has the mean and
    the variance, by moments, of the hosts' rates, each host weighing as its documents; the variance that chance alone gives
    a host of its size is taken off. A prior is worth no more documents than there are. A host of few documents moves little
    from the mean and stays uncertain; one law holds for hosts of every size.
    """
    hosts = rows.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed"))
    rate = F.col("failed") / F.col("n")
    sums = hosts.agg(F.sum("n").alias("all_n"), F.sum("failed").alias("all_failed"), F.sum(F.col("failed") * rate).alias("squares"), F.count("*").alias("hosts"))
    mean = F.col("all_failed") / F.col("all_n")
    spread = F.col("squares") / F.col("all_n") - mean * mean - mean * (1 - mean) * F.col("hosts") / F.col("all_n")
    most = F.col("all_n").cast("double")
    strength = F.when(spread > 0, F.greatest(F.lit(1.0), mean * (1 - mean) / spread - 1)).otherwise(most)
    prior = sums.select(mean.alias("mean"), F.least(most, strength).alias("strength"))
    shrunk = hosts.join(F.broadcast(prior)).withColumn("rate", (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength")))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("strength") + 1))
    return shrunk.select("host", "n", "failed", "rate", deviation.alias("deviation"))


def host_quality(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE, deviations: float = DEVIATIONS) -> DataFrame:
    """A row for each row of docs: _file, _row, doc_id, host, FEATURES, base_failed, kept.

    A document is dropped if it fails a rule itself, or if its host's shrunk rate of failing documents is surely above
    max_rate: still above it when `deviations` standard deviations of the host's posterior are taken off.
    Null and empty texts have no words, so they fail. Rows that repeat count as often as they come; an empty table gives no
    rows. The text is read once; what the rules found goes to the shared folder,
    is summed by host (partial sums first, so a hot host costs a row for each task), and only the rejected hosts are joined
    back. Columns besides doc_id, text and the host are not read.
    """
    placed = common.with_locator(docs, "doc_id", "text", host)
    rows = placed.select("_file", "_row", placed["doc_id"].cast("long").alias("doc_id"), placed[host].alias("host"), common.text_of(placed).alias("_body"))
    rows = common.staged(with_features(rows, F.col("_body")).drop("_body"), "quality-features")
    surely = F.col("rate") - F.lit(float(deviations)) * F.col("deviation") > F.lit(max_rate)
    rejected = common.staged(host_rates(rows).filter(surely).select(F.col("host").alias("bad")), "quality-hosts")
    rejected = common.bounded_broadcast(rejected).withColumn("rejected", F.lit(True))
    joined = rows.join(rejected, rows["host"].eqNullSafe(rejected["bad"]), "left")
    return joined.select("_file", "_row", "doc_id", "host", *FEATURES, "base_failed", (~F.col("base_failed") & F.col("rejected").isNull()).alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that host_quality keeps, all columns.

    Null, empty and short texts go, as do all rows of a rejected host; texts of any length are judged whole. Rows that repeat
    are judged alike and stay or go together. An empty table stays empty.
    """
    docs = common.filed(docs)
    placed = common.with_locator(docs)
    with common.scratch(docs.sparkSession):
        dropped = host_quality(docs, **settings).filter("NOT kept").select(F.col("_file").alias("_f"), F.col("_row").alias("_r"))
        dropped = common.staged(dropped, "quality-dropped", keep=True)
    dropped = common.bounded_broadcast(dropped)
    return placed.join(dropped, (placed["_file"] == dropped["_f"]) & (placed["_row"] == dropped["_r"]), "left_anti").select("_doc.*")


def op10_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality(common.documents(spark, sf_dir)).select("doc_id", *FEATURES, "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
g AS (SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
p AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM (SELECT *, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i) AS n FROM p GROUP BY r),
f AS (
  SELECT d.r, doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])::BIGINT
           - len(list_distinct([x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w ON d.r = w.r LEFT JOIN c ON d.r = c.r
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (base_failed)::DOUBLE AS k FROM b GROUP BY source),
s AS (SELECT sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) AS sq, count(*) / sum(n) AS hosts, sum(n) AS all_n FROM h),
t AS (SELECT mean, CASE WHEN sq - mean * mean - mean * (1 - mean) * hosts > 0 THEN least(all_n, greatest(1.0, mean * (1 - mean) / (sq - mean * mean - mean * (1 - mean) * hosts) - 1)) ELSE all_n END AS strength FROM s),
r AS (SELECT source, n, strength, (k + mean * strength) / (n + strength) AS rate FROM h, t),
v AS (SELECT source, rate - 3.0::DOUBLE * sqrt(rate * (1 - rate) / (n + strength + 1)) > 0.8 AS bad FROM r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT bad AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source
"""
