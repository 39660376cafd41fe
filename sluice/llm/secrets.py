"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings per character class."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common

KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_mixed", "entropy_lower", "entropy_upper", "entropy_letters")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Character classes: the runs of a candidate that are scored, window, least bits a character, what a window has to hold.
CLASSES = {
    "entropy_hex": (re.compile(r"[0-9a-fA-F]{20,}"), 20, 2.9, ("digit", "lower or upper")),
    "entropy_mixed": (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.7, ("digit", "lower", "upper")),
    "entropy_lower": (re.compile(r"[a-z0-9]{20,}"), 20, 3.4, ("digit", "lower")),
    "entropy_upper": (re.compile(r"[A-Z0-9]{20,}"), 20, 3.4, ("digit", "upper")),
    # of random letters 91 % in 32 and 58 % in 20 reach this, of long names in mixed case in PySpark's sources some 6 %
    "entropy_letters": (re.compile(r"[A-Za-z]{20,}"), 20, 3.95, ("lower", "upper")),
}
#: The allow-list. Parts of a candidate that are no secrets are cut out of it, and what is left of it is scored: fillers, sequences,
#: identifiers of a fixed form, checksums that say so.
FILLERS = re.compile(
    r"(?i:x{4,}|0123456789|abcdefgh|(?<![0-9a-z])[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}(?![0-9a-z])|(?<![0-9a-z])(?:sha1|sha256|sha384|sha512|md5)[-_=][0-9a-z+/]+=*)"
)
#: A span that holds one of these words, or is a path of short lower-case names, is dropped, and no other span with it.
ALLOWED = re.compile(r"(?i:example|placeholder|dummy|changeme)|^/?(?:[a-z0-9_=-]{0,19}/)+[a-z0-9_=-]{0,19}$")
#: Texts in which nothing can be found fail this (RE2) and are not looked at further.
ANY = r"(?i)password|passwd|secret|token|api_?key|AKIA|[0-9a-z+/_=-]{20}"


def entropy_windows(text: str, window: int, least: float, needs: tuple[str, ...]) -> list[tuple[int, int]]:
    """The spans that windows of at least `least` bits a character cover; a window also holds characters of each class in `needs`.

    One pass: a step adds a character's count and takes one off, and with them its share of the sum of n log n.
    """
    term = [0.0] + [n * math.log2(n) for n in range(1, window + 2)]
    kinds = ["digit" if c.isdigit() else "lower" if c.islower() else "upper" if c.isupper() else "other" for c in text]
    counts: dict[str, int] = {}
    held = {"digit": 0, "lower": 0, "upper": 0, "other": 0}
    total, spans = 0.0, []
    most = math.log2(window)
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        held[kinds[i]] += 1
        if i >= window:
            out = text[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += term[n - 1] - term[n]
            held[kinds[i - window]] -= 1
        if i >= window - 1 and most - total / window >= least and all(any(held[k] for k in need.split(" or ")) for need in needs):
            start = i - window + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((start, i + 1))
    return spans


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind: the fixed patterns' matches, and entropy spans of what lies between them."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    taken = _merged([(s, e) for _, s, e in found])
    starts = [s for s, _ in taken]
    for candidate in CANDIDATE.finditer(text):
        own = taken[max(0, bisect_right(starts, candidate.start()) - 1) : bisect_right(starts, candidate.end())]
        fillers = [m.span() for m in FILLERS.finditer(text, candidate.start(), candidate.end())]
        own = _merged(own + fillers) if fillers else own
        for kind, (runs, window, least, needs) in CLASSES.items():
            spans = []
            for start, end in _between(own, candidate.start(), candidate.end()):
                for run in runs.finditer(text, start, end):
                    spans += [(run.start() + s, run.start() + e) for s, e in entropy_windows(run[0], window, least, needs)]
            if spans:
                found += [(kind, *span) for span in spans if not ALLOWED.search(text[slice(*span)])]
                own = _merged(own + spans)
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _between(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """What the spans, in order and apart, leave of start to end."""
    out = []
    for s, e in spans:
        if start < s:
            out.append((start, min(s, end)))
        start = max(start, e)
    return [*out, (start, end)] if start < end else out


SCHEMA = "doc_id long, secrets array<struct<kind:string,start:int,end:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        texts = pc.fill_null(batch.column("text"), "")
        maybe = pc.match_substring_regex(texts, ANY).to_pylist()
        rows = [[dict(zip(("kind", "start", "end"), f, strict=True)) for f in find_secrets(text.as_py())] if m else [] for text, m in zip(texts, maybe, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, of)], ["doc_id", "secrets"])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and `secrets`, an array of (kind, start, end), for every row of docs.

    Fixed patterns come first and stay. Then candidate strings, runs of 20 and more letters, digits and + / _ = -, are scored
    in each character class by the entropy of every window of 20 characters; the windows above the class's threshold, merged,
    are spans. A fixed pattern's match, what FILLERS match, and a span of an earlier class, is cut out of the candidate and what
    is left of it is scored; a span that ALLOWED matches is dropped, by itself. Whole texts are scanned, of any length in time
    in proportion to it; null and empty ones have no spans; rows that repeat are scanned alike; an empty table gives no rows. Each row is scanned alone, in a narrow stage without a shuffle. Columns besides doc_id
    and text are not read.
    """
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).mapInArrow(_scan, SCHEMA)


def is_kind(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def joined_spans(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    chosen = F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    with common.small_batches(spark):
        rows = common.staged(scan_secrets(common.documents(spark, sf_dir)), "secrets")
    counts = [F.size(F.filter("secrets", is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return rows.select("doc_id", *counts, F.sha2(joined_spans(KINDS[:3]), 256).alias("base_sha256"), joined_spans(KINDS).alias("spans"))
