"""Column expressions over pages and texts."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose text is not for readers.
HIDDEN = ("script", "style", "nav", "footer", "noscript")
# Named characters that pages use.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def visible_text(html: Column) -> Column:
    """Text that a reader sees: hidden elements and comments out, tags to blanks, named characters decoded, blanks collapsed."""
    s = html
    for tag in HIDDEN:
        s = F.regexp_replace(s, f"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    s = F.regexp_replace(F.regexp_replace(s, "(?s)<!--.*?-->", " "), "<[^>]*>", " ")
    for name, char in ENTITIES.items():
        s = F.replace(s, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def host(url: Column) -> Column:
    """The host of an address, in lower case, without www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, "^[a-zA-Z]+://([^/?#:]+)", 1)), r"^www\.", "")


def term_counts(text: Column, families: dict[str, str]) -> dict[str, Column]:
    """How many words of a text, of letters and digits, each family's pattern matches as a whole, case ignored."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)
    matching = lambda pattern: F.filter(words, lambda w: w.rlike(f"^(?:{pattern})$"))
    return {name: F.size(matching(pattern)).cast("long") for name, pattern in families.items()}


def decoded(text: Column) -> Column:
    """text with character references as characters, once: named ones of HTML 4 and those by decimal or hexadecimal code; what is none stays."""
    names = F.create_map(*[F.lit(x) for name, code in (name2codepoint | {"commat": 64, "period": 46}).items() for x in (name, chr(code))])

    def one(p: Column) -> Column:
        name = F.regexp_extract(p, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z][a-zA-Z0-9]{1,31});", 1)
        number = F.when(F.lower(F.substring(name, 1, 2)) == "#x", F.conv(F.substr(name, F.lit(3)), 16, 10)).otherwise(F.substr(name, F.lit(2))).cast("int")
        is_char = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        numbered = F.when(is_char, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))
        char = F.when(name.startswith("#"), numbered).when(name != "", F.try_element_at(names, name))
        return F.coalesce(F.concat(char, F.substr(p, F.length(name) + 2)), F.concat(F.lit("&"), p))

    return F.array_join(F.transform(F.split(text, "&"), lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once, however often f has it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def without_dots(path: Column) -> Column:
    """A path without its . and .. segments: a fold over its parts with those that stay on a stack."""
    pop = lambda stack: F.slice(stack, F.lit(1), F.greatest(F.size(stack) - 1, F.lit(0)))
    step = lambda stack, p: F.when(p == "..", pop(stack)).when(p == ".", stack).otherwise(F.concat(stack, F.array(p)))

    def of(p: Column) -> Column:
        rooted = p.startswith("/")
        parts = F.split(F.when(rooted, F.substr(p, F.lit(2))).otherwise(p), "/")
        last = F.when(p.rlike(r"(^|/)\.\.?$"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        return F.concat(F.when(rooted, "/").otherwise(""), F.array_join(F.concat(F.aggregate(parts, F.array().cast("array<string>"), step), last), "/"))

    return _once(path, lambda p: F.when(F.contains(p, F.lit("/.")) | p.startswith("."), of(p)).otherwise(p))


def resolved(base: Column, reference: Column) -> Column:
    """The address that a reference in a document at `base` means, by RFC 3986, section 5.2."""
    names = ("scheme", "host", "path", "query", "fragment")
    parts = lambda url, of: [F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$", i + 1).alias(of + n) for i, n in enumerate(names)]

    def target(x: Column) -> Column:
        b, r = (lambda n: x[f"b_{n}"]), (lambda n: x[f"r_{n}"])
        beside = F.when((b("host") != "") & (b("path") == ""), F.concat(F.lit("/"), r("path"))).otherwise(F.concat(F.regexp_extract(b("path"), "^(.*/)?", 0), r("path")))
        own = (r("scheme") != "") | (r("host") != "")
        kept = ~own & (r("path") == "")
        path = F.when(kept, b("path")).otherwise(without_dots(F.when(own | r("path").startswith("/"), r("path")).otherwise(beside)))
        query = F.when(kept & (r("query") == ""), b("query")).otherwise(r("query"))
        return F.concat(F.when(r("scheme") != "", r("scheme")).otherwise(b("scheme")), F.when(own, r("host")).otherwise(b("host")), path, query, r("fragment"))

    return _once(F.struct(*parts(base, "b_"), *parts(reference, "r_")), target)
