"""Wikitext functions as Column expressions.

All patterns run with Unicode classes and '\\n' as the only line end, as in the dump format's own tools.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U = "(?dU)"
#: Patterns of the wikitext constructs (fixed values). IMAGE takes its options as one run, which is the same language as a run of runs, without nested repetition.
LINK = U + r"\[\[([^|\]]+?)(?:\|[^\]]+)?\]\]"
CATEGORY = U + r"\[\[Category:([^|\]]+?)(?:\|[^\]]+)?\]\]"
IMAGE = r"(?dUiu)\[\[(?:File|Image):([^|\]]+?)(?:\|[^\]]*)?\]\]"
EXTERNAL = U + r"\[(https?://\S+?)(?:\s[^\]]+)?\]"
SECTION = r"(?dUm)^(={2,})\s*(.+?)\s*={2,}\s*$"
SEE_ALSO = r"(?dUmiu)^={2,}\s*See\s+also\s*={2,}\s*$"
NEXT_SECTION = r"(?dUm)^={2,}\s*[^=]"
#: Templates of disambiguation pages (fixed values).
DISAMBIGUATION = (
    "disambig(?:uation)?", "dab", "hndis", "geodis", "disamb", "surname", "given name", "human name disambiguation", "place name disambiguation",
    "hospital disambiguation", "airport disambiguation", "letter-numbercombdisambig", "school disambiguation", "road disambiguation",
    "biology disambiguation", "taxonomy disambiguation", "species latin name disambiguation", "mathematical disambiguation", "chemistry disambiguation", "music disambiguation",
)
#: Prefixes of link targets outside the article namespace (fixed values).
NAMESPACES = ("Category", "File", "Image", "Template", "Wikipedia", "Help", "Portal", "Draft", "User", "Module", "MediaWiki")
SPECIAL_PREFIXES = ("File:", "Category:", "Template:")


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def trimmed(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?dU)\A\s+|\s+\z", "")


def sanitized(x: Column) -> Column:
    """On one line: if x holds a line break, every run of white space becomes a space and the ends go; else x as it is."""
    return F.when(x.rlike(r"[\n\r]"), F.trim(F.regexp_replace(x, r"(?dU)\s+", " "))).otherwise(x)


def _names(text: Column, pattern: str) -> Column:
    return F.filter(F.transform(_all(text, pattern, 1), lambda x: sanitized(trimmed(x))), lambda x: x != "")


def page_type(redirect_to: Column, ns: Column, title: Column) -> Column:
    special = F.lit(False)
    for prefix in SPECIAL_PREFIXES:
        special = special | title.startswith(prefix)
    return F.when(redirect_to.isNotNull(), "Redirect").when(ns == 0, "Article").when(ns.isNotNull() | special, "Special").otherwise("Article")


def is_namespace_link(target: Column) -> Column:
    return target.rlike(rf"\A(?:{'|'.join(NAMESPACES)}):")


def without_anchor(target: Column) -> Column:
    return F.substring_index(target, "#", 1)


def links(text: Column) -> Column:
    """All link targets in order, as written."""
    return _all(text, LINK, 1)


def see_also_start(text: Column) -> Column:
    """Place (from 1) of the 'See also' header; 0 if there is none."""
    return F.regexp_instr(text, F.lit(SEE_ALSO))


def links_before_see_also(text: Column) -> Column:
    """How many of links(text) begin before the 'See also' header; null if there is no header.

    A link that begins before the header may end after it. At most one can, and it begins in the last '[[' stretch
    without ']' before the header.
    """
    at = see_also_start(text)
    before, after = F.substring(text, F.lit(1), at - 1), F.substr(text, at)
    open_end = F.regexp_extract(before, r"\[\[[^\]]*\z", 0)
    first = F.regexp_instr(F.concat(open_end, after), F.lit(LINK))
    straddles = (open_end != "") & (first >= 1) & (first <= F.length(open_end))
    return F.when(at > 0, F.size(_all(before, LINK, 1)) + straddles.cast("int"))


def categories(text: Column) -> Column:
    return _names(text, CATEGORY)


def images(text: Column) -> Column:
    return _names(text, IMAGE)


def external_links(text: Column) -> Column:
    return _names(text, EXTERNAL)


def sections(text: Column) -> Column:
    return F.transform(_all(text, SECTION, 2), trimmed)


def see_also_links(text: Column) -> Column:
    """Targets between the 'See also' header and the next heading, trimmed."""
    at = see_also_start(text)
    rest = F.regexp_replace(F.substr(text, at), r"(?dUiu)\A={2,}\s*See\s+also\s*={2,}[^\S\n]*", "")
    end = F.regexp_instr(rest, F.lit(NEXT_SECTION))
    body = F.when(end > 0, F.substring(rest, F.lit(1), end - 1)).otherwise(rest)
    return F.when(at > 0, F.transform(_all(body, LINK, 1), trimmed)).otherwise(F.array().cast("array<string>"))


def is_disambiguation(text: Column) -> Column:
    return text.rlike(rf"(?dUiu)\{{\{{(?:{'|'.join(DISAMBIGUATION)})\b")


def lead(stripped: Column) -> Column:
    """The lines before the first heading of a text without templates, trimmed, without blank ones."""
    at = F.regexp_instr(stripped, F.lit(SECTION))
    head = F.when(at > 0, F.substring(stripped, F.lit(1), at - 1)).otherwise(stripped)
    return F.array_join(F.filter(F.transform(F.split(head, r"\r?\n"), trimmed), lambda x: x != ""), "\n")


def shard(page_id: Column, count: int) -> Column:
    return F.pmod(page_id, F.lit(count))


def is_shard_file(name: Column) -> Column:
    return name.rlike(r"(?s)\A.+_[0-9]{3}\.csv\z")


def escaped(x: Column) -> Column:
    """For a single-quoted literal of the store's query language."""
    return F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def format_size(n: Column, largest: str = "G") -> Column:
    """In the units B, K, M, G as far as ``largest``."""
    shown = F.concat(n.cast("string"), F.lit("B"))
    for power, unit in enumerate("KMG"[: "KMG".index(largest) + 1], 1):
        shown = F.when(n >= 1024**power, F.format_string(f"%.1f{unit}", n / float(1024**power))).otherwise(shown)
    return shown


def format_number(n: Column) -> Column:
    return F.format_number(n, 0)


def page_type_label(kind: Column, redirect_to: Column) -> Column:
    return F.when(kind == "Redirect", F.concat(F.lit("Redirect("), redirect_to, F.lit(")"))).otherwise(kind)
