"""Text functions: Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units in quantity texts.
UNITS = {"million": 1e6, "billion": 1e9}


def parse_quantity(text: Column) -> Column:
    """'1.2 million gallons' -> 1200000.0; 'TBD' and 'Ongoing' -> -1.0; null and anything unreadable -> null."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(text, "gallons", ""), ",", ""))
    number = F.regexp_extract(bare, r"([0-9.]+)\s?(million|billion)", 1)
    factor = F.when(F.contains(bare, F.lit("million")), UNITS["million"]).otherwise(UNITS["billion"])
    scaled = F.round(number.try_cast("double") * factor, 3)
    return F.when(F.contains(text, F.lit("TBD")) | F.contains(text, F.lit("Ongoing")), -1.0).when(number != "", scaled).otherwise(bare.try_cast("double"))


def parse_qualifier(text: Column) -> Column:
    """struct(value, qualifier, original) of a censored reading: '<5' -> (5, '<', '<5').

    Removed in turn: '<=', '<', '>'; the last one found is the qualifier. What is left, if empty, gives a null value and
    keeps the qualifier; if no number, a null value and an empty qualifier.
    """
    qualifier = F.when(F.contains(text, F.lit(">")), ">").when(F.contains(F.replace(text, F.lit("<="), F.lit("")), F.lit("<")), "<").when(F.contains(text, F.lit("<=")), "<=").otherwise("")
    bare = F.trim(F.regexp_replace(text, "<=|<|>", ""))
    value = bare.try_cast("double")
    kept = F.when((bare != "") & value.isNull(), "").otherwise(qualifier)
    return F.struct(value.alias("value"), kept.alias("qualifier"), text.alias("original"))


def spill_status(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("Ongoing")), "Ongoing").otherwise("Completed")


def map_lookup(code: Column, labels: dict) -> Column:
    """The label of a code; unknown codes give null."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.element_at(F.create_map(*pairs), code)


def title_case(text: Column) -> Column:
    """A capital after every character that is no letter, as in "O'Neil-X"; all other letters small."""
    parts = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def name_or_title(name: Column, fallback: Column) -> Column:
    """``name`` unless it is null or blank, else ``fallback`` in title case."""
    return F.when(F.trim(name) != "", name).otherwise(title_case(fallback))


def ascii_fold(text: Column) -> Column:
    """Deletes what is not ASCII."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def composite_key(*parts: Column) -> Column:
    """Parts joined by '_'; null if any is null."""
    joined = [parts[0].cast("string")]
    for p in parts[1:]:
        joined += [F.lit("_"), p.cast("string")]
    return F.concat(*joined)


def split_once(text: Column, separator: str = " ") -> Column:
    """struct(first, rest) around the first separator; rest is '' without one. ``separator`` is plain text."""
    at = F.instr(text, separator)
    return F.struct(
        F.when(at > 0, F.left(text, at - 1)).otherwise(text).alias("first"),
        F.when(at > 0, F.substring(text, at + len(separator), F.length(text))).when(text.isNotNull(), "").alias("rest"),
    )


def safe_file_name(text: Column) -> Column:
    return F.translate(text, " -,./", "_____")


STATUS_SINCE = r"(?i)<strong>\s*Status Since:\s*</strong>(?:\s|&nbsp;)*([A-Za-z]+ [0-9]{1,2}, [0-9]{4})"


def status_since(html: Column) -> Column:
    """'April 8, 2025' after a 'Status Since:' label, as 'Apr 8, 2025'; '' if there is none or it is no date."""
    found = F.try_to_timestamp(F.regexp_extract(html, STATUS_SINCE, 1), F.lit("MMMM d, yyyy"))
    return F.coalesce(F.date_format(found, "MMM d, yyyy"), F.lit(""))


def last_strong(html: Column) -> Column:
    """The text of the last <strong> element; '' without one."""
    found = F.regexp_extract_all(html, F.lit(r"(?s)<strong>(.*?)</strong>"), F.lit(1))
    return F.when(F.size(found) > 0, F.try_element_at(found, F.lit(-1))).otherwise("")


def strip_fragments(text: Column, fragments: list[tuple[str, str]]) -> Column:
    """Replaces each (fragment, replacement) of plain text in turn; null gives ''."""
    out = F.coalesce(text, F.lit(""))
    for fragment, replacement in fragments:
        out = F.replace(out, F.lit(fragment), F.lit(replacement))
    return out


def by_code(code: Column, **of: tuple[int, Column]) -> Column:
    """The column whose number equals the code; '' for other codes. ``of``: any name = (number, column)."""
    out = F.lit("")
    for number, column in reversed(list(of.values())):
        out = F.when(code == number, column).otherwise(out)
    return out


def html_links(html: Column) -> Column:
    """array<struct(href, text)> of the <a> elements in page order; the text has no markup, white space collapsed."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*?href=\"[^\"]*\"[^>]*>.*?</a>"), F.lit(0))

    def one(a: Column) -> Column:
        text = F.trim(F.regexp_replace(F.regexp_replace(a, r"(?s)<[^>]*>", ""), r"\s+", " "))
        return F.struct(F.regexp_extract(a, r"(?i)href=\"([^\"]*)\"", 1).alias("href"), text.alias("text"))

    return F.transform(found, one)


def text_after_marker(html: Column, marker: str) -> Column:
    """The rest of the text run that holds ``marker`` (plain text, any case), without markup; null if it is not there."""
    found = F.regexp_extract(html, rf"(?is)>[^<]*?\Q{marker}\E\s*([^<]*)<", 1)
    return F.when(F.contains(F.lower(html), F.lit(marker.lower())), F.trim(found))


def list_after_header(html: Column, header: str) -> Column:
    """Texts of the items of the first list behind a heading with this text (any case); null if there is none."""
    found = F.regexp_extract(html, rf"(?is)<h[1-6][^>]*>(?:\s|<[^>]*>)*\Q{header}\E(?:\s|<[^>]*>)*</h[1-6]>.*?<[uo]l[^>]*>(.*?)</[uo]l>", 1)
    items = F.regexp_extract_all(found, F.lit(r"(?is)<li[^>]*>(.*?)(?=</li>|<li[\s>]|\z)"), F.lit(1))
    plain = F.transform(items, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?s)<[^>]*>", ""), r"\s+", " ")))
    return F.when(found != "", plain)
