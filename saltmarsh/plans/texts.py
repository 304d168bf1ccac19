"""Queries: text functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.transform import transformed
from .catalogue import query

_QUANTITY = """SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 WHEN 0 THEN l_quantity::INT || ',000 gallons' WHEN 1 THEN l_quantity::INT || '.5 million gallons'
WHEN 2 THEN 'TBD' WHEN 3 THEN 'about ' || l_quantity::INT WHEN 4 THEN l_quantity::INT || ' billion gallons' END AS raw, l_linenumber % 6 AS k, l_quantity::INT AS q FROM lineitem"""


def _quantities(lineitem: DataFrame) -> DataFrame:
    q, k = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 6
    raw = F.when(k == 0, F.concat(q, F.lit(",000 gallons"))).when(k == 1, F.concat(q, F.lit(".5 million gallons"))).when(k == 2, "TBD")
    raw = raw.when(k == 3, F.concat(F.lit("about "), q)).when(k == 4, F.concat(q, F.lit(" billion gallons")))
    return lineitem.select("l_orderkey", "l_linenumber", raw.alias("raw"))


@query(f"""SELECT l_orderkey, l_linenumber, CASE k WHEN 0 THEN q * 1000.0 WHEN 1 THEN (q + 0.5) * 1000000 WHEN 2 THEN -1 WHEN 4 THEN q * 1000000000.0 END::DOUBLE AS gallons FROM ({_QUANTITY})""")
def parse_quantity(lineitem: DataFrame) -> DataFrame:
    return _quantities(lineitem).select("l_orderkey", "l_linenumber", text.parse_quantity(F.col("raw")).alias("gallons"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 3 THEN NULL WHEN 5 THEN NULL ELSE floor(value) END AS value, CASE event_id % 6 WHEN 1 THEN '<' WHEN 2 THEN '<=' WHEN 4 THEN '>' WHEN 5 THEN '<' ELSE '' END AS qualifier,
CASE event_id % 6 WHEN 1 THEN '<' || floor(value)::INT WHEN 2 THEN '<=' || floor(value)::INT WHEN 3 THEN 'M' WHEN 4 THEN '>' || floor(value)::INT WHEN 5 THEN '<' ELSE floor(value)::INT || '' END AS original FROM events""")
def parse_qualifier(events: DataFrame) -> DataFrame:
    v, k = F.floor("value").cast("string"), F.col("event_id") % 6
    raw = F.when(k == 1, F.concat(F.lit("<"), v)).when(k == 2, F.concat(F.lit("<="), v)).when(k == 3, "M").when(k == 4, F.concat(F.lit(">"), v)).when(k == 5, "<").otherwise(v)
    return events.select("event_id", text.parse_qualifier(raw).alias("r")).select("event_id", "r.*")


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN 'Ongoing' ELSE 'Completed' END AS status FROM events")
def status_case(events: DataFrame) -> DataFrame:
    shown = F.concat(F.lit("01/02/2024 "), F.when(F.col("event_type") == "view", "Ongoing").otherwise("01/03/2024"))
    return events.select("event_id", text.spill_status(shown).alias("status"))


@query("SELECT r_regionkey, CASE r_regionkey WHEN 0 THEN 'low' WHEN 1 THEN 'mid' WHEN 2 THEN 'high' END AS label FROM region")
def map_lookup(region: DataFrame) -> DataFrame:
    return region.select("r_regionkey", text.map_lookup(F.col("r_regionkey"), {0: "low", 1: "mid", 2: "high"}).alias("label"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE array_to_string(list_transform(regexp_extract_all(lower(p_type || '-o''neil x'), '[a-z]+|[^a-z]+'),
lambda w: upper(w[1]) || w[2:]), '') END AS name FROM part""")
def coalesce_initcap(part: DataFrame) -> DataFrame:
    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, "  ")
    return part.select("p_partkey", text.name_or_title(name, F.concat("p_type", F.lit("-o'neil x"))).alias("name"))


@query("SELECT p_partkey, upper(trim(replace(p_type, 'E', 'oe '))) AS cleaned, replace(p_name || '.png', '.png', '') AS icon FROM part")
def string_clean(part: DataFrame) -> DataFrame:
    cleaned = F.upper(F.trim(F.replace("p_type", F.lit("E"), F.lit("oe "))))
    return part.select("p_partkey", cleaned.alias("cleaned"), F.replace(F.concat("p_name", F.lit(".png")), F.lit(".png"), F.lit("")).alias("icon"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[^\x00-\x7F]', '', 'g')) AS folded FROM documents")
def ascii_fold(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.md5(text.ascii_fold(F.col("text")).cast("binary")).alias("folded"))


@query("SELECT o_orderkey, o_orderpriority || '_' || year(o_orderdate) || '_' || nullif(o_custkey % 5, 0) AS k FROM orders WHERE o_custkey % 5 <> 0")
def composite_key(orders: DataFrame) -> DataFrame:
    key = text.composite_key(F.col("o_orderpriority"), F.year("o_orderdate"), F.nullif(F.col("o_custkey") % 5, F.lit(0)))
    return orders.select("o_orderkey", key.alias("k")).na.drop(subset=["k"])


@query("SELECT p_partkey, split_part(p_type, ' ', 1) AS first, CASE WHEN instr(p_type, ' ') > 0 THEN substr(p_type, instr(p_type, ' ') + 1) ELSE '' END AS rest FROM part")
def split_once(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", text.split_once(F.col("p_type")).alias("s")).select("p_partkey", "s.*")


@query("SELECT p_partkey, translate(p_name || ' a-b,c.d/e', ' -,./', '_____') AS file FROM part")
def file_name(part: DataFrame) -> DataFrame:
    return part.select("p_partkey", text.safe_file_name(F.concat("p_name", F.lit(" a-b,c.d/e"))).alias("file"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE strftime(o_orderdate, '%b ') || day(o_orderdate) || strftime(o_orderdate, ', %Y') END AS since FROM orders")
def regex_date_reformat(orders: DataFrame) -> DataFrame:
    label = F.when(F.col("o_orderkey") % 4 == 0, "<strong>Status:</strong> ").otherwise("<p><strong>status since:</strong>&nbsp;&nbsp;")
    notice = F.concat(label, F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit("</p>"))
    return orders.select("o_orderkey", text.status_since(notice).alias("since"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS last FROM part")
def regex_last_match(part: DataFrame) -> DataFrame:
    notice = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat(F.lit("<strong>a\nb</strong> c <strong>"), "p_type", F.lit("</strong>")))
    return part.select("p_partkey", text.last_strong(notice).alias("last"))


@query("SELECT page_id, md5(replace(replace(replace(html, '<p>', ''), '</p>', ' '), '<br>', '')) AS stripped FROM pages")
def strip_fragments(pages: DataFrame) -> DataFrame:
    stripped = text.strip_fragments(F.col("html"), [("<p>", ""), ("</p>", " "), ("<br>", "")])
    return pages.select("page_id", F.md5(stripped.cast("binary")).alias("stripped"))


@query("""SELECT event_id, CASE event_type WHEN 'error' THEN 'closed' WHEN 'view' THEN props ELSE '' END AS notice FROM events""")
def dispatch_by_code(events: DataFrame) -> DataFrame:
    code = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "view", 3).otherwise(2)
    return events.select("event_id", text.by_code(code, closure=(1, F.lit("closed")), advisory=(3, F.col("props"))).alias("notice"))


@query(r"""SELECT page_id, i - 1 AS pos, regexp_extract(l[i], 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(l[i], '<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS text
FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT page_id, regexp_extract_all(html, '<a\s[^>]*href="[^"]*"[^>]*>[^<]*</a>') AS l FROM pages))""")
def html_links(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", F.posexplode(text.html_links(F.col("html"))).alias("pos", "link")).select("page_id", F.col("pos").cast("long").alias("pos"), "link.*")


@query(r"SELECT page_id, trim(regexp_extract(html, '&copy;\s*([^<]*)<', 1)) AS owner FROM pages WHERE contains(html, '&copy;')")
def html_text_marker(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", text.text_after_marker(F.col("html"), "&copy;").alias("owner")).na.drop(subset=["owner"])


@query("SELECT event_id, (props->>'k')::INT AS k FROM events")
def json_extract(events: DataFrame) -> DataFrame:
    return events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


_WHOLE = "SELECT doc_id, CASE WHEN text <> '' THEN '[' || text || ']' ELSE '' END AS out FROM documents"


@query(_WHOLE)
def udf_text_transform(documents: DataFrame) -> DataFrame:
    return transformed(documents.select("doc_id", "text"), "text", "[{}]".format, "out").drop("text")


@query(_WHOLE)
def udf_text_transform_whole(documents: DataFrame) -> DataFrame:
    return transformed(documents.select("doc_id", "text"), "text", "[{}]".format, "out").drop("text")


@query("SELECT s_suppkey, unnest(['no ' || s_suppkey, s_name || ' & co', 'nation ' || s_nationkey]) AS item FROM supplier WHERE s_suppkey % 3 <> 0")
def html_list_items(supplier: DataFrame) -> DataFrame:
    key = F.col("s_suppkey").cast("string")
    items = F.concat(F.lit("<ul>\n<li><b>no "), key, F.lit("</b></li><LI class=x>"), "s_name", F.lit("\n & <i>co</i><li>nation "), F.col("s_nationkey").cast("string"), F.lit("</li></ul>"))
    head = F.when(F.col("s_suppkey") % 3 == 0, "Other").otherwise("Closures")
    page = F.concat(F.lit("<h2>First</h2><ul><li>not this</li></ul><h3 id=c> <span>"), head, F.lit("</span></h3><p>until "), key, F.lit("</p>"), items, F.lit("<ul><li>nor this</li></ul>"))
    return supplier.select("s_suppkey", F.explode(text.list_after_header(page, "closures")).alias("item"))
