"""Queries: pages as trees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import markup
from .catalogue import query


@query(r"""WITH p AS (SELECT page_id, regexp_replace(html, '(?s)<script>.*?</script>|<style>.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages)
SELECT page_id, len(regexp_extract_all(h, '<a [^>]*>'))::BIGINT AS links, len(regexp_extract_all(h, '<p>'))::BIGINT AS paragraphs, len(regexp_extract_all(h, '<li>'))::BIGINT AS items, regexp_extract(h, '<a href="([^"]*)"', 1) AS first_link, 3 AS item_depth FROM p""")
def page_nodes(pages: DataFrame) -> DataFrame:
    """What the trees of the pages hold: links, paragraphs, list items, and how deep those are (html, body, nav, ul above)."""
    found = markup.nodes(pages.select("page_id", "html"))
    tag = F.col("tag")
    href = F.min_by(F.when(tag == "a", F.col("attributes")["href"]), F.when(tag == "a", F.col("node")))
    return found.groupBy("page_id").agg(
        F.count_if(tag == "a").alias("links"), F.count_if(tag == "p").alias("paragraphs"), F.count_if(tag == "li").alias("items"),
        href.alias("first_link"), (F.max(F.when(tag == "li", F.col("depth"))) - 1).alias("item_depth"),
    )


@query("""WITH n AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber % 2 ORDER BY l_linenumber, l_partkey::VARCHAR) AS k FROM lineitem),
r AS (SELECT *, 'Park ' || l_partkey AS name, 'from ' || l_linenumber || ' on' AS own, 'gate ' || l_linenumber AS inner_item FROM n)
SELECT l_orderkey, CASE l_linenumber % 2 WHEN 1 THEN 'Temporary Closures' ELSE 'Weather-related Park Closures' END AS header, (2 * k - 1)::INT AS item, name, own || ' ' || inner_item AS details, '/p/' || l_partkey AS link FROM r
UNION ALL SELECT l_orderkey, CASE l_linenumber % 2 WHEN 1 THEN 'Temporary Closures' ELSE 'Weather-related Park Closures' END, (2 * k)::INT, '', inner_item, '' FROM r""")
def list_items_after_header(lineitem: DataFrame) -> DataFrame:
    """A page for each order: its odd lines under one heading, the even ones under another, each item with a list in it
    and without an end tag.
    """
    item = F.format_string("<li class=x><a href='/p/%d'>Park %d</a>\n from %d on<ul><li>gate %d</ul>", "l_partkey", "l_partkey", "l_linenumber", "l_linenumber")
    listed = lambda odd: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("l_linenumber") % 2 == odd, F.struct("l_linenumber", item.alias("t"))))), lambda x: x["t"]), "\n")
    start = "<body><ul><li><a href='/'>home</a></ul><div><strong> Temporary\n Closures</strong></div><h3>Temporary <i>Closures</i></h3><p>Now:<ul>"
    both = F.concat(F.lit(start), listed(1), F.lit("</ul><p><STRONG>Weather-related Park Closures</STRONG></p><div><ul>"), listed(0), F.lit("</ul></div><ul><li>last</ul>"))
    pages = lineitem.groupBy("l_orderkey").agg(both.alias("html"))
    return markup.items_after_headers(pages, ["l_orderkey"], ["Temporary Closures", "TemporaryClosures", "Weather-related Park Closures"]).withColumn("header", F.when(F.col("header") == "TemporaryClosures", "Temporary Closures").otherwise(F.col("header")))
