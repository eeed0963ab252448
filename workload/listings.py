"""XML listing pages, made from the given web pages, and date texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablehaul.functions import parse_http_date
from tablehaul.plans.jobs import load_blob_listing
from tablehaul.errors import LoadError
from tablehaul.sources import listing_faults, missing_pages, parse_pages, scalar
from workload.registry import given, query, target

BLOBS = ("name string, url string, content_length bigint, last_modified timestamp_ntz, creation_time timestamp_ntz, "
         "etag string")


def _escaped(text):
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _listing(spark, sf):
    """Ten blobs to a page, in the order of their keys, so that a page made twice is the same; each page announces the next one."""
    pages = given(spark, sf, "pages")
    last = scalar(pages.agg(F.max(F.floor(F.col("page_id") / 10))))
    when = F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, int(page_id))")
    blob = F.concat(
        F.lit("<Blob><Name>page-"), F.col("page_id").cast("string"), F.lit("</Name><Properties><Url>"),
        _escaped(F.col("url")), F.lit("</Url><Content-Length>"), F.length("html").cast("string"),
        F.lit("</Content-Length><Last-Modified>"), F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" GMT</Last-Modified><Creation-Time>unknown</Creation-Time></Properties></Blob>"))
    number = F.floor(F.col("page_id") / 10)
    grouped = (pages.select(number.alias("number"), F.struct("page_id", blob.alias("blob")).alias("keyed")).groupBy("number")
               .agg(F.array_join(F.sort_array(F.collect_list("keyed")).getField("blob"), "").alias("blobs")))
    marker = F.when(F.col("number") < last, F.concat(F.lit("m"), (F.col("number") + 1).cast("string"))).otherwise("")
    return grouped.select(
        F.when(F.col("number") > 0, F.concat(F.lit("m"), F.col("number").cast("string"))).alias("marker_in"),
        F.concat(F.lit("<EnumerationResults><Blobs>"), "blobs", F.lit("</Blobs><NextMarker>"), marker,
                 F.lit("</NextMarker></EnumerationResults>")).alias("xml"))


@query("""
SELECT 'page-' || CAST(page_id AS VARCHAR) AS name, url, length(html) AS content_length,
       TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id) AS last_modified, CAST(NULL AS TIMESTAMP) AS creation_time,
       CAST(NULL AS VARCHAR) AS etag
FROM pages
""")
def listing_rows(spark, sf):
    table = target(spark)
    load_blob_listing(spark, _listing(spark, sf), table, BLOBS)
    return spark.table(table)


@query("""
SELECT DISTINCT 'm' || CAST(page_id // 10 AS VARCHAR) AS marker FROM pages WHERE page_id // 10 = 2
""")
def listing_missing_pages(spark, sf):
    """Two neighbouring pages are missing; only the first of them is announced by a page that was fetched."""
    return missing_pages(_listing(spark, sf).where("marker_in IS NULL OR marker_in NOT IN ('m2', 'm3')"))


@query("""
SELECT 'page-' || CAST(page_id AS VARCHAR) AS name, length(html) AS content_length, ' ' || CAST(page_id AS VARCHAR) || ' ' AS deep
FROM pages
""")
def listing_deep_fields(spark, sf):
    """A field three levels down, with blanks around it."""
    deeper = F.expr(r"regexp_replace(xml, '<Name>page-(\\d+)</Name>', '<Name>page-$1</Name><Tags><TagSet><Deep> $1 </Deep></TagSet></Tags>')")
    table = target(spark)
    load_blob_listing(spark, _listing(spark, sf).withColumn("xml", deeper), table, "name string, content_length bigint, deep string")
    return spark.table(table)


@query("SELECT 'page-' || CAST(page_id AS VARCHAR) AS name, url FROM pages")
def listing_repeated_pages(spark, sf):
    """Every page is given twice and counts once."""
    table = target(spark)
    pages = _listing(spark, sf)
    load_blob_listing(spark, pages.unionByName(pages), table, "name string, url string")
    return spark.table(table)


@query("""
SELECT CASE WHEN page_id % 3 = 1 THEN NULL ELSE 'page-' || CAST(page_id AS VARCHAR) || ' <x>' END AS name, length(html) AS content_length,
       CASE page_id % 3 WHEN 0 THEN 'a & b' WHEN 2 THEN ' </Blob> ' END AS note
FROM pages
""")
def listing_any_case(spark, sf):
    """Names in any case and with a prefix, empty and repeated elements, comments with blobs in them, entities and CDATA."""
    pages = given(spark, sf, "pages")
    name = F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(" &lt;x&gt;"))
    kind, size = F.col("page_id") % 3, F.length("html").cast("string")
    ghost = F.lit("<!-- <Blob><Name>ghost</Name></Blob> -->")
    blob = (F.when(kind == 0, F.concat(F.lit("<a:BLOB><a:NAME>old</a:NAME><a:NAME>"), name, F.lit("</a:NAME><NOTE>a &amp; b</NOTE><Note/><a:CONTENT_Length>"), size,
                                       F.lit("</a:CONTENT_Length></a:BLOB>"), ghost))
            .when(kind == 1, F.concat(ghost, F.lit("<blob><name /><p:Deep><x><content-length>"), size, F.lit("</content-length></x></p:Deep></blob>")))
            .otherwise(F.concat(F.lit("<Blob><Name>"), name, F.lit("</Name><Note><![CDATA[ </Blob> ]]></Note><Content-Length>"), size, F.lit("</Content-Length></Blob>"))))
    xml = F.concat(F.lit("<?xml version='1.0'?><e:Results xmlns:e='urn:e' xmlns:a='urn:a' xmlns:p='urn:p'><Blobs>"), blob, F.lit("</Blobs><e:nextMarker>"),
                   F.when(F.col("page_id") < scalar(pages.agg(F.max("page_id"))), (F.col("page_id") + 1).cast("string")).otherwise(""),
                   F.lit("</e:nextMarker></e:Results>"))
    marker = F.when(F.col("page_id") > scalar(pages.agg(F.min("page_id"))), F.col("page_id").cast("string"))
    table = target(spark)
    load_blob_listing(spark, pages.select(marker.alias("marker_in"), xml.alias("xml")), table, "name string, content_length bigint, note string")
    return spark.table(table)


def _faults(pages):
    return listing_faults(parse_pages(pages, []))


@query("SELECT DISTINCT 'm' || CAST(page_id // 10 AS VARCHAR) AS marker, 'stranger' AS fault FROM pages WHERE page_id // 10 % 10 = 3")
def listing_strangers(spark, sf):
    """Every tenth page is passed over by the page before it: it is there, but the chain does not reach it."""
    number = F.floor(F.col("page_id") / 10)
    last = scalar(given(spark, sf, "pages").agg(F.max(number)))
    passed = F.expr(r"CAST(regexp_extract(xml, '<NextMarker>m(\\d*3)</NextMarker>', 1) AS string)")
    skipping = F.when(passed == "", F.col("xml")).otherwise(F.regexp_replace("xml", F.lit("<NextMarker>[^<]*</NextMarker>"), F.concat(
        F.lit("<NextMarker>"), F.when(passed.try_cast("long") < last, F.concat(F.lit("m"), (passed.try_cast("long") + 1).cast("string"))).otherwise(""), F.lit("</NextMarker>"))))
    return _faults(_listing(spark, sf).withColumn("xml", skipping))


@query("SELECT 'm' || CAST(max(page_id // 10) AS VARCHAR) AS marker, 'cycle' AS fault FROM pages")
def listing_cycle(spark, sf):
    """The last page leads back to the second one."""
    return _faults(_listing(spark, sf).withColumn("xml", F.replace("xml", F.lit("<NextMarker></NextMarker>"), F.lit("<NextMarker>m1</NextMarker>"))))


@query("SELECT DISTINCT 'm' || CAST(page_id // 10 AS VARCHAR) AS marker, 'different' AS fault FROM pages WHERE page_id // 10 % 4 = 1")
def listing_different_pages(spark, sf):
    """Pages given twice, some of them with other content."""
    pages = _listing(spark, sf)
    other = F.when(F.col("marker_in").substr(2, 20).try_cast("int") % 4 == 1, F.replace("xml", F.lit("<Blobs>"), F.lit("<Blobs><Blob/>"))).otherwise(F.col("xml"))
    return _faults(pages.unionByName(pages.withColumn("xml", other)))


@query("SELECT 'page-' || CAST(page_id AS VARCHAR) AS name, 3 AS refused FROM pages")
def listing_keeps_target(spark, sf):
    """Listings that are not whole leave the table as it was: the target is recreated only once all pages are found good."""
    table, pages = target(spark), _listing(spark, sf)
    load_blob_listing(spark, pages, table, "name string")
    refused = 0
    for broken in (pages.where("marker_in IS NOT NULL"), pages.where("NOT marker_in <=> 'm1'"),
                   pages.unionByName(pages.where("marker_in = 'm1'").withColumn("marker_in", F.lit("nobody knows me")))):
        try:
            load_blob_listing(spark, broken, table, "name string, more string")
        except LoadError:
            refused += 1
    return spark.table(table).withColumn("refused", F.lit(refused))


@query("""
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_orderdate + to_hours(o_orderkey % 24)
       WHEN 1 THEN o_orderdate + to_hours(o_orderkey % 24) WHEN 2 THEN o_orderdate END AS parsed
FROM orders
""")
def http_dates(spark, sf):
    at = F.expr("o_orderdate + make_dt_interval(0, int(o_orderkey % 24))")
    kind = F.col("o_orderkey") % 5
    text = (F.when(kind == 0, F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
            .when(kind == 1, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"))
            .when(kind == 2, F.date_format("o_orderdate", "dd MMM yyyy"))
            .when(kind == 3, F.concat(F.lit("about "), F.date_format(at, "yyyy"))).otherwise(" "))
    return given(spark, sf, "orders").select("o_orderkey", parse_http_date(text).alias("parsed"))
