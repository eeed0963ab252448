from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import values
from tablehaul import LoadError, conform, listing_faults, load_blob_listing, missing_pages, parse_listing
from tablehaul.functions import normalize_name, parse_http_date
from tablehaul.operators.schema import table_exists
from tablehaul.sources import chain, parse_pages
from workload.listings import _listing

FIRST = """<?xml version="1.0" encoding="utf-8"?>
<EnumerationResults ServiceEndpoint="https://example.invalid/" ContainerName="c">
  <Blobs>
    <Blob>
      <Name>a&amp;b &lt;x&gt; é.txt</Name>
      <Properties><Creation-Time>Mon, 01 Jan 2024 10:00:00 GMT</Creation-Time>
        <Content-Length>007</Content-Length><Content-Type>text &amp; more</Content-Type></Properties>
      <Metadata><Owner_Name>me</Owner_Name></Metadata>
    </Blob>
    <Blob><Name>b.txt</Name><Properties><Content-Length>12</Content-Length><Etag /></Properties></Blob>
  </Blobs>
  <NextMarker>m2</NextMarker>
</EnumerationResults>"""
LAST = "<EnumerationResults><Blobs><Blob><Name>c.txt</Name></Blob></Blobs><NextMarker /></EnumerationResults>"
EMPTY = "<EnumerationResults><Blobs></Blobs><NextMarker></NextMarker></EnumerationResults>"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "marker_in string, xml string")


def test_names():
    assert normalize_name("Content-MD5") == "content_md5"


def test_fields_are_flat_named_in_lower_case_and_unescaped(spark):
    got = parse_listing(pages(spark, (None, FIRST), ("m2", LAST)),
                        ["name", "content_length", "content_type", "owner_name", "missing"])
    assert values(got) == [("a&b <x> é.txt", "007", "text & more", "me", None), ("b.txt", "12", None, None, None),
                           ("c.txt", None, None, None, None)]


def test_an_empty_page_gives_no_rows_and_a_broken_one_fails(spark):
    assert parse_listing(pages(spark, (None, EMPTY)), ["name"]).count() == 0
    with pytest.raises(Exception):
        parse_listing(pages(spark, (None, "<EnumerationResults><Blobs>")), ["name"]).collect()


def test_missing_pages(spark):
    assert missing_pages(pages(spark, (None, FIRST), ("m2", LAST))).count() == 0
    assert values(missing_pages(pages(spark, (None, FIRST)))) == [("m2",)]


def test_load_conforms_to_the_target_and_needs_all_pages(spark, db):
    schema = "content_length int, NAME varchar(50), creation_time timestamp_ntz, etag string"
    with pytest.raises(LoadError):
        load_blob_listing(spark, pages(spark, (None, FIRST)), f"{db}.blobs", schema)
    assert not table_exists(spark, f"{db}.blobs")
    load_blob_listing(spark, pages(spark, (None, FIRST), ("m2", LAST)), f"{db}.blobs", schema)
    load_blob_listing(spark, pages(spark, (None, FIRST), ("m2", LAST)), f"{db}.blobs", schema)
    assert values(spark.table(f"{db}.blobs"), "name", "content_length", "creation_time") == [
        ("a&b <x> é.txt", 7, datetime(2024, 1, 1, 10)), ("b.txt", 12, None), ("c.txt", None, None)]


def test_conform_fills_absent_columns(spark):
    got = conform(spark.sql("SELECT '5' AS N, '01 Jan 2024' AS day"), "n int, day date, other double")
    assert [f.simpleString() for f in got.schema] == ["n:int", "day:date", "other:double"]
    assert str(got.first().day) == "2024-01-01"


DATES = [
    ("Mon, 01 Jan 2024 10:00:00 GMT", datetime(2024, 1, 1, 10)),
    ("Mon, 01 Jan 2024 10:00:00 EST", datetime(2024, 1, 1, 15)),
    ("mon, 1 jan 2024 10:00:00 UTC", datetime(2024, 1, 1, 10)),
    ("Wednesday, 31 Jan 2024 23:59:59", datetime(2024, 1, 31, 23, 59, 59)),
    ("01 Jan 2024", datetime(2024, 1, 1)),
    ("01 Jan 2024 10:00:00", None),
    ("Mon, 01 Jan 2024", None),
    ("Xyz, 01 Jan 2024 10:00:00", None),
    ("2024-01-01", None),
    ("   ", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(DATES)], "i int, t string")
        got = [r.d for r in texts.select("i", parse_http_date(F.col("t")).alias("d")).orderBy("i").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [want for _, want in DATES]


def page(marker, blobs, following=""):
    return marker, f"<E><Blobs>{blobs}</Blobs><NextMarker>{following}</NextMarker></E>"


def test_incomplete_listings_stop_and_repeats_count_once(spark, db):
    first, second = page(None, "<Blob><Name> a </Name></Blob>", "m"), page("m", "<Blob><Name>b</Name><X><Y><De-Ep>d</De-Ep></Y></X></Blob>")
    kind, table = "marker_in string, xml string", f"{db}.blobs"
    load_blob_listing(spark, spark.createDataFrame([first, second, second, first], kind), table, "name string, de_ep string")
    assert values(spark.table(table)) == [(" a ", None), ("b", "d")]
    for pages in ([], [second], [first]):
        with pytest.raises(LoadError):
            load_blob_listing(spark, spark.createDataFrame(pages, kind), table, "name string, de_ep string")
    assert spark.table(table).count() == 2


def test_numeric_offsets(spark):
    dates = spark.createDataFrame([("Mon, 01 Jan 2024 10:00:00 +0200",), ("Mon, 01 Jan 2024 10:00:00 GMT",)], "t string")
    assert [r[0] for r in dates.select(parse_http_date("t")).collect()] == [datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 10)]


def test_a_page_is_parsed_by_its_events(spark):
    xml = """<r xmlns:a="urn:a"><!-- <Blob><Name>ghost</Name></Blob> --><Blob /><a:bLOB><a:nAME>x<!-- c -->y</a:nAME><Properties>
      <E-Tag>1</E-Tag><e_tag>2</e_tag><E-Tag/></Properties><Note><![CDATA[</Blob>]]> &amp; more</Note></a:bLOB><nextmarker>n</nextmarker></r>"""
    got = parse_listing(pages(spark, (None, xml)), ["name", "e_tag", "note", "absent"])
    assert values(got) == [(None, None, None, None), ("x", "2", "</Blob> & more", None)]
    assert values(missing_pages(pages(spark, (None, xml)))) == [("n",)]
    for broken in ("<a><Blob></a>", "", None, "text"):
        with pytest.raises(Exception):
            parse_listing(pages(spark, (None, broken)), ["name"]).collect()


def faults(spark, *rows):
    return values(listing_faults(parse_pages(spark.createDataFrame(list(rows), "marker_in string, xml string"), [])), "marker", "fault")


def test_the_chain_is_followed(spark):
    whole = [page(None, "", "1")] + [page(str(i), "", str(i + 1) if i < 40 else "") for i in range(1, 41)]
    assert faults(spark, *whole) == [] and faults(spark, *whole, whole[7]) == []
    assert faults(spark, page(None, "")) == [] and faults(spark, ("", page(None, "")[1])) == []
    assert faults(spark) == [(None, "missing")]
    assert faults(spark, *whole, page("x", "", "y"), page("y", "", "30")) == [("x", "stranger"), ("y", "stranger")]
    assert faults(spark, *whole, page("x", "", "y"), page("y", "", "x")) == [("x", "stranger"), ("y", "stranger")]
    assert faults(spark, *whole[:-1], page("40", "", "17")) == [("40", "cycle")]
    assert faults(spark, page(None, "", "1"), page("1", "", "1")) == [("1", "cycle")]
    assert faults(spark, *whole, page("5", "<Blob/>", "6")) == [("5", "different")]
    assert [f for f in faults(spark, *whole[:20], *whole[21:]) if f[1] == "missing"] == [("20", "missing")]
    assert [r.place for r in chain(spark.createDataFrame([(m, x.split("NextMarker>")[1][:-2] or None) for m, x in whole], "marker string, next_marker string"))
            .orderBy("place").collect()] == list(range(41))


def test_faults_stop_a_load_and_keep_the_table(spark, db):
    table, kind = f"{db}.blobs", "marker_in string, xml string"
    good = [page(None, "<Blob><Name>a</Name></Blob>", "m"), page("m", "<Blob><Name>b</Name></Blob>")]
    load_blob_listing(spark, spark.createDataFrame(good, kind), table, "name string")
    for bad in ([*good, page(None, "<Blob><Name>c</Name></Blob>", "m")], [*good, page("zzz", "<Blob><Name>stranger</Name></Blob>")],
                [good[0], page("m", "", "m")]):
        with pytest.raises(LoadError, match="not whole"):
            load_blob_listing(spark, spark.createDataFrame(bad, kind), table, "name string")
    assert values(spark.table(table)) == [("a",), ("b",)]


def test_a_listing_made_twice_is_the_same_in_whatever_order_its_rows_are_read(spark, db, tmp_path):
    rows = [(i, f"https://h/{i}?a&b" if i % 7 else None, "x" * (i % 5)) for i in range(45)] + [(12, "https://h/other", "x"), (13, "https://h/13?a&b", "xxx")]
    made = []
    for way in ("rising", "falling"):
        given = spark.createDataFrame(rows if way == "rising" else rows[::-1], "page_id bigint, url string, html string")
        given.coalesce(1).write.parquet(f"{tmp_path}/{way}/pages.parquet")
        made.append(_listing(spark, f"{tmp_path}/{way}"))
    assert values(made[0]) == values(made[1])
    first = values(made[0])[0][1]
    assert "<Name>page-9</Name>" in first and "<Name>page-7</Name>" not in first
    load_blob_listing(spark, made[0].unionByName(made[1]), f"{db}.blobs", "name string, url string")
    assert values(spark.table(f"{db}.blobs")) == sorted((f"page-{i}", url) for i, url, _ in rows if url)
