"""XML listing pages as rows: one page of a blob listing per row, many blobs per page.

Fetching the pages is the caller's work; here all pages are parsed in parallel, whatever their order, each once. The chain of
their markers is followed afterwards, on one small row per page.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablehaul.functions.dates import parse_http_date
from tablehaul.operators.schema import as_schema
from tablehaul.workspace import materialize

_PARSED = "marker_in string, next_marker string, content string, blobs array<array<string>>"


def _page_reader(fields: Sequence[str]):
    """A function over Arrow batches (marker_in, xml) that reads every page once, by its events.

    Everything it needs is inside, so that executors need nothing of this library.
    """
    wanted = {name.lower(): place for place, name in enumerate(fields)}

    def read(batches: Iterator) -> Iterator:
        import hashlib
        from xml.parsers import expat

        import pyarrow as pa

        class Page:
            """What the events of one page leave behind. The text of an element is what follows its start tag directly."""

            def __init__(self) -> None:
                self.blobs, self.marker, self.blob, self.element, self.text = [], None, None, None, []

            def settle(self, *_) -> None:
                name, text = self.element, "".join(self.text)
                if name is not None and text:
                    if name == "nextmarker":
                        self.marker = text
                    elif self.blob is not None and name in wanted:
                        self.blob[wanted[name]] = text
                self.element = None
                self.text.clear()

            def start(self, name: str, _) -> None:
                self.settle()
                name = name.rpartition(":")[2].lower().replace("-", "_")
                if name == "blob":
                    self.blob = [None] * len(wanted)
                else:
                    self.element = name

            def end(self, name: str) -> None:
                self.settle()
                if name.rpartition(":")[2].lower() == "blob" and self.blob is not None:
                    self.blobs.append(self.blob)
                    self.blob = None

            def characters(self, text: str) -> None:
                if self.element is not None:
                    self.text.append(text)

        def parsed(xml: str | None) -> Page:
            page, parser = Page(), expat.ParserCreate("utf-8")
            parser.buffer_text = True
            parser.StartElementHandler, parser.EndElementHandler = page.start, page.end
            parser.CharacterDataHandler = page.characters
            parser.CommentHandler = parser.ProcessingInstructionHandler = page.settle
            parser.Parse((xml or "").encode(), True)
            return page

        for batch in batches:
            texts = batch.column(1).to_pylist()
            pages = [parsed(xml) for xml in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([p.marker for p in pages], pa.string()),
                 pa.array([hashlib.md5(xml.encode()).hexdigest() for xml in texts], pa.string()),
                 pa.array([p.blobs for p in pages], pa.list_(pa.list_(pa.string())))], ["marker_in", "next_marker", "content", "blobs"])

    return read


def parse_pages(pages: DataFrame, fields: Sequence[str], *, marker_in: str = "marker_in", xml: str = "xml") -> DataFrame:
    """Each page as one row: its own marker, the marker that it announces, a checksum of its text, and its blobs (lists of the
    fields' texts). A page that is not XML, or has no text, fails."""
    return pages.select(F.nullif(F.col(marker_in).cast("string"), F.lit("")).alias("marker_in"), F.col(xml).cast("string").alias("xml")).mapInArrow(
        _page_reader(fields), _PARSED)


def blobs_of(parsed: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per blob of parsed pages, with the named fields as text."""
    blob = parsed.select(F.explode("blobs").alias("blob"))
    return blob.select([F.get("blob", F.lit(i)).alias(name) for i, name in enumerate(fields)])


def parse_listing(pages: DataFrame, fields: Sequence[str], *, xml: str = "xml") -> DataFrame:
    """One row per blob with the named fields as text, blanks kept.

    A field is found at any depth below the blob; of several that have a text the last counts. Names are matched without their prefix, in
    lower case, with ``-`` read as ``_``. Entities and CDATA are text, comments are not. A field the blob lacks, or
    whose element is empty, is null, so an empty blob is a row of nulls. A page that is not XML fails.
    """
    return blobs_of(parse_pages(pages.withColumn("marker_in", F.lit(None)), fields, xml=xml), fields)


def next_markers(pages: DataFrame, *, xml: str = "xml") -> DataFrame:
    """The marker of the following page, for every page that announces one."""
    parsed = parse_pages(pages.withColumn("marker_in", F.lit(None)), [], xml=xml)
    return parsed.select(F.col("next_marker").alias("marker")).where("marker IS NOT NULL")


def missing_pages(pages: DataFrame, *, marker_in: str = "marker_in", xml: str = "xml") -> DataFrame:
    """Markers that some page announces but no page was fetched for; empty when the listing is whole."""
    parsed = parse_pages(pages, [], marker_in=marker_in, xml=xml).select("marker_in", "next_marker")
    return _missing(parsed.select(F.col("marker_in").alias("marker"), "next_marker"))


def _missing(links: DataFrame) -> DataFrame:
    announced = links.where("next_marker IS NOT NULL").select(F.col("next_marker").alias("marker"))
    return announced.join(links.select("marker"), "marker", "left_anti").distinct()


def chain(links: DataFrame) -> DataFrame:
    """``marker, next_marker, place`` of every page: how many pages after the first (the one without a marker) the chain of
    markers reaches it, null if it does not.

    ``links`` has one row per page, marker and next_marker. By pointer doubling: each round every page knows the page twice as far
    ahead, and the pages that are reached hand their places on to those, so that a chain of n pages takes about log2(n) rounds.
    """
    first = F.col("marker").isNull()
    state = links.select(F.coalesce("marker", F.lit("")).alias("node"), F.col("next_marker").alias("ahead"), F.when(first, 0).alias("place"))
    rounds = 0
    while True:
        seen = Observation()
        state = materialize(state.observe(seen, F.count(F.lit(1)).alias("all"), F.count_if(F.col("place").isNotNull() & F.col("ahead").isNotNull()).alias("on")), "chain")
        if not seen.get["on"] or 1 << rounds > seen.get["all"]:
            break
        told = state.where("place IS NOT NULL AND ahead IS NOT NULL").groupBy(F.col("ahead").alias("node")).agg(
            F.min(F.col("place") + (1 << rounds)).alias("told"))
        further = state.select(F.col("node").alias("ahead"), F.col("ahead").alias("further"))
        state = state.join(further, "ahead", "left").join(told, "node", "left").select(
            "node", F.col("further").alias("ahead"), F.coalesce("place", "told").alias("place"))
        rounds += 1
    return links.join(state.select(F.nullif("node", F.lit("")).alias("marker_of"), "place"), F.col("marker").eqNullSafe(F.col("marker_of"))).drop("marker_of")


def listing_faults(parsed: DataFrame) -> DataFrame:
    """``marker, fault`` for whatever keeps parsed pages from being one chain; empty when the listing is whole.

    ``different``: pages with one marker that are not the same. ``missing``: announced, but not there; the first page (null) as
    well. ``stranger``: a page that the chain does not reach. ``cycle``: a page of the chain that leads back to one before it.
    """
    each = materialize(parsed.groupBy(F.col("marker_in").alias("marker")).agg(
        F.max("next_marker").alias("next_marker"), (F.min("content") != F.max("content")).alias("differ")), "pages")
    links = each.select("marker", "next_marker")
    placed = materialize(chain(links), "places")
    back = placed.select(F.col("marker").alias("next_marker"), F.col("place").alias("ahead"))
    first = links.where("marker IS NULL").agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(None).cast("string").alias("marker"))
    found = {"different": each.where("differ").select("marker"), "missing": _missing(links).unionByName(first),
             "stranger": placed.where("place IS NULL").select("marker"),
             "cycle": placed.join(back, "next_marker").where("ahead <= place").select("marker")}
    return reduce(DataFrame.unionByName, [rows.withColumn("fault", F.lit(fault)) for fault, rows in found.items()])


def conform(df: DataFrame, target: StructType | str) -> DataFrame:
    """Text records to the target's columns: by name, null where absent, dates and times parsed leniently."""
    have = {name.lower(): name for name in df.columns}
    columns = []
    for field in as_schema(target).fields:
        name = have.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif field.dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
            value = parse_http_date(F.col(f"`{name}`")).cast(field.dataType)
        else:
            value = F.col(f"`{name}`").cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(columns)
