"""Reading: catalog tables, SQL extracts, JDBC databases, XML listing pages."""

from tablehaul.sources.extract import (extract, gate, read_table, run_context, scalar, scalar_timestamp,
                                       staged_extract, substitute)
from tablehaul.sources.jdbc import EvenSplits, Ranges, even_bounds, jdbc_options, read_jdbc, split_predicates
from tablehaul.sources.listing import chain, conform, listing_faults, missing_pages, next_markers, parse_listing, parse_pages

__all__ = ["EvenSplits", "Ranges", "chain", "conform", "even_bounds", "extract", "gate", "jdbc_options", "listing_faults", "missing_pages", "next_markers", "parse_listing",
           "parse_pages", "read_jdbc", "read_table", "run_context", "scalar", "scalar_timestamp", "split_predicates", "staged_extract", "substitute"]
