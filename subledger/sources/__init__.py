"""Raw tables: their schemas, the readers, and the adapter for the star-schema test tables."""

from subledger.sources.readers import CatalogSource, CsvSource, FrameSource, ParquetSource, Source
from subledger.sources.retail import RetailSource
from subledger.sources.schemas import RAW_TABLES, raw_schema

__all__ = [
    "CatalogSource", "CsvSource", "FrameSource", "ParquetSource", "RAW_TABLES", "RetailSource", "Source", "raw_schema",
]
