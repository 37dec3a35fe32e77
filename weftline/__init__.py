"""Keyed upserts of semi-structured change records as Spark jobs."""

from weftline.catalog import AttributeSpec, Catalog
from weftline.config import Options
from weftline.session import build_session, configure

__all__ = ["AttributeSpec", "Catalog", "Options", "build_session", "configure"]
