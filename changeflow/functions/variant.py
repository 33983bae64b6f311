"""JSON leaf types, for the few messages whose fields need a second look."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_type(doc: Column, path: str) -> Column:
    """Type name of a leaf: null when the key is absent, VOID for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(doc, f"$.{path}", "variant"))


def not_text(doc: Column, path: str) -> Column:
    """Present, not null and not a JSON string."""
    return ~F.coalesce(json_type(doc, path), F.lit("VOID")).isin("VOID", "STRING")


def is_null_leaf(doc: Column, path: str) -> Column:
    return F.coalesce(json_type(doc, path) == "VOID", F.lit(False))
