"""Checks of a meaning's substance (additions: specified, not built, in the surveyed engine)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a text speaks of itself instead of its matter.
META = r"(?i)\b(?:this|the) (?:passage|document|chunk|text|excerpt|section|page) (?:is|describes?|discusses?|mentions?|contains?|provides?|outlines?|states?)\b"
HOOK = r"\b(?:[A-Z][\w'’-]+(?: [A-Z][\w'’-]+)+|\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{2,4})"


def speaks_of_itself(meaning: Column) -> Column:
    return F.coalesce(meaning.rlike(META), F.lit(False))


def unresolved_hooks(meaning: Column, surfaces: Column) -> Column:
    """Names of several words and dates of the meaning that no entity surface has."""
    hooks = F.array_distinct(F.regexp_extract_all(F.coalesce(meaning, F.lit("")), F.lit(HOOK), F.lit(0)))
    known = F.coalesce(surfaces, F.array().cast("array<string>"))
    return F.filter(hooks, lambda h: ~F.exists(known, lambda s: F.contains(F.lower(s), F.lower(h)) | F.contains(F.lower(h), F.lower(s))))


def has_substance(entity_refs: Column, themes: Column, dated: Column) -> Column:
    """A reference that is no theme, or a dated action."""
    own = F.exists(F.coalesce(entity_refs, F.array().cast("array<struct<role:string,entity_id:string,entity_type:string,canonical:string>>")), lambda r: r["entity_id"].isNotNull() & ~F.array_contains(themes, r["entity_id"]))
    return own | F.coalesce(dated, F.lit(False))
