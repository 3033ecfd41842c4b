"""Aspect extraction (T13) and aspect → sentiment maps (T15) as expressions.

Matching is by substring of the lower-cased text, as in the reference: the
keyword ``turn`` is found in "return". A literal lexicon compiles to one
boolean expression per aspect, evaluated inside whole-stage codegen; no join
and no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinari.config import Aspect, Lexicon


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_contains(low: Column, words) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | low.contains(w)
    return hit


def aspect_found(text, aspect: Aspect, use_context: bool = True) -> Column:
    low = F.lower(_c(text))
    found = _any_contains(low, aspect.keywords)
    if use_context:
        for group in aspect.context:
            found = found & _any_contains(low, group)
    return F.coalesce(found, F.lit(False))


def extract_aspects(text, lexicon: Lexicon, use_context: bool = True) -> Column:
    """Array of found aspect names in lexicon order; ``[]`` for null or
    blank text. Built with ``array_remove`` (not a lambda ``filter``) so it
    stays inside whole-stage codegen."""
    flags = [F.when(aspect_found(text, a, use_context), F.lit(a.name)).otherwise(F.lit(""))
             for a in lexicon.aspects]
    return F.array_remove(F.array(*flags), "")


def aspect_sentiments(aspects, label) -> Column:
    """Every aspect of a comment takes the whole comment's label."""
    return F.map_from_arrays(_c(aspects), F.array_repeat(_c(label), F.size(_c(aspects))))


def aspect_confidences(aspects, confidence) -> Column:
    """T15, API form: the comment's confidence for every aspect."""
    return F.map_from_arrays(_c(aspects), F.array_repeat(_c(confidence), F.size(_c(aspects))))


def lexicon_position(aspect_col, lexicon: Lexicon) -> Column:
    """Position of an aspect name in the lexicon (for lexicon-order output)."""
    expr = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(lexicon.names))):
        expr = F.when(_c(aspect_col) == name, F.lit(i)).otherwise(expr)
    return expr
