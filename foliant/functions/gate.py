"""The content gate: is there markup in a text at all?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decode import NO_ERROR, error_of

NOT_XHTML = "NotXhtmlContentException"
#: Fixed values of the gate.
PROBE_CHARS, CONTROL_SHARE = 4096, 0.01
ELEMENT = "<\\s*[a-zA-Z][a-zA-Z0-9:._-]*(\\s|/|>)"


def is_binary(text: Column) -> Column:
    """Strictly more than 1 % control characters, other than tab, line feed, return and form feed, in the head."""
    head = F.substring(text, 1, PROBE_CHARS)
    return F.regexp_count(head, F.lit("[\\p{Cc}&&[^\\t\\n\\r\\f]]")) > CONTROL_SHARE * F.length(head)


def has_element(text: Column) -> Column:
    return text.rlike(ELEMENT)


def content_error(text: Column) -> Column:
    """Error struct of a text that holds no document, else null. Checks go from cheap to costly."""
    return (
        F.when(~F.coalesce(text, F.lit("")).rlike("(?U)\\S"), error_of(NOT_XHTML, "The payload is empty; there is no document to convert."))
        .when(is_binary(text), error_of(NOT_XHTML, "The payload is binary content, not markup."))
        .when(~has_element(text), error_of(NOT_XHTML, "The payload holds no element; it is not a document."))
        .otherwise(F.expr(NO_ERROR))
    )
