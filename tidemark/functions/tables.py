"""Table functions for plain SQL: elements of HTML, objects of JSON.

    SELECT p.page_id, e.attrs['href'] FROM pages p, LATERAL html_elements(p.html, 'a[href]') e
    SELECT p.page_id, o.value FROM pages p, LATERAL json_objects(p.body) o
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from tidemark.session import ship
from tidemark.sources import html

ELEMENT = "pos int, end int, parent int, tag string, attrs map<string,string>, text string"


@udtf(returnType=ELEMENT)
class HtmlElements:
    """html_elements(html, selector): the elements that the selector wants, in document order, with their texts. Null HTML has none; a null selector wants all."""

    def eval(self, page: str | None, selector: str | None):
        for pos, end, parent, _, tag, attrs, _, text, *_ in html.parse(page, None if selector is None else {"wanted": selector}):
            yield pos, end, parent, tag, attrs, text


@udtf(returnType="at int, type string, value string")
class JsonObjects:
    """json_objects(text): every object inside a JSON text, outer ones first, with its @type, as JSON; none of what can't be read."""

    def eval(self, text: str | None):
        try:
            value = json.loads(text)
            found = html.flatten_objects(value)
        except (TypeError, ValueError, RecursionError):
            return
        for at, o in enumerate(found):
            kind = o.get("@type")
            yield at, kind if isinstance(kind, str) else None, json.dumps(o, ensure_ascii=False)


def register(spark: SparkSession) -> None:
    """Makes html_elements and json_objects known to the session's SQL."""
    ship(spark)
    spark.udtf.register("html_elements", HtmlElements)
    spark.udtf.register("json_objects", JsonObjects)
