"""All catalogue queries by name, with the SQL each must agree with."""

from __future__ import annotations

from . import captures, catalogue, payloads, titles

QUERIES: dict = {**catalogue.QUERIES, **titles.QUERIES, **payloads.QUERIES, **captures.QUERIES}
ORACLES: dict = {**catalogue.ORACLES, **titles.ORACLES, **payloads.ORACLES, **captures.ORACLES}
