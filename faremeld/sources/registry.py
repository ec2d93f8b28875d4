"""Sources by name, and the choice of which to run."""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame

from faremeld import fixed_values as fv
from faremeld.sources import embedded_items, event_stream, itinerary_api, result_table, sailing_cards


@dataclass(frozen=True)
class Source:
    """How one source turns its raw tables into quotes.

    `parse(*raw, start, end)` gives quotes with `row_ord`;
    `health(*raw)` gives one `error` row per reason to fail the source.
    A run gives a source up after `deadline_s` seconds.
    """

    name: str
    parse: Callable[..., DataFrame]
    health: Callable[..., DataFrame]
    deadline_s: float = 3600.0


_MODULES = {
    "icruise": result_table,
    "expedia": itinerary_api,
    "cruisedirect": sailing_cards,
    "asiayo": embedded_items,
    "bwt": event_stream,
}


def default_sources() -> dict[str, Source]:
    return {name: Source(name, m.parse, m.health) for name, m in _MODULES.items()}


def select_sources(asked: str | None, known: tuple[str, ...] = fv.ALL_SOURCES) -> list[str]:
    """The names in a comma list, each once, in the list's order; no list or the word "all" stands for every source."""
    if (asked or "all").strip().lower() == "all":
        return [*known]
    found = {name: name in known for name in map(str.strip, asked.split(",")) if name}
    if not all(found.values()):
        missing = [name for name, there in found.items() if not there]
        raise ValueError(f"no source is called {' or '.join(missing)}; there are {', '.join(known)}")
    return [*found]
