"""Values a deployment chooses: brand, source tags, calendar, reporting date."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Source tags carried by every silver and gold row.
FEED_A = "feed_a"  # item-line CSV
FEED_B = "feed_b"  # one store per file CSV
FEED_C = "feed_c"  # nested order XML

UNKNOWN = "UNKNOWN"


@dataclass(frozen=True)
class Brand:
    """How a chain spells its own name in store columns and in file names."""

    name: str = "Bluebird"

    @property
    def prefixes(self) -> tuple[str, str]:
        """Store-name prefixes to strip, longest first."""
        return (f"{self.name} Coffee ", f"{self.name} ")

    @property
    def slug(self) -> str:
        """The brand part of a feed-B file name."""
        return f"{self.name.lower()}coffee"

    @property
    def display_prefix(self) -> str:
        return f"{self.name} Coffee "


@dataclass(frozen=True)
class Settings:
    """Bounds that the reports read instead of the wall clock."""

    as_of: dt.date | None = None  # reporting date; None is the last sale date
    calendar_years_ahead: int = 3
    brand: Brand = field(default_factory=Brand)
