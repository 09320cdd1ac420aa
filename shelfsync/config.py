"""Plain configuration values, built on the driver and shipped as literals."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Sync modes.  ``quick`` skips rows that are known, fresh and unchanged;
# ``full`` skips rows that are known and unchanged, whatever their age;
# ``force`` skips nothing.  Other strings are rejected.
MODES = ("quick", "full", "force")

# Mapping roles in the order the source row is built (and hashed).
ROLE_ORDER = ("id", "description", "code", "price", "display_name",
              "manufactory", "stock", "promotion_price", "need_prescription")
REQUIRED_ROLES = ("id", "description", "code", "price")


@dataclass(frozen=True)
class ColumnMapping:
    """Which source column plays which product role."""

    id: str = "id"
    description: str = "descricao"
    code: str = "codigo"
    price: str = "preco"
    display_name: str | None = None
    manufactory: str | None = None
    stock: str | None = None
    promotion_price: str | None = None
    need_prescription: str | None = None

    def roles(self) -> list[tuple[str, str]]:
        """(role, column) for every mapped role, in mapping order."""
        return [(r, getattr(self, r)) for r in ROLE_ORDER if getattr(self, r)]

    def source_columns(self) -> list[str]:
        """Mapped source columns, first occurrence kept: a column mapped to two
        roles is read, and fingerprinted, once."""
        seen: list[str] = []
        for _, c in self.roles():
            if c not in seen:
                seen.append(c)
        return seen


@dataclass(frozen=True)
class SyncConfig:
    workspace_id: str
    mapping: ColumnMapping = field(default_factory=ColumnMapping)
    mode: str = "full"
    stale_minutes: int = 60
    batch_size: int = 50
    # Titles are looked up when the run is given a lookup, unless this is False.
    lookup_enabled: bool | None = None
    lookup_concurrency: int = 5
    # When set, a vector of another width counts as a failed embedding.
    embedding_dim: int | None = None
    repair_orphans: bool = False
    exact_cents: bool = False
    # Optional source column ordering snapshots of one key (e.g. an event
    # time): when set, the latest snapshot of a key wins over duplicates.
    order_by: str | None = None

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"unknown sync mode {self.mode!r}; expected one of {MODES}")
        if self.batch_size <= 0 or self.lookup_concurrency <= 0:
            raise ValueError("batch_size and lookup_concurrency must be positive")


def as_of_now() -> dt.datetime:
    """One wall-clock instant per run, naive UTC, truncated to microseconds."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


# Promotions run from the sync instant for ten 365-day years (not calendar years).
PROMO_WINDOW = dt.timedelta(days=3650)
