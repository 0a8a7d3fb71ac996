"""Run parameters (the public knobs of every model)."""

from __future__ import annotations

from dataclasses import dataclass, replace

# Project defaults that results depend on.
DEFAULT_LOOKBACK_DAYS = 3
DEFAULT_EPOCH_OFFSET = 132
DEFAULT_START_DATE = "2023-06-01 00:00:00"
DEFAULT_WETH_CUTOFF = "2024-03-11 00:00:00"
# The validator identity key and vote key whose rewards count as native staking.
DEFAULT_RECIPIENTS = (
    "722RdWmHC5TGXBjTejzNjbc8xEiduVDLqZvoUGz6Xzbp",
    "EXhYxF25PJEHb3v5G1HY8Jn8Jm7bRjJtaxEghGrUuhQw",
)


@dataclass(frozen=True)
class Params:
    """Knobs shared by all models.

    ``as_of`` replaces the wall clock (``now()``) so runs are repeatable;
    ``None`` means "use the current time" where a model needs it.
    ``lookback_anchor`` picks where an incremental run's lookback starts:
    ``"target"`` = newest date already stored (the models' rule), ``"as_of"``
    = the run's clock (the documented late-data backfill pattern, T6).
    ``per_source_cutoff`` gives each staking source its own cutoff (from its
    own newest stored date) instead of one shared cutoff.
    """

    lookback_days: int = DEFAULT_LOOKBACK_DAYS
    epoch_offset: int = DEFAULT_EPOCH_OFFSET
    start_date: str = DEFAULT_START_DATE
    weth_cutoff: str = DEFAULT_WETH_CUTOFF
    recipients: tuple[str, ...] = DEFAULT_RECIPIENTS
    as_of: str | None = None
    lookback_anchor: str = "target"
    per_source_cutoff: bool = False

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


# Parameters used with the driver-table adapters (sources.fixtures).
TEST_PARAMS = Params(weth_cutoff="2024-01-15 00:00:00", recipients=("id_key", "vote_key"))
