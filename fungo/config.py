"""Names and sizes that a deployment may change."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    """Layer names, raw table names and the ingestion chunk length.

    Marts are stored as tables; raw, staging and reporting are views unless they are saved too.
    """

    raw_database: str = "raw"
    staging_database: str = "staging"
    marts_database: str = "marts"
    reporting_database: str = "reporting"
    pitch_table: str = "statcast_pitches"
    reference_tables: tuple[str, ...] = field(
        default=("player_lookup", "mlb_teams", "mlb_rosters", "mlb_roster_status")
    )
    chunk_size_days: int = 7

    @property
    def source_names(self) -> tuple[str, ...]:
        return (self.pitch_table, *self.reference_tables)
