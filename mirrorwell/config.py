"""What a refresh copies, and how."""

from __future__ import annotations

import json
import warnings
from dataclasses import asdict, dataclass, field

from mirrorwell.functions.names import identifier, table_list

# Names and defaults that users of the configuration rely on.
AUTO = "auto"
COMMIT_MODES = ("per_table", "defer_insert_commits")
COMMIT_ALIASES = {"all_or_nothing": "defer_insert_commits"}
STRATEGIES = ("direct_copy", "parallel_dml", "chunked_staging", "partition_exchange")
VERIFY_MODES = ("rows", "hash", "sample")
CONSISTENT_READ = ("scn", "none")


@dataclass(frozen=True)
class RefreshConfig:
    """One refresh job. Names are upper-cased; bad values raise ``ValueError``.

    ``tables`` is a list, or comma-separated text. ``verify`` is the check that
    decides whether a load may be published. ``consistent_read="none"`` reads
    the live source instead of a pinned snapshot.
    """

    source_schema: str
    target_schema: str
    tables: tuple[str, ...] | list[str] | str
    auto_include_fk_parents: bool = True
    recreate_tables: bool = False
    commit_mode: str = "per_table"
    strategy: str = AUTO
    max_parallel: int = 4
    max_chunks_per_table: int = 4
    supports_chunks: bool = True
    verify: str = "rows"
    sample_every: int = 100
    consistent_read: str = "scn"
    defaults: dict[str, dict[str, object]] = field(default_factory=dict)

    def __post_init__(self):
        put = lambda name, value: object.__setattr__(self, name, value)
        wanted = self.tables.split(",") if isinstance(self.tables, str) else self.tables
        put("tables", tuple(table_list(wanted)))
        put("source_schema", identifier(self.source_schema))
        put("target_schema", identifier(self.target_schema))
        if not self.tables:
            raise ValueError("name at least one table")
        if self.commit_mode in COMMIT_ALIASES:
            new = COMMIT_ALIASES[self.commit_mode]
            warnings.warn(
                f"commit_mode={self.commit_mode!r} is an old name for {new!r}",
                DeprecationWarning,
                stacklevel=3,
            )
            put("commit_mode", new)
        self._one_of("commit_mode", COMMIT_MODES)
        self._one_of("strategy", (AUTO, *STRATEGIES))
        self._one_of("verify", VERIFY_MODES)
        self._one_of("consistent_read", CONSISTENT_READ)
        for name in ("max_parallel", "max_chunks_per_table", "sample_every"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")

    def _one_of(self, name: str, allowed: tuple[str, ...]):
        if getattr(self, name) not in allowed:
            raise ValueError(f"{name}={getattr(self, name)!r} is not one of {allowed}")

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True, default=str)

    @classmethod
    def from_json(cls, text: str) -> RefreshConfig:
        return cls(**json.loads(text))
