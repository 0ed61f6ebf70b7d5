"""Run targets and the few settings that are shared between stages."""

from __future__ import annotations

from dataclasses import dataclass

# The smoke-test target reads this many product documents.
TEST_DOCUMENT_LIMIT = 20


@dataclass(frozen=True)
class Settings:
    table_suffix: str
    limit: int | None
    prefix: str = "reviews"

    def table(self, stage: str) -> str:
        """Name of the table that holds ``stage`` (for example ``tv_raw`` or ``gold``)."""
        return f"{self.prefix}_{stage}{self.table_suffix}"


def settings(target: str, prefix: str = "reviews") -> Settings:
    """Settings for a run target; case and surrounding blanks do not matter."""
    name = target.strip().upper()
    if name == "TEST":
        return Settings("_test", TEST_DOCUMENT_LIMIT, prefix)
    if name == "PROD":
        return Settings("", None, prefix)
    raise ValueError(f"target must be TEST or PROD, got {target!r}")
