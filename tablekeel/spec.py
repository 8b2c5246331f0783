"""The description of one target table: what to load, and how it is partitioned."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from zoneinfo import ZoneInfo

from tablekeel.errors import SpecError

# Partition types, and the strategies each of them allows.
STRATEGIES = {
    "day": ("single_day", "last_and_current_month"),
    "month": ("single_month",),
    "full": ("full", "view"),
}
#: How a day or month table is stored: a folder for each partition, or files that are sorted by its column.
LAYOUTS = ("partitioned", "clustered")
# Fixed value: where the quoted list of source days goes in a partitioned query.
DATE_LIST_PLACEHOLDER = "{target_date_list}"

# The fields that every description has.
REQUIRED_FIELDS = (
    "table",
    "schema",
    "partition_type",
    "partition_query",
    "processing_strategy",
)


@dataclass(frozen=True)
class LoadSpec:
    """A validated, immutable load description. Text fields are kept trimmed.

    Build it from a plain mapping with :meth:`from_mapping`, or directly. Either
    way an invalid combination raises :class:`SpecError` (a ``ValueError``).
    """

    table: str
    schema: str
    partition_type: str
    processing_strategy: str
    partition_query: str
    partition_column: str = ""
    catalog: str = ""
    time_zone: str = ""
    layout: str = ""

    @classmethod
    def from_mapping(cls, config: Mapping[str, str | None]) -> LoadSpec:
        if not isinstance(config, Mapping) or not config:
            raise SpecError("a load spec needs a non-empty mapping of fields")
        absent = [name for name in REQUIRED_FIELDS if config.get(name) is None]
        if absent:
            raise SpecError(f"load spec lacks required field(s): {', '.join(absent)}")
        known = {f.name for f in fields(cls)}
        return cls(**{name: config[name] for name in config if name in known})

    def __post_init__(self) -> None:
        for f in fields(self):
            value = getattr(self, f.name)
            if value is None and f.name not in REQUIRED_FIELDS:
                value = ""
            if not isinstance(value, str):
                raise SpecError(f"{f.name} must be text, got {type(value).__name__}")
            object.__setattr__(self, f.name, value.strip())
        self._check_fields()
        if self.is_partitioned:
            self._check_partitioned()
        else:
            self._check_full()

    def _check_fields(self) -> None:
        for name in ("table", "schema", "partition_query", "processing_strategy"):
            if not getattr(self, name):
                raise SpecError(f"{name} must not be blank")
        for name in ("table", "schema", "catalog"):
            if "." in getattr(self, name):
                raise SpecError(
                    f"{name} must be a single name without dots, got {getattr(self, name)!r}"
                )
        if self.time_zone:
            try:
                ZoneInfo(self.time_zone)
            except (ValueError, KeyError, OSError) as cause:
                raise SpecError(f"time_zone {self.time_zone!r} is not known") from cause
        if self.partition_type not in STRATEGIES:
            raise SpecError(
                f"partition_type must be one of {', '.join(STRATEGIES)}; got {self.partition_type!r}"
            )
        if self.is_view and self.partition_type != "full":
            raise SpecError("a view needs partition_type 'full'")
        if self.layout and (self.layout not in LAYOUTS or not self.is_partitioned):
            raise SpecError(f"layout is {' or '.join(LAYOUTS)}, for days and months only; got {self.layout!r}")
        allowed = STRATEGIES[self.partition_type]
        if self.processing_strategy not in allowed:
            raise SpecError(
                f"processing_strategy for partition_type {self.partition_type!r} must be one of "
                f"{', '.join(allowed)}; got {self.processing_strategy!r}"
            )

    def _check_partitioned(self) -> None:
        if not self.partition_column:
            raise SpecError(f"partition_column is required for partition_type {self.partition_type!r}")
        if DATE_LIST_PLACEHOLDER not in self.partition_query:
            raise SpecError(
                f"partition_query must use {DATE_LIST_PLACEHOLDER} for partition_type {self.partition_type!r}"
            )

    def _check_full(self) -> None:
        what = "a view" if self.is_view else "partition_type 'full'"
        if self.partition_column:
            raise SpecError(f"{what} takes no partition_column")
        if DATE_LIST_PLACEHOLDER in self.partition_query:
            raise SpecError(f"{what} takes no {DATE_LIST_PLACEHOLDER} in partition_query")

    def check_target_date(self, target_date: str | None) -> None:
        """Whole-table loads and views cover everything, so they take no date request."""
        if target_date and not self.is_partitioned:
            what = "a view" if self.is_view else "partition_type 'full'"
            raise SpecError(f"{what} takes no target_date, got {target_date!r}")

    @property
    def is_partitioned(self) -> bool:
        return self.partition_type in ("day", "month")

    @property
    def is_clustered(self) -> bool:
        return self.layout == "clustered"

    @property
    def is_view(self) -> bool:
        return self.processing_strategy == "view"

    @property
    def target(self) -> str:
        """The quoted name of the target, ready for ``spark.table`` or SQL text."""
        return self.sibling(self.table)

    def sibling(self, table: str) -> str:
        """The quoted name of another table in the target's schema."""
        return f"{self.target_schema}.{quoted(table)}"

    @property
    def target_schema(self) -> str:
        """The quoted name of the target's schema."""
        return ".".join(quoted(part) for part in (self.catalog, self.schema) if part)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
