"""Settings shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass, replace

BY_SERVICE_PATH = "db-by-service-path"
BY_ENTITY = "db-by-entity"
BY_ENTITY_TYPE = "db-by-entity-type"
BY_ENTITY_ID = "db-by-entity-id"
BY_ATTRIBUTE = "db-by-attribute"


@dataclass(frozen=True)
class Options:
    """One sink configuration. ``version`` is ``"v2"`` or ``"ld"``."""

    version: str = "v2"
    data_model: str = BY_ENTITY
    enable_encoding: bool = True
    enable_lowercase: bool = True
    default_service: str = "test"
    default_service_path: str = "/path"
    ckan_compatible: bool = False
    md_default: str = "[]"
    db_prefix: str = "sth_"
    collection_prefix: str = "sth_"
    swap_coordinates: bool = False
    #: Rows of an attribute with ``TimeInstant`` metadata take their time from it.
    time_instant: bool = False

    def __post_init__(self):
        if self.version not in ("v2", "ld"):
            raise ValueError(f"unknown notification version {self.version!r}")

    def but(self, **changes) -> "Options":
        return replace(self, **changes)
