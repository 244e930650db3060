"""The entities that are extracted: how each is keyed, extracted and dated. operators.incremental takes an Entity instead of a file each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Entity:
    name: str
    source: str
    key: str
    delta: bool  # each extraction has changed rows only, not all rows
    date_col: str | None = None  # dates a row's first appearance; none: the extraction's time does
    schema: StructType | str | None = None
    unhashed: tuple[str, ...] = ()  # columns whose change alone is no change


#: Entity names, keys and date columns of the two known sources.
_DDD_DELTA = ("aktoer", "moede", "sag", "sagstrin", "sagstrinaktoer", "stemme")
_DDD_FULL = ("afstemning", "afstemningstype", "aktoertype", "moedestatus", "moedetype", "periode", "sagskategori", "sagsstatus", "sagstrinsstatus", "sagstrinstype", "sagstype", "stemmetype")
_RFAM = (
    ("family", "rfam_acc", True, "updated"), ("genome", "upid", True, "updated"), ("clan", "clan_acc", False, "updated"),
    ("clan_membership", "rfam_acc", False, None), ("author", "author_id", False, None), ("literature_reference", "pmid", False, None), ("dead_family", "rfam_acc", False, None),
)

ENTITIES: dict[tuple[str, str], Entity] = {
    ("DDD", name): Entity(name, "DDD", "id", delta, "opdateringsdato") for names, delta in ((_DDD_DELTA, True), (_DDD_FULL, False)) for name in names
} | {("RFAM", name): Entity(name, "RFAM", key, delta, date) for name, key, delta, date in _RFAM}

#: Days that an incremental extraction looks back by default.
LOOKBACK_DAYS = {"DDD": 31, "RFAM": 365}


def entities(source: str | None = None, delta: bool | None = None) -> list[Entity]:
    return [e for e in ENTITIES.values() if source in (None, e.source) and delta in (None, e.delta)]
