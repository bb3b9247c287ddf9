"""S9 landing of one named entity of the marketing-cloud pull connector,
with P1 (all fields) and P2 (values delivered as text)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

# The entities a pull flow may copy.
ENTITIES = (
    "Activity", "BounceEvent", "ClickEvent", "ContentArea", "DataExtension", "Email",
    "ForwardedEmailEvent", "ForwardedEmailOptInEvent", "Link", "LinkSend", "List", "ListSubscriber",
    "NotSentEvent", "OpenEvent", "Send", "SentEvent", "Subscriber", "SurveyEvent", "UnsubEvent",
    "AuditEvents", "Campaigns", "Interactions", "ContentAssets",
)


def check_entity(entity: str) -> str:
    if entity not in ENTITIES:
        raise ValueError(f"unknown entity {entity!r}")
    return entity


def map_all(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """An empty field list maps every field unchanged."""
    return df.select(*(fields or ["*"]))


def stringify(df: DataFrame) -> DataFrame:
    """Every value as text; nested values become JSON text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StructType, ArrayType, MapType)):
            out.append(F.to_json(c).alias(f.name))
        else:
            out.append(c.cast("string").alias(f.name))
    return df.select(*out)


def land_entity(df: DataFrame, entity: str, entity_col: str | None = None) -> DataFrame:
    """Rows of one entity (when several are mixed in one set), all fields, as text."""
    check_entity(entity)
    if entity_col:
        df = df.where(F.col(entity_col) == F.lit(entity))
    return stringify(map_all(df))
