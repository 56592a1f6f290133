"""Declared schemas of the engine's tables; nothing in the read path is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DOCUMENTS = "doc_id string, rel_path string, doc_type string, title string, content string, content_sha256 string, content_fingerprint string, byte_size long, source_modified_at timestamp, ingested_at timestamp"
CHUNKS = "chunk_id string, doc_id string, rel_path string, title string, doc_type string, chunk_index long, heading string, content string, char_start long, char_end long, token_estimate long, content_sha256 string, ingested_at timestamp"
RELATIONS = "relation_id string, doc_id string, rel_path string, source_entity string, source_kind string, relation string, target_entity string, target_kind string, evidence string, ingested_at timestamp"
VECTORS = "chunk_id string, embedding array<float>"
NODES = "node_id string, kind string, label string, doc_id string, rel_path string, in_degree long, out_degree long"
EDGES = "source_id string, target_id string, relation string, weight double, doc_id string, rel_path string, evidence string"
META = "key string, value string"

#: JSON-schema types and formats as columns of a landed table; anything nested is kept as JSON text.
JSON_TYPES = {"integer": "bigint", "number": "double", "boolean": "boolean", "string": "string"}
JSON_FORMATS = {"date-time": "timestamp", "date": "date", "time": "string"}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def column_type(schema: dict) -> str:
    """SQL type for a JSON-schema property; a list of types counts by its first one that is not null."""
    kind = schema.get("type", "string")
    if isinstance(kind, list):
        kind = next((k for k in kind if k != "null"), "string")
    return JSON_FORMATS.get(schema.get("format", ""), JSON_TYPES["string"]) if kind == "string" else JSON_TYPES.get(kind, "string")


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Explicit typed projection onto a declared schema; absent columns are null, others fall away, nested ones turn to JSON."""
    have = {f.name: f.dataType for f in df.schema}
    nested = lambda name: have[name].typeName() in ("struct", "array", "map")
    cols = []
    for f in struct(ddl):
        value = F.lit(None) if f.name not in have else F.to_json(f.name) if nested(f.name) and f.dataType.typeName() == "string" else F.col(f.name)
        cols.append(value.cast(f.dataType).alias(f.name))
    return df.select(*cols)
