"""Typed fields out of JSON text columns.

One from_json with a schema holding just the wanted leaves reads each document
once, however many fields are taken. Leaves are read as text and then cast, so a
field behaves as a JSON path extraction followed by a cast would.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOC = "_doc"
MALFORMED = "_malformed"


def text_schema(paths: Iterable[str]) -> T.StructType:
    """Nested struct with a string leaf for every dotted path."""
    tree: dict = {}
    for path in paths:
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
            if node is None:
                raise ValueError(f"{path}: {name} is taken as a value by another path")
        if node.get(leaf) is not None:
            raise ValueError(f"{path} is the parent of another path")
        node[leaf] = None

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(name, T.StringType() if child is None else build(child)) for name, child in node.items()
        ])

    return build(tree)


def typed(text: Column, kind: str, strict: bool = True) -> Column:
    """Cast text to a type; strict raises on bad text, otherwise it gives NULL."""
    target = "bigint" if kind == "epoch_ms" else kind
    value = text.cast(target) if strict else text.try_cast(target)
    return F.timestamp_millis(value) if kind == "epoch_ms" else value


def with_document(df: DataFrame, paths: Iterable[str], payload: str = "payload", keep: Iterable[str] = ()) -> DataFrame:
    """`keep` columns plus the parsed document, with a flag for malformed text.

    The document comes out of a generator rather than a projection: a later filter
    on a parsed field would otherwise be pushed down with the parsing in it, and
    every document be read twice.
    """
    schema = text_schema(paths).add(MALFORMED, T.StringType())
    doc = F.from_json(payload, schema, {"columnNameOfCorruptRecord": MALFORMED})
    return df.select(*keep, F.explode(F.array(doc)).alias(DOC))


def flatten_payload(
    df: DataFrame,
    fields: Mapping[str, tuple[str, str]],
    payload: str = "payload",
    keep: Iterable[str] = (),
    strict: bool = True,
) -> DataFrame:
    """One row per document: `keep` columns plus each field at its type.

    Field names are matched case-sensitively. A missing field, a JSON null and a
    text that is not JSON all give NULL; a present value of the wrong type raises
    when strict and gives NULL when not (see flatten_rejects).
    """
    keep = list(keep)
    parsed = with_document(df, [path for path, _ in fields.values()], payload, keep)
    return parsed.select(
        *keep, *[typed(F.col(f"{DOC}.{path}"), kind, strict).alias(name) for name, (path, kind) in fields.items()]
    )


def parse_mode(strict: bool) -> dict[str, str]:
    """from_json options: raise on a document that cannot be read in full, or give NULLs."""
    return {"mode": "FAILFAST" if strict else "PERMISSIVE"}


def array_rejects(df: DataFrame, schema: str, path: str, payload: str = "payload", keep: Iterable[str] = ()) -> DataFrame:
    """Documents that give no rows, or rows with gaps, when the array at `path` is unfolded, with the reason.

    `reason` is "malformed" for a missing payload or one that is not JSON, "missing" where the document
    has no such array, and "wrong type" where the array is there but some value was not readable.
    Documents not named here are read in full.
    """
    doc = F.from_json(payload, f"{schema}, {MALFORMED} string", {"columnNameOfCorruptRecord": MALFORMED})
    # an object without the array still names the fields it has; text that is no object does not
    is_object = F.coalesce(F.try_parse_json(payload).isNotNull(), F.lit(False))
    parsed = df.select(*keep, F.col(payload).alias("_text"), is_object.alias("_is_json"), F.explode(F.array(doc)).alias(DOC))
    rows = F.col(f"{DOC}.{path}")
    reason = (
        F.when(~F.col("_is_json"), F.lit("malformed")).when(rows.isNull(), F.lit("missing"))
        .when(F.col(f"{DOC}.{MALFORMED}").isNotNull(), F.lit("wrong type"))
    )
    return parsed.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())


def flatten_rejects(
    df: DataFrame,
    fields: Mapping[str, tuple[str, str]],
    payload: str = "payload",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Documents the permissive mode could not read in full, with the reason.

    `reason` is "malformed" for text that is not JSON, else the comma-separated
    names of the fields holding a value of the wrong type.
    """
    keep = list(keep)
    parsed = with_document(df, [path for path, _ in fields.values()], payload, keep)
    bad = [
        F.when(F.col(f"{DOC}.{path}").isNotNull() & typed(F.col(f"{DOC}.{path}"), kind, False).isNull(), F.lit(name))
        for name, (path, kind) in fields.items()
        if kind != "string"
    ]
    reason = F.when(F.col(f"{DOC}.{MALFORMED}").isNotNull(), F.lit("malformed"))
    reason = reason.otherwise(F.nullif(F.concat_ws(",", *bad), F.lit(""))) if bad else reason
    return parsed.select(*keep, reason.alias("reason")).filter(F.col("reason").isNotNull())
