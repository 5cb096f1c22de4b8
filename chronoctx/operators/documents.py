"""Bucket documents: the nested form in which a store keeps time buckets.

A document has an ``_id`` struct, whose fields follow from the data model, the type
of the attribute and one point for every slot of its range. What the model leaves
out of ``_id`` names the collection. Points are dense and in order of their offset, so
two documents are merged slot by slot, without taking them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoctx import options as O
from chronoctx.operators import buckets as B
from chronoctx.operators import retention as R
from chronoctx.sinks import maintenance as MT
from chronoctx.sinks import versions as V

# Names of the fields of ``_id``.
ID_FIELDS = {"entity_id": "entityId", "entity_type": "entityType", "attr_name": "attrName"}
_RANGE = ["origin", "resolution", "range"]


def collection_keys(model: str) -> list[str]:
    """The columns that name the collection of a document."""
    if model not in B.MODEL_KEYS:
        raise ValueError(f"data model must be one of {tuple(B.MODEL_KEYS)}")
    return ["service_path", *(k for k in ID_FIELDS if k not in B.MODEL_KEYS[model])]


def document(dense: DataFrame, model: str) -> DataFrame:
    """Documents of one data model from ``dense_numeric``, which serves all of them."""
    fields = [F.col(k).alias(ID_FIELDS[k]) for k in B.MODEL_KEYS[model]] + [F.col(c) for c in _RANGE]
    return dense.select(*collection_keys(model), F.struct(*fields).alias("_id"), F.col("attr_type").alias("attrType"), "points")


def _typed(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """The attribute type that a document was last seen with."""
    return buckets.groupBy(*keys, "resolution", "range", "origin").agg(F.max_by("attr_type", F.struct("last_ts", "attr_type")).alias("attr_type"))


def _keys() -> list[str]:
    return ["service_path", *ID_FIELDS]


def numeric_documents(
    rows: DataFrame, model: str = O.BY_ENTITY, value: str = "value", ts: str = "recv_time_ts", resolutions: tuple[str, ...] = B.ALL_RESOLUTIONS,
) -> DataFrame:
    """Rows (``service_path``, ``entity_id``, ``entity_type``, ``attr_name``,
    ``attr_type``, value and time; keys not null) to documents with numeric points."""
    return document(dense_numeric(rows, value, ts, resolutions), model)


def dense_numeric(
    rows: DataFrame, value: str = "value", ts: str = "recv_time_ts", resolutions: tuple[str, ...] = B.ALL_RESOLUTIONS,
) -> DataFrame:
    """Numeric points and last type of every document, whatever its data model."""
    buckets = B.numeric_buckets(rows, _keys(), value, ts, resolutions, "attr_type")
    placed = buckets.dropna(subset=[*_keys(), "resolution", "range", "origin"])
    return B.dense_points(placed, _keys(), attr_type=F.max_by("attr_type", F.struct("last_ts", "attr_type")))


def categorical_documents(
    rows: DataFrame, model: str = O.BY_ENTITY, value: str = "value", ts: str = "recv_time_ts", resolutions: tuple[str, ...] = B.ALL_RESOLUTIONS,
) -> DataFrame:
    """The same with points that count every value (``occur``)."""
    typed = B.categorical_buckets(rows, [*_keys(), "attr_type"], value, ts, resolutions)
    points = B.occurrence_points(typed, _keys(), value)
    merged = [*_keys(), "resolution", "range", "origin"]
    return document(B.dense_occurrences(points, _keys()).join(_typed(typed, _keys()), merged), model)


def _merged_point(a: Column, b: Column, names: list[str]) -> Column:
    def both(name: str) -> Column:
        if name == "offset":
            return a[name]
        if name == "min":
            return F.least(a[name], b[name])
        if name == "max":
            return F.greatest(a[name], b[name])
        if name == "occur":
            return F.map_zip_with(a[name], b[name], lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))
        return a[name] + b[name]

    return F.struct(*[both(n).alias(n) for n in names])


def merge_documents(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored documents with fresh ones merged into them, and the fresh ones that
    are new. Counts and sums of a slot add up, the last type is the fresh one. Either side
    has one document of an ``_id`` in a collection, and both have one form."""
    keys = [c for c in stored.columns if c not in ("attrType", "points")]
    names = stored.schema["points"].dataType.elementType.fieldNames()
    new = fresh.select(*keys, F.col("attrType").alias("_type"), F.col("points").alias("_points"))
    both = F.zip_with("points", "_points", lambda a, b: _merged_point(a, b, names))
    points = F.when(F.col("_points").isNull(), F.col("points")).when(F.col("points").isNull(), F.col("_points")).otherwise(both)
    return stored.join(new, keys, "full").select(*keys, F.coalesce("_type", "attrType").alias("attrType"), points.alias("points"))


def retain_documents(documents: DataFrame, now_ms: int, expiration_s: int) -> DataFrame:
    """Documents whose ``origin`` has not expired (time to live)."""
    return R.retain_age(documents, F.unix_millis("_id.origin"), now_ms, expiration_s)


def upsert(spark: SparkSession, root: str, table: str, fresh: DataFrame, token: str | None = None) -> int:
    """Merge documents into a stored table (``sinks.versions``) in one version.
    Only the files that hold documents to change are written anew. A ``token`` that a
    version already has changes nothing, so a repeated batch counts once; if another
    writer comes first, this one fails with ``Conflict`` and can be repeated."""
    known = V.versions(spark, root)
    for number, record in known.items():
        if token is not None and record.get("token") == token:
            return number
    layout = {"partitions": ("resolution",), "order": ("_id",), "time_ms": "origin_ms", "token": token, "based_on": max(known, default=0)}
    placed = _placed(fresh)
    stored = V.read(spark, root, table)
    if stored is not None:
        keys = [c for c in fresh.columns if c not in ("attrType", "points")]
        touched = stored.select(*keys, F.col("_metadata.file_path").alias("path")).join(fresh.select(*keys), keys, "left_semi").select("path").distinct()
        done = V.rewrite(spark, root, table, touched, lambda part: _placed(merge_documents(part.select(*fresh.columns), fresh)), **layout)
        if done is not None:
            return done
    return V.commit(spark, root, {table: placed}, **layout)


def _placed(documents: DataFrame) -> DataFrame:
    return documents.withColumns({"resolution": F.col("_id.resolution"), "origin_ms": F.unix_millis("_id.origin")})


def drop_expired(spark: SparkSession, root: str, table: str, now_ms: int, expiration_s: int) -> int | None:
    """Time to live on ``origin`` in a stored table."""
    return MT.drop_expired(spark, root, table, now_ms, expiration_s, "origin_ms", partitions=("resolution",), order=("_id",))
