"""Keyed documents: actions for a bulk writer, and the table they lead to.

A document table has an ``id`` and one column per field. The last writer is the one with
the highest ``order_by``; where those columns tie, either may win, so end them on a
column that is unique.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, IntegerType, LongType, NumericType, StructField, TimestampNTZType, TimestampType

from flightlane.functions.text import natural_key


def index_actions(rows: DataFrame, index: str, key: list[str], fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """Insert-or-replace actions under a natural key. Rows need to be gated before."""
    return _actions(rows, index, "index", natural_key(key), fields, keep)


def append_actions(rows: DataFrame, index: str, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """Insert actions under a random id: a second run adds the rows again."""
    return _actions(rows, index, "index", F.uuid(), fields, keep)


def upsert_actions(rows: DataFrame, index: str, key: list[str], fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """Actions that set the given fields of a document and insert it when it is missing."""
    return _actions(rows, index, "update", natural_key(key), fields, keep).withColumn("doc_as_upsert", F.lit(True))


def _actions(rows: DataFrame, index: str, op_type: str, id: Column, fields: list[str], keep: list[str] | None) -> DataFrame:
    return rows.select(
        F.lit(op_type).alias("op_type"), F.lit(index).alias("index"), id.alias("id"),
        F.struct(*fields).alias("source"), *keep or [],
    )


def bulk_lines(actions: DataFrame, gate: Column | None = None) -> DataFrame:
    """Actions as text, two lines each: what to do, then the document. Null where ``gate`` is not passed."""
    target = F.struct(F.col("index").alias("_index"), F.col("id").alias("_id"))
    head = F.to_json(F.create_map("op_type", target))
    body = F.to_json("source", {"ignoreNullFields": "false"})
    if "doc_as_upsert" in actions.columns:
        body = F.concat(F.lit('{"doc":'), body, F.lit(',"doc_as_upsert":true}'))
    lines = F.concat_ws("\n", head, body)
    return actions.select((lines if gate is None else F.when(gate, lines)).alias("value"))


def tag_rows(rows: DataFrame, name: str = "unique_id") -> DataFrame:
    """A random id per row. Tag after the gates: they do not move below a random column."""
    return rows.withColumn(name, F.uuid())


def documents(actions: DataFrame) -> DataFrame:
    """The documents of index actions as a flat table, several versions of an id included."""
    kept = [name for name in actions.columns if name not in ("op_type", "index", "id", "source", "doc_as_upsert")]
    return actions.select("id", "source.*", *kept)


def latest_by(rows: DataFrame, key: list[str], order_by: list[str], keep: list[str] | None = None, unique: bool = False,
              few: bool = False) -> DataFrame:
    """One row per key: the one with the highest ``order_by``, nulls lowest.

    Orders of fixed width (a number, a date or a time, or a time before a whole number) are found with a
    hash aggregate over the narrow columns alone, and a semi join keeps the winners, so payloads are
    neither sorted nor held in an aggregate, and a hot key reaches the shuffle as one narrow row per
    task. ``rows`` are read twice then, the first time for key and order only: write them first where
    they are expensive to compute. Other orders, texts for instance, are about as wide as what they
    order; there the whole row is aggregated, one per key and task.

    ``keep`` names the columns to carry beside the key, all by default. ``unique`` promises that no two
    rows of a key tie; without it, winners that tie are reduced to one. ``few`` promises a
    bounded handful of keys, such as the routes of a fixed map: then their highest orders are broadcast
    and no payload is shuffled.
    """
    values = [name for name in rows.columns if name not in key] if keep is None else keep
    order = fixed_order([rows.schema[name] for name in order_by])
    if order is None:
        return rows.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order_by)).alias("_last")).select(*key, "_last.*")
    names = [f"_key{n}" for n in range(len(key))]
    top = rows.groupBy(*[F.col(k).alias(n) for k, n in zip(key, names)]).agg(F.max(order).alias("_top"))
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)]
    last = rows.join(F.broadcast(top) if few else top, reduce(and_, [*same, order.eqNullSafe(F.col("_top"))]), "left_semi").select(*key, *values)
    return last if unique else last.dropDuplicates(key)


#: Above any long, and so far apart that a long fits between two.
_STEP = "20000000000000000000"


def fixed_order(fields: list[StructField]) -> Column | None:
    """One column of fixed width that orders as the given ones do, one after the other, nulls lowest;
    None where there is none."""
    kinds = [f.dataType for f in fields]
    if len(fields) == 1 and isinstance(kinds[0], (NumericType, DatetimeType, BooleanType)):
        return F.col(fields[0].name)
    if len(fields) == 2 and isinstance(kinds[0], (TimestampType, TimestampNTZType)) and isinstance(kinds[1], (LongType, IntegerType)):
        micros = F.unix_micros(F.col(fields[0].name).cast("timestamp")).cast("decimal(20,0)")
        number = F.col(fields[1].name).cast("decimal(20,0)")
        whole = F.coalesce(micros, F.lit("-4500000000000000000").cast("decimal(20,0)")) * F.lit(_STEP).cast("decimal(20,0)")
        return whole.cast("decimal(38,0)") + F.coalesce(number, F.lit("-10000000000000000000").cast("decimal(20,0)"))
    return None


def replace_documents(
    current: DataFrame, incoming: DataFrame, fields: list[str], order_by: list[str], key: str = "id"
) -> DataFrame:
    """``current`` after whole documents were replaced or added: fields that the new document
    does not have are gone."""
    return _combine(current, incoming, fields, order_by, key, survive=False)


def merge_documents(
    current: DataFrame, updates: DataFrame, fields: list[str], order_by: list[str], key: str = "id"
) -> DataFrame:
    """``current`` after field-wise updates: a supplied field wins even when it is null, all
    other fields survive, and missing documents are inserted."""
    return _combine(current, updates, fields, order_by, key, survive=True)


def index_documents(actions: DataFrame, order_by: list[str]) -> DataFrame:
    """The documents that index actions leave behind in an empty index."""
    fields = actions.select("source.*").columns
    return latest_by(documents(actions), ["id"], order_by, keep=fields)


def _combine(
    current: DataFrame, incoming: DataFrame, fields: list[str], order_by: list[str], key: str, survive: bool
) -> DataFrame:
    # one row per id on both sides, so no id can be hot in the join
    last = latest_by(incoming, [key], order_by, keep=fields)
    new = last.select(F.col(key).alias("_key"), F.struct(*fields).alias("_new"), F.lit(True).alias("_hit"))
    joined = current.join(new, F.col(key) == F.col("_key"), "full_outer")

    columns = [name for name in current.columns if name != key]
    columns += [name for name in fields if name not in columns]

    def value(name: str) -> Column:
        old = F.col(name) if name in current.columns else F.lit(None)
        if name in fields:
            supplied = F.col("_new")[name]
        else:
            supplied = old if survive else F.lit(None)
        return F.when(F.col("_hit"), supplied).otherwise(old).alias(name)

    return joined.select(F.coalesce(key, "_key").alias(key), *[value(name) for name in columns])
