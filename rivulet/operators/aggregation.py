"""Grouped record statistics, their windows and mergeable partial states."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rivulet.operators.ordered import scan
from rivulet.records import as_number, is_typed, number_at, parsed, payload_size, text_at


def _inputs(df: DataFrame, field: str | None, group_by: str | None) -> DataFrame:
    """Group and number of every record: `_all` without a readable payload, `_null` without the field."""
    needs_json = any(path and not is_typed(df, path) for path in (field, group_by))
    staged = df.withColumn("__json", parsed()) if needs_json else df

    if not group_by:
        group = F.lit("_all")
    elif is_typed(df, group_by):
        group = F.coalesce(F.col(group_by).cast("string"), F.lit("_null"))
    else:
        json = F.col("__json")
        group = F.when(json.isNull() | F.is_variant_null(json), F.lit("_all")).otherwise(
            F.coalesce(text_at(json, group_by), F.lit("_null"))
        )
    if not field:
        number = F.lit(None).cast("double")
    elif is_typed(df, field):
        number = as_number(F.col(field)) if dict(df.dtypes).get(field) == "string" else F.col(field).try_cast("double")
    else:
        number = number_at(F.col("__json"), field)
    return staged.withColumns({"__group": group, "__number": number})


def partials(df: DataFrame, field: str | None = None, group_by: str | None = None, window: str | None = None,
             slide: str | None = None, time_col: str = "timestamp", watermark: str | None = None) -> DataFrame:
    """Mergeable state per group (and window): n, total, least, most."""
    staged = _inputs(df, field, group_by)
    keys: list[Column] = [F.col("__group").alias("group")]
    if watermark:
        staged = staged.withWatermark(time_col, watermark)
    if window:
        keys.append(F.window(time_col, window, slide).alias("window"))
    number = F.col("__number")
    return staged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(number).alias("total"),
        F.min(number).alias("least"),
        F.max(number).alias("most"),
    )


def session_partials(df: DataFrame, gap: str, field: str | None = None, group_by: str | None = None, time_col: str = "timestamp",
                     watermark: str | None = None, ranges: int | None = None) -> DataFrame:
    """Mergeable state per group and session. A session takes records that come at most `gap` after the one before;
    its window ends `gap` after its last record. Records without a time belong to none.

    On a stream Spark's session windows merge as records come, and close behind
    the watermark. A batch is cut in one ordered scan, so a group with many
    records is spread over tasks.
    """
    staged = _inputs(df, field, group_by).where(F.col(time_col).isNotNull())
    group, number = F.col("__group").alias("group"), F.col("__number")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(number).alias("total"), F.min(number).alias("least"), F.max(number).alias("most")]
    if df.isStreaming:
        staged = staged.withWatermark(time_col, watermark) if watermark else staged
        return staged.groupBy(group, F.session_window(time_col, gap).alias("session")).agg(*sums)
    width = int(pd.Timedelta(gap).total_seconds() * 1_000_000)
    at = F.col(time_col).cast("timestamp")
    narrow = staged.select(group, number, at.alias("at"), F.unix_micros(at).alias("__micros"))
    cut = scan(narrow, ["group"], ["at"], runs={"__run": (F.col("__micros"), width)}, ranges=ranges)
    ended = cut.groupBy("group", "__run").agg(*sums, F.min("at").alias("begin"), F.max("at").alias("end"))
    session = F.struct(F.col("begin").alias("start"), F.timestamp_add("MICROSECOND", F.lit(width), "end").alias("end"))
    return ended.select("group", session.alias("session"), "n", "total", "least", "most")


def merge_partials(*states: DataFrame) -> DataFrame:
    """Combine partial states of the same groups."""
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    keys = [c for c in ("group", "window") if c in union.columns]
    return union.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("most").alias("most"),
    )


def finish(state: DataFrame, op: str = "count") -> DataFrame:
    """Result rows of a state. The average divides by all records of the group."""
    total = F.coalesce(F.col("total"), F.lit(0.0))
    result = {
        "count": F.col("n").cast("double"),
        "sum": total,
        "avg": F.when(F.col("n") > 0, total / F.col("n")).otherwise(F.lit(0.0)),
        "min": F.col("least"),
        "max": F.col("most"),
    }.get(op, F.col("n").cast("double"))
    out = [F.col("group"), F.lit(op).alias("operation"), result.alias("result"), F.col("n").alias("count")]
    if "window" in state.columns:
        out.append(F.col("window.end").alias("window_end"))
    if "session" in state.columns:
        out += [F.col("session.start").alias("window_start"), F.col("session.end").alias("window_end")]
    return state.select(*out)


def aggregate(df: DataFrame, op: str = "count", field: str | None = None, group_by: str | None = None,
              window: str | None = None, slide: str | None = None, time_col: str = "timestamp",
              watermark: str | None = None, session: str | None = None) -> DataFrame:
    """`count`, `sum`, `avg`, `min` or `max` of a payload field per group and event-time window, or session with that gap.

    Every record counts, numeric or not. Groups without a number have a null
    minimum and maximum.
    """
    if session:
        return finish(session_partials(df, session, field, group_by, time_col, watermark), op)
    return finish(partials(df, field, group_by, window, slide, time_col, watermark), op)


#: What two transfers of one id must agree in to be the same.
_CONTENT = ("debit_account_id", "credit_account_id", "amount", "ledger")


def _sound(transfers: DataFrame, order: Sequence[str]) -> DataFrame:
    """Transfers that can post: id, content and their order."""
    ledger = F.coalesce(F.col("ledger"), F.lit(1)) if "ledger" in transfers.columns else F.lit(1)
    return transfers.withColumn("__reason", _rejection(transfers)).where("__reason = ''").select(
        F.col("id").cast("string").alias("id"), F.col("debit_account_id").cast("string").alias("debit_account_id"),
        F.col("credit_account_id").cast("string").alias("credit_account_id"),
        F.col("amount").try_cast("decimal(38,0)").alias("amount"), ledger.cast("int").alias("ledger"),
        *[F.col(c).alias(f"__order_{i}") for i, c in enumerate(order)])


def _shared_ids(sound: DataFrame) -> DataFrame:
    """Ids of several transfers. Only ids and counts move, after they were summed up where they are."""
    return sound.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id")


def _firsts(shared: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first transfer of every id by order, then by content; each map task passes on one per id."""
    own = Window.partitionBy("id").orderBy(*[f"__order_{i}" for i in range(len(order))], *_CONTENT)
    return shared.withColumn("__r", F.row_number().over(own)).where("__r = 1").select("id", *_CONTENT)


def balances(transfers: DataFrame, accounts: DataFrame | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Posted debits and credits per account.

    Transfers need an id, both accounts and an unsigned whole amount; the others
    are left to `invalid_transfers`. An id posts once: its first transfer by
    `order` (for instance the offset), or without an order and between equals the
    least by accounts, amount and ledger; later ones are replays, or rejected if
    they differ. Ledger and code default to 1. Ids stay text, amounts are exact
    decimals.
    """
    sound = _sound(transfers, order)
    complete = _firsts(sound, order)
    ledger, amount = F.col("ledger"), F.col("amount")
    none = F.lit(0).cast("decimal(38,0)")
    legs = F.array(
        F.struct(F.col("debit_account_id").cast("string").alias("account"), amount.alias("debit"), none.alias("credit")),
        F.struct(F.col("credit_account_id").cast("string").alias("account"), none.alias("debit"), amount.alias("credit")),
    )
    posted = (
        complete.select(ledger.cast("int").alias("ledger"), F.inline(legs))
        .groupBy("account", "ledger")
        .agg(
            F.sum("debit").cast("decimal(38,0)").alias("debits_posted"),
            F.sum("credit").cast("decimal(38,0)").alias("credits_posted"),
            F.count(F.lit(1)).alias("legs"),
        )
    )
    if accounts is None:
        return posted
    own = accounts.where("id IS NOT NULL").select(
        F.col("id").cast("string").alias("account"),
        (F.coalesce(F.col("ledger"), F.lit(1)) if "ledger" in accounts.columns else F.lit(1)).cast("int").alias("ledger"),
        (F.coalesce(F.col("code"), F.lit(1)) if "code" in accounts.columns else F.lit(1)).cast("int").alias("code"),
    )
    return own.join(posted, ["account", "ledger"], "left").fillna(0, ["legs"]).withColumns(
        {c: F.coalesce(F.col(c), none) for c in ("debits_posted", "credits_posted")}
    )


def _rejection(transfers: DataFrame) -> Column:
    """Why a transfer cannot post; empty if it can."""
    amount = F.col("amount")
    if isinstance(transfers.schema["amount"].dataType, T.NumericType):
        negative, whole = amount < 0, amount == F.floor(amount)
    else:
        negative, whole = F.trim(amount).startswith("-"), F.trim(amount).rlike("^[+]?[0-9]+$")
    missing = [F.when(F.col(name).isNull(), F.lit(f"{name} missing")) for name in ("id", "debit_account_id", "credit_account_id", "amount")]
    wrong = (
        F.when(amount.isNull(), None).when(negative, F.lit("amount negative")).when(~whole, F.lit("amount not whole"))
        .when(amount.try_cast("decimal(38,0)").isNull(), F.lit("amount out of range"))
    )
    return F.concat_ws(",", *missing, wrong)


def invalid_transfers(transfers: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Transfers the ledger rejects, with every reason.

    With an `order`, also those whose id was taken before, by a transfer with
    other accounts, another amount or ledger; an equal one is a replay and none.
    """
    rejected = transfers.withColumn("reason", _rejection(transfers)).where("reason <> ''")
    if order is None:
        return rejected
    sound = _sound(transfers, order)
    shared = sound.join(_shared_ids(sound), "id", "left_semi")
    first = _firsts(shared, order).select(F.col("id").alias("__id"), *[F.col(c).alias(f"__first_{c}") for c in _CONTENT])
    ledger = F.coalesce(F.col("ledger"), F.lit(1)) if "ledger" in transfers.columns else F.lit(1)
    own = {c: F.col(c).cast("string") for c in _CONTENT[:2]} | {"amount": F.col("amount").try_cast("decimal(38,0)"), "ledger": ledger.cast("int")}
    differs = F.lit(False)
    for c in _CONTENT:
        differs |= own[c] != F.col(f"__first_{c}")
    taken = transfers.withColumn("reason", _rejection(transfers)).where("reason = ''").join(first, F.col("id").cast("string") == F.col("__id"))
    return rejected.unionByName(taken.where(differs).withColumn("reason", F.lit("id taken by another transfer")).select(*transfers.columns, "reason"))


def replication_metrics(df: DataFrame) -> DataFrame:
    """Records and payload bytes per topic and partition."""
    return df.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(payload_size()).alias("bytes"),
        F.max("offset").alias("last_offset"),
    )


def error_counts(df: DataFrame, error_type: str = "error_type") -> DataFrame:
    """Failures by type."""
    return df.where(F.col(error_type).isNotNull()).groupBy(F.col(error_type).alias("error_type")).agg(
        F.count(F.lit(1)).alias("errors")
    )
