"""Decoding of landed JSON-RPC replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_hash, quantity

BLOCK_REPLY = "number string, hash string, parentHash string, timestamp string, baseFeePerGas string, gasUsed string, gasLimit string, transactions array<string>"
FEE_REPLY = "oldestBlock string, reward array<array<string>>"

# JSON-RPC error codes.
FATAL_CODES = (-32700, -32600, -32601, -32602, -32000, -32001, -32003, -32004, -32006)
LIMIT_CODE = -32005


def _first_reason(*checks: tuple[Column, str]) -> Column:
    """The name of the first check that fails; null if none does. A null check fails."""
    return F.coalesce(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for ok, name in checks))


def _once(rows: DataFrame, **made: Column) -> DataFrame:
    """rows with the columns made, each worked out once a row: exploding one struct keeps the optimizer from writing it out at each use."""
    held = F.struct(*(c.alias(name) for name, c in made.items()))
    return rows.select("*", F.explode(F.array(held)).alias("_made")).select(*rows.columns, "_made.*")


def decode_headers(raw: DataFrame) -> DataFrame:
    """One row per reply: the decoded columns, and reject_reason (null for a valid block).

    raw has `requested`, the block asked for, and `reply`, the JSON text. The columns of a rejected
    reply are null except for block_number, which is then the requested one.
    """
    parsed = _once(raw.select("requested", "reply"), r=F.from_json("reply", BLOCK_REPLY))
    made = _once(
        parsed,
        number=quantity(F.col("r.number")),
        block_hash=F.col("r.hash"),
        parent_hash=F.col("r.parentHash"),
        timestamp=quantity(F.col("r.timestamp")),
        base_fee_per_gas=quantity(F.col("r.baseFeePerGas")),
        gas_used=quantity(F.col("r.gasUsed")),
        gas_limit=quantity(F.col("r.gasLimit")),
        tx_count=F.when(F.col("r.transactions").isNotNull(), F.size("r.transactions").cast("bigint")),
    )
    reason = _first_reason(
        (F.col("number").isNotNull(), "number"),
        (F.col("number") == F.col("requested"), "other_block"),
        (is_hash(F.col("block_hash")), "block_hash"),
        (is_hash(F.col("parent_hash")), "parent_hash"),
        (F.col("timestamp").isNotNull(), "timestamp"),
        (F.col("base_fee_per_gas") > 0, "base_fee_per_gas"),
        (F.col("gas_limit") > 0, "gas_limit"),
        (F.col("gas_used") <= F.col("gas_limit"), "gas_used"),
        (F.col("tx_count").isNotNull(), "tx_count"),
    )
    names = ("timestamp", "block_hash", "parent_hash", "base_fee_per_gas", "gas_used", "gas_limit", "tx_count")
    judged = _once(made, reject_reason=reason)
    kept = [F.when(F.col("reject_reason").isNull(), F.col(c)).alias(c) for c in names]
    return judged.select(F.col("requested").alias("block_number"), *kept, "reject_reason")


def decode_fee_history(raw: DataFrame, percentiles: list[int]) -> DataFrame:
    """One row per block: block_number and a column p<percentile> each; plus reject_reason.

    raw has start_block, block_count and reply. A reply must begin at its start, hold one reward row
    per block and one entry per percentile, all valid quantities. A rejected reply gives one row.
    """
    parsed = raw.select("start_block", "block_count", F.from_json("reply", FEE_REPLY).alias("r"))
    reward = F.col("r.reward")
    judged = parsed.withColumn(
        "reject_reason",
        _first_reason(
            (quantity(F.col("r.oldestBlock")) == F.col("start_block"), "oldest_block"),
            (F.size(reward) == F.col("block_count"), "block_count"),
            (F.forall(reward, lambda row: F.coalesce(F.size(row) == len(percentiles), F.lit(False))), "percentile_count"),
            (F.forall(reward, lambda row: F.forall(row, lambda q: quantity(q).isNotNull())), "quantity"),
        ),
    )
    rows = judged.where("reject_reason is null").select("start_block", F.posexplode("r.reward").alias("i", "row"), "reject_reason")
    good = rows.select((F.col("start_block") + F.col("i")).alias("block_number"), *(quantity(F.element_at("row", k + 1)).alias(f"p{p}") for k, p in enumerate(percentiles)), "reject_reason")
    bad = judged.where("reject_reason is not null").select(F.col("start_block").alias("block_number"), *(F.lit(None).cast("bigint").alias(f"p{p}") for p in percentiles), "reject_reason")
    return good.unionByName(bad)


def with_fees(headers: DataFrame, fees: DataFrame) -> DataFrame:
    """Headers with their fee columns, one to one by block number."""
    return headers.join(fees.drop("reject_reason"), "block_number")


def _outcomes(calls: DataFrame, rated: DataFrame) -> DataFrame:
    """One row per call, and per reply to no call, from rated replies: batch_id, id, odd, error_code, given."""
    fatal, over = (F.coalesce(c, F.lit(False)) for c in (F.col("error_code").isin(*FATAL_CODES), F.col("error_code") == LIMIT_CODE))
    grouped = rated.groupBy("batch_id", "id").agg(F.count(F.lit(1)).alias("n"), F.bool_or("odd").alias("odd"), F.bool_or(fatal).alias("fatal"), F.bool_or(over).alias("over"), F.bool_or("given").alias("given"))
    asked = calls.select("batch_id", F.col("call_id").alias("id"), F.lit(True).alias("asked"))
    both = asked.join(grouped, ["batch_id", "id"], "full_outer")
    outcome = (
        F.when(F.col("asked").isNull() | (F.col("n") > 1) | F.col("odd"), "protocol")
        .when(F.col("fatal"), "fatal")
        .when(F.col("over"), "limit")
        .when(F.coalesce("given", F.lit(False)), "accepted")
        .otherwise("retry")
    )
    return both.select("batch_id", "id", outcome.alias("outcome"))


def reconcile_replies(calls: DataFrame, replies: DataFrame) -> DataFrame:
    """One row per call, and per reply to no call: batch_id, id, outcome.

    calls has batch_id and call_id; replies has batch_id, id, jsonrpc, has_result, result and
    error_code. Outcomes by precedence: protocol (wrong version, unknown or repeated id, both or
    neither of result and error), fatal, limit, retry (no reply, a null result, any other error),
    accepted. For replies as they land, see `reconcile_batches`.
    """
    result, error = F.coalesce("has_result", F.lit(False)), F.col("error_code").isNotNull()
    rated = replies.select("batch_id", "id", ((F.coalesce("jsonrpc", F.lit("")) != "2.0") | (result == error)).alias("odd"), "error_code", F.col("result").isNotNull().alias("given"))
    return _outcomes(calls, rated)


def _typed(value: Column, path: str, kind: str, as_type: str) -> Column:
    """What is at a path if it has exactly the kind, else null: a text is no number, and a number no text."""
    at = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(at) == kind, F.try_variant_get(value, path, as_type))


def batch_members(landed: DataFrame) -> DataFrame:
    """The replies in landed batches: batch_id, place, id, odd, error_code, given, result.

    landed has batch_id and payload, the text that came back. A payload that is no JSON list gives
    one odd row without an id. odd says that a member is no object, has not the text "2.0" as
    jsonrpc, no whole number as id, both or neither of result and error, or an error without a whole
    number as code and a text as message. given says that there is a result which is not null;
    result is its JSON text. Values are judged by their JSON types: the id "7" is no number.
    """
    payload = F.try_parse_json("payload")
    parsed = landed.select("batch_id", payload.alias("v"), F.coalesce(F.schema_of_variant(payload).startswith("ARRAY<"), F.lit(False)).alias("is_list"))
    nothing = F.array(F.lit(None).cast("variant"))
    listed = F.when(F.col("is_list"), F.try_variant_get("v", "$", "array<variant>")).otherwise(nothing)
    rows = parsed.select("batch_id", "is_list", F.posexplode(listed).alias("place", "m"))
    here = lambda path: F.try_variant_get("m", path, "variant")  # noqa: E731  there, be it a JSON null
    has_result, has_error = here("$.result").isNotNull(), here("$.error").isNotNull()
    code, message = _typed(F.col("m"), "$.error.code", "BIGINT", "bigint"), _typed(F.col("m"), "$.error.message", "STRING", "string")
    member = _typed(F.col("m"), "$.id", "BIGINT", "bigint")
    well = (
        F.col("is_list") & F.schema_of_variant("m").startswith("OBJECT<") & (_typed(F.col("m"), "$.jsonrpc", "STRING", "string") == "2.0") & member.isNotNull()
        & (has_result != has_error) & (~has_error | (code.isNotNull() & message.isNotNull()))
    )
    given = has_result & ~F.coalesce(F.is_variant_null(here("$.result")), F.lit(False))
    return rows.select("batch_id", "place", member.alias("id"), (~F.coalesce(well, F.lit(False))).alias("odd"), code.alias("error_code"), given.alias("given"), F.when(given, F.to_json(here("$.result"))).alias("result"))


def reconcile_batches(calls: DataFrame, landed: DataFrame) -> DataFrame:
    """reconcile_replies over batches as they land: batch_id, id, outcome; members without an id, and payloads that are no list, are protocol rows with a null id."""
    return _outcomes(calls, batch_members(landed))


def retries(reconciled: DataFrame) -> DataFrame:
    """The calls to make again, in call order."""
    return reconciled.where(F.col("outcome").isin("retry", "limit")).orderBy("batch_id", "id")
