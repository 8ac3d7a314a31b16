"""Streams of order messages: ``value`` (JSON text), ``arrival`` (a comparable struct, unique per message), and
``arrived``, when the message came in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderloom.operators.sized import broadcast_if_small
from orderloom.schemas import EVENT_FIELDS, ddl

_END = "_end"
# A task's part of Spark's running row numbers.
_LINE_BITS = 33


def kafka_options(servers: str, topic: str, batch_rows: int | None = None) -> dict[str, str]:
    """Reader options: from the earliest offset, all there is in a micro-batch, or at most ``batch_rows`` messages."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if batch_rows:
        options["maxOffsetsPerTrigger"] = str(batch_rows)
    return options


def kafka_orders(spark: SparkSession, servers: str, topic: str, batch_rows: int | None = None) -> DataFrame:
    """Order messages of a topic. Needs the Kafka connector on the class path."""
    messages = spark.readStream.format("kafka").options(**kafka_options(servers, topic, batch_rows)).load()
    return messages.select(F.col("value").cast("string").alias("value"),
                           F.struct("partition", "offset").alias("arrival"), F.col("timestamp").alias("arrived"))


def landed_orders(spark: SparkSession, path: str, files_per_batch: int | None = None,
                  by_name: bool = False) -> DataFrame:
    """Order messages landed as JSON lines. Files arrive in the order of their modification time, or of their
    names with ``by_name``; lines in the order they stand in."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    if not by_name:
        place.insert(0, "_metadata.file_modification_time")
    return reader.load(path).select("value", F.struct(*place).alias("place"),
                                    F.col("_metadata.file_modification_time").alias("arrived"))


def without_redelivery(messages: DataFrame, within: str) -> DataFrame:
    """A stream without the messages that came before, text for text, ``within`` that time. What came is held as state
    until the time is over, 32 bytes of SHA-256 a message, so memory is bounded by the time and not by all that was ever
    stored. Two messages of equal
    text say the same, so it doesn't matter which of them stays; different copies of an order both stay and are judged
    later. The time is that of arrival, so no message is late.

    Messages must bring their ``arrival`` with them, as a topic's do: the lines of a file are numbered only later, and
    the state has lost their order by then."""
    if "arrival" not in messages.columns:
        raise ValueError("messages without an arrival of their own can't be told from redelivered ones in order")
    return (messages.withWatermark("arrived", within).withColumn("_text", F.unhex(F.sha2(F.coalesce("value", F.lit("")), 256)))
            .dropDuplicatesWithinWatermark(["_text"]).drop("_text"))


def with_arrival(batch: DataFrame) -> DataFrame:
    """Complete the arrival of file lines by their position within the part of the file a task reads.

    The position is the running row number of the task. Tasks of one micro-batch read the same parts whenever
    they are repeated, so a repeated task numbers its lines alike."""
    if "arrival" in batch.columns:
        return batch.select("value", "arrival")
    return batch.select("value", F.struct("place.*", F.monotonically_increasing_id().alias("row")).alias("arrival"))


def with_number(batch: DataFrame) -> DataFrame:
    """``arrival`` as one BIGINT of the same order, whose minimum is a hash aggregate: of a topic, partition and offset
    (below 2^48); of files, the rank of the file's part, then the line within it. Other arrivals stay as they are.

    ``batch`` is read twice where it comes from files: persist it. The parts are ranked in one task, a row each."""
    names = getattr(batch.schema["arrival"].dataType, "names", [])
    if names == ["partition", "offset"]:
        return batch.withColumn("arrival", _offset_number())
    if names[-1:] != ["row"]:
        return batch
    place = [f"arrival.{name}" for name in names[:-1]]
    parts = batch.select(*(F.col(name).alias(f"_{k}") for k, name in enumerate(place))).distinct()
    own = [f"_{k}" for k in range(len(place))]
    parts = parts.withColumn("_rank", F.row_number().over(Window.orderBy(*own)).cast("bigint"))
    same = [F.col(name).eqNullSafe(F.col(column)) for name, column in zip(place, own)]
    line = F.col("arrival.row").bitwiseAND(F.lit((1 << _LINE_BITS) - 1))  # a part is read by one task
    ranked = batch.join(broadcast_if_small(parts), same, "left")
    return ranked.withColumn("arrival", F.shiftleft("_rank", _LINE_BITS) + line).drop("_rank", *own)


def message_id(batch: DataFrame) -> Column:
    """What tells a message from all others of its batch, at no cost. It need not be in their order."""
    names = getattr(batch.schema["arrival"].dataType, "names", [])
    if names == ["partition", "offset"]:
        return _offset_number()
    return F.col("arrival.row") if names[-1:] == ["row"] else F.col("arrival")


def _offset_number() -> Column:
    return F.shiftleft(F.col("arrival.partition").cast("bigint"), 48) + F.col("arrival.offset")


def decode(messages: DataFrame, fields: Sequence[str] = EVENT_FIELDS) -> DataFrame:
    """Event fields as text columns. A message that is not exactly one JSON object keeps its text in ``payload``
    (empty for a missing message) and has no fields.

    The parser stops after a first value, so the message is read as a member with a mark behind it, which is only
    reached if nothing else follows; and, unless it has no brace but the last, as an array of one, as a message may bring
    such a mark itself."""
    # In text whose only closing brace is its last character nothing can follow the object. Bytes are counted, as
    # characters of long text are counted one by one.
    text = F.rtrim("value")
    single = F.octet_length(text) - F.octet_length(F.substring_index(text, "}", 1)) == 1
    schema = f"e struct<{ddl({name: 'string' for name in fields})}>, {_END} string"
    strict = {"mode": "PERMISSIVE", "allowSingleQuotes": "false"}
    whole = F.from_json(F.concat(F.lit('{"e":'), "value", F.lit(f',"{_END}":"1"}}')), schema, strict)
    alone = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<string>", strict)
    parsed = messages.withColumn("whole", whole).withColumn("event", F.col("whole.e"))
    alone = F.when(single, F.lit(True)).otherwise(F.size(alone) == 1)
    one = (F.col(f"whole.{_END}") == "1") & F.col("event").isNotNull() & alone
    broken = ~F.coalesce(one, F.lit(False))
    kept = [F.when(~broken, F.col(f"event.{name}")).alias(name) for name in fields]
    payload = F.when(broken, F.coalesce("value", F.lit(""))).alias("payload")
    return parsed.select(*kept, payload, *(name for name in messages.columns if name != "value"))
