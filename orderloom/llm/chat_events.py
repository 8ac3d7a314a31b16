"""Chat formatting by event-sourced reconstruction.

A log holds one event a row: (conv_id, seq, message, kind, role, text). ``start`` opens a message (its slot within the
conversation, with a role), ``delta`` appends text, ``edit`` replaces the text so far, ``regenerate`` drops it to be
streamed anew. Events of a message are sorted by sequence and folded to its final text, messages of a conversation are
sorted by slot and rendered. Everything is column expressions.

Template: each turn is ``<turn ROLE>\\n``, its text, ``</turn>\\n``. Inside roles and texts the characters ``\\\\``,
``<`` and ``>`` are written ``\\\\0``, ``\\\\1``, ``\\\\2``, so that no text can hold a control string, and reading the codes
back in the order 2, 1, 0 gives the text again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.common import settle, table

_CODES = (("\\", "\\0"), ("<", "\\1"), (">", "\\2"))
OPEN, CLOSE = "<turn ", "</turn>\n"


def escaped(text: Column) -> Column:
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def fold_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final messages of a log.

    Events of a message count in the order of ``seq``; equal events (a redelivery) count once, and different ones with
    equal ``seq`` go by kind and text. Text before the last edit or regeneration is dropped, an edit's text is the new
    beginning. A null text is empty; the role is that of the first ``start``, else of the first event that names one;
    a message without any event does not exist."""
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role")
    logs = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_set(event)).alias("log"))
    logs = logs.withColumn("resets", F.expr("transform(log, (e, i) -> if(e.kind in ('edit', 'regenerate'), i, -1))"))
    logs = logs.withColumn("last", F.greatest(F.array_max("resets"), F.lit(0)))
    text = F.expr("array_join(transform(filter(slice(log, last + 1, size(log)), e -> e.kind in ('edit', 'delta')), e -> e.text), '')")
    role = F.coalesce(F.get(F.expr("filter(log, e -> e.kind = 'start' and e.role is not null)"), F.lit(0))["role"],
                      F.get(F.expr("filter(log, e -> e.role is not null)"), F.lit(0))["role"], F.lit(""))
    return logs.select("conv_id", "message", role.alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans): each conversation's messages by slot in the template, and where the
    assistant's texts stand in it (start, length in code points, as escaped)."""
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(">\n"))
    body = escaped(F.col("text"))
    pieces = messages.select("conv_id", "message", head.alias("head"), body.alias("body"),
                             (F.col("role") == "assistant").alias("learned"))
    size = F.length("head") + F.length("body") + len(CLOSE)
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head"))
    whole = F.sort_array(F.collect_list(F.struct(
        "message", F.concat("head", "body", F.lit(CLOSE)).alias("piece"), "learned", "at", F.length("body").alias("n"))))
    return pieces.groupBy("conv_id").agg(whole.alias("turns")).select(
        "conv_id", F.array_join("turns.piece", "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learned"]),
                    lambda t: F.struct((t["at"] + 1).alias("start"), t["n"].alias("length"))).alias("loss_spans"))


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of a log of events; see :func:`fold_messages` for nulls, ties and repeats.
    A null conv_id is a conversation of its own; an empty log gives an empty result."""
    return render(fold_messages(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of rendered conversations, from the output alone: the turns by parsing the template, the learned text by
    the spans."""
    raw = F.expr("slice(split(formatted, '<turn '), 2, greatest(size(split(formatted, '<turn ')) - 1, 0))")
    parsed = formatted.select("conv_id", "formatted", "loss_spans", raw.alias("raw"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, ">\n", 1)
        text = F.substr(piece, F.length(role) + 3, F.length(piece) - F.length(role) - 2 - len(CLOSE))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    turns = F.transform("raw", turn)
    parsed = parsed.withColumn("turns", turns)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss_spans", lambda s: unescaped(
        F.substr(F.col("formatted"), s["start"].cast("int"), s["length"]))), "")
    parsed = parsed.select("conv_id", "formatted", F.size("turns").cast("bigint").alias("n_turns"),
                           F.sha2(lines.cast("binary"), 256).alias("turns_sha256"), learned.alias("learned"))
    return parsed.select(
        "conv_id", "n_turns", "turns_sha256", F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def events_of(conversations: DataFrame) -> DataFrame:
    """A log that leads to the given (conv_id, turn, role, text) rows: each message starts, is streamed in two deltas,
    and by its place is also edited or regenerated after a draft. Rows with equal turns are different messages."""
    slot = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id", F.row_number().over(slot).cast("bigint").alias("message"), "role", F.coalesce("text", F.lit("")).alias("text"))
    half = (F.length("text") / 2).cast("int")
    first, second = F.substr("text", F.lit(1), half), F.substr("text", half + 1, F.length("text"))

    def event(step: int, kind: str, text: Column) -> Column:
        return F.struct((F.col("message") * 10 + step).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    streamed = [event(5, "delta", first), event(6, "delta", second)]
    draft = [event(1, "delta", second), event(2, "delta", F.lit("draft"))]
    log = (F.when(F.col("message") % 3 == 1, F.array(event(0, "start", F.lit("")), *streamed))
           .when(F.col("message") % 3 == 2, F.array(event(0, "start", F.lit("")), *draft, event(3, "regenerate", F.lit("")), *streamed))
           .otherwise(F.array(event(0, "start", F.lit("")), *draft, event(4, "edit", first), event(6, "delta", second))))
    exploded = rows.select("conv_id", "message", "role", F.explode(log).alias("e"))
    return exploded.select("conv_id", F.col("e.seq").alias("seq"), "message", F.col("e.kind").alias("kind"),
                           F.coalesce("role", F.lit("")).alias("role"), F.col("e.text").alias("text"))


def op9_chat_events(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    formatted = settle(format_conversations(events_of(rows.unionByName(extra))), "formatted")
    return read_back(formatted)
