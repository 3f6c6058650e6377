"""Chat formatting from event logs, in DataFrame expressions only.

A conversation is kept as a log of events: a message is opened, its text arrives in pieces, is edited as a whole,
or is dropped and generated again. The log is partitioned by conversation and message, sorted by sequence and
folded into the final messages, and these, in the order in which they were opened, are rendered as one training
text with a loss mask.

Template: each turn is ``<s>[INST]role[/INST]text</s>``. Roles and texts are escaped so that none of the four
control strings can stand in them: a backslash becomes two, and one is set behind the first character of a
control string. The mask covers the texts of assistant turns, in runs of code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from flightlake.llm.text import let, table

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
LEARNT = "assistant"
#: What a log may hold of a message; other kinds of event say nothing of its text.
OPENED, DELTA, EDIT, AGAIN = "open", "delta", "edit", "regenerate"


def escaped(text: Column) -> Column:
    whole = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(whole, r"(<(?=/?s>)|\[(?=/?INST\]))", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def final_messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, at, role, text): each message of the log as it stands after its last event.

    ``events`` has conv_id, message, seq, kind, role and text; further columns are left aside. In the order of
    ``seq`` an open, delta or edit adds its text, an edit or regenerate first drops all text before it. An event
    delivered more than once (all six values equal) counts once. The role is the last one named (null: empty), and
    ``at`` the first seq. Null texts add nothing, null seqs come first, events of null or other kinds change no text.
    A message's events meet in one task, a conversation's do not.
    """
    c = F.col
    event = F.struct("seq", "kind", "role", "text")
    logs = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("log"))
    once = let(c("log"), lambda log: F.filter(log, lambda e, i: (i == 0) | ~e.eqNullSafe(F.get(log, i - 1))))
    resets = F.transform("log", lambda e, i: F.when(e["kind"].isin(EDIT, AGAIN), i))
    kept = F.slice("log", F.coalesce(F.array_max(resets), F.lit(0)) + 1, F.size("log"))
    says = F.transform(kept, lambda e: F.when(e["kind"].isin(OPENED, DELTA, EDIT), e["text"]))
    roles = F.array_compact(F.transform("log", lambda e: e["role"]))
    return logs.select("conv_id", "message", once.alias("log")).select(
        "conv_id", "message", c("log")[0]["seq"].alias("at"),
        F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"), F.array_join(says, "").alias("text"),
    )


def rendered(messages: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """One row per conversation: conv_id, formatted and loss_runs, from (conv_id, message, at, role, text).

    Turns stand in the order of ``at``, then of ``message``. ``loss_runs`` has a pair (skip, learn) for each turn
    and one for the end, in code points of ``formatted``: so many without loss, then so many with loss. Messages
    are rendered before they are gathered, so what meets for a conversation is its own text and nothing else; that
    text is one value and must stay under two gigabytes.
    """
    head = F.concat(F.lit(OPEN), escaped(F.col("role")), F.lit(MIDDLE))
    turn = messages.select("conv_id", "at", "message", (F.col("role") == learnt).alias("learn"), head.alias("head"), escaped(F.col("text")).alias("body"))
    turns = turn.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "message", "learn", "head", "body"))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    # Each pair starts where the one before has ended: behind the text of a turn with loss, else behind its whole.
    close = len(CLOSE)
    learns = lambda t: t["learn"]
    before = lambda i: F.when((i > 0) & learns(F.get("turns", i - 1)), close).otherwise(0)
    size = lambda t: F.length(t["head"]) + F.when(learns(t), 0).otherwise(F.length(t["body"]) + close)
    pair = lambda skip, learn: F.struct(skip.cast("bigint").alias("skip"), learn.cast("bigint").alias("learn"))
    runs = F.transform("turns", lambda t, i: pair(before(i) + size(t), F.when(learns(t), F.length(t["body"])).otherwise(0)))
    last = F.array(pair(before(F.size("turns")), F.lit(0)))
    return turns.select("conv_id", formatted.alias("formatted"), F.concat(runs, last).alias("loss_runs"))


def format_conversations(events: DataFrame) -> DataFrame:
    """Final messages of the log, rendered; see :func:`final_messages` and :func:`rendered`.

    Rows with a null conv_id form a conversation of their own. An empty log gives no row.
    """
    return rendered(final_messages(events))


def read_back(formatted: Column) -> dict[str, Column]:
    """n_turns and turns (role, line end, text, line end for each turn) as the formatted text has them."""
    plain = F.replace(F.replace(F.replace(formatted, F.lit(OPEN)), F.lit(MIDDLE), F.lit("\n")), F.lit(CLOSE), F.lit("\n"))
    return {"n_turns": F.size(F.split(formatted, CLOSE)) - 1, "turns": unescaped(plain)}


def under_loss(formatted: Column, loss_runs: Column) -> Column:
    """All text under the mask, unescaped. A turn's text ends the turn, so its run is the end of its piece."""
    parts = F.zip_with(F.split(formatted, CLOSE), loss_runs, lambda piece, run: F.right(piece, run["learn"].cast("int")))
    return unescaped(F.array_join(parts, ""))


def event_log(rows: DataFrame, piece: int = 200) -> DataFrame:
    """The log of conversations that are kept as one row for each turn (conv_id, turn, role, text).

    Every text arrives in pieces of ``piece`` code points. Of each four turns, by hash, one first holds half of its
    text and is then generated again, one is then edited, and one has its last event delivered twice. Turns stand
    in the order of ``turn`` (nulls first), then of role and a hash of the text; repeated rows are turns of their own.
    """
    c = F.col
    text = F.coalesce(c("text").cast("string"), F.lit(""))
    keyed = rows.select(c("conv_id"), c("turn"), c("role").cast("string").alias("role"), text.alias("text"))
    keyed = keyed.withColumn("hash", F.xxhash64("role", "text")).withColumn("message", F.monotonically_increasing_id())
    event = lambda kind, said=None, role=None: F.struct(
        F.lit(kind).alias("kind"), (c("role") if role else F.lit(None).cast("string")).alias("role"),
        (F.lit(None).cast("string") if said is None else said).alias("text"))
    deltas = lambda said: F.transform(F.regexp_extract_all(said, F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)), lambda p: event(DELTA, p))
    way = F.pmod(F.xxhash64("conv_id", "turn", "hash"), F.lit(4))
    half = deltas(F.left(c("text"), F.ceil(F.length("text") / 2).cast("int")))
    told = (F.when(way == 1, F.concat(half, F.array(event(AGAIN)), deltas(c("text"))))
            .when(way == 2, F.concat(half, F.array(event(EDIT, c("text"))))).otherwise(deltas(c("text"))))
    numbered = F.transform(F.concat(F.array(event(OPENED, role=True)), told), lambda e, i: F.struct(
        i.alias("step"), e["kind"].alias("kind"), e["role"].alias("role"), e["text"].alias("text")))
    sent = let(numbered, lambda log: F.when(way == 3, F.concat(log, F.slice(log, -1, 1))).otherwise(log))
    log = keyed.withColumn("sent", sent).select("conv_id", "message", "turn", "role", "hash", F.explode("sent").alias("event"))
    seq = F.struct("turn", "role", "hash", "message", c("event.step").alias("step"))
    return log.select("conv_id", "message", seq.alias("seq"), "event.kind", "event.role", "event.text")


def op11_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1 through their event log, with digests read back from the output."""
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    ours = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    out = format_conversations(event_log(rows.unionByName(ours)))
    back, loss = read_back(F.col("formatted")), under_loss(F.col("formatted"), F.col("loss_runs"))
    return out.select(
        "conv_id", back["n_turns"].cast("bigint").alias("n_turns"), F.sha2(back["turns"], 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP11_SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(role) + length(text)
         + length(regexp_replace(role || ' ' || text, '[^\\]', '', 'g'))
         + len(regexp_extract_all(role || ' ' || text, '</?s>|\[/?INST\]')) AS chars
  FROM said
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars + length('<s>[INST][/INST]</s>'))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
