"""Quotation linking in conversations, in DataFrame operations alone.

A line's quote level is the number of ">" marks it begins with. Neighbouring lines of one level make a passage; passages
of level 0 are the message's own words. A passage is normalised (marks removed, case folded, white space to single
spaces, quotation of attribution lines such as "on ... wrote:" dropped) and hashed.

Each message offers to others the hashes of its whole own text and of each of its own paragraphs and lines. An offer is
owned by the earliest message that makes it, within its conversation if there is one before the quoting turn, else
anywhere: owners are aggregated before the join, so a sentence that a third of all messages share is one row. A quoted
passage is looked up whole, then line by line, so that a partly quoted paragraph is found too.

A message replies to the latest message it quotes at level 1; without such a quote, to the turn before it in its
conversation. The result keeps every message once, with its text free of quotes, sorted in reply order: by conversation,
by the turn answered within it (messages that answer none come first), by turn. An answered turn is always earlier, so a
message stands after what it answers. The sort is by ranges, and the turn before is found in chunks of CHUNK turns whose
ends are then compared, so a conversation that holds most of the table is spread over tasks.

Cases: a null text is empty and quotes nothing; messages of nothing but quotes have an empty text; a null conv_id or turn
is a conversation or turn of its own kind (null keys match null keys); a quote that no message owns stays unlinked and
is counted; repeated rows of a turn are merged into the first by text; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1024
ATTRIBUTION = r"(?i)^(on .{0,200}wrote|.{0,200} (wrote|schrieb|écrit|escribió)) ?:$"


def quote_level(line: Column) -> Column:
    """The number of marks at the start of a line, blanks between them allowed."""
    head = F.regexp_extract(line, r"^((?:[ \t]*>)*)", 1)
    return F.length(F.regexp_replace(head, r"[^>]", ""))


def unmarked(line: Column) -> Column:
    return F.regexp_replace(line, r"^(?:[ \t]*>)+ ?", "")


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, passage (its number in the message), level, text, lines: neighbouring lines of one quote level.

    Lines that are empty belong to the passage before them. Each line is a row for a while, so the work grows with the
    lines of a message and not with their square; rows of a message stay where it is.
    """
    here = Window.partitionBy("conv_id", "turn").orderBy("k")
    lines = messages.select("conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), r"\r\n|\n|\r", -1)).alias("k", "raw"))
    lines = lines.select("conv_id", "turn", "k", quote_level(F.col("raw")).alias("level"), unmarked(F.col("raw")).alias("line"))
    own = F.when((F.col("k") == 0) | (F.col("level") > 0) | (F.trim("line") != ""), F.col("level"))
    lines = lines.withColumn("level", F.last(own, ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0)))
    begins = F.coalesce((F.col("level") != F.lag("level").over(here)).cast("int"), F.lit(0))
    lines = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    rows = lines.groupBy("conv_id", "turn", "passage").agg(F.min("level").alias("level"), F.array_sort(F.collect_list(F.struct("k", "line"))).alias("l"))
    return rows.select("conv_id", "turn", "passage", "level", F.array_join("l.line", "\n").alias("text"), F.col("l.line").alias("lines"))


def _messages(conversations: DataFrame) -> DataFrame:
    """One row a turn; repeated rows of a turn: the first by role and text."""
    first = F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")
    return conversations.groupBy("conv_id", "turn").agg(first).select("conv_id", "turn", "m.role", "m.text")


def link_quotes(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (without quotes), depth, n_quotes, n_linked, reply_conv, reply_turn, in reply order."""
    messages = _messages(conversations)
    plain = messages.where(~F.col("text").rlike(r"(?m)^[ \t]*>"))  # most messages quote nothing: no need to fold lines
    quoting = messages.where(F.col("text").rlike(r"(?m)^[ \t]*>"))
    parts = passages(quoting)
    own = parts.where("level = 0").groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("passage", "text"))).alias("own"))
    own = _joined(quoting.select("conv_id", "turn", "role"), own).select("conv_id", "turn", "role", F.array_join(F.col("own.text"), "\n").alias("text"))
    own = own.withColumn("text", F.coalesce(F.array_join(F.filter(F.split("text", "\n", -1), lambda x: ~F.trim(x).rlike(ATTRIBUTION)), "\n"), F.lit("")))
    own = plain.unionByName(own).withColumn("text", F.regexp_replace("text", r"^\s+|\s+$", ""))

    # what messages offer: whole texts, paragraphs, lines
    paragraphs, each = F.split("text", r"\n[ \t]*\n"), F.split("text", r"\n")
    offers = own.select("conv_id", "turn", F.explode(F.array_distinct(F.transform(F.concat(F.array("text"), paragraphs, each), normal))).alias("said")).where("said <> ''")
    digest = (F.xxhash64("said").alias("hash"), F.unhex(F.md5("said")).alias("full"))
    offers = offers.select("conv_id", "turn", *digest)

    quotes = parts.where("level > 0").select("conv_id", "turn", "passage", "level", F.explode(F.array_distinct(F.transform(F.concat(F.array("text"), "lines"), normal))).alias("said")).where("said <> ''")
    quotes = quotes.select("conv_id", "turn", "passage", "level", F.length("said").alias("size"), *digest)
    # owners: the earliest turn in each conversation, then the earliest conversation; summed up before anything is joined
    near = offers.groupBy("hash", "full", "conv_id").agg(F.min("turn").alias("near_turn"))
    valid = F.col("conv_id").isNotNull() & F.col("near_turn").isNotNull()
    anywhere = near.where(valid).groupBy("hash", "full").agg(F.min(F.struct("conv_id", F.col("near_turn").alias("turn"))).alias("first"))
    near = near.withColumnsRenamed({"hash": "near_hash", "full": "near_full", "conv_id": "near_conv"})
    found = quotes.join(near, (F.col("hash") == F.col("near_hash")) & (F.col("full") == F.col("near_full")) & F.col("conv_id").eqNullSafe(F.col("near_conv")), "left")
    found = found.join(anywhere, ["hash", "full"], "left")
    inside = F.col("near_turn").isNotNull() & (F.col("near_turn") < F.col("turn"))
    other = F.col("first").isNotNull() & ((F.col("first.conv_id") < F.col("conv_id")) | ((F.col("first.conv_id") == F.col("conv_id")) & (F.col("first.turn") < F.col("turn"))))
    target = F.when(inside, F.struct(F.col("conv_id").alias("conv_id"), F.col("near_turn").alias("turn"))).when(other, F.struct(F.col("first.conv_id").alias("conv_id"), F.col("first.turn").alias("turn")))
    # per passage: the longest piece that is found names its original
    linked = found.withColumn("target", target).groupBy("conv_id", "turn", "passage", "level").agg(F.max(F.when(F.col("target").isNotNull(), F.struct("size", "target"))).alias("best"))
    of_message = linked.groupBy("conv_id", "turn").agg(
        F.count("*").alias("n_quotes"), F.count("best").alias("n_linked"), F.max("level").alias("depth"), F.max(F.when(F.col("level") == 1, F.struct((F.col("best.target.conv_id") == F.col("conv_id")).alias("here"), F.col("best.target").alias("target")))).alias("reply")
    )
    own = _with_previous(own)
    out = _joined(own, of_message).select(
        "conv_id", "turn", "role", "text", F.coalesce("depth", F.lit(0)).alias("depth"), F.coalesce("n_quotes", F.lit(0)).cast("bigint").alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        F.when(F.col("reply.target").isNotNull(), F.col("reply.target.conv_id")).when(F.col("previous").isNotNull(), F.col("conv_id")).alias("reply_conv"), F.coalesce("reply.target.turn", "previous").alias("reply_turn"),
    )
    answered = F.when(F.col("reply_conv").eqNullSafe(F.col("conv_id")), F.col("reply_turn"))
    return out.orderBy(F.col("conv_id").asc_nulls_first(), answered.asc_nulls_first(), F.col("turn").asc_nulls_first())


def _with_previous(own: DataFrame) -> DataFrame:
    """own with previous: the largest smaller turn of the conversation."""
    own = own.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    last = own.groupBy("conv_id", "chunk").agg(F.max("turn").alias("last"))
    last = last.withColumn("before", F.lag("last").over(Window.partitionBy("conv_id").orderBy(F.col("chunk").asc_nulls_first())))
    ends = last.select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), "before")
    within = F.lag("turn").over(Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first()))
    own = own.withColumn("within", within).join(ends, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k")), "left")
    return own.withColumn("previous", F.coalesce("within", "before")).drop("c", "k", "chunk", "within", "before")


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """left with the columns of right's row of the same message, if any; null keys are keys."""
    right = right.withColumnsRenamed({"conv_id": "right_conv", "turn": "right_turn"})
    same = F.col("conv_id").eqNullSafe(F.col("right_conv")) & F.col("turn").eqNullSafe(F.col("right_turn"))
    return left.join(right, same, "left").drop("right_conv", "right_turn")
