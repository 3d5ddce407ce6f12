"""Chat formatting by quotation linking (DataFrame functions only).

A line's quote level is the number of > in its leading run of >, spaces and
tabs. Quoted passages are every quoted line, every run of consecutive lines of
one level, every paragraph of a run (lines between blank ones) and all lines of
one level joined; they are normalised (white space collapsed, trimmed,
lower-cased), hashed and joined to the lines, runs, paragraphs and whole texts
that messages of the same conversation wrote themselves. A passage's original is the earliest message that wrote it,
and must be earlier than the quoting one. A message replies to the original
with the lowest quote level, then the most passages, then the latest turn. A
thread is a message that replies to nothing and all that reply to it, directly
or over others. Conversations list their threads by the turn of the first
message, and a thread's messages by turn, so that a reply always follows what
it quotes; quoted lines are left out.

Scale: only conversations with a line that begins with > are parsed, once. Originals are reduced to (conversation, hash) -> earliest turn by a
partial aggregation, so a line that everybody writes is one row and the join
makes no pairs; a large conversation's join partition is split by AQE. Threads
are found by pointer doubling over the links only, staged per round (rounds:
logarithm of the longest reply chain). A conversation is emitted in parts of
``PART`` turns by ``PART`` thread starts. Of a part with more than ``LIMIT``
messages (many at one turn, or without a turn), sub-parts follow each other in
the same order, and a turn of more than ``LIMIT`` messages is dealt over
sub-parts by a hash; so a group holds about 2 * ``LIMIT`` messages at most.

Defined results: repeated rows are one message; different texts at the same
turn share their reply; NULL text is an empty message; messages without a
conversation id stand alone, each a conversation of its own; messages without
a turn link to nothing and come last, and keep their lines; a message of linked quotes only has an empty
text; an empty table gives an empty result. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, let, stage

PART = 512
LIMIT = 4096


def _norm(s: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(s, SPACE, " ")))


def _runs(lines: Column, paragraphs: bool) -> Column:
    """struct(level, s, places) of every run of consecutive lines of one level, cut
    after blank lines for paragraphs; blank lines at the ends do not count in s."""
    def starts(x, i):
        before = F.get(lines, i - 1)
        cut = (i == 0) | (before["level"] != x["level"])
        return cut | (_norm(before["body"]) == "") if paragraphs else cut

    at = F.filter(F.transform(lines, lambda x, i: F.when(F.coalesce(starts(x, i), F.lit(True)), i)), lambda i: i.isNotNull())
    return let(at, lambda at: F.transform(at, lambda a, k: let(F.coalesce(F.get(at, k + 1), F.size(lines)), lambda end: F.struct(
        F.get(lines, a)["level"].alias("level"),
        _norm(F.array_join(F.transform(F.slice(lines, a + 1, end - a), lambda x: x["body"]), " ")).alias("s"),
        F.sequence(a, end - 1).alias("places")))))


def distinct_messages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, mark, quotes): every message once, a hash of it, and
    whether a line of it begins with >."""
    rows = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).distinct()
    whole = F.md5(F.concat(F.md5(F.coalesce(F.concat(F.lit("s"), "role"), F.lit("n"))), F.col("text")))
    return rows.withColumns({"mark": F.conv(F.substring(whole, 1, 15), 16, 10).cast("long"),
                             "quotes": F.col("text").rlike(r"(^|\n)[ \t]*>")})


def parse(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, lines, own_keys, quoted): the lines of a message that quotes, hashes of what
    the message wrote, and struct(level, key, places) of the passages it quotes."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.regexp_extract(x, r"^[ \t>]*", 0).alias("lead"), x.alias("line")))
    lines = F.transform(lines, lambda x: F.struct(
        F.length(F.regexp_replace(x["lead"], "[^>]", "")).alias("level"), x["line"].alias("line"),
        F.substring(x["line"], F.length(x["lead"]) + 1, F.length(x["line"])).alias("body")))
    rows = rows.withColumn("lines", lines)
    # a message of one line is its own run
    runs = F.concat(_runs(F.col("lines"), False), _runs(F.col("lines"), True))
    single = F.transform("lines", lambda x, i: F.struct(x["level"].alias("level"), _norm(x["body"]).alias("s"), F.array(i).alias("places")))
    levels = F.array_distinct(F.transform("lines", lambda x: x["level"]))
    numbered = F.transform("lines", lambda x, i: F.struct(x["level"].alias("level"), x["body"].alias("body"), i.alias("i")))
    whole = let(numbered, lambda n: F.transform(levels, lambda v: let(F.filter(n, lambda x: x["level"] == v), lambda part: F.struct(
        v.alias("level"), _norm(F.array_join(F.transform(part, lambda x: x["body"]), " ")).alias("s"),
        F.transform(part, lambda x: x["i"]).alias("places")))))
    passages = F.when(F.size("lines") > 1, F.concat(single, runs, whole)).otherwise(single)
    rows = rows.withColumn("passages", F.filter(passages, lambda p: p["s"] != ""))
    own = F.array_distinct(F.transform(F.filter("passages", lambda p: p["level"] == 0), lambda p: F.xxhash64(p["s"])))
    quoted = F.array_distinct(F.transform(F.filter("passages", lambda p: p["level"] > 0), lambda p: F.struct(
        p["level"].alias("level"), F.xxhash64(p["s"]).alias("key"), p["places"].alias("places"))))
    return rows.select("conv_id", "turn", "mark", F.when(F.col("quotes"), F.transform("lines", lambda x: x["line"])).alias("lines"),
                       own.alias("own_keys"), quoted.alias("quoted"))


def met_passages(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, level, key, places, wrote): the quoted passages that an earlier message
    wrote, with its turn."""
    quotes = parsed.select("conv_id", "turn", "mark", F.explode("quoted").alias("q")).select("conv_id", "turn", "mark", "q.*")
    originals = (parsed.select("conv_id", "turn", F.explode("own_keys").alias("key"))
                 .groupBy("conv_id", "key").agg(F.min("turn").alias("wrote")))
    return quotes.join(originals, ["conv_id", "key"]).filter("wrote < turn")


def reply_links(met: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to) of every message that quotes an earlier one."""
    found = (met.select("conv_id", "turn", "level", "key", "wrote").distinct()
             .groupBy("conv_id", "turn", "level", "wrote").agg(F.count(F.lit(1)).alias("n")))
    best = F.max(F.struct((-F.col("level")).alias("level"), "n", "wrote")).alias("best")
    return found.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", F.col("best.wrote").alias("reply_to"))


def without_quotes(parsed: DataFrame, met: DataFrame) -> DataFrame:
    """(conv_id, turn, mark, own, n_quoted) of the messages with met passages: the text
    without their lines, and how many these are."""
    message = ["conv_id", "turn", "mark"]
    gone = met.select(*message, F.explode("places").alias("i")).distinct()
    counts = gone.groupBy(*message).agg(F.count(F.lit(1)).alias("n_quoted"))
    lines = parsed.join(counts, message, "left_semi").select(*message, F.posexplode("lines").alias("i", "line"))
    kept = F.sort_array(F.collect_list(F.struct("i", "line")))
    own = lines.join(gone, [*message, "i"], "left_anti").groupBy(*message).agg(
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("own"))
    return counts.join(own, message, "left").withColumn("own", F.coalesce("own", F.lit("")))


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to, thread, depth): pointer doubling to the first
    message of the thread."""
    cur = stage(links.select("conv_id", "turn", "reply_to", F.col("reply_to").alias("thread"),
                             F.lit(1).cast("long").alias("depth")), "threads")
    while True:
        up = cur.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("up"), F.col("depth").alias("more"))
        cur = stage(cur.join(up, ["conv_id", "thread"], "left").select(
            "conv_id", "turn", "reply_to", F.coalesce("up", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("up").isNotNull().alias("moved")), "threads")
        if cur.filter("moved").isEmpty():
            return cur.drop("moved")


def linked_messages(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, text without quotes, mark
    (a hash of the message), n_quoted, reply_to (NULL: to nothing), thread and depth."""
    rows = stage(distinct_messages(messages), "messages")
    quoting = rows.filter("quotes AND turn IS NOT NULL AND conv_id IS NOT NULL").select("conv_id").distinct()
    parsed = stage(parse(rows.filter("turn IS NOT NULL").join(quoting, "conv_id", "left_semi")), "parsed")
    met = stage(met_passages(parsed), "met")
    links = threads(reply_links(met))
    return rows.join(links, ["conv_id", "turn"], "left").join(without_quotes(parsed, met), ["conv_id", "turn", "mark"], "left").select(
        "conv_id", "turn", "role", F.coalesce("own", "text").alias("text"), "mark", F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"),
        "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"))


def _with_sub_part(rows: DataFrame, limit: int) -> DataFrame:
    """Adds sub_part: 0, or the place within a part of more than ``limit``
    messages, in thread and turn order."""
    part = ["conv_id", "thread_part", "turn_part"]
    rows = stage(rows, "messages")
    known = rows.filter("conv_id IS NOT NULL")
    large = stage(known.groupBy(*part).count().filter(F.col("count") > limit).drop("count"), "large-parts")
    if large.isEmpty():
        return rows.withColumn("sub_part", F.lit(0).cast("long"))
    same = lambda a, b, names: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]
    turns = known.groupBy(*part, "thread", "turn").agg(F.count(F.lit(1)).alias("n"))
    turns = turns.alias("t").join(large.alias("l"), same("t", "l", part), "left_semi")
    # a turn above the limit takes the sub-parts first + 1 to first + deal
    turns = turns.withColumn("deal", F.when(F.col("n") > limit, F.ceil(F.col("n") * 2 / limit)).otherwise(0).cast("long"))
    size = F.when(F.col("deal") > 0, (F.col("deal") + 2) * limit).otherwise(F.col("n"))
    before = Window.partitionBy(*part).orderBy(F.asc_nulls_last("thread"), F.asc_nulls_last("turn")).rowsBetween(
        Window.unboundedPreceding, -1)
    turns = turns.withColumn("first", F.floor(F.coalesce(F.sum(size).over(before), F.lit(0)) / limit).cast("long"))
    turns = stage(turns.select(*part, "thread", "turn", "first", "deal"), "large-turns")
    out = rows.alias("m").join(turns.alias("t"), same("m", "t", [*part, "thread", "turn"]), "left")
    dealt = F.when(F.col("t.deal") > 0, F.lit(1) + F.pmod(F.col("m.mark"), F.col("t.deal"))).otherwise(0)
    return out.select("m.*", F.coalesce(F.col("t.first") + dealt, F.lit(0)).cast("long").alias("sub_part"))


def conversations(messages: DataFrame, part: int = PART, limit: int = LIMIT) -> DataFrame:
    """(conv_id, thread_part, turn_part, sub_part, n_messages, n_replies, n_quoted, chat):
    conversations in reply order, as <|role|> blocks. Parts follow each other by
    thread_part, then turn_part, then sub_part."""
    rows = linked_messages(messages)
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    rows = (rows.withColumn("alone", alone)
            .withColumn("thread_part", F.floor(F.col("thread") / part).cast("long"))
            .withColumn("turn_part", F.floor(F.col("turn") / part).cast("long")))
    rows = _with_sub_part(rows, limit)
    last = lambda c: F.struct(F.col(c).isNull(), F.col(c))
    entry = F.struct(last("thread").alias("a"), last("turn").alias("b"), F.coalesce("role", F.lit("")).alias("role"), "text")
    out = rows.groupBy("conv_id", "alone", "thread_part", "turn_part", "sub_part").agg(
        F.count(F.lit(1)).alias("n_messages"), F.count("reply_to").alias("n_replies"),
        F.sum("n_quoted").alias("n_quoted"), F.sort_array(F.collect_list(entry)).alias("entries"))
    chat = F.array_join(F.transform("entries", lambda e: F.concat(F.lit("<|"), e["role"], F.lit("|>\n"), e["text"])), "\n")
    return out.select("conv_id", "thread_part", "turn_part", "sub_part", "n_messages", "n_replies", "n_quoted", chat.alias("chat"))
