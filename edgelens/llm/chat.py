"""Chat formatting of reply trees (operator 3), in DataFrame operations only.

Messages form trees by (conversation, parent). Iterated self-joins that double the distance jumped
give every message its path to the root: its depth and the sum of its path's scores after log2(depth)
joins. Leaves are the branches; they are ranked in their conversation by score, and the chosen ones
gather their ancestors by the same jumps. Each chosen path becomes one string, its turns joined piece by
piece so that no task gathers a long conversation row by row.

Template: "[TAG] text [/TAG]" a turn, where TAG is INST for user, RSP for assistant, SYS for system and
"ROLE x" for another role x; "<s>" before and "</s>" after the conversation. In texts and role names
backslash, "[" and "<" become \\b, \\l and \\t, so no control string can occur, and the way back is exact.

Defined results: null text and role are empty; messages whose parent is null or absent are roots;
of repeated (conversation, message) ids the smallest by (role, text) counts; ties between branches go
to the deeper, then to the smaller message id; a conversation without messages does not occur. Where
replies go round in a circle, the smallest message id of the circle is a root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgelens.runtime import stage

# Fixed values of the template.
TAGS = {"user": "INST", "assistant": "RSP", "system": "SYS"}
OTHER = "ROLE "
ESCAPES = [("\\", "\\b"), ("[", "\\l"), ("<", "\\t")]
TURNS_PER_PIECE = 64


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def linear_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as a reply tree without forks: each turn replies to the one before. Equal turns
    are ordered by role and text."""
    rows = turns.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    msg = F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "text")) - 1
    return rows.select("conv", msg.cast("long").alias("msg"), "role", "text").select(
        "conv", "msg", F.when(F.col("msg") > 0, F.col("msg") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"
    )


def doubled_jumps(nodes: DataFrame, longest: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Jumps of 1, 2, 4, ... replies up: (conv, msg, up, total, hops, low), low the smallest message passed; and the
    (conv c3, message m3) to cut circles at if some path is longer than the longest conversation, else None."""
    jumps = [nodes]
    while not nodes.where("up is not null").isEmpty():
        if 1 << (len(jumps) - 1) > longest:
            # whatever is this far up is on a circle, and has seen all of it
            return jumps, stage(nodes.where("up is not null").select("conv", "up").distinct().join(
                nodes.select(F.col("conv").alias("c3"), F.col("msg").alias("m2"), F.col("low").alias("m3")), F.col("conv").eqNullSafe(F.col("c3")) & (F.col("up") == F.col("m2"))
            ).select("c3", "m3").distinct(), "chat-circles")
        far = nodes.select(
            F.col("conv").alias("c2"), F.col("msg").alias("m2"), F.col("up").alias("up2"), F.col("total").alias("t2"), F.col("hops").alias("h2"), F.col("low").alias("l2")
        )
        # messages whose path has reached the root stay as they are
        moved = nodes.where("up is not null").join(far, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("up") == F.col("m2")), "left").select(
            "conv", "msg", F.col("up2").alias("up"), (F.col("total") + F.coalesce("t2", F.lit(0.0))).alias("total"),
            (F.col("hops") + F.coalesce("h2", F.lit(0))).alias("hops"), F.least("low", "l2").alias("low"),
        )
        nodes = stage(moved.unionByName(nodes.where("up is null")), "chat-jumps")
        jumps.append(nodes)
    return jumps, None


def branch_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, leaf, depth, msg) of the best branches of each conversation; messages: (conv, msg, parent, score)."""
    nodes = messages.select("conv", "msg", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    known = nodes.select(F.col("conv").alias("c2"), F.col("msg").alias("up"))
    first = (
        nodes.join(known, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("parent") == F.col("up")), "left")
        .select("conv", "msg", "up", F.col("score").alias("total"), F.when(F.col("up").isNull(), 0).otherwise(1).alias("hops"), F.col("msg").alias("low"))
    )
    longest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    jumps, circles = doubled_jumps(stage(first, "chat-jumps"), longest)
    if circles is not None:
        cut = circles.withColumn("cut", F.lit(True))
        first = first.join(cut, F.col("conv").eqNullSafe(cut["c3"]) & (F.col("msg") == cut["m3"]), "left").select(
            "conv", "msg", F.when(F.col("cut").isNull(), F.col("up")).alias("up"), "total", F.when(F.col("cut").isNull(), F.col("hops")).otherwise(0).alias("hops"), "low",
        )
        jumps, _ = doubled_jumps(stage(first, "chat-jumps"), longest)
    nodes = jumps[-1]
    parents = jumps[0].where("up is not null").select(F.col("conv").alias("c2"), F.col("up").alias("m2")).distinct()
    leaves = nodes.join(parents, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("msg") == F.col("m2")), "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("total"), F.desc("hops"), "msg"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= branches)
    # depth counts from the root; the ancestor at distance d is reached by the jumps of d's binary digits,
    # the longest jumps first, so that the rows stay few until the last joins
    paths = chosen.select("conv", F.col("msg").alias("leaf"), F.col("hops").alias("depth"), "msg")
    for k, jump in reversed(list(enumerate(jumps[:-1]))):
        far = jump.select(F.col("conv").alias("c2"), F.col("msg").alias("m2"), F.col("up"))
        paths = paths.join(far, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("msg") == F.col("m2"))).select(
            "conv", "leaf",
            F.explode(F.when(F.col("up").isNull(), F.array(F.struct("depth", "msg"))).otherwise(
                F.array(F.struct("depth", "msg"), F.struct((F.col("depth") - (1 << k)).alias("depth"), F.col("up").alias("msg"))))).alias("n"),
        ).select("conv", "leaf", "n.depth", "n.msg")
    return paths


def joined_in_order(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Each of the columns as one array per key, in order; gathered by pieces first."""
    item = F.struct(order, *columns)
    pieces = (
        rows.withColumn("__piece", F.floor(F.col(order) / TURNS_PER_PIECE))
        .groupBy(*keys, "__piece")
        .agg(F.sort_array(F.collect_list(item)).alias("__items"))
    )
    whole = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("__piece", "__items"))).alias("__all"))
    items = F.flatten(F.transform("__all", lambda p: p["__items"]))
    return whole.select(*keys, items.alias("__all")).select(*keys, *[F.col("__all")[c].alias(c) for c in columns])


def format_chats(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv, leaf, n_turns, formatted, loss_spans): one row for each chosen branch.

    messages: (conv, msg, parent, score, role, text). loss_spans has an entry for each turn:
    turn_start, start and length in code points of the formatted string; length 0 unless the assistant
    speaks, whose escaped text is the span.
    """
    messages = stage(messages.groupBy("conv", "msg").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent", "score")).alias("m")
    ).select("conv", "msg", "m.*"), "chat-messages")
    paths = branch_paths(messages, branches)
    said = messages.select(F.col("conv").alias("c2"), F.col("msg").alias("m2"), "role", "text")
    tag = F.concat(F.lit(OTHER), F.replace(escape(F.col("role")), F.lit("]"), F.lit("\\r")))
    for role, name in TAGS.items():
        tag = F.when(F.col("role") == role, F.lit(name)).otherwise(tag)
    turns = (
        paths.join(said, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("msg") == F.col("m2")))
        .select("conv", "leaf", "depth", "role", tag.alias("tag"), escape(F.col("text")).alias("body"))
        .withColumn("turn", F.concat(F.lit("["), "tag", F.lit("] "), "body", F.lit(" [/"), "tag", F.lit("]")))
    )
    before = Window.partitionBy("conv", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("turn_start", F.lit(3) + F.coalesce(F.sum(F.length("turn")).over(before), F.lit(0)))
    span = F.struct(
        F.col("turn_start").cast("long").alias("turn_start"),
        (F.col("turn_start") + F.length("tag") + 3).cast("long").alias("start"),
        F.when(F.col("role") == "assistant", F.length("body")).otherwise(0).cast("long").alias("length"),
    )
    rows = turns.select("conv", "leaf", "depth", "turn", span.alias("span"))
    return joined_in_order(rows, ["conv", "leaf"], "depth", ["turn", "span"]).select(
        "conv", "leaf", F.size("turn").cast("long").alias("n_turns"),
        F.concat(F.lit("<s>"), F.array_join("turn", ""), F.lit("</s>")).alias("formatted"), F.col("span").alias("loss_spans"),
    )


def parse_turns(formatted: Column) -> Column:
    """array<struct<segment, role, text>> back from a formatted string."""
    inner = F.substring(formatted, 4, F.length(formatted) - 7)
    # "[" occurs in tags only, so "][" is where one turn's closing tag meets the next turn's opening tag
    segments = F.split(inner, r"(?<=\])(?=\[)")

    def turn(s: Column) -> Column:
        tag = F.substring_index(F.substring_index(s, "]", 1), "[", -1)
        other = tag.substr(F.lit(len(OTHER) + 1), F.length(tag))
        role = unescape(F.replace(other, F.lit("\\r"), F.lit("]")))
        for name, t in TAGS.items():
            role = F.when(tag == t, F.lit(name)).otherwise(role)
        body = s.substr(F.length(tag) + 4, F.length(s) - 2 * F.length(tag) - 7)
        return F.struct(s.alias("segment"), role.alias("role"), unescape(body).alias("text"))

    return F.transform(segments, turn)


def loss_text(turns: Column, spans: Column) -> Column:
    """The unescaped text under the mask; each span is cut from its own turn's segment."""
    cut = lambda t, s: unescape(t["segment"].substr((s["start"] - s["turn_start"] + 1).cast("int"), s["length"].cast("int")))
    return F.array_join(F.zip_with(turns, spans, cut), "")
