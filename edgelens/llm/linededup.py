"""Line dedup by winnowing over line hashes (operator 7), in DataFrame operations only.

Lines are compared trimmed; blank lines are passed over and kept. A gram is the shortest run of lines
from some line on that has at least GRAM words. Among the grams that start within THRESHOLD - GRAM words
of a line, the one with the smallest hash is selected. A repeated run of THRESHOLD words or more holds all
the grams that can be selected at its first line, in each of its copies, so its copies share a selected
gram: winnowing's guarantee. Each selected gram is joined with the first occurrence of the same gram, in
order of (id, position), and the match is extended line by line both ways; matches of at least THRESHOLD
words are repeated runs, and their lines are deleted from the later place. Where later places part from the
first and go on alike, they may share a run that the first place lacks: there the shortest runs of THRESHOLD
words around the gram are compared as well. So exactly those lines go that stand in a run of at least
THRESHOLD words of which an earlier place has a copy.

Matches go to one first occurrence, never to all pairs. A gram joins by one 64-bit hash of its lines and extends by
another, and a shortest run joins by both. A line's words stand between Unicode white space; a line without words
is blank.

Defined results: null text stays null; a text of which every line is repeated becomes empty, its row
stays; the first occurrence in order of (id, hash of id and text, line) always stays, in one document too; rows with
equal id and text are one document and are edited alike; short lines that repeat alone stay; an empty
table stays empty; other columns pass unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from edgelens.llm.common import hot_limit, row_key
from edgelens.runtime import stage

THRESHOLD, GRAM = 50, 25
WHITE = r"(?U)\s+"  # Unicode white space, no-break spaces too
REACH = 64  # non-blank lines that extension looks at on each side, more than THRESHOLD words have


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, h, g, w, at): two hashes, word counts and places of each document's non-blank lines."""
    lines = F.transform(F.split(F.col(text_col), "\n", -1), lambda x, i: F.struct(
        F.xxhash64(F.trim(x)).alias("h"), F.xxhash64(F.lit(1), F.trim(x)).alias("g"),
        F.size(F.filter(F.split(x, WHITE), lambda t: t != "")).alias("w"), i.alias("at"),
    ))
    words = F.filter(lines, lambda x: x["w"] > 0)
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), words.alias("x"))
    return rows.where(F.size("x") > 0).select("id", "key", *[F.col(f"x.{c}").alias(c) for c in ("h", "g", "w", "at")]).dropDuplicates(["key"])


def selected_grams(table: DataFrame, threshold: int, gram: int) -> DataFrame:
    """(id, key, gram, at): the selected grams' hashes and first lines."""
    lines = table.select("id", "key", F.posexplode(F.arrays_zip("g", "w")).alias("at", "x")).select("id", "key", "at", "x.g", "x.w")
    order = Window.partitionBy("key").orderBy("at")
    lines = lines.withColumn("end", F.sum(F.col("w").cast("long")).over(order))
    lines = lines.withColumn("start", F.col("end") - F.col("w")).withColumn("total", F.sum("w").over(Window.partitionBy("key")))
    along = Window.partitionBy("key").orderBy("start")
    grams = lines.withColumn("gram", F.xxhash64(F.collect_list("g").over(along.rangeBetween(0, gram - 1))))
    # what is left of a document may be too short for a gram
    grams = grams.withColumn("candidate", F.when(F.col("total") - F.col("start") >= gram, F.struct("gram", "at")))
    best = F.min("candidate").over(along.rangeBetween(0, threshold - gram))
    return (
        grams.withColumn("best", best)
        .where(F.col("best").isNotNull() & (F.col("total") - F.col("start") >= threshold))
        .select("id", "key", F.col("best.gram").alias("gram"), F.col("best.at").alias("at"))
        .distinct()
    )


def _agreeing(a: Column, b: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y)
    first = F.array_position(same, False)
    return F.when(first > 0, first - 1).otherwise(F.size(same)).cast("int")


def around(h: Column, at: Column, gram: int) -> tuple[Column, Column]:
    """The hashes from a line on, and those before it, the nearest first."""
    forward = F.slice(h, at + 1, F.lit(REACH + gram))
    backward = F.reverse(F.slice(h, F.greatest(at - REACH, F.lit(0)) + 1, F.least(at, F.lit(REACH))))
    return forward, backward


def with_first(places: DataFrame, first: DataFrame, keys: list[str]) -> DataFrame:
    """The places (id, key, keys, at) after the first one of their keys, with first's columns.

    first: (keys, n, f), n rows each. The few keys with very many places are joined by broadcast, so that
    none of them is one task's."""
    limit = hot_limit(places.count())
    hot = F.broadcast(first.where(F.col("n") > limit))
    cold = places.join(hot.select(*keys), keys, "left_anti").join(first.where(F.col("n") <= limit), keys)
    return places.join(hot, keys).unionByName(cold).where(F.struct("id", "key", "at") > F.col("f"))


def first_places(places: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, f): the first place of what has several."""
    return places.groupBy(*keys).agg(F.min(F.struct("id", "key", "at")).alias("f"), F.count("*").alias("n")).where("n > 1")


def extended(places: DataFrame, table: DataFrame, gram: int) -> DataFrame:
    """(key, gram, n, from, to, words, ahead, next, back, prev): for each later place of a gram the lines on which its
    document agrees with the first place, how many ahead and back, and the hashes of the lines where that ends."""
    ahead, back = around(F.col("h"), F.col("f.at"), gram)
    first = first_places(places, ["gram"]).withColumn("first_key", F.col("f.key"))
    first = first.join(table.select(F.col("key").alias("first_key"), "h"), "first_key").select("gram", "n", "f", ahead.alias("f2"), back.alias("b2"))
    links = with_first(places, stage(first, "line-firsts"), ["gram"]).select("key", "gram", "at", "n", "f2", "b2")
    ahead, back = around(F.col("h"), F.col("at"), gram)
    words = F.slice("w", F.greatest(F.col("at") - REACH, F.lit(0)) + 1, F.least("at", F.lit(REACH)) + REACH + gram)
    both = links.join(table.select("key", "h", "w"), "key").select("key", "gram", "at", "n", "f2", "b2", ahead.alias("f1"), back.alias("b1"), words.alias("w"))
    both = both.withColumn("ahead", _agreeing(F.col("f1"), F.col("f2"))).withColumn("back", _agreeing(F.col("b1"), F.col("b2")))
    # where a document repeats itself the copies may overlap: one period stays before the later copy
    matched = F.slice("w", F.least("at", F.lit(REACH)) - F.col("back") + 1, F.col("back") + F.col("ahead"))
    return both.select(
        "key", "gram", "n", (F.col("at") - F.col("back")).alias("from"), (F.col("at") + F.col("ahead")).alias("to"),
        F.aggregate(matched, F.lit(0), lambda s, x: s + x).alias("words"),
        "ahead", F.get("f1", F.col("ahead")).alias("next"), "back", F.get("b1", F.col("back")).alias("prev"),
    )


def branching_grams(runs: DataFrame) -> DataFrame:
    """(gram): the grams of which two later places part from the first at the same line and go on alike.

    If a place shares a run of lines with an earlier place but not with the first one, both part from the first
    inside that run, at the same line and with the same next line; of other grams the first place tells all."""
    many = runs.where("n > 2")
    after = many.where("next is not null").groupBy("gram", "ahead", "next").count()
    before = many.where("prev is not null").groupBy("gram", "back", "prev").count()
    return after.where("count > 1").select("gram").union(before.where("count > 1").select("gram")).distinct()


def shortest_runs(grams: DataFrame, table: DataFrame, threshold: int, gram: int) -> DataFrame:
    """(id, key, run, again, lines, at): two hashes of the runs of at least threshold words, which are shorter without
    their first or last line, and of which the first line may have selected the gram at one of grams' places.

    Every line of a longer run is in such a run inside it."""
    starts = F.sequence(F.greatest(F.col("at") - (threshold - gram), F.lit(0)), F.col("at"))
    near = F.filter(starts, lambda s: F.aggregate(F.slice("w", s + 1, F.col("at") - s), F.lit(0), lambda n, x: n + x) <= threshold - gram)

    def ends(s: Column) -> Column:
        whole = lambda n: (n >= threshold) & (n - F.get("w", s) < threshold)
        least = lambda n, w: (n >= threshold) & (n - w < threshold)
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("lines"), F.array().cast("array<int>").alias("out"))

        def add(a: Column, x: Column) -> Column:
            n, lines = a["n"] + x, a["lines"] + 1
            out = F.when(whole(n) | least(n, x), F.concat(a["out"], F.array(lines))).otherwise(a["out"])
            return F.struct(n.alias("n"), lines.alias("lines"), out.alias("out"))

        return F.aggregate(F.slice("w", s + 1, F.lit(threshold)), start, add)["out"]

    def runs(s: Column) -> Column:
        return F.transform(ends(s), lambda n: F.struct(
            F.xxhash64(F.slice("g", s + 1, n)).alias("run"), F.xxhash64(F.lit(1), F.slice("h", s + 1, n)).alias("again"), n.alias("lines"), s.alias("at"),
        ))

    rows = grams.join(table.select("key", "h", "g", "w"), "key").select("id", "key", F.explode(F.flatten(F.transform(near, runs))).alias("r"))
    return rows.select("id", "key", "r.*").distinct()


def repeated_lines(table: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM) -> DataFrame:
    """(key, gone): for each document with later repeated runs, the numbers of the lines to delete."""
    grams = stage(selected_grams(table, threshold, gram), "line-grams")
    runs = stage(extended(grams, table, gram), "line-runs")
    branching = stage(branching_grams(runs), "line-branching")
    places = grams.join(branching, "gram", "left_semi").select("id", "key", "at").distinct()
    more = stage(shortest_runs(places, table, threshold, gram), "line-more")
    keys = ["run", "again"]
    more = with_first(more, stage(first_places(more, keys), "line-more-firsts"), keys).select("key", F.col("at").alias("from"), (F.col("at") + F.col("lines")).alias("to"))
    runs = runs.where(F.col("words") >= threshold).select("key", "from", "to").unionByName(more)
    spans = runs.groupBy("key").agg(F.collect_set(F.struct("from", "to")).alias("runs")).join(table.select("key", "at"), "key")
    gone = F.array_distinct(F.flatten(F.transform("runs", lambda r: F.slice("at", r["from"] + 1, r["to"] - r["from"]))))
    return spans.select("key", gone.alias("gone"))


def dedup_lines(
    docs: DataFrame, threshold: int = THRESHOLD, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """docs with the lines of later repeated runs taken out of text_col, and n_lines_removed."""
    table = stage(line_table(docs, id_col, text_col), "line-table")
    gone = repeated_lines(table, threshold, gram).withColumnRenamed("key", "__key")
    lines = F.split(F.col(text_col), "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    kept = [c for c in docs.columns if c.lower() != "n_lines_removed"]
    joined = docs.select(*[F.col(f"`{c}`") for c in kept], row_key(id_col, text_col).alias("__key")).join(gone, "__key", "left")
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_lines_removed"),
    )
