"""Conversations from messages that quote each other.

Quoted lines start with ``>``; the number of marks is the level. Consecutive quoted lines of one level are a passage.
A passage, its paragraphs and its lines are hashed after normalising (marks off, white space collapsed, case folded) and
joined to the same units of the messages' own words in the same conversation. The message replies to the latest
earlier one that holds the unit; whole passages count before paragraphs before lines, lower levels before
higher ones. Quotes and the "... wrote:" lines before them are dropped, and messages go in reply
order: threads by the turn of their first message, then by turn.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import saved

MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.S)
#: How a line ends that announces a quote, and how an announcement begins that is wrapped over some lines.
WROTE = re.compile(r".*\b(?:wrote|writes|escribió|a écrit|schrieb\b[^:]*)\s*:\s*$", re.I | re.S)
OPENS = re.compile(r"\s*(?:on|am|el|le)\b", re.I)
WRAPPED = 3
WHOLE, PARAGRAPH, LINE = 0, 1, 2
#: Turns that share a step of the search for the latest earlier message.
STEP, ROUNDS = 1024, 64


def levels(text: str) -> list[tuple[int, str]]:
    """Each line with its quote level (0: own words) and without its marks."""
    out = []
    for line in text.split("\n"):
        found = MARKS.fullmatch(line)
        out.append((found[1].count(">"), found[2]) if found else (0, line))
    return out


def announcements(lines: list[tuple[int, str]]) -> set[int]:
    """Places of lines that announce a quote: the last own words before it, if they end like that, and the blank lines between.

    If such a line does not open the announcement, up to ``WRAPPED - 1`` lines right above that lead to its opening belong to it.
    """
    out: set[int] = set()
    for start in range(1, len(lines)):
        if not lines[start][0] or lines[start - 1][0]:
            continue
        last = start - 1
        while last >= 0 and not lines[last][0] and not lines[last][1].strip():
            last -= 1
        if last < 0 or lines[last][0] or not WROTE.fullmatch(lines[last][1]):
            continue
        first = last
        for above in range(last, max(last - WRAPPED, -1), -1):
            if lines[above][0] or not lines[above][1].strip():
                break
            if OPENS.match(lines[above][1]):
                first = above
                break
        out.update(range(first, start))
    return out


def own_words(lines: list[tuple[int, str]]) -> str:
    """The unquoted lines, without those that only announce a quote, blank lines at the ends removed."""
    gone = announcements(lines)
    kept = [line for i, (level, line) in enumerate(lines) if not level and i not in gone]
    while kept and not kept[0].strip():
        kept.pop(0)
    while kept and not kept[-1].strip():
        kept.pop()
    return "\n".join(kept)


def _hash(lines: list[str]) -> str | None:
    text = " ".join(" ".join(lines).split()).casefold()
    return hashlib.sha256(text.encode()).hexdigest()[:32] if text else None


def units(lines: list[str]) -> dict[str, int]:
    """Hashes of a passage, its paragraphs and lines, each with the widest kind it is."""
    out: dict[str, int] = {}
    paragraph: list[str] = []
    for line in [*lines, ""]:
        if line.strip():
            paragraph.append(line)
        elif paragraph:
            out.setdefault(_hash(paragraph), PARAGRAPH)
            paragraph = []
    for line in lines:
        out.setdefault(_hash([line]), LINE)
    out[_hash(lines)] = WHOLE
    out.pop(None, None)
    return out


def _parsed(batches):
    for batch in batches:
        own, said, quoted, deepest = [], [], [], []
        for text in batch.column("text").to_pylist():
            lines = levels(text or "")
            own.append(own_words(lines))
            said.append([{"hash": h, "kind": k} for h, k in units(own[-1].split("\n")).items()])
            found: dict[str, tuple[int, int]] = {}
            start = 0
            for i in range(1, len(lines) + 1):
                if i == len(lines) or lines[i][0] != lines[start][0]:
                    level = lines[start][0]
                    if level:
                        for h, k in units([line for _, line in lines[start:i]]).items():
                            found[h] = min(found.get(h, (level, k)), (level, k))
                    start = i
            quoted.append([{"hash": h, "level": level, "kind": k} for h, (level, k) in found.items()])
            deepest.append(max((level for level, _ in lines), default=0))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("turn"), batch.column("role"), pa.array(own, pa.string()),
             pa.array(said, pa.list_(pa.struct([("hash", pa.string()), ("kind", pa.int32())]))),
             pa.array(quoted, pa.list_(pa.struct([("hash", pa.string()), ("level", pa.int32()), ("kind", pa.int32())]))),
             pa.array(deepest, pa.int32())],
            names=["conv_id", "turn", "role", "text", "said", "quoted", "levels"])


def reply_links(parsed: DataFrame) -> DataFrame:
    """``(conv_id, turn, reply_to)`` of every message that quotes an earlier one.

    The latest earlier turn with a unit comes from windows over steps of ``STEP`` turns and, for earlier steps, a
    window over their last turns, so no pair of quoting and quoted rows is formed.
    """
    asked = parsed.select("conv_id", "turn", F.explode("quoted").alias("q")).select(
        "conv_id", "turn", "q.hash", "q.level", "q.kind")
    told = parsed.select("conv_id", F.col("turn").alias("said_at"), F.explode("said").alias("s")).select(
        "conv_id", "said_at", "s.hash")
    told = told.join(asked.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi").distinct()
    none = F.lit(None)
    rows = (asked.withColumn("said_at", none.cast("long"))
            .unionByName(told.select("conv_id", F.col("said_at").alias("turn"), "hash", none.cast("int").alias("level"),
                                     none.cast("int").alias("kind"), "said_at"))
            .withColumn("step", F.floor(F.col("turn") / STEP)))
    near = Window.partitionBy("conv_id", "hash", "step").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv_id", "hash").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = (rows.groupBy("conv_id", "hash", "step").agg(F.max("said_at").alias("last"))
             .withColumn("earlier", F.max("last").over(before)).select("conv_id", "hash", "step", "earlier"))
    met = (rows.withColumn("near", F.max("said_at").over(near)).where("level is not null")
           .join(steps, ["conv_id", "hash", "step"])
           .withColumn("reply_to", F.coalesce("near", "earlier")).where("reply_to is not null"))
    best = F.min(F.struct(F.col("kind"), F.col("level"), (-F.col("reply_to")).alias("back")))
    return met.groupBy("conv_id", "turn").agg(best.alias("b")).select("conv_id", "turn", (-F.col("b.back")).alias("reply_to"))


def _roots(links: DataFrame) -> DataFrame:
    """``(conv_id, turn, root)``: follow replies to the first message, doubling the way each round."""
    paths = saved(links.select("conv_id", "turn", F.col("reply_to").alias("root")), "replies")
    for _ in range(ROUNDS):
        onward = paths.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"))
        longer = saved(paths.join(onward, ["conv_id", "root"], "left")
                       .select("conv_id", "turn", F.coalesce("further", "root").alias("root"),
                               F.col("further").isNotNull().alias("moved")), "replies")
        paths = longer.select("conv_id", "turn", "root")
        if longer.where("moved").isEmpty():
            return paths
    raise RuntimeError("replies did not settle")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """``messages(conv_id, turn, role, text)`` -> one row for each row: ``conv_id, turn, position`` (from 0, in reply
    order), ``reply_to`` (a turn, or null), ``thread`` (the turn of its first message), ``quote_levels``, ``role``, ``text``
    (own words) and ``formatted`` (the message in chat markup).

    A null text is empty; a null role is "unknown"; rows without a conversation or turn share the conversation or turn
    null and reply to nothing. Messages of one turn are one place for links and ordered by
    role and text; repeated rows stay. Quoted text that nobody wrote earlier is dropped without a link. Other columns are not read.
    """
    spark = messages.sparkSession
    picked = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    unit = "array<struct<hash:string,kind:int>>"
    quote = "array<struct<hash:string,level:int,kind:int>>"
    parsed = saved(picked.mapInArrow(
        _parsed, f"conv_id long, turn long, role string, text string, said {unit}, quoted {quote}, levels int"), "messages")
    links = saved(reply_links(parsed), "reply-links")
    roots = _roots(links).withColumnRenamed("root", "thread")
    linked = (parsed.join(links, ["conv_id", "turn"], "left").join(roots, ["conv_id", "turn"], "left")
              .select("conv_id", "turn", "reply_to", F.coalesce("thread", "turn").alias("thread"),
                      F.col("levels").alias("quote_levels"), F.coalesce("role", F.lit("unknown")).alias("role"), "text"))
    keys = ["conv_id", "thread", "turn", "role", "text"]
    ordered = saved(linked.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("row", F.monotonically_increasing_id()), "ordered")
    task = F.shiftright("row", 33)
    sizes = ordered.groupBy(task.alias("task")).count().collect()  # one row for each task
    done, base = 0, []
    for size in sorted(sizes):
        base.append((size["task"], done))
        done += size["count"]
    base = spark.createDataFrame(base, "task long, base long")
    placed = (ordered.withColumn("task", task).join(F.broadcast(base), "task")
              .withColumn("place", F.col("base") + F.col("row").bitwiseAND((1 << 33) - 1)))
    first = placed.groupBy("conv_id").agg(F.min("place").alias("first")).withColumnRenamed("conv_id", "conv")
    markup = F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>\n"))
    return placed.join(first, F.col("conv_id").eqNullSafe(F.col("conv"))).select(
        "conv_id", "turn", (F.col("place") - F.col("first")).alias("position"), "reply_to", "thread", "quote_levels",
        "role", "text", markup.alias("formatted"))
