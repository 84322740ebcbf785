"""Conversation structure repair by a shortest-edit search over secondary-sorted turns.

A conversation is to read `(s?(ua)+)?` in the initials of its roles: an optional system turn, then user
and assistant in turn. Each row is kept, given another role, or deleted, and empty turns may be put in
anywhere; the cheapest edits win, ties by the letters of the edits (D, I, K, R) in order.

One exchange brings a conversation into one partition. There its rows are sorted by turn downwards
and streamed through Python in Arrow batches: the state is the cost of the best edits from here to the end
for each of four places of the pattern, and each row gets one byte, the best edit for each place. The bytes
stay with their rows, so Spark's own sort, which spills to disk, holds them for a conversation of any
length; sorted upwards, the rows are streamed again and the bytes are followed from the first place on.
Nothing but the state is carried from batch to batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Places of the pattern: 0 before it, 1 after s, 2 after u, 3 after a. The turn that may come next.
ROLES = {0: "user", 1: "user", 2: "assistant", 3: "user"}
AFTER = {0: 2, 1: 2, 2: 3, 3: 2}
EDITS = "DIKR"
#: Cost of the missing turns at the end of a conversation, and those turns.
END = (0, 2 * INSERT, INSERT, 0)
_FAULTS = ("", "blank", "duplicate", "truncated")
_SPACE = "\t\n\x0b\x0c\r "


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of conversations with planted faults: conv_id, turn, role, text, here (false: dropped).

    What happens to a row depends on crc32(`conv_id:turn`) % 20: 0 drops it, 1 empties its text, 2 takes
    `.!?` out, 3 repeats it, 4 makes it a user's. Nulls in that key, in role and in text are one space.
    """
    one_space = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), one_space)
                             for c in ("conv_id", "turn")))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", one_space).alias("role"),
        F.coalesce("text", one_space).alias("text"), (F.crc32(key) % 20).alias("fate"))
    fate = F.col("fate")
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate.isin(0, 1), "").when(fate == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (fate != 0).alias("here"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _step(costs: tuple, initial: str, fault: int) -> tuple[tuple, int]:
    """Costs before a row from those after it, and the best edit for each place, two bits each."""
    late = TRUNCATED if fault == 3 else 0
    choices = []
    for place in range(4):
        found = {"D": DELETE + costs[place]}
        if fault in (0, 3):
            found["R"] = REROLE + late + costs[AFTER[place]]
            if initial == "s" and place == 0:
                found["K"] = KEEP + late + costs[1]
            elif initial == ROLES[place][0]:
                found["K"] = KEEP + late + costs[AFTER[place]]
        choices.append(found)
    plain = [min(found.values()) for found in choices]
    user, assistant = min(plain[2], INSERT + plain[3]), min(plain[3], INSERT + plain[2])
    best = (min(plain[0], INSERT + user), min(plain[1], INSERT + user), user, assistant)
    edits = 0
    for place, found in enumerate(choices):
        found["I"] = INSERT + best[AFTER[place]]
        edits |= EDITS.index(min(e for e in found if found[e] == best[place])) << 2 * place
    return best, edits


def _text(value: object) -> str | None:
    return value if isinstance(value, str) else None


def _choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The best edits of every row; rows of a conversation come from its last turn upwards."""
    known: dict[tuple, tuple] = {}
    current, costs = object(), END
    for frame in frames:
        edits = []
        for conv, initial, fault, here in zip(
                frame["conv"].tolist(), frame["initial"].tolist(), frame["fault"].tolist(),
                frame["here"].tolist()):
            conv = _text(conv)
            if conv != current:
                current, costs = conv, END
            if not here:
                edits.append(0)
                continue
            step = known.get((costs, initial, fault))
            if step is None:
                after, edit = _step(costs, initial, fault)
                least = min(after)  # only differences matter from here on
                step = known[costs, initial, fault] = (tuple(c - least for c in after), edit)
            costs, edit = step
            edits.append(edit)
        yield frame.assign(edits=edits)


def _apply(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edits along the best way; rows of a conversation come in the order of turns."""
    names = ["conv", "edit", "turn", "role", "text", "old_role", "fault"]
    current, place = object(), 0

    def tail(rows: list) -> None:
        nonlocal place
        while place in (1, 2):
            rows.append((current, "I", None, ROLES[place], "", None, 0))
            place = AFTER[place]

    for frame in frames:
        rows: list[tuple] = []
        for conv, turn, role, text, fault, here, edits in zip(*(
                frame[c].tolist() for c in
                ("conv", "turn", "role", "text", "fault", "here", "edits"))):
            conv, turn = _text(conv), _text(turn)
            if conv != current:
                tail(rows)
                current, place = conv, 0
            if not here:
                rows.append((conv, None, None, None, None, None, 0))
                continue
            while (edit := EDITS[edits >> 2 * place & 3]) == "I":
                rows.append((conv, "I", None, ROLES[place], "", None, 0))
                place = AFTER[place]
            if edit == "D":
                rows.append((conv, "D", turn, None, None, role, fault))
            elif edit == "R":
                rows.append((conv, "R", turn, ROLES[place], text, role, fault))
                place = AFTER[place]
            else:
                rows.append((conv, "K", turn, role, text, role, fault))
                place = 1 if role[:1] == "s" else AFTER[place]
        yield pd.DataFrame(rows, columns=names)
    rows = []
    tail(rows)
    yield pd.DataFrame(rows, columns=names)


_EDITED = ("conv string, edit string, turn string, role string, text string, old_role string, "
           "fault int")


def _edited(turns: DataFrame, present: Column | None) -> DataFrame:
    """Edits as text columns; a conversation's rows follow each other in one partition."""
    space = F.lit(" ")
    trimmed = F.rtrim("text", F.lit(_SPACE))
    rows = turns.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("here"))
    rows = rows.withColumn(
        "own", F.when(trimmed == "", 1).when(
            ~F.substring(trimmed, -1, 1).isin(".", "!", "?"), 3).otherwise(0))
    rows = rows.repartition("conv")
    order = Window.partitionBy("conv").orderBy(
        F.asc_nulls_first("turn"), "role", "text", "here")
    same = Window.partitionBy("conv", "here", "role", "text").orderBy("place")
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "seen", F.row_number().over(same))
    rows = rows.select(
        "conv", F.col("turn").cast("string").alias("turn"), "role", "text", "here", "place",
        F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("own") == 1, 1).when(F.col("seen") > 1, 2).otherwise(F.col("own"))
        .alias("fault"))
    schema = StructType([*rows.schema.fields, StructField("edits", IntegerType())])
    return (rows.sortWithinPartitions("conv", F.desc("place")).mapInPandas(_choose, schema)
            .sortWithinPartitions("conv", "place").mapInPandas(_apply, _EDITED))


def repair(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """Cheapest edits that give every conversation the pattern, one row per edit.

    Columns: conv_id, edit (K kept, R other role, D deleted, I put in), turn (null: put in), role and
    text after the repair (null: deleted), old_role (null: put in), fault (`blank`, `duplicate`,
    `truncated` or null). Needs conv_id, turn, role and text; other columns are ignored. Rows where
    `present` is not true only name their conversation, which gets one row without an edit if none else.

    Rows are taken by turn (nulls first), then role and text. Null role or text is one space; rows
    without conv_id are one conversation; equal rows are duplicates of the first; texts of any length
    are streamed whole, 64 MB of a conversation at a time; an empty table gives no rows.
    """
    edits = _edited(turns, present)
    fault = F.element_at(F.array(*map(F.lit, _FAULTS)), F.col("fault") + 1)
    return edits.where("edit is not null").select(
        F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), "edit",
        F.col("turn").cast("long").alias("turn"), "role", "text", "old_role",
        F.when(F.col("fault") > 0, fault).alias("fault"))


class _Summary:
    """Running figures of one conversation."""

    def __init__(self, conv: str | None):
        self.conv, self.first, self.last, self.turns = conv, None, None, 0
        self.faults, self.illegal, self.cost = [0, 0, 0, 0], 0, 0
        self.audit, self.digest, self.lines, self.role = bytearray(), hashlib.sha256(), 0, None

    def add(self, edit: str, turn: str | None, role: str, text: str, old_role: str,
            fault: int) -> None:
        self.audit += edit.encode()
        self.cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
        if fault == 3 and edit != "D":
            self.cost += TRUNCATED
        if edit != "D":
            self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
            self.lines += 1
        if edit == "I":
            return
        self.faults[fault] += 1
        if self.role is not None and self.role[:1] + old_role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.role = old_role
        if turn is not None:
            number = int(turn)
            if self.first is None:
                self.first = number
            if number != self.last:
                self.turns += 1
            self.last = number

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, self.audit.decode(),
                self.digest.hexdigest())


_SUMMARY = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
            "repaired_sha256"]


def _summarise(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    summary = None
    for frame in frames:
        done = []
        for conv, edit, turn, role, text, old_role, fault in zip(*(
                frame[c].tolist() for c in
                ("conv", "edit", "turn", "role", "text", "old_role", "fault"))):
            conv = _text(conv)
            if summary is None or summary.conv != conv:
                if summary is not None:
                    done.append(summary.row())
                summary = _Summary(conv)
            if _text(edit) is not None:
                summary.add(edit, _text(turn), role, text, old_role, fault)
        yield pd.DataFrame(done, columns=_SUMMARY)
    yield pd.DataFrame([] if summary is None else [summary.row()], columns=_SUMMARY)


def repair_reports(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per conversation: the faults found, the edits made by `repair` and a digest.

    Columns: conv_id, gaps (turn numbers missing between the least and the largest), blank, duplicate,
    truncated, illegal (adjacent roles before the repair that the pattern does not allow), cost, audit
    (the edits' letters in order), repaired_sha256 (of `role:text` lines after the repair). The edits
    are summed up while they stream by, in the same stage as the repair. A conversation with no
    present row has zeros, an empty audit and the digest of an empty text. Nulls, ties, repeated
    rows, long texts and empty tables as in `repair`.
    """
    schema = ("conv string, gaps long, blank long, duplicate long, truncated long, illegal long, "
              "cost long, audit string, repaired_sha256 string")
    reports = _edited(turns, present).mapInPandas(_summarise, schema)
    return reports.select(
        F.col("conv").cast(turns.schema["conv_id"].dataType).alias("conv_id"), *_SUMMARY[1:])
