import hashlib
import heapq
import random
import re
import zlib

from studyloom.llm import queries
from studyloom.llm.conversations import damage, repair, repair_reports

SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    """By conversation: rows after damage, in order. Written from the description alone."""
    out = {}
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        fate = zlib.crc32(key.encode()) % 20
        kept = out.setdefault(conv, [])
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        if fate:
            kept += [(turn, role, text)] * (2 if fate == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
            for c, v in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        signs = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not signs else "duplicate" if (role, text) in seen
                   else "truncated" if signs[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Uniform-cost search over (cost, audit): rows taken and the roles written so far."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, lines
        shape = re.sub("(ua)+", "ua", roles)
        if (at, shape) in done:
            continue
        done.add((at, shape))

        def go(more, letter, step, role=None, text=""):
            new = roles + (role[:1] if role else "")
            if role is None or re.fullmatch("s?(ua)*u?", new) and new[-1:] in "sua" and role:
                heapq.heappush(heap, (cost + more, audit + letter, at + step, new,
                                      lines + ((f"{role}:{text}",) if role else ())))

        for role in ("user", "assistant"):
            go(3, "I", 0, role)
        if at < len(rows):
            _, role, text = rows[at]
            go(4, "D", 1)
            if found[at] in (None, "truncated"):
                late = 3 if found[at] else 0
                if role[:1] in ("s", "u", "a"):
                    go(late, "K", 1, role, text)
                for other in ("user", "assistant"):
                    go(3 + late, "R", 1, other, text)
    raise AssertionError


def brute(rows):
    out = []
    for conv, kept in damaged(rows).items():
        found = faults(kept)
        cost, audit, lines = cheapest(kept, found)
        turns = [t for t, _, _ in kept if t is not None]
        out.append((
            conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(repr, out))


def reported(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def made_up(n, seed):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", None, "", "tool", "unknown"]
    texts = ["Yes.", "No!", "why?", "cut off", " ", "", None, "end. \n\x0b", "é", "x\x1f", "a" * 50_000]
    rows = []
    for conv in [None, *range(n)]:
        odd, turn = rng.random() < 0.5, 0
        for k in range(rng.randrange(1, 9)):
            turn += rng.choice([1, 1, 1, 1, 0, 3])
            role = rng.choice(roles) if odd else roles[k % 2]
            rows.append((conv, rng.choice([turn] * 9 + [None]), role, rng.choice(texts)))
    rng.shuffle(rows)
    return rows


def test_equals_a_search_over_all_edits(spark):
    rows = made_up(400, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("conv", "here", "place", "edit", "fault", "copy"):
        from pyspark.sql import functions as F

        df = df.withColumn(name, F.lit("x"))
    bad = damage(df)
    assert reported(repair_reports(bad, bad["here"])) == brute(rows)


def test_state_is_carried_across_batches(spark):
    rows = made_up(60, 2) + [(7, t, "user" if t % 3 else "assistant", f"turn {t}.")
                             for t in range(10, 700)]
    df = spark.createDataFrame(rows, SCHEMA)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        bad = damage(df)
        assert reported(repair_reports(bad, bad["here"])) == brute(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_repaired_rows_have_the_pattern(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "system", "Be brief."), (1, 2, "user", ""),
            (2, 5, "system", "Rules."), (2, 6, "user", "Why?"), (3, 1, "user", "x" * 3_000_000)]
    got = repair(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {c: [r for r in got if r.conv_id == c] for c in (1, 2, 3)}
    assert [r.edit for r in by[2]] == ["K", "K", "I"] and by[2][2].role == "assistant"
    for rows_of in by.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in rows_of if r.role))
    assert [r.fault for r in by[1]][-1] == "blank" and by[1][-1].role is None
    assert by[3][0].edit == "D" and by[3][0].fault == "truncated"


def test_empty_table_and_conversation_without_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair(none).count() == 0 and repair_reports(damage(none)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    bad = damage(spark.createDataFrame([(gone, 0, "user", "x")], SCHEMA))
    assert [tuple(r) for r in repair_reports(bad, bad["here"]).collect()] == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_query_equals_the_search(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select(
        "conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op12_streamed_conversation_repair"](spark, folder)
    assert reported(got) == brute(rows)
