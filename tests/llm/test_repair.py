"""Conversation repair against exhaustive search and the SQL twin's rules."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import repair
from quarry.llm.queries import damaged, op12_conversation_repair

GOAL = re.compile(r"(s?(ua)+)?")
SHAPE = "conv_id long, turn int, role string, text string, note string"
HAS_WORD = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = HAS_WORD.findall(text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "sound" if last[0] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, turns) of the best repair by trying all edits with up to two inserted turns between rows."""
    given, best = faults(rows), None

    def go(i, cost, audit, turns):
        nonlocal best
        roles = "".join(r[:1] or "?" for r, _ in turns)
        if not re.fullmatch(r"(s?(ua)*u?)?", roles) or (best and cost > best[0]):
            return
        if i == len(rows) and GOAL.fullmatch(roles):
            best = min(best, (cost, audit, turns)) if best else (cost, audit, turns)
        if len(audit) - len(audit.rstrip("I")) < 2:
            for role in ("user", "assistant"):
                go(i, cost + 2, audit + "I", [*turns, (role, "")])
        if i < len(rows):
            role, text = rows[i]
            go(i + 1, cost + 3, audit + "D", turns)
            if given[i] in ("sound", "truncated"):
                extra = given[i] == "truncated"
                go(i + 1, cost + extra, audit + "K", [*turns, (role, text)])
                for to in ("user", "assistant"):
                    go(i + 1, cost + 2 + extra, audit + "R", [*turns, (to, text)])

    go(0, 0, "", [])
    return best


def runs_of(rows):
    codes = {"blank": repair.DEAD, "duplicate": repair.DEAD, "sound": repair.SOUND, "truncated": repair.TRUNCATED}
    symbols = [repair.symbol(role, codes[f]) for (role, _), f in zip(rows, faults(rows))]
    return [(s, len(list(g))) for s, g in itertools.groupby(symbols)]


def test_plans_equal_exhaustive_search():
    draw = random.Random(3)
    for _ in range(400):
        rows = [(draw.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]), draw.choice(["", " ", "a.", "b", "c!", "d?\n"]))
                for _ in range(draw.randrange(0, 6))]
        cost, audit, _ = cheapest(rows)
        assert repair.plan(runs_of(rows)) == (cost, audit), rows


def naive_plan(symbols):
    """Cost and audit by a forward table of one entry per row and state."""
    ways = {0: (0, "")}
    for sym in symbols:
        padded = dict(ways)
        for _ in range(3):
            for s, (c, a) in list(padded.items()):
                to = 3 if s == 2 else 2
                padded[to] = min(padded.get(to, (9e9, "")), (c + 2, a + "I"))
        after = {}
        for s, (c, a) in padded.items():
            for letter, cost, to in repair._edits(sym, s):
                after[to] = min(after.get(to, (9e9, "")), (c + cost, a + letter))
        ways = after
    ends = [(c + {0: 0, 1: 4, 2: 2, 3: 0}[s], a + {0: "", 1: "II", 2: "I", 3: ""}[s]) for s, (c, a) in ways.items()]
    return min(ends)


def test_long_runs_equal_the_row_by_row_table():
    draw = random.Random(5)
    for _ in range(40):
        runs = []
        while sum(n for _, n in runs) < 300:
            s = draw.randrange(12)
            if not runs or runs[-1][0] != s:
                runs.append((s, draw.choice([1, 1, 2, 3, 17, 64, 65, 130])))
        assert repair.plan(runs) == naive_plan([s for s, n in runs for _ in range(n)])


def test_a_run_of_a_billion_rows_takes_a_few_products():
    togo = repair.before(repair.symbol("user", repair.SOUND), 10**9, (0, 4, 2, 0))
    assert togo[0] == 10**9  # every second one becomes an answer


def expected(rows):
    """{conv_id: query row} of a table by hand."""
    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        convs[c] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen = [(role, text) for _, role, text in turns]
        kinds, numbers = faults(seen), {t for t, _, _ in turns if t is not None}
        cost, audit, left = cheapest(seen)
        lines = "\n".join(f"{r}:{t}" for r, t in left)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(seen, seen[1:]))
        out[c] = (max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, kinds.count("blank"), kinds.count("duplicate"),
                  kinds.count("truncated"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


ODD = [
    (1, 0, "system", "Be kind.", "x"), (1, 1, "user", "Why?", "x"), (1, 2, "assistant", "So.", "x"), (1, 2, "assistant", "So.", "x"),
    (2, None, "user", "a", None), (2, 3, None, None, None), (2, 7, "assistant", "", None), (3, None, None, None, None),
    (None, 1, "user", "Hm?", "y"), (None, 2, "assistant", "Yes.", "y"), (4, 1, "", "é!", ""), (4, 1, "user", "é!", ""),
    (5, 1, "assistant", "x" * 70_000 + ".", ""), (5, 2, "user", " \t\n", ""), (6, 4, "tool", "t.", ""), (6, 5, "system", "s.", ""),
    (-7, -3, "user", "neg.", ""), (-7, 9, "user", "neg.", ""),
]


def as_query(spark, tmp_path, rows):
    spark.createDataFrame(rows, SHAPE).write.parquet(str(tmp_path / "conversations.parquet"))
    found = op12_conversation_repair(spark, str(tmp_path)).collect()
    assert len(found) == len({r.conv_id for r in found})
    return {r.conv_id: tuple(r)[1:] for r in found}


def test_odd_rows(spark, tmp_path):
    assert as_query(spark, tmp_path, ODD) == expected(ODD)


def test_an_empty_table(spark, tmp_path):
    assert as_query(spark, tmp_path, []) == {}


def test_random_tables(spark, tmp_path):
    draw = random.Random(11)
    rows = [(c, draw.choice([None, 0, 1, 2, 3, 4, 5]), draw.choice(["system", "user", "assistant", "assistant", None]),
             draw.choice(["one.", "two", "three!", " ", None, "four. "]), "")
            for c in range(60) for _ in range(draw.randrange(1, 6))]
    assert as_query(spark, tmp_path, rows) == expected(rows)


def test_repaired_turns_and_clashing_names(spark):
    rows = [(1, 1, "user", "a.", 5, 6, 7), (1, 2, "user", "b.", 5, 6, 7)]
    turns = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string, key int, place int, audit int")
    found = repair.audits(turns)
    left = repair.repaired(turns, found).orderBy("place").collect()
    assert found.first()["audit"] == "KIKI" or found.first()["cost"] == 2
    assert "".join(r.role[0] for r in left) == "ua" and [r.place for r in left] == [0, 1]
    assert dict(found.dtypes)["conv_id"] == "int"


def test_one_conversation_is_spread_over_tasks(spark):
    turns = spark.range(4000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.expr("IF(id % 2 = 0, 'user', 'assistant')").alias("role"),
        F.concat(F.lit("t"), "id", F.lit(".")).alias("text"))
    audit = repair.audits(turns).first()
    assert (audit.cost, audit.audit) == (0, "K" * 4000)
    rows = repair._counted(repair._clean(turns))
    place = ["conv_id", "turn"]
    parts = rows.repartitionByRange(4, *place).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1
    shas = repair.digests(repair.repaired(turns, repair.audits(turns))).first().repaired_sha256
    text = "\n".join(f"{'assistant' if i % 2 else 'user'}:t{i}." for i in range(4000))
    assert shas == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("draw", range(5))
def test_damage(spark, draw):
    keys = [(c, t) for c in range(40) for t in range(5) if zlib.crc32(f"{c}:{t}".encode()) % 20 == draw]
    rows = [(c, t, "assistant", "One. Two!") for c, t in keys]
    got = [tuple(r) for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()]
    change = {0: [], 1: [("assistant", "")], 2: [("assistant", "One Two")], 3: [("assistant", "One. Two!")] * 2, 4: [("user", "One. Two!")]}
    assert sorted(got) == sorted((c, t, *new) for c, t in keys for new in change[draw])
