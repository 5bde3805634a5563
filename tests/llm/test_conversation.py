from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from helpers import with_clashes

from seqprep.llm import conversation

PATTERN = re.compile(r"(s?(ua)+)?")
SF_DIR = "/root/testdata/sf0.001"


def every_audit(rows, most_inserts=2):
    """All (cost, audit) that lead to the pattern, by trying out everything."""
    found = []

    def go(i, cost, audit, roles, inserts):
        if i == len(rows) and PATTERN.fullmatch(roles):
            found.append((cost, audit))
        if inserts < most_inserts:
            for c in "ua":
                go(i, cost + 5, audit + "I", roles + c, inserts + 1)
        if i == len(rows):
            return
        initial, must_go, truncated = rows[i]
        go(i + 1, cost + 2, audit + "D", roles, inserts)
        if not must_go:
            stay = 5 if truncated else 0
            if initial:
                go(i + 1, cost + stay, audit + "K", roles + initial, inserts)
            for c in "ua":
                go(i + 1, cost + stay + 1, audit + "R", roles + c, inserts)

    go(0, 0, "", "", 0)
    return min(found)


def by_strings(rows):
    """The same programme with whole audits as text: (cost, audit) for each state."""
    inf = (10**9, "")
    best = {"": (0, ""), "s": inf, "u": inf, "a": inf}
    after = {"u": ("", "s", "a"), "a": ("u",), "s": ("",)}

    def inserts():
        for to in "ua":
            best[to] = min([best[to]] + [(best[s][0] + 5, best[s][1] + "I") for s in after[to]])

    for initial, must_go, truncated in rows:
        inserts()
        new = {s: (b[0] + 2, b[1] + "D") for s, b in best.items()}
        if not must_go:
            for to, sources in after.items():
                if to == initial or to != "s":
                    cost, letter = (0, "K") if to == initial else (1, "R")
                    cost += 5 if truncated else 0
                    new[to] = min([new[to]] + [(best[s][0] + cost, best[s][1] + letter) for s in sources])
        best = new
    inserts()
    return min(best[""], best["a"])


def solved(rows):
    work = conversation.Repair()
    for row in rows:
        work.row(*row)
    return work.end()


def some_rows(rng, n, initials="suax"):
    return [(rng.choice(initials), rng.random() < 0.15, rng.random() < 0.2) for _ in range(n)]


def test_least_of_all_audits():
    rng = random.Random(1)
    for _ in range(400):
        rows = some_rows(rng, rng.randint(0, 5))
        assert solved(rows) == every_audit(rows)
        assert solved(rows) == by_strings(rows)


@pytest.mark.parametrize("initials", ["suax", "u", "a", "ua", "uuax", "x", "s"])
def test_long_conversations_and_ties(initials):
    rng = random.Random(2)
    for n in [20, 60, 300]:
        for _ in range(10):
            rows = some_rows(rng, n, initials)
            assert solved(rows) == by_strings(rows)


def test_colliding_hashes_are_found_out(monkeypatch):
    monkeypatch.setattr(conversation, "PRIME", 3)
    rng = random.Random(3)
    for _ in range(100):
        rows = some_rows(rng, 40, "uuax")
        assert solved(rows) == by_strings(rows)


def test_ancestors_and_order():
    rng = random.Random(4)
    audits, texts = conversation.Audits(), [""]
    for _ in range(600):
        parent, letter = rng.randrange(len(texts)), rng.choice("DK")
        if texts[parent] + letter not in texts:  # one node for each audit
            audits.add(parent, letter)
            texts.append(texts[parent] + letter)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        x, y = rng.choice("DKR"), rng.choice("DKR")
        if texts[a] + x != texts[b] + y:
            assert audits.less(a, x, b, y) == (texts[a] + x < texts[b] + y)
        depth = rng.randint(0, len(texts[a]))
        assert texts[audits.ancestor(a, depth)] == texts[a][:depth]


def expected(rows):
    """Brute force over the rows of ``conversations``: the query's result."""
    out = {}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for conv, group in itertools.groupby(order, key=lambda r: r[0]):
        left = []
        for _, turn, role, text in group:
            role, text = " " if role is None else role, " " if text is None else text
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind = zlib.crc32(name.encode()) % 20
            if kind == 1:
                text = ""
            elif kind == 2:
                text = re.sub("[.!?]", "", text)
            elif kind == 4:
                role = "user"
            left += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in left:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            faults.append("b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in left if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(left, left[1:])]
        cost, audit = by_strings([(r[1][:1], f in ("b", "d"), f == "t") for r, f in zip(left, faults)])
        lines = [f"{a}:{b}" for a, b in conversation.apply_audit([r[1:] for r in left], audit)]
        assert PATTERN.fullmatch("".join(x[:1] for x in lines))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in "bdt"),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def test_odd_rows(spark, tmp_path):
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "user", "assistant", None, "", "tool", "User"]
    texts = ["Yes.", "No", None, "", " \t", "Fine!\n", "What? \x0b", "é", "same.", "x" * 50_000 + "."]
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, turn if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts)))
        rows += rng.sample(rows, 1)
    rows += [(1000, None, "user", "a."), (1001, t := 7, "assistant", "b."), (1002, None, None, None)]
    rows += [(2000, i, ["user", "assistant"][i % 2], f"turn {i}.") for i in range(3000)]  # a third of all
    df = with_clashes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = conversation.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == expected(rows) and len(got) == len(expected(rows))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id string, turn long, role string, text string")
    assert conversation.repair(df).collect() == []


def test_other_names_and_types(spark):
    df = spark.createDataFrame([("c", 1, "assistant", "Hi."), ("c", 0, "user", "Hi")], "`my k` string, text int, k string, turn string")
    (row,) = conversation.repair(df, "my k", "text", "k", "turn").collect()
    assert (row["my k"], row.truncated, row.illegal, row.cost, row.audit, row.repaired) == ("c", 1, 0, 4, "DD", "")


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = conversation.op12_conversation_repair(spark, SF_DIR).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == expected(rows) and len(got) == len(expected(rows))
