"""Conversation structure repair by a dynamic programme over persistent audits.

A conversation's rows, in order of turn, are edited until the initials of the roles read
``(s?(ua)+)?``. The programme goes through the rows with four states (nothing yet, after
the system row, after a user row, after an assistant row) and keeps for each the cheapest
edits so far. An audit is a node linked to that of its prefix, so that all states share
their common beginnings: a row adds a few nodes and copies no text. A node holds its depth,
a rolling hash of the whole audit and a jump to an ancestor further up (the ancestors
of skew-binary numbers), by which any depth is reached in a logarithmic number of steps.
Equal costs go to the ASCII-least audit: both are brought to one depth, the jumps lead to
the longest common prefix, and the next letters decide. A prefix found by hashes is
verified: equal audits are one node; if two unlike nodes have one hash, the search is
repeated by the nodes themselves.

Spark deals the rows by conversation and sorts them within the tasks; a task streams through
them and holds one conversation at a time: its texts and about 400 bytes a row. Its result is one row,
so a conversation has to fit in one. Which rows repeat an earlier one is found before by
counts that are aggregated before they are shuffled, so a much repeated row is one row a task.

Cases: null roles and texts are one space, so such texts are blank, and such roles have to be
changed or deleted, as has an empty role. Null turns come first; rows of one turn go by
role, then text. A null conversation is one of its own, and repeated rows are duplicates. Very
long texts are read whole. A conversation without rows is none for ``repair``; the query returns it
with zeros. An empty table gives an empty result. Columns of the input may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from seqprep.llm.shared import quoted, small, small_batches, table

#: The costs of the edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What counts as white space, and the ends of a whole sentence.
WHITE, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: The pairs of initials that may stand side by side.
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Which state a row of this initial leads to, and from which ones it may.
STEPS = {"s": (SYSTEM, (START,)), "u": (USER, (START, SYSTEM, ASSISTANT)), "a": (ASSISTANT, (USER,))}
#: Modulus and base of the rolling hash.
PRIME, BASE = (1 << 61) - 1, 0x1B873593CC9E2D51
FIELDS = [
    "gaps long", "blank long", "duplicate long", "truncated long", "illegal long", "cost long", "audit string", "repaired string"
]

Best = tuple[int, int] | None


class Audits:
    """Audits as linked nodes; node 0 is the empty one."""

    def __init__(self) -> None:
        self.letter, self.parent, self.jump, self.depth, self.hash = [""], [0], [0], [0], [0]

    def add(self, parent: int, letter: str) -> int:
        up = self.jump[parent]
        # two jumps of one length in a row make a jump over both
        far = self.depth[parent] - self.depth[up] == self.depth[up] - self.depth[self.jump[up]]
        self.jump.append(self.jump[up] if far else parent)
        self.letter.append(letter)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + ord(letter)) % PRIME)
        return len(self.letter) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            up = self.jump[node]
            node = up if self.depth[up] >= depth else self.parent[node]
        return node

    def fork(self, a: int, b: int, mark: list[int] | range) -> tuple[int, int]:
        """The first nodes of one depth on the ways to ``a`` and ``b`` whose marks differ."""
        while mark[self.parent[a]] != mark[self.parent[b]]:
            if mark[self.jump[a]] != mark[self.jump[b]]:
                a, b = self.jump[a], self.jump[b]
            else:
                a, b = self.parent[a], self.parent[b]
        return a, b

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether audit ``a`` followed by ``x`` comes before ``b`` followed by ``y``."""
        if a == b:
            return x < y
        depth = min(self.depth[a], self.depth[b])
        p, q = self.ancestor(a, depth), self.ancestor(b, depth)
        if p == q:
            # one is a prefix of the other: the longer one's next letter against the new one
            after = self.letter[self.ancestor(b if p == a else a, depth + 1)]
            return x <= after if p == a else after < y
        nodes = range(len(self.letter))
        p, q = self.fork(p, q, self.hash if self.hash[p] != self.hash[q] else nodes)
        if self.parent[p] != self.parent[q]:  # unlike audits of one hash
            p, q = self.fork(p, q, nodes)
        return self.letter[p] < self.letter[q]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.parent[node]
        return "".join(reversed(out))


class Repair:
    """The cheapest edits of a conversation, row by row."""

    def __init__(self) -> None:
        self.audits = Audits()
        self.best: list[Best] = [(0, 0), None, None, None]

    def _least(self, options: list[tuple[int, int, str]]) -> Best:
        """The node of the least of some (cost, audit, next letter); a letter may be missing."""
        if not options:
            return None
        first = options[0]
        for other in options[1:]:
            if other[0] < first[0] or other[0] == first[0] and self.audits.less(other[1], other[2], first[1], first[2]):
                first = other
        cost, node, letter = first
        return cost, self.audits.add(node, letter) if letter else node

    def inserts(self) -> None:
        """Insert a user row where it is the cheapest way to that state, then an assistant row."""
        for to, sources in (STEPS["u"], STEPS["a"]):
            options = [(*self.best[to], "")] if self.best[to] else []
            options += [(self.best[s][0] + INSERT, self.best[s][1], "I") for s in sources if self.best[s]]
            self.best[to] = self._least(options)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.inserts()
        options: list[list[tuple[int, int, str]]] = [[(b[0] + DELETE, b[1], "D")] if b else [] for b in self.best]
        if not must_go:
            stay = TRUNCATED if truncated else 0
            for kind, (to, sources) in STEPS.items():
                if kind == initial or kind != "s":
                    cost, letter = (0, "K") if kind == initial else (REROLE, "R")
                    options[to] += [(self.best[s][0] + cost + stay, self.best[s][1], letter) for s in sources if self.best[s]]
        self.best = [self._least(o) for o in options]

    def end(self) -> tuple[int, str]:
        """(cost, audit) of the cheapest edits."""
        self.inserts()
        cost, node = self._least([(*self.best[s], "") for s in (START, ASSISTANT) if self.best[s]])
        return cost, self.audits.text(node)


def apply_audit(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The (role, text) rows that an audit leaves."""
    out: list[tuple[str, str]] = []
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit in "IR":
            role = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit != "D":
            out.append((role, text))
    return out


def repaired(rows: list[tuple[int | None, str, str, bool, str]]) -> tuple:
    """The result of a conversation of (turn, role, text, seen earlier, last character) rows."""
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    work, before = Repair(), None
    blank = duplicate = truncated = 0
    for row in rows:
        _, role, text, earlier, last = row
        again = earlier or row[:3] == before
        before = row[:3]
        blank += last == ""
        duplicate += last != "" and again
        cut = last != "" and not again and last not in STOPS
        truncated += cut
        work.row(role[:1], last == "" or again, cut)
    illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in pairwise(rows))
    cost, audit = work.end()
    lines = apply_audit([(r[1], r[2]) for r in rows], audit)
    return gaps, blank, duplicate, truncated, illegal, cost, audit, "\n".join(f"{a}:{b}" for a, b in lines)


def _repairing(kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["k", *(f.split()[0] for f in FIELDS)]
        key, rows, out = None, [], []

        def packed() -> pa.RecordBatch:
            columns = [pa.array(c, kind if i == 0 else None) for i, c in enumerate(zip(*out))]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            held = [batch.column(c).to_pylist() for c in ("k", "turn", "role", "text", "earlier", "last")]
            for k, *row in zip(*held):
                if rows and k != key:
                    out.append((key, *repaired(rows)))
                    rows = []
                key = k
                rows.append(tuple(row))
            if out:
                yield packed()
                out = []
        if rows:
            out.append((key, *repaired(rows)))
            yield packed()

    return run


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of each conversation."""
    held = small_batches(df).select(
        F.col(quoted(conv)).alias("k"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        *[F.coalesce(F.col(quoted(c)), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))],
    )
    rows = held.select(
        "*",
        # the last character that is no white space
        F.substring(F.rtrim("text", F.lit(WHITE)), -1, 1).alias("last"),
        F.xxhash64("k", "role", "text").alias("a"),
        F.xxhash64(F.lit(1), "k", "role", "text").alias("b"),
    )
    # the first turn of every row that a conversation repeats in another turn; nulls come first
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    again = rows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("latest"))
    again = small(again.where(F.col("first") != F.col("latest")).select("a", "b", "first"))
    marked = rows.join(again, ["a", "b"], "left").select(
        "k", "turn", "role", "text", "last", F.coalesce(place != F.col("first"), F.lit(False)).alias("earlier")
    )
    ordered = marked.repartition("k").sortWithinPartitions("k", "turn", "role", "text")
    schema = ", ".join([f"k {dict(rows.dtypes)['k']}", *FIELDS])
    return ordered.mapInArrow(_repairing(to_arrow_type(rows.schema["k"].dataType)), schema).withColumnRenamed("k", conv)


# --- query ---------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``conversations`` with the faults that the query plants, by a checksum of each row's id."""
    plain = rows.select(
        "conv_id", "turn", *[F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    )
    written: list[Column] = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    sort = F.crc32(F.concat(written[0], F.lit(":"), written[1])) % 20
    marked = plain.withColumn("sort", sort).where("sort <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("sort") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("sort") == 1, F.lit(""))
        .when(F.col("sort") == 2, F.translate("text", STOPS, ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("sort") == 3, 2).otherwise(1))).alias("copy"),
    )
    return marked.drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of ``conversations`` after damage, with its cheapest repair."""
    rows = table(spark, sf_dir, "conversations")
    fixed = repair(damaged(rows))
    every = rows.select(F.col("conv_id").alias("conv")).distinct()
    joined = every.join(fixed, F.col("conv").eqNullSafe(fixed["conv_id"]), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        F.col("conv").alias("conv_id"),
        *zero,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce("repaired", F.lit("")), 256).alias("repaired_sha256"),
    )
