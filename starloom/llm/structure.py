"""Repair of conversations' role structure on a suffix-shared automaton (op13).

A conversation is right if its role initials follow ``(s?(ua)+)?``. Its rows are first reduced to a signature, one letter a row: the
role's initial as far as the grammar knows it, and the row's first fault. Signatures are short and few, so each distinct one is
solved once for all conversations that have it:

1. A narrow pass gives every conversation its signature and counts; of the text only a hash and two flags are shuffled.
2. Distinct signatures are range-partitioned by their reversed letters, so those with common endings meet in a task. The task
   minimises them from the end into a directed acyclic word graph: equal suffixes of all signatures are one node. For
   each node and grammar state it holds, computed once, the cost-to-go and the first edit of the best audit suffix.
   At one node and state no two edits share a letter, so the least audit is found letter by letter and suffixes need no copies.
3. Walking the graph gives each signature its cost and audit, which go back to the conversations.
4. Where texts are asked for, the rows are streamed in order behind their conversation's audit and repaired one by one.

Edits and costs: Keep 0, Rerole to user or assistant 3, Delete 4 (required for blank and duplicate rows), Insert an empty user or
assistant row 3; a truncated row that stays costs 3 more.

Defined cases: null roles and texts are one space, also a null id or turn in the text that is hashed for the damage, and rows without
conv_id are one conversation; equal turns are ordered by role, then by MD5; repeated rows are rows of their own (the later ones duplicates); a very
long text is read whole and held once; an empty table gives an empty result; other columns are not read, so they may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import cut_lineage, load

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Grammar states: nothing yet, after s, after u, after a; those in which a conversation may end.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (START, AFTER_A)
_USER_NEXT = {START: True, AFTER_S: True, AFTER_U: False, AFTER_A: True}
_IMPOSSIBLE = 1 << 60
#: Nodes of a task's graph; beyond that it starts a new one (suffixes are then shared within each).
MOST_NODES = 2_000_000
SIGNATURES_PER_TASK = 100_000

#: Letters of a signature: role initial s, u, a or another (x); upper case if truncated; d if the row must go.
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


class SuffixGraph:
    """Nodes are suffixes of signatures; node 0 is the empty one. ``cost`` and ``edit`` hold four entries a node."""

    def __init__(self):
        self.index: dict[tuple[int, str], int] = {}
        self.follow: list[int] = [0]
        self.cost: list[int] = []
        self.edit: list[str] = []
        self._solve([0 if q in ENDS else _IMPOSSIBLE for q in range(4)], [""] * 4)

    def node(self, signature: str) -> int:
        """The node of a signature: its letters are added from the end, as far as they are new."""
        at = 0
        for letter in reversed(signature):
            known = self.index.get((at, letter))
            at = self._add(letter, at) if known is None else known
        return at

    def _add(self, letter: str, rest: int) -> int:
        base = 4 * rest
        costs, edits = [], []
        for state in range(4):
            choices = [(self.cost[base + state] + DELETE, "D")]
            if letter != "d":
                more = TRUNCATED if letter.isupper() else 0
                role, user = letter.lower(), _USER_NEXT[state]
                if role == "s" and state == START:
                    choices.append((self.cost[base + AFTER_S] + KEEP + more, "K"))
                to = AFTER_U if user else AFTER_A
                if role == ("u" if user else "a"):
                    choices.append((self.cost[base + to] + KEEP + more, "K"))
                else:
                    choices.append((self.cost[base + to] + REROLE + more, "R"))
            best = min(choices)
            costs.append(best[0])
            edits.append(best[1])
        new = len(self.follow)
        self.follow.append(rest)
        self.index[rest, letter] = new
        self._solve(costs, edits)
        return new

    def _solve(self, costs: list[int], edits: list[str]) -> None:
        """Let rows be inserted before the node's first letter: at most three in a row, as a fourth returns to a state."""
        for _ in range(3):
            before = list(costs)
            for state in range(4):
                option = (before[AFTER_U if _USER_NEXT[state] else AFTER_A] + INSERT, "I")
                if option < (costs[state], edits[state]):
                    costs[state], edits[state] = option
        self.cost += costs
        self.edit += edits

    def audit(self, signature: str) -> tuple[int, str]:
        """Least cost and, of its audits, the ASCII-least."""
        at, state, out = self.node(signature), START, []
        cost, place = self.cost[4 * at], 0
        while edit := self.edit[4 * at + state]:
            out.append(edit)
            if edit == "I":
                state = AFTER_U if _USER_NEXT[state] else AFTER_A
                continue
            if edit == "K" and signature[place] in "sS":
                state = AFTER_S
            elif edit != "D":
                state = AFTER_U if _USER_NEXT[state] else AFTER_A
            at, place = self.follow[at], place + 1
        return cost, "".join(out)


def repaired_rows(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that an audit leaves or makes of ``rows``."""
    state = START
    for edit in audit:
        user = _USER_NEXT[state]
        if edit == "I":
            yield ("user" if user else "assistant", "")
        else:
            role, text = next(rows)
            if edit == "D":
                continue
            if edit == "R":
                role = "user" if user else "assistant"
            yield role, text
            if edit == "K" and role[:1] == "s":
                state = AFTER_S
                continue
        state = AFTER_U if user else AFTER_A


# --- on Spark -------------------------------------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the damage by crc32 of ``conv_id:turn``: 0 drops a row, 1 empties its text, 2 removes its full
    stops, 3 repeats it, 4 makes it the user's."""
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"]).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced["role"].alias("role"),
                                spaced["text"].alias("text"), kind.alias("kind")).where(F.col("kind") != 0)
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _last_letter(text: Column) -> Column:
    """The last character of a text that is no blank, or the empty string."""
    return F.right(F.rtrim(text, F.lit(BLANK)), F.lit(1))


def _text_id() -> Column:
    """What makes rows duplicates, and their order at one turn and role."""
    return F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))


_SIGNED = ("conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long")


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


class _Signing:
    """A conversation's signature and counts, row by row in order."""

    def __init__(self, conv):
        self.conv, self.letters, self.seen, self.last = conv, [], set(), None
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = None

    def add(self, turn, initial: str, text_id: bytes, fault: str) -> None:
        if turn is not None:
            if turn != self.most:
                self.turns += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        again = text_id in self.seen
        self.seen.add(text_id)
        letter = initial if initial in ("s", "u", "a") else "x"
        if fault == "b":
            self.blank += 1
            letter = "d"
        elif again:
            self.duplicate += 1
            letter = "d"
        elif fault == "t":
            self.truncated += 1
            letter = letter.upper()
        self.letters.append(letter)

    def row(self) -> tuple:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return (self.conv, "".join(self.letters), gaps, self.blank, self.duplicate, self.truncated, self.illegal)


def signatures(rows: DataFrame) -> DataFrame:
    """One row per conversation that has rows: its signature and the counts of its faults. Rows come sorted, so a task holds 16
    bytes and a letter of each row of one conversation."""
    last = _last_letter(F.col("text"))
    fault = F.when(last == "", "b").when(last.isin(".", "!", "?"), "").otherwise("t")
    narrow = rows.select("conv_id", "turn", "role", F.left("role", F.lit(1)).alias("initial"), _text_id().alias("text_id"), fault.alias("fault"))

    def run(batches):
        state = None
        for batch in batches:
            out = []
            for conv, turn, initial, key, bad in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "turn", "initial", "text_id", "fault")), strict=True):
                if state is None or conv != state.conv:
                    if state:
                        out.append(state.row())
                    state = _Signing(conv)
                state.add(turn, initial, key, bad)
            if out:
                yield _table(out, _SIGNED)
        if state:
            yield _table([state.row()], _SIGNED)

    ordered = narrow.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text_id")
    return ordered.select("conv_id", "turn", "initial", "text_id", "fault").mapInArrow(run, _SIGNED)


_AUDITS = "signature string, cost long, audit string"


def audits(signed: DataFrame, per_task: int = SIGNATURES_PER_TASK) -> DataFrame:
    """Cost and audit of each distinct signature."""
    spark = signed.sparkSession
    distinct = signed.groupBy("signature").count().select("signature")

    def run(batches):
        graph = SuffixGraph()
        for batch in batches:
            out = []
            for signature in batch.column(0).to_pylist():
                if len(graph.follow) > MOST_NODES:
                    graph = SuffixGraph()
                out.append((signature, *graph.audit(signature)))
            yield _table(out, _AUDITS)

    distinct = cut_lineage(distinct)
    n = distinct.count()
    tasks = max(1, -(-n // per_task), min(spark.sparkContext.defaultParallelism, n // 1_000))
    by_ending = distinct.withColumn("ending", F.reverse("signature")).repartitionByRange(tasks, "ending").sortWithinPartitions("ending")
    return by_ending.select("signature").mapInArrow(run, _AUDITS)


def repair_hashes(rows: DataFrame, audited: DataFrame) -> DataFrame:
    """conv_id and SHA-256 of the repaired ``role:text`` rows, newline-joined. The audit of a conversation comes before its rows."""
    first = audited.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), "audit")
    both = first.unionByName(rows.withColumn("audit", F.lit(None).cast("string")))
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "role", _text_id())
    schema = "conv_id long, repaired_sha256 string"

    def run(batches):
        def conversation(conv, audit, rows):
            digest, between = hashlib.sha256(), b""
            for role, text in repaired_rows(audit, rows):
                digest.update(between + f"{role}:".encode())
                digest.update(text.encode())
                between = b"\n"
            for _ in rows:      # rows that the audit deletes at the end are read, too
                pass
            return conv, digest.hexdigest()

        stream = _Stream(batches)
        out = []
        while stream.here is not None:
            conv, _, _, audit = stream.here
            stream.step()
            out.append(conversation(conv, audit, stream.rows_of(conv)))
            if len(out) == 10_000:
                yield _table(out, schema)
                out = []
        yield _table(out, schema)

    return ordered.select("conv_id", "role", "text", "audit").mapInArrow(run, schema)


class _Stream:
    """Rows of Arrow batches one by one; a batch is turned into Python values in slices."""

    def __init__(self, batches: Iterator[pa.RecordBatch], at_once: int = 256):
        self._rows = (row for batch in batches for start in range(0, batch.num_rows, at_once)
                      for row in zip(*(c.to_pylist() for c in batch.slice(start, at_once).columns), strict=True))
        self.here = None
        self.step()

    def step(self) -> None:
        self.here = next(self._rows, None)

    def rows_of(self, conv) -> Iterator[tuple[str, str]]:
        while self.here is not None and self.here[0] == conv and self.here[3] is None:
            role, text = self.here[1:3]
            self.step()
            yield role, text


def repair_structure(conversations: DataFrame, rows: DataFrame | None = None, per_task: int = SIGNATURES_PER_TASK) -> DataFrame:
    """One row per conv_id of ``conversations``: the faults of its ``rows`` (as they are, if none are given), the least cost and
    audit of a repair, and the hash of the repaired rows."""
    if rows is None:
        space = F.lit(" ")
        rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                    F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    signed = cut_lineage(signatures(rows))
    solved = signed.join(audits(signed, per_task), "signature")
    solved = cut_lineage(solved)
    hashes = repair_hashes(rows, solved.select("conv_id", "audit"))
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv")).distinct()
    told = solved.alias("s").join(hashes.alias("h"), F.col("s.conv_id").eqNullSafe(F.col("h.conv_id"))).select("s.*", "repaired_sha256")
    zero = F.lit(0).cast("long")
    return ids.join(told, F.col("conv").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("conv").alias("conv_id"), *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def op13_structure_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = load(spark, sf_dir, "conversations")
    return repair_structure(conversations, damaged(conversations))


#: The least audit over all edits is a shortest path with ties by text: tests hold it against an exhaustive search instead.
SQL = None
