import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from starloom.llm import structure
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
BLANKS = " \t\n\x0b\x0c\r"
GRAMMAR = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        spaced = [" " if v is None else str(v) for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{spaced[0]}:{spaced[1]}".encode()) % 20
        role, text = spaced[2:]
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def best_audit(rows):
    """Least (cost, audit) from the beginning: all pairs of a place and a state, with whole audits as strings."""
    best = {0: (0, "", [])}
    step = {0: "u", 1: "u", 2: "a", 3: "u"}
    into = {"u": 2, "a": 3}

    def better(table, state, cost, audit, made):
        if state not in table or (cost, audit) < table[state][:2]:
            table[state] = (cost, audit, made)

    def inserted(table):
        for _ in range(4):
            for q, (c, a, m) in list(table.items()):
                better(table, into[step[q]], c + 3, a + "I", [*m, ({"u": "user", "a": "assistant"}[step[q]], "")])
        return table

    # Prefixes of equal cost may not be cut by text, so the search runs over (cost, audit) sets of equal cost.
    sets = {q: [v] for q, v in inserted(best).items()}
    for role, text, fault in rows:
        table = defaultdict(list)
        for q, options in sets.items():
            for c, a, m in options:
                table[q].append((c + 4, a + "D", m))
                if fault in ("b", "d"):
                    continue
                more = 3 if fault == "t" else 0
                if role[:1] == "s" and q == 0:
                    table[1].append((c + more, a + "K", [*m, (role, text)]))
                want = step[q]
                if role[:1] == want:
                    table[into[want]].append((c + more, a + "K", [*m, (role, text)]))
                else:
                    table[into[want]].append((c + 3 + more, a + "R", [*m, ({"u": "user", "a": "assistant"}[want], text)]))
        for _ in range(4):
            for q in list(table):
                for c, a, m in list(table[q]):
                    if not a.endswith("IIII"):
                        table[into[step[q]]].append((c + 3, a + "I", [*m, ({"u": "user", "a": "assistant"}[step[q]], "")]))
            for q in table:
                least = min(c for c, _, _ in table[q])
                table[q] = list({(c, a): (c, a, m) for c, a, m in table[q] if c == least}.values())
        sets = dict(table)
    return min((v for q in (0, 3) for v in sets.get(q, [])), key=lambda v: v[:2])


def plain(originals, rows=None):
    rows = damage(originals) if rows is None else rows
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        by_conv[conv].append(((turn is not None, turn or 0, role, key), turn, role, text))
    out = []
    for conv in {r[0] for r in originals}:
        seen, faults, marked = set(), defaultdict(int), []
        ordered = sorted(by_conv[conv], key=lambda r: r[0])
        for _, _, role, text in ordered:
            kept = text.rstrip(BLANKS)
            fault = "b" if not kept else "d" if (role, text) in seen else "t" if kept[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        turns = [t for _, t, _, _ in ordered if t is not None]
        initials = [r[:1] for _, _, r, _ in ordered]
        cost, audit, made = best_audit(marked)
        assert GRAMMAR.fullmatch("".join(r[:1] for r, _ in made))
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["b"], faults["d"], faults["t"],
                    sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    return sorted(out, key=str)


def exhaustive(signature):
    """Least (cost, audit) over all edits with up to three inserted rows in each gap."""
    gaps = ["", "u", "a", "ua", "au", "uau", "aua"]
    found = []
    for edits in itertools.product(*[["K", "u", "a", "D"] for _ in signature]):
        cost, roles, letters = 0, [], []
        for e, x in zip(edits, signature, strict=True):
            if x == "d" and e != "D":
                break
            cost += 4 if e == "D" else (3 if x.isupper() else 0) + (0 if e == "K" else 3)
            letters.append("D" if e == "D" else "K" if e == "K" else "R")
            roles.append("" if e == "D" else x.lower() if e == "K" else e)
        else:
            for ins in itertools.product(gaps, repeat=len(signature) + 1):
                made = ins[0] + "".join(r + i for r, i in zip(roles, ins[1:], strict=True))
                if GRAMMAR.fullmatch(made):
                    audit = "I" * len(ins[0]) + "".join(x + "I" * len(i) for x, i in zip(letters, ins[1:], strict=True))
                    found.append((cost + 3 * sum(map(len, ins)), audit))
    return min(found)


def test_graph_against_every_edit():
    graph = structure.SuffixGraph()
    for n in range(4):
        for signature in itertools.product("suaxUAd", repeat=n):
            signature = "".join(signature)
            if n < 3 or random.Random(signature).random() < 0.05:
                assert graph.audit(signature) == exhaustive(signature), signature


def test_graph_shares_suffixes():
    graph = structure.SuffixGraph()
    graph.audit("suauaua")
    nodes = len(graph.follow)
    graph.audit("dddsuauaua")
    assert len(graph.follow) == nodes + 3
    graph.audit("uaua")
    assert len(graph.follow) == nodes + 3
    long = "suaUAxd" * 5_000
    cost, audit = graph.audit(long)
    assert len(audit.replace("I", "")) == len(long) and cost > 0


def run(spark, rows, damaged=True, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = structure.repair_structure(df, structure.damaged(df) if damaged else None, **options)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()), key=str)


def made(seed, n):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-100, 2000), n):
        for t in sorted(r.sample(range(12), r.choice([1, 2, 3, 5, 8, 11]))):
            rows.append((c, t if r.random() > 0.05 else None, r.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""]),
                         r.choice(["Yes.", "No!", "Why? ", "broken", "", None, "\n", "a.b", f"text {r.random()}.\n", "é?"])))
    return rows


@pytest.mark.parametrize("per_task", [3, 100_000])
def test_against_plain(spark, per_task):
    rows = made(per_task, 150)
    assert run(spark, rows, per_task=per_task) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x."), (None, None, "assistant", "y."), (1, None, None, None), (1, None, None, None), (2, 5, "user", "Hi."), (2, 5, "user", "Hi."),
            (2, 5, "assistant", "Ho."), (3, 1, "user", "long " * 50_000 + "."), (3, 2, "assistant", "end\x0b"), (-4, 9, "System", "x.")]
    dropped = next(c for c in range(100, 10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "gone."))
    got = run(spark, rows)
    assert got == plain(rows)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert run(spark, rows, damaged=False) == plain(rows, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
    assert run(spark, []) == []
    clash = spark.createDataFrame([(1, 0, "user", "a.", 1, "b")], SCHEMA + ", cost int, audit string")
    assert structure.repair_structure(clash).collect()[0].audit == "KI"


def test_long_conversation_and_hot_id(spark):
    r = random.Random(4)
    rows = [(5, t, r.choice(["user", "assistant", "system"]), f"{t % 1500}.") for t in range(4_000)] + [(6, 0, "user", "a.")]
    got = {g[0]: g for g in run(spark, rows, damaged=False)}
    assert got[5][3] > 0 and len(got[5][7].replace("I", "")) == 4_000 and got[6][7] == "KI"


def test_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_SMALL}/conversations.parquet'").fetchall()
    got = sorted(map(tuple, structure.op13_structure_dawg(spark, SF_SMALL).select(COLUMNS).collect()), key=str)
    assert got == plain(rows)
