"""Repairs against a search over all edits, and every conversation of a table."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from conftest import SF
from millrace.llm import conversations, queries


def plain_repair(rows):
    """Least (cost, audit, repaired) over all edits, by Dijkstra over (row, end of the repaired part)."""
    queue, done = [(0, "", 0, 0, ())], set()
    while queue:
        cost, audit, at, state, made = heapq.heappop(queue)
        if at == len(rows) and state in (0, 3):
            return cost, audit, made
        if (at, state) in done:
            continue
        done.add((at, state))
        after = 3 if state == 2 else 2
        name = "user" if after == 2 else "assistant"
        push = lambda *item: heapq.heappush(queue, item)
        push(cost + 3, audit + "I", at, after, made + ((name, ""),))
        if at < len(rows):
            role, text, fault = rows[at]
            push(cost + 4, audit + "D", at + 1, state, made)
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == "s" and state == 0:
                    push(cost + more, audit + "K", at + 1, 1, made + ((role, text),))
                if role[:1] == name[0]:
                    push(cost + more, audit + "K", at + 1, after, made + ((role, text),))
                push(cost + more + 3, audit + "R", at + 1, after, made + ((name, text),))


def plain_report(rows):
    """rows: (turn, role, text) of one conversation after damage, in order."""
    seen, marked, counts = set(), [], collections.Counter()
    for _, role, text in rows:
        visible = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not visible else "duplicate" if (role, text) in seen else "" if visible[-1] in ".!?" else "truncated"
        seen.add((role, text))
        counts[fault] += 1
        marked.append((role, text, fault))
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, made = plain_repair(marked)
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if code:
            text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
            out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def plain_query(rows):
    of = collections.defaultdict(list, {conv: [] for conv, *_ in rows})
    for conv, *row in damaged(rows):
        of[conv].append(row)
    return {
        conv: plain_report(sorted(some, key=lambda r: (r[0] is not None, r[0]))) for conv, some in of.items()
    }


def test_edits_are_the_cheapest_and_least():
    random.seed(41)
    for _ in range(3000):
        rows = [(random.choice("suax"), random.random() < 0.2, random.random() < 0.15) for _ in range(random.randint(0, 11))]
        exact = plain_repair([(r, "", "blank" if gone else "truncated" if cut else "") for r, cut, gone in rows])
        assert conversations.repair_roles(rows) == exact[:2]


def test_blocks_agree_with_single_steps():
    known = conversations.RepairTables(3)
    random.seed(42)
    for vector in range(len(known.vectors)):
        kinds = random.choices(range(9), k=3)
        at, paid = vector, 0
        for kind in reversed(kinds):
            paid += known.price[at][kind]
            at = known.step[at][kind]
        code = kinds[0] * 81 + kinds[1] * 9 + kinds[2]
        assert (known.block_step[vector][code], known.block_price[vector][code]) == (at, paid)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, seq long")


def many(seed):
    random.seed(seed)
    rows = []
    for conv in range(60):
        for turn in range(random.randint(1, 14)):
            role = random.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = random.choice([None, "", " \n", "Yes.", "no", "what? \x0b", f"word {turn}.", "end!é", " "])
            rows.append((conv, random.choice([turn, turn + 1000]), role, text))
    return list({(r[0], r[1]): r for r in rows}.values())


@pytest.mark.parametrize("bits", [14, 1])
def test_rows(spark, monkeypatch, tmp_path, bits):
    monkeypatch.setattr(conversations, "CHUNK_BITS", bits)
    rows = many(43) + [(None, 1, "user", "Null conversation."), (None, 2, "assistant", None), (70, None, "user", "a."), (70, 3, "assistant", "b.")]
    rows += [(80, i, ("user", "assistant", "assistant")[i % 3], f"turn {i}" + "." * (i % 5 > 0)) for i in range(300)]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op12_conversation_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == plain_query(rows)


def test_repeated_rows(spark):
    rows = [(1, 0, "user", "Hello."), (1, 1, "assistant", "Yes.")] * 3 + [(2, None, "user", " ")] * 4
    edits, repaired = conversations.repair(table(spark, rows))
    found = {r.conv: r for r in conversations.report(edits).collect()}
    assert tuple(found[1])[1:] == (0, 0, 4, 0, 4, 16, "KDDKDD") and tuple(found[2])[1:] == (0, 4, 0, 0, 3, 16, "DDDD")
    assert [(r.role, r.text) for r in repaired.orderBy("seq", "place").collect()] == [("user", "Hello."), ("assistant", "Yes.")]
    edits, repaired = conversations.repair(table(spark, []))
    assert conversations.report(edits).count() == repaired.count() == 0


def test_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    found = queries.op12_conversation_repair(spark, SF).collect()
    assert {r.conv_id: tuple(r)[1:] for r in found} == plain_query(rows) and len(found) == len({r[0] for r in rows})
