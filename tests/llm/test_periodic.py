"""Periodic runs against a scan of all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import SF
from llm.test_operators import ODD, frame
from millrace.llm import periodic, queries


def plain_runs(symbols, least=6, periods=4):
    """Stretches of equal neighbours at each distance, without those of a smaller period."""
    n, found = len(symbols), []
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and symbols[j] == symbols[j + q]:
                j += 1
            end = j + q
            if end - i >= max(least, periods * q) and not any(
                all(symbols[x] == symbols[x + p] for x in range(i, end - p)) for p in range(1, q)
            ):
                found.append((i, end - i, q))
            i = j + 1
    return sorted(found)


def plain_row(doc, text, damaged=True):
    cut = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(cut)
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if damaged and doc is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        cut = [cut[i] if i < a else cut[a + (i - a) % p] for i in range(n)]
    found = plain_runs(cut)
    gone = {x for s, length, q in found for x in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda shown: hashlib.sha256(shown.encode()).hexdigest()
    return (
        doc, len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(cut) if i not in gone)),
    )


@pytest.mark.parametrize("least, periods", [(6, 4), (2, 2)])
def test_runs_of_small_alphabets(least, periods):
    random.seed(21)
    for _ in range(600):
        cut = random.choices(range(random.choice([1, 2, 3])), k=random.randint(0, 50))
        root = random.choices(range(2), k=random.randint(1, 7))
        cut += (root * 9)[: random.randint(0, 8 * len(root))] + random.choices(range(3), k=random.randint(0, 9))
        found = periodic.runs_of(np.array(cut, np.int64), least, periods)
        assert list(map(tuple, found.tolist())) == plain_runs(cut, least, periods)


def test_common_extensions():
    random.seed(22)
    cut = random.choices(range(2), k=200)
    tree = periodic.SuffixTree(cut)
    a, b = np.array([(i, j) for i in range(201) for j in range(i)]).T
    exact = [next((k for k in range(200) if max(i, j) + k >= 200 or cut[i + k] != cut[j + k]), 200) for i, j in zip(a, b)]
    assert tree.common(a, b).tolist() == exact
    assert [i for _, i in sorted((cut[i:], i) for i in range(201))] == np.argsort(tree.rank).tolist()


def test_rows(spark):
    random.seed(23)
    word = lambda: random.choice("abcdefghij")
    rows = list(ODD)
    for i in range(10, 60):
        text = [word() for _ in range(random.randint(0, 40))]
        for _ in range(3):
            root = [word() for _ in range(random.randint(1, 6))]
            text += (root * 8)[: random.randint(1, 8 * len(root))] + [word() for _ in range(random.randint(0, 20))]
        rows.append((i, random.choice(["\n", "  ", "\x1c \t"]).join(text)))
    found = periodic.periodic_runs(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.id: r for r in found}
    for i, text in rows:
        cut = (text or "").encode().split()
        exact = plain_runs(cut) if i != 7 else [(0, 9000, 1)]
        assert list(map(tuple, by_id[i].runs)) == exact
    assert by_id[7].collapsed == "word" and by_id[1].collapsed == "" and by_id[4].collapsed == "one two"
    assert periodic.periodic_runs(frame(spark, [])).count() == 0


def test_query(spark):
    rows = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    found = queries.op11_periodic_runs(spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(plain_row(r["doc_id"], r["text"]) for r in rows)
    assert sum(r.n_runs > 0 for r in found) > 5


def test_odd_rows_of_the_query(spark, tmp_path):
    odd = [r for r in ODD if r[0] != 7] + [(i, "to be or not to be " * 5) for i in range(30)]
    frame(spark, odd).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(plain_row(*r)) for r in odd)
