"""Cheapest repair of conversations whose roles are out of order, by Four-Russians block tables.

A repaired conversation is empty, or an optional system row and then pairs of user and assistant. Rows
are kept, given another role or deleted, and empty rows inserted, each at a price; blank rows and rows
seen before must go. Four states say what the repaired rows so far end with: nothing, system, user or
assistant. The costs of repairing the rest, one per state, are a vector; without its minimum it is one
of a few dozen. So a row is a step from vector to vector, and a table over all blocks of ``BLOCK`` row
kinds takes that many rows at one look-up. Rows are read from the end; only the vectors at block ends
are kept. The edits are traced from the start: a block is expanded backward from its end once more,
and of the edits that keep the least cost the one of the smallest letter is taken, which gives the
least audit of all cheapest ones.

Rows are put in order by ranges, so a conversation of any length lies in many tasks, in chunks of at
most ``CHUNK`` rows. A conversation of more than one chunk is settled between chunks first: a chunk's
costs from state to state are a four-by-four table, and its end states follow from its start states.
Texts stay out of all this: rows go by digests until the repaired rows are made.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.work import column, partitions, stored

#: Rows that one look-up takes; bits of the rows' numbers inside a chunk.
BLOCK, CHUNK_BITS = 4, 14
#: Prices of edits, and of a kept row that breaks off.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
_FAR = 1 << 50
#: State after a row of the role that comes next; states: 0 nothing, 1 system, 2 user, 3 assistant.
_AFTER = (2, 2, 3, 2)
#: Row kinds: initial (s, u, a, other) and whether the row breaks off; then those that must go.
_MUST_GO = 8
_END = (0, 2 * INSERT, INSERT, 0)
_ROLES = "-sua"
#: Adjacent initials (numbers of s, u, a) that are in order.
_LEGAL = {(0, 1), (1, 2), (2, 1)}


def _uses(kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, price, state after) of each edit that takes a row, by letter."""
    yield "D", DELETE, state
    if kind == _MUST_GO:
        return
    initial, price = kind >> 1, TRUNCATED * (kind & 1)
    if (initial == 0 and state == 0) or (initial in (1, 2) and _AFTER[state] == initial + 1):
        yield "K", price, initial + 1
    yield "R", price + REROLE, _AFTER[state]


class RepairTables:
    """Vectors and their steps. ``vectors[0]`` is that of the end; 1 to 4 are free in one state only."""

    def __init__(self, block: int = BLOCK):
        self.block, kinds = block, _MUST_GO + 1
        self.vectors = [_END, *(tuple(0 if s == t else _FAR for s in range(4)) for t in range(4))]
        number = {vector: i for i, vector in enumerate(self.vectors)}
        step, price = [], []
        for vector in self.vectors:  # grows while it is read
            step.append([])
            price.append([])
            for kind in range(kinds):
                costs = self._costs(vector, kind)
                least = min(costs)
                rest = tuple(c - least if c < _FAR else _FAR for c in costs)
                if rest not in number:
                    number[rest] = len(self.vectors)
                    self.vectors.append(rest)
                step[-1].append(number[rest])
                price[-1].append(least)
        self.step, self.price = step, price
        one, paid = np.array(step), np.array(price)
        many, all_paid = one, paid
        for _ in range(block - 1):  # a block's code has its first row as the highest digit
            first = one[many]  # vector, block, kind of the row before it
            all_paid = (all_paid[:, :, None] + paid[many]).transpose(0, 2, 1).reshape(len(one), -1)
            many = first.transpose(0, 2, 1).reshape(len(one), -1)
        self.block_step, self.block_price = many.tolist(), all_paid.tolist()
        self._traced: dict[tuple[int, int, int], tuple[str, str, int, int]] = {}

    @staticmethod
    def _costs(vector: tuple, kind: int) -> list[int]:
        taken = [min(price + vector[after] for _, price, after in _uses(kind, state)) for state in range(4)]
        user, assistant = min(taken[2], INSERT + taken[3]), min(taken[3], INSERT + taken[2])
        return [min(c, _FAR) for c in (min(taken[0], INSERT + user), min(taken[1], INSERT + user), user, assistant)]

    def trace(self, vector: int, kind: int, state: int) -> tuple[str, str, int, int]:
        """Letters, roles, state after and price of the edits at a row, ``vector`` being that of the rest."""
        key = vector, kind, state
        if key not in self._traced:
            rest, costs = self.vectors[vector], self._costs(self.vectors[vector], kind)
            letters, roles, paid, done = "", "", 0, False
            while not done:
                found = [(letter, price, after) for letter, price, after in _uses(kind, state) if price + rest[after] == costs[state]]
                if INSERT + costs[_AFTER[state]] == costs[state]:
                    found.append(("I", INSERT, _AFTER[state]))
                letter, price, state = min(found)
                letters += letter
                roles += "-" if letter == "D" else _ROLES[state]
                paid, done = paid + price, letter != "I"
            self._traced[key] = letters, roles, state, paid
        return self._traced[key]

    def ends(self, kinds: list[int], last: int) -> tuple[list[int], int]:
        """Vectors where blocks begin and where the last one ends, first row first, and what was paid.

        The first block may be short.
        """
        at, vector, paid, size = len(kinds), last, 0, self.block
        found = [vector]
        while at >= size:
            code = 0
            for kind in kinds[at - size : at]:
                code = code * (_MUST_GO + 1) + kind
            paid += self.block_price[vector][code]
            vector = self.block_step[vector][code]
            found.append(vector)
            at -= size
        if at:
            for kind in reversed(kinds[:at]):
                paid += self.price[vector][kind]
                vector = self.step[vector][kind]
            found.append(vector)
        return found[::-1], paid

    def edits(self, kinds: list[int], last: int, state: int) -> tuple[list[tuple[str, str, int]], int]:
        """(letters, roles, price) of each row from ``state`` on, and the state after them."""
        ends, _ = self.ends(kinds, last)
        out, begin = [], 0
        stop = len(kinds) % self.block or min(self.block, len(kinds))
        for vector in ends[1:]:
            inner = [vector]
            for kind in reversed(kinds[begin + 1 : stop]):
                inner.append(self.step[inner[-1]][kind])
            for kind, rest in zip(kinds[begin:stop], reversed(inner)):
                letters, roles, state, paid = self.trace(rest, kind, state)
                out.append((letters, roles, paid))
            begin, stop = stop, stop + self.block
        return out, state


@lru_cache
def tables(block: int = BLOCK) -> RepairTables:
    return RepairTables(block)


def _tail(state: int) -> tuple[str, str, int]:
    """Rows inserted after the last one."""
    many = _END[state] // INSERT
    return "I" * many, "ua"[2 - many :] if many else "", INSERT * many


def repair_roles(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Cost and audit of a conversation of (initial, breaks off, must go) rows, all at once."""
    kinds = [_MUST_GO if gone else 2 * ("sua".find(initial) % 4) + cut for initial, cut, gone in rows]
    found, state = tables().edits(kinds, 0, 0)
    found.append(_tail(state))
    return sum(paid for _, _, paid in found), "".join(letters for letters, _, _ in found)


# A row's mark: its initial's number times four, and its fault.
_TRUNCATED, _BLANK, _DUPLICATE = 1, 2, 3


def _kind(mark: int) -> int:
    return _MUST_GO if mark & 3 >= _BLANK else mark >> 2 << 1 | mark & 3


def _chunks(batches) -> Iterator[dict[str, list]]:
    """The sorted rows of each (conv, chunk); a chunk's rows, whose number is bounded, are put together."""
    kept: dict[str, list] | None = None
    for batch in batches:
        rows = batch.to_pydict()
        keys = list(zip(rows["conv"], rows["chunk"]))
        begin = 0
        for _, some in itertools.groupby(keys):
            end = begin + len(list(some))
            part = {name: values[begin:end] for name, values in rows.items()}
            if kept and (kept["conv"][0], kept["chunk"][0]) == keys[begin]:
                for name, values in part.items():
                    kept[name] += values
            else:
                if kept:
                    yield kept
                kept = part
            begin = end
    if kept:
        yield kept


def _kinds(chunk: dict[str, list]) -> list[int]:
    """Row kinds of a chunk; further copies of a row must go."""
    out = []
    for mark, copies in zip(chunk["mark"], chunk["copies"]):
        out.append(_kind(mark))
        out.extend([_MUST_GO] * (copies - 1))
    return out


def _pass(rows: DataFrame, made, schema: str) -> DataFrame:
    """``made(chunk)`` gives the rows for each chunk; chunks are dealt over all tasks."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        out = []
        for chunk in _chunks(batches):
            out.extend(made(chunk))
            if len(out) > 1 << 14:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in out], arrow)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    arrow = pa.schema([(name, kinds[part.split()[1]]) for name, part in zip(names, schema.split(", "))])
    dealt = rows.repartition(partitions(rows.sparkSession), "conv", "chunk").sortWithinPartitions("conv", "chunk", "seq")
    return dealt.mapInArrow(run, schema)


def _between_chunks(rows: DataFrame) -> DataFrame | None:
    """(conv, chunk, rest, state, before, last) of the chunks of conversations that have several."""
    several = rows.groupBy("conv").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("low < high")
    several = stored(several, "long-conversations")
    if several.isEmpty():
        return None
    long = rows.alias("r").join(several.alias("s"), F.expr("r.conv <=> s.conv"), "left_semi")

    def costs(chunk):
        kinds, known, table = _kinds(chunk), tables(), []
        for state in range(4):
            ends, paid = known.ends(kinds, state + 1)
            table += [paid + c if c < _FAR else _FAR for c in known.vectors[ends[0]]]
        yield chunk["conv"][0], chunk["chunk"][0], table, chunk["mark"][-1] >> 2

    def backward(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("chunk").reset_index(drop=True)
        known, rest, out = tables(), np.array(_END), []
        for table in reversed(found["costs"].tolist()):
            out.append(known.vectors.index(tuple((rest - rest.min()).tolist())))
            rest = (np.array(table).reshape(4, 4).T + rest).min(axis=1)
        found["rest"] = out[::-1]
        found["before"] = found["initial"].shift(1)
        found["last"] = found.index == len(found) - 1
        return found[["conv", "chunk", "rest", "before", "last"]]

    def forward(found: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("chunk").reset_index(drop=True)
        state, out = 0, []
        for after in found["after"]:
            out.append(state)
            state = after[state]
        found["state"] = out
        return found[["conv", "chunk", "state"]]

    def follow(chunk):
        kinds, known = _kinds(chunk), tables()
        yield chunk["conv"][0], chunk["chunk"][0], [known.edits(kinds, chunk["rest"][0], state)[1] for state in range(4)]

    tabled = _pass(long, costs, "conv long, chunk long, costs array<long>, initial int")
    rests = stored(tabled.groupBy("conv").applyInPandas(backward, "conv long, chunk long, rest int, before int, last boolean"), "rests")
    traced = _pass(_with(long, rests), follow, "conv long, chunk long, after array<long>")
    states = traced.groupBy("conv").applyInPandas(forward, "conv long, chunk long, state int")
    return stored(_with(rests, states), "between-chunks")


def _with(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on conversation, which may be null, and chunk."""
    right = right.withColumnsRenamed({"conv": "conv_", "chunk": "chunk_"})
    return left.join(right, F.expr("conv <=> conv_ AND chunk = chunk_"), how).drop("conv_", "chunk_")


def repair(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The edits of all rows and the repaired rows.

    Edits: (conv, turn, seq, edits, roles, cost, blank, duplicate, truncated, illegal), a row for each
    distinct input row, in the order of ``seq`` in its conversation. ``edits`` has a letter for each
    of its copies (K keep, R give another role, D delete) and an I for each row inserted before it, or
    after the last one. ``roles`` has the initial of each repaired row, ``-`` where deleted. Faults
    are counted over the copies: a row's first of blank, duplicate (role and text seen before in the
    conversation) and truncated (last visible character not one of ``.!?``); ``illegal`` counts
    neighbours whose initials are not su, ua or au.

    Repaired: (conv, seq, place, role, text), in the order of (seq, place).

    Rows go by turn, null turns first, those of one turn by a digest. Null roles and texts are one
    space; rows of null conversations are one conversation. A conversation without rows has none here.
    """
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    given = turns.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    name = lambda *parts: F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))
    shown = [F.length("role").cast("string"), F.lit(" "), F.col("role"), F.col("text")]
    conv = [F.coalesce(F.col("conv").cast("string"), F.lit("-")), F.lit(" ")]
    turn = [F.coalesce(F.col("turn").cast("string"), F.lit("-")), F.lit(" ")]
    given = given.withColumn("key", name(*conv, *turn, *shown))
    last = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = F.when(last == "", _BLANK).when(~last.isin(".", "!", "?"), _TRUNCATED).otherwise(0)
    initial = F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1).when(F.col("role").startswith("a"), 2).otherwise(3)
    narrow = given.select("conv", "turn", "key", name(*conv, *shown).alias("content"), (initial * 4 + fault).alias("mark"))
    # Equal rows are one with a number of copies; the first of a content is the one of the least turn.
    same = stored(narrow.groupBy("key", "conv", "turn", "content", "mark").count().withColumnRenamed("count", "copies"), "same-rows")
    first = same.groupBy("content").agg(F.min_by("key", F.struct("turn")).alias("key")).select("key", F.lit(True).alias("first"))
    seen = (F.col("first").isNull()) & (F.col("mark").bitwiseAND(3) != _BLANK)
    marked = same.join(first, "key", "left").withColumn("mark", F.when(seen, F.col("mark").bitwiseOR(_DUPLICATE)).otherwise(F.col("mark")))
    ranged = (
        marked.select("conv", "turn", "key", "mark", F.col("copies"))
        .repartitionByRange(partitions(turns.sparkSession), "conv", "turn", "key").sortWithinPartitions("conv", "turn", "key")
    )
    seq = F.monotonically_increasing_id()
    rows = stored(ranged.withColumn("seq", seq).withColumn("chunk", F.shiftright("seq", CHUNK_BITS)), "ordered-rows")
    between = _between_chunks(rows.select("conv", "chunk", "seq", "mark", "copies"))
    narrow = rows.select("conv", "chunk", "seq", "mark", "copies")
    if between is None:
        none = F.lit(None)
        narrow = narrow.withColumns({"rest": none.cast("int"), "state": none.cast("int"), "before": none.cast("int"), "last": none.cast("boolean")})
    else:
        narrow = _with(narrow, between, "left")

    def settled(chunk):
        rest, state, before, last = (chunk[name][0] for name in ("rest", "state", "before", "last"))
        found, state = tables().edits(_kinds(chunk), rest or 0, state or 0)
        if last is not False:
            tail = _tail(state)
            found[-1] = tuple(a + b for a, b in zip(found[-1], tail))
        at = 0
        for seq, mark, copies in zip(chunk["seq"], chunk["mark"], chunk["copies"]):
            letters, roles, paid = zip(*found[at : at + copies])
            at += copies
            own, fault = mark >> 2, mark & 3
            illegal = (before is not None and (before, own) not in _LEGAL) + copies - 1
            before = own
            blank = copies if fault == _BLANK else 0
            again = copies if fault == _DUPLICATE else 0 if blank else copies - 1
            yield chunk["conv"][0], seq, "".join(letters), "".join(roles), sum(paid), blank, again, int(fault == _TRUNCATED), illegal

    schema = "conv long, seq long, edits string, roles string, cost long, blank long, duplicate long, truncated long, illegal long"
    edits = stored(_pass(narrow, settled, schema), "edits")
    keyed = stored(edits.drop("conv").join(rows.select("seq", "conv", "turn", "key"), "seq"), "keyed-edits")
    texts = given.groupBy("key").agg(F.any_value("role").alias("role"), F.any_value("text").alias("text"))
    place = F.explode(F.sequence(F.lit(1), F.length("edits")))
    letter, own = F.substr(F.col("edits"), F.col("place"), F.lit(1)), F.substr(F.col("roles"), F.col("place"), F.lit(1))
    made = F.when(letter == "K", F.col("role")).when(own == "u", "user").otherwise("assistant")
    repaired = (
        keyed.where("roles RLIKE '[sua]'").join(texts, "key").withColumn("place", place).where(own != "-")
        .select("conv", "seq", "place", made.alias("role_"), F.when(letter == "I", "").otherwise(F.col("text")).alias("text"))
        .withColumnRenamed("role_", "role")
    )
    return keyed.drop("key"), repaired


def report(edits: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation of ``edits``.

    ``gaps`` counts the turns missing between the smallest and the largest; it is 0 if all are null.
    """
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    turns = edits.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"))
    names = ("blank", "duplicate", "truncated", "illegal", "cost")
    listed = F.array_sort(F.collect_list(F.struct("seq", "edits")))
    sums = edits.groupBy("conv").agg(
        *[F.sum(name).alias(name) for name in names], F.array_join(F.transform(listed, lambda x: x["edits"]), "").alias("audit")
    )
    return turns.withColumnRenamed("conv", "conv_").join(sums, F.expr("conv <=> conv_")).select("conv", "gaps", *names, "audit")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of the lines ``role:text`` of each conversation, joined by newlines.

    A digest is made row after row, so a conversation's rows pass one task; it holds one batch of them.
    """

    def run(batches):
        import hashlib

        conv, digest = None, None
        for batch in batches:
            out = []
            for own, role, text in zip(*(column(batch, name).to_pylist() for name in ("conv", "role", "text"))):
                if digest is None or own != conv:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if out:
                yield _digest_rows(out)
        if digest is not None:
            yield _digest_rows([(conv, digest.hexdigest())])

    dealt = repaired.repartition(partitions(repaired.sparkSession), "conv").sortWithinPartitions("conv", "seq", "place")
    return dealt.select("conv", "role", "text").mapInArrow(run, "conv long, sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    convs, shas = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(convs, pa.int64()), pa.array(shas)], ["conv", "sha256"])
