"""SimHash near-duplicates found with BK-trees.

Fingerprints within the radius are found per *shard*. A shard is a set of rows with one key, and the
keys are chosen so that every pair to be found meets in some shard:

* ``link_fingerprints``: the fingerprint is cut into radius + 1 blocks. Two fingerprints that differ
  in at most radius bits agree in at least one whole block, so no link is lost.
* ``link_similar``: smallest shingle hashes under several permutations, so that documents of a given
  Jaccard similarity share one of them. A sketch then tells the pairs that are clearly similar or
  clearly not. Rows with pairs between are searched once more, with their shingle sets: the task that
  meets such a pair takes its exact similarity, and hands on what it unites, never the pairs.

A shard holds one BK-tree of about ``tree_rows`` fingerprints, or several when it is larger (a hot
key): then its rows are dealt to trees by hash and every row searches each tree of its shard up to
its own. The trees of a shard are bounded by that size, and a search reaches them by a shuffle on
(shard, tree), not by a broadcast, which would grow with the corpus. Inside a tree, links become
stars around the smallest row, so a group of n copies makes n edges; stars of all trees are joined
by :func:`millrace.llm.components.components`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bktree import link_steps
from millrace.llm.components import components
from millrace.llm.work import column, partitions, steps, stored, texts_of

_HASH_SEED = 42
_HASHES_PER_STEP = 1 << 16
#: Permutations whose smallest shingle hash is a shard key, and bins of the similarity sketch.
KEYS, BINS = 6, 256
#: Bytes of shingle sets in a tree, and in the rows that a task holds of one that is larger.
SET_BYTES = 32 << 20
_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, words: int) -> Iterator[np.ndarray]:
    """XXH64 of every word shingle, repeats included, in pieces of bounded length.

    Words are maximal runs without ASCII white space after A-Z are lower-cased. A text with fewer
    words is one shingle; a text without words has none.
    """
    joined = b" ".join(text.encode("utf-8", "surrogatepass").lower().split())
    if not joined:
        return
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    begin = np.concatenate(([0], spaces + 1))
    end = np.append(spaces, len(joined))[words - 1 :]
    if not len(end):
        begin, end = begin[:1], np.array([len(joined)])
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(end), _HASHES_PER_STEP):
        low, high = begin[at : at + _HASHES_PER_STEP].tolist(), end[at : at + _HASHES_PER_STEP].tolist()
        yield np.array([digest(joined[a:b], _HASH_SEED) for a, b in zip(low, high)], dtype=np.uint64)


def simhash(pieces: list[np.ndarray]) -> int:
    """64-bit majority of the hashes: a bit is 1 if it is set in over half of them."""
    total, count = np.zeros(64, np.int64), 0
    for piece in pieces:
        total += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(piece)
    return int(np.packbits(2 * total > count, bitorder="little").view(np.uint64)[0])


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of every row; a null text or one without words has fingerprint zero."""

    def hashed(batches):
        for batch in steps(batches):
            prints = [simhash(list(shingle_hashes(text, words))) for text in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([column(batch, "id"), _signed(prints)], ["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(hashed, "id long, fp long")


def link_fingerprints(prints: DataFrame, radius: int = 4, tree_rows: int = 4096) -> DataFrame:
    """(node, component): classes of distinct ``fp`` values linked within ``radius`` bits.

    The smallest fingerprint of a class and fingerprints without a link have no row.
    """
    bounds = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
    keys = F.array(*[
        F.shiftrightunsigned("fp", low).bitwiseAND((1 << (high - low)) - 1).bitwiseOR(F.lit(i << 58))
        if high - low < 58 else F.col("fp")
        for i, (low, high) in enumerate(zip(bounds, bounds[1:]))
    ])
    rows = prints.select(F.col("fp").alias("node"), "fp").distinct().withColumn("keys", keys)
    return components(_stars(rows, radius, tree_rows, None))


def _stars(rows: DataFrame, radius: int, tree_rows: int, similarity: float | None) -> DataFrame:
    """Edges (a, b) that connect the rows (node, fp, keys[, sketch, class[, hashes]]) of each shard's classes.

    Without ``hashes``, the rows with pairs whose sketches leave the similarity open, and which no
    edge of the shard connects, are returned as loops; with them such pairs are settled. Either way
    a tree returns at most two edges a row.
    """
    exact = "hashes" in rows.columns
    carried = ["node", "fp", *(["sketch", "class"] if similarity is not None else []), *(["hashes"] if exact else [])]
    rows = stored(rows, "shard-rows")
    size = F.size("hashes").cast("long") * 8 if exact else F.lit(0)
    load = F.greatest(F.count(F.lit(1)) / tree_rows, F.sum("size") / SET_BYTES)
    shards = (
        rows.select(F.explode("keys").alias("key"), size.alias("size")).groupBy("key")
        .agg(F.ceil(load).cast("int").alias("trees"), F.count(F.lit(1)).alias("count")).where("count > 1").drop("count")
    )
    dealt = (
        rows.select("*", F.explode("keys").alias("key")).drop("keys").join(shards, "key")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("trees")).cast("int"))
        .select("key", *carried, "own", F.explode(F.sequence(F.lit(0), "own")).alias("tree"))
        .select("key", "tree", (F.col("tree") != F.col("own")).alias("query"), *carried)
    )
    dealt = dealt.repartition(partitions(rows.sparkSession), "key", "tree").sortWithinPartitions("key", "tree", "query")

    def stars(batches):
        buffer: _Shards = _Shards(radius, similarity, exact)
        for batch in batches:
            yield from buffer.add(batch)
        yield from buffer.finish()

    return dealt.mapInArrow(stars, "a long, b long").distinct()


class _Shards:
    """Rows of one task in shard order; whole shards are linked together once enough rows are there.

    A shard too large for that keeps the rows of its tree, whose number is bounded, and lets its
    searching rows pass in blocks.
    """

    rows = 1 << 15
    #: Open pairs that are held before their rows are handed on.
    open_pairs = 1 << 20

    def __init__(self, radius: int, similarity: float | None, exact: bool):
        self.radius, self.similarity, self.exact = radius, similarity, exact
        self.parts: list[pa.Table] = []
        self.held = self.bytes = 0
        self.linked = False  # the tree rows that are held have been linked among themselves

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        # A batch of long shingle sets is taken in pieces.
        step = max(1, batch.num_rows * SET_BYTES // max(1, batch.nbytes)) if self.exact else max(1, batch.num_rows)
        for start in range(0, batch.num_rows, step):
            yield from self._add(pa.Table.from_batches([batch.slice(start, step)]))

    def _add(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        self.parts.append(table)
        self.held, self.bytes = self.held + table.num_rows, self.bytes + table.nbytes
        if not self._full():
            return
        kept = pa.concat_tables(self.parts).combine_chunks()
        key, tree = kept["key"].to_numpy(), kept["tree"].to_numpy()
        last = np.flatnonzero((key == key[-1]) & (tree == tree[-1]))[0]
        if last:
            yield from self._link(kept.slice(0, last))
            kept, self.linked = kept.slice(last), False
        self._hold(kept)
        if self._full() and kept["query"][-1].as_py():
            yield from self._link(kept)
            nodes = int(np.count_nonzero(~kept["query"].to_numpy()))
            self._hold(kept.slice(0, nodes))
            self.linked = True

    def _full(self) -> bool:
        # Beside a tree's own rows there is always room for as many bytes again.
        return self.held >= self.rows or self.exact and self.bytes >= 3 * SET_BYTES

    def _hold(self, table: pa.Table) -> None:
        self.parts, self.held, self.bytes = [table], table.num_rows, table.nbytes

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield from self._link(pa.concat_tables(self.parts).combine_chunks())

    def _link(self, table: pa.Table) -> Iterator[pa.RecordBatch]:
        key, tree = table["key"].to_numpy(), table["tree"].to_numpy()
        turn = np.ones(len(key), bool)
        turn[1:] = (key[1:] != key[:-1]) | (tree[1:] != tree[:-1])
        node, similar = table["node"].to_numpy(), None
        doubtful: list[tuple[np.ndarray, np.ndarray]] = []
        if self.similarity is not None:
            sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, BINS)
            known = table["class"].to_numpy()
            sets = _Sets(table["hashes"].combine_chunks()) if self.exact else None

            def similar(a, b):
                share, margin = sketch_similarity(sketch[a], sketch[b], self.similarity)
                same = known[a] == known[b]
                near = (np.abs(share - self.similarity) < margin) & ~same
                good = same | ~near & (share >= self.similarity)
                if sets is None:
                    doubtful.append((a[near], b[near]))
                else:
                    good[near] = sets.similar(a[near], b[near], self.similarity)
                return good

        label = np.arange(len(key))
        for label in link_steps(
            np.cumsum(turn), table["fp"].to_numpy().view(np.uint64), table["query"].to_numpy(), self.radius, similar
        ):
            if sum(len(pairs[0]) for pairs in doubtful) > self.open_pairs:
                yield from self._open(node, label, doubtful)
        yield from self._open(node, label, doubtful)
        tied = label != np.arange(len(label))
        yield self._edges(node[label[tied]], node[tied])

    def _open(self, node: np.ndarray, label: np.ndarray, doubtful: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Rows of the open pairs that are not in one class by now; the pairs are taken off the list."""
        if doubtful:
            a, b = (np.concatenate(parts) for parts in zip(*doubtful))
            doubtful.clear()
            apart = label[a] != label[b]
            rows = node[np.unique(np.concatenate([a[apart], b[apart]]))]
            yield self._edges(rows, rows)

    @staticmethod
    def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


class _Sets:
    """Sorted sets of hashes, compared exactly."""

    #: Members of sets that are looked up at once.
    most = 1 << 21

    def __init__(self, sets: pa.ListArray):
        self.begin = sets.offsets.to_numpy()
        self.size = np.diff(self.begin)
        self.values = sets.values.to_numpy()

    def _of(self, row: int) -> np.ndarray:
        return self.values[self.begin[row] : self.begin[row + 1]]

    def similar(self, a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
        """Whether the Jaccard similarity of the sets a[i] and b[i], none empty, is ``similarity`` or more."""
        out = np.zeros(len(a), bool)
        sizes = self.size[a], self.size[b]
        # Sets of very unequal sizes cannot be similar.
        open_pairs = np.flatnonzero(np.minimum(*sizes) >= similarity * np.maximum(*sizes))
        open_pairs = open_pairs[np.argsort(a[open_pairs], kind="stable")]
        for some in np.split(open_pairs, np.flatnonzero(np.diff(a[open_pairs])) + 1):
            if not len(some):
                continue
            own = self._of(a[some[0]])
            block = np.cumsum(self.size[b[some]]) // self.most
            for part in np.split(some, np.flatnonzero(np.diff(block)) + 1):
                others = [self._of(row) for row in b[part]]
                joined = np.concatenate(others)
                hit = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
                first = np.concatenate([[0], np.cumsum([len(o) for o in others])[:-1]])
                shared = np.add.reduceat(hit, first, dtype=np.int64)
                out[part] = shared >= similarity * (len(own) + self.size[b[part]] - shared)
        return out


def near_duplicates(
    docs: DataFrame, words: int = 5, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fp, component): rows whose fingerprints are linked, directly or in steps, share a component.

    ``component`` is the smallest id of the class. Null texts and texts without words have
    fingerprint zero and are linked like others. A row without id is in its class but never names it,
    and a class without any id has a null component. Repeated rows are returned as often as given.
    """
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("id").alias("own"))
    linked = link_fingerprints(prints, radius)
    names = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "class", F.coalesce("component", "fp")
    )
    names = stored(names.select("fp", "own", "class"), "classes")
    # Classes of one fingerprint, most of the corpus, are named already; the rest meet on the class.
    tied = names.join(linked.select(F.col("component").alias("class")).distinct(), "class", "left_semi")
    named = tied.join(tied.groupBy("class").agg(F.min("own").alias("first")), "class").select("fp", "first")
    names = names.join(named, "fp", "left").select("fp", F.coalesce("first", "own").alias("component"))
    return prints.join(names, "fp").select("id", "fp", "component")


def sketch_of(hashes: np.ndarray) -> tuple[list[int], bytes]:
    """Of distinct hashes: the smallest under KEYS permutations, and one 16-bit value in each of BINS bins (0: empty).

    A bin keeps the smallest hash that falls in it, so two texts' bins agree as often as their
    shingle sets do; texts with few shingles compare nearly exactly.
    """
    keys = []
    for i in range(KEYS):
        mixed = (hashes ^ np.uint64(i * 0x632BE59BD9B4E019 & (2**64 - 1))) * _GAMMA
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        keys.append(int(mixed.min()) & ~7 & (2**63 - 1) | i)
    mixed = hashes * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    bins, values = (mixed >> np.uint64(56)).astype(np.int64), (mixed & np.uint64((1 << 56) - 1))
    smallest = np.full(BINS, (1 << 64) - 1, np.uint64)
    np.minimum.at(smallest, bins, values)
    short = (smallest % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
    short[smallest == (1 << 64) - 1] = 0
    return keys, short.tobytes()


def sketch_similarity(a: np.ndarray, b: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Share of bins, filled in either sketch, that agree, and how far it can be from the Jaccard similarity.

    The margin is four standard errors at ``similarity`` and two bins, for small sets whose shingles
    meet in a bin.
    """
    filled = (a > 0) | (b > 0)
    count = np.maximum(filled.sum(axis=1), 1)
    return ((a == b) & filled).sum(axis=1) / count, 4 * (similarity * (1 - similarity) / BINS) ** 0.5 + 2 / count


def link_similar(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 22, tree_rows: int = 4096,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, text_hash, component, component_hash): rows whose word shingles have a Jaccard similarity of ``similarity``.

    A component is named by its smallest (id, XXH64 of the text). Links need a distance within
    ``radius`` of the SimHashes of the distinct shingles, since repeats do not count for the
    similarity either. Sketches of BINS bins clear the pairs that are more than four standard errors
    (0.1 at 0.8) from ``similarity``; the others are settled exactly, unless clear pairs connect them
    anyway. A pair of similarity 0.8 shares none of the KEYS shard keys with probability 0.2 ** 6,
    and differs in more than 22 bits with probability up to 0.001. Texts with equal shingle sets are
    one node. Rows with a null id or without a word are left out.
    """

    def sketched(batches):
        for batch in steps(batches):
            ids, texts, nodes, prints, keys, sketches = [], [], [], [], [], []
            own = column(batch, "text_hash").to_pylist()
            for doc, text_hash, text in zip(column(batch, "id").to_pylist(), own, texts_of(batch)):
                pieces = list(shingle_hashes(text, words))
                if doc is None or not pieces:
                    continue
                hashes = np.unique(np.concatenate(pieces))
                key, sketch = sketch_of(hashes)
                ids.append(doc)
                texts.append(text_hash)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes()))
                prints.append(simhash([hashes]))
                keys.append(key)
                sketches.append(sketch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), _signed(nodes), _signed(prints),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["id", "text_hash", "node", "fp", "keys", "sketch"],
            )

    given = docs.select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text")
    )
    rows = stored(
        given.mapInArrow(
            sketched, "id long, text_hash long, node long, fp long, keys array<long>, sketch binary"
        ), "sketches",
    )
    least = rows.groupBy("node").agg(F.min(F.struct("id", "text_hash")).alias("own"))
    # Only rows that share a key with another node go on, so most sketches are never shuffled.
    nodes = rows.select("node", F.explode("keys").alias("key"))
    shared = nodes.groupBy("key").agg((F.min("node") != F.max("node")).alias("more")).where("more").select("key")
    met = nodes.join(shared, "key", "left_semi").select("node").distinct()
    distinct = (
        rows.join(met, "node", "left_semi").groupBy("node")
        .agg(F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch"))
    )
    distinct = stored(distinct, "met-nodes")
    found = stored(_stars(distinct.withColumn("class", F.col("node")), radius, tree_rows, similarity), "similar-pairs")
    linked = components(found)
    rest = found.where("a = b").select(F.col("a").alias("node"))
    if not rest.isEmpty():
        rest = distinct.join(rest.distinct(), "node", "left_semi").join(linked, "node", "left")
        rest = rest.withColumn("class", F.coalesce("component", "node")).drop("component")
        rest = rest.join(_shingle_sets(rest.select("node"), given, rows, words), "node")
        known = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
        linked = components(known.unionByName(_stars(rest, radius, tree_rows, similarity)))
    names = least.join(linked, "node", "left").withColumn("class", F.coalesce("component", "node"))
    names = stored(names.select("node", "own", "class"), "classes")
    tied = names.join(linked.select(F.col("component").alias("class")).distinct(), "class", "left_semi")
    named = tied.join(tied.groupBy("class").agg(F.min("own").alias("first")), "class").select("node", "first")
    names = names.join(named, "node", "left").select("node", F.coalesce("first", "own").alias("first"))
    return rows.select("id", "text_hash", "node").join(names, "node").select(
        "id", "text_hash", F.col("first.id").alias("component"), F.col("first.text_hash").alias("component_hash")
    )


def _shingle_sets(nodes: DataFrame, given: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """(node, hashes): the sorted shingle hashes of each node, made anew from one of its rows."""

    def hashed(batches):
        for batch in steps(batches):
            sets = [
                np.unique(np.concatenate(list(shingle_hashes(text, words)))).view(np.int64) for text in texts_of(batch)
            ]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "node"), pa.array([np.sort(some) for some in sets], pa.list_(pa.int64()))], ["node", "hashes"]
            )

    chosen = rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.min(F.struct("id", "text_hash")).alias("own"))
    texts = given.join(chosen.select("node", "own.*"), ["id", "text_hash"]).select("node", "text")
    sets = texts.mapInArrow(hashed, "node long, hashes array<long>")
    return sets.groupBy("node").agg(F.first("hashes").alias("hashes"))  # repeated rows have one set


def _unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def drop_near_duplicates(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Rows are told apart by id and text, so different texts of one id are judged each on its own; of
    rows with the same id and text one stays. Rows with a null id or a text without words are in no
    group and stay. Other columns may have any names.
    """
    found = link_similar(docs, words, similarity, id_col=id_col, text_col=text_col)
    own, text = _unused("lost_id", docs.columns), _unused("lost_text", docs.columns)
    named = found.select(F.col("id").alias(own), F.col("text_hash").alias(text), (
        (F.col("id") != F.col("component")) | (F.col("text_hash") != F.col("component_hash"))
    ).alias("lost"))
    same = (F.col(id_col).cast("long") == F.col(own)) & (F.xxhash64(text_col) == F.col(text))
    kept = docs.join(named.where("lost").select(own, text).distinct(), same, "left_anti")
    # Rows that occur once, nearly all, need no further pass over their texts.
    repeats = named.where("NOT lost").groupBy(own, text).count().where("count > 1").select(own, text)
    again = kept.join(repeats, same, "left_semi").dropDuplicates([id_col, text_col])
    return kept.join(repeats, same, "left_anti").unionByName(again)
