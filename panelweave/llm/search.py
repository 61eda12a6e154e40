"""Ranked lexical search for many queries at once, with shared partial scores.

The items are the queries. Terms that the same items hold are one node, and
pairs of nodes that stand together in several items become nodes above them, so
the items form a graph of shared term sets. For every block of documents the
partial scores of all nodes are worked out once, bottom up, and an item's
score is the sum of the few nodes it is left with. A task keeps the best
documents of each item; two rounds of ranking merge what tasks kept.

Documents are read once per block of items: words become a table of the
items' terms with their frequencies, which the corpus figures and the scores
are taken from. A block holds a bounded number of (item, term) pairs, so that
its graph may be broadcast; more items make more blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from panelweave.llm import textvec as tv
from panelweave.llm.arrow import map_batches, ship, texts, written
from panelweave.session import use_settings

#: Letters and digits of ASCII, and all characters beyond it.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 50
#: (item, term) pairs of a block of items at most, single items apart.
BLOCK = 1 << 20
#: Neighbours a node is paired with when shared pairs are mined, and rounds of mining; neither changes a score.
NEAR, ROUNDS = 32, 64
#: Partial scores held at once by a task.
CELLS = 1 << 21
#: Groups of tasks whose best documents are merged first.
MERGED = 64


def item_terms(items: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct pairs of ``item`` and ``term``; rows of one id, or of none, are one item."""
    found = F.regexp_extract_all(F.translate(F.col(text), UPPER, SMALL), F.lit(TERM), F.lit(0))
    return items.select(F.col(item).alias("item"), F.explode(found).alias("term")).distinct()


def blocks(entries: DataFrame, most: int = BLOCK) -> int:
    """Into how many blocks items are dealt by a hash, so that none of several items holds more than ``most`` pairs."""
    sizes = entries.groupBy(F.xxhash64("item").alias("h"), "item").count()
    total = entries.count()
    n = max(1, -(-2 * total // most)) if total > most else 1
    while n > 1:
        dealt = sizes.groupBy(F.pmod("h", F.lit(n)).alias("b")).agg(F.sum("count").alias("pairs"), F.count("h").alias("items"))
        if not dealt.where((F.col("pairs") > most) & (F.col("items") > 1)).head(1):
            break
        n *= 2
    return n


class Terms:
    """The terms of a block of items, found in texts by hash and confirmed byte by byte."""

    def __init__(self, terms: list[str]):
        spelled = [t.encode() for t in terms]
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.edge = np.concatenate(([0], np.cumsum([len(t) for t in spelled]))).astype(np.int64)
        h = tv.hashes(self.data, self.edge[:-1], self.edge[1:])
        self.order = np.argsort(h, kind="stable")
        self.hash = h[self.order]
        self.equal = int(np.unique(h, return_counts=True)[1].max()) if len(h) else 0

    def find(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are terms, and of their terms; ``low`` holds the lowered bytes."""
        h = tv.hashes(low, starts, ends)
        place = np.searchsorted(self.hash, h)
        words, terms = [], []
        for step in range(self.equal):  # terms of equal hash stand side by side
            at = place + step
            word = np.flatnonzero((at < len(self.hash)) & (self.hash[np.minimum(at, len(self.hash) - 1)] == h))
            term = self.order[at[word]]
            size = ends[word] - starts[word]
            fits = size == self.edge[term + 1] - self.edge[term]
            word, term, size = word[fits], term[fits], size[fits]
            begin = np.cumsum(size) - size
            inner = np.arange(int(size.sum())) - np.repeat(begin, size)
            differ = low[np.repeat(starts[word], size) + inner] != self.data[np.repeat(self.edge[term], size) + inner]
            wrong = np.zeros(len(word), bool)
            wrong[np.repeat(np.arange(len(word)), size)[differ]] = True
            words.append(word[~wrong])
            terms.append(term[~wrong])
        empty = np.empty(0, np.int64)
        return (np.concatenate(words), np.concatenate(terms)) if words else (empty, empty)


def postings(docs: DataFrame, terms: Terms, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row with a term of any kind: the key, ``n`` terms with repeats, and the items' ``terms`` with their ``tfs``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def make(batch: pa.RecordBatch) -> Iterator[dict]:
        own = shared.value
        size = max(len(own.hash), 1)
        for lo, hi, data, offs in tv.slices(batch.column(1)):
            starts, ends, first = tv.words(data, offs, tv.IS_ALNUM)
            word, term = own.find(tv.LOWER[data], starts, ends)
            both, tf = np.unique(tv.owners(first)[word] * size + term, return_counts=True)
            edge = pa.array(np.searchsorted(both, np.arange(hi - lo + 1) * size), pa.int32())
            n = np.diff(first)
            keep = pa.array(n > 0)
            column = lambda x, kind: pa.ListArray.from_arrays(edge, pa.array(x, kind)).filter(keep)
            yield {
                "key": batch.column(0)[lo:hi].filter(keep),
                "n": pa.array(n, pa.int64()).filter(keep),
                "terms": column(both % size, pa.int32()),
                "tfs": column(tf, pa.int64()),
            }

    kind = docs.schema[key].dataType.simpleString()
    schema = f"key {kind}, n bigint, terms array<int>, tfs array<bigint>"
    return map_batches(docs, [F.col(key).alias("key"), texts(docs, text)], make, schema)


@dataclass
class Sharing:
    """The graph of shared term sets of a block of items.

    ``node`` is each term's lowest node. Each of ``rounds`` makes new nodes, the
    sums of a left and a right one each. ``nodes`` lists what every item sums in
    the end; ``edge`` tells where each item's begin.
    """

    node: np.ndarray
    size: int = 0
    rounds: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    nodes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    edge: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))

    def additions(self) -> int:
        """Sums of two partial scores that a document costs."""
        return sum(len(left) for left, _ in self.rounds) + len(self.nodes) - (len(self.edge) - 1)

    def scores(self, term: np.ndarray, doc: np.ndarray, worth: np.ndarray, docs: int) -> np.ndarray:
        """Scores of every item (row) for ``docs`` documents, from what each term is worth in a document."""
        held = np.zeros((self.size, docs), np.int64)
        np.add.at(held.reshape(-1), self.node[term] * docs + doc, worth)
        at = self.size - sum(len(left) for left, _ in self.rounds)
        for left, right in self.rounds:
            np.add(held[left], held[right], out=held[at : at + len(left)])
            at += len(left)
        return np.add.reduceat(held[self.nodes], self.edge[:-1], axis=0)


def mine(item: np.ndarray, term: np.ndarray, terms: int) -> Sharing:
    """Graph of the term sets that the pairs of ``item`` (numbered from 0, each with a term) and ``term`` share.

    Terms of equal item sets make one node. Then, round by round, an item's
    nodes stand in the order of how many items hold them, each is paired with
    the neighbour that most items hold beside it, and pairs that choose each other in two
    or more items become one node there.
    """
    order = np.lexsort((item, term))
    item, term = item[order], term[order]
    begin = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
    sets: dict[bytes, int] = {}
    node = np.zeros(terms, np.int64)
    for a, b in zip(begin, np.append(begin[1:], len(term))):
        node[term[a]] = sets.setdefault(item[a:b].tobytes(), len(sets))
    own = Sharing(node, len(sets))
    row, held = np.unique(np.stack((item, node[term]), 1), axis=0).T
    for _ in range(ROUNDS):
        support = np.bincount(held, minlength=own.size)
        order = np.lexsort((held, -support[held], row))
        row, held = row[order], held[order]
        left, right = [], []
        for step in range(1, NEAR + 1):
            near = np.flatnonzero(row[step:] == row[:-step])
            left.append(near)
            right.append(near + step)
        left, right = np.concatenate(left), np.concatenate(right)
        low, high = np.minimum(held[left], held[right]), np.maximum(held[left], held[right])
        name, at, count = np.unique(low << 32 | high, return_inverse=True, return_counts=True)
        # every pair's place in one order: most items first, then by name
        place = np.empty(len(name), np.int64)
        place[np.lexsort((name, -count))] = np.arange(len(name))
        many = count[at] > 1
        left, right, at = left[many], right[many], at[many]
        best = np.full(len(held), len(name), np.int64)
        np.minimum.at(best, left, place[at])
        np.minimum.at(best, right, place[at])
        mutual = (best[left] == place[at]) & (best[right] == place[at])
        uses = np.bincount(at[mutual], minlength=len(name))
        taken = mutual & (uses[at] > 1)
        if not taken.any():
            break
        made = np.flatnonzero(uses > 1)
        number = np.full(len(name), -1, np.int64)
        number[made] = own.size + np.arange(len(made))
        own.rounds.append((name[made] >> 32, name[made] & 0xFFFFFFFF))
        own.size += len(made)
        held[left[taken]] = number[at[taken]]
        keep = np.ones(len(held), bool)
        keep[right[taken]] = False
        row, held = row[keep], held[keep]
    own.nodes, own.edge = held, np.searchsorted(row, np.arange(row[-1] + 2)) if len(row) else np.zeros(1, np.int64)
    return own


class Best:
    """The best documents of each item that a task has seen: highest score, then least key, null last."""

    def __init__(self, items: int, top: int):
        self.items, self.top, self.parts, self.count = items, top, [], 0
        self.floor = np.ones(items, np.int64)

    def add(self, scores: np.ndarray, keys: pa.Array) -> None:
        floor = self.floor
        if scores.shape[1] > self.top:
            floor = np.maximum(floor, np.partition(scores, -self.top, axis=1)[:, -self.top])
        item, doc = np.nonzero(scores >= floor[:, None])
        self.parts.append(pa.table({"item": pa.array(item, pa.int32()), "score": scores[item, doc], "key": keys.take(pa.array(doc))}))
        self.count += len(item)
        if self.count > 4 * self.items * self.top + 100_000:
            self.trim()

    def trim(self) -> pa.Table:
        table = pa.concat_tables(self.parts)
        order = pc.sort_indices(table, [("item", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_end")
        table = table.take(order)
        item = table.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        last = rank == self.top - 1
        self.floor[item[last]] = table.column("score").to_numpy()[last]
        table = table.filter(pa.array(rank < self.top))
        self.parts, self.count = [table], len(table)
        return table


def best_per_task(found: DataFrame, sharing: Sharing, weight: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item`` number, ``key`` and ``score`` of the ``top`` documents of each item, per task."""
    shared = found.sparkSession.sparkContext.broadcast((sharing, weight))
    ship(found.sparkSession)
    kind = found.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = shared.value
        best = Best(len(own.edge) - 1, top)
        step = max(1, CELLS // (own.size + len(own.nodes) + best.items))
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                m = 100 - 50 + 50 * part.column(1).to_numpy() * n_docs // n_terms
                terms = part.column(2)
                doc = np.repeat(np.arange(part.num_rows), pc.list_value_length(terms).to_numpy())
                term, tf = terms.flatten().to_numpy(), part.column(3).flatten().to_numpy()
                worth = w[term] * (1_000_000_000 * tf // (1000 * tf + 20 * m[doc]))
                best.add(own.scores(term, doc, worth, part.num_rows), part.column(0))
        if best.parts:
            for made in best.trim().to_batches():
                yield made

    return found.mapInArrow(run, f"item int, score bigint, key {kind}")


def _block(docs: DataFrame, entries: DataFrame, top: int, key: str, text: str) -> DataFrame:
    spark = docs.sparkSession
    held = entries.toArrow()
    items, terms = held.column("item").combine_chunks(), held.column("term").combine_chunks().dictionary_encode()
    names = items.dictionary_encode(null_encoding="encode")
    item, term = names.indices.to_numpy().astype(np.int64), terms.indices.to_numpy().astype(np.int64)
    size = len(terms.dictionary)
    found = written(postings(docs, Terms(terms.dictionary.to_pylist()), key, text), "postings")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = found.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    df = np.zeros(size, np.int64)
    df[counted.column("term").to_numpy()] = counted.column("count").to_numpy()
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    # terms worth nothing take no part, nor do items that have no others
    worth = (df > 0) & (weight > 0)
    left = worth[term]
    numbers, item = np.unique(item[left], return_inverse=True)
    schema = f"__item int, item {entries.schema['item'].dataType.simpleString()}"
    if not len(numbers):
        kind = docs.schema[key].dataType.simpleString()
        return spark.createDataFrame([], f"item {entries.schema['item'].dataType.simpleString()}, rank int, key {kind}, score bigint")
    known = pa.table({"__item": pa.array(np.arange(len(numbers)), pa.int32()), "item": names.dictionary.take(pa.array(numbers))})
    sharing = mine(item, term[left], size)
    # a term that takes no part has no node of its own; its worth is 0 wherever it is put
    ranked = best_per_task(found, sharing, np.where(worth, weight, 0), n_docs, n_terms, top)
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    merged = ranked.withColumn("part", F.spark_partition_id() % MERGED)
    for by in (["item", "part"], ["item"]):
        merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    spelled = spark.createDataFrame(known, schema)
    return merged.withColumnRenamed("item", "__item").join(spelled, "__item").select("item", "rank", "key", "score")


def ranked(
    docs: DataFrame, items: DataFrame, top: int = TOP, key: str = "doc_id", item: str = "item_id", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """The ``top`` documents of every item: item, ``rank`` from 1, key and ``score``.

    A row of ``docs`` is a document; equal scores rank by ascending key, null
    last. Null and wordless texts have no term and are no document. Items of one
    id are one item with the terms of all its rows, and null is an id. Items
    without a term that documents hold have no rows.
    """
    use_settings(docs.sparkSession)
    entries = written(item_terms(items, item, text), "items")
    n = blocks(entries, block)
    parts = [_block(docs, entries.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b), top, key, text) for b in range(n)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def twin(docs: str = "documents", items: str = "benchmark", top: int = TOP) -> str:
    """SQL over single terms, without sharing."""
    terms = lambda text: f"unnest(regexp_extract_all(translate({text}, '{UPPER}', '{SMALL}'), '{TERM}'))"
    return f"""
with rows_of as (select row_number() over () r, doc_id, text from {docs}),
words as (select r, {terms("text")} term from rows_of),
sizes as (select r, count(*) n from words group by r),
corpus as (select count(*) n_docs, cast(sum(n) as bigint) n_terms from sizes),
wanted as (select distinct item_id, term from (select item_id, {terms("text")} term from {items})),
tfs as (select r, term, count(*) tf from words where term in (select term from wanted) group by r, term),
weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) w
  from (select term, count(*) df from tfs group by term), corpus),
worth as (
  select t.r, t.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) score
  from tfs t join sizes using (r) join weights using (term), corpus),
scores as (
  select i.item_id, r, cast(sum(score) as bigint) score from wanted i join worth using (term) group by i.item_id, r)
select item_id, cast(rank as integer) rank, doc_id, score from (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last) rank
  from scores join rows_of using (r) where score > 0)
where rank <= {top}"""
