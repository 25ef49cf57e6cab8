"""Ranked lexical search with norm buckets.

A document is a vector of impacts, one coordinate per term that some item asks
for, and an item's score is an inner product of its terms' weights with them.
Vectors are ordered by length, longest first, and read in buckets of nearly the
same length. By Cauchy and Schwarz a bucket, and so every later one, is of no
use to an item once its longest vector times the length of the item's falls
below the item's tenth best score so far. Within a bucket the largest impact of
each coordinate bounds what terms not yet added can bring; together with the
length that a vector has left over, that filters the documents, and those that
pass are scored anew in integers. So the result is exact.

The order is one within each part of the corpus, as it was read: no vector is
shuffled, and parts have equal work. A first pass over the longest bucket of
every part finds scores that the best ten reach at least, from which all parts
start. Weights are shared out evenly: vectors and items both carry the root of
a term's weight, so that common words don't lengthen vectors much.

Items are taken in blocks of about ``BLOCK`` terms, which are counted; a block's
terms are sent to every task, and the corpus is read once per block.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1_000_000
BUCKET = 1024
LEAST_BUCKET = 64
RATIO = 0.9
_SLACK = 1 + 1e-9
#: ASCII letters in lower case, digits and all bytes of other characters; blanks for the rest.
_LETTERS = bytes(
    c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in bytes(range(256)).lower()
)
_SCORES = "item_id long, doc_id long, score long"


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_LETTERS).split()


# Items


@dataclass
class Items:
    """A block of items: their ids and, per item, numbers of terms."""

    ids: list[int]
    asked: list[np.ndarray]
    numbers: dict[bytes, int]


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        texts = [[t.decode() for t in some] for some in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), pa.array(texts, pa.list_(pa.string()))], ["item_id", "terms"]
        )


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, terms``, sorted and once each; rows that repeat an id are one item."""
    rows = items.where("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    found = to_python(rows).mapInArrow(_terms_of, "item_id long, terms array<string>")
    once = found.select("item_id", F.explode("terms").alias("term")).distinct()
    return once.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def blocks(asked: DataFrame, block: int = BLOCK) -> Iterator[Items]:
    """The items in blocks of about so many terms."""
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = -(-total // block)
    for part in range(parts):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).orderBy("item_id").collect()
        numbers: dict[bytes, int] = {}
        lists = [
            np.array([numbers.setdefault(t.encode(), len(numbers)) for t in r.terms], np.int64) for r in rows
        ]
        if rows:
            yield Items([r.item_id for r in rows], lists, numbers)


# Vectors


def counted(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document with a term: how many it has,
    and how often it has those with a number."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            ids, sizes, found, often = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = Counter(terms(text.as_py()))
                if words:
                    shared = [w for w in words if w in number]
                    ids.append(doc_id)
                    sizes.append(words.total())
                    found.append([number[w] for w in shared])
                    often.append([words[w] for w in shared])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())), pa.array(often, pa.list_(pa.int32())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return to_python(rows).mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weights(stored: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and the weight of each numbered term."""
    total = stored.agg(F.count("*").alias("docs"), F.sum("n").alias("all")).first()
    held = stored.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    found = np.zeros(size, np.int64)
    for r in held.collect():  # one row per numbered term at the most
        found[r.term] = math.floor(1000 * math.log((2 * total.docs + 2) / (2 * r.df + 1)))
    return total.docs, total["all"] or 0, found


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(column.offsets.to_numpy())
    return sizes, column.flatten().to_numpy().astype(np.int64)


def ordered(stored: DataFrame, docs: int, size: int, weight: np.ndarray) -> DataFrame:
    """``length, doc_id, terms, impacts`` of the documents that can be named and
    share a term with an item; in each part the longest vectors come first."""
    m = F.expr("100 - 90 + ((90L * n * all_docs) div all_terms)")
    rows = (
        stored.where("doc_id is not null and size(terms) > 0")
        .withColumns({"all_docs": F.lit(docs).cast("long"), "all_terms": F.lit(max(1, size)).cast("long")})
        .select("doc_id", m.alias("m"), "terms", "tfs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = _lists(batch.column("terms"))
            _, tf = _lists(batch.column("tfs"))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * batch.column("m").to_numpy()[owner])
            squares = np.bincount(owner, weight[found] * impacts.astype(np.float64) ** 2, len(sizes))
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.sqrt(squares)), batch.column("doc_id"),
                    pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(impacts, pa.int32())),
                ],
                ["length", "doc_id", "terms", "impacts"],
            )

    vectors = rows.mapInArrow(run, "length double, doc_id long, terms array<int>, impacts array<int>")
    return vectors.sortWithinPartitions(F.desc("length"), "doc_id")


# Buckets


class Bucket:
    """Vectors of nearly one length, by row and by coordinate."""

    def __init__(self, lengths: np.ndarray, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        self.lengths, self.ids = lengths, ids
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.impacts = terms, impacts
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(ids)), sizes)[order]
        self.by_term = impacts[order]
        self.known, self.starts = np.unique(terms[order], return_index=True)
        self.stops = np.append(self.starts[1:], len(terms))
        self.most = np.maximum.reduceat(self.by_term, self.starts)

    def places(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms are coordinates here, and where."""
        at = np.minimum(np.searchsorted(self.known, asked), len(self.known) - 1)
        here = self.known[at] == asked
        return here, at[here]

    def score(self, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Exact scores of some rows; ``own`` has the item's weight of every term."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        skipped = np.repeat(self.ends[rows] - np.cumsum(sizes) + sizes, sizes)
        flat = np.arange(sizes.sum()) + skipped
        parts = own[self.terms[flat]] * self.impacts[flat]
        return np.add.reduceat(parts, np.cumsum(sizes) - sizes)


def candidates(bucket: Bucket, asked: np.ndarray, weight: np.ndarray, floor: int) -> np.ndarray:
    """Rows of the bucket that may reach the floor, by bounds per coordinate and
    by the length that is left beside the coordinates looked at."""
    here, at = bucket.places(asked)
    w = weight[asked[here]]
    bound = w * bucket.most[at]
    if not len(at) or bound.sum() * _SLACK < floor:
        return np.zeros(0, np.int64)
    order = np.argsort(-bound, kind="stable")
    at, w, bound = at[order], w[order], bound[order]
    rest = bound.sum() - np.cumsum(bound)  # what the later coordinates can bring
    looked = int(np.argmax(rest * _SLACK < max(floor, 1))) + 1
    have = np.zeros(len(bucket.ids), np.int64)
    squares = np.zeros(len(bucket.ids))
    for i in range(looked):
        part = slice(bucket.starts[at[i]], bucket.stops[at[i]])
        have[bucket.rows[part]] += w[i] * bucket.by_term[part]
        squares[bucket.rows[part]] += w[i] * bucket.by_term[part].astype(np.float64) ** 2
    rows = np.flatnonzero(have)
    left = np.sqrt(np.maximum(bucket.lengths[rows] ** 2 - squares[rows], 0) * _SLACK)
    more = np.minimum(rest[looked - 1], left * math.sqrt(w[looked:].sum()))
    return rows[(have[rows] + more) * _SLACK + 1 >= floor]


class Search:
    """The best documents per item, over buckets of falling length."""

    def __init__(self, items: Items, weight: np.ndarray, k: int, floors: np.ndarray):
        self.items, self.weight, self.k = items, weight, k
        self.floors = floors.copy()
        self.lengths = np.array([math.sqrt(weight[a].sum()) for a in items.asked])
        self.active = np.arange(len(items.ids))
        self.best: list[list[tuple[int, int]]] = [[] for _ in items.ids]
        self.own = np.zeros(len(weight), np.int64)
        self.met = self.scored = 0

    def add(self, bucket: Bucket) -> bool:
        """Whether any item may find something in a later bucket."""
        reach = self.lengths[self.active] * bucket.lengths[0] * _SLACK + 1
        self.active = self.active[reach >= self.floors[self.active]]
        for q in self.active:
            asked = self.items.asked[q]
            rows = candidates(bucket, asked, self.weight, self.floors[q])
            self.met += len(bucket.ids)
            self.scored += len(rows)
            if not len(rows):
                continue
            self.own[asked] = self.weight[asked]
            scores = bucket.score(rows, self.own)
            self.own[asked] = 0
            good = scores >= max(1, self.floors[q])
            new = zip((-scores[good]).tolist(), bucket.ids[rows[good]].tolist())
            best = self.best[q] = heapq.nsmallest(self.k, [*self.best[q], *new])
            if len(best) == self.k:
                self.floors[q] = max(self.floors[q], -best[-1][0])
        return len(self.active) > 0

    def batch(self) -> pa.RecordBatch:
        found = [(i, d, -s) for i, best in zip(self.items.ids, self.best) for s, d in best]
        columns = zip(*found) if found else ([], [], [])
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), pa.int64()) for c in columns], ["item_id", "doc_id", "score"]
        )


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    """Rows in order of falling length as buckets; a bucket ends where it is
    full, or where lengths fall below ``RATIO`` of its first."""
    held: list[tuple] = []

    def joined(parts: list[tuple]) -> Bucket:
        return Bucket(*(np.concatenate(c) for c in zip(*parts)))

    first, rows = None, 0
    for batch in batches:
        lengths, ids = batch.column("length").to_numpy(), batch.column("doc_id").to_numpy()
        sizes, found = _lists(batch.column("terms"))
        _, impacts = _lists(batch.column("impacts"))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        at = 0
        while at < len(ids):
            first = lengths[at] if first is None else first
            near = int(np.searchsorted(-lengths, -RATIO * first, "right"))
            stop = min(len(ids), at + BUCKET - rows, max(near, at + max(1, LEAST_BUCKET - rows)))
            part = slice(ends[at], ends[stop])
            held.append((lengths[at:stop], ids[at:stop], sizes[at:stop], found[part], impacts[part]))
            rows += stop - at
            at = stop
            if rows >= BUCKET or at < len(ids):
                yield joined(held)
                held, first, rows = [], None, 0
    if held:
        yield joined(held)


def _search(vectors: DataFrame, items: Items, weight: np.ndarray, k: int, floors: np.ndarray, most: int | None) -> DataFrame:
    sent = vectors.sparkSession.sparkContext.broadcast((items, weight, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some, w, start = sent.value
        search = Search(some, w, k, start)
        for number, bucket in enumerate(buckets(batches), 1):
            if not search.add(bucket) or number == most:
                break
        yield search.batch()

    return vectors.mapInArrow(run, _SCORES)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: Items, k: int) -> DataFrame:
    stored = checkpointed(counted(docs, items.numbers))
    n_docs, n_terms, weight = weights(stored, len(items.numbers))
    vectors = checkpointed(ordered(stored, n_docs, n_terms, weight))
    none = np.zeros(len(items.ids), np.int64)
    seeds = _best(_search(vectors, items, weight, k, none, 1), k).where(F.col("rank") == k)
    reached = {r.item_id: r.score for r in seeds.collect()}  # one row per item of the block
    floors = np.array([reached.get(i, 0) for i in items.ids], np.int64)
    return _best(_search(vectors, items, weight, k, floors, None), k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a
    score above zero, best first, equal scores by id.

    Null and empty texts have no terms; such documents count nowhere, and such
    items find nothing. Documents without an id count in the statistics but
    can't be named in a result. Repeated documents are documents of their own;
    rows that repeat an item's id are one item; items without an id are left
    out. Other columns are ignored; an empty table gives no rows.
    """
    found = None
    for some in blocks(checkpointed(item_terms(items)), block):
        one = _block(docs, some, k)
        found = one if found is None else found.union(one)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"{_SCORES}, rank int")
    return found.select("item_id", "rank", "doc_id", "score")


_WORDS_SQL = r"""unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"""

#: The same ranking, all documents with a term scored.
RANKED_SQL = f"""
with rows as (select row_number() over () as r, doc_id, text from documents),
words as (select r, doc_id, {_WORDS_SQL} as term from rows),
asked as (select distinct item_id, {_WORDS_SQL} as term from benchmark where item_id is not null),
sizes as (select r, count(*) as n from words group by r),
total as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes),
often as (
  select r, doc_id, term, count(*) as tf from words
  where term in (select term from asked) group by r, doc_id, term),
weight as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from often, total group by term, n_docs),
scores as (
  select item_id, doc_id, r,
         cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * n_docs) // n_terms)))))
              as bigint) as score
  from asked join often using (term) join weight using (term) join sizes using (r), total
  where doc_id is not null
  group by item_id, doc_id, r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank,
       doc_id, score
from scores where score > 0 qualify rank <= 10"""
