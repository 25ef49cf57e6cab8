"""Line dedup over all documents by a join of deletion neighbourhoods.

A line is a sequence of words. It goes if an earlier line, by document id and
then line number, has the same words, or words within the edits granted to the
shorter of the two: words replaced, left out or put in. Steps tell how many, as
pairs of a number of words and the edits from there on. By default it is one
edit from ``LEAST_WORDS`` words, so a fifth of a line may differ at most. Of what
is alike the earliest line stays; whether a line goes doesn't depend on whether the earlier
line stays. Lines without words always stay.

1. Every line is hashed, and equal lines shrink to their earliest one.
2. If two lines are within one edit, the front half of the shorter one or its
   rear half is untouched. Lines that share no such half with another one, at
   a length that differs by at most one word, are done.
3. The others emit their deletion neighbourhood as hashed keys: the line with a
   hole in place of each word, the line closed up over each word, and the line
   itself. Lines with the same hole key are within one edit of each other, and
   a line is within one edit of those that give it when closed up; so the
   earliest line per key settles it, and no pairs within a group are made.
4. The edit distance of each line to the earlier one that it would go for is
   verified on the words.

Steps that grant more than one edit take the same way with more keys. Of ``k``
edits on a line cut into ``k + 1`` parts one part is untouched, at a place that
the edits beside it may have moved; lines that share no such part are done. The
others emit every form with up to ``k`` words turned to holes or closed up over:
two forms that agree are as many edits apart as words are gone, holes counted
once. That is exact too and makes no pairs, but the number of keys of a line
grows with the ``k``-th power of its words: steps should end, with a step back to
one edit or none, before lines get long.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import combinations, islice, product

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import once_per_worker, to_python, unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST_WORDS = 5
EDITS = ((LEAST_WORDS, 1),)
_FORMS_AT_ONCE = 1 << 16
_BYTES_AT_ONCE = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_STEP = 0xDA942042E4DD58B5
_NO_ID = -(1 << 63)
_HOLE, _WHOLE, _CLOSED, _WORDS = range(4)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit numbers over all others (SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, as far as asked."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            grown = []
            for base in (self.base, self.inverse):
                factors = np.full(n + n // 4, base, np.uint64)
                factors[0] = 1
                grown.append(np.cumprod(factors, dtype=np.uint64))
            self.up, self.down = grown
        return self.up, self.down


def _sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:], dtype=np.uint64)
    return out


class Lines:
    """Hashes of runs of words in lines of text, all lines at once.

    ``words`` has the number of words per line, ``first`` the place of its
    first word. A run's hash is a polynomial in its words' hashes, which are
    polynomials in their bytes; there are two of each, with 64 bits.
    """

    def __init__(self, text: bytes):
        powers = once_per_worker(("lines",), lambda: [*map(Powers, (*_BASES, _STEP))])
        data = np.frombuffer(text, np.uint8)
        breaks = np.flatnonzero(data == 10)
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
        turns = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = turns[::2], turns[1::2]
        line = np.searchsorted(breaks, starts)
        self.words = np.bincount(line, minlength=len(breaks) + 1)
        self.first = np.cumsum(self.words) - self.words
        self.up, self.down = powers[2].reach(len(starts) + 2)
        self.sums = []
        for base in powers[:2]:
            up, down = base.reach(len(data) + 1)
            sums = _sums((data + np.uint64(1)) * up[: len(data)])
            hashes = _mixed((sums[ends] - sums[starts]) * down[starts])
            self.sums.append(_sums(hashes * self.up[: len(hashes)]))

    def run(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums = self.sums[which]
        return (sums[end] - sums[start]) * self.down[start]

    def without(
        self, which: int, start: np.ndarray, end: np.ndarray, at: np.ndarray, close: bool
    ) -> np.ndarray:
        """Runs without the word ``at``; the rest moves up if ``close``."""
        sums = self.sums[which]
        rest = sums[end] - sums[at + 1]
        if close:
            rest = rest * self.down[1]
        return (sums[at] - sums[start] + rest) * self.down[start]


def _key(hashes: np.ndarray, *told: np.ndarray | int) -> np.ndarray:
    for number in told:
        hashes = _mixed(hashes + np.asarray(number).astype(np.uint64) * np.uint64(_STEP))
    return hashes


def _binary(high: np.ndarray, low: np.ndarray) -> pa.Array:
    """Pairs of 64-bit numbers as 12 bytes each: 96 bits tell the lines of any
    corpus apart, and every byte is shuffled several times."""
    joined = np.empty((len(high), 12), np.uint8)
    joined[:, :8] = high.astype("<u8").view(np.uint8).reshape(-1, 8)
    joined[:, 8:] = low.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :4]
    offsets = np.arange(len(joined) + 1, dtype=np.int32) * 12
    return pa.Array.from_buffers(
        pa.binary(), len(joined), [None, pa.py_buffer(offsets), pa.py_buffer(joined)]
    )


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in runs of bounded size, with the place of the first."""
    column = batch.column("text")
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes, dtype=np.int64) // _BYTES_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1), len(column)]
    for first, end in zip(cuts, cuts[1:]):
        if first < end:
            yield first, column.slice(first, end - first).cast(pa.binary()).to_pylist()


# Without nulls, no filter against them tells one use of the lines from another.
_LINE_COLUMNS = (
    "doc long not null, row_key long not null, line int not null, n int not null, hash binary not null"
)
_HALVES = ("half0", "half1", "half2", "half3")
_PARTS = ("own", "moved")


Steps = Sequence[tuple[int, int]]


def granted(n: np.ndarray, edits: Steps) -> np.ndarray:
    """The edits that lines of so many words have."""
    found = np.zeros(np.shape(n), np.int64)
    for least, most in sorted(edits):
        found = np.where(n >= least, most, found)
    return found


def _granted(n: Column, edits: Steps) -> Column:
    found = F.lit(0)
    for least, most in sorted(edits):
        found = F.when(n >= least, most).otherwise(found)
    return found


def part_keys(found: Lines, edits: Steps) -> tuple[list, list]:
    """Per line with words: the keys of its own parts, and of its runs that would
    be a part of a line with as many words, or fewer, after edits beside it."""
    own, moved = [], []
    most = max(most for _, most in edits)
    for i in np.flatnonzero(found.words):
        n, at = int(found.words[i]), int(found.first[i])
        tags, starts, ends = [], [], []
        for fewer in range(min(most, n - 1) + 1):
            least = n - fewer
            k = int(granted(least, edits))
            if k < max(1, fewer):
                continue
            cuts = [least * j // (k + 1) for j in range(k + 2)]
            for part in range(k + 1):
                shifts = [0] if part == 0 else [fewer] if part == k else range(-k, k + 1)
                for shift in sorted(shifts, key=lambda x: (x != 0, x)):
                    start, end = cuts[part] + shift, cuts[part + 1] + shift
                    if abs(shift) + abs(fewer - shift) <= k and 0 <= start and end <= n:
                        tags.append((least, part, fewer == 0 and shift == 0))
                        starts.append(at + start)
                        ends.append(at + end)
        hashes = found.run(0, np.array(starts, np.int64), np.array(ends, np.int64))
        tag = np.array([t[:2] for t in tags], np.int64).reshape(-1, 2)
        keys = _key(hashes, tag[:, 0], tag[:, 1], 5).view(np.int64).tolist()
        fixed = [t[2] for t in tags]
        own.append([key for key, f in zip(keys, fixed) if f])
        moved.append([key for key, f in zip(keys, fixed) if not f])
    return own, moved


def hashed_lines(docs: DataFrame, edits: Steps = EDITS) -> DataFrame:
    """One row per line with words: its place, its hash, and the keys of its
    halves for pairs whose shorter line has as many words, or one less; or the
    keys of its parts, where more than one edit is granted."""
    by_parts = max(most for _, most in edits) > 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, row_keys = batch.column("doc").to_numpy(), batch.column("row_key").to_numpy()
            for at, texts in _texts(batch):
                found = Lines(b"\n".join(texts))
                counts = np.array([t.count(b"\n") + 1 for t in texts])
                row = np.repeat(np.arange(len(texts)), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                own = np.flatnonzero(found.words)
                n, start = found.words[own], found.first[own]
                end = start + n
                halves = [pa.array(k, pa.list_(pa.int64())) for k in part_keys(found, edits)] if by_parts else []
                for least in () if by_parts else (n, n - 1):
                    front, long = least // 2, granted(least, edits) > 0
                    rear = np.where(long, least - front, 0)
                    front = np.where(long, front, 0)
                    for tag, key in (
                        (1, found.run(0, start, start + front)),
                        (2, found.run(0, end - rear, end)),
                    ):
                        key = _key(key, least, tag).view(np.int64)
                        halves.append(pa.array(key, mask=~long))
                columns = [
                    pa.array(ids[at + row[own]]),
                    pa.array(row_keys[at + row[own]]),
                    pa.array(number[own].astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    _binary(*(found.run(which, start, end) for which in (0, 1))),
                    *halves,
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["doc", "row_key", "line", "n", "hash", *(_PARTS if by_parts else _HALVES)]
                )

    halves = ", ".join([f"{h} array<long>" for h in _PARTS] if by_parts else [f"{h} long" for h in _HALVES])
    return to_python(docs.select("doc", "row_key", "text")).mapInArrow(run, f"{_LINE_COLUMNS}, {halves}")


def neighbourhoods(lines: DataFrame, doc: str, row_key: str, wanted: str) -> DataFrame:
    """For rows with a text and some of its lines, ``wanted``: one row per key
    of each such line, and one with its words. A wanted line has its number and,
    as bits, what it needs: holes (``1`` and ``2``) and closed-up forms (``4``
    and ``8``) where it shares its front or its rear half with another line, in
    the other half, and itself (``16``)."""

    names = [doc, row_key, wanted]

    schema = pa.schema(
        [("role", pa.int32()), ("key", pa.binary()), ("doc", pa.int64()),
         ("row_key", pa.int64()), ("line", pa.int32()), ("words", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, row_keys, wanted = map(batch.column, names)
            wanted = wanted.to_pylist()
            for at, texts in _texts(batch):
                row, number, chosen, needs = [], [], [], []
                for i, text in enumerate(texts, at):
                    split = text.split(b"\n")
                    for told in wanted[i]:
                        row.append(i)
                        number.append(told["line"])
                        chosen.append(split[told["line"]])
                        needs.append(told["needs"])
                places = pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(row, pa.int64())),
                     row_keys.take(pa.array(row, pa.int64())),
                     pa.array(number, pa.int32())],
                    ["doc", "row_key", "line"],
                )
                found = Lines(b"\n".join(chosen))
                n, start = found.words[: len(chosen)], found.first[: len(chosen)]
                every = np.repeat(np.arange(len(n)), n)
                at_word, needs = np.arange(len(every)), np.array(needs)
                place, m, need = at_word - start[every], n[every], needs[every]
                s, e = start[every], (start + n)[every]
                holes = ((need & 1 > 0) & (place >= m // 2)) | ((need & 2 > 0) & (place < m // 2))
                closed = ((need & 4 > 0) & (place >= (m - 1) // 2)) | (
                    (need & 8 > 0) & (place <= (m - 1) // 2)
                )
                whole = np.flatnonzero(needs & 16)

                def rows(role: int, of: np.ndarray, key: pa.Array, words: pa.Array | None = None):
                    of = pa.array(of)
                    return pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(of), role, np.int32)), key,
                         *(c.take(of) for c in places.columns),
                         pa.nulls(len(of), pa.string()) if words is None else words],
                        schema=schema,
                    )

                h, c = holes, closed
                yield rows(_HOLE, every[h], _binary(*(
                    _key(found.without(w, s[h], e[h], at_word[h], False), m[h], place[h], 3)
                    for w in (0, 1)
                )))
                yield rows(_CLOSED, every[c], _binary(*(
                    _key(found.without(w, s[c], e[c], at_word[c], True), m[c] - 1, 4)
                    for w in (0, 1)
                )))
                yield rows(_WHOLE, whole, _binary(*(
                    _key(found.run(w, start[whole], (start + n)[whole]), n[whole], 4)
                    for w in (0, 1)
                )))
                words = pa.array([b" ".join(c.split()).decode() for c in chosen], pa.string())
                yield rows(_WORDS, np.arange(len(n)), pa.nulls(len(n), pa.binary()), words)

    return to_python(lines).mapInArrow(
        run, "role int, key binary, doc long, row_key long, line int, words string"
    )


def _meet(h: int, a: int, b: int, n: np.ndarray, edits: Steps) -> np.ndarray:
    """Whether forms of lines of ``n`` words with ``h`` holes, closed up over ``a``
    words, are within the edits of those closed up over ``b``."""
    return h + a + b <= granted(n - a + min(a, b), edits)


def forms(found: Lines, i: int, edits: Steps) -> Iterator[tuple[int, int, tuple[np.ndarray, np.ndarray]]]:
    """Keys of every form of a line that another line can meet within the edits,
    in runs of bounded size: ``(holes, words closed up over, keys)``."""
    n, start, most = int(found.words[i]), int(found.first[i]), max(most for _, most in edits)
    end = start + n
    for gone in range(min(most, n) + 1):
        kinds = [
            closed for closed in product((False, True), repeat=gone)
            if any(_meet(gone - sum(closed), sum(closed), b, n, edits) for b in range(most + 1))
        ]
        places = combinations(range(start, end), gone)
        while kinds and (some := list(islice(places, _FORMS_AT_ONCE))):
            at = np.array(some, np.int64).reshape(len(some), gone)
            edge = np.full((len(some), 1), end)
            to, since = np.hstack([at, edge]), np.hstack([np.full_like(edge, start), at + 1])
            for closed in kinds:
                before = np.cumsum((0, *closed))
                holes = [at[:, j] - start - before[j] for j in range(gone) if not closed[j]]
                keys = []
                for which in (0, 1):
                    rest = found.sums[which][to] - found.sums[which][since]
                    whole = (rest * found.down[before]).sum(axis=1, dtype=np.uint64) * found.down[start]
                    keys.append(_key(whole, n - sum(closed), len(holes), *holes, 6))
                yield len(holes), sum(closed), tuple(keys)


def neighbourhoods_of(
    lines: DataFrame, doc: str, row_key: str, wanted: str, edits: Steps
) -> tuple[DataFrame, DataFrame]:
    """As ``neighbourhoods``, for any edits: the forms of the wanted lines, with
    the number of words, of holes and of words closed up over, and the words."""
    names = [doc, row_key, wanted]
    forms_schema = pa.schema(
        [("key", pa.binary()), ("doc", pa.int64()), ("row_key", pa.int64()), ("line", pa.int32()),
         ("n", pa.int32()), ("holes", pa.int32()), ("closed", pa.int32())]
    )

    def chosen(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int, int], bytes]]:
        docs, row_keys, wanted = map(batch.column, names)
        for at, texts in _texts(batch):
            for i, text in enumerate(texts, at):
                split = text.split(b"\n")
                for told in wanted[i].as_py():
                    yield (docs[i].as_py(), row_keys[i].as_py(), told["line"]), split[told["line"]]

    def all_forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            waiting: list[tuple] = []
            size = 0

            def out() -> pa.RecordBatch:
                told = np.array([w[0] for w in waiting], np.int64)
                told = np.repeat(told, [len(w[1][0]) for w in waiting], axis=0)
                keys = _binary(*(np.concatenate([w[1][which] for w in waiting]) for which in (0, 1)))
                return pa.RecordBatch.from_arrays(
                    [keys, *(pa.array(c).cast(f.type) for c, f in zip(told.T, list(forms_schema)[1:]))],
                    schema=forms_schema,
                )

            for place, line in chosen(batch):
                found = Lines(line)
                for holes, closed, keys in forms(found, 0, edits):
                    waiting.append(((*place, int(found.words[0]), holes, closed), keys))
                    size += len(keys[0])
                    if size >= _FORMS_AT_ONCE:
                        yield out()
                        waiting, size = [], 0
            if waiting:
                yield out()

    def all_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for (doc, row_key, line), text in chosen(batch):
                yield pa.RecordBatch.from_pylist(
                    [{"doc": doc, "row_key": row_key, "line": line, "words": b" ".join(text.split()).decode()}],
                    schema=pa.schema([*list(forms_schema)[1:4], ("words", pa.string())]),
                )

    of = "doc long, row_key long, line int"
    return (
        to_python(lines).mapInArrow(all_forms, f"key binary, {of}, n int, holes int, closed int"),
        to_python(lines).mapInArrow(all_words, f"{of}, words string"),
    )


def _claims_of(forms: DataFrame, edits: Steps) -> DataFrame:
    """Places with the earliest place among those whose forms they meet."""
    closed = range(max(most for _, most in edits) + 1)
    keys = forms.select("key", "n", "holes", "closed", F.struct("doc", "row_key", "line").alias("place"))
    firsts = keys.groupBy("key").agg(
        *(F.min(F.when(F.col("closed") == b, F.col("place"))).alias(f"first_{b}") for b in closed)
    )

    def met(b: int) -> Column:
        shorter = F.col("n") - F.col("closed") + F.least("closed", F.lit(b))
        return F.when(F.col("holes") + F.col("closed") + b <= _granted(shorter, edits), F.col(f"first_{b}"))

    return (
        keys.join(firsts, "key")
        .select("place", F.least(*map(met, closed)).alias("earlier"))
        .where("earlier < place")
        .groupBy("place").agg(F.min("earlier").alias("earlier"))
    )


def within(left: list[str], right: list[str], most: int) -> bool:
    """Whether at most so many edits of a word lead from one list to the other."""
    if abs(len(left) - len(right)) > most:
        return False
    same = next((i for i, (a, b) in enumerate(zip(left, right)) if a != b), None)
    if same is None:
        return True
    # Along each diagonal, how far a number of edits gets.
    reach = {0: same}
    for _ in range(most):
        further: dict[int, int] = {}
        for diagonal, i in reach.items():
            for to, start in ((diagonal, i + 1), (diagonal - 1, i + 1), (diagonal + 1, i)):
                j = start + to
                while start < len(left) and j < len(right) and left[start] == right[j]:
                    start, j = start + 1, j + 1
                if start <= len(left) and j <= len(right):
                    further[to] = max(further.get(to, -1), start)
        reach = further
        if reach.get(len(right) - len(left), -1) == len(left):
            return True
    return False


def _verified(left: str, right: str, edits: Steps) -> Column:
    @F.pandas_udf("boolean")
    def verified(left: pd.Series, right: pd.Series) -> pd.Series:
        pairs = [(a.split(" "), b.split(" ")) for a, b in zip(left, right)]
        most = granted(np.array([min(map(len, pair)) for pair in pairs], np.int64), edits)
        return pd.Series([within(*pair, int(k)) for pair, k in zip(pairs, most)], dtype=bool)

    return verified(left, right)


def _claims(neighbours: DataFrame) -> DataFrame:
    """Places with an earlier place, if there is one, within one edit."""
    place = F.struct("doc", "row_key", "line")
    keys = neighbours.where(F.col("role") != _WORDS).select("role", "key", place.alias("place"))
    first = lambda role: F.min(F.when(F.col("role") == role, F.col("place")))
    firsts = keys.groupBy("key").agg(
        first(_HOLE).alias("hole"), first(_WHOLE).alias("whole"), first(_CLOSED).alias("closed")
    )
    return (
        keys.join(firsts, "key")
        .select(
            "place",
            F.when(F.col("role") == _HOLE, F.col("hole"))
            .when(F.col("role") == _WHOLE, F.col("closed"))
            .otherwise(F.col("whole")).alias("earlier"),
        )
        .where("earlier < place")
        .groupBy("place").agg(F.min("earlier").alias("earlier"))
    )


def _near(claims: DataFrame, words: DataFrame, edits: Steps) -> DataFrame:
    """Places ``doc, row_key`` with the numbers of lines that are within their
    edits of an earlier line, verified."""
    place = F.struct("doc", "row_key", "line")
    words = words.groupBy(place.alias("place")).agg(F.min("words").alias("words"))
    return (
        claims.join(words, "place")
        .select("earlier", F.col("place").alias("later"), F.col("words").alias("later_words"))
        .join(words.withColumnRenamed("place", "earlier"), "earlier")
        .where(_verified("later_words", "words", edits))
        .groupBy("later.doc", "later.row_key")
        .agg(F.collect_list("later.line").alias("near"))
    )


def _alike_by_halves(distinct: DataFrame) -> DataFrame:
    """Hashes of the lines that share a half with another line, and what they
    need of their neighbourhoods."""
    halves = distinct.select(
        "hash", F.posexplode(F.array(*(F.col("place")[h] for h in _HALVES))).alias("which", "half")
    ).where("half is not null")
    # Of the lines that share a half, those of the length that the key tells and
    # those with one word more: which forms can meet depends on who is there.
    exact, which = F.col("which") < 2, F.col("which")
    shared = halves.groupBy("half").agg(
        F.count(F.when(exact, 1)).alias("exact"), F.count(F.when(~exact, 1)).alias("longer")
    ).where("exact > 1 or (exact > 0 and longer > 0)")
    bits = lambda condition, bit: F.when(condition, bit).otherwise(0)
    needs = F.when(
        exact,
        bits(F.col("exact") > 1, F.when(which == 0, 1).otherwise(2)).bitwiseOR(bits(F.col("longer") > 0, 16)),
    ).otherwise(bits(F.col("exact") > 0, F.when(which == 2, 4).otherwise(8)))
    return (
        halves.join(shared, "half").select("hash", needs.alias("needs")).where("needs > 0")
        .groupBy("hash").agg(F.bit_or("needs").alias("needs"))
    )


def _alike_by_parts(distinct: DataFrame) -> DataFrame:
    """Hashes of the lines that share a part with another line."""
    keys = F.concat(
        F.transform(F.col("place.own"), lambda key: F.struct(key.alias("part"), F.lit(True).alias("own"))),
        F.transform(F.col("place.moved"), lambda key: F.struct(key.alias("part"), F.lit(False).alias("own"))),
    )
    parts = distinct.select("hash", F.explode(keys).alias("key")).select("hash", "key.*")
    shared = parts.groupBy("part").agg(F.count("*").alias("n"), F.bool_or("own").alias("own")).where("own and n > 1")
    return parts.select("hash", "part").join(shared, "part").groupBy("hash").agg(F.lit(0).alias("needs"))


def deduplicated(docs: DataFrame, edits: Steps = EDITS) -> DataFrame:
    """The table with each text cut down to the lines that stay, and two more
    columns, last: ``n_lines`` and ``n_kept``, its lines with words before and
    after. A text of which nothing stays becomes empty; null stays null.

    ``edits`` are the steps by which edits are granted: with ``((5, 1), (12, 2),
    (60, 1))`` lines of 12 to 59 words may differ in two. Without steps, or with
    no edits in them, only lines with the same words go.

    Other columns may have any names. Rows without a ``doc_id`` come before
    all others. Rows with the same ``doc_id`` and text count as one document
    and keep the same lines; with different texts they are ordered by a hash.
    """
    names = {
        c: unused(docs, f"_line_dedup_{c}") for c in ("doc", "row_key", "kept", "near", "wanted")
    }
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    keyed = docs.withColumns({
        names["doc"]: F.coalesce(doc_id, F.lit(_NO_ID)),
        names["row_key"]: F.xxhash64(doc_id, text),
    })
    plain = keyed.where("text is not null").select(
        F.col(names["doc"]).alias("doc"), F.col(names["row_key"]).alias("row_key"), text.alias("text")
    )
    edits = tuple(edits) or ((0, 0),)
    by_parts = max(most for _, most in edits) > 1
    lines = hashed_lines(plain, edits)
    # The halves follow from the hash: they ride along, so that one shuffle serves all.
    distinct = lines.groupBy("hash").agg(
        F.min(F.struct("doc", "row_key", "line", *(_PARTS if by_parts else _HALVES))).alias("place")
    )
    alike = _alike_by_parts(distinct) if by_parts else _alike_by_halves(distinct)
    wanted = (
        distinct.select("hash", "place").join(alike, "hash")
        .groupBy("place.doc", "place.row_key")
        .agg(F.collect_list(F.struct("place.line", "needs")).alias("wanted"))
    )
    renamed = lambda df: df.select(*(F.col(c).alias(names[c]) for c in df.columns))
    on = [names["doc"], names["row_key"]]
    # All columns go along, so that the shuffle of the table is the one used below.
    asked = keyed.join(renamed(wanted).hint("shuffle_hash"), on)
    told = asked, names["doc"], names["row_key"], names["wanted"]
    if by_parts:
        form_rows, words = neighbourhoods_of(*told, edits)
        near = _near(_claims_of(form_rows, edits), words, edits)
    else:
        neighbours = neighbourhoods(*told)
        near = _near(_claims(neighbours), neighbours.where(F.col("role") == _WORDS), edits)
    kept = distinct.groupBy("place.doc", "place.row_key").agg(
        F.collect_list("place.line").alias("kept")
    )
    none, lines_of = F.array().cast("array<int>"), F.split(text, "\n")
    blank = F.filter(
        F.transform(lines_of, lambda x, i: F.when(~x.rlike(r"[^\x20\t-\r]"), i)),
        lambda i: i.isNotNull(),
    )
    staying = F.array_except(F.coalesce(names["kept"], none), F.coalesce(names["near"], none))
    n_lines, n_kept = unused(docs, "n_lines"), unused(docs, "n_kept")
    split, empty, stay = (F.col(unused(docs, f"_line_dedup_{c}")) for c in ("split", "empty", "stay"))
    all_kept = F.size(stay) + F.size(empty) == F.size(split)
    left = F.transform(F.array_sort(F.array_union(empty, stay)), lambda i: F.get(split, i))
    shorter = F.when(F.col("text").isNull() | all_kept, F.col("text")).otherwise(F.array_join(left, "\n"))
    column = lambda c: F.col(f"`{c}`")
    return (
        keyed.join(renamed(kept).hint("shuffle_hash"), on, "left")
        .join(renamed(near).hint("shuffle_hash"), on, "left")
        .select(
            *map(column, docs.columns),
            *(c.alias(name) for c, name in zip(
                (lines_of, blank, staying),
                (unused(docs, f"_line_dedup_{c}") for c in ("split", "empty", "stay")),
            )),
        )
        .select(
            *(shorter.alias(c) if c == "text" else column(c) for c in docs.columns),
            F.coalesce(F.size(split) - F.size(empty), F.lit(0)).cast("long").alias(n_lines),
            F.size(stay).cast("long").alias(n_kept),
        )
    )


DEDUPLICATED_SQL = f"""
with l as (
  select doc_id, text, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as i
  from documents
),
w as (
  select doc_id, line, (doc_id::hugeint << 32) + i as place,
         list_filter(string_split_regex(line, '[ \\t-\\r]+'), lambda x: x <> '') as w from l
),
d as (select w, len(w) as n, min(place) as place from w where len(w) > 0 group by w),
p as (select *, unnest(range(1, n + 1)) as i from d where n >= {LEAST_WORDS}),
h as (select place, md5(n || ':' || i || ':' || array_to_string(w[:i - 1] || [''] || w[i + 1:], ' ')) as key from p),
c as (select place, md5(array_to_string(w[:i - 1] || w[i + 1:], ' ')) as key from p where n > {LEAST_WORDS}),
f as (select place, md5(array_to_string(w, ' ')) as key from d where n >= {LEAST_WORDS}),
near as (
  select h.place from h join (select key, min(place) as first from h group by key) using (key) where first < place
  union
  select f.place from f join c using (key) where c.place < f.place
  union
  select c.place from c join f using (key) where f.place < c.place
),
s as (
  select w.*, len(w) > 0 as has_words,
         len(w) = 0 or (place in (select place from d) and place not in (select place from near)) as stays
  from w
)
select doc_id, coalesce(string_agg(line, chr(10) order by place) filter (stays), '') as text,
       count(*) filter (has_words) as n_lines, count(*) filter (has_words and stays) as n_kept
from s group by doc_id
"""
