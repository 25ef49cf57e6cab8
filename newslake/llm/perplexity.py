"""Quality rules with an n-gram perplexity.

Base rules count words, symbols, repeated lines and repeated runs of words.
Beside them stands a language model: modified Kneser-Ney over runs of
``ORDER`` characters, white space written as one blank, one model per language.
Characters rather than words, because their runs are far fewer than the text is
long, whatever its vocabulary: tasks add up their own before the shuffle.

All documents are counted, in two folds by a hash of the text, so that copies
share a fold, and each fold is scored by the counts of the other. So no text is
judged by what it taught, and every run that has to be looked up is known
beforehand: its probability, lower orders included, is worked out once per run
of characters in joins. What comes out is the model, hashes in order with a log
probability beside each, per language and fold.

A text's perplexity is judged by its language's band: the median of all distinct
texts, ``WIDTH`` median deviations to either side (``LEAST_WIDTH`` at least), and
``NOISE`` standard errors for the text's own length.

The model is sent to every task up to ``SENT_RUNS`` runs, which are counted. A
larger one goes, in the order of its hashes, only where it is needed: documents
are dealt to groups of about ``GROUP_CHARS`` characters, and each group meets
the runs that it holds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import checkpointed, to_python

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 4
WIDTH = 8.0
LEAST_WIDTH = 0.1
NOISE = 4.0
LEAST_WORDS = 20
MOST_REPEATED = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
SENT_RUNS = 4_000_000
GROUP_CHARS = 16_000_000
_CHARS_AT_ONCE = 1 << 21
_HELD_RUNS = 1 << 20
_BIN = 0.001
_MICRO = 1_000_000
#: One odd number per place in a run; a run's hash is the sum of its products,
#: mixed so that its leading bits are even.
_FACTORS = np.random.default_rng(13).integers(0, 1 << 63, ORDER, np.uint64) * 2 + 1

_MIX = np.uint64(0x9E3779B97F4A7C15)

_COUNTED = "lang string, fold int, run string, n long"
_SCORED = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, runs long, surprise long, squares long"
)


# Base rules


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in a window that is found twice or more."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.uint64)
    factors = np.random.default_rng(window).integers(0, 1 << 63, window, np.uint64) * 2 + 1
    n = len(ids) - window + 1
    hashes = sum(ids[j : j + n] * factors[j] for j in range(window))
    ranked = np.sort(hashes)
    if (ranked[1:] != ranked[:-1]).all():
        return 0
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    some = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    seen: dict[bytes, list[int]] = {}
    for i in some.tolist():  # equal hashes are looked at word by word
        seen.setdefault(ids[i : i + window].tobytes(), []).append(i)
    starts = [i for places in seen.values() if len(places) > 1 for i in places]
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, np.array(starts, np.int64) + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines, repeated words."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    # Every byte but those that continue a character starts one.
    inside = sum(map(len, words))
    chars = inside if raw.isascii() else inside - (len(raw) - len(text))
    return (
        len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)), repeated_words(words),
    )


# Runs of characters


def characters(text: str) -> np.ndarray:
    """Code points, every run of white space as one blank."""
    return np.frombuffer(b" ".join(text.encode().split()).decode().encode("utf-32-le"), "<u4")


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The texts' characters in pieces of bounded size: characters, places at
    which a whole run starts, and the number of the text at each such place."""
    held, size = [], 0
    for number, text in enumerate(texts):
        chars = characters(text)
        step = _CHARS_AT_ONCE
        for at in range(0, max(0, len(chars) - ORDER + 1), step):
            part = chars[at : at + step + ORDER - 1]
            held.append((number, part))
            size += len(part)
            if size >= step:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(part) for _, part in held])
    owners = np.repeat([number for number, _ in held], lengths - ORDER + 1)
    # Each text before a run ends with ORDER - 1 places at which none starts.
    skipped = np.repeat(np.arange(len(held)) * (ORDER - 1), lengths - ORDER + 1)
    places = np.arange(len(owners)) + skipped
    return np.concatenate([part for _, part in held]), places, owners


def run_hashes(chars: np.ndarray, places: np.ndarray) -> np.ndarray:
    wide = chars.astype(np.uint64)
    n = len(wide) - ORDER + 1
    total = wide[:n] * _FACTORS[0]
    for j in range(1, ORDER):
        total += wide[j : j + n] * _FACTORS[j]
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total[places].view(np.int64)


def written_hashes(runs: list[str]) -> np.ndarray:
    """The same hashes, of runs as strings."""
    chars = np.frombuffer("".join(runs).encode("utf-32-le"), "<u4")
    return run_hashes(chars, np.arange(0, len(chars), ORDER))


class _Counts:
    """Runs counted in one task, in bounded space, for one language and fold."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, texts: list[str]) -> None:
        for chars, places, _ in pieces(texts):
            hashes = run_hashes(chars, places)
            _, first, n = np.unique(hashes, return_index=True, return_counts=True)
            rows = np.lib.stride_tricks.sliding_window_view(chars, ORDER)[places[first]]
            self.parts.append((hashes[first], n, rows))
            if sum(len(p[0]) for p in self.parts) > 2 * _HELD_RUNS:
                self._merge()

    def _merge(self) -> None:
        hashes, n, rows = (np.concatenate(c) for c in zip(*self.parts))
        unique, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(where, n, len(unique)).astype(np.int64)
        self.parts = [(unique, total, rows[first])]

    def taken(self) -> tuple[list[str], np.ndarray]:
        """The runs and their counts so far, and none from then on."""
        if not self.parts:
            return [], np.zeros(0, np.int64)
        self._merge()
        _, n, rows = self.parts.pop()
        text = np.ascontiguousarray(rows).tobytes().decode("utf-32-le")
        return [text[i : i + ORDER] for i in range(0, len(text), ORDER)], n

    def full(self) -> bool:
        return bool(self.parts) and len(self.parts[0][0]) > _HELD_RUNS


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, int], _Counts] = {}

    def out(key: tuple[str, int]) -> Iterator[pa.RecordBatch]:
        runs, n = held.pop(key).taken()
        for at in range(0, len(runs), 50_000):
            some = runs[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key[0]] * len(some)), pa.array([key[1]] * len(some), pa.int32()),
                    pa.array(some), pa.array(n[at : at + 50_000]),
                ],
                ["lang", "fold", "run", "n"],
            )

    for batch in batches:
        texts: dict[tuple[str, int], list[str]] = {}
        for lang, fold, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "fold", "text"))):
            texts.setdefault((lang, fold), []).append(text)
        for key, some in texts.items():
            held.setdefault(key, _Counts()).add(some)
        # Each language holds a bounded number of runs, and so do all together.
        full = [key for key, counts in held.items() if counts.full()]
        if sum(len(p[0]) for c in held.values() for p in c.parts) > 4 * _HELD_RUNS:
            full = list(held)
        for key in full:
            yield from out(key)
    for key in list(held):
        yield from out(key)


# The model


def _discounts(level: DataFrame) -> DataFrame:
    """Per language, what is taken from counts of 1, 2 and 3 or more in either
    fold; where too few runs have the counts that decide it, the usual halves."""
    many = [
        F.count_if(F.col(f"c{f}") == i).alias(f"n{f}{i}") for f in (0, 1) for i in (1, 2, 3, 4)
    ]
    found = level.groupBy("lang").agg(*many)

    def taken(fold: int, i: int) -> Column:
        n = lambda j: F.col(f"n{fold}{j}")
        share = n(1) / (n(1) + 2 * n(2))
        value = F.when((n(1) > 0) & (n(i) > 0) & (n(i + 1) > 0), i - (i + 1) * share * n(i + 1) / n(i))
        usual = F.lit(i / 2)
        return F.when((value > 0) & (value < i), value).otherwise(usual).alias(f"d{fold}{i}")

    return found.select("lang", *[taken(f, i) for f in (0, 1) for i in (1, 2, 3)])


def _off(fold: int, count: Column) -> Column:
    d = [F.col(f"d{fold}{i}") for i in (1, 2, 3)]
    return F.when(count == 0, 0.0).when(count == 1, d[0]).when(count == 2, d[1]).otherwise(d[2])


def _left(level: DataFrame, length: int) -> DataFrame:
    """Per context, its total and the share that is left to lower orders."""
    discounts = _discounts(level)
    context = F.substring("run", 1, length - 1).alias("context")
    sums = []
    for f in (0, 1):
        c = F.col(f"c{f}")
        sums += [F.sum(c).alias(f"t{f}"), *(F.count_if(c == i).alias(f"k{f}{i}") for i in (1, 2))]
        sums += [F.count_if(c >= 3).alias(f"k{f}3")]
    found = level.groupBy("lang", context).agg(*sums).join(discounts, "lang")
    rest = [
        F.when(F.col(f"t{f}") > 0, sum(F.col(f"d{f}{i}") * F.col(f"k{f}{i}") for i in (1, 2, 3)) / F.col(f"t{f}"))
        .otherwise(1.0).alias(f"rest{f}")
        for f in (0, 1)
    ]
    kept = [f"d{f}{i}" for f in (0, 1) for i in (1, 2, 3)]
    return found.select("lang", "context", "t0", "t1", *rest, *kept)


def _level(length: int, level: DataFrame, lower: DataFrame | None) -> DataFrame:
    """Probabilities ``p0, p1`` of each run's last character after the others, by
    the counts of either fold. ``lower`` has those of runs one shorter."""
    known = level.withColumns(
        {"context": F.substring("run", 1, length - 1), "shorter": F.substring("run", 2, length)}
    ).join(_left(level, length), ["lang", "context"])
    if lower is None:  # what is left goes to all characters alike, and to one not seen
        size = level.groupBy("lang").agg(F.count("*").alias("chars"))
        known = known.join(size, "lang").withColumns(
            {f"q{f}": 1 / (F.col("chars") + 1) for f in (0, 1)}
        )
    else:
        known = known.join(
            lower.select("lang", F.col("run").alias("shorter"), F.col("p0").alias("q0"), F.col("p1").alias("q1")),
            ["lang", "shorter"],
        )
    p = [
        F.coalesce(F.try_divide(F.col(f"c{f}") - _off(f, F.col(f"c{f}")), F.col(f"t{f}")), F.lit(0.0))
        + F.col(f"rest{f}") * F.col(f"q{f}")
        for f in (0, 1)
    ]
    return known.select("lang", "run", p[0].alias("p0"), p[1].alias("p1"))


def counts(docs: DataFrame) -> DataFrame:
    """``lang, run, c0, c1``: how often each run of characters is in either fold
    of ``lang, fold, text``."""
    found = to_python(docs.select("lang", "fold", "text")).mapInArrow(_counted, _COUNTED)
    per_fold = [F.sum(F.when(F.col("fold") == f, F.col("n")).otherwise(0)).alias(f"c{f}") for f in (0, 1)]
    return found.groupBy("lang", "run").agg(*per_fold)


def probabilities(counted: DataFrame) -> DataFrame:
    """``lang, run, p0, p1`` of all counted runs, by modified Kneser-Ney: lower
    orders count the different characters before a run instead of its places."""
    levels = {ORDER: counted}
    for length in range(ORDER - 1, 0, -1):
        shorter = F.substring("run", 2, length).alias("run")
        before = [F.count_if(F.col(f"c{f}") > 0).alias(f"c{f}") for f in (0, 1)]
        levels[length] = checkpointed(levels[length + 1].groupBy("lang", shorter).agg(*before))
    found = None
    for length in range(1, ORDER + 1):
        found = _level(length, levels[length], found)
        if length < ORDER:
            found = checkpointed(found)
    return found


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = written_hashes(batch.column("run").to_pylist())
        columns = [batch.column(c) for c in ("lang", "fold")]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(hashes), batch.column("logp")], ["lang", "fold", "hash", "logp"]
        )


def model(counted: DataFrame) -> DataFrame:
    """``lang, fold, hash, logp``: what texts of a fold need, by the other's counts."""
    found = probabilities(counted).join(counted, ["lang", "run"])
    sides = [
        found.where(F.col(f"c{f}") > 0).select(
            "lang", F.lit(f).alias("fold"), "run", F.log(f"p{1 - f}").cast("float").alias("logp")
        )
        for f in (0, 1)
    ]
    return sides[0].union(sides[1]).mapInArrow(_hashed, "lang string, fold int, hash long, logp float")


class Sorted:
    """Hashes in order, with a value beside each; where the hashes that begin
    with some bits start is kept, so that few steps find any."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        unsigned = hashes.view(np.uint64)
        order = np.argsort(unsigned)
        self.hashes, self.values = unsigned[order], values[order]
        self.shift = np.uint64(64 - max(1, len(hashes).bit_length()))
        starts = np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift
        self.starts = np.searchsorted(self.hashes, starts).astype(np.int32)

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        """Values of hashes that are all there."""
        wanted = hashes.view(np.uint64)
        at = self.starts[wanted >> self.shift]
        behind = np.flatnonzero(self.hashes[at] != wanted)
        while len(behind):
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] != wanted[behind]]
        return self.values[at]


Tables = dict[tuple[str, int], Sorted]


def sorted_arrays(rows: pa.Table) -> Tables:
    """Hashes in order and log probabilities, per language and fold."""
    hashes, logps = rows["hash"].to_numpy(), rows["logp"].to_numpy()
    langs = rows["lang"].combine_chunks().dictionary_encode()
    numbers = langs.indices.to_numpy() * 2 + rows["fold"].to_numpy()
    names = langs.dictionary.to_pylist()
    out = {}
    for number in np.unique(numbers):
        own = numbers == number
        out[names[number // 2], int(number % 2)] = Sorted(hashes[own], logps[own])
    return out


def surprises(texts: list[str], table: Sorted | None) -> np.ndarray:
    """Per text: runs, the sum of their negative log probabilities, and of its squares."""
    sums = np.zeros((3, len(texts)))
    for chars, places, owners in pieces(texts):
        found = -table[run_hashes(chars, places)].astype(np.float64)
        for row, weights in zip(sums, (None, found, found**2)):
            row += np.bincount(owners, weights, len(texts))
    return sums


def _rows(batch: pa.RecordBatch, tables: Tables) -> pa.RecordBatch:
    ids, langs, folds, texts = (batch.column(c).to_pylist() for c in ("doc_id", "lang", "fold", "text"))
    sums = np.zeros((3, len(texts)))
    groups: dict[tuple[str, int], list[int]] = {}
    for i, key in enumerate(zip(langs, folds)):
        groups.setdefault(key, []).append(i)
    for key, rows in groups.items():
        sums[:, rows] = surprises([texts[i] for i in rows], tables.get(key))
    base = np.array([base_counts(t) for t in texts], np.int64).reshape(-1, 5)
    whole = [sums[0], np.round(sums[1] * _MICRO), np.round(sums[2] * _MICRO)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.array(langs, pa.string()), *map(pa.array, base.T.copy()),
            *(pa.array(c.astype(np.int64)) for c in whole),
        ],
        [c.split()[0] for c in _SCORED.split(", ")],
    )


def _sent(docs: DataFrame, found: DataFrame) -> DataFrame:
    tables = docs.sparkSession.sparkContext.broadcast(sorted_arrays(found.toArrow()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows(batch, tables.value)

    return to_python(docs).mapInArrow(run, _SCORED)


def _in_groups(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents and the runs that they hold, in groups of bounded size."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    groups = max(1, -(-chars // GROUP_CHARS))
    dealt = docs.withColumn("group", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: dict[tuple, list[str]] = {}
            for *key, text in zip(*(batch.column(c).to_pylist() for c in ("group", "lang", "fold", "text"))):
                keys.setdefault(tuple(key), []).append(text)
            for (group, lang, fold), texts in keys.items():
                for chars, places, _ in pieces(texts):
                    hashes = np.unique(run_hashes(chars, places))
                    n = len(hashes)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([group] * n, pa.int64()), pa.array([lang] * n, pa.string()),
                            pa.array([fold] * n, pa.int32()), pa.array(hashes),
                        ],
                        ["group", "lang", "fold", "hash"],
                    )

    needed = to_python(dealt).mapInArrow(held, "group long, lang string, fold int, hash long").distinct()
    parts = needed.join(found, ["lang", "fold", "hash"]).select(
        "group", F.lit(0).alias("kind"), "lang", "fold", "hash", "logp",
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"),
    ).union(
        dealt.select(
            "group", F.lit(1), "lang", "fold", F.lit(None).cast("long"), F.lit(None).cast("float"), "doc_id", "text"
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, tables = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("group", "kind")], axis=1)
            turns = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *turns], [*turns, len(keys)]):
                now, kind = keys[start]
                if now != group:
                    group, held, tables = now, [], None
                some = batch.slice(start, end - start)
                if not kind:
                    held.append(some.select(["lang", "fold", "hash", "logp"]))
                    continue
                if tables is None:
                    tables = sorted_arrays(pa.Table.from_batches(held)) if held else {}
                    held = []
                yield _rows(some, tables)

    order = ["group", "kind"]
    return parts.repartition("group").sortWithinPartitions(*order).mapInArrow(run, _SCORED)


# Verdicts


def _median(weighted: DataFrame, value: str, name: str) -> DataFrame:
    """Per language, the smallest value that half of the weight ``n`` reaches."""
    upto = Window.partitionBy("lang").orderBy(value)
    sums = weighted.withColumns(
        {"upto": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("lang"))}
    )
    return sums.where("2 * upto >= all").groupBy("lang").agg(F.min(value).alias(name))


def bands(scores: DataFrame, width: float = WIDTH, least_width: float = LEAST_WIDTH) -> DataFrame:
    """``lang, low, high, spread``: the band of the mean surprise, and the
    standard deviation of a single run's. Every distinct text counts once. The
    medians are exact to a thousandth, taken from counts per thousandth."""
    texts = scores.where("runs > 0").select("lang", "runs", "surprise", "squares").distinct()
    mean = F.col("surprise") / F.col("runs") / _MICRO
    bins = checkpointed(
        texts.groupBy("lang", F.round(mean / _BIN).cast("long").alias("bin"))
        .agg(
            F.count("*").alias("n"), F.sum("runs").alias("runs"),
            F.sum(F.col("surprise").cast("decimal(38,0)")).alias("surprise"),
            F.sum(F.col("squares").cast("decimal(38,0)")).alias("squares"),
        )
    )
    middle = _median(bins, "bin", "middle")
    away = bins.join(middle, "lang").groupBy("lang", F.abs(F.col("bin") - F.col("middle")).alias("away"))
    deviation = _median(away.agg(F.sum("n").alias("n")), "away", "deviation")
    double = lambda c: F.sum(c).cast("double")
    spread = bins.groupBy("lang").agg(
        F.sqrt(
            F.greatest(
                double("squares") / F.sum("runs") / _MICRO
                - F.pow(double("surprise") / F.sum("runs") / _MICRO, F.lit(2)),
                F.lit(0.0),
            )
        ).alias("spread")
    )
    half = F.greatest(F.col("deviation") * _BIN * width, F.lit(least_width))
    return (
        middle.join(deviation, "lang").join(spread, "lang")
        .select(
            "lang", (F.col("middle") * _BIN - half).alias("low"),
            (F.col("middle") * _BIN + half).alias("high"), "spread",
        )
    )


def scored(docs: DataFrame, sent_runs: int = SENT_RUNS) -> DataFrame:
    """Base counts of every row of ``doc_id, lang, text`` with the number of runs
    and their summed surprise, in millionths of a natural unit."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.pmod(F.xxhash64(text), F.lit(2)).cast("int").alias("fold"),
        text.alias("text"),
    )
    counted = checkpointed(counts(rows))
    found = checkpointed(model(counted))
    return (_sent if found.count() <= sent_runs else _in_groups)(rows, found)


def judged(
    docs: DataFrame,
    width: float = WIDTH,
    least_width: float = LEAST_WIDTH,
    noise: float = NOISE,
    sent_runs: int = SENT_RUNS,
) -> DataFrame:
    """``doc_id``, the base counts, ``perplexity``, the ``low`` and ``high`` that
    it may have, ``base_failed`` and ``kept`` for every row, repeated ones
    included.

    A null text is empty and fails the base rules, as every text of under
    ``LEAST_WORDS`` words does. A text too short for a run has no perplexity, and
    the base rules alone decide. Texts without a language are one language.
    Other columns are ignored; an empty table gives no rows.
    """
    scores = checkpointed(scored(docs, sent_runs))
    held = scores.join(bands(scores, width, least_width), "lang", "left")
    mean = F.try_divide(F.col("surprise") / _MICRO, F.col("runs"))
    slack = noise * F.try_divide(F.col("spread"), F.sqrt("runs"))
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    outside = F.coalesce((mean < F.col("low") - slack) | (mean > F.col("high") + slack), F.lit(False))
    return held.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.exp(mean).alias("perplexity"), F.exp(F.col("low") - slack).alias("low"),
        F.exp(F.col("high") + slack).alias("high"),
        failed.alias("base_failed"), (~failed & ~outside).alias("kept"),
    )

