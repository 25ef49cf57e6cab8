import random

import pytest
from newslake.llm import linededup

SCHEMA = "doc_id long, text string, near string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, edits=linededup.EDITS):
    """Texts and counts by comparing every line with every earlier one."""
    most = lambda n: next((k for least, k in reversed(edits) if n >= least), 0)
    lines = sorted(
        ((d, i, line) for d, text in docs for i, line in enumerate(text.split("\n"))),
        key=lambda x: x[:2],
    )
    stays = set()
    seen = []
    for d, i, line in lines:
        words = line.split()
        near = any(
            o == words or distance(o, words) <= most(min(len(o), len(words)))
            for o in seen
        )
        if not near or not words:
            stays.add((d, i))
        if words:
            seen.append(words)
    out = {}
    for d, text in docs:
        split = text.split("\n")
        kept = [i for i in range(len(split)) if (d, i) in stays]
        out[d] = (
            "\n".join(split[i] for i in kept),
            sum(1 for x in split if x.split()),
            sum(1 for i in kept if split[i].split()),
        )
    return out


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("ab" if seed % 2 else "abcdé") for _ in range(rng.randrange(0, 9)))
    docs = [(d, "\n".join(line() for _ in range(rng.randrange(1, 6)))) for d in range(60)]
    rows = spark.createDataFrame([(*d, "x") for d in docs], SCHEMA).repartition(5)
    found = linededup.deduplicated(rows).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in found} == brute(docs)
    assert all(r.near == "x" for r in found)


def test_nulls_blanks_and_repeated_rows(spark):
    long = "w " * 30_000 + "end"
    rows = [
        (None, "one two three four five", "a"),
        (1, None, None),
        (2, "", "b"),
        (3, "one two three four six\n\n\tx", "c"),
        (3, "one two three four six\n\n\tx", "c"),
        (4, long + "\nx", "d"),
        (5, long.replace("end", "END"), "e"),
        (6, " \t\n", "f"),
    ]
    found = linededup.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = sorted((r.doc_id or 0, r.text, r.n_kept) for r in found if r.doc_id != 1)
    assert texts == [
        (0, "one two three four five", 1), (2, "", 0), (3, "\n\tx", 1), (3, "\n\tx", 1),
        (4, long, 1), (5, "", 0), (6, " \t\n", 0),
    ]
    assert [r.text for r in found if r.doc_id == 1] == [None]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert linededup.deduplicated(empty).columns == ["doc_id", "text", "near", "n_lines", "n_kept"]
    assert linededup.deduplicated(empty).count() == 0


@pytest.mark.parametrize(
    "edits", [((1, 1), (4, 2)), ((3, 2),), ((2, 1), (5, 3), (7, 1)), ((6, 3),), ((2, 1),), ((3, 0),), ()]
)
def test_other_edits_against_brute_force(spark, edits):
    rng = random.Random(len(edits))
    line = lambda: " ".join(rng.choice("abcdefg") for _ in range(rng.randrange(0, 10)))
    docs = [(d, "\n".join(line() for _ in range(rng.randrange(1, 6)))) for d in range(60)]
    rows = spark.createDataFrame([(*d, "x") for d in docs], SCHEMA).repartition(5)
    found = linededup.deduplicated(rows, edits).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_kept) for r in found} == brute(docs, edits)


def test_two_edits_in_long_lines(spark):
    words = [f"w{i}" for i in range(30)]
    moved = ["new", *words[:11], *words[12:]]
    rows = [
        (1, " ".join(words), ""), (2, " ".join(words[:3] + ["x"] + words[4:20] + ["y"] + words[21:]), ""),
        (3, " ".join(moved), ""), (4, " ".join(["x", "y", "z"] + words[3:]), ""), (5, "w " * 20_000 + "a", ""),
        (6, "w " * 20_000 + "b", ""), (7, "w " * 20_000 + "a c", ""), (8, "w " * 20_000 + "b c d", ""),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = lambda edits: [r.doc_id for r in linededup.deduplicated(docs, edits).where("n_kept = 1").collect()]
    assert sorted(kept(((5, 1),))) == [1, 2, 3, 4, 5, 8]
    assert sorted(kept(((5, 1), (12, 2), (100, 0)))) == [1, 4, 5, 6, 7, 8]


def test_distance_bounds():
    rng = random.Random(5)
    for _ in range(5_000):
        left, right = ([rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(2))
        for most in range(5):
            assert linededup.within(left, right, most) == (distance(left, right) <= most)
