import math
import random
import re
from collections import Counter, defaultdict

import pytest
from newslake.llm import perplexity
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string"


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    found = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if found[w] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered))


def test_base_counts():
    rng = random.Random(1)
    texts = ["", " \n\t", "a", "é ü\n\né ü\n é ü", "a b\x1cc \x0bd", "日本 語🎉 <|>", "x " * 30]
    for _ in range(200):
        words = rng.choices("ab c# dé \n\n".split(" ") + ["f\n", "\n"], k=rng.randrange(60))
        texts.append(" ".join(words))
    for _ in range(100):
        part = rng.choices("abcdefghij", k=rng.randrange(6, 12))
        texts.append(" ".join(rng.choices("klmno", k=4) + part + rng.choices("klmno", k=5) + part))
    for text in texts:
        assert perplexity.base_counts(text) == brute_base(text), text


def brute_model(runs):
    """Probability of a run by the counts of all runs, written out."""
    order = perplexity.ORDER
    levels = {order: Counter(runs)}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(r[1:] for r in levels[k + 1])
    off = {}
    for k, level in levels.items():
        n = Counter(level.values())
        for i in (1, 2, 3):
            off[k, i] = i / 2
            if n[1] and n[i] and n[i + 1]:
                value = i - (i + 1) * n[1] / (n[1] + 2 * n[2]) * n[i + 1] / n[i]
                if 0 < value < i:
                    off[k, i] = value
    return levels, off


def brute_p(run, levels, off, size):
    if not run:
        return 1 / (size + 1)
    k, level = len(run), levels[len(run)]
    lower = brute_p(run[1:], levels, off, size)
    after = [c for r, c in level.items() if r[:-1] == run[:-1]]
    if not after:
        return lower
    c = level.get(run, 0)
    own = (c - off[k, min(c, 3)]) / sum(after) if c else 0
    return own + sum(off[k, min(c, 3)] for c in after) / sum(after) * lower


def some_docs(rng, n=60):
    words = {"en": "the then hen than that hat a at".split(), "fr": "le la les lé ça où".split(), None: ["x", "xy"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(words))
        rows.append((i, " ".join(rng.choices(words[lang], k=rng.randrange(1, 40))), lang, "s"))
    return rows


def test_model_is_the_written_out_one(spark):
    rows = some_docs(random.Random(2))
    docs = spark.createDataFrame(rows, SCHEMA)
    folds = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(2)).alias("f")).collect()}
    runs = defaultdict(list)
    own = {}
    for doc_id, text, lang, _ in rows:
        own[doc_id] = [text[i : i + perplexity.ORDER] for i in range(len(text) - perplexity.ORDER + 1)]
        runs[lang, folds[doc_id]] += own[doc_id]
    found = {r.doc_id: r for r in perplexity.scored(docs).collect()}
    for doc_id, _, lang, _ in rows:
        key = (lang, 1 - folds[doc_id])
        levels, off = brute_model(runs[key])
        size = len({r[-1] for f in (0, 1) for r in runs[lang, f]})
        surprise = [-math.log(brute_p(r, levels, off, size)) for r in own[doc_id]]
        assert found[doc_id].runs == len(surprise)
        assert found[doc_id].surprise == pytest.approx(sum(surprise) * 1e6, rel=1e-5, abs=10)
        assert found[doc_id].squares == pytest.approx(sum(s * s for s in surprise) * 1e6, rel=1e-5, abs=10)


def test_large_models_go_in_groups(spark, monkeypatch):
    docs = spark.createDataFrame(some_docs(random.Random(3)) + [(99, None, None, None), (99, "", "en", None)], SCHEMA)
    rows = lambda df: sorted(map(tuple, df.collect()))
    sent = rows(perplexity.scored(docs))
    monkeypatch.setattr(perplexity, "GROUP_CHARS", 400)
    assert rows(perplexity.scored(docs, sent_runs=0)) == sent


def test_pieces_of_long_texts(spark, monkeypatch):
    docs = spark.createDataFrame(some_docs(random.Random(4)), SCHEMA)
    rows = lambda df: sorted(map(tuple, df.collect()))
    whole = rows(perplexity.scored(docs))
    monkeypatch.setattr(perplexity, "_CHARS_AT_ONCE", 7)
    monkeypatch.setattr(perplexity, "_HELD_RUNS", 5)
    assert rows(perplexity.scored(docs)) == whole


def test_bands_reject_the_strange(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 7))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=80)), "en", "s") for i in range(300)]
    strange = "".join(rng.choices("qwxyz 0123456789", k=600))
    rows += [(300, strange, "en", "s"), (301, " ".join(words[:19]), "en", "s"), (302, words[0] + " ", "en", "s")]
    rows += [(303, " ".join(words[:10] * 9), "en", "s")]
    found = {r.doc_id: r for r in perplexity.judged(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(found[i].kept and not found[i].base_failed for i in range(300))
    assert not found[300].kept and not found[300].base_failed
    assert found[300].perplexity > found[300].high
    assert found[301].base_failed and found[302].base_failed and found[303].base_failed
    assert not any(found[i].kept for i in (301, 302, 303))


def test_tables(spark):
    empty = perplexity.judged(spark.createDataFrame([], SCHEMA))
    assert empty.columns[:6] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert empty.collect() == []
    long = "word " * 50_000 + "end"
    rows = [(1, long, "en", "s"), (1, long, "en", "s"), (None, None, None, None), (2, "", "en", "s"), (3, "abc", "xx", "s")]
    clashing = spark.createDataFrame([(*r, 1, "b", 0) for r in rows], SCHEMA + ", fold int, run string, Group int")
    found = perplexity.judged(clashing).collect()
    assert len(found) == 5
    by = {(r.doc_id, r.n_words): r for r in found}
    assert sum(r.doc_id == 1 for r in found) == 2 and by[1, 50_001].base_failed
    assert by[None, 0].perplexity is None and not by[None, 0].kept
    assert by[3, 1].base_failed and by[3, 1].perplexity is None
