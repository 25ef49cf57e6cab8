import random

import corpus_pipeline
from newslake.llm import pii
from test_linededup import brute as brute_lines
from test_packing import check
from test_pii import brute as brute_spans
from test_simhash import brute_groups, brute_print

import __spark_entry__ as entry_points

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, kept int, line string"


def corpus(spark, folder):
    """Documents with toxic words, repeated lines, copies and addresses, and labels."""
    rng = random.Random(5)
    line = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(6, 14)))
    docs, labels, shared = [], [], [line() for _ in range(5)]
    for i in range(400):
        lines = [line() for _ in range(rng.randrange(2, 7))] + rng.sample(shared, i % 3)
        if i % 8 == 0:
            lines[0] += " grolk snarvel"
        if i % 11 == 0:
            lines.append(f"write to {line()} me{i}@mail.example.com {line()}")
        if i % 17 == 0 and i:
            lines = docs[i - 1][1].split("\n")
        text = "\n".join(lines)
        docs.append((i, text, "en", "s", len(text), 1, "x"))
        labels.append((i, 1, int("grolk" in text)))
    docs += [(1000, None, "en", "s", 0, 1, "x"), (1001, "", None, None, None, 1, "x")]
    spark.createDataFrame(docs, EXTRA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return {d[0]: d[1] for d in docs}


def test_every_stage_does_its_whole_work(spark, tmp_path):
    sf = str(tmp_path)
    texts = corpus(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, tables = docs.columns, []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{sf}/out/{i}")
        docs = spark.read.parquet(f"{sf}/out/{i}")
        tables.append(docs.collect())
        assert i == 4 or docs.columns == columns
    by_id = [{r.doc_id: r.text for r in rows} for rows in tables[:4]]
    assert by_id[0] == {i: t for i, t in texts.items() if "grolk" not in (t or "")}
    lines = brute_lines([(i, t) for i, t in by_id[0].items() if t is not None])
    assert by_id[1] == {i: lines[i][0] if t is not None else None for i, t in by_id[0].items()}
    groups = brute_groups({i: brute_print(t) for i, t in by_id[1].items()})
    assert by_id[2] == {i: t for i, t in by_id[1].items() if groups[i] == i}
    assert any("@" in (t or "") for t in by_id[2].values())
    automaton = pii._automaton()
    for i, text in by_id[3].items():
        assert not brute_spans(text or "")
        if by_id[2][i]:
            assert text == pii.masked_text(by_id[2][i], pii.find(by_id[2][i], automaton))
    for rows in tables[1:4]:
        assert all(r.text is None or r.n_chars == len(r.text) for r in rows)
    check(tables[4], by_id[3])
    key = lambda rows: sorted((r.doc_id, r.piece, r.ids_crc32, r.length) for r in rows)
    assert key(entry_points.queries()["pipeline"](spark, sf).collect()) == key(tables[4])


def test_stages_name_their_operators():
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_over_an_empty_table(spark, tmp_path, sf):
    docs = spark.createDataFrame([], EXTRA)
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf).count() == 0


def test_stages_with_clashing_names(spark, sf):
    names = ["score", "predicted", "component_id", "fingerprint", "n_lines", "n_kept", "spans", "near", "wanted", "_turn"]
    rows = [(1, "a b c d e f", *range(len(names))), (2, "a b c d e f", *range(len(names)))]
    schema = "doc_id long, text string, " + ", ".join(f"{n} int" for n in names)
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, sf).columns == docs.columns
    assert corpus_pipeline.STAGES[2][1](spark, docs, sf).count() == 1
