import hashlib
import random
import re

import pytest
from newslake.llm import repair
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"


def brute_audit(symbols):
    """Least (cost, letters) per state, message by message."""
    to = {0: 2, 1: 2, 2: 3, 3: 2}

    def added(best):
        for _ in range(2):
            for state, (cost, letters) in list(best.items()):
                new = (cost + 5, letters + "I")
                best[to[state]] = min(best.get(to[state], (1e9, "")), new)
        return best

    best = {0: (0, "")}
    for symbol in symbols:
        after = {}

        def offer(state, cost, letters):
            after[state] = min(after.get(state, (1e9, "")), (cost, letters))

        for state, (cost, letters) in added(best).items():
            offer(state, cost + 2, letters + "D")
            if symbol != repair.GONE:
                role, extra = symbol // 2, 5 * (symbol % 2)
                if role == 0 and state == 0:
                    offer(1, cost + extra, letters + "K")
                if role in (1, 2) and to[state] == role + 1:
                    offer(to[state], cost + extra, letters + "K")
                offer(to[state], cost + 1 + extra, letters + "R")
        best = after
    best = added(best)
    return min(best[s] for s in (0, 3) if s in best)


def as_runs(symbols):
    runs = []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1] = (s, runs[-1][1] + 1)
        else:
            runs.append((s, 1))
    return runs


def test_audit():
    rng = random.Random(1)
    for _ in range(1500):
        few = rng.sample(range(9), rng.randrange(1, 5))
        symbols = [rng.choice(few) for _ in range(rng.randrange(14))]
        assert repair.audit(as_runs(symbols)) == brute_audit(symbols)


def test_long_runs(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(repair, "_UNROLLED", 7)
    for _ in range(40):
        symbols = [s for _ in range(rng.randrange(1, 5)) for s in [rng.randrange(9)] * rng.randrange(1, 90)]
        assert repair.audit(as_runs(symbols)) == brute_audit(symbols)


def test_packed_runs():
    runs = [[8, 1], [2, 127], [3, 128], [0, 300_000], [8, 1]]
    found = []
    repair._unpacked(repair._packed(runs), found)
    assert found == [tuple(r) for r in runs]
    repair._unpacked(repair._packed([[8, 2]]), found)
    assert found[-1] == (8, 3)


def brute(rows):
    """All results of one conversation from its messages in order."""
    seen, symbols, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        kind = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        symbols.append(8 if fault in ("blank", "duplicate") else 2 * kind + (fault == "truncated"))
    pairs = zip([r[1][:1] for r in rows], [r[1][:1] for r in rows[1:]])
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, letters = brute_audit(symbols)
    out, left = [], list(rows)
    for letter in letters:
        _, role, text = (None, "", "") if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        system = out and out[0].startswith("s") and out[0].split(":")[0] not in ("user", "assistant")
        if letter != "K":
            role = "assistant" if (len(out) - bool(system)) % 2 else "user"
        out.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    return gaps, *counts.values(), illegal, cost, letters, digest


def results(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_conversations(spark):
    rng = random.Random(3)
    rows, expected = [], {}
    for conv in range(60):
        found = []
        turn = rng.randrange(-2, 3)
        for _ in range(rng.randrange(0 if conv else 400, 12 if conv else 401)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", ""])
            text = rng.choice(["Yes.", "No", "", " \t", "é!\n", "Why?", f"n{rng.randrange(30)}."])
            found.append((turn, role, text))
            turn += rng.choice([1, 1, 1, 2, 4])
        if found and conv % 5 == 0:
            found[0] = (None, *found[0][1:])
        rows += [(conv, *r) for r in found]
        if found:
            expected[conv] = brute(found)
    rng.shuffle(rows)
    messages = repair.messages(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert results(repair.repairs(messages)) == expected


def test_hot_conversation_in_many_ranges(spark):
    found = [(i, ["user", "assistant"][i % 2], f"{i % 997}." if i % 11 else "cut") for i in range(6000)]
    messages = repair.messages(spark.createDataFrame([(5, *r) for r in found] + [(6, 0, "user", "Hi.")], SCHEMA))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = repair.marked(messages).repartitionByRange(*repair._order())
        assert parts.where("conv_id = 5").select(F.spark_partition_id()).distinct().count() > 4
        got = results(repair.repairs(messages))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[5] == brute(found) and got[6] == brute([(0, "user", "Hi.")])


def test_equal_turns_and_repeated_rows(spark):
    rows = [(1, 0, "user", "A."), (1, 0, "user", "A."), (1, 0, "assistant", "B."), (1, 1, "assistant", "A."), (1, 1, "user", "A.")]
    got = results(repair.repairs(repair.messages(spark.createDataFrame(rows, SCHEMA))))
    in_order = sorted((t, r, x) for _, t, r, x in rows)
    assert got[1] == brute(in_order)


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "Q?"), (1, 2, "user", "R?"), (1, 3, "assistant", "A.")]
    messages = repair.messages(spark.createDataFrame(rows, SCHEMA))
    audited = repair.audits(messages)
    assert audited.first().audit == "KDKK"
    written = [tuple(r) for r in repair.repaired(messages, audited).collect()]
    assert written == [(1, 0, "K", "system", "S."), (1, 1, "K", "user", "R?"), (1, 2, "K", "assistant", "A.")]


def test_tables(spark):
    empty = repair.repairs(repair.damaged(spark.createDataFrame([], SCHEMA)))
    assert empty.columns == [*repair._names(repair._AUDIT), "repaired_sha256"] and empty.collect() == []
    long = "x" * 300_000 + "."
    rows = [(None, None, None, None), (None, 1, "user", None), (2, None, "user", long), (2, None, "assistant", "ok."), (3, 1, None, "t.")]
    clashing = spark.createDataFrame([(*r, 1, "k", "b") for r in rows], SCHEMA + ", copies int, Kind string, same string")
    got = results(repair.repairs(repair.messages(clashing)))
    assert got[None] == brute([(None, " ", " "), (1, "user", " ")])
    assert got[2] == brute([(None, "assistant", "ok."), (None, "user", long)])
    assert got[3] == brute([(1, " ", "t.")])


def test_nothing_left(spark):
    ids = spark.range(400).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'Hi.' as text")
    gone = [r.conv_id for r in repair.damaged(ids).where("copies = 0").collect()]
    assert gone
    got = results(repair.repairs(repair.damaged(ids)))
    assert len(got) == 400
    assert got[gone[0]] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


@pytest.mark.parametrize("symbol", range(9))
def test_powers(symbol):
    once = repair.power(symbol, 0)
    many = once
    for _ in range(7):
        many = repair._product(many, once)
    assert many == repair.power(symbol, 3)
