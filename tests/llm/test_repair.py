import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import duckdb
import pytest

from plotcover.llm import queries as q
from plotcover.llm import repair

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield from [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """rows: (initial, doomed, truncated); the whole lattice by recursion."""
    n = len(rows)

    @lru_cache(None)
    def rest(at, said, inserts):
        options = []
        if at == n and re.fullmatch("(s?(ua)+)?", said):
            options.append((0, ""))
        if inserts:
            for role in "ua":
                if legal(said + role):
                    cost, audit = rest(at, state(said + role), inserts - 1)
                    options.append((cost + 3, "I" + audit))
        if at < n:
            initial, doomed, cut = rows[at]
            cost, audit = rest(at + 1, said, 2)
            options.append((cost + 4, "D" + audit))
            if not doomed:
                for letter, role, price in [("K", initial, 0), ("R", "u", 3), ("R", "a", 3)]:
                    if legal(said + role):
                        cost, audit = rest(at + 1, state(said + role), 2)
                        options.append((cost + price + 3 * cut, letter + audit))
        return min(options, default=(10 ** 9, ""))

    def legal(said):
        return bool(re.fullmatch("s?(ua)*u?", said)) and said != "" and len(said) <= 4

    def state(said):                       # enough of what was said to go on
        return {"s": "s", "u": "u", "su": "u", "ua": "ua", "uau": "u", "uaua": "ua"}.get(said, "ua" if said.endswith("a") else "u")

    return rest(0, "", 2)


def brute(rows, broken=damaged):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted(broken([r for r in rows if r[0] == conv]),
                     key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in own} - {None}
        seen, faults = set(), []
        for _, _, role, text in own:
            last = VISIBLE.findall(text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen
                          else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[2][:1] for r in own]
        cost, audit = cheapest(tuple((i, f in ("blank", "duplicate"), f == "truncated")
                                     for i, f in zip(initials, faults)))
        made, left, said = [], iter(own), 0
        for letter in audit:
            row = None if letter == "I" else next(left)
            if letter == "D":
                continue
            system = letter == "K" and row[2][:1] == "s"
            role = row[2] if letter == "K" else ("assistant" if said % 2 else "user")
            made.append(f"{role}:{row[3] if row else ''}")
            said += not system
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=str)


def result(frame):
    return sorted(map(tuple, frame.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string"


def test_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{sf_dir}/conversations.parquet'").fetchall()
    assert result(q.op12_conversation_repair(spark, sf_dir)) == brute(rows)


def test_two_heaps_find_the_least_audit():
    for n in range(6):
        for rows in itertools.product([("s", False, False), ("u", False, False), ("a", False, True),
                                       ("x", False, False), ("a", True, False)], repeat=n):
            got = repair.cheapest([repair.Row(*r) for r in rows], 0, repair.ENDS, True)
            assert (got[0], got[1].replace("J", "K")) == cheapest(rows)


def random_rows(rng, conversations, turns):
    texts = ["Yes.", "No!", "so", "", " \t", "Why?", "Tail. \n"] + [f"t{i}." for i in range(40)]
    return [(c, t, rng.choice(["system", "user", "user", "assistant", "assistant", "tool"]), rng.choice(texts))
            for c in range(conversations) for t in range(rng.randint(1, turns))]


@pytest.mark.parametrize("segment,fold,parts", [(3, 2, 7), (5, 3, 2), (512, 64, 16)])
def test_segments_of_long_conversations(spark, segment, fold, parts):
    rng = random.Random(segment)
    rows = random_rows(rng, 25, 12) + [(100, t, rng.choice(["user", "assistant"]), f"w{t % 90}.") for t in range(300)]
    frame = spark.createDataFrame(rng.sample(rows, len(rows)), SCHEMA).repartition(parts)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        done = repair.repair(frame, segment, fold)
        got = {r.conv_id: tuple(r)[1:] for r in done.summary.collect()}
        text = {r.conv_id: r.repaired_sha256 for r in repair.digests(done.turns).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    empty = hashlib.sha256(b"").hexdigest()
    assert sorted(((c, *v, text.get(c, empty)) for c, v in got.items()), key=str) == brute(rows, iter)


def test_nulls_empty_long_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, "user", "a."), (1, None, "assistant", "b."), (1, 5, None, None), (1, 3, "user", None),
            (None, 0, "user", "x."), (None, 0, "user", "x."), (None, None, None, "y."), (2, 1, "user", "z." * 300_000),
            (2, 1, "assistant", "  "), (2, 9, "", "q."), (3, 4, "system", "s."), (4, -2, "system", "s."),
            (4, 7, "assistant", "é? "), (5, 1, "user", "same."), (5, 1, "user", "same."), (5, 1, "user", "same."),
            (6, 1, "usher", "kept."), (6, 2, "aide", "kept too!")] + [(c, 0, "user", "q") for c in range(10, 60)]
    frame = spark.createDataFrame([r + (7, "m") for r in rows], SCHEMA + ", row long, seg string")
    assert result(repair.repair_damaged(frame.repartition(4))) == brute(rows)
    assert repair.repair_damaged(frame.limit(0)).collect() == []
    gone = spark.createDataFrame([r for r in rows if not list(damaged([r]))], SCHEMA)
    assert gone.count() and {tuple(r)[1:8] for r in repair.repair_damaged(gone).collect()} == {(0, 0, 0, 0, 0, 0, "")}
