import random

import pytest

from plotcover.llm import chat
from plotcover.llm import queries as q
from tests.oracle_compare import compare

TREE = "conv_id long, node long, parent long, role string, text string, score double"


def test_oracle(spark, sf_dir):
    got = compare(spark, sf_dir, q.op3_chat_formatting, q.oracle_sql()["op3_chat_formatting"])
    assert got["hash_match"] and got["columns_match"] and got["rows_spark"] == 21


@pytest.mark.parametrize("seed", range(20))
def test_round_trip(seed):
    rng = random.Random(seed)
    pool = ["\\", "#", "###", "<", "/turn>", "</turn>", "\n", " ", "é", "### User: ", ":", "x", "="]
    turns = [(rng.choice(["user", "assistant", "system", "tool:x", "", "User", "=", "a###</turn>\\"]),
              "".join(rng.choice(pool) for _ in range(rng.randint(0, 12)))) for _ in range(6)]
    formatted, loss = chat.format_turns(turns)
    assert chat.parse_turns(formatted) == turns
    assert [chat.unescape(formatted[b:e]) for b, e in loss] == [t for r, t in turns if r == "assistant"]
    assert formatted.count(" </turn>\n") - formatted.count("\\</turn>\n") >= 0


def test_branches_by_score(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1),
            (1, 3, 1, "assistant", "good", 0.5), (1, 4, 3, "user", "more", 0.0),
            (1, 5, 4, "assistant", "end", 0.2), (1, 6, 4, "assistant", "end2", 0.2),
            (2, 1, 9, "user", "orphan", None), (3, 1, 2, "user", "cycle", 1.0),
            (3, 2, 1, "user", "cycle", 1.0), (None, 1, None, None, None, None),
            (1, 5, 4, "assistant", "end", 0.2)]
    nodes = spark.createDataFrame([r + ("x",) for r in rows], TREE + ", leaf string")
    got = {(r.conv_id, r.leaf): [t for _, t in chat.parse_turns(r.formatted)]
           for r in chat.format_conversations(nodes, branches=2).collect()}
    assert got == {(1, 5): ["q", "good", "more", "end"], (1, 6): ["q", "good", "more", "end2"],
                   (2, 1): ["orphan"], (None, 1): [""]}
    assert chat.format_conversations(nodes.limit(0)).collect() == []


def test_long_chain_and_ties(spark):
    n = 70
    rows = [(5, i, "assistant", f"t{i}" * 2000) for i in range(n)] + [(6, 1, "user", "b"), (6, 1, "user", "a")]
    nodes = chat.turn_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: chat.parse_turns(r.formatted) for r in chat.format_conversations(nodes).collect()}
    assert [t for _, t in got[5]] == [f"t{i}" * 2000 for i in range(n)]
    assert [t for _, t in got[6]] == ["a", "b"]
