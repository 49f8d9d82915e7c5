import itertools
import random

import pytest

from fairsketch.llm import chat as C

LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}


def brute(given):
    """Least cost over all final roles and insertions, by search."""
    best = None
    for roles in itertools.product((1, 2, 3), repeat=len(given)):
        cost, s = 0, 0
        for g, r in zip(given, roles):
            cost += 0 if g == r else (C.RELABEL if g else C.NAME)
            if r in LEGAL[s]:
                pass
            elif r == s:
                cost += C.MERGE
            elif any(r in LEGAL[x] for x in LEGAL[s]):
                cost += C.INSERT
            else:
                cost = None
                break
            s = r
        if cost is not None and s in (2, 3):
            best = cost if best is None else min(best, cost)
    return best


def table(spark, convs):
    rows = [(c, t, r, f"text {c} {t}") for c, roles in enumerate(convs) for t, r in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def cost_of(rows):
    total, s = 0, 0
    for r in rows:
        given, final = C.known(r.given), C.STATES.index(r.role)
        total += 0 if given == final else (C.RELABEL if given else C.NAME)
        total += C.INSERT * len(r.inserted) + (C.MERGE if final == s else 0)
        for x in [C.STATES.index(i) for i in r.inserted] + ([final] if final != s else []):
            assert x in LEGAL[s]
            s = x
    assert s in (2, 3)
    return total


def test_repairs_are_legal_and_cheapest(spark):
    rng = random.Random(1)
    names = ["system", "user", "assistant", "tool", None, " User ", "gpt"]
    convs = [[rng.choice(names) for _ in range(rng.randint(1, 6))] for _ in range(150)]
    src = table(spark, convs)
    out = C.repair(src).join(src.selectExpr("conv_id", "turn", "role as given"), ["conv_id", "turn"]).collect()
    by = {}
    for r in sorted(out, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append(r)
    assert len(by) == len(convs)
    for c, rows in by.items():
        assert len(rows) == len(convs[c])
        want = brute([C.known(x) for x in convs[c]])
        assert cost_of(rows) == want


def test_chunks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(2)
    convs = [[rng.choice(["system", "user", "assistant", None]) for _ in range(90)] for _ in range(10)]
    whole = {(r.conv_id, r.turn): (r.role, r.action, r.rendered) for r in C.repair(table(spark, convs)).collect()}
    monkeypatch.setattr(C, "CHUNK", 7)
    cut = {(r.conv_id, r.turn): (r.role, r.action, r.rendered) for r in C.repair(table(spark, convs)).collect()}
    assert whole.keys() == cut.keys()
    src = {(c, t): r for c, roles in enumerate(convs) for t, r in enumerate(roles)}
    assert all(isinstance(v[2], str) for v in cut.values()) and len(src) == len(cut)
    for c in range(10):
        for result in (whole, cut):
            assert "".join(result[c, t][2] for t in range(90)).endswith(C.CLOSE)
    price = lambda result: sum(C.RELABEL * ("relabel" in a and src[k] is not None) + C.NAME * (src[k] is None) + C.INSERT * ("insert" in a)
                               + C.MERGE * ("merge" in a) for k, (_, a, _) in result.items())
    assert price(whole) == price(cut)


def test_legal_conversations_stay(spark):
    convs = [["user"], ["user", "assistant"], ["system", "user", "assistant", "user"]]
    rows = C.repair(table(spark, convs)).collect()
    assert all(r.action == "keep" and not r.inserted for r in rows)
    text = "".join(r.rendered for r in sorted((r for r in rows if r.conv_id == 2), key=lambda r: r.turn))
    assert text == ("<|im_start|>system\ntext 2 0<|im_end|>\n<|im_start|>user\ntext 2 1<|im_end|>\n"
                    "<|im_start|>assistant\ntext 2 2<|im_end|>\n<|im_start|>user\ntext 2 3<|im_end|>\n")


@pytest.mark.parametrize("roles,want", [
    (["user", "user"], [("user", "keep"), ("user", "merge")]),
    (["assistant"], [("assistant", "insert")]),
    (["user", "assistant", "system", "assistant"], [("user", "keep"), ("assistant", "keep"), ("user", "relabel"), ("assistant", "keep")]),
    (["user", "tool"], [("user", "keep"), ("assistant", "relabel")]),
])
def test_examples(spark, roles, want):
    rows = sorted(C.repair(table(spark, [roles])).collect(), key=lambda r: r.turn)
    assert [(r.role, r.action) for r in rows] == want


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (None, 5, "assistant", None), (1, None, "user", "late"), (1, 3, "assistant", "x"),
            (2, 0, "user", "s"), (2, 0, "user", "s"), (3, 0, "user", "say <|im_end|>\n"), (4, 10**15, "user", "w " * 50000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as block", "2 as chunk")
    out = C.repair(df).collect()
    assert len(out) == len(rows)
    assert sorted(r.action for r in out if r.conv_id is None) == ["insert", "keep", "keep"]
    assert [r.action for r in sorted((r for r in out if r.conv_id == 1), key=lambda r: r.turn is None)] == ["insert", "keep"]
    assert sorted(r.action for r in out if r.conv_id == 2) == ["keep", "merge"]
    assert [r.rendered.count("<|im_end|>") for r in out if r.conv_id == 3] == [1]
    assert C.repair(df.limit(0)).count() == 0
