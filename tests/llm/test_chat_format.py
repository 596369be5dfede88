"""Preference formatting against plain Python."""

import random

from strata.llm import chat_format as C
from strata.llm.common import table
from tests.conftest import SF_SMALL

TURN = "pair long, turn long, role string, text string"


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def mask(turns):
    at, out = 0, []
    for r, t in turns:
        end = at + len(render([(r, t)]))
        if r == "assistant":
            out.append((end - len(t) - len("<|im_end|>\n"), end))
        at = end
    return out


def expected(a, b):
    out = {}
    for p in set(a) & set(b):
        n = 0
        while n < min(len(a[p]), len(b[p])) and a[p][n] == b[p][n]:
            n += 1
        out[p] = (n, render(a[p][:n]), render(a[p][n:]), mask(a[p][n:]), render(b[p][n:]), mask(b[p][n:]))
    return out


def result(df):
    return {r["pair"]: (r["prompt_turns"], r["prompt"], r["chosen"], [tuple(s) for s in r["chosen_mask"]],
                        r["rejected"], [tuple(s) for s in r["rejected_mask"]]) for r in df.collect()}


def test_prefixes_and_masks_match_brute_force(spark):
    r = random.Random(4)
    a, b = {}, {}
    for p in range(60):
        shared = [(r.choice(["user", "assistant", "system"]), r.choice(["x", "yé日", "", "a b"])) for _ in range(r.randrange(4))]
        more = lambda: [(r.choice(["user", "assistant"]), r.choice(["x", "longer 日本", ""])) for _ in range(r.randrange(4))]  # noqa: E731,B023
        a[p], b[p] = shared + more(), shared + more()
    a, b = {p: t for p, t in a.items() if t}, {p: t for p, t in b.items() if t}

    def frame(side):  # turns out of order, with gaps
        rows = [(p, 3 * k - 5, *t) for p, turns in side.items() for k, t in enumerate(turns)]
        r.shuffle(rows)
        return spark.createDataFrame(rows, TURN)
    assert result(C.preference_pairs(frame(a), frame(b))) == expected(a, b)


def test_awkward_rows(spark):
    a = spark.createDataFrame([(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 0, "user", "later"), (1, 1, None, None), (None, 0, "user", "x"),
                               (2, None, "user", "x"), (3, 0, "user", "only here")], TURN).selectExpr("*", "1 as side", "2 as same", "3 as a")
    b = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, None, None), (None, 0, "user", "x"), (4, 0, "user", "only there")], TURN)
    got = result(C.preference_pairs(a, b))
    assert got == {1: (2, render([("user", "hi"), ("", "")]), "", [], "", [])}
    none = b.limit(0)
    assert result(C.preference_pairs(a, none)) == {} and result(C.preference_pairs(none, none)) == {}


def test_pairs_of_the_table(spark):
    chosen, rejected = C.paired_answers(table(spark, SF_SMALL, "conversations"))
    got = result(C.preference_pairs(chosen, rejected))
    talks = {}
    for r in table(spark, SF_SMALL, "conversations").orderBy("conv_id", "turn").collect():
        talks.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    last = {c: max((k for k, t in enumerate(turns) if t[0] == "assistant"), default=None) for c, turns in talks.items()}
    ids = sorted(c for c in talks if last[c] is not None)
    other = {c: c ^ 1 if last.get(c ^ 1) is not None else ids[(k + 1) % len(ids)] for k, c in enumerate(ids)}
    a = {c: talks[c][:last[c] + 1] for c in ids}
    b = {c: turns[:-1] + [("assistant", talks[other[c]][last[other[c]]][1])] for c, turns in a.items()}
    assert got == expected(a, b) and got


def test_no_answered_conversation_is_lost(spark):
    """Ids without an answered neighbour get the next answer in order, the last the first."""
    ids = [-7, 0, 4, 5, 8, 20, 21]  # 20 has no answer
    rows = [(c, 0, "user", f"q{c}") for c in ids] + [(c, 1, "assistant", f"a{c}") for c in ids if c != 20]
    other = {-7: 0, 0: 4, 4: 5, 5: 4, 8: 21, 21: -7}
    got = result(C.preference_pairs(*C.paired_answers(spark.createDataFrame(rows, TURN.replace("pair", "conv_id")))))
    assert got == expected({c: [("user", f"q{c}"), ("assistant", f"a{c}")] for c in other},
                           {c: [("user", f"q{c}"), ("assistant", f"a{o}")] for c, o in other.items()})
    even = spark.range(2000).selectExpr("id * 2 as pair")
    ring = {r["pair"]: r["next"] for r in C.next_in_order(even).collect()}
    assert ring == {2 * k: 2 * (k + 1) % 4000 for k in range(2000)}
    assert C.next_in_order(even.limit(1)).count() == 0 and C.next_in_order(even.limit(0)).count() == 0
