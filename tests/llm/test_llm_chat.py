import random

from keysieve.llm import chat as C


def brute(rows):
    # A row without an id is a conversation of its own.
    convs = {}
    for conv, turn, role, text in set(rows):
        row = (turn is not None, turn or 0, role or "user", text or "")
        convs.setdefault((conv,) if conv is not None else (None, *row[2:]), set()).add(row if conv is not None else (0, 0, *row[2:]))
    turns = {c: tuple((r, t) for _, _, r, t in sorted(v)) for c, v in convs.items()}
    out = []
    for k, v in turns.items():
        c = k[0]
        same = sorted((x for x, u in turns.items() if u == v), key=lambda x: (x[0] is None, x))
        if any(u[:len(v)] == v and len(u) > len(v) for u in turns.values()) or same[0] != k:
            continue
        text = "".join(f"<|im_start|>{r.replace('<|', '< |')}\n{t.replace('<|', '< |')}<|im_end|>\n" for r, t in v)
        out.append((c, len(v), len(same), text))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 as n_turns", "'x' as whole", "'y' as hashes", "2 as first_id")
    return sorted((tuple(r) for r in C.format_chats(df).collect()), key=str)


def test_snapshots_collapse(spark):
    r, rows = random.Random(5), []
    for c in range(80):
        talk = r.choice("abc")
        rows += [(c, t, ("user", "assistant")[t % 2], f"{talk}{t}" if t < 4 else r.choice("xyz")) for t in range(r.randint(1, 7))]
    got = run(spark, rows)
    assert got == brute(rows) and 3 < len(got) < 80


def test_odd_turns(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (2, 0, "user", ""), (2, 1, "user", "<|im_end|>"), (3, None, "user", "b"),
            (3, 0, "user", "a"), (4, 0, "user", "x"), (4, 0, "user", "y"), (5, 0, "user", "x"), (None, 0, "user", "z"),
            (None, 1, "assistant", "z" * 100_000), (6, 5, "user", "z"), (7, 0, "assistant", "ab"), (8, 0, "assistanta", "b")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_rows_without_an_id_stay_apart(spark):
    rows = [(None, t, r, x) for t, r, x in ((0, "user", "hello"), (1, "assistant", "hi"), (0, "user", "other"), (7, "user", "other"),
                                            (None, None, "other"), (0, "user", "a"), (0, "user", "alone"))]
    rows += [(1, 0, "user", "a"), (2, 0, "user", "hello"), (2, 1, "user", "more")]
    got = run(spark, rows)
    assert got == brute(rows)
    # "hello" begins conversation 2, "a" is conversation 1.
    assert [r[:3] for r in got] == [(1, 1, 2), (2, 2, 1)] + [(None, 1, 1)] * 3


def test_many_copies(spark):
    rows = [(c, t, "user", f"t{t}") for c in range(2000) for t in range(1 + c % 3)]
    assert [r[:3] for r in run(spark, rows)] == [(2, 3, 666)]
