import hashlib
import random

from modelweave.llm.queries import CONTROL_TEXT, op10_reply_trees
from modelweave.llm.reply_trees import branches_of, escape, format_conversations, format_turns, parse, read_back, threads
from modelweave.llm.reply_trees import CONTROL, unescape


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """(conv_id, n_turns, turns, loss) from (conv_id, turn, role, text) rows."""
    out = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        (c, len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), sum(len(x) for r, x in t if r == "assistant"),
         sha("".join(x for r, x in t if r == "assistant")))
        for c, t in out.items()
    }


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]
    got = op10_reply_trees(spark, small)
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert {tuple(r)[:5] for r in got.collect()} == expected(rows)


def test_escaping_is_reversible():
    random.seed(6)
    parts = [*CONTROL, "\\", "<", "s>", "[", "INST]", "/", "a", "\n", "é"]
    for _ in range(3000):
        text = "".join(random.choices(parts, k=random.randint(0, 10)))
        assert unescape(escape(text)) == text
        assert not any(c in escape(text) for c in CONTROL)
        turns = [(text, text[::-1]), ("assistant", text)]
        formatted, mask = format_turns(turns)
        assert parse(formatted) == turns
        assert unescape("".join(formatted[a:b] for a, b in mask)).endswith(text)


def test_awkward_conversations(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, None, "x"), (1, None, "assistant", "first"),
            (2, 5, "assistant", ""), (3, 0, "user", "long " * 50_000)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "conv_id long, turn long, role string, text string, msg int")
    got = read_back(format_conversations(threads(frame))).drop("branch").collect()
    assert {tuple(r)[:5] for r in got} == expected(rows)
    nobody = spark.createDataFrame([(None, 0, "user", "a"), (None, 1, "assistant", "b")], frame.drop("msg").schema)
    assert [r.n_turns for r in format_conversations(threads(nobody)).collect()] == [2]
    assert format_conversations(threads(frame.filter("false"))).count() == 0


def brute_branches(messages, branches):
    nodes = {m: (p, s or 0.0) for m, p, s in messages}
    parents = {p for p, _ in nodes.values()}
    paths = []
    for leaf in nodes:
        if leaf in parents:
            continue
        path, at = [], leaf
        while at in nodes and at not in path:
            path.append(at)
            at = nodes[at][0]
        if at not in path:
            total = sum(nodes[m][1] for m in path)
            paths.append((-total / len(path), -len(path), leaf, path[::-1]))
    return [p[3] for p in sorted(paths)[:branches]]


def test_trees_equal_brute_force(spark):
    random.seed(9)
    rows, want = [], set()
    for conv in range(30):
        n = random.randint(1, 40)
        messages = [
            (m, random.choice([m - 1, random.randint(-1, m - 1)]) if m else None, random.choice([0, 1, 2, 4, None]))
            for m in range(n)
        ]
        rows += [(conv, *m, "user", f"t{m[0]}") for m in messages]
        for b, path in enumerate(brute_branches(messages, 3)):
            want |= {(conv, b + 1, k + 1, m) for k, m in enumerate(path)}
    rows += [(99, 1, 2, 1, "user", "cycle"), (99, 2, 1, 1, "user", "cycle"), (99, 3, 2, 9, "user", "on it"),
             (99, 4, None, 0, "user", "root")]
    want.add((99, 1, 1, 4))
    frame = spark.createDataFrame(
        [(c, m, p, None if s is None else float(s), r, t) for c, m, p, s, r, t in rows],
        "conv long, msg long, parent long, score double, role string, text string",
    )
    got = {tuple(r) for r in branches_of(frame, 3).select("conv", "branch", "place", "msg").collect()}
    assert got == want
    best = {r.conv: r.formatted for r in format_conversations(frame).collect()}
    assert best[99] == format_turns([("user", "root")])[0] and len(best) == 31


def test_deep_chain(spark):
    frame = spark.createDataFrame(
        [(1, m, m - 1 if m else None, 1.0, "user", "x") for m in range(1000)],
        "conv long, msg long, parent long, score double, role string, text string",
    )
    assert [r.msg for r in branches_of(frame).orderBy("place").collect()] == list(range(1000))


def test_two_roots_are_ranked_as_one_conversation(spark):
    frame = spark.createDataFrame(
        [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, None, 5.0), (1, 4, 9, 3.0)],
        "conv long, msg long, parent long, score double",
    )
    got = [sorted((r.branch, r.place, r.msg) for r in branches_of(frame, n).collect()) for n in (1, 3)]
    assert got == [[(1, 1, 3)], [(1, 1, 3), (2, 1, 4), (3, 1, 1), (3, 2, 2)]]
