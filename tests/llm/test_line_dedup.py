from collections import Counter, defaultdict

from modelweave.llm import line_dedup
from modelweave.llm.line_dedup import LineRuns, dedup_lines
from tests.llm.cases import LINE, edge_documents, no_documents


def brute(rows):
    def key(line):
        k = line.strip(" \t\n\x0b\f\r")
        k = "".join(c.lower() if "A" <= c <= "Z" else c for c in k)
        return k if len(k) >= 40 else None

    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and key(line):
                held[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if i is None or not key(x) or len(held[key(x)]) < 5 or max(held[key(x)]) == i
        ]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def test_awkward_rows_equal_brute_force(spark):
    docs = edge_documents(spark)
    got = dedup_lines(docs, counts=True)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = [(r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()]
    assert Counter(rows) == Counter(brute([(r.doc_id, r.text) for r in docs.collect()]))
    assert sum(LINE in r[1] for r in rows) == 1  # upper case is the same key; the largest id keeps it


def test_documents_that_lose_many_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LISTED", 1)
    lines = [f"Line {n} of more than forty characters, held by many documents." for n in range(5)]
    rows = [(i, "\n".join([f"own {i}", *lines[:i % 6], "", "  " + lines[0].upper() + "\t", lines[1]])) for i in range(12)]
    rows += [(3, "another text\n" + lines[1]), (None, lines[0]), (50, None)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n_lines int, lost int")
    got = dedup_lines(docs, counts=True)
    assert got.columns == ["doc_id", "text", "lost", "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()) == Counter(brute(rows))


def test_the_anti_join_decides(spark, monkeypatch):
    """Without first sights in later batches, keys that no document of the first batch holds are not known."""
    rows = [(5 * k + i, f"Line {k} of more than forty characters, held by five documents.") for k in range(20) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    kept = Counter((i, t) for i, t, _, _ in brute(rows))
    assert Counter((r.doc_id, r.text) for r in dedup_lines(docs).collect()) == kept
    monkeypatch.setattr(LineRuns, "unseen", lambda self, keys: keys.filter("false"))
    assert Counter((r.doc_id, r.text) for r in dedup_lines(docs).collect()) != kept


def test_no_rows(spark):
    assert dedup_lines(no_documents(spark), counts=True).count() == 0


def test_runs_know_each_key_once(spark):
    runs = LineRuns(fanout=2)
    batches = [[(1, b"a"), (2, b"a"), (2, b"b")], [(3, b"a"), (4, b"c")], [(5, b"c"), (6, b"d"), (6, None), (None, b"a")]]
    fresh = []
    for rows in batches:
        run = runs.add(spark.createDataFrame(rows, "id long, key binary"))
        fresh.append(sorted(bytes(r["key"]) for r in run.filter("fresh").collect()))
    assert fresh == [[b"a", b"b"], [b"c"], [b"d"]]
    assert [len(level) for level in runs.levels] == [1, 1]
    totals = {(bytes(r["key"]), r["docs"], r["last_doc"]) for r in runs.totals().collect()}
    assert totals == {(b"a", 3, 3), (b"b", 1, 2), (b"c", 2, 5), (b"d", 1, 6)}
