import hashlib

from entityframe.llm.line_dedup import drop_repeated_lines


def brute(rows, min_docs=3, min_chars=20):
    upper = {c: c + 32 for c in range(65, 91)}
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(upper)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")

        def gone(line):
            who = holders.get(key(line), set())
            return i is not None and len(key(line)) >= min_chars and len(who) >= min_docs and i < max(who)

        kept = [x for x in lines if not gone(x)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


LINE = "This line is found in many documents"
ROWS = [
    (1, f"a\n{LINE}\nb"),
    (2, f"  {LINE.upper()}\t\nc"),
    (3, LINE),
    (4, f"{LINE}\n{LINE}"),
    (5, None),
    (6, ""),
    (7, "\n\n"),
    (8, "short\nshort"),
    (9, "short"),
    (10, "short"),
    (3, LINE),
    (11, "ÀÉ line with letters beyond ASCII"),
    (12, "àé line with letters beyond ASCII"),
    (13, "àé line with letters beyond ascii"),
    (14, "àé LINE with letters beyond ascii\nx"),
    (None, LINE),
]


def test_equals_brute_force(docs_of):
    got = drop_repeated_lines(docs_of(ROWS))
    rows = [(r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in got.collect()]
    assert sorted(rows, key=repr) == brute(ROWS)


def test_other_columns_stay_and_clashing_ones_are_replaced(docs_of):
    got = drop_repeated_lines(docs_of(ROWS))
    assert got.columns == ["doc_id", "text", "verdict", "n_lines", "n_dropped"]
    assert {r.verdict for r in got.collect()} == {"x"}


def test_empty_table(docs_of):
    assert drop_repeated_lines(docs_of([])).collect() == []


def test_long_text_of_equal_lines(docs_of):
    text = "\n".join([LINE] * 20_000)
    got = {r.doc_id: r for r in drop_repeated_lines(docs_of([(1, text), (2, text), (3, text)])).collect()}
    assert [got[i].n_dropped for i in (1, 2, 3)] == [20_000, 20_000, 0]
    assert hashlib.md5(got[3].text.encode()).digest() == hashlib.md5(text.encode()).digest()


def test_no_python_in_the_plan(docs_of):
    plan = drop_repeated_lines(docs_of(ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
