"""Line dedup against its definition."""

from collections import Counter

from compare import duck_rows, spark_rows

from tidemark.llm.boilerplate import ORACLE, drop_boilerplate, op6_line_dedup


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert spark_rows(op6_line_dedup(spark, sf)) == duck_rows(sf, ORACLE)


def test_equals_definition(make_docs):
    rows = [(i, f"common\nown {i}\n\ncommon", "a") for i in range(8)] + [(20 + i, f"common\nb {i}", "b") for i in range(2)]
    rows += [(30 + i, f"line {i // 5}", None) for i in range(60)]  # copies: each text counts once
    rows += [(1000 + i, f"footer {i // 4}\npage {i}", "c") for i in range(400)] + [(2000, "footer 7\nmore", "c")]
    rows += [(100, None, "a"), (101, "", "a"), (102, "common", "a"), (7, "common\nown 7\n\ncommon", "a")]
    rows += [(103, "x\n" * 50_000 + "common", "a")]
    docs = make_docs(rows)
    found = drop_boilerplate(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    texts = {(r[2] or "", r[1]) for r in rows if r[1] is not None}
    pages, having = Counter(host for host, _ in texts), Counter()
    for host, text in texts:
        having.update((host, line) for line in set(text.split("\n")) - {""})
    bad = {k for k, n in having.items() if n >= 3 and n > 0.01 * pages[k[0]]}
    assert ("a", "common") in bad and ("b", "common") not in bad and ("", "line 3") not in bad
    assert ("c", "footer 7") in bad and ("c", "footer 8") not in bad  # five and four of 401 different texts
    wanted = []
    for doc_id, text, host in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if (host or "", x) not in bad]
        wanted.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    key = lambda r: (r[0], r[1] or "", r[2])
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=key) == sorted(wanted, key=key)


def test_empty_and_clashing(make_docs):
    assert drop_boilerplate(make_docs([])).collect() == []
    twice = drop_boilerplate(drop_boilerplate(make_docs([(1, "a", "s")])))
    assert twice.columns.count("n_lines") == 1
