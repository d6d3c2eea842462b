"""The pipeline's stages, each against a plain version on its own input."""

import corpus_pipeline
import pytest
from test_near_dup import brute
from test_token_files import ids_of

from tidemark.llm.common import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found.append(docs)
        docs = stored(stage(spark, docs, SF), f"test-{name}")
    return [*found, docs]


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dup", "decontaminate", "pack"]
    assert all(df.columns == outputs[0].columns for df in outputs[:-1])


def test_quality_keeps_good(spark, outputs):
    before, after = rows_of(outputs[0]), rows_of(outputs[1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in before if labels.get(i) == 1]
    assert sum(i in after for i in good) >= 0.97 * len(good)
    assert all(after[i] == before[i] for i in after)


def test_lines_only_go(outputs):
    before, after = rows_of(outputs[1]), rows_of(outputs[2])
    assert before.keys() == after.keys()
    for i, row in after.items():
        assert set(row.text.split("\n")) <= {*before[i].text.split("\n"), ""} and row.n_chars == len(row.text)


def test_one_of_each_group_stays(outputs):
    before, after = rows_of(outputs[2]), rows_of(outputs[3])
    wanted = brute([(i, r.text) for i, r in before.items()], 5, 80)
    assert sorted(after) == sorted(i for i, c in wanted.items() if i == c)


def test_benchmark_passages_go(spark, outputs):
    before, after = rows_of(outputs[3]), rows_of(outputs[4])
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(before) - set(after) == {i for i, r in before.items() if any(x in r.text for x in items)}


def test_all_tokens_are_packed(spark, outputs):
    found = outputs[5].collect()
    texts = rows_of(outputs[4])
    total = {}
    for r in found:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {i: len(ids_of(r.text, 0)) for i, r in texts.items()}


HARD = "doc_id long, text string, lang string, source string, n_chars long, `__text` string, `__lines` string, `__gone` string, n_lines long, n_dropped long, `__site` int, row int, `of` int, n int"


def hard_rows(prose):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    texts = [(1, a), (5, a), (5, b), (None, c), (None, c), (None, a), (7, None), (7, None), (8, ""), (9, prose(4, 20_000)), (10, b + " end"), (5, b)]
    texts += [(20 + i, f"Top line\n{prose(20 + i, 30)}") for i in range(12)]
    return [(i, t, None, None if i == 9 else "s", None if t is None else len(t), "MINE", "L", "G", 99, 98, 1, 2, 3, 4) for i, t in texts]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_hard_rows(spark, prose, name):
    """Null and repeated ids, null, empty and long texts, repeated rows, clashing names."""
    rows = hard_rows(prose)
    docs = spark.createDataFrame(rows, HARD).repartition(3)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    if name == "pack":
        sizes = [len(ids_of(r[1], 0)) for r in rows]
        assert sorted(r.length for r in found.collect()) == sorted(min(2048, n - i) for n in sizes for i in range(0, n, 2048))
        return
    assert found.columns == docs.columns and found.dtypes == docs.dtypes
    got = [tuple(r) for r in found.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    if name == "line_dedup":
        wanted = [(*r[:1], r[1] and r[1].replace("Top line\n", ""), *r[2:]) for r in rows]
        wanted = [(*r[:4], None if r[1] is None else len(r[1]), *r[5:]) for r in wanted]
        assert sorted(got, key=key) == sorted(wanted, key=key)
    elif name == "near_dup":
        texts = sorted(r[1] or "" for r in got)
        alone = [r[1] for r in rows if r[1] and r[1].startswith("Top")] + [rows[9][1]]
        # One of a (the id that is not repeated), of b (its near copy, likewise) and of c; rows without words have no copies.
        assert texts == sorted(["", "", "", rows[0][1], rows[10][1], rows[3][1], *alone])
        assert [r[0] for r in got if r[1] == rows[0][1]] == [1]
        assert set(got) <= set(rows)
    else:
        assert set(got) <= set(rows) and (name == "quality" or len(got) == len(rows))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_empty_tables(spark, name):
    docs = spark.createDataFrame([], HARD)
    assert dict(corpus_pipeline.STAGES)[name](spark, docs, SF).collect() == []


def test_run_equals_stages(spark, outputs):
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*pick).collect())) == sorted(map(tuple, outputs[5].select(*pick).collect()))
    assert corpus_pipeline.ORACLE_SQL is None
