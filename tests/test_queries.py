"""Every query of the core against its SQL, over whole tables."""

import pytest

from quillspark.plans import fixtures, lines, relational, retrieval, text

from .oracle import connect, rows

MODULES = (text, lines, relational, retrieval, fixtures)
CASES = [(m, k) for m in MODULES for k in m.ORACLES]


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("module,name", CASES, ids=[k for _, k in CASES])
def test_query(spark, duck, data, module, name):
    got, want = module.QUERIES[name](spark, data).toPandas(), duck.sql(module.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_names_differ_between_modules():
    names = [k for m in MODULES for k in m.QUERIES]
    assert len(names) == len(set(names))


def test_abbreviations_end_no_sentence(spark):
    from quillspark.operators import chunks as C

    d = spark.createDataFrame([(1, "Mr. Hale met Dr. Roe. They left at 5 p.m. Then what? Home."), (2, None), (3, "")], "id int, text string")
    assert [r.content for r in C.sentences(d, "text").orderBy("id", "chunk_index").collect()] == [
        "Mr. Hale met Dr. Roe.", "They left at 5 p.m. Then what?", "Home.",
    ]
