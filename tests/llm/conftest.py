import os

import pytest

from daybar.llm.tables import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, kept string, fp string, digest string, row string, budget string"


@pytest.fixture(scope="session")
def docs(spark):
    """Edge cases: null, empty, blank, repeated rows, ties, a long text, a null id, extra columns with clashing names."""
    prepare(spark)
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, passage, "en", "src0"), (2, passage, "en", "src0"), (2, passage, "en", "src0"),
        (3, f"some words before it {passage} and behind", "de", None), (4, None, None, "src1"), (5, "", "en", "src12"),
        (6, " \t\n ", "en", "src0"), (7, "Released under the MIT License.\nnothing else here", "fr", "src3"),
        (8, "é ß 漢字 😀 " * 30, "de", "src0"), (None, passage, "en", "src0"), (9, "a b " * 40000, "es", "src2"),
        (10, passage.replace("word7 ", "other "), "en", "src0"), (11, "one\none\none\ntwo words two words", "en", "src0"),
        (12, passage.replace(" ", "\n"), "en", "src0"),
    ]
    return spark.createDataFrame([(*r, 0, *["x"] * 6) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF
