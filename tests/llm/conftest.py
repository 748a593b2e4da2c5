"""Small tables with every awkward case the operators define a result for."""

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EXTRA = (
    "score double, selected boolean, ids string, node string, class_id string, spans string, shard string,"
    " __rank int, c0 string"
)


def prose(seed: int, words: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * seed) % 9973}" for i in range(words))


def documents(spark):
    """Null, empty, letterless and very long texts, repeated rows and ids, ties, clashing column names."""
    long = prose(3, 20_000)
    near = prose(5, 200)
    texts = {
        1: None,
        2: "",
        3: "!!! ... 123 --",
        4: "one two three",
        5: prose(1, 120),
        6: prose(1, 120),
        7: near,
        8: near.replace(near.split()[100], "changed"),
        9: long,
        10: "  two  spaces \n and\tmore ",
        11: "日本語 テキスト 👍",
        12: "one two three",
    }
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 == 0 else "s1", None) for i, t in texts.items()]
    rows += [rows[4], (None, "no id", "en", "s2", None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", *[f"CAST(NULL AS {f.split()[1]}) AS {f.split()[0]}" for f in EXTRA.split(",")])


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")
