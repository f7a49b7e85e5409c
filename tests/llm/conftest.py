import random

import pytest

WORDS = ["the", "of", "and", "cat", "hond", "été", "größe", "niño", "run", "lazy", "fox", "jumps", "over", "brown"]


@pytest.fixture(scope="session")
def llm(spark):
    """The session with the package shipped to its Python workers."""
    from civica.session import ship_package
    ship_package(spark)
    return spark


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice([".", ",", ".\n"]) if rng.random() < 0.2 else "") for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> dict:
    """Edge cases by id: null, empty, blank, short, copies, a very long text."""
    rng = random.Random(5)
    out = {1: None, 2: "", 3: " \t\n ", 4: "one", 5: "one two", 6: prose(rng, 40), 8: prose(rng, 300), 9: "É É É É É É É É",
           10: "x" * 3000, 11: prose(rng, 20000), 12: "a\x00b\x1cc\x85d e", 13: "日本 語 テスト", 14: "!!! ??? ...",
           15: "line one.\nline one.\nline one.\n"}
    out[7] = out[6]
    for i in range(20, 60):
        out[i] = prose(rng, rng.randint(1, 120))
    return out


@pytest.fixture(scope="session")
def docs(llm, texts):
    """The edge cases as a table, with a null id, a repeated row, and extra
    columns named like the operators' own."""
    rows = [(k, v, "en", 0.5, k, True, "x") for k, v in texts.items()]
    rows += [(None, "a text without an id, and some words.", "en", 0.5, 0, False, None), rows[5]]
    return llm.createDataFrame(rows, "doc_id long, text string, lang string, score double, n_words int, held boolean, spans string")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


def table(df, *keys) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
