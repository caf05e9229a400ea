import pytest
from plain_text import prose

@pytest.fixture(scope="session")
def ready(spark):
    from statledger.llm.ship import ship_package

    ship_package(spark)
    return spark


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, spans string"


@pytest.fixture(scope="session")
def make_docs(ready):
    """Documents from (doc_id, text[, source[, lang]]), with extra columns whose names clash."""

    def made(rows):
        full = []
        for r in rows:
            doc_id, text, source, lang = (*r, *(None,) * (4 - len(r)))
            full.append((doc_id, text, lang, source, len(text or ""), 7, "x"))
        return ready.createDataFrame(full, SCHEMA)

    return made


@pytest.fixture(scope="session")
def odd_docs():
    """Null and empty texts, blank ones, a giant one, repeated rows, null and repeated ids."""
    long = prose(99, 40_000)
    return [
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, prose(5, 60)),
        (5, prose(5, 60)),
        (None, prose(5, 60)),
        (6, long),
        (7, long),
        (8, "x" * 100_000),
        (9, "1" * 50_000),
        (10, "naïve Ünïcödé words"),
    ]
