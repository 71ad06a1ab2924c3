import random

import pytest

DOC_TYPE = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # columns whose names the operators use themselves
    "score double, spans string, size int, label int, fingerprint string, _hashes int, _mix_size int, word string"
)


def words(rng, n, letters="abcdefghijklmnop"):
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def messy_texts():
    rng = random.Random(4)
    texts = [" ".join(words(rng, n)).capitalize() + "." for n in (1, 2, 3, 12, 40, 150)]
    texts += [texts[4] + " once more", texts[4].upper(), " ".join(words(rng, 30_000)), "x" * 50_000]
    texts += [None, "", "  \n\t ", "  two  gaps \n and a hard one ", "ünïcode ßtraße 漢字 😀 " * 5, texts[4], texts[4]]
    return texts


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls everywhere, empty and long texts, repeated rows and ids, clashing columns."""
    rows = []
    for i, text in enumerate(messy_texts()):
        lang, source = (None, "en", "fr")[i % 3], (None, "b", "a")[i % 3]
        rows.append((None if i == 3 else i, text, lang, source, None, 1.0, "s", 2, 3, "f", 4, 5, "w"))
    rows += [rows[4], rows[4], rows[10]]
    return spark.createDataFrame(rows, DOC_TYPE)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_TYPE)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
