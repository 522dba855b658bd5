import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, payload string, block string, home int, kind string, row string, fp long, perplexity double, hits string, component_id long, ids string, _gone string, _block string, key string, n long, list long, _c long, sketch string, terms string, root long, _id long, _text long"


def rows_of(pairs):
    """Documents with every other column null or clashing with names inside the operators."""
    return [(d, t, lang, "s", None if t is None else len(t), 1, "x", "b", 2, "k", "r", 3, 0.5, "h", 4, "i", "g", "j", "k", 5, 6, 7, "l", "m", 8, 9, 10) for d, t, lang in pairs]


def odd_documents():
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "the", "of", "and", "zeta", "eta", "theta"]

    def prose(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) + str(r.randint(0, 40)) for _ in range(n))

    shared = prose(40, 1)
    out = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, shared, "en"), (5, shared, "en"), (6, "start " + shared + " end", "de"), (7, prose(60, 2), "en"), (7, prose(60, 2), "en"), (8, prose(60, 3), "en"), (8, prose(50, 4) + " " + shared, None),
        (None, shared, "en"), (None, None, None), (9, "x" * 50_000, "en"), (10, "the " * 9_000, "en"), (11, "<|endoftext|>Hello\x1cWORLD's ÉÈ ΑΣ J̌ 漢字 😀 \x85\xa0 12½", "fr"), (12, "a@b.co, +1 (415) 555-2671; 4111 1111 1111 1111 and 10.0.0.255 a@b.co", "en"),
        (-5, shared + " tail", "en"), (9_000_000_000, prose(30, 5) + "\n" + shared, "en"), (13, "école ECOLE école", "fr"), (14, "$$$ ### !!!", "xx"),
    ]
    out += [(100 + i, prose(rng.randint(5, 80), 100 + i % 7), "en" if i % 3 else "de") for i in range(40)]
    return out


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows_of(odd_documents()), SCHEMA)


@pytest.fixture(scope="session")
def odd_pairs():
    return [(d, t) for d, t, _ in odd_documents()]


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest driver tables as (documents, rows)."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
