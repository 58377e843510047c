import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from (id, text) pairs."""

    def build(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)

    return build


@pytest.fixture(scope="session")
def prose():
    """Seeded words: prose(seed, n) gives n words of a few letters."""

    def write(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ka", "lo", "mi", "ter", "un", "da", "res"]) for _ in range(rng.randint(2, 4))) for _ in range(n))

    return write


#: Rows that every operator must bear, beside ordinary ones.
ODD = [(901, None), (902, ""), (903, "  \n\t "), (904, "one"), (905, "one"), (906, "ünï ﬀ 漢字 \U0001f600 — ok"), (907, "x" * 300_000), (908, "la " * 100_000), (904, "one")]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)


@pytest.fixture(scope="session")
def sf_of(tmp_path_factory):
    """Writes tables into a folder that queries can read."""

    def write(**tables):
        folder = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"file://{folder}/{name}.parquet")
        return f"file://{folder}"

    return write
