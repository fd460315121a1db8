import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, kept string, size string, shard string, place string, cluster string, d string, t string, bucket int, host string"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n=60):
    return " ".join(WORDS[(seed * 37 + i * i * (seed % 7 + 1) + i) % len(WORDS)] for i in range(n))


def odd_rows():
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows, clashing columns."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    texts = [
        base, base, base.upper(), " ".join(near), prose(2), prose(3), None, "", " \n\t", "one two", "ONE  two", "one two three", base + "\n" + prose(9, 8) + "\nx", prose(4) + "\n" + prose(9, 8), "a\n" + prose(9, 8).upper() + " \n", prose(9, 8),
        "mail a.b@c.de or +1 (555) 123-4567, 10.0.0.1", "é" * 5000 + " 日本 😀", " ".join(["same"] * 3000), "x" * 20000, prose(5, 9000), "<|endoftext|> it's 12 '' …",
    ]
    rows = [(i, x, "en", f"s{i % 3}" if i % 5 else None, len(x or ""), 1, "k", "z", "q", "p", "c", "d", "t", 3, "h") for i, x in enumerate(texts)]
    rows += [rows[0], rows[5], (None, base, None, None, None, *[None] * 10), (None, None, None, None, None, *[None] * 10), (5, "another text under a doc_id that is there already", None, "s1", None, *[None] * 10)]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
