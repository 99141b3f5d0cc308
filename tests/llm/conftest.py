import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket string, t string, row int, label int, n int, kind int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, other white space, special strings; extra columns with clashing names."""
    prose = "the quick brown fox jumps over the lazy dog while seven wizards watch it run and nobody says a word about that"
    texts = [
        (1, prose), (2, prose.upper()), (3, prose + "  "), (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, "one two"), (8, "One two"), (9, "ONE two"), (10, "ab " * 30_000), (10, prose),
        (None, prose), (None, None), (11, "x" * 50_000), (12, "<|endoftext|> a<|endoftext|>"), (13, "日本語 🙂 é　x"), (14, "a  b\n\n\nc   d \n e  "), (15, prose + " extra"), (16, "#*$%&|<> " * 60),
        (17, "line\n" * 70), (18, prose), (18, prose), (19, " ".join(f"w{i}" for i in range(400))), (20, " ".join(f"w{i}" for i in range(420))),
    ]
    rows = [(d, t, "en" if (d or 0) % 2 else None, "s" if (d or 0) % 3 else None, 1, "b", "t", 1, 2, 3, 4) for d, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter("false")
