import pytest

# Null ids and texts, empty and blank texts, repeated rows, a doc_id with two
# texts, ties and one long text; extra columns clash with the operators' names.
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " score double, n_words string, id int, digest string"
)


def words(seed, count):
    state, out = seed * 7919 + 1, []
    for _ in range(count):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(state >> 8) % 12] + str((state >> 14) % 40))
    return out


def rows():
    base = words(1, 120)
    near = [*base[:60], "changed", *base[61:]]
    texts = [
        (1, " ".join(base)),
        (2, " ".join(near)),
        (3, "  ".join(base).upper()),
        (4, "\n".join(words(2, 200) + base[20:90])),
        (4, "another text of four"),
        (5, " ".join(words(2, 200))),
        (6, None),
        (7, ""),
        (8, " \t\n\x0b\x0c\r "),
        (9, "one"),
        (9, "one"),
        (10, "ONE"),
        (11, "one two"),
        (12, "a | b\na | b\na | b\n###### $$$$"),
        (None, " ".join(base)),
        (None, None),
        (13, "é ü 日本 🙂 " * 30),
        (14, "x" * 5000 + " " + " ".join(words(3, 30000))),
        (15, " ".join(words(4, 60) * 3)),
    ]
    return [
        (key, text, None if key == 5 else "en", None if key in (5, 6) else f"s{(key or 0) % 2}",
         len(text or ""), 0.5, "clash", 7, "clash")
        for key, text in texts
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
