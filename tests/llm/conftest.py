import pytest

WORDS = "stone river maple candle bright window copper garden silent harbor velvet thunder meadow lantern".split()


def prose(n: int, seed: int) -> str:
    """n words that repeat no long passage of another seed."""
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(state >> 33) % len(WORDS)] + str((state >> 40) % 97))
    return " ".join(out)


PASSAGE = prose(60, 1000)

#: Nulls, empty and blank texts, ties, repeated rows, copies, a very long word and text.
AWKWARD = [
    (1, prose(80, 1), "en"),
    (1, prose(80, 1), "en"),
    (2, prose(80, 1), None),
    (3, prose(80, 1).upper(), "en"),
    (4, None, "en"),
    (5, "", "en"),
    (6, "  \n\t ", "en"),
    (7, "one", "de"),
    (8, "x" * 5000, "de"),
    (9, prose(40, 2) + " " + PASSAGE + " " + prose(40, 3), "fr"),
    (10, prose(50, 4) + " " + PASSAGE + " " + prose(30, 5), "fr"),
    (11, "Größe élan ñandú \u2581 日本語 🙂 \x00 end " * 20, "es"),
    (12, prose(20000, 6), "en"),
    (None, prose(80, 1), "en"),
    (None, "short text without an id", None),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents of every awkward kind, with columns whose names operators use themselves."""
    schema = (
        "doc_id long, text string, lang string, source string, n_chars long, score double, n_bytes long, "
        "n_removed string, ids string, _key int, _text int, _kept int, _repeated int, shard int, slot int"
    )
    rows = [(i, t, lang, "src", len(t or ""), 0.5, 1, "a", "b", 1, 2, 3, 4, 5, 6) for i, t, lang in AWKWARD]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.filter("false")
