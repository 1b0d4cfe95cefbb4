"""Fixtures, and rows with the cases every operator defines."""

import random

import pytest

from wakeline.llm.tables import prepare

SF = "/root/testdata/sf0.001"

# Names that operators use for columns of their own.
CLASHING = ["kept", "digest", "run", "key", "ids", "item", "group", "row", "spans", "n_words",
            "component", "text_sha256", "packed", "place", "size"]

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{name} string" for name in CLASHING
)


@pytest.fixture
def llm_spark(spark):
    prepare(spark)
    return spark


@pytest.fixture
def make_docs(llm_spark):
    """Documents from (doc_id, text), with extra columns of clashing names."""

    def build(rows):
        full = [(i, t, None, "s", None, *(["x"] * len(CLASHING))) for i, t in rows]
        return llm_spark.createDataFrame(full, COLUMNS)

    return build


@pytest.fixture
def given_docs(llm_spark):
    return llm_spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))


def tricky_rows():
    """Missing and empty texts, white space, ties, repeated rows, no doc_id, a long text."""
    rng = random.Random(7)
    words = ["Alpha", "beta", "gamma.", "délta", "日本", "e", "👍x", "<|endoftext|>", "don't"]
    prose = [" ".join(rng.choices(words, k=60)) for _ in range(6)]
    long = " ".join(f"w{rng.randint(0, 4000)}" for _ in range(30_000))
    rows = [
        (1, prose[0]), (2, prose[0]), (3, prose[0].replace(" ", "\t\n")), (4, prose[0].upper()),
        (5, None), (6, ""), (7, " \n\t "), (8, "one two three"), (9, "One two  three"),
        (10, prose[1]), (10, prose[1]), (None, prose[2]), (None, None), (11, prose[2]),
        (12, prose[3] + "\n" + prose[3]), (13, long), (14, long + " end"), (15, "a" * 9000),
        (16, "ab " * 900), (17, "\x00\x85  x"), (-5, prose[4]), (2**60, prose[4]),
    ]
    rng.shuffle(rows)
    return rows
