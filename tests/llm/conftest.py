import random

import pytest

TOKENIZERS = "/opt/tokenizers"


@pytest.fixture
def vocabulary():
    return lambda name: f"{TOKENIZERS}/{name}"


def strange_texts(n: int = 120, seed: int = 3) -> list[str]:
    """Texts of characters from many scripts, with apostrophes, spaces and special strings."""
    r = random.Random(seed)
    kinds = (
        lambda: chr(r.randint(32, 126)),
        lambda: chr(r.randint(0xA0, 0x24F)),
        lambda: chr(r.randint(0x370, 0x5FF)),
        lambda: chr(r.randint(0x4E00, 0x4FFF)),
        lambda: chr(r.randint(0x1F300, 0x1F5FF)),
        lambda: r.choice("'strevmd \n\t  Σ"),
    )
    out = ["".join(r.choice(kinds)() for _ in range(r.randint(1, 80))) for _ in range(n)]
    return [
        *out, "", " ", "aaaaaaaaaaaaaaaaaaa", "don't 'sam ''s 'll've", "x<|endoftext|> y<|endoftext|>",
        "ab" * 4000, "  a  b \n\n c", "é é İ ß", "1234 5678",
    ]


#: A null text and id, empty and blank texts, repeated rows, a long text, and other columns under
#: names that operators use themselves.
ODD_ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (4, "one two"), (None, "a b c d e f g"),
    (5, "word " * 30_000), (6, "a b c d e f g"), (7, "line\n" * 40), (8, "!!! ??? ..."),
]
CLASHES = {
    "id": "1", "row": "2", "keep_0": "3", "v": "4", "key": "5", "gone": "6", "n_words": "7",
    "node": "8", "anchor": "9", "start": "10", "kind": "11", "line": "12", "place": "13",
}


@pytest.fixture
def odd(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ODD_ROWS, "doc_id bigint, text string")
    frame = frame.withColumn("lang", F.lit(None).cast("string"))
    return frame.select("*", *[F.expr(v).alias(k) for k, v in CLASHES.items()])


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


@pytest.fixture
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
