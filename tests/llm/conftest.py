import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
WORDS = {"en": "the and of to with thing from house water morning people little".split(),
         "de": "der und nicht mit einer für straße haus wasser größe schön".split(),
         "fr": "le les des une avec maison été où être château".split()}


def prose(rng, lang, n):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "s", "er", "ing", "é"]) + str(rng.choice(["", ",", "."])) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Nulls, empty and long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(7)
    base = [prose(rng, rng.choice(list(WORDS)), rng.randint(5, 300)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    long = prose(rng, "en", 20_000)
    passage = prose(rng, "de", 120)
    rows += [(100, None, None, None, None), (101, "", "en", "s", 0), (102, " \t\n", "en", "s", 3), (103, "12 34 ²", "en", None, 5),
             (104, long, "en", "s", len(long)), (105, long, "en", "s", len(long)), (106, base[0], "en", "s", 1),
             (107, base[0].replace(" ", "  "), "en", "s", 1), (108, base[1], None, "s", 1), (108, base[1], None, "s", 1),
             (None, base[2], "en", "s", 1), (None, None, None, None, None), (109, "Привет мир", "en", "s", 10),
             (110, passage + " " + base[3], "de", "s", 1), (111, base[4] + " " + passage, "de", "s", 1), (112, "a" * 3000, "en", "s", 1),
             (113, "abc" * 700, "en", "s", 1), (114, "one two", "en", "s", 1), (115, "One two", "en", "s", 1), (116, "漢字 \U0001f642 <|endoftext|>", "en", "s", 1)]
    many = base[5].split()
    for i in range(40):  # near copies of one document
        copy = list(many)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = "changed" + str(i)
        rows.append((200 + i, " ".join(copy), "en", "hot", 1))
    return rows


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    return spark.createDataFrame(hard_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
