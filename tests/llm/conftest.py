import pytest
from pyspark.sql import functions as F

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, n_words string"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names the operators use themselves."""
    def make(rows, partitions=3):
        data = [(i, t, ("en", "de", None)[k % 3], f"src{k % 4}", None if t is None else len(t), "x", "y", "z")
                for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, DOC).repartition(partitions)
    return make


@pytest.fixture()
def odd_rows():
    """Nulls, empties, one word, ties, repeated rows, a very long text, white space only, long runs."""
    long_text = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    same = "the same text of a few words that is found more than once in the table"
    return [(1, None), (2, ""), (3, "one"), (4, same), (5, same), (5, same), (None, same), (None, None),
            (6, long_text), (7, " \t\n\x0b\x0c\r "), (8, "a b c"), (9, "É\u00e9 \U0001F600 x" * 40),
            (10, "x" * 3000), (11, long_text + " tail"), (12, " " * 12_000 + "end"), (13, "<|endoftext|> in a text")]


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture()
def sf(spark):
    def read(name):
        return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    return read


@pytest.fixture()
def col():
    return F.col
