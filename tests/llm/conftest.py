
import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())]
                    # names that operators use themselves
                    + [T.StructField(c, T.StringType()) for c in (
                        "_size", "_key", "k1", "k2", "z", "cuts", "a", "s", "n", "ids", "score", "shard", "fp", "th",
                        "size", "_row", "toxic", "component", "_t", "label")])


def rows(*texts):
    """(doc_id, text) or text; ids count from 0 where none is given."""
    out = []
    for i, x in enumerate(texts):
        doc, text, *src = x if isinstance(x, tuple) else (i, x)
        out.append((doc, text, "en", src[0] if src else f"src{i % 3}", None, *[f"own{i}"] * 20))
    return out


MESSY = rows((0, "alpha beta gamma delta " * 40), (1, None), (2, ""), (3, " \t\n "), (None, "no id here at all"),
             (None, None), (7, "same row twice, it is"), (7, "same row twice, it is"), (7, "another text of id seven"),
             (9, "é ü ß \u0000 \U0001f600   x" * 9), (10, "x"), (11, "word " * 40_000, None), (12, "a" * 30_000, None),
             (13, "alpha beta gamma delta " * 40, ""), (14, "Alpha BETA gamma delta " * 40))


@pytest.fixture(scope="session")
def llm(spark):
    from carelake.llm.common import prepare
    return prepare(spark)


@pytest.fixture
def messy(llm):
    return llm.createDataFrame(MESSY, DOCS)


@pytest.fixture
def empty(llm):
    return llm.createDataFrame([], DOCS)


@pytest.fixture
def sf(tmp_path, llm):
    """Writes tables into a folder that a query can read."""
    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write
