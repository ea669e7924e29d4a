import zlib

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from lakeloom.llm.common import prepare
    prepare(spark)
    return spark


@pytest.fixture(scope="session")
def documents(llm):
    """The documents with awkward rows added: null and empty texts, nulls in
    every other column, repeated rows, a very long text and ties."""
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    first = docs.orderBy("doc_id").limit(1).collect()[0]
    long = "lorem ipsum dolor sit amet " * 12_000 + "\n" + first["text"]
    extra = [(90_001, None, None, None, None), (90_002, "", "en", "", 0), (90_003, " \t\n ", "en", "src0", 4),
             (90_004, "één woord", None, None, 9), (90_005, long, "en", "src0", len(long)),
             (90_006, "x" * 70_000, "en", "src1", 70_000), (90_007, "12 34 ... !!", "en", "src2", 12),
             (90_004, "één woord", None, None, 9), (None, first["text"], "fr", "src0", 10),
             (None, "a text without an id", "en", None, 20), (90_008, first["text"], "fr", "src3", 10)]
    return docs.unionByName(llm.createDataFrame(extra, docs.schema)).repartition(5, "text").cache()


@pytest.fixture(scope="session")
def empty(llm):
    return llm.read.parquet(f"{SF}/documents.parquet").limit(0)


def fold(i, parts):
    return 0 if i is None else zlib.crc32(str(i).encode()) % parts
