
import pytest


SF = "/root/testdata/sf0.001"
ODD = [(-5, None, None), (-4, "", "en"), (-3, " \n\t ", "en"), (-2, "one two", "en"), (-1, "One  two\n", "en"),
       (100000, "ha " * 60, "en"), (100001, "la la " * 5000 + "end of a very long text", "en"), (100002, "ha " * 60, "en"),
       (100003, "ähnlich Ähnlich\nÄHNLICH x\n\n  one two ", "de"), (100004, "123 456 !!", None), (100005, "🙂 " + "x" * 20000, "en"),
       (100006, "the cat sat on the mat and the dog lay by the door all day long then\nthe cat sat on the mat and the dog lay by the door all night", "en"),
       (100007, "now the cat sat on the mat and the dog lay by the door all day", "en")]


@pytest.fixture(scope="session")
def rows(spark):
    """(doc_id, text, lang): the smallest documents and odd ones."""
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    return [tuple(r) for r in table] + ODD


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5).cache()
