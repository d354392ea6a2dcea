import pytest
from llm_cases import DOCUMENTS


@pytest.fixture
def documents(spark, tmp_path):
    """Write (doc_id, text[, lang[, source]]) rows as a documents table; gives the folder."""

    def write(rows, files=2, name="sf"):
        full = [(*r, *[None] * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(full, DOCUMENTS).repartition(files).write.parquet(f"{folder}/documents.parquet")
        return folder

    return write
