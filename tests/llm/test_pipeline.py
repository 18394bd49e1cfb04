import os

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from stocktake.llm.queries import QUERIES

from .cases import documents, prose, texts
from .test_packing import check

SF = "/root/testdata/sf0.001"


def test_stages_on_hard_cases(spark, tmp_path):
    """Each stage's rows by its own operator; the last packs what the others left."""
    rows = texts() + [(100 + k, prose(f"c{k}", 200, lang), lang) for k in range(10) for lang in ("en", "de")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in C.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns and docs.dtypes == before.dtypes, name
    kept = docs.collect()
    assert {100 + k for k in range(10)} <= {r.doc_id for r in kept}
    assert {1, 20} <= {r.doc_id for r in kept} and {2, 3, 4, 5, 21, 17, 18}.isdisjoint(r.doc_id for r in kept)
    check([(r.doc_id, r.text, r.lang) for r in kept], C.run(spark, str(tmp_path)).collect(), 2048)


def test_stages_on_an_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_every_query_is_registered():
    assert set(QUERIES) <= set(E.queries()) and len(QUERIES) == 14
    assert [name for name, _ in C.STAGES] == ["quality rules", "language ID", "n-gram Jaccard join", "secret scans", "best-fit packing"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_return_a_row_for_every_input_row(spark, name):
    n = E.queries()[name](spark, SF).count()
    tables = {"op6_warc": "pages", "op11_ranked_search": "benchmark", "op12_centroid_clustering": "embeddings", "op13_html_extraction": "pages"}
    rows = spark.read.parquet(f"{SF}/{tables.get(name, 'documents')}.parquet").count() * (10 if name == "op11_ranked_search" else 1)
    assert n >= rows if name == "op3_best_fit_packing" else n == rows if name != "pipeline" else n > 0
