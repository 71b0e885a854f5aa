import os

import pandas as pd
import pytest

import __spark_entry__ as contract
from check import database, differences
from loomwork.operators import similarity
from loomwork.sources import records, sinks

SF = "/root/testdata/sf0.001"
NAMES = [
    "top_rated", "similar_users", "recommend_item_based", "adjacency", "pagerank",
    "candidate_pairs", "pair_metrics", "clean_book", "book_features", "row_stats",
    "fold_days", "tagged_documents",
]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    result = contract.queries()[name](spark, SF)
    rows = pd.DataFrame([tuple(r) for r in result.collect()], columns=result.columns)
    cursor = database(SF).execute(contract.oracle_sql()[name])
    expected = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description])
    assert differences(rows, expected) == ""
    assert len(rows) > 0


def test_every_sql_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_from_record_files_to_pairs_and_metrics(spark, tmp_path):
    body = "grain exports rose in the third quarter according to officials in the ministry"
    texts = {"9": body, "10": body, "11": body.replace("third", "fourth"), "12": "nothing alike here at all"}
    topic = {"9": "grain", "10": "grain", "11": "trade", "12": "grain"}
    for doc_id, text in texts.items():
        (tmp_path / f"{doc_id}.sgm").write_text(
            f'<REUTERS NEWID="{doc_id}"><TOPICS><D>{topic[doc_id]}</D></TOPICS>'
            f"<TEXT><BODY>{text}</BODY></TEXT></REUTERS>\n"
        )
    docs = records.documents(records.file_records(spark, str(tmp_path / "*.sgm"), "REUTERS"))
    signatures = similarity.minhash(similarity.shingles(docs))
    groups = similarity.signature_groups(signatures)
    among = similarity.group_pairs(groups)
    pairs = similarity.candidate_pairs(groups, among)
    found = {(r.doc_id_1, r.doc_id_2): r.num_bands_matched for r in pairs.collect()}
    # ids are text, so "10" comes before "9"
    assert found["10", "9"] == 50
    assert set(found) == {("10", "9"), ("10", "11"), ("11", "9")}
    metrics = similarity.pair_metrics(groups, among, docs).first()
    assert (metrics.tp, metrics.fp, metrics.fn, metrics.tn) == (1, 2, 2, 1)
    out = str(tmp_path / "pairs")
    sinks.write_csv(pairs, out, files=1)
    assert spark.read.csv(out, header=True).count() == 3
