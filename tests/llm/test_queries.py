"""Registered queries of the subpackage over the smallest tables."""

import duckdb

import __spark_entry__ as entry
from tidewatch.llm import queries

SF = "/root/testdata/sf0.001"

#: Columns that each query returns at least.
COLUMNS = {
    "op1_simhash": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op2_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op3_topk": "query_id rank vec_id score",
    "op4_quality": "doc_id held_out score predicted",
    "op5_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op6_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op7_language": "doc_id held_out lang_pred score",
    "op8_line_dedup": "doc_id n_lines n_removed kept_sha256",
    "op9_minhash": "doc_id n_shingles component_id kept",
    "op10_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_toxicity": "doc_id held_out score predicted",
    "op12_collocations": "lang rank phrase a l r n score",
    "op13_divergence": "lang source part item value rank",
}


def test_queries_return_their_columns_for_every_document(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    n = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert set(COLUMNS) == set(queries.REGISTRY) <= set(entry.queries()) and "pipeline" in entry.queries()
    for name, columns in COLUMNS.items():
        rows = entry.queries()[name](spark, SF).toPandas()
        assert set(columns.split()) <= set(rows.columns), name
        if name == "op2_packing":
            assert rows.doc_id.nunique() == n and rows.groupby("doc_id").length.sum().eq(rows.groupby("doc_id").doc_tokens.first()).all()
        elif name not in ("op3_topk", "op12_collocations", "op13_divergence"):
            assert len(rows) == n, name
        if name in queries.ORACLE:
            wanted = con.execute(queries.ORACLE[name]).df()[columns.split()]
            order = columns.split()
            got = rows[order].sort_values(order).reset_index(drop=True)
            wanted = wanted.sort_values(order).reset_index(drop=True)
            assert got.astype(str).equals(wanted.astype(str)), name
