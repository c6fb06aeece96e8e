"""The registered queries: their columns, one row per row, and their SQL."""

import math

import pytest

from encore.llm.queries import ORACLES, QUERIES, table

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"
#: First columns by contract.
COLUMNS = {
    "op1": "doc_id n_shingles component_id", "op2": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3": "doc_id n_bytes n_removed n_spans kept_sha256", "op4": "doc_id n_pieces pieces_sha256 round_trip",
    "op5": "page_id payload_bytes payload_digest record_type refers_to", "op6": "doc_id held_out score predicted", "op7": "doc_id source lang topic",
    "op8": "doc_id keep_id group_size kept text_sha256", "op9": "doc_id held_out score predicted", "op10": "doc_id n_bytes n_tokens over_limit",
    "op11": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256", "op12": "doc_id fingerprint component_id",
    "op13": "vec_id component n deviation whitened explained identity_error",
}


def _norm(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op11_conversation_trie", "op13_whitening")])
def test_query(spark, name):
    out = QUERIES[name](spark, SMALL)
    first = COLUMNS[name.split("_")[0]].split()
    assert out.columns[:len(first)] == first
    rows = out.collect()
    source = table(spark, SMALL, "pages" if name == "op5_warc" else "documents")
    assert sorted(r[0] for r in rows) == sorted(r[0] for r in source.select(source.columns[0]).collect())
    if name in ORACLES:
        import duckdb

        con = duckdb.connect()
        for t in ("documents", "pages", "labels"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
        res = con.execute(ORACLES[name])
        names = [d[0] for d in res.description]
        assert sorted(names) == sorted(out.columns)
        want = sorted(tuple(_norm(r[names.index(c)]) for c in out.columns) for r in res.fetchall())
        assert sorted(tuple(map(_norm, r)) for r in rows) == want
