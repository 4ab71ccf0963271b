import public_tokenizers
import pytest
import tiktoken

from loomset.llm import bpe, queries
from verify_queries import comparable, duck


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_against_its_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = duck(sf_dir).sql(queries.ORACLES[name])
    columns, want = result.columns, result.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert comparable([tuple(r) for r in df.collect()], df.columns) == comparable(want, columns)


def test_contract_columns(spark, sf_dir, documents):
    sizes = {r.doc_id: len(r.text) for r in documents.collect()}
    columns = {
        "op1_odd_sketches": {"doc_id", "n_shingles", "component_id", "kept"},
        "op2_chat_events": {"conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"},
        "op4_language_centroids": {"doc_id", "held_out", "lang_pred", "score"},
        "op6_url_trees": {"page_id", "host", "path", "rule", "verdict"},
    }
    for name, wanted in columns.items():
        assert wanted <= set(queries.QUERIES[name](spark, sf_dir).columns)
    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        special_tokens={},
    )
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in queries.QUERIES["op5_merge_replay"](spark, sf_dir).collect():
        assert r.n_tokens == len(encoding.encode_ordinary(texts[r.doc_id])) and sizes[r.doc_id] == len(texts[r.doc_id])
