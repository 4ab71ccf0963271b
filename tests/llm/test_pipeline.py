import hashlib
import re
from collections import Counter

import public_tokenizers
import tiktoken
from test_dedup import plain_components

import __spark_entry__ as contract
import corpus_pipeline
from loomset.llm import bpe, queries


def plain_mix(docs, weights=(3, 1, 2)):
    """Copies by document: one queue in the order of virtual finish times, cut at the budget."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text)) for i, text, _ in docs}
    order = sorted({s for _, _, s in docs}, key=lambda s: (s is None, s.encode() if s else b""))
    total = Counter()
    for i, _, s in docs:
        total[s] += size[i]
    queue = []
    for n, source in enumerate(order):
        own = [(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16), i) for i, _, s in docs if s == source and size[i]]
        done = 0
        for again in range(2):
            for h, i in sorted(own):
                done += size[i]
                queue.append((done / weights[n % len(weights)], n, h, i, again))
    budget, spent, copies = 1.5 * sum(total.values()), 0, Counter()
    for *_, i, _ in sorted(queue):
        spent += size[i]
        if spent > budget:
            break
        copies[i] += 1
    return copies


def test_all_stages_against_a_plain_version(spark, sf_dir, documents):
    docs = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    # No document of this table is without a language.
    last = {}
    for i, (text, _) in docs.items():
        last[text] = max(last.get(text, i), i)
    kept = {i: d for i, d in docs.items() if last[d[0]] == i}
    component, _ = plain_components([(i, text) for i, (text, _) in kept.items()], 5, 80)
    kept = {i: d for i, d in kept.items() if component[i] == i}
    copies = plain_mix([(i, *d) for i, d in kept.items()])
    encoding = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
        special_tokens={},
    )
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter(r.doc_id for r in got) == +copies
    for r in got:
        assert (r.text, r.source) == kept[r.doc_id]
        assert r.ids == encoding.encode_ordinary(r.text) and r.n_tokens == len(r.ids)


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        docs = docs.drop("ids")
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, sf_dir), "odd")
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns == [*columns, "ids", "n_tokens"]


def test_queries_are_registered():
    names = contract.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(names) and "pipeline" not in contract.oracle_sql()
