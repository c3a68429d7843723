"""The pipeline against a brute-force version of its stages, and the SQL forms against the queries."""

import duckdb
import pytest
import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from jobmart.llm import oracle, pii, queries
from tests.paths import SF_SMALL
from tests.llm.test_packing import check
from tests.llm.test_quality import brute as quality_counts
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_equal_brute_force(spark):
    docs = corpus_pipeline.read(spark, SF_SMALL, "documents")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.staged(stage(spark, steps[-1], SF_SMALL), name.replace(" ", "-")))
    rows = [{r.doc_id: r for r in s.collect()} for s in steps[:4]]
    assert all(s.columns == docs.columns for s in steps[:5])
    # 1: nothing that fails the base rules stays, ordinary text does
    assert all(not quality_counts(r.text)[5] for r in rows[1].values()) and len(rows[1]) > 0.7 * len(rows[0])
    # 2: exactly the smallest id of every component
    prints = {i: plain_fingerprint(r.text) for i, r in rows[1].items()}
    want = plain_components(prints, 4)
    assert set(rows[2]) == {i for i, root in want.items() if i == root}
    # 3: the spans found are gone, all else is as it was
    model, limits = pii.fitted()
    for i, r in rows[2].items():
        spans = pii.find([r.text], model, limits)[0][1]
        assert rows[3][i].text == pii.redact(r.text, spans) and rows[3][i].n_chars == len(rows[3][i].text) and rows[3][i].source == r.source
    # 4: only documents of the stage before, none more than three times
    mixed = [r.doc_id for r in steps[4].collect()]
    assert set(mixed) <= set(rows[3]) and max(mixed.count(i) for i in set(mixed)) <= 3
    # 5: whole documents in gapless sequences
    texts = {i: rows[3][i].text for i in set(mixed)}
    pieces = [r for r in steps[5].collect()]
    assert sum(p.length for p in pieces) == sum(len(Tokenizer.from_file(P.path("byte_bpe_50k.json")).encode(texts[i], add_special_tokens=False).ids) + 1 for i in mixed)
    if len(set(mixed)) == len(mixed):
        check(pieces, texts, Tokenizer.from_file(P.path("byte_bpe_50k.json")))


def test_run_gives_pieces(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql_form(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(oracle.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    want = sorted(str([r[names.index(c)] for c in sorted(names)]) for r in cur.fetchall())
    got = queries.queries()[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names) and sorted(str([r[c] for c in sorted(names)]) for r in got.collect()) == want
