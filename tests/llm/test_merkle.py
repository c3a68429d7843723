"""Manifests, proofs and versions against a plain tree, and against SQL."""

import hashlib
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from jobmart.llm import merkle, oracle, queries
from jobmart.llm.merkle import PersistentTree, climb

COLS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def way(lv, pos):
    out = []
    for level in lv[:-1]:
        at = pos - pos % 2
        out.append((level[at:pos], level[pos + 1:at + 2]))
        pos //= 2
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13])
def test_persistent_tree(n):
    leaves = [h(str(i)) for i in range(n)]
    tree, plain = PersistentTree(leaves), levels(leaves)
    assert tree.top == plain[-1][0]
    before = list(tree.digests)
    for i in range(n):
        siblings, sides = tree.way(i)
        assert siblings == [x for a, b in way(plain, i) for x in a + b]
        assert [leaves[i], *climb(leaves[i], siblings, sides)][-1] == tree.top
        copies = tree.version(i, h("new"))
        changed = leaves[:i] + [h("new")] + leaves[i + 1:]
        assert tree.digests[copies[-1]] == levels(changed)[-1][0] and len(copies) == len(plain)
    assert tree.digests[:len(before)] == before  # the first version is shared, never changed


def test_blocks_of_full_height():
    """A block with one leaf climbs as far as the others."""
    assert PersistentTree([h("x")], 3).top == h(h(h(h("x"))))


def proofs_of(spark, rows, height, extra=""):
    df = spark.createDataFrame([(*r, *["z"] * extra.count(",")) for r in rows], "doc_id long, source string, lang string, n_chars long, text string" + extra)
    leaf = merkle.leaf_digest(*[F.col(c) for c in COLS])
    new = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.lit("tampered"), 256))
    tree = merkle.manifest(df, "lang", "doc_id", leaf, new, height)
    return tree, [r.asDict() for r in tree.proofs.collect()]


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equals_plain_tree(spark, height):
    r = random.Random(height)
    rows = [(i, r.choice([None, "a", "bé"]), r.choice([None, "", "de", "en", "en", "en", "en", "zé"]), r.choice([None, 3]), r.choice([None, "", "t" * 50, "ü漢"])) for i in range(70)]
    rows += [rows[5], rows[5], (None, None, "en", None, None), (None, None, None, None, "x"), (2 ** 60 + 1, "s", "en", 1, "big id")]
    tree, got = proofs_of(spark, rows, height, ", grp string, pos string, digest string, n string")
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(((row[0] is not None, row[0] or 0), h(*[field(row[i]) for i in (0, 1, 2, 3, 4)])))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for _, leaf in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    assert tree.root == top[-1][0] and len(got) == len(rows)
    assert {x["grp"]: x["digest"] for x in map(lambda x: x.asDict(), tree.subroots.collect())} == {g: trees[g][-1][0] for g in names}
    for x in got:
        lv = trees[x["grp"]]
        steps = way(lv, x["pos"]) + way(top, names.index(x["grp"]))
        assert x["leaf"] == lv[0][x["pos"]] and x["subroot"] == lv[-1][0]
        assert x["siblings"] == [s for a, b in steps for s in a + b]
        value, copies = x["new_leaf"] or x["leaf"], []
        for a, b in steps:
            value = h(*a, value, *b)
            copies.append(value)
        assert x["folded"] == value and (x["copies"] == copies if x["new_leaf"] else x["copies"] is None)
        assert (x["folded"] == tree.root) == (x["new_leaf"] is None)


def test_empty_table_and_single_row(spark):
    tree, got = proofs_of(spark, [], 2)
    assert tree.root is None and got == []
    tree, got = proofs_of(spark, [(3, None, None, None, None)], 2)
    assert tree.root == got[0]["leaf"] == got[0]["subroot"] and got[0]["siblings"] == [] and got[0]["folded"] == h("tampered")


def test_query_equals_sql_with_odd_rows(spark, docs, tmp_path):
    """The registered query on rows with nulls, groups of one and very large counts."""
    base = [(i, None if i % 11 == 0 else f"text {i} é" * (i % 4), "s" if i % 2 else None) for i in range(60)]
    df = docs(base, extra=", leaf string")
    lang = F.when(F.col("doc_id") % 4 == 1, "en").when(F.col("doc_id") % 4 == 2, "zé").when(F.col("doc_id") == 4, "")
    df = df.withColumns({"lang": lang, "n_chars": F.when(F.col("doc_id") == 7, F.lit(2 ** 63 - 1)).otherwise(F.col("n_chars"))})
    path = str(tmp_path / "documents.parquet")
    df.coalesce(1).write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    res = con.execute(oracle.oracle_sql()["op12_merkle"])
    got = queries.op12_merkle(spark, str(tmp_path))
    assert got.columns == [c[0] for c in res.description]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(res.fetchall(), key=str)
