"""The manifest against a plain tree in memory, on awkward rows."""

import hashlib
import random

import pytest

from tickreport.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _tree(nodes, arity=3):
    rows = [nodes]
    while len(rows[-1]) > 1:
        rows.append([_h(*rows[-1][i:i + arity]) for i in range(0, len(rows[-1]), arity)])
    return rows


def _plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2], r[3]))
    trees = [_tree([r[2] for r in groups[g]]) for g in names]
    top = _tree([t[-1][0] for t in trees])
    for k, g in enumerate(names):
        for i, (id_, _, leaf, shown) in enumerate(groups[g]):
            node, beside = shown, []
            for rows_, at in ((trees[k], i), (top, k)):
                for nodes in rows_[:-1]:
                    first = at // 3 * 3
                    left, right = nodes[first:at], nodes[at + 1:first + 3]
                    beside += left + right
                    node, at = _h(*left, node, *right), at // 3
            yield id_, leaf, trees[k][-1][0], top[-1][0], _h(*beside), node, node == top[-1][0]


@pytest.mark.parametrize("levels,n,n_groups", [(1, 40, 12), (2, 300, 30), (6, 50, 3), (6, 1, 1)])
def test_equals_a_plain_tree(spark, levels, n, n_groups):
    rnd = random.Random(n)
    groups = [None, "", *(f"s{'é' * (k % 2)}{k}" for k in range(n_groups))]
    rows = [(rnd.choice([None, 2 ** 60 + 1, *range(60)]), "s0" if i % 3 == 0 else rnd.choice(groups), _h(str(i // 2)),
             _h(str(i // 2 + 1000 * (i % 5 == 0)))) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, shown string")
    got = [tuple(r) for r in merkle.manifest(df, shown_col="shown", levels=levels).collect()]
    assert sorted(got, key=str) == sorted(_plain(rows), key=str)


def test_proofs_fold_to_the_root_and_tampering_shows(spark):
    rows = [(i, "a b" if i % 2 else None, _h(str(i)), i) for i in range(20)]
    df = spark.createDataFrame(rows, "`the id` int, `tree` string, `pos` string, path int")
    out = merkle.manifest(df, "the id", "tree", "pos", levels=1, with_path=True).collect()
    assert all(r["verified"] and merkle.fold(r["leaf"], r["path"]) == r["root"] for r in out) and len(out) == 20
    assert all(merkle.fold(_h("x"), r["path"]) != r["root"] for r in out)
    assert out[0].asDict().keys() == {"the id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "path"}


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, source string, leaf string")
    assert merkle.manifest(none).collect() == []


def test_leaf_text(spark):
    df = spark.createDataFrame([(12, None, "é\n")], "a long, b string, c string")
    assert df.select(merkle.leaf_digest([df.a, df.b, df.c])).first()[0] == _h("2:12", "-", "3:é\n")
