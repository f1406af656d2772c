"""The Merkle manifest against a plain version, proofs of single leaves, edges."""

import hashlib

import pytest

from metricstore.llm import merkle

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests):
    """(root, path of each leaf: [(left, right)] from the leaf up)."""
    paths, at, nodes = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(nodes) > 1:
        for path, k in zip(paths, at):
            run = k - k % 3
            path.append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + 3])))
        nodes = [H("".join(nodes[k:k + 3])) for k in range(0, len(nodes), 3)]
        at = [k // 3 for k in at]
    return nodes[0], paths


def plain(rows):
    """rows (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, path)."""
    key = lambda v: (v is not None, v)
    groups = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for g in groups:
        members = sorted(((r[0], leaf(r)) for r in rows if r[1] == g), key=lambda x: (key(x[0])[0], x[0] or 0, x[1]))
        made.append((members, *tree([d for _, d in members])))
    if not made:
        return []
    root, tops = tree([sub for _, sub, _ in made])
    return sorted(((d, h, sub, root, path + top) for (members, sub, paths), top in zip(made, tops)
                   for (d, h), path in zip(members, paths)), key=str)


def sides(proof):
    return [(bytes(s["left"]).hex(), bytes(s["right"]).hex()) for s in proof]


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def rows_of(sizes):
    out, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            out.append((k * 7 % 1009, s, None if k % 4 else "en", None if k % 5 == 0 else k, f"té\n{k}" if k % 3 else None))
            k += 1
    return out


CASES = {
    "heights": {"a": 1, "b": 2, "c": 3, "d": 4, None: 28, "Z": 82, "é": 9, "": 10},
    "one": {"only": 1},
    "one group": {None: 250},
    "many groups": {f"s{i}": 1 + i % 2 for i in range(30)},
}


@pytest.mark.parametrize("case", CASES)
def test_proofs_equal_plain_ones(spark, tmp_path, case):
    rows = rows_of(CASES[case])
    if case == "heights":
        rows += [(None, "a", None, None, None), (3, "b", "x", 1, "same"), (3, "b", "x", 1, "same"), (3, "b", "x", 1, "other")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA + ", tree int, leaf string").repartition(5)
    merkle.write_manifest(df, f"{tmp_path}/m")
    got = merkle.verify(spark, f"{tmp_path}/m").collect()
    want = plain(rows)
    assert sorted(((r["id"], r["leaf"], r["subroot"], r["root"], sides(r["proof"])) for r in got), key=str) == want
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_requested_leaves_and_changed_rows(spark, tmp_path):
    rows = rows_of(CASES["heights"])
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    other = merkle.leaf_digest({c: F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.LEAF_COLUMNS})
    path = f"{tmp_path}/m"
    merkle.write_manifest(df, path, carry={"shown": other})
    every = {(r["tree"], r["rank"]): r for r in merkle.verify(spark, path, "shown").collect()}
    texts = {r[0]: r[4] for r in rows}
    assert all(r["verified"] == (texts[r["id"]] is None) for r in every.values())
    some = sorted(every)[::17]
    asked = spark.createDataFrame(some + some[:2], "tree long, rank long")
    got = {(r["tree"], r["rank"]): r for r in merkle.proofs(spark, path, asked).collect()}
    assert sorted(got) == some
    assert all(got[k]["proof"] == every[k]["proof"] and got[k]["root"] == every[k]["root"] for k in some)


def test_empty_table(spark, tmp_path):
    merkle.write_manifest(spark.createDataFrame([], SCHEMA), f"{tmp_path}/m")
    out = merkle.verify(spark, f"{tmp_path}/m")
    assert out.count() == 0 and {"id", "leaf", "subroot", "root", "proof", "folded_root", "verified"} <= set(out.columns)


def test_equal_nodes_are_stored_once(spark, tmp_path):
    rows = [(1, "a", "x", 1, "same")] * 81 + [(2, "a", "x", 2, "end")]
    merkle.write_manifest(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/m")
    nodes = spark.read.parquet(f"{tmp_path}/m/nodes/top=0")
    assert nodes.where("height = 1").count() == 2
    assert merkle.verify(spark, f"{tmp_path}/m").where("verified").count() == 82


def test_plan_has_no_python(spark, tmp_path):
    merkle.write_manifest(spark.createDataFrame(rows_of({"a": 5}), SCHEMA), f"{tmp_path}/m")
    plan = merkle.verify(spark, f"{tmp_path}/m")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "CartesianProduct" not in plan
