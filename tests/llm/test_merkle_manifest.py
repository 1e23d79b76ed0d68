import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from veilcorpus.llm import merkle_manifest as mm

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    fields = [None if v is None else str(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])]
    return sha("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + arity])) for i in range(0, len(out[-1]), arity)])
    return out


def path(tree, at, arity):
    steps = []
    for level in tree[:-1]:
        start = at - at % arity
        steps.append(("".join(level[start:at]), "".join(level[at + 1 : start + arity])))
        at //= arity
    return steps


def brute(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = levels([leaf(r) for r in groups[name]], arity)
    top = levels([trees[n][-1][0] for n in names], arity)
    out = []
    for g, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = path(trees[name], at, arity) + path(top, g, arity)
            doc_id, altered = row["doc_id"], dict(row)
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row["n_chars"] is not None:
                altered["n_chars"] += 1
            node = leaf(altered)
            for left, right in steps:
                node = sha(left + node + right)
            root = top[-1][0]
            proof = sha("".join(left + right for left, right in steps))
            out.append((doc_id, leaf(row), trees[name][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def found(df):
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted([tuple(r[c] for c in cols) for r in df.select(cols).collect()], key=str)


def odd_rows():
    rng = random.Random(3)
    rows = [
        {"doc_id": i, "text": f"text {i} é日", "lang": rng.choice(["en", "en", "en", "de", "ü"]), "source": f"s{i % 3}", "n_chars": i}
        for i in rng.sample(range(-50, 4000), 90)
    ]
    rows += [{"doc_id": 7, "text": "same", "lang": "en", "source": None, "n_chars": 4}] * 30  # a third of a group is one row
    rows += [{"doc_id": 7, "text": f"same id {i}", "lang": "en", "source": "", "n_chars": None} for i in range(5)]
    rows += [{"doc_id": None, "text": None, "lang": None, "source": None, "n_chars": None}] * 2
    rows += [{"doc_id": 2**62, "text": "", "lang": "", "source": "", "n_chars": 2**63 - 1}]
    rows += [{"doc_id": i, "text": "long " * 50_000, "lang": "xx", "source": "-", "n_chars": 250_000} for i in range(3)]
    return rows


@pytest.mark.parametrize("height", [1, 2, 10])
def test_equals_brute_force(spark, monkeypatch, height):
    rows = odd_rows()
    monkeypatch.setattr(mm, "ROWS_A_TASK", 20)
    monkeypatch.setattr(mm.merkle_proofs, "__defaults__", ((), 2, height))
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    assert found(mm.document_manifest(docs.repartition(5))) == brute(rows)


def test_wider_runs_and_clashing_names(spark):
    rows = [{"doc_id": i, "text": str(i), "lang": "abc"[i % 3], "source": "s", "n_chars": 1} for i in range(50)]
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    for name in ("group", "key", "digest", "item", "row", "pos", "n", "place", "members", "top", "path", "l0", "block", "root"):
        docs = docs.withColumn(name, F.lit("user"))
    leaves = docs.withColumn("h", mm.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]))
    out = mm.merkle_proofs(leaves, "h", "lang", "doc_id", carry=["doc_id", "group"], arity=3, height=2)
    seen = {r["doc_id"]: r for r in out.withColumn("folded", mm.fold(F.col("path"), F.col("h"))).withColumn("p", mm.proof_digest(F.col("path"))).collect()}
    assert len(seen) == 50 and all(r["group"] == "user" and r["folded"] == r["root"] for r in seen.values())
    for doc_id, leaf_, subroot, root, proof, _, _ in brute(rows, arity=3):
        got = seen[doc_id]
        assert (got["h"], got["subroot"], got["root"], got["p"]) == (leaf_, subroot, root, proof)
    assert found(mm.document_manifest(docs)) == brute(rows)


def test_one_row_and_no_row(spark):
    row = {"doc_id": 1, "text": "a", "lang": "en", "source": "s", "n_chars": 1}
    one = mm.document_manifest(spark.createDataFrame([(1, "a", "en", "s", 1)], SCHEMA))
    assert found(one) == brute([row]) and one.first()["subroot"] == one.first()["leaf"] == one.first()["root"]
    none = mm.document_manifest(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns[:2] == ["doc_id", "leaf"]
    with pytest.raises(ValueError):
        mm.merkle_proofs(none, "leaf", "leaf", "doc_id", arity=1)
