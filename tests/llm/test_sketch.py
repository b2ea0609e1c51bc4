import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quayside.llm import sketch


def sets(array):
    d = sketch.Digests(array)
    return d, [set(d.keys[a:b].tolist()) for a, b in zip(d.starts, d.starts[1:], strict=False)]


def test_peeling_recovers_the_differences():
    rng = np.random.default_rng(0)
    lines = [f"line {i} " + " ".join(f"w{x}" for x in rng.integers(0, 50, 9)) for i in range(400)]
    old, new = [], []
    for n in (0, 1, 3, 40, 300, 400):
        keep = rng.random(400) < 0.5
        old.append("\n".join(lines[:n]))
        new.append("\n".join([*(x for x, k in zip(lines[:n], keep, strict=False) if k), "added", "added", "added"][: max(n, 0) + 3]))
    (a, sa), (b, sb) = (sets(pa.array(t, pa.large_string())) for t in (old, new))
    rows = np.arange(len(old))
    pair, key, sign = sketch.differences(a, rows, b, rows)
    for r in rows:
        assert set(key[(pair == r) & (sign == 1)].tolist()) == sa[r] - sb[r]
        assert set(key[(pair == r) & (sign == -1)].tolist()) == sb[r] - sa[r]
        assert (pair == r).sum() == len(sa[r] ^ sb[r])
    near = sketch.likeness(a, rows, b, rows)
    assert np.allclose(near, [len(x & y) / len(x | y) for x, y in zip(sa, sb, strict=True)])


def test_a_full_sketch_is_tried_larger():
    text = ["\n".join(f"only here {i}" for i in range(500)), ""]
    d, s = sets(pa.array(text, pa.large_string()))
    small = sketch.Sketch(*d.of(np.array([0])), 1, sketch.CELLS)
    assert not small.peel()[3][0]
    _, key, _ = sketch.differences(d, np.array([0]), d, np.array([1]))
    assert set(key.tolist()) == s[0] and len(s[0]) >= 500


def plain(rows):
    """n_chars and edited text, one document after the other."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        third = len(text) // 3
        out.append((i, len(text), hashlib.sha256((text[: len(text) - third] + after[:third]).encode()).hexdigest(), text, after))
    return out


def test_edits_over_the_table(spark, scratch, odd_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_documents.select(F.col("doc_id") - 100, "text").toDF("doc_id", "text"))
    rows = sketch.edit_likeness(docs.repartition(5)).collect()
    expected = plain([(r["doc_id"], r["text"] or "") for r in docs.collect()])
    assert sorted((r["doc_id"] or 0, r["n_chars"], r["edited_sha256"]) for r in rows) == sorted((i or 0, n, s) for i, n, s, _, _ in expected)
    prints = {r["doc_id"]: r["fingerprint"] for r in sketch.fingerprints(docs.where("doc_id >= 0")).collect()}
    texts = {i: t for i, _, _, t, _ in expected}
    by_text = {}
    for r in rows:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is not None:
            assert by_text.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"] == prints.get(r["doc_id"], r["fingerprint"])
    long = [r for r in rows if r["n_chars"] > 1500]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)
    next_of = {i: n for i, _, _, _, n in expected}
    same = [r for r in rows if r["doc_id"] is not None and r["doc_id"] >= 0 and texts[r["doc_id"]] == next_of[r["doc_id"]]]
    assert all(r["near_next"] == 1.0 for r in same)


def test_small_tables(spark, scratch, odd_documents):
    assert sketch.edit_likeness(odd_documents.where(F.lit(False))).count() == 0
    (row,) = sketch.edit_likeness(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0


def test_changes_of_versions(spark):
    df = spark.createDataFrame([(1, "a\nb\nc", "a\nx\nc"), (2, None, ""), (3, "a\na", "a")], "doc_id long, old string, new string")
    rows = {r["doc_id"]: r for r in sketch.changes(df).collect()}
    assert (len(rows[1]["removed"]), len(rows[1]["added"]), rows[1]["likeness"]) == (1, 1, 0.5)
    assert rows[2]["likeness"] == 1.0 and (len(rows[3]["removed"]), len(rows[3]["added"]), rows[3]["likeness"]) == (1, 0, 0.5)
