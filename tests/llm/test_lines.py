import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import lines
from quayside.plans.session import Scratch


def plain_removed(docs, width=5, threshold=0.8):
    """(doc_id, line) of all lines with an earlier similar one, by comparing all pairs."""
    seen, out = [], set()
    for i, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n")):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in line).split()
            if not w:
                continue
            s = frozenset(" ".join(w[j : j + width]) for j in range(max(1, len(w) - width + 1)))
            if any(min(len(s), len(o)) >= threshold * max(len(s), len(o)) and len(s & o) >= threshold * len(s | o) - 1e-9 for o in seen):
                out.add((i, k))
            seen.append(s)
    return out


def removed(docs, scratch, **options):
    return {(r["id"], r["line"]) for r in lines.removed_lines(docs, scratch, **options).collect()}


def test_against_all_pairs(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = plain_removed([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert removed(docs, scratch) == expected and len(expected) > 50


def test_near_copies_and_ties(spark, scratch):
    rng = random.Random(3)
    base = [f"w{rng.randrange(200)}" for _ in range(120)]
    docs = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(50)}"
        docs.append((i, "\n".join([" ".join(w), " ".join(w[:7]), " ".join(w[: rng.randrange(1, 5)]), ""])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for threshold in (0.6, 0.8, 0.95):
        assert removed(df, scratch, threshold=threshold) == plain_removed(docs, threshold=threshold)


def test_prefix_covers_the_threshold():
    for n in range(1, 200):
        assert lines.prefix_length(n, 0.8) == n - math.ceil(round(0.8 * n, 9)) + 1


def test_odd_rows(spark, scratch, odd_documents):
    out = lines.without_repeats(odd_documents, scratch)
    assert out.columns == [*odd_documents.columns, "n_removed"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == odd_documents.count()
    assert rows[0]["text"] is None and rows[0]["n_lines"] == 0 and rows[1]["text"] == "" and rows[1]["n_lines"] == 1
    assert rows[5]["text"] == "  \t\n\n " and rows[5]["n_removed"] == 0
    assert rows[6]["text"] == "Élan vital, 你好 ▁ x\x00y\n" and rows[6]["n_removed"] == 1
    assert rows[3]["text"] == "one" and rows[None]["text"] == "no id here at all"


def test_empty_table(spark, scratch, odd_documents):
    assert lines.without_repeats(odd_documents.where(F.lit(False)), scratch).count() == 0


def test_postings_travel_sorted_and_packed():
    rng = np.random.default_rng(0)
    key, low = np.sort(rng.integers(0, 1 << 56, 1000, dtype=np.uint64)), rng.integers(0, 1 << 64, 1000, dtype=np.uint64)
    data = lines._packed(key, low)
    assert len(data) == 15 * len(key)
    assert all((a == b).all() for a, b in zip(lines._unpacked(data), (key, low), strict=True))


def test_texts_are_not_dealt_again_for_a_few_lines(spark, monkeypatch):
    rng = random.Random(5)
    docs = []
    for i in range(60):
        w = [f"w{k}" for k in range(60)]
        w[rng.randrange(60)] = f"x{rng.randrange(9)}"
        docs.append((i, " ".join(w[: rng.randrange(40, 60)]) + "\nnone like this " + str(i)))
    docs += docs[:30] * 3  # rows with the same id and text are one document
    plans = {}

    class Seen(Scratch):
        def keep(self, df, label):
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
            return super().keep(df, label)

    scratch = Seen(spark)
    monkeypatch.setattr(lines, "LEAST_GROUPS", 7, raising=False)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert removed(df, scratch) == plain_removed(set(docs))
    assert not re.findall(r"hashpartitioning\(id", plans["matched"])
    scratch.clear()
