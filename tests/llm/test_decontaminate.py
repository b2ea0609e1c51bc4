import re

from pyspark.sql import functions as F

from quayside.llm import decontaminate
from quayside.llm.decontaminate import similarity

SF = "/root/testdata/sf0.01"


def plain_words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_leaks(docs, items, threshold=0.8):
    out = {}
    items = [(i, plain_words(t)) for i, t in items]
    known = {tuple(w[j : j + 5]) for _, w in items for j in range(max(1, len(w) - 4)) if w}
    for d, text in docs:
        w = plain_words(text)
        for i, item in items:
            if not item:
                continue
            n = len(item)
            for k in range(len(w) - n + 1):
                if any(tuple(w[k + j : k + j + min(5, n)]) in known for j in range(max(1, n - 4))):
                    s = similarity(w[k : k + n], item)
                    if s >= threshold:
                        out[d, i] = max(s, out.get((d, i), 0))
    return out


def test_against_all_windows(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.leaks(docs, items, scratch).collect()}
    assert got == plain_leaks([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()]) and got


def test_edited_passages(spark, scratch):
    words = [f"w{i}" for i in range(60)]
    item = " ".join(words)
    edited = [" ".join(words[:30] + ["NEW"] + words[31:]), " ".join(words[:5] + ["NEW"] + words[6:40] + ["N"] + words[41:]), "W0, " + " ".join(words[1:])]
    docs = [(k, f"before it. {e.upper()} and after") for k, e in enumerate([item, *edited])] + [(9, "nothing of it here"), (10, " ".join(words[:30]))]
    got = {
        r["doc_id"]: r
        for r in decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"), scratch).collect()
    }
    assert sorted(got) == [0, 1, 3] and got[0]["similarity"] == 1.0 and got[0]["first_word"] == 2 and got[0]["n_words"] == 60
    assert abs(got[1]["similarity"] - 51 / 61) < 1e-12  # two edits leave 46 of 66 shingles


def test_blocks_find_every_near_print():
    import numpy as np

    rng = np.random.default_rng(0)
    prints = rng.integers(0, 2**63, 40).astype(np.uint64)
    noise = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 25), replace=False)) for _ in range(2000)], dtype=np.uint64)
    windows = prints[rng.integers(0, 40, 2000)] ^ noise
    size = (np.arange(40), prints, [decontaminate._block_table(prints, b, 15 // 4) for b in range(4)])
    found = set(zip(*(x.tolist() for x in decontaminate._candidates(windows, size, 15)), strict=True))
    near = np.bitwise_count(windows[:, None] ^ prints) <= 15
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_several_passes_agree(spark, scratch, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(tuple, decontaminate.leaks(docs, items, scratch).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS_PER_PASS", 15)
    assert sorted(map(tuple, decontaminate.leaks(docs, items, scratch).collect())) == whole


def test_odd_rows(spark, scratch, odd_documents):
    items = spark.createDataFrame([(0, None), (1, ""), (2, "no id here"), (2, "no id here"), (None, "one"), (4, "123")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.leaks(odd_documents, items, scratch).where("doc_id is not null and item_id is not null").collect())
    assert got == [(7, 4)]
    left = decontaminate.without_leaks(odd_documents, items, scratch)
    assert left.columns == odd_documents.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 5]


def test_clean_rows_stay_beside_leaks_of_the_same_id(spark, scratch):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(None, words), (None, "a clean text"), (None, None), (5, words), (5, "another clean text"), (5, ""), (6, "clean too"), (6, "clean too")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, words)], "item_id long, text string")
    left = decontaminate.without_leaks(docs, items, scratch).collect()
    assert sorted(map(tuple, left), key=str) == sorted((r for r in rows if r[1] != words), key=str)


def test_empty_tables(spark, scratch, odd_documents):
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert decontaminate.leaks(odd_documents.where(F.lit(False)), items, scratch).count() == 0
    assert decontaminate.leaks(odd_documents, items.where(F.lit(False)), scratch).count() == 0


def test_texts_shorter_than_the_item(spark, scratch):
    words = [f"w{i}" for i in range(59)]
    texts = [words[1:], words[:-2], words[1:-1], words[:48], words[:47], words[11:], words, words[2:] + ["x"], words[:3], []]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(words)), (8, "one two"), (9, " ".join(f"z{i}" for i in range(300)))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.leaks(docs, items, scratch).collect()}
    # 44 of 55 shingles are 0.8, 43 are below
    assert sorted(got) == [0, 1, 2, 3, 5, 6, 7]
    assert abs(got[0]["similarity"] - 54 / 55) < 1e-12 and (got[0]["first_word"], got[0]["n_words"]) == (0, 58)
    assert abs(got[3]["similarity"] - 44 / 55) < 1e-12 and got[6]["similarity"] == 1.0 and got[6]["n_words"] == 59
    assert sorted(r["doc_id"] for r in decontaminate.without_leaks(docs, items, scratch).collect()) == [4, 8, 9]


def test_recall_of_edited_passages():
    """Of passages at or above the threshold, the fingerprints lose no more than the radius of three deviations says."""
    import random

    import pyarrow as pa

    rng = random.Random(7)
    texts, items, wanted = [], [], set()
    for i in range(3000):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice((50, 59, 100, 120)))]
        edited = list(words)
        for at in rng.sample(range(len(words)), len(words) // 50):
            edited[at] = "new"
        items.append(" ".join(words))
        texts.append(" ".join(["before", *edited, "after"]))
        if similarity(edited, words) >= 0.8:
            wanted.add((i, i))
    block = decontaminate.Items(pa.array(range(len(items))), pa.array(items, pa.large_string()))
    found = {(t, n) for t, n, *_ in decontaminate.find(pa.array(texts, pa.large_string()), block)}
    assert found <= wanted and len(wanted) > 2000
    assert len(wanted - found) <= 0.002 * len(wanted)
