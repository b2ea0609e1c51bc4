import re

from pyspark.sql import functions as F

from quayside.llm import licenses


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_blocks(words, templates, threshold):
    """(start, label, share) of every window that starts with a word of a template and holds enough of its words."""
    for label, notice in templates:
        t, size = set(notice.split()), licenses.window_words(notice, threshold)
        for i, w in enumerate(words):
            shared = len(t & set(words[i : i + size])) if w in t else 0
            if shared and shared >= round(threshold * len(t), 9):
                yield i, label, shared / len(t)


def plain_scan(text, threshold=licenses.CONTAINMENT):
    w = plain_words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    more, best = set(), 0.0
    for _, label, share in plain_blocks(w, licenses.TEMPLATES, threshold):
        more.add(label)
        best = max(best, share)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best)


def texts():
    notices = [n for _, n in licenses.TEMPLATES]
    cut = [" ".join(n.split()[: int(len(n.split()) * s)]) for n in notices for s in (0.75, 0.85, 1.0)]
    return [
        *cut, "before\n" + notices[0].upper() + " more words\nafter", "Licensed under CC BY-NC 4.0.", "MIT LICENSE, mit license; Mit-License", "the gnu General\nPublic license", "gnu general public licenses",
        "cc byte cc  by", "Apache License apache license", "éMIT License MITé license K", notices[3] + "\n" + notices[7], " ".join(notices), "a" * 50_000 + " mit license", "0 CC BY 1 cc by",
    ]


def test_against_plain_words(spark, scratch, odd_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    own = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(texts())], "doc_id long, text string")
    docs = docs.unionByName(own).unionByName(odd_documents.select(F.col("doc_id") - 100, "text").toDF("doc_id", "text"))
    rows = licenses.scan(docs, scratch).collect()
    expected = [(r["doc_id"], *plain_scan(r["text"])) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, rows), key=key) == sorted(expected, key=key)
    assert sum(bool(r["labels"]) for r in rows) > 40


def test_every_containment(spark, scratch):
    """Random blocks against random templates at several thresholds."""
    import random

    rng = random.Random(5)
    templates = [(f"t{i}", " ".join(rng.sample([f"w{k}" for k in range(40)], rng.randrange(1, 15)))) for i in range(25)]
    docs = [(i, "\n".join(" ".join(rng.choices([f"w{k}" for k in range(60)], k=rng.randrange(0, 40))) for _ in range(4))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for threshold in (0.5, 0.8, 1.0):
        got = sorted((r["id"], r["block"], r["label"]) for r in licenses.notices(df, scratch, templates=templates, containment=threshold).collect())
        expected = sorted((i, block, label) for i, text in docs for block, label, _ in plain_blocks(text.split(), templates, threshold))
        assert got == expected and expected


def test_wrapped_notices_and_scattered_words(spark, scratch):
    grant = next(n for label, n in licenses.TEMPLATES if label == "mit").split()
    wrapped = "\n".join(" * " + " ".join(grant[i : i + 9]) for i in range(0, len(grant), 9))
    filler = [f"filler{i}" for i in range(400)]
    scattered = list(filler)
    for i, w in enumerate(["released", "under", "the", "mit", "license"]):
        scattered[80 * i + 7] = w
    rows = [(1, wrapped), (2, " ".join(scattered)), (3, " ".join([*filler, *grant, *filler] * 30)), (4, "Permission is hereby granted,\r\n\r\n" + wrapped[40:])]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), scratch).collect()}
    assert got[1] == ("mit", 1.0) and got[2] == ("", 0.0) and got[3] == ("mit", 1.0) and got[4][0] == "mit"


def test_no_python_on_the_main_path(spark, scratch, odd_documents):
    plan = licenses.scan(odd_documents, scratch)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert licenses.scan(odd_documents.where(F.lit(False)), scratch).count() == 0
