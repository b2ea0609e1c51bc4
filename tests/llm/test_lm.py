import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quayside.llm import lm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def out(i, folds=7):
    return zlib.crc32(("" if i is None else str(i)).encode()) % folds == 2


class PlainModel:
    """Interpolated Witten-Bell over bytes within words, by dictionaries, without n-grams met less than ``least`` times."""

    def __init__(self, texts, least):
        self.known = {}
        self.grams = [Counter() for _ in range(lm.ORDER + 1)]
        for text in texts:
            for strings, _ in self.steps(text):
                for k in range(1, len(strings) + 1):
                    self.grams[k][strings[-k:]] += 1
        self.kept = [{g: n for g, n in level.items() if n >= least} for level in self.grams]
        self.context = [{} for _ in self.grams]
        for k, level in enumerate(self.grams):
            for g, n in level.items():
                whole, kinds, kept = self.context[k].get(g[:-1], (0, 0, 0))
                self.context[k][g[:-1]] = (whole + n, kinds + 1, kept + (n if n >= least else 0))

    @staticmethod
    def steps(text):
        """Each symbol with those it depends on, up to the model's order and three of the text before its word."""
        told = b"\n"
        for word in text:
            own = b"\n" if word is None else word.encode() + b" "
            # a text starts with the end of the one before, a space and a line feed
            before = (b" " + told if told == b"\n" else told)[-3:]
            for e in range(len(own)):
                yield (before + own[: e + 1])[-lm.ORDER :], word
            told += own

    def p(self, gram):
        if gram not in self.known:
            self.known[gram] = self.found(gram)
        return self.known[gram]

    def found(self, gram):
        if not gram:
            return 1 / 256
        lower = self.p(gram[1:])
        k = len(gram)
        if gram[:-1] not in self.context[k] or (k > 2 and gram[:-1] not in self.kept[k - 1]):
            return lower
        whole, kinds, kept = self.context[k][gram[:-1]]
        return (self.kept[k].get(gram, 0) + (whole - kept + kinds) * lower) / (whole + kinds)

    def score(self, text):
        return sum(math.log10(self.p(s)) for s, _ in self.steps(text))


def plain_scores(rows, least):
    train = Counter(t for i, text in rows if not out(i) for t in tokens(text))
    n, v = sum(train.values()), len(train)
    model = PlainModel([tokens(text) for i, text in rows if not out(i)], least)
    result = []
    for i, text in rows:
        mine = tokens(text)
        score = model.score(mine)
        result.append((i, out(i), len(mine), sum(train[t] > 0 for t in mine), n, sum(math.log10((train[t] + 1) / (n + v + 1)) for t in mine), score))
    return result


@pytest.mark.parametrize(("least", "part_rows"), [(2, 2_000_000), (2, 2_000), (20, 5_000)])
def test_against_dictionaries(spark, scratch, odd_documents, monkeypatch, least, part_rows):
    monkeypatch.setattr(lm, "PART_ROWS", part_rows)
    monkeypatch.setattr(lm, "FREQUENT", 50)
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (30, 50))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(odd_documents.select(F.col("doc_id") - 100, "text").toDF("doc_id", "text"))
    got = sorted(map(tuple, lm.scores(docs.repartition(4), scratch, least=least).collect()), key=lambda r: (r[0] is None, r[0] or 0))
    expected = sorted(plain_scores([tuple(r) for r in docs.collect()], least), key=lambda r: (r[0] is None, r[0] or 0))
    assert len(got) == len(expected)
    for g, e in zip(got, expected, strict=True):
        assert g[:5] == e[:5]
        assert math.isclose(g[5], e[5], rel_tol=1e-9)
        # stored costs are rounded up by up to 1/1024 of a factor of two, for each of up to six steps
        symbols = 40 * g[2]
        assert e[6] - symbols * 6 / lm.STEPS * math.log10(2) - 1e-6 <= g[6] <= e[6] + 1e-6 * abs(e[6])
    held = [r for r in got if r[1] and r[0] is not None and r[0] >= 0]
    assert held and sum(r[6] for r in held) > 1.5 * sum(r[5] for r in held)


def plain_trie(model, folder, of):
    """The trie's files from a plain model's counts."""
    rows = []
    for k in range(1, lm.ORDER + 1):
        for g, n in model.kept[k].items():
            whole, kinds, kept = model.context[k][g[:-1]]
            rows.append((k, int.from_bytes(g, "big"), n / (whole + kinds), (whole - kept + kinds) / (whole + kinds)))
    k, gram, own, rest = (np.array(c, dtype=t) for c, t in zip(zip(*sorted(rows), strict=True), (int, np.int64, float, float), strict=True))
    low = lm.low_orders(k, gram, own, rest)
    three, long = k == 3, k >= 3
    (folder / "head").write_bytes(lm.build_head(low, gram[three] >> 8, rest[three]))
    k, gram, own, rest = k[long], gram[long], own[long], rest[long]
    cost, rest, part = lm._stored(lm.smoothed(k, gram, own, rest, low)), lm._stored(rest), lm.part_of(gram >> 8 * (k - 3), of)
    files = {}
    for i in sorted(set(part.tolist())):
        files[i] = str(folder / f"part{i}")
        (folder / f"part{i}").write_bytes(lm.build_part(k[part == i], gram[part == i], cost[part == i], rest[part == i]))
    return lm.Trie(str(folder / "head"), files, of)


@pytest.mark.parametrize("of", [1, 5])
def test_probabilities_sum_to_one_at_most(tmp_path, of):
    model = PlainModel([["the", "then", "that", "a", None], ["an", "and", "é", "the", "the", None], ["the", "then", "a", None]] * 2, 0)
    found = plain_trie(model, tmp_path, of)
    for context in (b"", b" ", b"e t", b" th", b" the", b" q", b" \xc3", b"hen the"[1:], b" \n"):
        keys = [int.from_bytes(context + bytes([s]), "big") | len(context) + 1 << 56 for s in range(256)]
        p = 2.0 ** -found.gram_costs(np.array(keys, np.uint64))
        assert 0.99 < p.sum() <= 1.0000001
        for s in range(256):
            # a cost is rounded up once where found and once for each longer context left
            assert model.p(context + bytes([s])) * 2 ** (-6 / lm.STEPS) <= p[s] * 1.0000001 <= model.p(context + bytes([s])) * 1.000001


def test_the_model_grows_with_the_corpus(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    sizes = []
    for rows in (docs.limit(100), docs):
        counts = scratch.keep(lm.count(rows, np.zeros(0, np.int64), "text"), "counts")
        model = lm.learn(counts, scratch)
        sizes.append(sum(len(open(f"{scratch.root}/{name}", "rb").read()) for name in model.parts.values()))
    assert sizes[1] > 3 * sizes[0]


def test_elias_fano():
    rng = np.random.default_rng(0)
    for values in ([0], [5, 5, 5], np.sort(rng.integers(0, 10**6, 5000)), np.sort(rng.integers(0, 100, 3000)), np.arange(200) * 10**9):
        values = np.array(values, dtype=np.uint64)
        coded = lm.EliasFano(lm.ef_arrays(values))
        assert (coded[np.arange(len(values))] == values.astype(np.int64)).all()


def test_empty_tables(spark, scratch, odd_documents):
    assert lm.scores(odd_documents.where(F.lit(False)), scratch).count() == 0
    (row,) = lm.scores(spark.createDataFrame([(1, "one two")], "doc_id long, text string"), scratch).collect()
    assert row["n_tokens"] == 3 and row["train_tokens"] in (0, 3)


def test_a_task_hands_its_ngrams_on_once(monkeypatch):
    texts = ["the then that thing", "an and \x00 \u00e9 the", None, "", "zz top"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    frequent = np.sort(lm._Batch(pa.array(["the", "zz", "never"], pa.large_string())).hashes)
    expected = Counter()
    for text in texts:
        for strings, _ in PlainModel.steps(tokens(text)):
            expected[len(strings), int.from_bytes(strings, "big")] += 10

    def rows(held):
        monkeypatch.setattr(lm, "HELD", held)
        return [tuple(r.values()) for b in lm._counted([batch] * 10, "text", frequent) for r in b.to_pylist()]

    got = rows(2_000_000)
    grams = {(kind, key): n for kind, key, n in got if 0 < kind <= lm.ORDER}
    assert grams == expected and len(got) == len(expected) + 2 + 2
    assert sorted(n for kind, _, n in got if kind == 0) == [10, 20] and [n for kind, _, n in got if kind >= 100] == [160, 50]
    summed = Counter()
    for kind, key, n in rows(50):
        summed[kind, key] += n
    assert summed == {(kind, key): n for kind, key, n in got}


def test_costs_remembered_in_few_places(monkeypatch):
    class Plain:
        def gram_costs(self, keys):
            return keys * 0.5

    monkeypatch.setattr(lm, "REMEMBERED", 3)
    monkeypatch.setattr(lm, "_remembered", {})
    monkeypatch.setattr(lm, "trie", lambda model: Plain())
    rng = np.random.default_rng(0)
    for _ in range(50):
        keys = np.unique(rng.integers(1, 40, 20).astype(np.uint64))
        assert (lm._gram_costs(lm.Model("head", {}, 1), keys) == keys * 0.5).all()
        assert all(len(a) == 8 for a in lm._remembered["head"])
