import math
import re
from collections import Counter, defaultdict

import pytest

from quayside.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MARKS = ".,;:!?'\"()-"


def plain_class(c):
    code = len(c.encode())
    if code > 1:
        return 6 + code
    return next(
        k for k, has in enumerate([c in "aeiou", c.islower(), c.isupper(), c.isdigit(), c in " \t\n\r\v\f", c in MARKS, "!" <= c <= "~", True]) if has
    )


def plain_counts(text):
    words = WORD.findall(text or "")
    times = Counter(zip(words, words[1:], words[2:], strict=False))
    again = {i + j for i, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if times[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(again)


def lower(word):
    return word.lower().strip(MARKS)


def plain_references(rows):
    classes, words = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang in rows:
        if text is not None and lang is not None:
            classes[lang].update(map(plain_class, text))
            words[lang].update(map(lower, WORD.findall(text)))
    every = sum(sum(w.values()) for w in words.values())
    out = {}
    for lang in sorted(words):
        n = sum(words[lang].values())
        if n and n >= quality.LANGUAGE_SHARE * every:
            total = sum(classes[lang].values())
            out[lang] = (
                {k: v / total for k, v in classes[lang].items()},
                {w: v / n for w, v in words[lang].items() if v >= quality.COMMON_SHARE * n},
            )
    return out


def plain_distance(p, q):
    total = 0
    for k in {*p, *q}:
        a, b = p.get(k, 0), q.get(k, 0)
        total += sum(x / 2 * math.log2(2 * x / (a + b)) for x in (a, b) if x)
    return math.sqrt(max(total, 0))


def with_rest(shares):
    return shares | {None: max(0, 1 - sum(shares.values()))}


def plain_verdict(text, refs):
    n, chars, _, _, again = plain_counts(text)
    failed = n < 50 or 100 * again > 50 * n
    if not refs:
        return failed, not failed, None, None, None
    words = Counter(map(lower, WORD.findall(text or "")))
    by = {lang: plain_distance(with_rest({w: words[w] / n for w in common if words[w]}), with_rest(common)) if n else 1.0 for lang, (_, common) in refs.items()}
    lang = min(by, key=lambda k: (round(by[k], 9), k))
    classes = Counter(map(plain_class, text or ""))
    far = plain_distance({k: v / len(text) for k, v in classes.items()} if text else {}, refs[lang][0])
    kept = not failed and (far <= quality.CLASS_LIMIT or chars < quality.MIN_CHARS) and (by[lang] <= quality.WORD_LIMIT or n < quality.MIN_WORDS)
    return failed, kept, lang, far, by[lang]


def compare(docs, scratch):
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    refs = plain_references(rows)
    made = quality.learn(docs, scratch)
    assert made.languages == list(refs)
    assert [set(w) for w in made.words] == [set(c) for _, c in refs.values()]
    found = quality.judge(docs, made).collect()
    expected = [(i, *plain_counts(text), *plain_verdict(text, refs)) for i, text, _ in rows]
    key = lambda r: tuple((v is None, str(v)) for v in r[:6])
    assert len(found) == len(rows)
    for a, b in zip(sorted(map(tuple, found), key=key), sorted(expected, key=key), strict=True):
        assert a[:8] == b[:8]
        assert a[9:] == pytest.approx(b[9:], abs=1e-6)
        if a[9] is not None and b[1]:
            assert a[8] == b[8]
    return found


def test_given_documents_against_the_plain_version(spark, scratch):
    found = compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), scratch)
    assert any(r.kept for r in found) and any(not r.kept and not r.base_failed for r in found)


def test_odd_documents_against_the_plain_version(spark, scratch, odd_documents):
    compare(odd_documents, scratch)


def test_an_empty_table_and_one_without_languages(spark, scratch, odd_documents):
    made = quality.learn(odd_documents.limit(0), scratch)
    assert made.languages == [] and quality.judge(odd_documents.limit(0), made).collect() == []
    nameless = odd_documents.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    found = quality.judge(nameless, quality.learn(nameless, scratch)).collect()
    assert {r.language for r in found} == {None} and all(r.kept != r.base_failed for r in found)


def test_good_prose_stays_and_junk_goes(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.judge(docs, quality.learn(docs, scratch)).join(labels, "doc_id").where("n_words >= 50").toPandas()
    assert found[found.quality == 1].kept.mean() >= 0.95
    assert (~found[found.quality == 0].kept).mean() >= 0.9


def test_the_language_column_does_not_decide(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    made = quality.learn(docs, scratch)
    assert quality.judge(docs.withColumnRenamed("lang", "other"), made).exceptAll(quality.judge(docs, made)).count() == 0
