import hashlib
import zlib
from itertools import groupby

import duckdb
import pytest

from quayside.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    """(levels, root): lists of digests, and what is left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 16])) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, at):
    """(left, right) digests of the runs met from place ``at`` upwards."""
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append((level[first:at], level[at + 1 : first + 16]))
        at //= 16
    return out


def plain_proofs(rows):
    def leaf(values):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = []
    for doc_id, text, lang, source, n_chars in rows:
        values = (doc_id, source, lang, n_chars, text)
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        low = (*values[:4], text if text is None or not tampered else text.translate(table))
        made.append((source, doc_id, leaf(values), leaf(low)))

    def order(r):
        return ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0), r[2])

    groups = [list(g) for _, g in groupby(sorted(made, key=order), key=lambda r: r[0])]
    trees = [plain_tree([r[2] for r in g]) for g in groups]
    top = plain_tree([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, (group, tree) in enumerate(zip(groups, trees, strict=True)):
        for at, (_, doc_id, digest, now) in enumerate(group):
            path = siblings(tree, at) + siblings(top, k)
            for left, right in path:
                now = sha("".join([*left, now, *right]))
            root = top[-1][0]
            out.append((doc_id, digest, tree[-1][0], root, sha("".join("".join(a) + "".join(b) for a, b in path)), now, now == root))
    return sorted(out, key=str)


def rows_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def check(docs, scratch):
    got = sorted((tuple(r) for r in manifest.proofs(docs, scratch).collect()), key=str)
    assert got == plain_proofs(rows_of(docs))
    return got


def test_odd_documents_against_the_plain_version(spark, scratch, odd_documents):
    got = check(odd_documents, scratch)
    assert len(got) == odd_documents.count()


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [300, 1, 16], [3] * 20])
def test_trees_of_all_shapes(spark, scratch, sizes):
    rows = [(k * 1000 + i, f"Text {i}", "en", None if k == 1 else f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = check(docs, scratch)
    assert any(not r[-1] for r in got) or len(rows) < 20


def test_an_empty_table(spark, scratch, odd_documents):
    found = manifest.proofs(odd_documents.limit(0), scratch)
    assert found.columns == manifest.proofs(odd_documents, scratch).columns and found.collect() == []


def test_tampering_shows_and_only_there(spark, scratch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in manifest.proofs(docs, scratch).collect():
        text = texts[row.doc_id] if zlib.crc32(str(row.doc_id).encode()) % 5 == 0 else ""
        changed = any("A" <= c <= "Z" for c in text or "")
        assert row.verified != changed


def test_the_sql_agrees_with_the_plain_version(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    got = sorted(con.sql(manifest.oracle_sql()).fetchall(), key=str)
    assert got == plain_proofs(rows_of(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))


def test_the_row_limit_of_the_session_is_put_back(spark, scratch, odd_documents):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    manifest.proofs(odd_documents, scratch)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
