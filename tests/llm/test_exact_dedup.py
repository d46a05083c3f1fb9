import hashlib
import re
from collections import defaultdict

from jobmart.llm.exact_dedup import drop_duplicates, exact_groups


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[norm])
        keep = None if best[1] else best[2]
        out.append((doc_id, keep, len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def test_same_as_brute_force(spark, odd_docs, clashing_docs):
    want = expected([(r.doc_id, r.text) for r in odd_docs.collect()])
    for docs in (odd_docs, clashing_docs):
        got = exact_groups(docs, hash_all=True)
        assert sorted(map(tuple, got.select("doc_id", "keep_id", "group_size", "text_sha256").collect()), key=str) == want


def test_settled_texts_are_not_hashed(odd_docs):
    alone = exact_groups(odd_docs).where("group_size = 1")
    assert alone.where("text_sha256 IS NULL").count() == alone.count() > 0


def test_longest_then_smallest_id_stays(spark):
    docs = spark.createDataFrame([(5, "a b"), (3, "a  b"), (2, "ab "), (9, "a  b")], "doc_id long, text string")
    kept = exact_groups(docs).where("kept").collect()
    assert [(r.doc_id, r.keep_id, r.group_size) for r in kept] == [(3, 3, 4)]


def test_heavy_group(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text', concat('text ', id)) AS text")
    got = exact_groups(docs)
    assert got.count() == 3000
    assert got.where("group_size = 1000").select("keep_id").distinct().collect()[0][0] == 0
    assert drop_duplicates(docs).count() == 2001


def test_one_row_of_repeated_rows_stays(odd_docs, clashing_docs):
    for docs in (odd_docs, clashing_docs):
        kept = drop_duplicates(docs)
        assert kept.columns == docs.columns
        assert kept.where("doc_id = 7").count() == 1
        assert kept.where("doc_id = 8").count() == 2
        assert kept.where("doc_id IN (1, 2)").count() == 1
        assert kept.where("text IS NULL OR trim(text) = '' OR doc_id = 5").count() == 1


def test_no_rows(no_docs):
    assert exact_groups(no_docs).count() == drop_duplicates(no_docs).count() == 0
