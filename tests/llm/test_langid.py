import pytest
from pyspark.sql import functions as F

from jobmart.llm.langid import BLANK, NO_LANGUAGE, RANKS, Classifier, language_of, ngrams, profiles, ranked

TEXTS = {
    "en": "the cat and the dog were in the house with the old man who had seen them there",
    "de": "der hund und die katze waren in dem haus mit dem alten mann der sie dort gesehen hatte",
    "fr": "le chien et le chat étaient dans la maison avec le vieil homme qui les avait vus là",
}


def plain_ngrams(text):
    out = []
    word = ""
    for ch in text.lower() + " ":
        if ch.isalpha():
            word += ch
        elif word:
            padded = f" {word} "
            out += [padded[i:i + n] for n in (1, 2, 3) for i in range(len(padded) - n + 1) if padded[i:i + n] != " "]
            word = ""
    return out


def code(gram):
    out = 0
    for ch in gram:
        out = (out << 21) | (BLANK if ch == " " else ord(ch))
    return out


@pytest.mark.parametrize("text", [*TEXTS.values(), "A1b2  C", "x", "  ", "", "漢字 kana!", "İstanbul"])
def test_ngrams(text):
    assert sorted(ngrams(text).tolist()) == sorted(map(code, plain_ngrams(text)))


def test_ties_go_by_code():
    assert ranked(ngrams("b a")).tolist()[:2] == sorted(map(code, ["a", "b"]))


def brute(learned, text):
    own = ranked(ngrams(text)).tolist()
    best = None
    for language in sorted(learned):
        place = {g: i for i, g in enumerate(learned[language].tolist())}
        apart = sum(abs(place[g] - i) if g in place else RANKS for i, g in enumerate(own))
        if best is None or apart < best[1]:
            best = language, apart
    return best[0], 1 - best[1] / (RANKS * len(own))


@pytest.fixture(scope="module")
def learned(spark):
    rows = [(lang, text) for lang, text in TEXTS.items() for _ in range(3)] + [(None, "zzz"), ("en", None), ("xx", "123")]
    return profiles(spark.createDataFrame(rows, "lang string, text string"))


def test_profiles(learned):
    assert list(learned) == ["de", "en", "fr"] or set(learned) == {"de", "en", "fr"}
    for language, text in TEXTS.items():
        assert learned[language].tolist() == ranked(ngrams(text)).tolist()


def test_distances(learned):
    classify = Classifier(learned)
    for text in ["the man in the house", "die katze", "le chat était là", "qqq", TEXTS["en"]]:
        language, score = classify(text)
        assert (language, pytest.approx(score)) == brute(learned, text)
    assert classify(TEXTS["fr"]) == ("fr", 1.0)
    assert classify(None) == classify("") == classify("12 !?") == (NO_LANGUAGE, 0.0)


def test_column(spark, learned, odd_docs, clashing_docs, no_docs):
    for docs in (odd_docs, clashing_docs, no_docs):
        got = docs.select("doc_id", language_of(spark, learned)(F.col("text")).alias("f")).select("doc_id", "f.*").collect()
        assert len(got) == docs.count()
        for r in got:
            assert (r.lang_pred == NO_LANGUAGE) == (r.doc_id in (3, 4, 5, 9) or r.doc_id is None and r.score == 0)
            assert 0 <= r.score <= 1


def test_nothing_learned(spark, no_docs):
    assert profiles(no_docs) == {}
    assert Classifier({})("some text") == (NO_LANGUAGE, 0.0)


def test_held_out_accuracy(spark):
    from jobmart.llm.queries import QUERIES

    got = QUERIES["op1_language_id"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang")
    held = got.join(docs, "doc_id").where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count() > 0
