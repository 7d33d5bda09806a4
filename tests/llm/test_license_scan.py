import re

from candela.llm.license_scan import NOTICES, license_report, license_spans
from llm_helpers import SF_SMALL
from llm_helpers import DOCUMENTS, same_rows

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min((p for p, _ in places), default=None),
            max((p for p, _ in places), default=None), ",".join(sorted({x for _, x in places})))


def base(rows):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)


def test_base_places_match_brute_force(spark, odd):
    more = [(1, "CC BY cc  by, c-c by; cc by CC-BY4 cc-by", None, None, None),
            (2, "General, public-license. ALL rights\nreserved all rights all rights reserved", None, None, None),
            (3, "general public public license general public license general public license", None, None, None),
            (4, "Écc by İcc by", None, None, None)]
    docs = odd.unionByName(spark.createDataFrame(more, DOCUMENTS))
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert base(license_report(docs).collect()) == want


def test_notices_survive_a_word_put_in_or_left_out(spark):
    mit = " ".join(next(t for t in NOTICES if t.label == "mit").words).split()
    put_in = " ".join(mit[:9] + ["very", "kindly"] + mit[9:])
    left_out = " ".join(mit[:6] + mit[7:])
    half = " ".join(mit[:8]) + " something else entirely " + " ".join(mit[:3])
    rows = [(1, "x " * 50 + put_in), (2, left_out), (3, half), (4, " ".join(mit)), (5, "of the " * 400)]
    got = {r.doc_id: r for r in license_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4, 5)] == ["mit", "mit", "", "mit", ""]
    assert got[4].score == 1.0 and 0.8 <= got[1].score < 1 and got[5].score == 0
    spans = license_spans(spark.createDataFrame(rows[:1], "doc_id long, text string")).filter("template >= 0").collect()
    assert [(s.start, s.end) for s in spans] == [(50, 50 + len(put_in.split()))]


def test_stuttered_text_around_a_notice(spark):
    mit = " ".join(next(t for t in NOTICES if t.label == "mit").words)
    n = len(mit.split())
    rows = [(1, "permission is " * 11 + mit), (2, mit + " associated documentation files" * 12), (3, "permission is " * 40),
            (4, "permission is " * 30 + mit + " documentation files" * 30), (5, "any person " * 9 + "x y z " * 9 + mit)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in license_report(frame).collect()}
    assert got == {1: ("mit", 1.0), 2: ("mit", 1.0), 3: ("", 0.0), 4: ("mit", 1.0), 5: ("mit", 1.0)}
    spans = {s.doc_id: (s.start, s.end) for s in license_spans(frame).filter("template >= 0").collect()}
    assert all(a <= len(t.split(mit)[0].split()) and b >= len(t.split(mit)[0].split()) + n and b - a <= 2 * n + 2
               for i, t in rows if i in spans for a, b in [spans[i]])


def test_edges(odd, none, clashing):
    assert license_report(none).count() == 0
    assert same_rows(license_report(odd), license_report(clashing))
    assert license_report(odd).count() == odd.count()


def test_planted_in_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)
    assert base(license_report(docs).collect()) == want
