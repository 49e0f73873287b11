import random

from tamarack.llm import pii
from tamarack.llm.names import Vocabulary
from tamarack.llm.pii import company_words, find_all, fold, learn, Learned, patterns_of, personal_spans, redact, tokens_of
from tamarack.llm.tokens import encode_corpus, ranked, replay, tokenizer_file

TEXTS = [None, "", " ", "\n\n  x", "Hello world! It's 42—ok", "aaaaaaaaaaaaaaaa", "naïve café 日本語 👍🏽", "<|endoftext|> stays text", "don’t DON'T  tabs\t\tand   runs ", "x" * 5000 + " " * 300, "0123456789" * 40, "﻿​ zero"]


def library(texts):
    t = ranked(tokenizer_file())
    return [t.encode(x, add_special_tokens=False).ids if x else [] for x in texts]


def test_encoding_is_the_librarys(spark):
    texts = [*TEXTS, *TEXTS]
    d = spark.createDataFrame([(i, t, 1, "clash") for i, t in enumerate(texts)] + [(None, "no key", 1, "x")], "doc_id bigint, text string, ids int, word string")
    got = encode_corpus(d, "doc_id", "text").collect()
    want = library(texts)
    assert len(got) == len(texts) + 1
    for r in got:
        assert r.ids == (want[r.doc_id] if r.doc_id is not None else library(["no key"])[0])
    assert encode_corpus(d.limit(0), "doc_id", "text").count() == 0


def test_replay_of_words():
    r = random.Random(1)
    words = ["".join(r.choice("abcehilnorstu' é") for _ in range(r.randrange(1, 15))).strip() or "a" for _ in range(500)]
    t = ranked(tokenizer_file())
    alone = [w for w in words if len(t.pre_tokenizer.pre_tokenize_str(w)) == 1]
    assert replay(alone, tokenizer_file()) == library(alone)


KNOW = Learned(patterns={"L ask for", "R at (", "B demandez _ à", "phone L line is", "email L mail is"}, company=company_words(Vocabulary(("coastal", "precision"), ("castings", "foundry"))))


def found(text, know=KNOW):
    return [(k, text[a:b]) for a, b, k in find_all(text, know)]


def test_shapes():
    for mail in ("a.b+c@x-y.example", "a @ b.test", "a [at] b [dot] test", "a (at) b (dot) test", "a AT b.c DOT test", "a＠b.test", "a&#64;b.test", "A_B@MAIL.C.EXAMPLE"):
        assert found(f"write to {mail} now") == [("email", mail)], mail
    for none in ("tag @shop_x", "bolt @ 685.4 Nm", "build user@v2 in"):
        assert found(none) == []
    assert found("my mail is ann.lee at works dot example dot com now") == [("email", "ann.lee at works dot example dot com")] and found("look at works dot example dot com") == []
    for number in ("(203) 555-0148", "203-555-0148", "203.555.0148", "203 555 0148", "203 555 0148", "+1 203-555-0148 ext. 12", "1-800-555-PUMP", "(203)555-0148 x463", "+49 (0)470 5550142", "0049 343 555-0121", "0205/555 0194", "0468 55501-84", "01 99 00 44 85", "+33 1 99 00 47 40", "(+34) 900-654-172", "+44 1632 960130", "203-555-\n0148", "four two seven, five five five, zero one seven four"):
        assert found(f"line {number}, thanks") == [("phone", number)], number
    for none in ("Serial no. 875-481-2143 was", "Model (247) 2-8923", "Drawing 4-478-2082", "P/N 914-36-1134", "Batch 21910648", "10.2.0.6 in 2020"):
        assert found(none) == [], none
    assert found("my line is 2035550148.") == [("phone", "2035550148")] and found("part 2035550148.") == []
    for label, number in (("SSN", "902-48-4940"), ("soc sec #", "902 48 4940"), ("the owner's social is", "902-48-4940"), ("ssn #", "902484940"), ("DL#", "T778-9991-5062"), ("Passport:", "QZ5508966"), ("DNI", "00039442-Y"), ("IdNr.", "08 652 937 909"), ("NIR", "2 22 55 01 314 480 03"), ("n° de sécurité sociale", "115555410291442")):
        assert found(f"has {label} {number}, noted") == [("id_number", number)], label
    for place in ("8074 Orchard Hill Ln", "11513 Foundry Dr. S.W.", "41 Rolmirbane Way\nUnit B", "P.O. Box 6205", "Rural Route 4, Box 232", "12241 County Road 38", "81 11th Terrace", "39-B Mill Rd", "Nine Celdindard Parkway", "9463 Old Kockgegane Terrace Ste. 4", "88 CLIRFINFACK ST.", "Am Lildorbane 19", "Industriestraße 13", "C/ Dronvalith 85", "Avda. de Rolfenmow, 9, 2º B", "17, rue de Rollermack", "11 bis, rue des Forges"):
        assert found(f"at {place}, Rome") == [("address", place)], place
    assert found("Lane 4 of the Quarry Road depot; Box 32 holds parts; 8 road plates") == []


def test_names():
    assert found("ask for Robert Keck at (203) 555-0148") == [("name", "Robert Keck"), ("phone", "(203) 555-0148")]
    assert found("Dr. Krickbar runs it; per Anthony Thernevane's assistant") == [("name", "Krickbar"), ("name", "Anthony Thernevane")]
    assert found("cc: Vilmore, Lawrence J., and KATHERINE VAN TOLL-HUND") == [("name", "Vilmore, Lawrence J."), ("name", "KATHERINE VAN TOLL-HUND")]
    assert found("ask for R. Toronfick at (2") == [("name", "R. Toronfick")] and found("saw R. Toronfick once") == []
    assert found("Demandez richard kricknar à l'accueil") == [("name", "richard kricknar")]
    assert found("le dossier de M. O'Brien et Frau von Gell") == [("name", "O'Brien"), ("name", "von Gell")]
    assert found("ask for M. Tusdirvack at (2") == [("name", "M. Tusdirvack")]
    for none in ("Robert Keck Precision Castings LLC", "Coastal Castings of Samuel Vilmore", "Henry is our oldest press", "left a message, will retry", "Jackson, MS. PAST DUE", "The Keck & Vilmore pattern", "15 Foundry Dr. Asked about"):
        assert [k for k, _ in found(none) if k == "name"] == [], none


def test_learning_and_redaction(spark):
    given, new = ["Robert", "Walter", "Samuel", "Henry"], ["Zorana", "Milivoj"]
    rows = [(i, f"Please ask for {g} Vil{chr(97 + i % 20)}more today.") for i, g in enumerate((given * 10 + new * 4))]
    rows += [(100 + i, f"The {w} Castle{chr(97 + i)} stands here.") for i, w in enumerate(["Golden"] * 8)] + [(200, None), (201, ""), (202, "x" * 20000 + " mail a@b.test " + "y" * 20000), (None, "SSN 902-48-4940"), (0, rows[0][1])]
    d = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, kind string")
    know = learn(d, "text")
    assert {"zorana", "milivoj"} <= know.given and "golden" not in know.given
    got = {(r.doc_id, r.kind, r.found_text) for r in personal_spans(d, "doc_id", "text", know).collect()}
    assert (40, "name", "Zorana Vilamore") in got and (202, "email", "a@b.test") in got and (None, "id_number", "902-48-4940") in got and not any(100 <= (i or 0) < 200 for i, _, _ in got)
    shown = {r.doc_id: r.text for r in redact(d, "doc_id", "text", know).collect()}
    assert shown[40] == "Please ask for [NAME] today." and shown[200] is None and shown[201] == "" and len(shown[202]) == 40000 + len(" mail [EMAIL] ") and shown[100] == rows[48][1]
    assert personal_spans(d.limit(0), "doc_id", "text").count() == 0


def test_rare_names_are_learned_in_large_corpora(spark):
    common = [(i, f"Please ask for {g} Vil{chr(97 + i % 20)}more today.") for i, g in enumerate(["Robert", "Walter", "Samuel", "Henry"] * 10)]
    bulk = [(1000 + i, " ".join(f"the Golden{chr(97 + j % 26)} Castle{chr(97 + i % 26)} stood," for j in range(400))) for i in range(300)]
    d = spark.createDataFrame([*common, (100, "Please ask for Zorana Kolbrane today."), *bulk], "doc_id bigint, text string")
    assert "zorana" in learn(d, "text").given
    assert {(r.doc_id, r.found_text) for r in personal_spans(d, "doc_id", "text").filter("doc_id < 1000").collect()} >= {(100, "Zorana Kolbrane"), (0, "Robert Vilamore")}


def test_lessons_by_chunk_are_those_of_the_whole(spark, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", 300)
    rows = [(i, f"Please ask for {g} Vil{chr(97 + i % 20)}more at (203) 555-01{i % 90 + 10}, or ask for R. Tol{chr(97 + i % 9)}bane.") for i, g in enumerate((["Robert", "Walter", "Samuel", "Zorana"] * 10))]
    rows += [(200, "please ask for zorana keckbane today, or ask for robert zorana vilmore."), (201, "my SSN 902-48-4940; mail a@b.test"), (202, None), (203, ""), (None, "ask for Zorana Zell"), (None, "ask for Zorana Zell"), (204, "line is 2035550148 or 2035550149")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    know = learn(d, "text")
    rows_of = lambda x: sorted(map(repr, x.collect()))
    assert rows_of(personal_spans(d, "doc_id", "text")) == rows_of(personal_spans(d, "doc_id", "text", know))
    assert rows_of(redact(d, "doc_id", "text")) == rows_of(redact(d, "doc_id", "text", know))
    for _, t in rows:
        if t:
            least = Learned(given=Learned().given | (know.given & {fold(w) for w, _, _ in tokens_of(t)}))
            least.patterns = know.patterns & patterns_of(t, least)
            assert find_all(t, least) == find_all(t, know)
    assert personal_spans(d.limit(0), "doc_id", "text").count() == 0 and redact(d.limit(0), "doc_id", "text").count() == 0
