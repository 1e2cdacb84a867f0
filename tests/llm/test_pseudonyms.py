import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barflow.llm.pseudonyms import Feistel, Pseudonyms, luhn_digit, pseudonymise
from barflow.llm.queries import LLM_QUERIES

TEXT = (
    "Mail ab.Cd9@mail8.example.com, card 4041 8949 7460 8795 4041894974608795 ip 42.144.35.254 v4.0. on 2023-02-28, "
    "28/02/2023 02/28/2023 31.12.1999 ssn 078-05-1120 call +1 (988) 555-2485 or 988-555-2485 +49 30 1234567 "
    "IBAN DE89 3704 0044 0532 0130 00 GB82WEST12345698765432."
)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 1023, 1025])
def test_feistel_permutes(size):
    f = Feistel(b"k")
    there = [f.permute("x", i, size) for i in range(size)]
    assert sorted(there) == list(range(size))
    assert [f.permute("x", y, size, back=True) for y in there] == list(range(size))


def test_keys_and_names_differ():
    moves = [[f.permute(n, i, 1000) for i in range(50)] for f, n in [(Feistel(b"a"), "x"), (Feistel(b"b"), "x"), (Feistel(b"a"), "y")]]
    assert moves[0] != moves[1] != moves[2] != moves[0]


def test_every_kind_is_replaced_in_its_format_and_back():
    new, spans = Pseudonyms(b"key").text(TEXT)
    assert [k for k, _, _ in spans] == "email card card ip iso day day day ssn phone phone abroad iban iban".split()
    for (kind, start, n), shape in zip(spans, re.findall(r"\S+", "x " * len(spans)), strict=True):
        assert new[start : start + n] not in TEXT and shape
    cards = [re.sub(r"\D", "", new[s : s + n]) for k, s, n in spans if k == "card"]
    assert cards[0] == cards[1] and luhn_digit(cards[0][:-1]) == int(cards[0][-1]) and cards[0][0] == "4"
    assert Pseudonyms(b"key", back=True).text(new)[0] == TEXT
    assert Pseudonyms(b"other").text(TEXT)[0] != new


@pytest.mark.parametrize(
    "text",
    ["", "no data", "4041894974608794", "2023-02-30", "31/31/2023", "256.1.1.1", "1.2.3", "000-12-3456", "666-12-3456",
     "DE89 3704 0044 0532 0130 01", "Version 2.0", "0000000000000000", "01.02.03.04", "12345678901234567890123", "a@b"],
)
def test_unconfirmed_stays(text):
    assert Pseudonyms(b"k").text(text) == (text, [])


@settings(max_examples=200, deadline=None)
@given(st.integers(10**14, 10**15 - 1), st.dates(min_value=__import__("datetime").date(1900, 1, 1), max_value=__import__("datetime").date(2099, 12, 31)))
def test_back_and_forth(number, day):
    card = f"{number}{luhn_digit(str(number))}"
    there, back = Pseudonyms(b"k"), Pseudonyms(b"k", back=True)
    for kind, value in [("card", card), ("iso", day.isoformat()), ("day", day.strftime("%d/%m/%Y")), ("day", day.strftime("%m.%d.%Y"))]:
        new = getattr(there, kind)(value)
        if new is not None:
            assert getattr(back, kind)(new) == value
    assert there.card(card) is None or len(there.card(card)) == len(card)


def test_frame(spark, docs_of):
    docs = docs_of([(1, TEXT), (2, None), (3, ""), (4, "4041894974608795"), (5, "plain " * 50_000)]).withColumnRenamed("token", "Spans")
    got = {r["doc_id"]: r for r in pseudonymise(docs, b"k").collect()}
    assert got[2]["text"] is None and got[2]["spans"] == [] and got[3]["text"] == "" and got[5]["text"] == "plain " * 50_000
    assert got[4]["text"] in got[1]["text"]
    assert pseudonymise(docs.limit(0), b"k").count() == 0
    with pytest.raises(ValueError):
        Feistel(b"")


def test_query(spark, small):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = LLM_QUERIES["op1_pseudonyms"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        if not r["spans"]:
            assert r["text"] == docs[r["doc_id"]]
        assert not re.findall(r"\w+\.[0-9]+@mail[0-9]\.example\.com", docs[r["doc_id"]]) or r["text"] != docs[r["doc_id"]]


@pytest.mark.parametrize(
    "number",
    ["+1 (017) 555-7713", "+1 (100) 055-0000", "(017) 555-7713", "+1-017-555-7713", "+10175557713", "1-212-555-0100", "212 555 0100",
     "1 212 555 0100", "1-017-555-7713", "212 555-0100", "+1 212 555 0100"],
)
def test_phone_numbers_in_every_form(number):
    new, spans = Pseudonyms(b"k").text(f"call {number}, or {number}.")
    assert [k for k, _, _ in spans] == ["phone", "phone"] and number not in new
    assert re.sub("[0-9]", "0", new) == re.sub("[0-9]", "0", f"call {number}, or {number}.")
    assert Pseudonyms(b"k", back=True).text(new)[0] == f"call {number}, or {number}."


def test_a_phone_number_is_one_value_however_written():
    found = {Pseudonyms(b"k").text(t)[0][-8:] for t in ("+1 (212) 555-0100", "212-555-0100", "1-212-555-0100")}
    assert len(found) == 1
    assert Pseudonyms(b"k").text("(017) 555-7713")[0] in Pseudonyms(b"k").text("+1 (017) 555-7713")[0]


def test_no_phone_number_of_the_documents_stays(spark, small):
    wide = re.compile(r"\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}")
    texts = [r["text"] or "" for r in spark.read.parquet(small.replace("sf0.001", "sf0.1") + "/documents.parquet").select("text").collect()]
    numbers = [(t, n) for t in texts for n in wide.findall(t)]
    assert any(n[4] in "01" for _, n in numbers)
    assert not [n for t, n in numbers if n in Pseudonyms(b"k").text(t)[0]]


@pytest.mark.parametrize(
    "text, value, kind",
    [("4111 1111 1111 1111 12/27", "4111 1111 1111 1111", "card"), ("4111111111111111 123", "4111111111111111", "card"),
     ("4111-1111-1111-1111 12/27 123", "4111-1111-1111-1111", "card"), ("no 7 4111 1111 1111 1111", "4111 1111 1111 1111", "card"),
     ("AB12 4111 1111 1111 1111", "4111 1111 1111 1111", "card"), ("BE68 5390 0754 7034 BANK", "BE68 5390 0754 7034", "iban"),
     ("BE68539007547034 PAID IN", "BE68539007547034", "iban"), ("2023-02-28T10:15:00Z", "2023-02-28", "iso")],
)
def test_values_with_more_behind_or_before_them(text, value, kind):
    new, spans = Pseudonyms(b"k").text(text)
    before, after = text.split(value)
    assert [(k, s, n) for k, s, n in spans] == [(kind, len(before), len(value))]
    assert value not in new and new.startswith(before) and new.endswith(after) and len(new) == len(text)


@pytest.mark.parametrize("text", ["4111 1111 1111 1112 12/27", "BE68 5390 0754 7035 BANK", "2023-02-30T10:15:00Z", "2023-02-28Tx", "2023-02-28abc"])
def test_unconfirmed_with_more_behind_stays(text):
    assert Pseudonyms(b"k").text(text) == (text, [])
