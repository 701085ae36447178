"""Personal details in a small corpus of invented letters, with decoys of every kind."""

import random

import pytest

from flightloom.llm import pii as P

FIRST = ["Anouk", "Berit", "Cosmo", "Delia", "Edwin", "Farah", "Goran", "Hedda"]
LAST = ["Marlowe", "Tindall", "Oxbourne", "Quillfeather", "Rothwell", "Sandvik-Moor", "O'Brannigan"]
SCHEMA = "doc_id long, text string, pii_kind string"


PHONES = ["+1415555{:04d}", "(01632) 96{:04d}", "07700 90{:04d}", "0044-20-7946-{:04d}", "617.555.{:04d}", "202-555-{:04d}"]
IDS = ["Z0 19{:04d}", "000-61-{:04d}", "BDXXQ{:04d}W", "NX-39-2052-009{:04d}", "1186 1744 {:04d}"]


def corpus():
    """Persons next to cues, numbers near them, and figures of the same forms that stand near nobody."""
    rng = random.Random(4)
    docs = []
    for i in range(120):
        f, l = rng.choice(FIRST), rng.choice(LAST)
        docs.append(rng.choice([f"Copy kept on file, holder {f} {l}.", f"Passenger {f} {l}, booked.", f"Good day.\nThanks, {f} {l}", f"From: {f} {l} <x{i}@post.example>", f"We asked Dr. {f} {l} about it."]))
    for i in range(160):
        f, l = rng.choice(FIRST), rng.choice(LAST)
        phone, code = PHONES[i % 6].format(i), IDS[i % 5].format(i)
        label = ("passport no.", "social insurance #", "tax id =", "licence no.", "voter card", "SSN")[i % 6]
        docs.append(rng.choice([f"Call {phone} or write x{i}@post.example.", f"Passenger {f} {l}, {label} {code}, booked.", f"{code} / Dr. {f} {l} /", f"Copy of {label} {code} kept on file, holder {f} {l}."]))
        docs.append(f"Run 5926 5008 {i:04d} gave little." if i % 3 else f"Part 896-28-{i:04d} was short. " + "The slots were full. " * 8 + f"The totals 731-487-{i:04d} are seats.")
    return docs


def found(spark, texts):
    rows = [(i, t, "clash") for i, t in enumerate(corpus() + texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    n = len(corpus())
    return {(r.doc_id - n, r.pii_kind, r.pii_value) for r in P.personal_details(df).collect() if r.doc_id >= n}


CASES = [
    ("Write to ann.bee+x@mail.port-desk.example. Or to a_b9 [at] post [dot] example, or c.d (at) post.example; or e @ post.example!", {("email", "ann.bee+x@mail.port-desk.example"), ("email", "a_b9 [at] post [dot] example"), ("email", "c.d (at) post.example"), ("email", "e @ post.example")}),
    ("tel:+14155550152 ext. 23 or (01632) 960483, 07700 900982, 0044-20-7946-0529, 617.555.0181, or call 202-555-0100.", {("phone", "+14155550152"), ("phone", "(01632) 960483"), ("phone", "07700 900982"), ("phone", "0044-20-7946-0529"), ("phone", "617.555.0181"), ("phone", "202-555-0100")}),
    ("I quoted my passport no.: Z0 191615 and social insurance # 000-61-2659 and tax id = BDXXQ3305W, licence no. NX-39-2052-0095994.", {("id_number", "Z0 191615"), ("id_number", "000-61-2659"), ("id_number", "BDXXQ3305W"), ("id_number", "NX-39-2052-0095994")}),
    ("Send it to Flat 29A, 137 Station Crescent, Garowby Point. Or 106b Coppersmith St\nTamanton Point 34483. Or No. 290, 5th Main, New Ravuholm - 53338, not here.", {("address", "Flat 29A, 137 Station Crescent, Garowby Point"), ("address", "106b Coppersmith St\nTamanton Point 34483"), ("address", "No. 290, 5th Main, New Ravuholm - 53338")}),
    ("It was Edwin Tindall who noticed, and ROTHWELL, Hedda who did not; H. Marlowe and Goran J. van Oxbourne came later. That was Farah Tindall's bag, Delia O’Brannigan’s word.", {("name", "Farah Tindall"), ("name", "Delia O’Brannigan"), ("name", "Edwin Tindall"), ("name", "ROTHWELL, Hedda"), ("name", "H. Marlowe"), ("name", "Goran J. van Oxbourne")}),
    ("1186 1744 5723 / Delia O'Brannigan / House 33, Weaver's Cross, Corumere 52619", {("id_number", "1186 1744 5723"), ("name", "Delia O'Brannigan"), ("address", "House 33, Weaver's Cross, Corumere 52619")}),
    ("The Edwin Tindall Terminal at Port Lune took 3 percent; the Cosmo Rothwell Hall too. @slotdesk wrote. Run 5926 5008 8035 gave little. Part 896-28-8400 was short. The totals 731-487-4954 are seats. See carrier_001_2020_01.xlsx, stand 30, Port Lune.", set()),
    ("It reads: her SSN is 123-45-6789, and the voter card 000-61-7777 was lost.", {("id_number", "123-45-6789"), ("id_number", "000-61-7777")}),
    (None, set()), ("", set()),
]


def test_details_and_decoys(spark):
    got = found(spark, [t for t, _ in CASES])
    assert got == {(i, *x) for i, (_, want) in enumerate(CASES) for x in want}


def test_long_text_and_repeats(spark):
    text = "Nothing to see here. " * 20_000 + "Edwin Tindall wrote. " + "More of the same. " * 20_000 + "Edwin Tindall wrote."
    assert found(spark, [text]) == {(0, "name", "Edwin Tindall")}


def test_portions_of_terms_give_the_same(spark, monkeypatch):
    texts = [t for t, _ in CASES]
    whole = found(spark, texts)
    monkeypatch.setattr(P, "TERMS_PER_PASS", 3)
    assert found(spark, texts) == whole


def test_sanitised_texts(spark):
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(corpus() + [CASES[5][0], None, "plain"])], SCHEMA)
    n = len(corpus())
    got = {r.doc_id - n: (r.text, r.n_details) for r in P.sanitised(df).where(f"doc_id >= {n}").collect()}
    assert got == {0: ("[ID] / [NAME] / [ADDRESS]", 3), 1: (None, 0), 2: ("plain", 0)}


def test_no_documents(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert P.personal_details(df).collect() == [] and P.sanitised(df).collect() == []


def test_disclosure_is_high_for_what_stands_near_persons(spark):
    df = spark.createDataFrame([(i, t, "") for i, t in enumerate(corpus())], SCHEMA)
    bits = {(r.kind, r.term): r.bits for r in P.disclosure_terms(df).collect()}
    assert bits["first", "edwin"] > P.NAME_BITS and ("first", "passenger") not in bits
    assert bits["left", "ssn"] > 2 and bits["left", "card"] > 2 and bits["shape", "phone(99999) 999999"] > 2
    assert all(bits["left", w] < 0 for w in ("run", "part", "totals"))


def test_figures_are_told_by_the_company_of_their_words(spark):
    """The same text, in a corpus in which the word keeps other company: details come from the statistics, not from a list."""
    text = ["Desk note. The tally 000-61-2659 was filed."]
    n = len(corpus())

    def search(more):
        df = spark.createDataFrame([(i, t, "") for i, t in enumerate(text + corpus() + more)], SCHEMA)
        return {(r.pii_kind, r.pii_value) for r in P.personal_details(df).where("doc_id = 0").collect()}

    assert search([f"The tally 000-61-{i:04d} was filed for Mr. Goran Tindall." for i in range(40)]) == {("id_number", "000-61-2659")} and n > 0
    assert search([f"The tally 000-61-{i:04d} was filed." for i in range(40)]) == set()


@pytest.mark.parametrize("name,want", [("A. Bee", (None, "bee")), ("Bee, Ann", ("ann", "bee")), ("Ann C. van Bee", ("ann", "bee"))])
def test_parts(name, want):
    assert P._parts(name) == want
