"""Personal information inside free text: find it, list it, replace it.

Information-theoretic sanitisation.  What stands for persons is learned from the corpus.  A first pass over all documents counts how often
a term occurs together with something that reveals a person, and how often it occurs at all; the pointwise mutual information of the
two, in bits, is the term's disclosure.  Terms are

* words and endings of surnames, next to a cue (a title, a signature, a label, an address): those above the threshold
  are protected, and a second pass finds every span made of them, with or without a cue;
* for figures that have the form of a phone or identity number: the word before, the shape, and the mark after them, near a person named with
  a cue or an e-mail address.  The disclosures of a figure's terms add up, and where they exceed the threshold it is a detail.
  So a passport number is told from a batch number by the company that the words keep, not by a list of labels.

E-mail and street addresses have a form of their own.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightloom.session import cut_lineage

#: Bits by which a first name, and the ending of a surname, must be more frequent next to a cue than any word.
NAME_BITS, ENDING_BITS = 5.5, 3.0
ENDING = 3
#: Characters between a figure and a person at which they occur together.
NEAR = 100
#: Bits that a figure's terms must add up to, and those that its surroundings alone must show.
FIGURE_BITS = 3.0
#: The same for codes that have no known form of an identity number.
CODE_BITS = 6.0
CONTEXT_BITS = {"id_number": 2.0, "phone": 0.0}
#: What a figure's own neighbour adds where the word before it has not been seen often enough.
OWN_BITS = 3.0
#: Occurrences from which a term tells anything, and the least share of all figures (it bounds the number of terms).
SUPPORT, SUPPORT_SHARE = 5, 1e-6
#: Share of words next to a cue, and of text near a person, in any corpus, and the words or characters of a corpus that outweigh it.
USUAL, USUAL_WEIGHT = {"first": 0.002, "ending": 0.002, "near": 0.03}, 200_000
#: What is expected of a term before the corpus is read: it stands near a person in four of five cases.
EXPECTED = {("left", w) for w in ("passport", "identity", "id", "insurance", "tax", "licence", "tel", "phone", "call")} | {("shape", "phone+")}
#: Protected words that one pass holds; more are worked off in several passes.
TERMS_PER_PASS = 200_000
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}
#: Of overlapping findings the one of the kind named first stays.
PRECEDENCE = ("email", "address", "id_number", "phone", "name")

_LOCAL = r"[A-Za-z0-9](?:[\w.+-]*[A-Za-z0-9])?"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
EMAIL = re.compile(rf"{_LOCAL}(?:@{_LABEL}(?:\.{_LABEL})+| @ {_LABEL}(?:\.{_LABEL})+| ?[\[(]at[\])] ?{_LABEL}(?:\.{_LABEL}| ?[\[(]dot[\])] ?{_LABEL})+)", re.I)

# digit groups as phone numbers are written; the surroundings decide on those that other figures share
PHONE = re.compile(
    r"(?<![\w.,/+-])(?:"
    r"\+\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,6}){1,3}|\+\d{9,14}"
    r"|00\d{2}(?:[ -]\d{2,6}){2,4}"
    r"|\(\d{3,5}\) ?\d{3,4}[ .-]?\d{3,4}|\(\d{5}\) ?\d{6}"
    r"|0\d{2,4}[ ]\d{3,4}[ ]?\d{3,4}|0\d{4} \d{6}"
    r"|\d{3}([.-])\d{3}\1\d{4}"
    r")(?![\w/]|[.,-]\d)"
)

_ID_FORM = r"(?:[A-Z]{2}-\d{2}-\d{4}-\d{6,8}|[A-Z]{5} ?\d{4} ?[A-Z]|\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}|\d{3}-\d{2}-\d{4}|\d{12}|[A-Z]\d? ?\d{6,7})"
#: Forms of identity numbers, and any code of letters and digits, which only its surroundings can tell.
_CODE = re.compile(rf"(?<![\w+-])(?:(?P<form>{_ID_FORM})|[A-Z0-9][A-Z0-9-]{{4,}}[A-Z0-9])(?![\w-])")
_SHAPE = str.maketrans("0123456789" + ascii_uppercase + ascii_lowercase, "9" * 10 + "A" * 26 + "a" * 26)
_LAST_WORD = re.compile(r"(\w+)\W{0,6}$")
_VERBS = re.compile(r"(\w+)\W{0,3}(?:is|was|are|=|:)\W{0,3}$")

_STREET = r"(?:Street|St|Road|Rd|Lane|Avenue|Ave|Way|Close|Terrace|Crescent|Marg|Cross|Main|Drive|Court|Square|Row)\b\.?"
ADDRESS = re.compile(
    r"(?<![\w/.-])(?:(?:Flat|Apartment|Apt\.?|Unit) \d+[A-Za-z]?, ?)?(?:(?:House|No\.|Door|Plot) ?\d+[A-Za-z]?(?:/\d+)?,? |\d+[A-Za-z]?(?:/\d+)? )"
    rf"(?:\d+(?:st|nd|rd|th) (?:Main|Cross)\b|(?:[^\W\d_a-z][\w'’]+ ){{1,3}}?{_STREET})"
    r"(?:(?:,? ?\n|, ?)(?:(?:New|Port|St\.?|Upper|Lower) )?[^\W\d_a-z][\w'’-]+(?: Point)?(?:(?: - |,? )\d{5,6}\b)?)?"
)

_STREET_WORD = re.compile(_STREET[:-3])
_DIGITS = re.compile(r"\d[\d .()/-]{2,}\d")

# a possessive ending is no part of a word
_REST = r"\w*(?:['’](?!s\b)\w+)*"
_CAP = rf"[^\W\d_a-zà-öø-ÿ]{_REST}(?:-\w{_REST})*"
_PARTICLE = "(?:van|von|de|der|den|del|da|di|la|bin|VAN|VON|DE|DER|DEN|DEL|DA|DI|LA|BIN)"
_PARTICLES = frozenset("van von de der den del da di la bin al el".split())
_SURNAME = rf"(?:{_PARTICLE} ){{0,2}}(?:al-|el-)?{_CAP}"
_FULL = rf"(?:{_CAP}(?: [^\W\d_a-z]\.)? {_SURNAME}|[^\W\d_a-z]\. {_SURNAME}|{_CAP}, {_CAP}(?: [^\W\d_a-z]\.)?)"
TITLE = r"(?:Dr|Mr|Mrs|Ms|Miss|Prof|Sir|Captain|Capt|Mme|Sr|Sra)\b\.?"
#: Places that reveal a person, each with a piece of text without which it cannot occur.
_CUES = tuple(
    (needles, re.compile(pattern, re.M))
    for needles, pattern in (
        (("Dr", "Mr", "Ms", "Miss", "Prof", "Sir", "Capt", "Mme", "Sr"), rf"\b{TITLE} ({_FULL})"),
        (("From: ",), rf"\bFrom: (?:{TITLE} )?({_FULL}) <"),
        (("name=",), rf"\bname=({_FULL})(?= id=)"),
        ((";",), rf"^({_FULL});"),
        ((" / ",), rf"/ ({_FULL}) /"),
        (("holder ",), rf"\bholder (?:{TITLE} )?({_FULL})"),
        (("Passenger ",), rf"\bPassenger (?:{TITLE} )?({_FULL})(?=,)"),
        (("Thanks, ", "Regards, ", "Yours, ", "Sincerely, "), rf"\b(?:Thanks|Regards|Yours|Sincerely), ({_FULL})\s*$"),
        (("Contact",), rf"\bContact[oe]? ?: (?:{TITLE} )?({_FULL})"),
        ((" (",), rf"({_FULL}) \((?=[^)\n]{{0,40}}(?:@|\d{{3}}))"),
    )
)
_WORD = re.compile(rf"\b{_CAP}")
_INITIAL = re.compile(rf"(?<![\w.])[^\W\d_a-z]\. ({_SURNAME})")
_AFTER_FIRST = re.compile(rf"(?: [^\W\d_a-z]\.)? ({_SURNAME})")
_BEFORE_FIRST = re.compile(rf"((?:(?:Van|Von|De|Der) )?{_SURNAME}), $")
_MIDDLE = re.compile(r" [^\W\d_a-z]\.(?= ?[^ \w]| [a-z(/<]|\n|$)")
#: After a name these make it that of a building; so does any capital word, if the name follows an article.
_BUILDING = re.compile(r" (?:Airport|Terminal|Concourse|Hall|Airfield|Aerodrome|Building|Pavilion|Tower|Bridge|Stadium|Wing|Library|Hospital|School|Field)\b")
_ARTICLE = re.compile(r"\b(?:[Tt]he|[Ll]['’]|[Ll]e|[Ll]a|[Ee]l) $|(?:[Aa]éroport|[Aa]eropuerto|[Aa]irport|[Tt]erminal) $")


@dataclass(frozen=True)
class Terms:
    """What the corpus says about words: protected first names, and protected endings of surnames."""

    first: frozenset[str]
    endings: frozenset[str]
    #: disclosure, in bits, of what surrounds figures: ("left", word), ("shape", shape) or ("right", mark)
    bits: dict[tuple[str, str], float] = field(default_factory=dict)


def _parts(name: str) -> tuple[str | None, str]:
    """First name (none if only an initial) and surname of a written name, in lower case."""
    if "," in name:
        last, first = name.split(",", 1)
        return first.split()[0].lower(), last.lower()
    words = name.split(" ")
    first = None if words[0].endswith(".") else words[0].lower()
    return first, words[-1].lower()


#: Buildings named after persons; they say nothing about who is a person.
_NAMED_BUILDING = re.compile(rf"\b(?:[Tt]he |[Ee]l |[Ll]a |[Ll]e |[Ll]['’]){_CAP}(?: [^\W\d_a-z]\.)? {_SURNAME} {_CAP}")


def _is_building(text: str, start: int, end: int) -> bool:
    if _BUILDING.match(text, end):
        return True
    return bool(_ARTICLE.search(text, max(0, start - 14), start)) and bool(re.match(rf" {_CAP}", text[end : end + 40]))


def _emails(text: str) -> list[tuple[int, int]]:
    low = text.lower()
    return [m.span() for m in EMAIL.finditer(text)] if "@" in text or "at)" in low or "at]" in low else []


def _cued(text: str) -> Iterator[re.Match]:
    """Names next to a cue, but for those of buildings."""
    for needles, cue in _CUES:
        if any(n in text for n in needles):
            yield from (m for m in cue.finditer(text) if not _is_building(text, m.start(1), m.end(1)))


def _persons(text: str) -> list[tuple[int, int]]:
    return [m.span(1) for m in _cued(text)] + _emails(text)


def _is_near(persons: list[tuple[int, int]], a: int, b: int) -> bool:
    return any(x - NEAR < b and y + NEAR > a for x, y in persons)


def _figures(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """Figures with the form of an identity or phone number: (kind, start, end, whether the form is a known one)."""
    if not _DIGITS.search(text):
        return
    phones = [m.span() for m in PHONE.finditer(text)]
    for m in _CODE.finditer(text):
        a, b = m.span()
        if m.group("form") or sum(c.isdigit() for c in m.group()) >= 4 and all(b <= x or a >= y for x, y in phones):
            yield "id_number", a, b, bool(m.group("form"))
    for a, b in phones:
        yield "phone", a, b, True


def _figure_terms(text: str, kind: str, a: int, b: int) -> list[tuple[str, str]]:
    """The word before a figure, its shape, and the mark after it if there is one."""
    before = _LAST_WORD.search(text, max(0, a - 24), a)
    word = before.group(1).lower() if before else ""
    after = text[b : b + 3].translate(_SHAPE)
    return [("left", "9" if word.isdigit() else word), ("shape", kind + text[a:b].translate(_SHAPE)), ("right", "" if after[:2] in (" a", " A", " 9") else after)]


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        cued: Counter = Counter()
        seen: Counter = Counter()
        words: Counter = Counter()
        for text in pdf["text"]:
            if not text:
                continue
            persons = _emails(text)
            for m in _cued(text):
                persons.append(m.span(1))
                first, last = _parts(m.group(1))
                if first and first not in _PARTICLES:
                    cued["first", first] += 1
                cued["ending", last[-ENDING:]] += 1
            words.update(_WORD.findall(_NAMED_BUILDING.sub(" ", text)))
            # how much of the text lies near a person
            seen["near", ""] += len(text)
            cued["near", ""] += sum(min(len(text), b + NEAR) - max(0, a - NEAR) for a, b in persons)
            for kind, a, b, _ in _figures(text):
                near = _is_near(persons, a, b)
                for term in _figure_terms(text, kind, a, b):
                    seen[term] += 1
                    cued[term] += near
        for w, n in words.items():
            w = w.lower()
            seen["first", w] += n
            seen["ending", w[-ENDING:]] += n
        rows = [(kind, term, cued[kind, term], n) for (kind, term), n in seen.items()]
        yield pd.DataFrame(rows, columns=["kind", "term", "cued", "seen"])


def disclosure_terms(documents: DataFrame, text: str = "text") -> DataFrame:
    """How strongly terms reveal a person: (kind, term, cued, seen, bits).

    Counted over all documents and their whole texts; batches send sums, Spark adds them
    up.  ``bits`` is the pointwise mutual information of the term with the presence of a person: for ``first`` and ``ending`` against all words, for
    ``left``, ``shape`` and ``right`` of figures against the share of text near a person.  Figures' terms below the support are left out.
    """
    counts = documents.select(F.col(text).alias("text")).mapInPandas(_count_terms, "kind string, term string, cued long, seen long")
    # small next to the texts; written once, as totals and terms are read from it
    sums = cut_lineage(counts.groupBy("kind", "term").agg(F.sum("cued").alias("cued"), F.sum("seen").alias("seen")))
    total = {r.kind: (r.cued or 0, r.seen or 0) for r in sums.groupBy("kind").agg(F.sum("cued").alias("cued"), F.sum("seen").alias("seen")).collect()}

    def share(kind: str) -> float:
        """Of all words, or of all text, that which is next to a person; a small corpus is held to what is usual."""
        cued, seen = total.get(kind, (0, 0))
        return (cued + USUAL[kind] * USUAL_WEIGHT) / (seen + USUAL_WEIGHT)

    near = share("near")
    least = max(SUPPORT, total.get("shape", (0, 0))[1] * SUPPORT_SHARE)
    own = F.least(F.lit(1.0), F.try_divide("cued", "seen"))
    name = F.when(F.col("kind") == "first", own / F.lit(share("first"))).otherwise(own / F.lit(share("ending")))
    of_name = F.col("kind").isin("first", "ending")
    bits = F.when(of_name & (F.col("cued") > 0), F.log2(name)).when(~of_name & (F.col("seen") >= least), F.log2((F.col("cued") + near) / (F.col("seen") + 1) / near))
    return sums.where("kind <> 'near'").withColumn("bits", bits).where("bits IS NOT NULL")


def protected_terms(documents: DataFrame, text: str = "text") -> list[Terms]:
    """What the corpus says, in as many portions as passes are needed.

    Endings are bounded by their length, terms of figures by their support.  First names are fetched in portions of
    ``TERMS_PER_PASS``; a corpus with more of them is read once per portion.
    """
    terms = disclosure_terms(documents, text).where(f"kind = 'first' AND bits >= {NAME_BITS} OR kind = 'ending' AND bits >= {ENDING_BITS} OR kind NOT IN ('first', 'ending')")
    first, endings = [], set()
    bits = {term: math.log2(0.8 / 0.05) for term in EXPECTED}
    for kind, term, own in terms.select("kind", "term", "bits").toLocalIterator():
        if kind == "first":
            first.append(term)
        elif kind == "ending":
            endings.add(term)
        else:
            bits[kind, term] = own
    portions = max(1, math.ceil(len(first) / TERMS_PER_PASS))
    first.sort()
    return [Terms(frozenset(first[k::portions]), frozenset(endings), bits) for k in range(portions)]


def _disclosing_figures(text: str, bits: dict[tuple[str, str], float]) -> Iterator[tuple[str, int, int]]:
    persons = None
    for kind, a, b, known_form in _figures(text):
        left, shape, right = _figure_terms(text, kind, a, b)
        before = bits.get(left)
        if before is not None and (verb := _VERBS.search(text, max(0, a - 30), a)):
            # "the number is": the word before the verb may say more
            before = max(before, bits.get(("left", verb.group(1).lower()), before))
        if before is None:
            persons = _persons(text) if persons is None else persons
            before = OWN_BITS * _is_near(persons, a, b)
            verb = _VERBS.search(text, max(0, a - 30), a)
            before = max(before, bits.get(("left", verb.group(1).lower()), 0.0)) if verb else before
        after = bits.get(right, 0.0) if right[1] else 0.0
        form = bits.get(shape, bits.get(("shape", shape[1][: len(kind) + 1]), 0.0))
        context = max(before, after)
        if context >= CONTEXT_BITS[kind] and before + form + after >= (FIGURE_BITS if known_form else CODE_BITS) and (known_form or left[1].isalpha()):
            yield kind, a, b


def _names(text: str, terms: Terms) -> Iterator[tuple[int, int]]:
    known = lambda s: s.rsplit(" ", 1)[-1].lower()[-ENDING:] in terms.endings
    for m in _WORD.finditer(text):
        if m.group().lower() not in terms.first:
            continue
        start, end = m.span()
        after = _AFTER_FIRST.match(text, end)
        if after and known(after.group(1)):
            end = after.end()
        else:
            before = _BEFORE_FIRST.search(text, max(0, start - 60), start)
            if not before or not known(before.group(1)):
                continue
            start = before.start()
            middle = _MIDDLE.match(text, end)
            if middle:
                end = middle.end()
        if not _is_building(text, start, end):
            yield start, end
    for m in _INITIAL.finditer(text):
        if known(m.group(1)) and not _is_building(text, m.start(), m.end()):
            yield m.span()


def candidates(text: str | None, terms: Terms) -> set[tuple[str, int, int]]:
    """Everything in a text that may be a personal detail: (kind, start, end), overlaps included."""
    if not text:
        return set()
    found: list[tuple[str, int, int]] = []
    found += [("email", *span) for span in _emails(text)]
    # a cheap search keeps the dear pattern away from texts in which it cannot match
    if _STREET_WORD.search(text):
        found += [("address", *m.span()) for m in ADDRESS.finditer(text)]
    found += _disclosing_figures(text, terms.bits)
    found += [("name", *s) for s in _names(text, terms)]
    return set(found)


def without_overlaps(found: set[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Of overlapping findings the kind that takes precedence stays, then the longest; in order."""
    rank = {k: i for i, k in enumerate(PRECEDENCE)}
    taken: list[tuple[str, int, int]] = []
    for kind, a, b in sorted(found, key=lambda x: (rank[x[0]], x[1] - x[2], x[1])):
        if all(b <= c or a >= d for _, c, d in taken):
            taken.append((kind, a, b))
    return sorted(taken, key=lambda x: x[1])


def find_details(text: str | None, terms: Terms) -> list[tuple[str, int, int]]:
    """Personal details of one text, without overlaps, in order."""
    return without_overlaps(candidates(text, terms))


def _masked(text: str | None, details: list[tuple[str, int, int]]) -> str | None:
    for kind, a, b in reversed(details):
        text = text[:a] + PLACEHOLDERS[kind] + text[b:]
    return text


def _gathered(base: DataFrame, portions: list[Terms]) -> DataFrame:
    """(doc_id, details): candidates of every portion of terms, brought together per document.

    Only for more terms than one pass holds.  A document's details are bounded by its length.
    """

    def search(own: Terms):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame([(d, *c) for d, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()) for c in candidates(t, own)], columns=["doc_id", "kind", "a", "b"])

        return run

    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, kind string, a int, b int"
    parts = [base.mapInPandas(search(own), schema) for own in portions]
    return reduce(DataFrame.unionByName, parts).groupBy("doc_id").agg(F.collect_set(F.struct("kind", "a", "b")).alias("details"))


def personal_details(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", terms: list[Terms] | None = None) -> DataFrame:
    """Each distinct personal detail of each document: (doc_id, pii_kind, pii_value).

    Values are written as in the text.  Null and empty texts have none; whole texts
    of any length are read; repeated details of a document count once; columns not named are
    left out; an empty table gives no rows.  No shuffle but that of the distinct.
    """
    base, given = _with_details(documents, doc_id, text, terms)
    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, pii_kind string, pii_value string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = {(d, k, t[a:b]) for d, t, details in given(pdf) for k, a, b in details}
            yield pd.DataFrame(sorted(rows, key=repr), columns=["doc_id", "pii_kind", "pii_value"])

    return base.mapInPandas(run, schema).distinct()


def _with_details(documents: DataFrame, doc_id: str, text: str, terms: list[Terms] | None):
    """Documents, and how to get (doc_id, text, details) from a batch of them."""
    portions = protected_terms(documents, text) if terms is None else terms
    base = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if len(portions) == 1:
        own = portions[0]
        return base, lambda pdf: ((d, t, find_details(t, own)) for d, t in zip(pdf["doc_id"].tolist(), pdf["text"].tolist()))
    joined = base.join(_gathered(base, portions), "doc_id", "left")
    as_set = lambda x: set() if x is None else {(r["kind"], r["a"], r["b"]) for r in x}
    return joined, lambda pdf: ((d, t, without_overlaps(as_set(x))) for d, t, x in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), pdf["details"].tolist()))


def sanitised(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", terms: list[Terms] | None = None) -> DataFrame:
    """Texts with a typed placeholder in place of each detail: (doc_id, text, n_details)."""
    base, given = _with_details(documents, doc_id, text, terms)
    schema = f"doc_id {base.schema['doc_id'].dataType.simpleString()}, text string, n_details int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([(d, _masked(t, details), len(details)) for d, t, details in given(pdf)], columns=["doc_id", "text", "n_details"])

    return base.mapInPandas(run, schema)
