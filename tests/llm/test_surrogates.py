from __future__ import annotations

import re

from clinlake.llm import surrogates
from clinlake.llm.surrogates import entities, in_format, replace_entities, surrogate
from tests.llm.helpers import DOCUMENTS, documents, with_texts

TEXT = (
    "Write to Ann.34@mail7.example.com or ANN.34@MAIL7.EXAMPLE.COM, call +1 (017) 555-7713 or 212-555-1234, pay with "
    '4111 1111 1111 1111 or 9807915762804490### from 97.51.17.173; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962". '
    "Mr. John Smith and Frau Anna Müller, г-жа Иванова; 123-45-6789. Version 4.0, GPL-3, 2024-01-31, 12345."
)


def test_entities_and_what_is_none():
    found = [(k, TEXT[a:b]) for a, b, k, _ in entities(TEXT)]
    kinds = [k for k, _ in found]
    assert kinds == ["email", "email", "phone", "phone", "account", "account", "ip", "secret", "name-m", "name-f", "name-f", "ssn"]
    assert entities("Version 4.0 of 2024-01-31, 12345 words, 3.14159 and a+b=c; The Mrs. of it") == []


def test_surrogates_keep_format_and_coreference(spark):
    made = replace_entities(with_texts(spark, [TEXT, TEXT.replace("Ann.", "ann.")])).orderBy("doc_id").collect()
    text = made[0]["text"]
    assert len(text) - len(TEXT) < 40 and made[0]["n_entities"] == 12
    own = {TEXT[a:b] for a, b, _, _ in entities(TEXT)}
    assert not any(e in text for e in own)
    mails = re.findall(r"\S+@\S+[^,\s]", text)
    assert mails[0].lower() == mails[1].lower().rstrip(",") and mails[1].isupper()
    assert re.search(r"call \+\d \(\d{3}\) \d{3}-\d{4} or \d{3}-\d{3}-\d{4},", text)
    assert re.search(r"Frau [A-Z][a-z]+ [A-Z][a-z]+(lina|bella|dora|nia),", text) and re.search("г-жа [А-Я][а-я]+(ова|нина|рина)", text)
    assert text.endswith("Version 4.0, GPL-3, 2024-01-31, 12345.")
    assert made[1]["text"].split()[3:] == made[0]["text"].split()[3:]


NAMES = [
    "Mr. John Smith said hi. Smith left. Mr Smith wept.", "Dr. Maria Garcia Lopez came.", "Mr. John Q. Smith spoke.", "Mr. J. Smith sat.",
    "Dr Smith met Prof. Dr. Ludwig van Beethoven and Mrs. O'Brien; SMITH and J. Smith's dog ran.", "Mrs. Smith Then slept. Then he did.",
    "John Smith came. Mr. J.R.R. Smith stayed. Jones and john went.", "Señora Ángela Núñez écrit. Núñez",
    "Ms. So Young2 and Dr. So went. So be it.",
]


def test_names_agree_in_every_form(spark):
    made = [r["text"] for r in replace_entities(with_texts(spark, NAMES)).orderBy("doc_id").collect()]
    m = re.fullmatch(r"Mr\. (\w+) (\w+) said hi\. (\w+) left\. Mr (\w+) wept\.", made[0])
    john, smith, *more = m.groups()
    assert more == [smith, smith] and john != smith
    j = john[0]
    assert re.fullmatch(r"Dr\. [A-Z]\w+ [A-Z]\w+ [A-Z]\w+ came\.", made[1]) and not re.search("Maria|Garcia|Lopez", made[1])
    assert re.fullmatch(rf"Mr\. {john} [B-Z]\. {smith} spoke\.", made[2]) and " Q." not in made[2]
    assert made[3] == f"Mr. {j}. {smith} sat." and j != "J"
    assert re.fullmatch(
        rf"Dr {smith} met Prof\. Dr\. \w+ van \w+ and Mrs\. \w+; {smith.upper()} and {j}\. {smith}'s dog ran\.", made[4]
    )
    assert made[5] == f"Mrs. {smith} Then slept. Then he did."
    assert re.fullmatch(rf"John {smith} came\. Mr\. {j}\.[A-Z]\.[A-Z]\. {smith} stayed\. Jones and john went\.", made[6])
    assert re.fullmatch(r"Señora \w+ (\w+) écrit\. \1", made[7])
    assert re.fullmatch(r"Ms\. (\w+) [A-Z][a-z]+2 and Dr\. \1 went\. So be it\.", made[8])
    own = r"Young|Ludwig|Beethoven|Brien|Smith|SMITH|Ángela|Núñez"
    assert not any(re.search(own, t) for t in made)


def test_numbers_are_permuted():
    for kind, form in (("phone", "{:010d}"), ("account", "{:016d}"), ("ssn", "{:09d}")):
        made = {surrogate(kind, form.format(i)) for i in range(300)}
        assert len(made) == 300 and all(len(m) == len(form.format(0)) for m in made)
    assert surrogates._luhn(surrogate("account", "4111111111111111")) and in_format("phone", "12-3", "456") == "45-6"


def test_initials_keep_people_apart(spark):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for alphabet in (letters, "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЭЮЯ", "ÀÈÉÎÑÖÜØ", "ŠŽŁ", "ΑΒΓΔΩ"):
        made = {c: surrogates._initial(c, "k") for c in alphabet}
        assert len(set(made.values())) == len(alphabet) and all(c.casefold() != m for c, m in made.items())
    texts = [f"Mr. {c}. Smith came." for c in letters] + [f"Dr. {c}{c.lower()}nes came." for c in letters]
    made = [r["text"] for r in replace_entities(with_texts(spark, texts)).collect()]
    assert len(set(made)) == len(texts)


def test_numbers_agree_with_and_without_country_code(spark):
    text = "call +1 415-555-2671 or 415-555-2671 or (415) 555-2671, not +1 415-555-2672"
    made = replace_entities(with_texts(spark, [text])).first()["text"]
    first, second, third, fourth = re.fullmatch(r"call \+\d ([\d-]+) or ([\d-]+) or ([()\d -]+), not \+\d ([\d-]+)", made).groups()
    assert first == second == re.sub(r"\((\d+)\) ", r"\1-", third) != fourth and first != "415-555-2671"


def test_redrawn_entities_by_join_and_columns_of_any_name(spark, monkeypatch):
    texts = NAMES + ["Mr. Smith", "Mrs. Smith and Mr. Jones", None, ""]
    docs = with_texts(spark, texts).selectExpr("IF(doc_id % 3 = 0, NULL, doc_id) AS doc_id", "text", "'x' AS redrawn", "1 AS other_id", "2 AS attempt")
    few = sorted(map(str, replace_entities(docs).collect()))
    monkeypatch.setattr(surrogates, "REDRAWN_BYTES", -1)
    assert sorted(map(str, replace_entities(docs).collect())) == few and "redrawn='x', other_id=1, attempt=2" in few[0]


def test_collisions_are_drawn_again(spark, monkeypatch):
    real = surrogates.surrogate
    # The first draw of all addresses is the same, the second hits a real one for a@.
    def narrow(kind, canonical, key=surrogates.KEY, attempt=0):
        if attempt == 0:
            return "same@x.org"
        if attempt == 1 and canonical.startswith("b"):
            return "cc@real.org"
        return real(kind, canonical, key, attempt)

    monkeypatch.setattr(surrogates, "surrogate", narrow)
    texts = [f"mail {w}@real.org now" for w in ("aa", "bb", "cc", "dd")]
    made = [r["text"] for r in replace_entities(with_texts(spark, texts)).orderBy("doc_id").collect()]
    assert len(set(made)) == 4 and not any(w + "@real.org" in t for t in made for w in ("aa", "bb", "cc", "dd"))


def test_rows_of_every_kind(spark):
    docs = documents(spark)
    found = replace_entities(docs)
    assert found.columns == [c for c in docs.columns if c not in ("n_entities", "kinds")] + ["n_entities", "kinds"]
    rows = found.collect()
    assert len(rows) == len(DOCUMENTS) and all(r["n_entities"] == 0 for r in rows)
    assert {(r["doc_id"], r["text"]) for r in rows} == {(r[0], r[1]) for r in DOCUMENTS}
    assert replace_entities(documents(spark, [])).collect() == []
