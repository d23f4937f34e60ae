from __future__ import annotations

import re

from saleloom.llm import surrogates


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return surrogates.replace_entities(df, key).orderBy("doc_id").collect()


WHOLE = [
    ("secret", "token=" + "a1B2" * 120, r"token=[A-Za-z0-9]{480}"),
    ("secret", "password=" + "x" * 300 + "9", r"password=[a-z]{300}\d"),
    ("secret", "password: correcthorse", r"password: [a-z]{12}"),
    ("secret", 'DB_PASSWORD="two words here"', r'DB_PASSWORD="[a-z]{3} [a-z]{5} [a-z]{4}"'),
    ("phone", "+14155552671", r"\+1\d{10}"),
    ("phone", "4155552671", r"\d{10}"),
    ("phone", "+44 20 7946 0958", r"\+44 \d\d \d{4} \d{4}"),
    ("phone", "+33 1 23 45 67 89", r"\+33 \d( \d\d){4}"),
    ("phone", "+49 30 1234567", r"\+49 \d\d \d{7}"),
    ("phone", "0044 20 7946 0958", r"0044 \d\d \d{4} \d{4}"),
    ("phone", "030 1234567", r"0\d\d \d{7}"),
    ("card", "3782 822463 10005", r"3\d{3} \d{6} \d{5}"),
    ("ip6", "2001:db8::ff00:42:8329", r"2001:0db8(:[0-9a-f]{4}){6}"),
    ("ip6", "fe80::1", r"2001:0db8(:[0-9a-f]{4}){6}"),
    ("ip6", "::ffff:1.2.3.4", r"2001:0db8(:[0-9a-f]{4}){6}"),
    ("key", "ghp_" + "aB3" * 12, r"ghp_([a-z][A-Z]\d){12}"),
    ("key", "sk-" + "aB3x" * 10, r"sk-([a-z][A-Z]\d[a-z]){10}"),
    ("key", "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxIn0.abc-def_1", r"eyJ\w+\.\w+\.[a-z]{3}-[a-z]{3}_\d"),
    ("email", "müller@example.com", r"[a-z]{6}@[a-z]{10}\.example\.org"),
    ("email", "иванов@пример.рф", r"[а-я]{6}@[a-z]{10}\.example\.org"),
    ("male", "Mr. J. F. Kennedy", r"Mr\. [A-Z][a-z]+ [A-Z][a-z]+"),
]


def test_whole_entities_are_replaced(spark):
    rows = replaced(spark, [f"and {value} of it" for _, value, _ in WHOLE])
    for (kind, value, pattern), row in zip(WHOLE, rows, strict=True):
        assert [e.kind for e in row.entities] == [kind], value
        assert re.fullmatch(f"and {pattern} of it", row.text), (value, row.text)
        assert value not in row.text


def test_no_entities(spark):
    texts = ["n 1234567890123456 at 1700000000", "12:30:45 std::vector ::add() a::b", "password: ******** token=------", "3.4155552671"]
    assert [r.text for r in replaced(spark, texts)] == texts


def test_layouts_of_one_number_agree(spark):
    phones, addresses = replaced(spark, ["+14155552671, 4155552671, (415) 555-2671, +1 415 555 2671", "2001:db8::1:2, 2001:0DB8:0:0:0:0:0001:0002"])
    assert len({re.sub(r"\D", "", e.surrogate)[-10:] for e in phones.entities}) == 1
    assert phones.n_entities == 4
    assert len({e.surrogate.lower() for e in addresses.entities}) == 1


def test_names_follow_the_surname(spark):
    text = "Mr. John Smith met Mrs. Smith. Later Smith and John Smith left; SMITH too. Mr. Jack Smith and Blacksmith"
    one, two = replaced(spark, [text, "Mr. Smith saw a Smith, and Smithers"])
    assert "Smith" not in one.text.replace("Blacksmith", "")
    surname = re.match(r"Mr\. \w+ (\w+) met", one.text).group(1)
    assert one.text.count(surname) == 5
    assert one.text.count(surname.upper()) == 1
    assert two.text == f"Mr. {surname} saw a {surname}, and Smithers"
    john, jack = re.match(r"Mr\. (\S+) ", one.text).group(1), re.search(r"Mr\. (\S+) \w+ and B", one.text).group(1)
    assert john != jack
    assert f"and {john} {surname} left" in one.text
    assert replaced(spark, ["A Smith without a title"])[0].n_entities == 0
