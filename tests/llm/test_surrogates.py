"""One entity has one surrogate in all its spellings."""

import re

from tallyspark.llm import surrogates


def _replaced(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    return [r.text for r in sorted(surrogates.replace_pii(df, "k").collect(), key=lambda r: r.doc_id)]


def _digits(text):
    return re.sub("[^0-9]", "", text)


def test_spellings_share_a_surrogate(spark):
    a, b, c = _replaced(spark, "Mr John Smith, Bob.Ray@X.com, +1 (687) 555-9292, 4111 1111 1111 1111",
                        "Mr. Smith, bob.ray@x.com, +16875559292, 4111-1111-1111-1111", "BOB.RAY@X.COM (687) 555-9292, 4111111111111111")
    n, e, p, card = a.split(", ")
    n2, e2, p2, card2 = b.split(", ")
    assert n.startswith("Mr ") and n2 == "Mr. " + n.split()[2] and "Smith" not in n + n2
    assert e.lower() == e2 != "bob.ray@x.com" and e[0].isupper() and e.endswith(".com")
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", p) and p2 == "+" + _digits(p)
    assert _digits(card) == _digits(card2) != "4" + "1" * 15 and card2.count("-") == 3
    e3, rest = c.split(" ", 1)
    assert e3 == e2.upper() and rest == f"{p[3:]}, {_digits(card)}"


def test_later_mentions_of_a_name(spark):
    a, b = _replaced(spark, "Mrs Anna Kowal spoke. Later Anna Kowal left, and Kowal's dog; Kowalski stays, annual too.",
                     "Anna Kowal is nobody here.")
    first, last = re.match(r"Mrs (\w+) (\w+) spoke", a).groups()
    assert a == f"Mrs {first} {last} spoke. Later {first} {last} left, and {last}'s dog; Kowalski stays, annual too."
    assert b == "Anna Kowal is nobody here." and len({first, last, "Anna", "Kowal"}) == 4


def test_more_card_forms(spark):
    out = _replaced(spark, "3782 822463 10005 x", "2223 0031 2200 3222 x", "2123465659789240 x", "2720990000000007 x")
    assert re.fullmatch(r"3\d{3} \d{6} \d{5} x", out[0]) and "822463" not in out[0]
    assert re.fullmatch(r"2223 \d{4} \d{4} \d{4} x", out[1]) and "0031 2200" not in out[1]
    assert out[2] == "2123465659789240 x" and out[3] != "2720990000000007 x"
